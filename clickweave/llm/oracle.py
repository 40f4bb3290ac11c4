"""DuckDB SQL of the training-data queries that SQL can express."""

from __future__ import annotations

OP4 = rf"""
with recursive docs as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
), sets as (
  select doc_id, case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) end as s
  from docs
), rows_ as (select doc_id, len(s) as n, unnest(s) as g from sets),
common as (
  select a.doc_id as a, b.doc_id as b, any_value(a.n) as na, any_value(b.n) as nb, count(*) as c
  from rows_ a join rows_ b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2
), links as (
  select a, b from common where 100 * c >= 85 * (na + nb - c)
), both_ as (select a, b from links union all select b, a from links),
reach as (
  select doc_id, doc_id as r from sets
  union
  select reach.doc_id, both_.b from reach join both_ on reach.r = both_.a
), least_ as (select doc_id, min(r) as component_id from reach group by 1)
select s.doc_id, len(s.s)::bigint as n_shingles, l.component_id, s.doc_id = l.component_id as kept
from sets s join least_ l using (doc_id)
"""

OP6 = r"""
with docs as (
  select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as n from documents
), shares as (select source, sum(n)::bigint as tokens from docs group by 1),
ends as (select min(tokens) filter (tokens > 0) as lo, max(tokens) as hi, sum(tokens) as total from shares),
-- the smallest exponent from 0 whose busiest source repeats at most 4 times
found as (select *, case when hi <= 4 * lo then 0.0 else 1 - ln(4) / ln(hi / lo) end as a from ends),
powers as (select source, tokens, case when tokens > 0 then pow(tokens / total, a) else 0 end as power from shares, found),
plan as (
  select source, tokens, power / z as weight,
    case when tokens > 0 then floor(round(power / z * hi * z / pow(hi / total, a), 3)) else 0 end::bigint as target
  from powers, found, (select sum(power) as z from powers)
), epochs as (
  select *, case when tokens > 0 then target // tokens else 1 end as whole, case when tokens > 0 then target % tokens else 0 end as rest from plan
), part as (
  select doc_id, docs.source, n, whole as epoch, rest,
    sum(n) over (partition by docs.source order by md5('17:' || whole || ':' || doc_id)) as upto
  from docs join epochs on docs.source is not distinct from epochs.source
), shown as (
  select doc_id, docs.source, n, e as epoch from docs join epochs on docs.source is not distinct from epochs.source, unnest(range(whole)) r(e)
  union all select doc_id, source, n, epoch from part where rest > 0 and upto <= rest
), placed as (
  select *, sum(n) over (partition by source, epoch order by md5('17:' || epoch || ':' || doc_id)) as upto from shown
)
select doc_id, placed.source, n as n_tokens, epoch::int as epoch,
  case when weight > 0 then floor((epoch * tokens + greatest(upto - 1, 0)) / (weight * 1000000))::bigint else 0 end as block
from placed join epochs on placed.source is not distinct from epochs.source
"""

OP7 = r"""
with docs as (
  select doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents
), windows as (
  select doc_id, unnest(range(1, len(w) - 48)) as i, unnest(list_transform(range(1, len(w) - 48), lambda k: md5(array_to_string(w[k:k+49], ' ')))) as h
  from docs where len(w) > 49
), firsts as (select h, min(doc_id) as first from windows group by 1),
gone as (
  select distinct doc_id, i + k as i from windows join firsts using (h), range(50) r(k) where first < doc_id
), words as (select doc_id, unnest(w) as x, unnest(range(1, len(w) + 1)) as i from docs),
kept as (
  select words.doc_id, string_agg(x, ' ' order by words.i) as t, count(*) as n
  from words anti join gone on words.doc_id = gone.doc_id and words.i = gone.i group by 1
)
select docs.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from docs left join kept using (doc_id)
"""

OP10 = r"""
with docs as (
  select doc_id, source, coalesce(text, '') as t,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents
), places as (
  select doc_id, unnest(range(1, len(w) - 1)) as i, unnest(list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2])) as g
  from docs where len(w) > 2
), windows as (
  select doc_id, i, count(*) over (partition by doc_id, g) as n from places
), covered as (
  select doc_id, count(distinct i + k) as n from windows, range(3) r(k) where windows.n > 1 group by 1
), base as (
  select docs.doc_id, source, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(covered.n, 0)::bigint as n_repeat_words
  from docs left join covered using (doc_id)
), failed as (
  select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed from base
), hosts as (
  select source, count(*) as n, sum(base_failed::int) as f from failed group by 1
), prior as (
  select sum(f) / sum(n) as m, var_samp(f / n) as v, sum(n) as rows_ from hosts
), rates as (
  select source, (f + m * k) / (n + k) as rate
  from hosts, (select m, case when v > 0 then greatest(1.0, m * (1 - m) / v - 1) else rows_ end as k from prior)
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and not coalesce(rate > 0.5, false) as kept
from failed left join rates on failed.source is not distinct from rates.source
"""

OP1 = r"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  union all select -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), numbered as (
  select *, row_number() over w as i, count(*) over (partition by conv_id) as n,
    sum(length('<|im_start|>' || regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g') || chr(10) || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10))) over w as upto
  from said window w as (partition by conv_id order by turn, role, text rows unbounded preceding)
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by i)) as turns_sha256,
  coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by i) filter (role = 'assistant'), '')) as loss_sha256,
  sum(upto) filter (role = 'assistant' or i = n)::bigint as formatted_chars
from numbered group by conv_id
"""

OP13 = r"""
with recursive crc(n, k, v) as (
  select n, 0, n::ubigint from range(256) r(n)
  union all select n, k + 1, case when v & 1 = 1 then xor(v >> 1, 3988292384::ubigint) else v >> 1 end from crc where k < 8
), tab as (select list(v order by n) as t from crc where k = 8),
heads as (
  select conv_id, xor(list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(conv_id::varchar, ''), lambda x: ascii(x)::ubigint)),
    lambda a, b: xor(a >> 8, t[((xor(a, b) & 255) + 1)::bigint])), 4294967295::ubigint) % 4 as h
  from (select distinct conv_id from conversations), tab
), said as (
  select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first) as i
  from conversations
), rebuilt as (
  select c.conv_id as c, 0 as part, i, role, text from heads c join said s on s.conv_id = c.conv_id - c.conv_id % 20 and i <= h
  union all select c.conv_id, 1, i, role, text from heads c join said s using (conv_id) where i > h
), members as (
  select c, row_number() over w as depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as words,
    string_agg(length(role) || ':' || role || length(text) || ':' || text, '') over w as path
  from rebuilt window w as (partition by c order by part, i rows unbounded preceding)
  union all select conv_id, 0, 0, '' from heads
), placed as (select *, lag(path) over (partition by c order by depth) as up, depth = max(depth) over (partition by c) as ends from members),
nodes as (
  select path, any_value(up) as up, any_value(depth) as depth, min(c) as conv_id, count(*) as n_convs, any_value(words) as words,
    coalesce(string_agg(c::varchar, ',' order by c) filter (ends), '') as ended
  from placed group by path
), children as (select up as path, count(*) as n_children from nodes where up is not null group by 1),
below as (
  select a.path, sum((u.n_convs - 1) * u.words)::bigint as saved_tokens, count(*) filter (k.n_children is null) as n_leaves
  from nodes u left join children k using (path) join members a on a.c = u.conv_id and a.depth <= u.depth group by 1
)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(k.n_children, 0) as n_children, b.n_leaves, b.saved_tokens,
  sha256(n.ended) as ends_sha256
from nodes n join below b using (path) left join children k using (path) left join nodes p on p.path = n.up
"""

ORACLES: dict[str, str] = {"op1_chat_format": OP1, "op4_near_dedup": OP4, "op6_mixing": OP6, "op7_substring_dedup": OP7, "op10_host_quality": OP10, "op13_prefix_trie": OP13}
