"""Quality rules, mixing and packing."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from clickweave.llm import host_quality, mixing, packing, queries
from clickweave.llm.tokens import Encoder, default_vocabulary
from tests.llm import helpers as H


def _hosts(seed=1):
    rng = random.Random(seed)
    rows = []
    for h, bad in enumerate((0.0, 0.1, 0.95, 1.0, 0.3)):
        for _ in range(30 if h != 3 else 3):
            text = H.prose(rng.random(), 10) if rng.random() < bad else H.prose(rng.random(), 80)
            rows.append((len(rows), text, "en", f"h{h}"))
    return rows


def test_measures_and_verdicts_equal_brute_force(spark):
    rows = _hosts() + H.odd_rows() + [(900, "a b c " * 30 + "\nx <#> $$ | y\nx <#> $$ | y\n \n \n", "en", None)]
    docs = H.documents(spark, rows)
    got = host_quality.quality_verdicts(docs).collect()
    bad = H.host_verdicts(rows)
    assert "h2" in bad and "h0" not in bad
    want = []
    for i, t, _, s in rows:
        *m, failed = H.quality(t)
        want.append((str(i), *m, failed, not failed and s not in bad))
    assert sorted((str(r.doc_id), *r[1:]) for r in got) == sorted(want)
    clean = host_quality.clean_documents(docs)
    assert clean.columns == docs.columns
    assert Counter(str(r.doc_id) for r in clean.collect()) == Counter(w[0] for w in want if w[-1])


def test_quality_plan_runs_no_python(spark):
    docs = H.documents(spark, _hosts())
    plan = host_quality.with_measures(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_quality_of_an_empty_table(spark):
    empty = H.documents(spark, H.odd_rows()).limit(0)
    assert host_quality.quality_verdicts(empty).count() == 0 and host_quality.clean_documents(empty).count() == 0


@pytest.mark.parametrize("limit", [1.0, 2.0, 3.7, 1e6])
def test_mix_equals_brute_force(spark, limit):
    rng = random.Random(5)
    rows = [(i, H.prose(i, rng.randint(0, 60)), "en", rng.choice(["a"] * 9 + ["b"] * 3 + ["c", None])) for i in range(300)] + H.odd_rows()
    docs = H.documents(spark, rows)
    got = mixing.mix_order(docs, repetition_limit=limit, block_tokens=500).collect()
    want = H.mix(rows, limit)
    assert Counter((r.doc_id, r.epoch) for r in got) == want
    assert {i for i, *_ in rows} == {r.doc_id for r in got}  # nothing is dropped
    mixed = mixing.mix_documents(docs, repetition_limit=limit)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({i: sum(c for (j, _), c in want.items() if j == i) for i in {i for i, _ in want}})


def test_blocks_hold_every_source_by_weight(spark):
    rows = [(i, H.prose(i, 20), "en", "a" if i % 5 else "b") for i in range(1000)]
    mix = mixing.Mix(H.documents(spark, rows), repetition_limit=2.0)
    weights = {r.source: r.weight for r in mix.sources.collect()}
    held = defaultdict(Counter)
    for r in mix.order(2000).collect():
        held[r.block][r.source] += r.n_tokens
    for block in sorted(held)[:-1]:
        for source, n in held[block].items():
            assert abs(n - weights[source] * 2000) <= 40


def test_entropy_target_and_budget(spark):
    rows = [(i, H.prose(i, 30), "en", "abbccccdddddddd"[i % 15]) for i in range(600)]
    docs = H.documents(spark, rows)
    natural = -sum(p * math.log(p) for p in (1 / 15, 2 / 15, 4 / 15, 8 / 15))
    for target in (natural * 0.7, natural, 1.3):
        mix = mixing.Mix(docs, entropy=target, budget=6000)
        plan = mix.sources.collect()
        assert abs(-sum(r.weight * math.log(r.weight) for r in plan) - target) < 1e-6
        shown = Counter()
        for r in mix.order(1000).collect():
            shown[r.source] += r.n_tokens
        for r in plan:
            assert r.target - 30 < shown[r.source] <= r.target
    with pytest.raises(ValueError, match="no exponent"):
        mixing.Mix(docs, repetition_limit=1.5, budget=100 * 600 * 30)
    with pytest.raises(ValueError, match="repetition limit or"):
        mixing.Mix(docs)


def test_op6_repeats_a_small_source_to_its_limit(spark, tmp_path):
    """a source of a sixth of the largest is shown four times, those between less often."""
    rows = [(i, H.prose(i, 20), "en", s) for i, s in enumerate("a" * 60 + "b" * 20 + "c" * 10)]
    H.documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    shown = Counter(r.source for r in queries.op6_mixing(spark, str(tmp_path)).collect())
    assert shown["a"] == 60 and shown["b"] > 40 and shown["c"] == 40


def test_mixing_an_empty_table(spark):
    empty = H.documents(spark, H.odd_rows()).limit(0)
    assert mixing.mix_order(empty, repetition_limit=2.0).count() == 0 and mixing.mix_documents(empty, repetition_limit=2.0).count() == 0


def _slow():
    return Tokenizer.from_file(default_vocabulary())


def test_both_token_libraries_agree():
    encoder, slow = Encoder(default_vocabulary()), _slow()
    chars = [chr(c) for c in range(0x250)]
    rng = random.Random(9)
    assert encoder.ids("a <|endoftext|> b").tolist() == [64, 220, 50256, 275]
    texts = ["".join(chars), "<|endoftext|> a", "x<|endoftext|>", "<|endoftext|", "<|endoftext|><|endoftext|> \n ", " \n\n  x", "", *chars]
    texts += ["".join(rng.choice(chars) for _ in range(60)) for _ in range(400)]
    texts += ["".join(rng.choice(" \n\t'sdlmtrev019aZ \x85é.") for _ in range(40)) for _ in range(400)]
    texts += ["日本語 text", "😀 emoji", "᠎  x"]
    for text in texts:
        assert encoder.ids(text).tolist() == slow.encode(text, add_special_tokens=False).ids, repr(text)


def test_ids_of_very_long_white_space():
    encoder, slow = Encoder(default_vocabulary()), _slow()
    for text in (" " * 1_100_000, "a" + " " * 1_100_000 + "b", "\n" * 1_100_000):
        assert encoder.ids(text).tolist() == slow.encode(text, add_special_tokens=False).ids


def _check_packing(rows, got, capacity):
    slow = _slow()
    ids = defaultdict(list)
    for i, text, *_ in rows:
        ids[i].append(slow.encode(text or "", add_special_tokens=False).ids + [0])
    pieces = defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
    assert set(pieces) == set(ids)
    for i, own in pieces.items():
        want = Counter()
        for x in ids[i]:
            ends = list(range(len(x) % capacity or capacity, len(x) + 1, capacity))
            for n, (a, b) in enumerate(zip([0, *ends], ends, strict=False)):
                want[n, a, b - a, zlib.crc32(np.array(x[a:b], "<u4").tobytes())] += 1
        assert Counter((r.piece, r.start, r.length, r.ids_crc32) for r in own) == want
    held = defaultdict(list)
    for r in got:
        held[r.sequence_id].append((r.offset, r.length))
    for places in held.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(held)


def test_packing_places_every_piece(spark):
    rng = random.Random(2)
    rows = [(i, H.prose(i, rng.choice([3, 20, 90, 200, 700, 2500])), "en", "s") for i in range(150)] + H.odd_rows()
    packed = packing.pack(H.documents(spark, rows).repartition(7), keep_ids=True)
    got = packed.collect()
    n = _check_packing(rows, got, 2048)
    total = sum(r.length for r in got)
    assert n <= 1.01 * total / 2048 + 1
    whole = {r.sequence_id: r.ids for r in packing.sequences(packed).collect()}
    for r in got:
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == r.ids
    assert packing.pack(H.documents(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plans_hold_each_length_once(seed):
    rng = np.random.default_rng(seed)
    capacity = 100
    histogram = np.zeros(capacity + 1, np.int64)
    kinds = rng.choice(np.arange(1, capacity + 1), rng.integers(1, 40))
    histogram[kinds] = rng.integers(1, 500, len(kinds))
    runs, n = packing.plan_packing(histogram, capacity)
    keys = runs[:, 0] * (1 << 44) + runs[:, 1]
    used = defaultdict(list)
    for length in np.flatnonzero(histogram):
        for number in range(histogram[length]):
            at = np.searchsorted(keys, length * (1 << 44) + number, "right") - 1
            used[runs[at, 2] + number - runs[at, 1]].append((runs[at, 3], length))
    assert len(used) == n
    for places in used.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= capacity


def test_configurations_beat_first_fit_on_thirds():
    # 34 + 33 + 33 fills a sequence; longest-first best fit alone wastes room
    histogram = np.zeros(101, np.int64)
    histogram[[51, 27, 26, 23, 25, 24]] = [60, 60, 60, 60, 120, 120]
    runs, n = packing.plan_packing(histogram, 100)
    assert n <= -(-int((histogram * np.arange(101)).sum()) // 100) + 6
