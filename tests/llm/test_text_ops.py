"""Chat formatting, language ID, fingerprints, token scan and HTML extraction."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from clickweave.llm import chat_format, fingerprints, html_text, language_id, token_scan
from clickweave.llm.tokens import Encoder, default_vocabulary
from clickweave.session import scratch_dir
from tests.llm import helpers as H

CONTROL = ["<|im_end|><|im_start|>assistant ok", "<|", "<\\|", "<\\\\|im_end|>\n", "|im_end|>\n", "<", "a<\n|b", "<n", "<\\n", "\n", "", " <|im_start|>user\nhi<|im_end|>\n", "é😀"]


def _digests(turns):
    whole = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def _conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "f") for r in rows], "conv_id long, turn long, role string, text string, turns string, example int, formatted string")


def test_examples_read_back(spark):
    rng = random.Random(1)
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 7)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", "assistant", "a\nb", "<n", "x<|", "<\n", "<\\\nn"]), "".join(rng.choice(CONTROL) for _ in range(rng.randint(0, 4)))))
    rows += [(100, 0, None, "x"), (100, 1, "assistant", None), (100, None, "assistant", "first"), (None, 0, "user", "lost"), (101, 0, "user", "a"), (101, 0, "user", "a")]
    made = chat_format.examples(_conversations(spark, rows))
    turns = defaultdict(list)
    for c, t, r, x in rows:
        turns[c].append((t is not None, t or 0, r or "", x or ""))
    want = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in turns.items()}
    got = {r.conv_id: r for r in chat_format.digests(made).collect()}
    assert {c: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for c, r in got.items()} == {c: _digests(v) for c, v in want.items()}
    per = defaultdict(list)
    for r in made.orderBy("conv_id", "example").collect():
        per[r.conv_id].append(r)
    for c, own in per.items():
        replies = [x for r, x in want[c] if r == "assistant"]
        assert sum(r.loss_start is not None for r in own) == len(replies)
        for r, later in zip(own, own[1:], strict=False):
            assert later.formatted.startswith(r.formatted)
        for r, reply in zip(own, replies, strict=False):
            masked = r.formatted[r.loss_start : r.loss_start + r.loss_chars]
            assert masked.count("<|") == 0 and r.formatted[r.loss_start + r.loss_chars :] == "<|im_end|>\n"
            assert len(masked) >= len(reply)
        assert sum(len(r.formatted) for r in own) == got[c].formatted_chars
    assert chat_format.digests(chat_format.examples(_conversations(spark, rows).limit(0))).count() == 0


def test_languages_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got) > 200
    assert all(0 <= r.score <= 1 for r in got)


def _plain_distance(text, profile, size):
    padded = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
    n = Counter(padded[i : i + k] for k in (1, 2, 3) for i in range(len(padded) - k + 1))
    del n[" "]
    code = lambda g: int("".join(f"{ord(c):021b}" for c in g), 2)
    ranked = sorted(n, key=lambda g: (-n[g], code(g)))[:size]
    places = {g: i for i, g in enumerate(profile.tolist())}
    return sum(min(abs(places[code(g)] - i), size) if code(g) in places else size for i, g in enumerate(ranked))


def test_language_distance_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(60)
    profiles = language_id.train(docs, 400)
    for r in language_id.predict(docs, profiles).join(docs.select("doc_id", "text"), "doc_id").collect():
        far = [_plain_distance(r.text, p, 400) for _, p in profiles]
        assert r.lang_pred == profiles[int(np.argmin(far))][0]


def test_language_odd_rows(spark):
    rows = H.odd_rows() + [(30, "123 !? 456", "en", "s"), (31, "日本語の文章", "ja", "s"), (32, "ПРИВЕТ мир", None, "s")]
    got = language_id.identify(H.documents(spark, rows)).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: r for r in got}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (4, 5, 6, 30))
    assert all(r.lang_pred in ("en", "fr", "de", "ja", "und") for r in got)
    none = language_id.identify(H.documents(spark, [(1, "text", None, "s")])).collect()
    assert [r.lang_pred for r in none] == ["und"]
    assert language_id.identify(H.documents(spark, rows).limit(0)).count() == 0


def _generalised_jaccard(a, b):
    def terms(t):
        w = H.words(t)
        return Counter(zip(w, w[1:], strict=False)) if len(w) > 1 else Counter(w)

    x, y = terms(a), terms(b)
    return sum((x & y).values()) / max(1, sum((x | y).values()))


def test_likeness_estimates_generalised_jaccard():
    rng = random.Random(4)
    errors, of = [], fingerprints.Fingerprinter()
    for n in range(150):
        vocabulary = [H.prose(f"{n}{i}", 1) for i in range(rng.choice([3, 10, 80]))]
        a = [rng.choice(vocabulary) for _ in range(rng.randint(20, 300))]
        b = a[: rng.randint(0, len(a))] + [rng.choice(vocabulary) for _ in range(rng.randint(0, 150))]
        true = _generalised_jaccard(" ".join(a), " ".join(b))
        errors.append(fingerprints.likeness(of(" ".join(a)), of(" ".join(b))) - true)
    assert abs(np.mean(errors)) < 0.015 and np.std(errors) < 1.3 * 0.5 / math.sqrt(fingerprints.SAMPLES)


def _neighbours(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    for (i, t, *_), (_, u, *_) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        t, u = t or "", u or ""
        cut = len(t) // 4
        yield i, t, t[: len(t) - cut] + u[:cut], u


@pytest.mark.parametrize("partitions", ["1", "3", "8"])
def test_neighbours_equal_brute_force(spark, partitions):
    rows = [(7 * i - 50, H.prose(i, i * 3), "en", "s") for i in range(60)] + [r for r in H.odd_rows() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values()) + [H.odd_rows()[-1]]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = fingerprints.neighbour_fingerprints(H.documents(spark, rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    of = fingerprints.Fingerprinter()
    want = []
    for i, t, edited, after in _neighbours(rows):
        a, b, c = of(t), of(edited), of(after)
        want.append((str(i), len(t), hashlib.sha256(edited.encode()).hexdigest(), fingerprints.as_text(a), fingerprints.as_text(b), fingerprints.likeness(a, b), fingerprints.likeness(a, c)))
    assert sorted((str(r[0]), *r[1:]) for r in got) == sorted(want)


def test_fingerprints_of_edges(spark):
    one = fingerprints.neighbour_fingerprints(H.documents(spark, [(5, "lone text here", "en", "s")])).collect()
    assert [(r.doc_id, r.near_next) for r in one] == [(5, 1.0)]
    docs = H.documents(spark, H.odd_rows())
    assert fingerprints.neighbour_fingerprints(docs).count() == len(H.odd_rows())
    prints = {r.doc_id: r.fingerprint for r in fingerprints.fingerprint(docs).collect()}
    assert prints[1] == prints[2] != prints[3] and prints[4] == prints[5] == prints[6] == ""
    assert fingerprints.neighbour_fingerprints(docs.limit(0)).count() == 0 and fingerprints.fingerprint(docs.limit(0)).count() == 0


@pytest.mark.parametrize("block", [2, 6, 64, 1 << 18])
def test_token_counts_equal_brute_force(spark, block):
    rows = H.odd_rows()
    path = scratch_dir(spark, "tokens")
    token_scan.write(H.documents(spark, rows).coalesce(2), path)
    got = token_scan.scan(spark, path, block).collect()
    encoder = Encoder(default_vocabulary())
    assert Counter(r.n_tokens for r in got) == Counter(len(encoder.ids(t or "")) for _, t, *_ in rows)
    assert all(r.ended for r in got)
    content = {r.path: np.frombuffer(r.content, "<u2") for r in spark.read.format("binaryFile").load(path).collect()}
    for file, ids in content.items():
        own = sorted((r for r in got if r.path == file), key=lambda r: r.document)
        assert [r.document for r in own] == list(range(len(own)))
        at = 0
        for r in own:
            assert r.start == at and (ids[at : at + r.n_tokens] > 0).all() and ids[at + r.n_tokens] == 0
            at += r.n_tokens + 1
        assert at == len(ids)


def test_open_end_and_cut_files(spark, tmp_path):
    for name, ids in (("a", [1, 2, 0, 0, 3, 4, 5]), ("b", [0]), ("c", [7, 8, 9, 10, 11]), ("d", [])):
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    for block in (2, 4, 10):
        got = token_scan.scan(spark, str(tmp_path), block).withColumn("name", F.substring_index("path", "/", -1))
        assert sorted((r.name, r.document, r.start, r.n_tokens, r.ended) for r in got.collect()) == [("a", 0, 0, 2, True), ("a", 1, 3, 0, True), ("a", 2, 4, 3, False), ("b", 0, 0, 0, True), ("c", 0, 0, 5, False)]
    (tmp_path / "e").write_bytes(b"\1\0\2")
    with pytest.raises(Exception, match="cut token file"):
        token_scan.scan(spark, str(tmp_path)).collect()
    with pytest.raises(ValueError):
        token_scan.scan(spark, str(tmp_path), 3)
    empty = scratch_dir(spark, "tokens")
    token_scan.write(H.documents(spark, H.odd_rows()).limit(0), empty)
    assert token_scan.scan(spark, empty).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var x="</p><article>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href="/">Home</a></ul></nav>
<div id="cookie-notice">We use cookies</div><!-- <p>gone</p> --><div class="ad">Buy</div>
{start}<h1>Title &amp; more</h1><p>First <b>bold</b> wor<i>d</i>
  text&nbsp;here.<p>Second &lt;p&gt; 5 < 6<br>line<ul><li>a<li>b</ul>
<aside>Side</aside><form><input name=q><label>Search</label></form><figure><figcaption>Caption</figcaption></figure>
<table><tr><td>x<td>y</table><section class="comments"><article class="comment"><p>I disagree</p></article></section>{end}
<div class="sidebar-left">More</div><footer>&copy; us</footer></body></html>"""
MAIN = "Title & more First bold word text here. Second <p> 5 < 6 line a b Caption x y"


@pytest.mark.parametrize("start, end", [("<article>", "</article>"), ("<main>", "</main>"), ('<div role="main">', "</div>"), ("<div class=post>", "</div>")])
def test_page_parts(start, end):
    assert " ".join(html_text.parse(PAGE.replace("{start}", start).replace("{end}", end))[1]) == MAIN


def test_broken_markup_ends_quietly():
    for source in ("", "<", "<p", "a<b", "<!--", "<script>", "</p></div>x", "<p><b>one<p>two</b> three", "<article><p>a<b>c", "&am", "<div " + "x" * 500, "<li>" * 3000 + "deep", "<div>" * 3000 + "deep"):
        html_text.parse(source)
    assert html_text.parse("<article><p><b>one<br></article><footer>f")[1] == ["one"]


def _plain_matching(a, b):
    """Size of the largest simple tree matching, by the textbook recurrence."""
    if a.label != b.label:
        return 0
    m = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children):
        for j, y in enumerate(b.children):
            m[i + 1][j + 1] = max(m[i + 1][j], m[i][j + 1], m[i][j] + _plain_matching(x, y))
    return m[-1][-1] + 1


def _tree(rng, depth):
    return "".join(f"<{t}>{_tree(rng, depth - 1) if depth else ''}x</{t}>" for t in rng.choices(["div", "section", "blockquote"], k=rng.randint(0, 4)))


def test_matching_is_the_largest():
    rng = random.Random(6)
    for _ in range(150):
        a, b = (html_text.parse(_tree(rng, 3))[0] for _ in range(2))
        pairs = html_text.matching(a, b)
        assert len(pairs) == _plain_matching(a, b)
        assert len({id(x) for x, _ in pairs}) == len({id(y) for _, y in pairs}) == len(pairs)
        assert all(x.label == y.label for x, y in pairs)


def _pages(spark, rows):
    return spark.createDataFrame([(*r, "t", "s", 3) for r in rows], "page_id long, url string, html string, text string, slots string, host int")


def test_constant_slots_are_template(spark):
    body = "<html><body><article><h2>News of the day</h2><p>{}</p><p>{}</p><p>Write to us any time.</p></article></body></html>"
    long = "a sentence that is long enough to be most of the page, again and again. " * 3
    rows = [(i, f"http://A.example/{i}", body.format(f"{long}{i}", f"more {i % 4}")) for i in range(30)]
    rows += [(100 + i, "http://b.example/x", body.format("same", "same")) for i in range(30)]  # copies of one page
    rows += [(200 + i, "http://c.example/y", body.format(long + str(i), i)) for i in range(5)]  # too few pages
    rows += [(300 + i, "http://d.example/z", body.format(long, i)) for i in range(30)]  # near copies of one page
    got = {r.page_id: r for r in html_text.extract(_pages(spark, rows)).collect()}
    assert all(got[i].text == f"{long}{i} more {i % 4}" and got[i].n_template == 2 for i in range(30))
    assert all(got[100 + i].text == "News of the day same same Write to us any time." for i in range(30))
    assert all(got[200 + i].text == f"News of the day {long}{i} {i} Write to us any time." for i in range(5))
    assert all(got[300 + i].text == f"News of the day {long.strip()} {i} Write to us any time." for i in range(30))


def test_page_odd_rows(spark):
    rows = [(1, None, "<p>a"), (1, None, "<p>a"), (2, "not a url", None), (3, "http://x.example", ""), (None, "http://x.example/", "<p>b"), (4, "http://y.example", "<p>" + "long word " * 30000)]
    got = html_text.extract(_pages(spark, rows)).collect()
    assert sorted((str(r.page_id), r.text[:3], r.n_chars) for r in got) == [("1", "a", 1), ("1", "a", 1), ("2", "", 0), ("3", "", 0), ("4", "lon", 299999), ("None", "b", 1)]
    assert html_text.extract(_pages(spark, rows).limit(0)).count() == 0


def test_few_different_pages_and_heavy_templates(spark):
    notice = "This long notice stands on all pages of the host and tells how to write to us. " * 2
    body = "<html><body><article><h2>Daily</h2>{}<p>" + notice + "</p></article></body></html>"
    own = {i: [H.prose(f"{i}:{j}", 9) for j in range(1 + i % 3)] for i in range(4)} | {i: [H.prose(i, 8)] for i in range(10, 22)} | {i: [H.prose(i, 60)] for i in (30, 31)}
    host = {i: "few" if i < 10 else "heavy" if i < 30 else "two" for i in own}
    near = [(40 + i, "http://near.example/", body.format(f"<p>{H.prose('near', 40)} {i}</p>")) for i in range(4)]
    rows = [(i, f"http://{host[i]}.example/{i}", body.format("".join(f"<p>{t}</p>" for t in texts))) for i, texts in own.items()]
    got = {r.page_id: r for r in html_text.extract(_pages(spark, rows + near + rows[:2])).collect()}
    assert {i: got[i].text for i in own} == {i: " ".join(texts) for i, texts in own.items()}
    assert all(got[i].n_template == 2 for i in own)
    assert all(got[i].n_template == 0 for i in range(40, 44))


@pytest.mark.parametrize("odd", [None, "", "<html><body><h1>404 Not found</h1></body></html>"])
def test_odd_first_page_and_deviating_page(spark, odd):
    body = "<html><body><article><h2>Daily</h2>{}<p>Write to us in {}.</p></article></body></html>"
    own = {i: [H.prose(f"{i}:{j}", 40) for j in range(1 + i % 3)] for i in range(1, 31)}
    rows = [(0, "http://a.example/", odd), (99, "http://a.example/", odd)]
    rows += [(i, f"http://a.example/{i}", body.format("".join(f"<p>{t}</p>" for t in texts), 2024 if i == 7 else 2023)) for i, texts in own.items()]
    got = {r.page_id: r for r in html_text.extract(_pages(spark, rows)).collect()}
    assert {i: got[i].text for i in own} == {i: " ".join(texts) + " Write to us in 2024." * (i == 7) for i, texts in own.items()}
    assert [got[i].n_template for i in (0, 7, 8, 99)] == [0, 1, 2, 0]


@pytest.mark.parametrize("wrapper", ['class="layout has-sidebar"', 'class="elementor-widget"', 'class="widget"', 'id="banner" class="promo"'])
def test_articles_keep_wrappers_anchors_and_formulas(wrapper):
    article = '<article><h2 id="related-work">Related work</h2><h2 id="search">Search</h2><p id="ad-hoc">Ad hoc <span id="share">part</span> <math><mi>x</mi></math></p><div class="ad">Buy</div><div id="share-box">Share</div></article>'
    want = "Related work Search Ad hoc part x"
    for around in (f"<div {wrapper}>{article}</div>", f"<div {wrapper}><div class=widgets>{article}</div></div><p>Below</p>"):
        page = f'<body><div class="sidebar">More</div>{around}<div class="comments"><article>Me too</article></div></body>'
        assert " ".join(html_text.parse(page)[1]) == want
    beside = f'<body>{article}<div class="widget"><article>Teaser</article></div></body>'
    assert " ".join(html_text.parse(beside)[1]) == want


def test_a_headline_that_two_of_three_pages_share_stays(spark):
    """Headline and lead of an article are never template; other texts of few pages go only if all pages have them."""
    head = "The news of today. Read on."
    body = "<html><body><nav>menu</nav><article><h1>{0}</h1><p><b>{0}</b><br><p>{1}</p><p>Share of two.</p></article></body></html>"
    rows = [(i, f"http://a.example/{i}", body.format(head if i < 2 else "Another one", H.prose(i, 60))) for i in range(2)]
    rows.append((2, "http://a.example/2", body.format("Another one", H.prose(2, 60)).replace("<p>Share of two.</p>", "")))
    rows += [(10 + i, f"http://b.example/{i}", body.format(head, H.prose(10 + i, 60))) for i in range(12)]
    got = {r.page_id: r.text for r in html_text.extract(_pages(spark, rows)).collect()}
    for i in range(2):
        assert got[i] == f"{head} {head} {H.prose(i, 60)} Share of two."
    assert got[2] == f"Another one Another one {H.prose(2, 60)}"
    for i in range(12):  # on every page: the note is template, the headline is not
        assert got[10 + i] == f"{head} {head} {H.prose(10 + i, 60)}"


def test_unmarked_wrappers_are_told_by_place(spark):
    """Article, menu, advert and footer as plain ``div`` of varying words, on pages of the tables."""
    import re

    def renamed(source):
        source = re.sub(r"<(/?)(article|nav|footer|aside|main|header)\b", r"<\1div", source or "")
        return re.sub(r'class="[^"]*"', 'class="zz"', source)

    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("page_id", "url", "html").limit(600).collect()
    marked = {r.page_id: " ".join(html_text.parse(r.html or "")[1]) for r in pages}
    got = {r.page_id: r.text for r in html_text.extract(_pages(spark, [(r.page_id, r.url, renamed(r.html)) for r in pages])).collect()}
    right = sum(got[i] == marked[i] for i in marked)
    assert right >= 0.9 * len(marked), (right, len(marked))


def test_article_text_of_the_tables_is_whole(spark):
    """No block of an article is taken for template on any page of the tables."""
    for sf in ("0.001", "0.01"):
        pages = spark.read.parquet(f"/root/testdata/sf{sf}/pages.parquet")
        want = {r.page_id: " ".join(html_text.parse(r.html or "")[1]) for r in pages.collect()}
        assert {r.page_id: r.text for r in html_text.extract(pages).collect()} == want


@pytest.mark.parametrize("piece", ["<a ", "<div>", "<div></p>", "<b><i>", "<div class=ad>", "<li><div>", "<p a='", '<p a="x', "<!-- ", "<script>", "<p>x<div>y", "<article class=ad>", "</div>"])
def test_hostile_pages_take_linear_time(piece):
    import time

    def took(n):
        began = time.process_time()
        root, _ = html_text.parse((piece * (n // len(piece)))[:n] + "</p>" * (n // 40))
        html_text.matching(root, html_text.parse("<div><p>a</p></div>" * 50)[0])
        return time.process_time() - began

    took(10_000)
    assert took(1_000_000) < 12


def test_quotes_outside_values_and_open_ends():
    assert html_text.parse("<p title=don't>Hello it's me</p>")[1] == ["Hello it's me"]
    assert html_text.parse('<p title="a > b" x=\'c > d\'>in</p>out')[1] == ["in", "out"]
    assert html_text.parse("<p>a</p>b <!-- never closed <p>c</p>")[1] == ["a", "b"]
    assert html_text.parse("<p>1 < 2</p>x <script> y")[1] == ["1 < 2", "x"]
    assert html_text.parse("<p>a</p>tail <a href=x")[1] == ["a", "tail"]
    deep = "<div>" * 3000 + "in" + "</div>" * 3000 + "<p>out</p>"
    a, b = html_text.parse(deep), html_text.parse(deep.replace("in", "<p>in</p>"))
    assert a[1] == b[1] == ["in", "out"]
    html_text.matching(a[0], b[0])


def test_long_lists_are_aligned_as_short_ones(monkeypatch):
    """the way that long lists take gives the pairs of the whole table, ties included."""
    rng = random.Random(3)
    item = lambda depth: "<p>x</p>" if depth == 0 or rng.random() < 0.3 else f"<{(t := rng.choice(['div', 'ul']))}>" + "".join(item(depth - 1) for _ in range(rng.randrange(4))) + f"</{t}>"
    for _ in range(60):
        a, b = (html_text.parse("".join(item(3) for _ in range(rng.randrange(1, 30))))[0] for _ in range(2))
        places = []
        for most in (1 << 21, 0, 40):
            monkeypatch.setattr(html_text, "MOST_PAIRS", most)
            monkeypatch.setattr(html_text, "MOST_WEIGHTS", 1 << 20 if most else 3)
            places.append([(x.place, y.place) for x, y in html_text.matching(a, b)])
        assert places[0] == places[1] == places[2]


def test_long_lists_are_aligned_beyond_the_next_64_children():
    """what lies behind a hundred other blocks is found."""
    rows = "<div><p>a</p></div>" * 1500 + "<h2>t</h2>"
    a = html_text.parse(f"<dl><dt>q</dt></dl>{rows}<ol><li>x</li></ol>")[0]
    b = html_text.parse(f"{'<pre>c</pre>' * 100}{rows}<ul><li>y</li></ul>")[0]
    labels = Counter(x.label for x, _ in html_text.matching(a, b))
    assert labels["div"] == 1500 and labels["p"] == 1500 and labels["h2"] == 1
