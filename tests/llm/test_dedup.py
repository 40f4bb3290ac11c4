"""Near-dedup and substring dedup against brute force."""

import hashlib
import random

import pytest

from clickweave.llm import near_dedup, substring_dedup
from tests.llm import helpers as H


def _family(seed, n, length=90, edits=12):
    """Near copies with chains: neighbours are alike, ends are not."""
    rng = random.Random(seed)
    base = H.prose(seed, length).split()
    out = []
    for i in range(n):
        w = list(base)
        for j in rng.sample(range(length), rng.randint(0, edits // 3)):
            w[j] = f"x{i}{j}"
        out.append(" ".join(w))
        if rng.random() < 0.4:
            base = out[-1].split()
    return out


@pytest.fixture(scope="module")
def rows():
    texts = [t for s in range(6) for t in _family(f"f{s}", 14)] + [H.prose(f"p{i}", 30 + i) for i in range(20)]
    rng = random.Random(3)
    passage = H.prose("passage", 64)
    texts += [f"{H.prose(f'q{i}', 40)} {passage} {H.prose(f'r{i}', 30)}" for i in range(12)]
    rng.shuffle(texts)
    return [(3 * i + 1, t, "en", "s") for i, t in enumerate(texts)] + H.odd_rows()[:-2][1:]


@pytest.mark.parametrize("percent", [80, 85])
def test_components_equal_brute_force(spark, rows, percent):
    by_id = {}
    for r in rows:
        by_id.setdefault(r[0], r)
    rows = list(by_id.values())
    want = H.components(rows, percent)
    got = near_dedup.near_duplicates(H.documents(spark, rows), threshold=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got) and len(got) == len(rows)


def test_blocks_find_links_between_members_that_the_pivot_misses(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)
    texts = _family("chain", 60, length=80, edits=24)
    rows = [(i, t, "en", "s") for i, t in enumerate(texts)]
    got = near_dedup.near_duplicates(H.documents(spark, rows), threshold=85, bands=40).collect()
    assert {r.doc_id: r.component_id for r in got} == {i: c for i, (_, c) in H.components(rows, 85).items()}


def test_near_dedup_odd_rows(spark):
    rows = H.odd_rows()
    got = near_dedup.near_duplicates(H.documents(spark, rows), threshold=80).collect()
    assert len(got) == len(rows)
    found = {r.doc_id: r for r in got if r.doc_id is not None}
    assert found[2].component_id == found[3].component_id == 1
    assert found[7].component_id == found[8].component_id == 7 and found[7].n_shingles == 1
    assert all(found[i].component_id == i and found[i].kept and found[i].n_shingles == 0 for i in (4, 5, 6))
    assert all(r.kept and r.component_id is None for r in got if r.doc_id is None)
    docs = H.documents(spark, rows)
    kept = near_dedup.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 7, 9, 10, 11, 12] and ids.count(None) == 2


def test_one_of_repeated_rows_stays(spark):
    docs = H.documents(spark, [(1, "a b c", "en", "s"), (1, "a b c", "en", "s"), (2, "d e f", "en", "s")])
    assert sorted(r.doc_id for r in near_dedup.without_near_duplicates(docs).collect()) == [1, 2]


def test_removed_words_equal_brute_force(spark, rows):
    rows = rows + [(500, H.prose("passage", 64), "en", "s"), (501, "w " * 200, "en", "s"), (502, "w " * 130, "en", "s"), (None, H.prose("passage", 64), None, None)]
    got = substring_dedup.repeat_verdicts(H.documents(spark, rows))
    want = sorted((str(i), n, n - len(k), hashlib.sha256(b" ".join(k)).hexdigest()) for i, n, k in H.without_repeats(rows))
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()) == want


def test_texts_lose_the_same_words(spark, rows):
    docs = H.documents(spark, rows + H.odd_rows())
    out = substring_dedup.without_repeats(docs)
    assert out.columns == docs.columns
    want = sorted((str(i), b" ".join(k)) for i, _, k in H.without_repeats(rows + H.odd_rows()))
    got = out.collect()
    assert sorted((str(r.doc_id), b" ".join(H.words(r.text))) for r in got) == want
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in got)


def test_kept_text_is_not_reformatted(spark):
    passage = H.prose("x", 50)
    docs = H.documents(spark, [(1, passage, "en", "s"), (2, f"a\n\n b\t{passage}  c\n", "en", "s")])
    assert {r.doc_id: r.text for r in substring_dedup.without_repeats(docs).collect()} == {1: passage, 2: "a\n\n b\tc\n"}


def test_levels_double_until_nothing_survives(spark):
    a, b = H.prose("a", 230), H.prose("b", 60)
    docs = H.documents(spark, [(1, a + " 1", "en", "s"), (2, "2 " + a, "en", "s"), (3, b + " 3", "en", "s"), (4, "4 " + b, "en", "s"), (5, H.prose("c", 300), "en", "s")])
    got = {r.doc_id: r.length for r in substring_dedup.repeat_levels(docs).collect()}
    assert got == {1: 200, 2: 200, 3: 50, 4: 50}


@pytest.mark.parametrize("window", [7, 10])
def test_other_window_lengths(spark, window):
    rng = random.Random(window)
    rows = [(i, " ".join(rng.choice("ab") for _ in range(rng.randint(0, 60))), "en", "s") for i in range(40)]
    got = substring_dedup.repeat_verdicts(H.documents(spark, rows), window)
    assert sorted((r.doc_id, r.n_words - r.n_removed) for r in got.collect()) == sorted((i, len(k)) for i, _, k in H.without_repeats(rows, window))


def test_empty_tables(spark):
    empty = H.documents(spark, H.odd_rows()).limit(0)
    assert near_dedup.near_duplicates(empty).count() == 0 and near_dedup.without_near_duplicates(empty).count() == 0
    assert substring_dedup.repeat_verdicts(empty).count() == 0 and substring_dedup.without_repeats(empty).count() == 0
    assert substring_dedup.repeat_levels(empty).count() == 0


def test_bands_follow_from_the_threshold():
    for percent in (50, 70, 80, 85, 90, 100):
        assert (1 - (percent / 100) ** 5) ** near_dedup.bands_for(percent) < 1e-6
    assert [near_dedup.bands_for(p) for p in (85, 80)] == [24, 35]


def test_a_doc_id_with_several_texts_links_them(spark):
    one, two, three = (H.prose(f"several{i}", 50) for i in range(3))
    rows = [(1, one), (2, one), (2, two), (3, two), (4, three), (5, three), (5, ""), (6, H.prose("alone", 40)), (7, ""), (7, "")]
    got = near_dedup.near_duplicates(H.documents(spark, rows), threshold=80).collect()
    want = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 7}
    assert sorted((r.doc_id, r.component_id, r.kept) for r in got) == sorted((i, want[i], i == want[i]) for i, _ in rows)
    kept = near_dedup.without_near_duplicates(H.documents(spark, rows)).collect()
    assert sorted(r.doc_id for r in kept) == [1, 4, 6, 7]
