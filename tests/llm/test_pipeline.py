"""The pipeline against brute force, stage by stage on its own."""

import random
from collections import Counter, defaultdict

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline
from clickweave.llm.tokens import default_vocabulary
from tests.llm import helpers as H


def _rows():
    rng = random.Random(8)
    rows = []
    for i in range(120):
        text = H.prose(rng.randrange(90), rng.choice([20, 70, 120, 400]))  # repeats as exact copies
        if i % 6 == 0:
            text += " " + H.prose("shared", 60)
        if i % 7 == 0:
            text = " ".join(text.split()[:-1])
        rows.append((i, text, "en", "big" if i % 3 else rng.choice(["s1", "s2"])))
    rows += [(200 + i, H.prose(f"bad{i}", 5), "en", "spam") for i in range(20)] + [(230, H.prose("good", 90), "en", "spam")]
    return rows


@pytest.fixture(scope="module")
def made(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("pipeline"))
    H.documents(spark, _rows()).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    return corpus_pipeline.run(spark, folder).collect()


def test_run_equals_brute_force(made):
    rows = _rows()
    bad = H.host_verdicts(rows)
    rows = [r for r in rows if not H.quality(r[1])[-1] and r[3] not in bad]
    classes = H.components(rows, 80)
    rows = [r for r in rows if classes[r[0]][1] == r[0]]
    kept = H.without_repeats(rows)
    cut = []
    for (i, t, lang, s), (_, n, k) in zip(rows, kept, strict=True):
        cut.append((i, t if len(k) == n else None, lang, s, b" ".join(k).decode()))
    shown = H.mix([(i, k, lang, s) for i, _, lang, s, k in cut], 2.0)
    tokenizer = Tokenizer.from_file(default_vocabulary())
    want = Counter()
    for i, t, _, _, _ in cut:
        copies = sum(c for (j, _), c in shown.items() if j == i)
        if t is not None:
            want[i] = copies * (len(tokenizer.encode(t).ids) + 1)
        else:
            want[i] = copies
    total, copies = Counter(), Counter()
    for r in made:
        total[r.doc_id] += r.length
        copies[r.doc_id] += r.piece == 0
    assert set(total) == set(want)
    for i, t, _, _, _ in cut:
        assert copies[i] == sum(c for (j, _), c in shown.items() if j == i)
        if t is not None:
            assert total[i] == want[i]
    held = defaultdict(int)
    for r in made:
        held[r.sequence_id] += r.length
    assert max(held.values()) <= 2048


def test_stages_stand_odd_rows_and_empty_tables(spark):
    docs = H.documents(spark, H.odd_rows())
    for rows in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, rows, "")
            out.collect()
            if name != "packing":
                assert out.columns == docs.columns


def test_mixing_stage_repeats_a_small_source_twice(spark):
    """a source of a third of the largest is shown twice over, not a tenth more."""
    rows = [(i, H.prose(i, 20), "en", s) for i, s in enumerate("a" * 60 + "b" * 20)]
    shown = Counter(r.source for r in corpus_pipeline.mix_sources(spark, H.documents(spark, rows), "").collect())
    assert shown == {"a": 60, "b": 40}


def test_queries_are_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {x.split("_")[0] for x in names if x.startswith("op") and x[2].isdigit()} and "pipeline" in names
    assert set(entry.oracle_sql()) <= names


@pytest.mark.parametrize("name", ["op1_chat_format", "op4_near_dedup", "op6_mixing", "op7_substring_dedup", "op10_host_quality", "op13_prefix_trie"])
def test_oracles(spark, name):
    import duckdb

    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "conversations"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    got = entry.queries()[name](spark, folder)
    want = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    assert Counter(tuple(r[c] for c in columns) for r in got.collect()) == Counter(want.fetchall())


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01", "sf0.1"])
def test_mixing_acts_on_the_tables(spark, sf):
    """The exponent is between the ends, so the weights are neither equal nor the sources' own."""
    from clickweave.llm import mixing, queries

    mix = mixing.Mix(queries.table(spark, f"/root/testdata/{sf}", "documents"), repetition_limit=queries.MIX_REPETITIONS)
    assert 0.05 < mix.exponent < 0.95
    assert len({r.weight for r in mix.sources.collect()}) > 1


def test_workers_need_no_copy_of_the_package(tmp_path):
    """Queries run from any folder: functions travel by value."""
    import os
    import subprocess
    import sys

    repo = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    code = f"""
import sys; sys.path.insert(0, {repo!r})
import __spark_entry__ as e
from clickweave.session import get_spark
spark = get_spark("local[2]", 2, extra={{"spark.checkpoint.dir": {str(tmp_path / "ck")!r}}})
q = e.queries()
print([q[n](spark, "/root/testdata/sf0.001").count() for n in sorted(q) if n.startswith("op")])
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
