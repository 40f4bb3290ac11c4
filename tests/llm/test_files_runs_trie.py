"""Token files, periodic runs and the prefix trie."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickweave.llm import periodic, prefix_trie, queries, token_files
from clickweave.llm.tokens import default_vocabulary
from clickweave.llm.words import WordHashes
from tests.llm import helpers as H

# ------------------------------------------------------------------ token files


@pytest.mark.parametrize("bits,top", [(1, 1 << 16), (2, 1 << 16), (2, 1 << 32)])
def test_code_round_trip(bits, top):
    rng = np.random.default_rng(bits)
    code = token_files.Code(bits)
    for n in (0, 1, 7, 8, 9, 1000):
        ranks = (top ** rng.random(n)).astype(np.int64).clip(0, top - 1).astype(np.uint32)
        control, data = code.encode(ranks)
        assert len(control) == -(-n // code.per)
        assert len(data) == sum(max(1, (int(r).bit_length() + 7) // 8) for r in ranks)
        assert (code.decode(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), n) == ranks).all()


def test_blocks_never_hold_their_mark_and_show_damage():
    codes = {b: token_files.Code(b) for b in (1, 2)}
    ranks = np.arange(300, dtype=np.uint32) % 7
    for mark in (b"\x00\x01", b"\x05\x06", b"\x03", token_files.MARK.encode()):
        block = token_files.pack_block([b"12", None, b"", "é\n".encode()], np.array([100, 0, 199, 1]), ranks, 5, codes[1], mark)
        assert mark not in block[6:]
        names, lengths, back, before = token_files.unpack_block(block, codes)
        assert names == [b"12", None, b"", "é\n".encode()] and lengths.tolist() == [100, 0, 199, 1] and before == 5 and (back == ranks).all()
    assert not any(token_files.MARK.startswith(token_files.MARK[i:]) for i in range(1, len(token_files.MARK)))
    for cut in (block[:-1], block + b"x"):
        with pytest.raises(ValueError, match="cut"):
            token_files.unpack_block(cut, codes)
    with pytest.raises(ValueError, match="not a block"):
        token_files.unpack_block(b"abc", codes)


def test_ranks_follow_counts():
    assert token_files.ranked([(5, 2), (1, 9), (3, 2)], 6).tolist() == [1, 3, 5, 0, 2, 4]


def _ids(text, slow=Tokenizer.from_file(default_vocabulary())):
    return slow.encode(text or "", add_special_tokens=False).ids + [0]


def test_token_files_equal_the_tokenizer(spark, scratch):
    rng = random.Random(3)
    rows = [(1000 - i, H.prose(i, rng.choice([0, 3, 50, 700])), "en", "s") for i in range(120)] + H.odd_rows()
    rows += [(50, "a <|endoftext|> b !", "en", "s"), (51, "日本語 text\0frvb-block-end\n", "en", "s")]
    docs = H.documents(spark, rows).repartition(5)
    token_files.write(docs, f"{scratch}/files", file_ids=4000, block_ids=500)
    assert len([x for x in __import__("os").listdir(f"{scratch}/files/tokens") if x.startswith("part")]) > 3
    got = token_files.read(spark, f"{scratch}/files", with_ids=True).collect()
    want = Counter((i, tuple(_ids(t))) for i, t, *_ in rows)
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    got.sort(key=lambda r: r.start)
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    order = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert order == sorted(order)
    # small splits read the same rows
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        assert sorted(map(str, token_files.read(spark, f"{scratch}/files", with_ids=True).collect())) == sorted(map(str, got))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_token_files_of_an_empty_table_and_of_string_ids(spark, scratch):
    docs = H.documents(spark, H.odd_rows())
    assert token_files.token_files(docs.limit(0), f"{scratch}/none").count() == 0
    named = docs.withColumn("doc_id", F.concat(F.lit("d\n"), F.col("doc_id").cast("string")))
    got = token_files.token_files(named, f"{scratch}/named")
    assert Counter(r.doc_id for r in got.collect()) == Counter(r.doc_id for r in named.collect())


# ---------------------------------------------------------------- periodic runs


def brute_runs(words, min_length=6, times=4):
    """Every run (start, length, period), by definition."""
    n, found = len(words), {}
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words])
    for q in range(1, n // times + 1):
        same = np.concatenate([[False], ids[:-q] == ids[q:], [False]])
        for i, j in np.flatnonzero(np.diff(same)).reshape(-1, 2).tolist():
            length = j - i + q
            if length >= max(min_length, times * q):
                found.setdefault((i, length), q)  # the smallest period comes first
    return sorted((a, length, q) for (a, length), q in found.items())


def brute_digest(doc_id, words):
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    gone = {k for a, n, q in runs for k in range(a + q, a + n)}
    lines = "".join(f"{a},{n},{q}\n" for a, n, q in sorted(runs, key=lambda r: (r[0], r[2])))
    kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
    milli = 1000 * best[1] // best[2] if runs else None
    return doc_id, len(runs), *best, milli, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest()


def _texts():
    rng = random.Random(11)
    out = []
    for _ in range(60):
        out.append([rng.choice("ab") for _ in range(rng.randint(0, 120))])
        n = rng.randint(1, 300)
        words = [f"w{rng.randrange(40)}" for _ in range(n)]
        for _ in range(3):
            a, p = rng.randrange(n), rng.randint(1, 30)
            for i in range(a, min(n, a + p * rng.randint(2, 7) + rng.randrange(p))):
                words[i] = words[a + (i - a) % p]
        out.append(words)
    out += [["x"] * 5, ["x"] * 6, ["x"] * 500, ["x", "y"] * 4, ["x", "y"] * 250, (["x"] * 7 + ["y"]) * 12, []]
    return out


@pytest.mark.parametrize("min_length,times", [(6, 4), (1, 3), (12, 5)])
def test_solver_equals_brute_force(min_length, times):
    solver, hashes = periodic.Solver(min_length, times), WordHashes()
    for words in _texts():
        found = solver(hashes.of([w.encode() for w in words]), 1, 1 << 20)
        assert sorted((a, b - a + q, q) for q, a, b in found) == brute_runs(words, min_length, times), words


def test_tiles_cover_every_place_and_period():
    for n in (0, 5, 16, 17, 40, 100, 1000):
        tiles = periodic.tiling(n, 8, 4)
        for q in range(1, n // 4 + 1):
            mine = [(a, b) for a, b, low, high in tiles if low <= q < high]
            assert mine and mine[0][0] == 0 and mine[-1][1] == n
            assert all(c <= b - 4 * q or b == n for (_, b), (c, _) in zip(mine, mine[1:]))
    with pytest.raises(ValueError, match="three times"):
        periodic.Solver(6, 2)


def test_runs_of_tiled_documents_equal_brute_force(spark):
    texts = _texts()
    rng = random.Random(4)
    tail = [f"w{i}" for i in range(90)]
    texts.append([f"v{rng.randrange(9)}" for _ in range(300)] + tail * 5 + tail[:17] + ["end"])
    rows = [(i % 50, " \n".join(w), "en", "s") for i, w in enumerate(texts)] + H.odd_rows()
    docs = H.documents(spark, rows)
    want = Counter()
    for i, t, *_ in rows:
        want.update({(i, *r) for r in brute_runs(H.words(t))})
    for tile in (8, 32, 4096):
        by_text = Counter()
        for r in periodic.periodic_runs(docs, tile=tile).collect():
            by_text[r.doc_id, r.row, r.start, r.length, r.period] += 1
        assert set(by_text.values()) <= {1}
        assert {(i, a, n, q) for i, _, a, n, q in by_text} == set(want)
    got = Counter(tuple(r) for r in periodic.run_digests(docs, tile=16).collect())
    expected = Counter(brute_digest(i, H.words(t)) for i, t, *_ in rows)
    assert got == expected
    assert periodic.run_digests(docs.limit(0)).count() == 0


def test_long_and_hostile_texts_are_solved_in_time():
    import time

    solver, hashes = periodic.Solver(), WordHashes()
    began = time.time()
    same = hashes.of([b"x"] * 200_000)
    assert solver(same, 1, 1 << 20) == [(1, 0, 199_999)]
    rng = random.Random(1)
    two = hashes.of([rng.choice((b"x", b"y")) for _ in range(100_000)])
    solver(two, 1, 1 << 20)
    assert time.time() - began < 30


def _planted(doc_id, text):
    words = H.words(text)
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = (h // 10) % n
    p = 1 + (n - a) // (3 + (h // 10) % 8)
    return [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]


def _folder(spark, scratch):
    """Documents of sf0.001 and odd rows."""
    some = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = H.documents(spark, H.odd_rows()).select(*some.columns)
    some.unionByName(odd).write.parquet(f"{scratch}/documents.parquet")
    return spark.read.parquet(f"{scratch}/documents.parquet").collect()


def test_queries_equal_brute_force(spark, scratch):
    rows = _folder(spark, scratch)
    got = Counter(tuple(r) for r in queries.op12_periodic_runs(spark, scratch).collect())
    assert got == Counter(brute_digest(r.doc_id, _planted(r.doc_id, r.text)) for r in rows)
    assert sum(n for x, n in got.items() if x[1]) > len(rows) // 20
    found = sorted((tuple(r) for r in queries.op11_token_files(spark, scratch).collect()), key=lambda r: r[1])
    at, want = 0, Counter()
    for r in rows:
        ids = _ids(r.text)
        want[r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((i, n, crc) for i, _, n, crc in found) == want
    for _, start, n, _ in found:
        assert start == at
        at += n
    keys = [(i is not None, i or 0) for i, *_ in found]
    assert keys == sorted(keys)


# ------------------------------------------------------------------ prefix trie


def brute_trie(turns_of):
    """Counter of result rows for ``{conv_id: [(role, text)]}``."""
    members, ended = defaultdict(list), defaultdict(list)
    for c, turns in turns_of.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ended[tuple(turns)].append(c)
    key = lambda c: (c is not None, c or 0)
    least = {p: min((c for c in m if c is not None), default=None) for p, m in members.items()}
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(H.words(p[-1][1])) if p else 0
    out = Counter()
    for p, m in members.items():
        ends = ",".join("" if c is None else str(c) for c in sorted(ended[p], key=key))
        out[least[p], len(p), least[p[:-1]] if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def _conversations(spark, rows):
    full = [(*r, "k", 1, 2, "w") for r in rows]
    return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, kind string, depth int, words int, turns string")


def _talk():
    rng = random.Random(6)
    rows = []
    for c in range(200):
        for t in range(rng.choice([1, 2, 3, 5, 8])):
            rows.append((c * 3, t, "user" if t % 2 == 0 else "assistant", "hello there" if rng.random() < 0.7 else f"turn {rng.randrange(6)} of it"))
    rows += [(5000 + i, t, "user", "the same again") for i in range(60) for t in range(4)]  # a conversation that many share
    rows += [(7000, t, "user", f"long {t % 5}") for t in range(900)] + [(7001, t, "user", f"long {t % 5}") for t in range(850)]
    rows += [(8000, None, None, None), (8000, 0, "", ""), (8001, None, "", ""), (None, 0, "user", "hello there"), (None, 1, "x", None)]
    return rows


def _by_conversation(rows):
    out = defaultdict(list)
    for c, t, role, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0)):
        out[c].append((role or "", text or ""))
    return out


@pytest.mark.parametrize("shard,cells", [(1 << 22, 1 << 22), (400, 64), (120, 1)])
def test_trie_equals_brute_force(spark, shard, cells):
    rows = _talk()
    random.Random(2).shuffle(rows)
    got = prefix_trie.prefix_trie(prefix_trie.sequences(_conversations(spark, rows)), shard, cells)
    assert Counter(tuple(r) for r in got.collect()) == brute_trie(_by_conversation(rows))


def test_trie_of_few_and_of_turnless_conversations(spark):
    rows = prefix_trie.sequences(_conversations(spark, _talk()))
    assert prefix_trie.prefix_trie(rows.limit(0)).count() == 0
    bare = rows.select("conv_id", F.slice("turns", 1, 0).alias("turns"))
    got = prefix_trie.prefix_trie(bare, 60, 4).collect()
    assert Counter(tuple(r) for r in got) == brute_trie({r.conv_id: [] for r in bare.collect()})


def test_shared_heads(spark):
    rows = [r for r in _talk() if r[0] != 0]
    own = _by_conversation(rows)
    want = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if c is not None else 0
        base = own.get(c - c % 20, []) if c is not None else []
        want[c] = base[:h] + turns[h:]
    assert any(not t for t in want.values())
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    made = prefix_trie.with_shared_heads(prefix_trie.sequences(_conversations(spark, rows)), head, 20)
    assert {r.conv_id: len(r.turns) for r in made.collect()} == {c: len(t) for c, t in want.items()}
    assert Counter(tuple(r) for r in prefix_trie.prefix_trie(made, 100, 500).collect()) == brute_trie(want)
