"""Brute-force versions, and rows that are odd in every way the operators must stand."""

import hashlib
import math
import re
from collections import Counter, defaultdict

DOC_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, component_id string, key string, label string, number int, row string, n_words string, epoch string, host string"
_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def words(text):
    return _WORD.findall((text or "").encode())


def prose(seed, n):
    return " ".join(hashlib.md5(f"{seed}:{i}".encode()).hexdigest()[: 3 + i % 5] for i in range(n))


def documents(spark, rows):
    """Rows of ``(doc_id, text[, lang, source])`` with columns whose names clash with results and working columns."""
    full = []
    for doc_id, text, *more in rows:
        lang, source = [*more, None, None][:2]
        full.append((doc_id, text, lang, source, None if text is None else len(text), "k", "c", "x", "y", 7, "r", "w", "e", "h"))
    return spark.createDataFrame(full, DOC_SCHEMA)


def odd_rows():
    base = prose("a", 120)
    edited = " ".join(base.split()[:-3]) + " one two three"
    return [
        (1, base, "en", "s1"),
        (2, base, "en", "s1"),
        (2, base, "en", "s1"),  # a repeated row
        (3, edited, "en", "s2"),
        (4, None, "fr", "s1"),
        (5, "", "fr", None),
        (6, " \t\n\x0b\x0c\r ", None, "s2"),
        (7, "one", "en", "s2"),
        (8, "ONE", "en", "s2"),
        (9, prose("long", 4000), "en", "s1"),
        (10, prose("b", 60) + "\n" + prose("a", 70) + "\n" + prose("b", 60), "de", "s3"),
        (11, "é ü " * 40, "fr", "s3"),
        (12, "same same same " * 30, "en", "s3"),
        (None, prose("c", 80), "en", None),
        (None, base, None, "s1"),
    ]


def shingle_set(text, k=5):
    w = [x.lower() for x in words(text)]
    if not w:
        return frozenset()
    k = min(k, len(w))
    return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))


def components(rows, percent):
    """``{doc_id: (n_shingles, component)}`` of rows with ids."""
    sets = {i: shingle_set(t) for i, t, *_ in rows if i is not None}
    root = {i: i for i in sets}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1 :]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = sorted((top(a), top(b)))
                root[q] = p
    return {i: (len(sets[i]), top(i)) for i in ids}


def without_repeats(rows, window=50):
    """``[(doc_id, n_words, kept words)]`` in the order of the rows."""
    first = {}
    for doc_id, text, *_ in rows:
        w = words(text)
        for i in range(len(w) - window + 1):
            k = tuple(w[i : i + window])
            if doc_id is not None:
                first[k] = min(first.get(k, doc_id), doc_id)
    out = []
    for doc_id, text, *_ in rows:
        w = words(text)
        gone = set()
        for i in range(len(w) - window + 1):
            if doc_id is not None and first[tuple(w[i : i + window])] < doc_id:
                gone.update(range(i, i + window))
        out.append((doc_id, len(w), [x for i, x in enumerate(w) if i not in gone]))
    return out


def quality(text, min_words=50, max_repeat=50):
    w = words(text)
    raw = text or ""
    lines = [x for x in raw.split("\n") if words(x)]
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    again = {j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    failed = len(w) < min_words or 100 * len(again) > max_repeat * len(w)
    return len(w), sum(len(x.decode()) for x in w), sum(raw.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(again), failed


def host_verdicts(rows, limit=0.5):
    """Hosts whose shrunk failure rate is above the limit."""
    n, f = Counter(), Counter()
    for _, text, _, source in rows:
        n[source] += 1
        f[source] += quality(text)[-1]
    mean = sum(f.values()) / sum(n.values())
    rates = [f[h] / n[h] for h in n]
    centre = sum(rates) / len(rates)
    spread = sum((r - centre) ** 2 for r in rates) / (len(rates) - 1) if len(rates) > 1 else 0
    weight = max(1.0, mean * (1 - mean) / spread - 1) if spread > 0 else sum(n.values())
    return {h for h in n if (f[h] + mean * weight) / (n[h] + weight) > limit}


def mix(rows, limit, seed=17):
    """Counter of ``(doc_id, epoch)`` shown, by exact bisection of the exponent."""
    tokens = [(i, s, len(words(t))) for i, t, _, s in rows]
    total = defaultdict(int)
    for _, s, n in tokens:
        total[s] += n
    some = {s: n for s, n in total.items() if n}
    if not some:
        return Counter({(i, 0): c for i, c in Counter(i for i, *_ in tokens).items()})
    low, high = 0.0, 1.0
    most, least = max(some.values()), min(some.values())
    if (least / most) ** -1.0 <= limit:
        high = 0.0
    for _ in range(200):
        middle = (low + high) / 2
        if (least / most) ** (middle - 1) <= limit:
            high = middle
        else:
            low = middle
    out = Counter()
    for s, n in total.items():
        mine = [(i, t) for i, x, t in tokens if x == s]
        if not n:
            out.update((i, 0) for i, _ in mine)
            continue
        target = math.floor(round(n * (n / most) ** (high - 1), 3))
        whole = target // n
        out.update((i, e) for i, _ in mine for e in range(whole))
        rest = target - whole * n
        if not rest:
            continue
        # as concat_ws: a null id is left out of the key
        key = lambda i: hashlib.md5(":".join([str(seed), str(whole)] + ([] if i is None else [str(i)])).encode()).hexdigest()  # noqa: B023, E731
        upto = 0
        by_key = defaultdict(list)
        for i, t in mine:
            by_key[key(i)].append((i, t))
        for k in sorted(by_key):
            upto += sum(t for _, t in by_key[k])
            if upto > rest:
                break
            out.update((i, whole) for i, _ in by_key[k])
    return out
