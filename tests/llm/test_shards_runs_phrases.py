"""Sharding, periodic runs and phrases on small fixtures, against plain versions."""

import random
import zlib
from bisect import bisect_right
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from gapwise.llm import phrases, queries, runs, sharding

from .brute import LOWER, WORD

CLASHES = ("id", "key", "size", "part", "shard", "upto", "bucket", "word", "f", "n", "_text", "runs", "lines")


def crowded(df):
    """Extra columns that bear the names the operators use inside."""
    return df.withColumns({c: F.lit("x") for c in CLASHES})


# --- sharding


def plain_shards(rows, shards):
    """{text: shard}: groups in order, each first shard at the least capacity for all that is left."""
    ids = defaultdict(list)
    for i, t in rows:
        ids[t or ""].append(i)
    total = sum((len(t.encode()) + 1) * len(v) for t, v in ids.items())
    order = []
    for t, v in ids.items():
        size, known = (len(t.encode()) + 1) * len(v), [i for i in v if i is not None]
        order.append((-size if size >= max(total // shards, 1) else 0, not known, min(known, default=0), sha256(t.encode()).digest(), size, t))
    order.sort()
    upto = list(np.cumsum([0] + [o[4] for o in order]))

    def filled(start, capacity, n):
        for _ in range(n):
            start = upto[bisect_right(upto, start + capacity) - 1]
        return start

    start, cuts = 0, []
    for left in range(shards, 0, -1):
        capacity = -(-(total - start) // left)
        while filled(start, capacity, left) < total:
            capacity += 1
        start = filled(start, capacity, 1)
        cuts.append(start)
    return {o[5]: sum(u > c for c in cuts[:-1]) for o, u in zip(order, upto[1:])}


def shard_rows(seed):
    rng = random.Random(seed)
    pool = ["x" * rng.randrange(60) for _ in range(20)] + ["y" * 500]
    rows = [(k if rng.random() < 0.9 else None, rng.choice([None, "", " ", rng.choice(pool), "é" * rng.randrange(400) + str(k)])) for k in range(200)]
    if seed == 1:  # a group that fills shards alone, and rows with one id
        rows += [(10**6 + k, "hot") for k in range(4000)] + [(5, "hot")] * 300
    if seed == 2:  # fewer groups than shards
        rows = [(k, "ab"[k % 2]) for k in range(9)]
    if seed == 3:  # one very long text
        rows.append((7, "z" * 3_000_000))
    return rows


@pytest.mark.parametrize("seed, bins", [(0, 8), (1, 64), (2, 1 << 14), (3, 1 << 14)])
def test_shards(spark, monkeypatch, seed, bins):
    monkeypatch.setattr(sharding, "BINS", bins)
    rows = shard_rows(seed)
    got = sharding.place_in_shards(crowded(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).drop("id"), 8).collect()
    shard = plain_shards(rows, 8)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), shard[t or ""]) for i, t in rows)
    assert Counter(tuple(r)[:4] for r in got) == want
    for s in range(8):
        inside = sorted((r.slot, r.id is None, r.id) for r in got if r.shard == s)
        assert [r[0] for r in inside] == list(range(len(inside)))


def test_capacity_is_the_least(spark):
    """No contiguous partition of the same order has a smaller largest shard."""
    rng = random.Random(4)
    rows = [(k, "a" * rng.randrange(1, 90) + str(k)) for k in range(40)]
    sizes = [len(t) + 1 for _, t in rows]
    best = [0] + [sum(sizes[:k]) for k in range(1, 41)]
    for _ in range(4):  # one shard more: the last one starts after j
        best = [min(max(best[j], sum(sizes[j:k])) for j in range(k + 1)) for k in range(41)]
    got = sharding.place_in_shards(spark.createDataFrame(rows, "doc_id long, text string"), 5).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    assert max(r.s for r in got) == best[40]


# --- periodic runs


def plain_runs(words, least=6, times=4):
    found = {}
    for q in range(1, len(words) // times + 1):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                found.setdefault((i, j - i + q), q)  # the smallest period comes first
            i = j + 1
    found = sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))
    gone = {k for s, n, q in found for k in range(s + q, s + n)}
    return found, " ".join(w for k, w in enumerate(words) if k not in gone)


def repetitive(rng):
    words = [f"w{rng.randrange(rng.choice([1, 2, 3, 30]))}" for _ in range(rng.randrange(60))]
    for _ in range(rng.randrange(3)):
        block = [f"w{rng.randrange(5)}" for _ in range(rng.randrange(1, 8))] * rng.randrange(2, 9)
        at = rng.randrange(len(words) + 1)
        words[at:at] = block[: rng.randrange(1, len(block) + 1)]
    return rng.choice([" ", "\n", "\t  "]).join(words)


@pytest.fixture(scope="module")
def run_texts():
    rng = random.Random(6)
    rows = [(k, repetitive(rng)) for k in range(1500)]
    long = " ".join(f"v{rng.randrange(10**5)}" for _ in range(200_000)) + " la" * 9 + " do re mi" * 5  # above a slice of a megabyte
    rows += [(None, "a b " * 20), (2001, None), (2002, ""), (2003, " \n"), (2004, "one"), (2005, long), (2005, long), (-7, "na " * 7)]
    return rows + [rows[0]]


@pytest.mark.parametrize("least, times", [(6, 4), (1, 5)])
def test_runs(spark, run_texts, least, times):
    df = crowded(spark.createDataFrame(run_texts, "doc_id long, text string").repartition(3))
    got = runs.periodic_runs(df, keep=["doc_id", "size"], least=least, times=times).collect()
    want = Counter()
    for i, t in run_texts:
        words = WORD.findall(t or "")
        if i == 2005:
            found = [(200_000, 9, 1), (200_009, 15, 3)]
            collapsed = " ".join(words[:200_001] + words[200_009:200_012])
        else:
            found, collapsed = plain_runs(words, least, times)
        want[i, "x", len(words), tuple(found), collapsed] += 1
    assert Counter((r.doc_id, r.size, r.n_words, tuple(map(tuple, r.runs)), r.collapsed) for r in got) == want


def test_splitting_leaves_all_runs_whole():
    """The recursion is what finds segments: each is stable, and rare words end it."""
    rng = random.Random(8)
    for _ in range(300):
        words = np.array([rng.randrange(12) for _ in range(rng.randrange(200))], np.int32)
        pieces = list(runs.segments(words, 6, 4))
        for s, e in pieces:
            assert min(Counter(words[s:e].tolist()).values()) >= 4 and e - s >= 6
        for s, n, _ in plain_runs([str(w) for w in words])[0]:
            assert any(a <= s and s + n <= b for a, b in pieces)


def test_runs_refuse():
    with pytest.raises(ValueError):
        runs.periodic_runs(None, keep=["runs"])
    with pytest.raises(ValueError):
        runs.periodic_runs(None, keep=[], times=3)


def test_repetition_of_the_contract(spark):
    rng = random.Random(9)
    rows = [(k, " ".join(f"w{rng.randrange(50)}" for _ in range(rng.randrange(30)))) for k in range(300)] + [(None, "a b"), (30, None), (17, "")]
    got = queries.with_repetition(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    turned = 0
    for (i, t), r in zip(rows, got):
        words, h = (t or "").split(), zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
            turned += 1
        assert (r.text or "").split() == words
    assert turned > 10


# --- phrases

PIECE = dict.fromkeys(map(ord, ".,;:!?\n\x0b\x0c\r"), "\n")


def plain_phrases(rows, least, longest, covered=100, most=2000):
    counts = defaultdict(Counter)
    for lang, text in rows:
        for piece in (text or "").translate(LOWER).translate(PIECE).split("\n"):
            w = [x for x in piece.replace("\t", " ").split(" ") if x]
            for m in range(1, longest + 1):
                counts["und" if lang is None else lang].update(tuple(w[s : s + m]) for s in range(len(w) - m + 1))
    out = []
    for lang, f in counts.items():
        n = sum(v for p, v in f.items() if len(p) == 1)
        frequent = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in frequent.items():
            for m in range(2, len(p)):
                for s in range(len(p) - m + 1):
                    longer[p[s : s + m]] = max(longer[p[s : s + m]], a)
        lines = []
        for p, a in frequent.items():
            if p not in longer or 100 * longer[p] < covered * a:
                score, k = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                lines.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(lines)[:most], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


@pytest.fixture(scope="module")
def phrase_rows():
    rng = random.Random(10)
    common = ["The", "of", "Ünder", "and"] + [f"w{k}" for k in range(40)]

    def text(n):
        weights = [200 / (k + 1) for k in range(len(common))]
        words = rng.choices(common, weights, k=n)
        return "".join(w + rng.choice([" "] * 14 + ["  ", "\t", ". ", ",", "!\n", "; x y "]) for w in words)

    rows = [(rng.choice(["en", "en", "de", None, "a b"]), text(rng.randrange(1, 90))) for _ in range(300)]
    rows += [("en", "to be or not to be that is it")] * 60  # exact copies, longer than a phrase
    rows += [("en", None), ("en", ""), ("fr", " ., "), ("en", text(9_000)), (None, "q")]
    return rows


@pytest.mark.parametrize("hot_share, chunk, bucket_words", [(1024, 1_500_000, 2_000_000), (20, 1_500_000, 3_000), (8, 500, 1_000)])
def test_phrases(spark, monkeypatch, phrase_rows, hot_share, chunk, bucket_words):
    """Hot words or none, texts cut into chunks within and between documents, one bucket or many."""
    monkeypatch.setattr(phrases, "HOT_SHARE", hot_share)
    monkeypatch.setattr(phrases, "CHUNK_WORDS", chunk)
    df = crowded(spark.createDataFrame(phrase_rows, "lang string, text string").repartition(3))
    got = phrases.collocations(df, least=15, longest=5, bucket_words=bucket_words)
    assert sorted(map(tuple, got.collect())) == plain_phrases(phrase_rows, 15, 5)


@pytest.mark.parametrize("longest, covered, most", [(2, 100, 7), (4, 60, 2000)])
def test_phrase_parameters(spark, phrase_rows, longest, covered, most):
    df = spark.createDataFrame(phrase_rows, "lang string, text string")
    got = phrases.collocations(df, least=15, longest=longest, covered=covered, most=most)
    assert sorted(map(tuple, got.collect())) == plain_phrases(phrase_rows, 15, longest, covered, most)


def test_scores_beyond_64_bits(spark):
    """1000 a n is 2.4e20 here."""
    schema = "lang string, phrase string, size int, f bigint"
    found = spark.createDataFrame([("en", "a b", 2, 300_000_000)], schema)
    words = spark.createDataFrame([("en", "a", 400_000_000), ("en", "b", 300_000_000), ("en", "c", 10**8)], "lang string, word string, f bigint")
    row = phrases.scored(found, words, 100, 100, None).first()
    assert row.score == 1000 * 300_000_000 * 800_000_000 // (400_000_000 * 300_000_000)


def test_quicksort_abandons_what_is_rare():
    columns = np.array([[1, 1, 1, 2, 3], [2, 2, 0, 2, 1]])
    hot = np.zeros(4, bool)
    assert list(phrases.quicksorted(columns, np.array([5, 6, 100, 1, 2]), 10, hot, summed=False)) == [(2, 0, 11)]
    hot[1:3] = True
    assert list(phrases.quicksorted(columns, np.array([5, 6, 100, 1, 2]), 10, hot, summed=False)) == []


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert sharding.place_in_shards(empty, 8).count() == 0
    assert runs.periodic_runs(empty, keep=["doc_id"]).count() == 0
    assert phrases.collocations(empty).count() == 0
