"""The join of buckets that hold several components: which rows meet, and what a pair costs."""

from __future__ import annotations

import random
import re

import numpy as np

from gapwise.llm import near_text
from gapwise.scratch import Scratch
from tests.llm import brute

CLASSES = "id long, n_shingles long, set_a long, set_b long, signature binary"


def test_only_rows_beside_the_main_component_meet_all_rows(spark):
    rows = [(1, 0, i, 10) for i in range(10, 15)] + [(1, 0, 20, 20), (1, 0, 21, 20), (1, 0, 30, 30)]
    rows += [(2, 7, 10, 10), (2, 7, 11, 10)]
    rows += [(3, 9, 10, 10), (3, 9, 40, 40)]
    got = near_text._open_rows(spark.createDataFrame(rows, "key long, slot int, id long, component long")).collect()
    assert sorted(tuple(r)[:4] for r in got) == sorted(r for r in rows if r[0] != 2)
    assert {r["id"] for r in got if r["key"] == 1 and r["beside"]} == {20, 21, 30}
    assert sum(r["beside"] for r in got if r["key"] == 3) == 1


def test_the_join_is_short_enough_to_be_compiled(spark):
    """The JVM leaves methods of 8,000 bytes and more to its interpreter."""
    scratch = Scratch(spark)
    rows, _ = scratch.write(spark.createDataFrame([], "key long, slot int, id long, component long, beside boolean"))
    sets, _ = scratch.write(spark.createDataFrame([], "id long, items array<long>, odd array<long>"))
    classes, _ = scratch.write(spark.createDataFrame([], CLASSES))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        met = near_text._met_across(rows, sets, classes, 10, 7, 1, 27, 80)
        code = spark._jvm.PythonSQLUtils.explainString(met._jdf.queryExecution(), "codegen")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", code)]
    assert sizes and max(sizes) < 8000


def test_parities_differ_in_no_more_places_than_sets_differ_in_items():
    draw = np.random.default_rng(1)
    for size, own in ((1, 0), (1, 1), (400, 0), (400, 60), (5000, 1000)):
        items = draw.integers(0, 1 << 64, size + 2 * own, dtype=np.uint64)
        a, b = near_text.parities(items[: size + own]), near_text.parities(np.r_[items[:size], items[size + own :]])
        unlike = sum(int(x).bit_count() for x in (a ^ b).view(np.uint64))
        assert len(a) == near_text.PARITY_BITS // 64 and unlike <= 2 * own and unlike % 2 == 0
        assert unlike > own or not own or own > 100


def test_a_large_component_beside_texts_that_are_nearly_linked(spark):
    """Edits of one text at several distances, so that buckets hold a large component, links across and near misses."""
    draw = random.Random(7)
    words = [f"w{k}" for k in range(400)]
    base = [draw.choice(words) for _ in range(150)]
    texts = []
    for edits in [1] * 40 + [7] * 30 + [8, 9, 10, 11, 12] * 8 + [16, 20] * 10:
        text = list(base)
        for at in draw.sample(range(len(base)), edits):
            text[at] = draw.choice(words)
        texts.append((draw.randrange(10**6), " ".join(text)))
    texts = sorted(dict(texts).items())
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    got = near_text.near_duplicates(docs, shingle=2).collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted(brute.near_text(texts, 2))
    assert len({r["component_id"] for r in got}) > 5


def test_pairs_met_across_are_those_of_all_pairs(spark):
    """Every pair of one bucket and two components with similar sets comes out once, also of two rows beside the main component."""
    draw = np.random.default_rng(3)
    base = draw.integers(0, 1 << 63, 300, dtype=np.uint64)
    sets = {i: np.unique(np.r_[base[: 300 - 3 * i], draw.integers(0, 1 << 63, 3 * i, dtype=np.uint64)]) for i in range(12)}
    component = {i: max(0, i - 5) for i in sets}
    rows = [(5, 0, i, component[i], component[i] != 0) for i in sets]
    frames = [
        spark.createDataFrame(rows, "key long, slot int, id long, component long, beside boolean"),
        spark.createDataFrame([(i, s.view(np.int64).tolist(), near_text.parities(s).tolist()) for i, s in sets.items()], "id long, items array<long>, odd array<long>"),
        spark.createDataFrame([(i, len(s), 0, 0, bytes(70)) for i, s in sets.items()], CLASSES),
    ]
    got = near_text._met_across(*frames, 10, 7, 1, 27, 80).collect()
    want = set()
    for u in sets:
        for v in range(u):
            both = len(np.intersect1d(sets[u], sets[v]))
            if component[u] != component[v] and 100 * both >= 80 * (len(sets[u]) + len(sets[v]) - both):
                want.add((u, v))
    pairs = [(r["u"], r["v"]) for r in got]
    assert len(set(pairs)) == len(pairs) and want <= set(pairs) and any(component[v] for _, v in want)
    assert all(component[u] != component[v] and u > v for u, v in pairs)
