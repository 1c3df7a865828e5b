"""The files of narrow tables, and what is shuffled for the sets."""

from __future__ import annotations

import glob

import numpy as np
from pyspark.sql import functions as F

from gapwise import scratch as scratch_module
from gapwise.llm import near_text
from gapwise.scratch import Scratch


def test_a_narrow_table_has_few_files(spark, monkeypatch):
    monkeypatch.setattr(scratch_module, "TASKS_PER_CORE", 1)
    rows = spark.range(1000).repartition(200)
    written, path = Scratch(spark).write_narrow(rows)
    files = glob.glob(f"{path.removeprefix('file:')}/*.parquet")
    assert 0 < len(files) <= spark.sparkContext.defaultParallelism
    assert written.count() == 1000


def test_texts_are_not_shuffled_for_their_sets(spark):
    """Only ids and sets are dealt out, however many ids there are; what comes back is the sets of these ids, each once."""
    texts = spark.range(3000).select("id", F.concat_ws(" ", *[F.concat(F.lit(c), F.col("id") % 700) for c in "abcd"]).alias("text"))
    docs = texts.union(texts.filter("id < 50"))
    ids = spark.range(0, 4000, 7)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sets = near_text._sets_of(docs, ids, 2)
        plan = sets._jdf.queryExecution().executedPlan().toString()
        got = {r["id"]: sorted(r["items"]) for r in sets.collect()}
        assert sets.count() == len(got)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    below = plan[plan.index("MapInArrow") : plan.index("BroadcastExchange")]
    assert "Exchange hashpartitioning" not in below and "BroadcastHashJoin" in below
    of = {r["id"]: r["text"] for r in texts.collect()}
    assert got == {i: sorted(near_text.shingles(of[i], 2).view(np.int64).tolist()) for i in range(0, 3000, 7)}


def test_a_full_bitmap_loses_no_id(spark, monkeypatch):
    monkeypatch.setattr(near_text, "MOST_BITS", near_text.BITMAP)
    docs = spark.range(5000).select("id", F.lit("a b c").alias("text"))
    ids = spark.range(0, 5000, 2)
    assert near_text._sets_of(docs, ids, 2).count() == 2500
    assert near_text._perhaps_among(docs, ids).join(ids, "id", "left_semi").count() == 2500
