"""Mixing sources to target weights, by a multivariate-hypergeometric splitting tree.

1. *Targets.* Sources get shares of all words by weight; a target above ``most`` times its
   source's size is cut there and the excess shared again by weight, until none is above.
2. *Blocks.* Each source's documents fall into blocks by hash, about ``block_docs`` each. A
   target of a full passes and a rest takes every block a times and, of one more pass, the
   documents in hash order up to the rest. A document larger than what is then left is put
   aside, and the later ones that are no larger are cut again, until none is left that fits.
   So what a source misses of its target is less than any document it did not take once more,
   whatever the layout of the data.
3. *Splitting tree.* The quotas of all sources are divided among the output shards by halving:
   a node with n shards below hands its left child the block quotas of a draw without
   replacement (multivariate hypergeometric) of that child's exact share. Every draw's seed
   is its node, so a leaf walks its own path down and meets what its sibling leaves.
4. *Blocks to shards.* A source's blocks, in drawn order, go to the shards in turn by their
   quotas: disjoint by construction. Inside a shard documents are shuffled by hash.

Only the sums over all sources (total size, sum of weights) reach the driver. Windows run
over a source's blocks or digit sums, never its documents. Everything depends on hashes of
ids and texts, so reruns agree.

Defined results: null texts have size 0 and, like empty ones, are taken with their block;
the null source is a source of its own, last; sources without words have the target 0.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gapwise.llm.common import word_count
from gapwise.scratch import Scratch

DIGIT = 10  # bits of a document's place that one refinement reads
LEVELS = 6


def targets(sources: DataFrame, weights: tuple[float, ...], most: float, scratch: Scratch) -> DataFrame:
    """(source, source_size) to (source, source_size, target).

    ``weights`` repeat over the sources by code point, null last. The order is a range sort
    with counts for each range, so no task holds all sources.
    """
    ranged, _ = scratch.write(
        sources.withColumn("no_source", F.col("source").isNull()).repartitionByRange("no_source", "source").sortWithinPartitions("no_source", "source")
        .withColumn("part", F.spark_partition_id()).withColumn("seq", F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    )
    # one line for each range; their running sum is the first rank of the range
    counts = ranged.groupBy("part").agg(F.count("*").alias("n"))
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.withColumn("base", F.coalesce(F.sum("n").over(w), F.lit(0))).select("part", "base")
    place = F.pmod(F.col("base") + F.col("seq"), F.lit(len(weights))).cast("int")
    weighed, _ = scratch.write(
        ranged.join(first, "part")
        .withColumn("weight", F.element_at(F.array(*[F.lit(float(x)) for x in weights]), place + 1))
        .select("source", "source_size", "weight", (F.col("source_size") * F.lit(float(most)) / F.col("weight")).alias("ratio"))
    )
    level = -1.0
    while True:
        # sources at or below the level are full; the others share what is left by weight
        full = F.col("ratio") <= level
        row = weighed.agg(
            F.sum("source_size").alias("all"),
            F.sum(F.when(full, F.col("source_size") * F.lit(float(most)))).alias("full"),
            F.sum(F.when(~full, F.col("weight"))).alias("open"),
        ).first()
        if not row["open"]:
            break
        new = ((row["all"] or 0) - (row["full"] or 0.0)) / row["open"]
        if new <= level:
            break
        level = new
        if weighed.filter((F.col("ratio") <= level) & ~full).isEmpty():
            break
    target = F.when(F.col("ratio") <= level, F.col("source_size") * F.lit(float(most))).otherwise(F.col("weight") * F.lit(float(max(level, 0.0))))
    return weighed.select("source", "source_size", target.alias("target"))


def _cut(docs: DataFrame, rest: DataFrame, scratch: Scratch) -> DataFrame:
    """For each source, the place up to which its documents' sizes fit in ``rest``.

    ``docs``: source, place (a hash), size. The running sum is narrowed digit by digit: each
    round sums sizes by the next digit of the place, within the one digit that the rest ends
    in, and so reads ever fewer rows in its window: at most 2**DIGIT lines for each source.
    Returns source, limit: documents with place < limit are taken.
    """
    state = rest.select("source", "rest", F.lit(0).cast("long").alias("low"))
    for level in range(1, LEVELS + 1):
        shift = DIGIT * (LEVELS - level)
        step = F.lit(1 << shift).cast("long")
        state = state.withColumnRenamed("source", "s")
        inside = docs.join(state, F.col("source").eqNullSafe(F.col("s")))
        span = F.lit(1 << (shift + DIGIT)).cast("long")
        inside = inside.filter((F.col("place") >= F.col("low")) & (F.col("place") < F.col("low") + span))
        if level == 2:  # what the first digit leaves, about a thousandth
            docs, _ = scratch.write(inside.select("source", "place", "size"))
            inside = docs.join(state, F.col("source").eqNullSafe(F.col("s"))).filter((F.col("place") >= F.col("low")) & (F.col("place") < F.col("low") + span))
        sums = inside.groupBy("s", F.shiftright(F.col("place") - F.col("low"), shift).alias("digit")).agg(F.sum("size").alias("size"))
        running = F.sum("size").over(Window.partitionBy("s").orderBy("digit"))
        before = sums.withColumn("upto", running).join(state.select(F.col("s").alias("s2"), "rest"), F.col("s").eqNullSafe(F.col("s2"))).filter("upto <= rest")
        passed = before.groupBy("s").agg(F.max("digit").alias("digit"), F.max("upto").alias("upto"))
        passed = passed.select(F.col("s").alias("p"), "digit", "upto")
        moved = state.join(passed, F.col("s").eqNullSafe(F.col("p")), "left").select(
            F.col("s").alias("source"),
            (F.col("rest") - F.coalesce("upto", F.lit(0))).alias("rest"),
            (F.col("low") + F.coalesce(F.col("digit") + 1, F.lit(0)) * step).alias("low"),
        )
        state, _ = scratch.write(moved)
    return state.select("source", F.col("low").alias("limit"), F.col("rest").alias("left"))


def _fillers(places: DataFrame, limits: DataFrame, scratch: Scratch, chunk: int = 512) -> DataFrame:
    """The documents after a cut that are taken too: in order of place, each that fits in what is left.

    One line for each: source, place. A round scans about ``chunk`` documents of each source
    in order; where as many again still fit, a cut passes their bulk first. The size that is
    left falls, or the documents behind end, so there is a last round.
    """
    end = 1 << (DIGIT * LEVELS)
    kind = dict(places.dtypes)["source"]

    def scan(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        left, kept = pdf["left"].iloc[0], []
        for size in pdf["size"]:
            kept.append(size <= left)
            left -= size if kept[-1] else 0
        return pdf.loc[kept, ["source", "place", "size"]]

    def fitting(state: DataFrame) -> DataFrame:
        s = state.withColumnRenamed("source", "s")
        return rest.join(s, F.col("source").eqNullSafe(F.col("s"))).filter((F.col("place") >= F.col("limit")) & (F.col("size") <= F.col("left"))).drop("s")

    def moved(state: DataFrame, by: DataFrame) -> DataFrame:
        """``by``: s, to (null: as before), size taken."""
        return scratch.write(
            state.join(by, F.col("source").eqNullSafe(F.col("s")), "left").select(
                "source", F.coalesce("to", "limit").alias("limit"), (F.col("left") - F.coalesce("size", F.lit(0))).alias("left")
            )
        )[0]

    rest, state, chosen, bulk = places, limits.select("source", "limit", "left"), None, False
    while True:
        rest, _ = scratch.write(fitting(state).select("source", "place", "size"))
        counts, _ = scratch.write(rest.groupBy(F.col("source").alias("s")).agg(F.count("*").alias("n")))
        most = counts.agg(F.max("n")).first()[0]
        if chosen is not None and not most:
            return chosen
        if bulk and most > 2 * chunk:
            cut, _ = scratch.write(_cut(rest, state.select("source", F.col("left").alias("rest")), scratch).select(F.col("source").alias("s"), F.col("limit").alias("to")))
            taken = rest.join(cut, F.col("source").eqNullSafe(F.col("s"))).filter("place < to").select("source", "place", "size")
            to = cut.select(F.col("s").alias("t"), "to")
        else:
            span = F.when(F.col("n") <= 2 * chunk, F.lit(end) - F.col("limit")).otherwise(F.ceil((F.lit(end) - F.col("limit")) * (F.lit(float(chunk)) / F.col("n"))))
            ahead, _ = scratch.write(
                state.join(counts, F.col("source").eqNullSafe(F.col("s"))).select(F.col("source").alias("t"), (F.col("limit") + span.cast("long")).alias("to"), "left")
            )
            near = rest.join(ahead, F.col("source").eqNullSafe(F.col("t"))).filter("place < to").select("source", "place", "size", "left")
            taken = near.groupBy("source").applyInPandas(scan, f"source {kind}, place long, size long")
            to = ahead.select("t", "to")
        taken, _ = scratch.write(taken)
        sums = taken.groupBy(F.col("source").alias("g")).agg(F.sum("size").alias("size"))
        state = moved(state, to.join(sums, F.col("t").eqNullSafe(F.col("g")), "left").select(F.col("t").alias("s"), "to", "size"))
        taken = taken.select("source", "place")
        chosen = taken if chosen is None else chosen.union(taken)
        bulk = not bulk


def _tree(quotas: DataFrame, shards: int, seed: int) -> DataFrame:
    """(source_key, quota) to (source_key, shard, quota): every shard walks its path down the tree."""

    def leaf(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("source_key")
        shard, counts = int(pdf["shard"].iloc[0]), pdf["quota"].to_numpy(np.int64)
        low, high = 0, shards
        while high - low > 1:
            middle = (low + high) // 2
            left = int(counts.sum()) * (middle - low) // (high - low)
            drawn = np.random.default_rng([seed, low, high]).multivariate_hypergeometric(counts, left, method="marginals")
            counts, low, high = (drawn, low, middle) if shard < middle else (counts - drawn, middle, high)
        return pd.DataFrame({"source_key": pdf["source_key"], "shard": shard, "quota": counts})

    spread = quotas.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    return spread.groupBy("shard").applyInPandas(leaf, "source_key long, shard int, quota long").filter("quota > 0")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[float, ...] = (5, 2, 1),
    most: float = 3.0,
    block_docs: int = 64,
    shard_words: int = 50_000_000,
    seed: int = 17,
) -> tuple[DataFrame, DataFrame]:
    """(documents, placements).

    documents: one row for each row of ``docs``, with id, size, source, source_size, target,
    copy (a number that tells equal rows apart) and taken. placements: one row for each time a
    document is taken, with id, place, source, pass, shard and rank_key, by which a shard's rows
    are ordered.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark)
    base = docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.col(text_col).alias("text"))
    place = F.shiftrightunsigned(F.xxhash64(F.lit(seed), "source", "id", "text"), 64 - DIGIT * LEVELS)
    sized, _ = scratch.write(base.select("id", "source", word_count("text").alias("size"), place.alias("place")))
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    aimed = targets(sources.select("source", "source_size"), weights, most, scratch)
    aimed = aimed.join(sources.select(F.col("source").alias("s"), "n"), F.col("source").eqNullSafe(F.col("s"))).drop("s")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    bits = F.least(F.lit(DIGIT * LEVELS), F.greatest(F.lit(0), F.ceil(F.log2(F.greatest(F.col("n") / F.lit(float(block_docs)), F.lit(1.0)))))).cast("int")
    planned, _ = scratch.write(
        aimed.withColumn("passes", passes.cast("long"))
        .withColumn("rest", F.col("target") - F.col("passes") * F.col("source_size"))
        .withColumn("bits", bits)
        .withColumn("source_key", F.xxhash64("source", F.col("source").isNull()))
    )
    # equal rows share a place and are taken together
    places, _ = scratch.write(sized.filter("size > 0").groupBy("source", "place").agg(F.sum("size").alias("size")))
    limits = _cut(places, planned.select("source", "rest"), scratch)
    extra = _fillers(places, limits, scratch).select(F.col("source").alias("es"), F.col("place").alias("ep"), F.lit(1).alias("extra"))
    limits = limits.withColumnRenamed("source", "s").drop("left")
    plan, _ = scratch.write(planned.join(limits, F.col("source").eqNullSafe(F.col("s"))).drop("s"))

    # a block is the leading ``bits`` of the place; shift by 60 - bits
    shift = F.lit(DIGIT * LEVELS) - F.col("bits")
    p = plan.withColumnRenamed("source", "s")
    rows = sized.join(p, F.col("source").eqNullSafe(F.col("s"))).drop("s")
    rows = rows.withColumn("block", F.expr(f"shiftright(place, {DIGIT * LEVELS} - bits)"))
    rows = rows.join(extra, F.col("source").eqNullSafe(F.col("es")) & (F.col("place") == F.col("ep")), "left")
    partial = F.when(((F.col("place") < F.col("limit")) & (F.col("rest") > 0)) | F.col("extra").isNotNull(), 1).otherwise(0)
    rows = rows.withColumn("times", F.col("passes") + partial)

    blocks = rows.filter("times > 0").groupBy("source_key", "block").agg(F.max("times").alias("times"))
    drawn = blocks.withColumn("pass", F.explode(F.sequence(F.lit(1).cast("long"), F.col("times"))))
    order = Window.partitionBy("source_key").orderBy(F.xxhash64(F.lit(seed), "block", "pass"), "block", "pass")
    drawn, _ = scratch.write(drawn.select("source_key", "block", "pass", (F.row_number().over(order) - 1).cast("long").alias("at")))
    quotas = drawn.groupBy("source_key").agg(F.count("*").alias("quota"))
    total = plan.agg(F.sum("target")).first()[0] or 0.0
    shards = max(1, int(-(-total // shard_words)))
    split = _tree(quotas, shards, seed)
    before = Window.partitionBy("source_key").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    split = split.withColumn("start", F.coalesce(F.sum("quota").over(before), F.lit(0)))
    slots = split.select("source_key", "shard", F.explode(F.sequence(F.col("start"), F.col("start") + F.col("quota") - 1)).alias("at"))
    placed, _ = scratch.write(drawn.join(slots, ["source_key", "at"]).select("source_key", "block", "pass", "shard"))

    taken = rows.filter("times > 0").select("id", "place", "source", "size", "source_key", "block", "times")
    placements = (
        taken.join(placed, ["source_key", "block"])
        .filter("pass <= times")
        .withColumn("rank_key", F.xxhash64(F.lit(seed), "shard", "place", "pass"))
        .select("id", "place", "source", "size", "pass", "shard", "rank_key")
    )
    # equal rows share a place; each of them is taken as often, so a count is divided among them
    times = placements.groupBy("id", "source", "place").agg(F.count("*").alias("placed"))
    copies = rows.groupBy("id", "source", "place").agg(F.count("*").alias("copies"))
    per = copies.join(
        times.select(F.col("id").alias("i"), F.col("source").alias("s"), F.col("place").alias("q"), "placed"),
        F.col("id").eqNullSafe(F.col("i")) & F.col("source").eqNullSafe(F.col("s")) & (F.col("place") == F.col("q")),
        "left",
    ).select(F.col("id").alias("i"), F.col("source").alias("s"), F.col("place").alias("q"), (F.coalesce("placed", F.lit(0)) / F.col("copies")).cast("long").alias("repeats"))
    documents = rows.join(per, F.col("id").eqNullSafe(F.col("i")) & F.col("source").eqNullSafe(F.col("s")) & (F.col("place") == F.col("q"))).select(
        "id", "size", "source", "source_size", "target", (F.col("repeats") * F.col("size")).alias("taken"), "repeats"
    )
    return documents, placements
