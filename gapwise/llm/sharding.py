"""Shards of near equal size, by minimax contiguous partition of whole groups.

Rows with equal texts are one group and stay together. Groups stand in an order, and each shard
takes a stretch of it; the shards' capacity is the least one that lets them hold everything.

1. *Groups.* Sizes are summed by a hash of the text, in the tasks first. A group that alone
   fills a shard comes first, larger ones before smaller ones; all others follow by the least
   id in them. Range partitions are summed up, so every group gets the sum of all sizes up to
   its own.
2. *Capacity.* Binary search for the smallest feasible capacity; a check fills the shards greedily
   from the left: each ends at the largest running sum within its capacity. The first shard is
   cut there and the rest is searched anew with one shard less, so that what one large group
   forces upon its own shard does not leave the others uneven.
3. *Running sums.* The driver knows them by ``BINS`` bins only: least sum, largest sum and number.
   A check that falls between two sums of one bin is open, and one job then bins anew the
   stretches where checks are open, thousands of times finer. Cuts are exact; nothing that
   grows with the data reaches the driver.
4. *Rows* get their group's place by a join. Groups with more than a 1024th of all rows, 1024
   at most, are broadcast; their rows are dealt evenly. Slots are numbered by range partitions.

Defined results: the size of a row is its text's bytes in UTF-8 plus 1; a null text has none and
is in one group with empty ones. Rows without an id come after the others of their group.
Repeated rows are placed each. With fewer groups than shards some shards stay empty. An empty table
gives an empty table. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gapwise.scratch import Scratch

BINS = 1 << 14
HOT_ROWS = 1024


def place_in_shards(docs: DataFrame, shards: int, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, size, text_crc32, shard, slot) of every row; slots count from 0 within a shard."""
    if shards < 1:
        raise ValueError("shards must be at least 1")
    scratch = Scratch(docs.sparkSession)
    rows, _ = scratch.write(measured(docs, id, text))
    groups, _ = scratch.write(rows.groupBy("key").agg(F.sum("size").alias("bytes"), F.count("*").alias("n"), F.min("id").alias("first")))
    totals = groups.agg(F.sum("bytes").alias("bytes"), F.sum("n").alias("n")).first()
    summed, _ = scratch.write(running_sums(groups, (totals["bytes"] or 0) // shards, scratch))
    cuts = cut_sums(summed, totals["bytes"] or 0, shards)
    after = [F.when(F.col("upto") > c, 1).otherwise(0) for c in cuts[:-1]]
    placed = summed.withColumn("shard", sum(after, F.lit(0)).cast("int"))
    per_shard = {r["shard"]: r["n"] for r in placed.groupBy("shard").agg(F.sum("n").alias("n")).collect()}  # a line for each shard
    return slots(located(rows, placed, totals["n"] or 0), per_shard, shards, scratch)


def measured(docs: DataFrame, id: str, text: str) -> DataFrame:
    """Thin rows: id, size, checksum and the key of the group of equal texts."""
    body = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    return docs.select(
        F.col(id).alias("id"), (F.octet_length(body) + 1).cast("long").alias("size"), F.crc32(body).alias("text_crc32"), F.unhex(F.sha2(body, 256)).alias("key")
    )


def running_sums(groups: DataFrame, full: int, scratch: Scratch) -> DataFrame:
    """key, n and ``upto``: the sum of the sizes of all groups up to this one, in order."""
    alone = F.when(F.col("bytes") >= max(full, 1), -F.col("bytes")).otherwise(0)
    order = ["alone", "nameless", "first", "key"]
    ordered = (
        groups.withColumns({"alone": alone, "nameless": F.col("first").isNull()})
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("key", "n", "bytes", F.spark_partition_id().alias("part"))
    )

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for batch in batches:
            upto = total + np.cumsum(batch.column("bytes").to_numpy())
            total = int(upto[-1]) if len(upto) else total
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], batch.column("part"), pa.array(upto, pa.int64())], names=["key", "n", "part", "upto"])

    ranged, _ = scratch.write(ordered.mapInArrow(add_up, "key binary, n bigint, part int, upto bigint"))
    return ranged.join(_before(ranged.groupBy("part").agg(F.max("upto").alias("own"))), "part").select("key", "n", (F.col("before") + F.col("upto")).alias("upto"))


def _before(parts: DataFrame) -> DataFrame:
    """(part, own) to (part, before): the sum of ``own`` over all lower parts, one line for each range partition."""
    w = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.withColumn("before", F.coalesce(F.sum("own").over(w), F.lit(0))).select("part", "before")


@dataclass
class Bin:
    """Running sums in (low, high]: the least, the largest and their number."""

    low: int
    high: int
    least: int = 0
    most: int = 0
    number: int = 0


class Sums:
    """What the driver knows of the running sums, as ascending bins."""

    def __init__(self, summed: DataFrame, total: int):
        self._summed = summed
        self.bins = [Bin(0, total, 0, total, 3)]
        self.refine([0])

    def at_most(self, x: int) -> tuple[int, int]:
        """The largest running sum up to x, as bounds from below and above; equal where it is known."""
        k = min(bisect_right(self._lows, x) - 1, len(self.bins) - 1)
        b = self.bins[k]
        if b.number and x >= b.most:
            return b.most, b.most
        if b.number and x >= b.least:
            return (b.least, b.least) if b.number <= 2 else (b.least, min(x, b.most - 1))
        below = self._ends[k]
        return below, below

    def refine(self, places: list[int]) -> None:
        """Bin anew the bins with these numbers, by one job."""
        places = sorted(set(places))
        share = max(2, BINS // len(places))
        width = {k: max(1, -(-(self.bins[k].high - self.bins[k].low) // share)) for k in places}
        inside = [(F.col("upto") > self.bins[k].low) & (F.col("upto") <= self.bins[k].high) for k in places]
        which, step = F.lit(None).cast("int"), F.lit(None).cast("long")
        for k, test in zip(reversed(places), reversed(inside)):
            which = F.when(test, k).otherwise(which)
            step = F.when(test, F.floor((F.col("upto") - 1 - self.bins[k].low) / width[k]).cast("long")).otherwise(step)
        any_of = inside[0]
        for test in inside[1:]:
            any_of = any_of | test
        found = (
            self._summed.filter(any_of)
            .groupBy(which.alias("bin"), step.alias("step"))
            .agg(F.min("upto").alias("least"), F.max("upto").alias("most"), F.count("*").alias("number"))
            .collect()
        )
        finer: dict[int, list[Bin]] = {k: [] for k in places}
        for r in sorted(found, key=lambda r: (r["bin"], r["step"])):
            low = self.bins[r["bin"]].low + r["step"] * width[r["bin"]]
            finer[r["bin"]].append(Bin(low, low + width[r["bin"]], r["least"], r["most"], r["number"]))
        self.bins = [b for k, old in enumerate(self.bins) for b in finer.get(k, [old])]
        self._lows = [0, *[b.low for b in self.bins[1:]]]
        self._ends = [0, *[b.most for b in self.bins]]

    def bin_of(self, x: int) -> int:
        return min(bisect_right(self._lows, x) - 1, len(self.bins) - 1)


def cut_sums(summed: DataFrame, total: int, shards: int) -> list[int]:
    """The running sum at which each shard ends."""
    if not total:
        return [0] * shards
    sums, start, cuts = Sums(summed, total), 0, []
    for left in range(shards, 0, -1):
        start = _first_cut(sums, start, total, left)
        cuts.append(start)
    return cuts


def _first_cut(sums: Sums, start: int, total: int, shards: int) -> int:
    """Where the first of ``shards`` shards ends, at the least capacity that holds all from ``start`` on."""
    while True:
        open_bins: set[int] = set()

        def reached(capacity: int, side: int) -> int:
            at = start
            for _ in range(shards):
                at = sums.at_most(at + capacity)[side]
            return at

        # the least capacity that is feasible for certain, and the least that may be
        bounds = []
        for side in (0, 1):
            low, high = -(-(total - start) // shards), total - start
            while low < high:
                middle = (low + high) // 2
                low, high = (low, middle) if reached(middle, side) >= total else (middle + 1, high)
            bounds.append(high)
        sure, maybe = bounds
        for capacity in {sure, maybe}:
            for side in (0, 1):
                at = start
                for _ in range(shards):
                    lower, upper = sums.at_most(at + capacity)
                    if lower != upper:
                        open_bins.add(sums.bin_of(at + capacity))
                    at = (lower, upper)[side]
        lower, upper = sums.at_most(start + sure)
        if sure == maybe and lower == upper:
            return lower
        sums.refine(list(open_bins))


def located(rows: DataFrame, placed: DataFrame, total: int) -> DataFrame:
    """Rows with the place and the shard of their group."""
    where = placed.select("key", "upto", "shard")
    hot = F.broadcast(placed.filter(F.col("n") * HOT_ROWS > total).select("key", F.col("upto").alias("hot_upto"), F.col("shard").alias("hot_shard")))
    # rows of hot groups need no second join: they get keys of another length, one each
    spread = F.when(F.col("hot_upto").isNull(), F.col("key")).otherwise(F.monotonically_increasing_id().cast("string").cast("binary"))
    found = rows.join(hot, "key", "left").withColumn("key", spread).join(where, "key", "left")
    return found.select("id", "size", "text_crc32", F.coalesce("upto", "hot_upto").alias("upto"), F.coalesce("shard", "hot_shard").alias("shard"))


def slots(rows: DataFrame, per_shard: dict[int, int], shards: int, scratch: Scratch) -> DataFrame:
    """Number the rows of each shard by place of the group and id."""
    order: list[str | Column] = ["upto", "nameless", "id", "tie"]
    ranged, _ = scratch.write(
        rows.withColumns({"nameless": F.col("id").isNull(), "tie": F.monotonically_increasing_id()})
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("part", F.spark_partition_id())
        .withColumn("seq", F.monotonically_increasing_id() - F.shiftleft(F.col("part").cast("long"), 33))
        .drop("nameless", "tie")
    )
    first = [sum(per_shard.get(j, 0) for j in range(k)) for k in range(shards)]
    before = _before(ranged.groupBy("part").agg(F.count("*").alias("own")))
    start = F.element_at(F.array(*[F.lit(f).cast("long") for f in first]), F.col("shard") + 1)
    return ranged.join(before, "part").select("id", "size", "text_crc32", "shard", (F.col("before") + F.col("seq") - start).alias("slot"))
