"""Connected components of an edge table, by alternating star contractions.

Every round maps edges to edges: first each node hands its larger neighbours to its smallest
one, then each node hands its smaller neighbours (and itself) to the smallest of them. The
graph ends as stars around each component's smallest node. Rounds are written to the shared
scratch folder, so lineage stays short; the driver sees counts alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.scratch import Scratch


def _large(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.union(least.select("u", F.col("m").alias("v"))).distinct()


def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(u, v) pairs of ids to (id, component): every id of an edge that is not its component's smallest.

    Null ids and self-links are ignored; direction and repeats do not matter. Ids in no row
    of the result are components of their own or the smallest of theirs.
    """
    edges = (
        edges.filter("u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    edges, path = scratch.write_narrow(edges)
    while True:
        parents = edges.select(F.col("v").alias("u")).distinct()
        pending = edges.join(parents, "u", "left_semi").select("u").union(
            edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1").select("u")
        )
        if pending.isEmpty():
            return edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
        edges, new = scratch.write_narrow(_small(_large(edges)))
        scratch.drop(path)
        path = new
