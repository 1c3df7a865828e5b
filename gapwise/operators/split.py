"""Train/test splits."""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.functions.keys import md5_bucket


def random_split(df: DataFrame, weights: list[float], seed: int) -> list[DataFrame]:
    """Spark's seeded split. Its outcome depends on how the rows are partitioned."""
    return df.randomSplit(weights, seed)


def with_side(df: DataFrame, key: str, weights: list[int], salt: str = "split", name: str = "side") -> DataFrame:
    """Tag each row with its side, 0, 1, ..., by its key alone.

    ``weights`` are whole percentages that add up to 100. The same key lands on the same
    side in every run and layout.
    """
    if sum(weights) != 100 or any(w < 0 for w in weights):
        raise ValueError("weights must be non-negative percentages that add up to 100")
    side = F.lit(len(weights) - 1)
    for i, bound in reversed(list(enumerate(list(accumulate(weights))[:-1]))):
        side = F.when(F.col("_bucket") < bound, F.lit(i)).otherwise(side)
    return df.withColumn("_bucket", md5_bucket(F.col(key), 100, salt)).withColumn(name, side).drop("_bucket")


def hash_split(df: DataFrame, key: str, weights: list[int], salt: str = "split") -> list[DataFrame]:
    """Split by a hash of ``key``; see ``with_side``."""
    tagged = with_side(df, key, weights, salt, "_side")
    return [tagged.filter(F.col("_side") == i).drop("_side") for i in range(len(weights))]
