"""Mean and sample standard deviation of many columns at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.functions.missing import present_or_null


@dataclass(frozen=True)
class ColumnStats:
    count: int
    mean: float | None
    std_dev: float | None


def _aggregate(df: DataFrame, cols: list[str], means: dict[str, float] | None, factor: float | None) -> DataFrame:
    out = []
    for i, name in enumerate(cols):
        value = present_or_null(F.col(name))
        spread = value if means is None else F.when(value < factor * means[name], value)
        out += [
            F.count(value).alias(f"count_{i}"),
            F.mean(value).alias(f"mean_{i}"),
            F.stddev_samp(spread).alias(f"std_dev_{i}"),
        ]
    return df.agg(*out)


def trim_means(df: DataFrame, cols: list[str]) -> dict[str, float]:
    """The means that bound a trimmed deviation. A bound needs a positive mean."""
    row = df.agg(*[F.mean(present_or_null(F.col(c))).alias(f"mean_{i}") for i, c in enumerate(cols)]).first()
    means = {name: row[f"mean_{i}"] for i, name in enumerate(cols)}
    for name, mean in means.items():
        if mean is not None and mean <= 0:
            raise ValueError(f"column {name} has mean {mean}; an upper bound of factor * mean would cut real values")
    return {name: 0.0 if mean is None else mean for name, mean in means.items()}


def stats_frame(df: DataFrame, cols: list[str], trim_factor: float | None = None) -> DataFrame:
    """One line per column: ``column, count, mean, std_dev``.

    Missing values are left out. With ``trim_factor`` the deviation (not the mean) uses
    only values below ``trim_factor * mean``; that costs one more pass, for the bound.
    """
    means = None if trim_factor is None else trim_means(df, cols)
    wide = _aggregate(df, cols, means, trim_factor)
    lines = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(f"count_{i}").alias("count"),
            F.col(f"mean_{i}").alias("mean"),
            F.col(f"std_dev_{i}").alias("std_dev"),
        )
        for i, name in enumerate(cols)
    ]
    return wide.select(F.inline(F.array(*lines)))


def column_stats(df: DataFrame, cols: list[str], trim_factor: float | None = None) -> dict[str, ColumnStats]:
    """``stats_frame`` as a dictionary; one action, two with trimming."""
    rows = stats_frame(df, cols, trim_factor).collect()
    return {r["column"]: ColumnStats(r["count"], r["mean"], r["std_dev"]) for r in rows}
