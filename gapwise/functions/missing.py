"""One meaning of "missing" for the whole package: null, or NaN in a floating column.

A self-comparison cannot stand in for the NaN test, because Spark holds NaN equal to itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, NumericType

from gapwise.functions.keys import md5_uniform

POLICIES = ("keep", "skip", "error")
NAN = float("nan")


def is_missing(c: Column) -> Column:
    """True where a numeric column is null or NaN."""
    return c.isNull() | F.isnan(c)


def present_or_null(c: Column) -> Column:
    """The value as a double, with NaN turned into null."""
    return F.nanvl(c.cast("double"), F.lit(None).cast("double"))


def enforce(df: DataFrame, cols: list[str], policy: str) -> DataFrame:
    """Apply a missing-value policy to numeric columns.

    ``keep`` leaves the rows alone, ``skip`` drops rows with a missing value and ``error``
    fails the job at the first one. The null test of ``skip`` stays a bare
    ``IS NOT NULL``, which reaches the scan.
    """
    if policy not in POLICIES:
        raise ValueError(f"policy must be one of {POLICIES}, not {policy!r}")
    if policy == "skip":
        for name in cols:
            df = df.filter(F.col(name).isNotNull())
            if isinstance(df.schema[name].dataType, (FloatType, DoubleType)):
                df = df.filter(~F.isnan(name))
    elif policy == "error":
        df = df.withColumns(
            {
                name: F.when(
                    is_missing(F.col(name)),
                    F.raise_error(F.lit(f"missing value in column {name}")).cast(df.schema[name].dataType),
                ).otherwise(F.col(name))
                for name in cols
            }
        )
    return df


def _number(value: float | None) -> Column:
    """A double literal; None, the statistic of a column without values, is null."""
    return F.lit(None if value is None else float(value)).cast("double")


def fill_constant(c: Column, value: float | None) -> Column:
    """Replace missing values by one constant: the mean, zero or a sentinel such as -999999.

    The mean of a column that is all missing is None and leaves the column as it is.
    """
    return F.coalesce(present_or_null(c), _number(value))


def fill_normal(c: Column, mean: float, std_dev: float, seed: int, key: Column | None = None) -> Column:
    """Replace missing values by draws from N(mean, std_dev).

    With ``key`` each draw is a function of the row's key and the seed (Box-Muller on two
    hash words), so it does not change when the data are laid out differently. Without
    it the draw comes from ``randn(seed)``.
    """
    if key is None:
        draw = F.randn(seed)
    else:
        first = md5_uniform(key, f"normal{seed}:", 0)
        second = md5_uniform(key, f"normal{seed}:", 1)
        draw = F.sqrt(-2 * F.log(first)) * F.cos(2 * F.pi() * second)
    return F.coalesce(present_or_null(c), _number(mean) + _number(std_dev) * draw)


def nudge_zero(c: Column, epsilon: float = 0.0001) -> Column:
    """Move true zeros to ``epsilon``, then let zero stand for missing."""
    value = present_or_null(c)
    return F.when(value == 0, F.lit(float(epsilon))).otherwise(F.coalesce(value, F.lit(0.0)))


def zero_when(c: Column, condition: Column) -> Column:
    """Missing means zero where ``condition`` holds; elsewhere it stays missing (null)."""
    value = present_or_null(c)
    return F.when(value.isNull() & condition, F.lit(0.0)).otherwise(value)


def missing_profile(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows, nulls, NaNs and zeros per column, from one aggregation over one scan."""
    aggregates = [F.count(F.lit(1)).alias("rows")]
    for i, name in enumerate(cols):
        c, dtype = F.col(name), df.schema[name].dataType
        floating = isinstance(dtype, (FloatType, DoubleType))
        numeric = isinstance(dtype, NumericType)
        aggregates += [
            F.count_if(c.isNull()).alias(f"null_{i}"),
            (F.count_if(F.isnan(c)) if floating else F.lit(0).cast("bigint")).alias(f"nan_{i}"),
            (F.count_if(c == 0) if numeric else F.lit(0).cast("bigint")).alias(f"zero_{i}"),
        ]
    lines = [
        F.struct(
            F.lit(name).alias("column"),
            F.col("rows"),
            F.col(f"null_{i}").alias("nulls"),
            F.col(f"nan_{i}").alias("nans"),
            F.col(f"zero_{i}").alias("zeros"),
            F.try_divide(F.col(f"null_{i}") + F.col(f"nan_{i}"), F.col("rows")).alias("missing_rate"),
        )
        for i, name in enumerate(cols)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*lines)))
