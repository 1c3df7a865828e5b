"""Further single-column work: outliers, interactions and mathematical functions."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.functions.missing import present_or_null
from gapwise.operators.stage import ColumnStage
from gapwise.operators.stats import column_stats


def zscore_bounds(df: DataFrame, cols: list[str], limit: float) -> dict[str, tuple[float, float]]:
    """Value bounds that stand for ``|z| <= limit``, from one aggregation."""
    bounds = {}
    for name, s in column_stats(df, cols).items():
        if s.mean is not None:
            spread = limit * (s.std_dev or 0.0)
            bounds[name] = (s.mean - spread, s.mean + spread)
    return bounds


def quantile_bounds(
    df: DataFrame, cols: list[str], low: float, high: float, accuracy: int = 10_000
) -> dict[str, tuple[float, float]]:
    """Value bounds at two approximate quantiles; one pass of mergeable sketches for all columns."""
    row = df.agg(
        *[
            F.percentile_approx(present_or_null(F.col(c)), [low, high], accuracy).alias(f"q{i}")
            for i, c in enumerate(cols)
        ]
    ).first()
    return {c: tuple(row[f"q{i}"]) for i, c in enumerate(cols) if row[f"q{i}"] is not None}


def within_bounds(df: DataFrame, bounds: dict[str, tuple[float, float]], keep_missing: bool = True) -> DataFrame:
    """Drop rows with an outlier.

    The test is a plain comparison of the column with two constants, so with
    ``keep_missing=False`` it is pushed down to the scan.
    """
    for name, (low, high) in bounds.items():
        c = F.col(name)
        inside = (c >= F.lit(low)) & (c <= F.lit(high))
        df = df.filter(inside | c.isNull() | F.isnan(c)) if keep_missing else df.filter(inside)
    return df


def interact(*columns: Column) -> Column:
    """Product of features; missing if any factor is."""
    product = present_or_null(columns[0])
    for c in columns[1:]:
        product = product * present_or_null(c)
    return product


_FUNCTIONS = {
    "log": lambda x: F.when(x > 0, F.log(x)),
    "exp": F.exp,
    "square": lambda x: x * x,
    "sin": F.sin,
}


def apply_function(c: Column, function: str) -> Column:
    """``log``, ``exp``, ``square`` or ``sin``; missing stays missing, and so does log of x <= 0."""
    if function not in _FUNCTIONS:
        raise ValueError(f"function must be one of {sorted(_FUNCTIONS)}, not {function!r}")
    return _FUNCTIONS[function](present_or_null(c))


class FunctionStage(ColumnStage):
    """``apply_function`` as a pipeline stage."""

    function = Param(Params._dummy(), "function", "log, exp, square or sin", typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, function=None):
        super().__init__()
        self._set(**self._input_kwargs)

    def expression(self, c: Column) -> Column:
        return apply_function(c, self.getOrDefault("function"))
