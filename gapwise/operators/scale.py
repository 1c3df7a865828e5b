"""Standard scores under an explicit missing-value policy.

``skip`` drops NaN as well as null, and the replacement replaces NaN as well as null. A
constant column scores 0 instead of dividing by zero.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gapwise.functions.missing import NAN, POLICIES, enforce, present_or_null
from gapwise.operators.stage import ColumnStage, check_schema
from gapwise.operators.stats import column_stats


def standard_score(c: Column, mean: float, std_dev: float, missing: float = NAN) -> Column:
    """``(x - mean) / std_dev``; missing values give ``missing``, in standardised units."""
    value = present_or_null(c)
    if std_dev is None or std_dev != std_dev or std_dev == 0:
        score = F.when(value.isNotNull(), F.lit(0.0))
    else:
        score = (value - F.lit(float(mean))) / F.lit(float(std_dev))
    return F.coalesce(score, F.lit(float(missing)))


def _policy(value: str) -> str:
    if value not in POLICIES:
        raise TypeError(f"handleInvalid must be one of {POLICIES}, not {value!r}")
    return value


class HasPolicy(Params):
    handleInvalid = Param(
        Params._dummy(),
        "handleInvalid",
        "missing values: keep (as NaN or as the replacement), skip (drop the row) or error",
        typeConverter=_policy,
    )

    def setHandleInvalid(self, value: str):
        return self._set(handleInvalid=value)

    def getHandleInvalid(self) -> str:
        return self.getOrDefault("handleInvalid")


class HasReplacement(Params):
    replacementValue = Param(
        Params._dummy(),
        "replacementValue",
        "score given to missing values under keep",
        typeConverter=TypeConverters.toFloat,
    )

    def setReplacementValue(self, value: float):
        return self._set(replacementValue=value)

    def getReplacementValue(self) -> float:
        return self.getOrDefault("replacementValue")


class NumericNormalizer(ColumnStage, HasPolicy):
    """Standard score of one column with given mean and deviation; kept missing values are NaN."""

    mean = Param(Params._dummy(), "mean", "mean of the column", typeConverter=TypeConverters.toFloat)
    stdDev = Param(Params._dummy(), "stdDev", "standard deviation of the column", typeConverter=TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol=None, handleInvalid="keep", mean=0.0, stdDev=1.0):
        super().__init__()
        self._setDefault(handleInvalid="keep", mean=0.0, stdDev=1.0)
        self._set(**self._input_kwargs)

    def setMean(self, value: float):
        return self._set(mean=value)

    def setStdDev(self, value: float):
        return self._set(stdDev=value)

    def rows(self, df: DataFrame) -> DataFrame:
        return enforce(df, [self.getInputCol()], self.getHandleInvalid())

    def missing_score(self) -> float:
        return NAN

    def expression(self, c: Column) -> Column:
        return standard_score(c, self.getOrDefault("mean"), self.getOrDefault("stdDev"), self.missing_score())


class NumericNormalizerWithReplacement(NumericNormalizer, HasReplacement):
    """As ``NumericNormalizer``, but kept missing values get ``replacementValue`` (0 = the mean)."""

    @keyword_only
    def __init__(
        self, *, inputCol=None, outputCol=None, handleInvalid="keep", mean=0.0, stdDev=1.0, replacementValue=0.0
    ):
        kwargs = self._input_kwargs
        super().__init__()
        self._setDefault(replacementValue=0.0)
        self._set(**kwargs)

    def missing_score(self) -> float:
        return self.getReplacementValue()


class StandardScore(
    Estimator, HasInputCols, HasOutputCols, HasPolicy, HasReplacement, DefaultParamsReadable, DefaultParamsWritable
):
    """Learn mean and deviation of all columns in one pass and score them in one projection."""

    trimFactor = Param(
        Params._dummy(),
        "trimFactor",
        "if above 0, the deviation uses only values below trimFactor * mean",
        typeConverter=TypeConverters.toFloat,
    )

    @keyword_only
    def __init__(
        self, *, inputCols=None, outputCols=None, handleInvalid="keep", replacementValue=NAN, trimFactor=0.0
    ):
        super().__init__()
        self._setDefault(handleInvalid="keep", replacementValue=NAN, trimFactor=0.0)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "StandardScoreModel":
        cols = self.getInputCols()
        check_schema(df.schema, cols, self.getOutputCols())
        factor = self.getOrDefault("trimFactor")
        stats = column_stats(df, cols, factor if factor > 0 else None)
        return StandardScoreModel(
            inputCols=cols,
            outputCols=self.getOutputCols(),
            handleInvalid=self.getHandleInvalid(),
            replacementValue=self.getReplacementValue(),
            means=[stats[c].mean or 0.0 for c in cols],
            stdDevs=[stats[c].std_dev or 0.0 for c in cols],
        )


class StandardScoreModel(
    Model, HasInputCols, HasOutputCols, HasPolicy, HasReplacement, DefaultParamsReadable, DefaultParamsWritable
):
    means = Param(Params._dummy(), "means", "mean per column", typeConverter=TypeConverters.toListFloat)
    stdDevs = Param(Params._dummy(), "stdDevs", "deviation per column", typeConverter=TypeConverters.toListFloat)

    @keyword_only
    def __init__(
        self, *, inputCols=None, outputCols=None, handleInvalid="keep", replacementValue=NAN, means=None, stdDevs=None
    ):
        super().__init__()
        self._setDefault(handleInvalid="keep", replacementValue=NAN)
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        check_schema(df.schema, self.getInputCols(), self.getOutputCols())
        kept = enforce(df, self.getInputCols(), self.getHandleInvalid())
        parts = zip(
            self.getInputCols(), self.getOutputCols(), self.getOrDefault("means"), self.getOrDefault("stdDevs")
        )
        return kept.withColumns(
            {out: standard_score(F.col(c), mean, std, self.getReplacementValue()) for c, out, mean, std in parts}
        )
