import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gapwise.functions import (
    enforce,
    fill_constant,
    fill_normal,
    is_missing,
    missing_profile,
    nudge_zero,
    zero_when,
)
from gapwise.operators.scale import (
    NumericNormalizer,
    NumericNormalizerWithReplacement,
    StandardScore,
    StandardScoreModel,
)
from gapwise.operators.stage import check_schema
from gapwise.operators.stats import column_stats
from gapwise.operators.transforms import FunctionStage, apply_function, interact, quantile_bounds, within_bounds, zscore_bounds


def plain(rows):
    return ["nan" if isinstance(v, float) and math.isnan(v) else v for v in rows]


def values(df, name):
    return plain([r[name] for r in df.orderBy("k").select(name).collect()])


def test_policies(numbers):
    assert values(enforce(numbers, ["x"], "keep"), "k") == [0, 1, 2, 3, 4, 5]
    assert values(enforce(numbers, ["x"], "skip"), "k") == [0, 3, 4, 5]
    assert values(enforce(numbers, ["x", "same"], "skip"), "k") == [0, 3, 4]
    with pytest.raises(Exception, match="missing value in column x"):
        enforce(numbers, ["x"], "error").collect()
    assert enforce(numbers.filter("k in (0, 3)"), ["x"], "error").count() == 2
    with pytest.raises(ValueError):
        enforce(numbers, ["x"], "drop")


def test_fills(numbers):
    x = F.col("x")
    got = numbers.select(
        "k",
        fill_constant(x, -999999).alias("sentinel"),
        nudge_zero(x).alias("nudged"),
        zero_when(x, F.col("k") == 1).alias("ruled"),
        fill_normal(x, 10.0, 0.0, 1).alias("drawn"),
        is_missing(x).alias("gone"),
    )
    assert values(got, "sentinel") == [1.0, -999999.0, -999999.0, 0.0, 3.0, 0.0]
    assert values(got, "nudged") == [1.0, 0.0, 0.0, 0.0001, 3.0, 0.0001]
    assert values(got, "ruled") == [1.0, 0.0, None, 0.0, 3.0, 0.0]
    assert values(got, "drawn") == [1.0, 10.0, 10.0, 0.0, 3.0, 0.0]
    assert values(got, "gone") == [False, True, True, False, False, False]


def test_normal_draws_follow_the_distribution_and_not_the_layout(spark):
    df = spark.range(20000).select("id", F.lit(None).cast("double").alias("x"))
    draw = fill_normal(F.col("x"), 5.0, 2.0, 3, F.col("id")).alias("x")
    one, two = df.select("id", draw), df.repartition(5).select("id", draw)
    assert one.exceptAll(two).count() == 0
    s = column_stats(one, ["x"])["x"]
    assert abs(s.mean - 5) < 0.06 and abs(s.std_dev - 2) < 0.05


def test_profile(numbers, census):
    rows = {r["column"]: r for r in missing_profile(numbers, ["x", "same"]).collect()}
    assert rows["x"].asDict() == {"column": "x", "rows": 6, "nulls": 1, "nans": 1, "zeros": 2, "missing_rate": 2 / 6}
    assert (rows["same"]["nulls"], rows["same"]["nans"], rows["same"]["zeros"]) == (1, 0, 0)
    text = missing_profile(census, ["workclass"]).first()
    assert (text["rows"], text["nulls"]) == (30, 1)
    assert missing_profile(numbers.limit(0), ["x"]).first()["missing_rate"] is None


def test_stats_leave_out_null_and_nan(numbers):
    s = column_stats(numbers, ["x", "same"])
    assert (s["x"].count, s["x"].mean) == (4, 1.0)
    assert s["x"].std_dev == pytest.approx(math.sqrt(2.0))  # sample, not population
    assert s["same"].std_dev == 0.0


def test_trimming(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (1000.0,)], "x double")
    whole, trimmed = column_stats(df, ["x"])["x"], column_stats(df, ["x"], 2.0)["x"]
    assert trimmed.mean == whole.mean == 251.5
    assert trimmed.std_dev == pytest.approx(1.0) and whole.std_dev > 400
    with pytest.raises(ValueError):
        column_stats(df.select((-F.col("x")).alias("x")), ["x"], 2.0)


def test_normalizer_policies(numbers):
    def run(**kw):
        return NumericNormalizer(inputCol="x", outputCol="z", mean=1.0, stdDev=2.0, **kw).transform(numbers)

    assert values(run(), "z") == [0.0, "nan", "nan", -0.5, 1.0, -0.5]
    assert values(run(handleInvalid="skip"), "z") == [0.0, -0.5, 1.0, -0.5]  # NaN rows go as well
    with pytest.raises(Exception, match="missing value"):
        run(handleInvalid="error").collect()
    with pytest.raises(TypeError):
        run(handleInvalid="other")
    assert values(NumericNormalizer(inputCol="x", outputCol="z").transform(numbers), "z")[4] == 3.0  # 0 and 1


def test_replacement(numbers):
    stage = NumericNormalizerWithReplacement().setInputCol("x").setOutputCol("z").setMean(1.0).setStdDev(2.0)
    assert values(stage.transform(numbers), "z") == [0.0, 0.0, 0.0, -0.5, 1.0, -0.5]  # NaN is replaced too
    assert values(stage.setReplacementValue(9.0).transform(numbers), "z")[1:3] == [9.0, 9.0]
    assert values(stage.setHandleInvalid("skip").transform(numbers), "k") == [0, 3, 4, 5]


def test_constant_column_scores_zero(numbers):
    stage = StandardScore(inputCols=["x", "same"], outputCols=["x_norm", "same_norm"]).fit(numbers)
    out = stage.transform(numbers)
    assert values(out, "same_norm") == [0.0, 0.0, 0.0, 0.0, 0.0, "nan"]
    empty = StandardScore(inputCols=["x"], outputCols=["z"]).fit(numbers.limit(0))
    assert values(empty.transform(numbers), "z")[0] == 0.0
    nothing = numbers.select("k", F.lit(None).cast("double").alias("x"))
    assert values(StandardScore(inputCols=["x"], outputCols=["z"]).fit(nothing).transform(nothing), "z") == ["nan"] * 6


@settings(max_examples=8, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=3, max_size=30).filter(lambda v: max(v) - min(v) > 1e-3))
def test_training_column_has_mean_0_and_deviation_1(spark, v):
    df = spark.createDataFrame([(x,) for x in v], "x double")
    out = StandardScore(inputCols=["x"], outputCols=["z"]).fit(df).transform(df)
    s = column_stats(out, ["z"])["z"]
    assert s.mean == pytest.approx(0, abs=1e-6) and s.std_dev == pytest.approx(1, abs=1e-6)


def test_schema_is_checked_before_any_job(numbers, census):
    with pytest.raises(ValueError, match="does not exist"):
        NumericNormalizer(inputCol="nope", outputCol="z").transform(numbers)
    with pytest.raises(ValueError, match="already exists"):
        NumericNormalizer(inputCol="x", outputCol="K").transform(numbers)
    with pytest.raises(ValueError, match="must be numeric"):
        NumericNormalizer(inputCol="race", outputCol="z").transform(census)
    assert check_schema(numbers.schema, ["x"], ["z"]).names == ["k", "x", "same", "z"]


def test_stages_are_expressions_only_and_filters_reach_the_scan(spark, numbers, tmp_path):
    path = str(tmp_path / "t")
    numbers.write.parquet(path)
    df = spark.read.parquet(path)
    for stage in (
        NumericNormalizer(inputCol="x", outputCol="z", handleInvalid="skip"),
        NumericNormalizerWithReplacement(inputCol="x", outputCol="z", handleInvalid="skip"),
    ):
        plan = stage.transform(df)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
        assert "PushedFilters: [IsNotNull(x)]" in plan


def test_outliers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([(float(i),) for i in range(100)] + [(1e6,), (None,)], "x double").write.parquet(path)
    df = spark.read.parquet(path)
    kept = within_bounds(df, zscore_bounds(df, ["x"], 3.0))
    assert kept.count() == 101  # the missing row stays
    strict = within_bounds(df, quantile_bounds(df, ["x"], 0.0, 0.9), keep_missing=False)
    assert strict.agg(F.max("x")).first()[0] < 100
    assert "GreaterThanOrEqual(x" in strict._jdf.queryExecution().executedPlan().toString()


def test_functions_and_interaction(numbers, tmp_path):
    out = numbers.select(
        "k",
        apply_function(F.col("x"), "log").alias("log"),
        apply_function(F.col("x"), "square").alias("square"),
        interact(F.col("x"), F.col("same")).alias("both"),
    )
    logs = values(out, "log")
    assert logs[:4] + logs[5:] == [0.0, None, None, None, None] and logs[4] == pytest.approx(math.log(3.0))
    assert values(out, "square") == [1.0, None, None, 0.0, 9.0, 0.0]
    assert values(out, "both") == [5.0, None, None, 0.0, 15.0, None]
    stage = FunctionStage(inputCol="x", outputCol="e", function="exp")
    stage.write().overwrite().save(str(tmp_path / "s"))
    assert values(FunctionStage.load(str(tmp_path / "s")).transform(numbers), "e")[3] == 1.0


def test_stages_can_be_saved(numbers, tmp_path):
    model = StandardScore(inputCols=["x"], outputCols=["z"], replacementValue=0.5).fit(numbers)
    model.save(str(tmp_path / "m"))
    again = StandardScoreModel.load(str(tmp_path / "m"))
    assert values(again.transform(numbers), "z") == values(model.transform(numbers), "z")
    assert again.copy().uid == again.uid
