import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from gapwise.operators.evaluate import area_under_roc, class_score, roc_points


def brute_auc(pairs):
    pos = [s for s, y in pairs if y > 0.5]
    neg = [s for s, y in pairs if y <= 0.5]
    if not pos or not neg:
        return None
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def auc(df, **kw):
    return area_under_roc(df, "s", "y", **kw).first()["auc"]


@settings(max_examples=12, deadline=None)
@given(
    st.lists(st.tuples(st.sampled_from([-1.0, 0.0, 0.25, 0.5, 0.75, 3.0]) | st.floats(-1, 1), st.sampled_from([0.0, 1.0])), min_size=1, max_size=40),
    st.integers(1, 6),
)
def test_area_matches_brute_force(spark, pairs, ranges):
    df = spark.createDataFrame(pairs, "s double, y double").repartition(3)
    got, want = auc(df, ranges=ranges), brute_auc(pairs)
    assert got is None if want is None else got == pytest.approx(want, abs=1e-12)


def test_area_equals_the_evaluator_without_bins(spark):
    df = spark.range(20000).select(
        F.rand(1).alias("s"), (F.rand(2) < 0.3 + 0.4 * F.rand(1)).cast("double").alias("y")
    ).cache()
    exact = BinaryClassificationEvaluator(
        rawPredictionCol="v", labelCol="y", metricName="areaUnderROC", numBins=0
    ).evaluate(df.withColumn("v", array_to_vector(F.array(1 - F.col("s"), F.col("s")))))
    assert auc(df) == pytest.approx(exact, abs=1e-9)


def test_class_0_turns_the_curve_and_increasing_maps_do_not(spark):
    df = spark.range(500).select(F.rand(5).alias("p"), (F.rand(6) < F.rand(5)).cast("double").alias("y"))
    df = df.withColumn("probability", array_to_vector(F.array(1 - F.col("p"), F.col("p")))).cache()
    one = auc(df.withColumn("s", class_score()))
    assert one + auc(df.withColumn("s", class_score(class_index=0))) == pytest.approx(1.0)
    assert auc(df.withColumn("s", F.exp(3 * class_score()))) == pytest.approx(one)
    assert auc(df.withColumn("s", -class_score())) == pytest.approx(1 - one)


def test_hot_score(spark):
    """One score holds a third of the rows: it is one line after grouping and counts as a tie."""
    pairs = [(0.5, float(i % 2)) for i in range(100)] + [(i / 200, float(i > 90)) for i in range(200)]
    df = spark.createDataFrame(pairs, "s double, y double")
    assert auc(df, ranges=8) == pytest.approx(brute_auc(pairs))


def test_missing_scores_are_an_error(spark):
    df = spark.createDataFrame([(0.1, 1.0), (None, 0.0)], "s double, y double")
    with pytest.raises(ValueError, match="missing"):
        auc(df)


def test_points(spark):
    pairs = [(0.9, 1.0), (0.8, 0.0), (0.8, 1.0), (0.3, 0.0), (0.1, 1.0)]
    df = spark.createDataFrame(pairs, "s double, y double")
    rows = {r["score"]: (r["tp"], r["fp"]) for r in roc_points(df, "s", "y", ranges=3).collect()}
    assert rows == {0.9: (1, 0), 0.8: (2, 1), 0.3: (2, 2), 0.1: (3, 2)}


def test_no_window_over_all_scores(spark):
    df = spark.range(100).select(F.rand(1).alias("s"), F.lit(1.0).alias("y"))
    plan = area_under_roc(df, "s", "y")._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Python" not in plan and "Cartesian" not in plan
    for line in plan.splitlines():
        if "Window [" in line:
            assert "range" in line
