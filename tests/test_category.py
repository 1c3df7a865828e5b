import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.feature import IndexToString
from pyspark.sql import functions as F

from gapwise.operators import category
from gapwise.operators.category import (
    CategoryIndexer,
    CategoryModel,
    category_counts,
    category_dictionary,
    label_indexer,
    label_text,
    ordinal_indexer,
    rare_to_other,
    read_dictionary,
)


def index(df, model, out="i"):
    return [r[out] for r in model.transform(df).orderBy("k").collect()]


@pytest.fixture(scope="module")
def letters(spark):
    rows = list(enumerate(["A", "B", "B", "A", "C", "D", None]))
    return spark.createDataFrame(rows, "k int, v string")


def test_rank_order_ties_and_null(letters):
    model = CategoryIndexer(inputCols=["v"], outputCols=["i"]).fit(letters)
    assert isinstance(model, CategoryModel)
    assert index(letters, model) == [0, 1, 1, 0, 2, 3, 4]


def test_unseen_values(spark, letters):
    other = spark.createDataFrame([(0, "Z"), (1, "A")], "k int, v string")
    fit = lambda policy: CategoryIndexer(inputCols=["v"], outputCols=["i"], handleInvalid=policy).fit(letters)
    assert index(other, fit("keep")) == [4, 0]
    assert index(other, fit("skip")) == [0]
    with pytest.raises(Exception):
        fit("error").transform(other).collect()


def test_dictionary_table_gives_the_same_indices(spark, letters):
    model = CategoryIndexer(inputCols=["v"], outputCols=["i"]).fit(letters)
    out = model.transform(letters)
    assert out.schema["i"].metadata["ml_attr"]["num_vals"] == 5
    assert model.transform(letters.drop("v")).columns == ["k"]
    assert index(letters, model) == [0, 1, 1, 0, 2, 3, 4]
    assert {(r["value"], r["idx"]) for r in read_dictionary(spark, model).collect()} == {
        ("A", 0), ("B", 1), ("C", 2), ("D", 3),
    }


def test_dictionary_of_many_columns_and_ranges(spark):
    df = spark.range(5000).select(
        F.concat(F.lit("u"), F.pmod(F.xxhash64("id"), F.lit(1700))).alias("many"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 11)).alias("few"),
    )
    counts = category_counts(df, ["many", "few"])
    got = {(r["column"], r["value"]): r["idx"] for r in category_dictionary(counts).collect()}
    rows = sorted((r["column"], -r["n"], r["value"]) for r in counts.collect())
    want, seen = {}, {}
    for column, _, value in rows:
        want[column, value] = seen.get(column, 0)
        seen[column] = want[column, value] + 1
    assert got == want


def test_hot_and_null_values_are_not_joined_in_one_place(spark):
    """Two thirds of the rows are null or one value; neither may gather in one join task."""
    df = spark.range(0, 9000, 1, 8).select(
        F.col("id").alias("k"),
        F.when(F.col("id") % 3 == 0, None)
        .when(F.col("id") % 3 == 1, "hot")
        .otherwise(F.concat(F.lit("v"), F.col("id"))).alias("v"),
    )
    model = CategoryIndexer(inputCols=["v"], outputCols=["i"], handleInvalid="keep").fit(df)
    for name, value in {
        "spark.sql.adaptive.enabled": "false",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }.items():
        spark.conf.set(name, value)
    try:
        out = model.transform(df)
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) < 9000 / 4 * 2
        assert out.filter("v = 'hot'").agg(F.min("i"), F.max("i")).first() == (0, 0)
        assert out.filter("v is null").agg(F.min("i"), F.max("i")).first() == (3001, 3001)
        assert out.count() == 9000 and out.select("i").distinct().count() == 3002
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_unseen_hot_value_is_spread(spark, letters):
    model = CategoryIndexer(inputCols=["v"], outputCols=["i"]).fit(letters)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = model.transform(spark.range(0, 8000, 1, 8).select(F.col("id").alias("k"), F.lit("new").alias("v")))
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 8000 and len(sizes) > 1 and max(sizes) < 6000
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_repeated_dictionary_is_not_broadcast(spark, monkeypatch):
    """What goes to every executor is a dictionary that is small in memory, never its repeated lines."""
    df = spark.range(0, 6000, 1, 4).select(F.col("id").alias("k"), F.concat(F.lit("v"), F.col("id") % 3000).alias("v"))
    model = CategoryIndexer(inputCols=["v"], outputCols=["i"]).fit(df)
    plan = lambda out: out._jdf.queryExecution().executedPlan().toString()
    small = model.transform(df)
    assert "BroadcastHashJoin" in plan(small) and "Generate explode" not in plan(small)
    monkeypatch.setattr(category, "BROADCAST_BYTES", 3000 * category.LINE_BYTES)
    monkeypatch.setattr(category, "LINES_PER_TASK", 2000)
    large = model.transform(df)
    assert "SortMergeJoin" in plan(large) and "Broadcast" not in plan(large)
    assert large.rdd.getNumPartitions() == 12
    assert large.exceptAll(small).isEmpty() and small.exceptAll(large).isEmpty()
    unknown = CategoryModel(inputCols=["v"], outputCols=["i"], dictionaryPath=model.getOrDefault("dictionaryPath"), sizes=[3000])
    assert "SortMergeJoin" in plan(unknown.transform(df)) and unknown.transform(df).exceptAll(small).isEmpty()


def test_hot_values_of_a_large_dictionary_are_spread(spark, letters, monkeypatch):
    """One value, seen or not, and null rows go to several tasks where the dictionary is not broadcast."""
    monkeypatch.setattr(category, "BROADCAST_BYTES", 0)
    model = CategoryIndexer(inputCols=["v"], outputCols=["i"]).fit(letters)
    for hot, place in (("A", 0), ("new", 4), (None, 4)):
        out = model.transform(spark.range(0, 8000, 1, 8).select(F.col("id").alias("k"), F.lit(hot).cast("string").alias("v")))
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()]
        assert sum(sizes) == 8000 and len(sizes) > 1 and max(sizes) < 6000
        assert out.filter(F.col("i") != place).isEmpty()


def test_saved_model_holds_its_dictionary(spark, letters, tmp_path):
    model = CategoryIndexer(inputCols=["v"], outputCols=["i"]).fit(letters)
    model.save(str(tmp_path / "m"))
    path = model.getOrDefault("dictionaryPath")
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    assert index(letters, CategoryModel.load(str(tmp_path / "m"))) == [0, 1, 1, 0, 2, 3, 4]


def test_label_index_and_back(census):
    model = label_indexer(census, "income")
    assert list(model.labels) == ["<=50K", ">50K"]
    out = label_text(model.labels, "label", "back").transform(model.transform(census))
    assert out.count() == 29  # the unlabelled row is gone
    assert out.filter("back <> income").count() == 0


def test_absent_label_column_passes_through(census):
    model = label_indexer(census, "income")
    assert model.transform(census.drop("income")).count() == 30


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text("abcXYZ-é", min_size=1, max_size=3), min_size=1, max_size=20))
def test_round_trip(spark, words):
    df = spark.createDataFrame([(w,) for w in words], "v string")
    model = CategoryIndexer(inputCols=["v"], outputCols=["i"]).fit(df)
    back = IndexToString(inputCol="i", outputCol="back", labels=[r["value"] for r in read_dictionary(spark, model).orderBy("idx").collect()])
    assert back.transform(model.transform(df)).filter("back <> v").count() == 0


def test_own_order(letters):
    assert index(letters, ordinal_indexer(["D", "C", "B", "A"], "v", "i")) == [3, 2, 2, 3, 1, 0, 4]


def test_rare_values(letters):
    out = rare_to_other(letters, "v", "g", 0.3).orderBy("k")
    assert [r["g"] for r in out.collect()] == ["A", "B", "B", "A", "other", "other", None]
    with pytest.raises(ValueError):
        rare_to_other(letters, "v", "g", 0.0)


def test_all_null_column(letters):
    df = letters.select("k", F.lit(None).cast("string").alias("v"))
    assert index(df, CategoryIndexer(inputCols=["v"], outputCols=["i"]).fit(df)) == [0.0] * 7


def test_one_job_counts_all_columns(census):
    counts = category_counts(census, ["race", "gender", "workclass"])
    plan = counts._jdf.queryExecution().executedPlan().toString()
    initial = plan.split("Initial Plan")[-1]
    assert initial.count("Exchange") == 1 and initial.count("FileScan") == 1
