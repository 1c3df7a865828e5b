from pyspark.sql import functions as F

from gapwise.operators.split import hash_split, random_split, with_side
from gapwise.sources import CENSUS_SCHEMA

import pytest


def test_declared_schema_and_null_rules(census):
    assert census.schema == CENSUS_SCHEMA
    assert census.count() == 30
    rows = {r["fnlwgt"]: r for r in census.collect()}
    assert rows[234721]["age"] is None and rows[234721]["capital_loss"] is None
    assert rows[284582]["age"] is None  # a bad integer
    assert rows[284582]["workclass"] == "Private"  # and only that field
    assert rows[160187]["marital_status"] is None  # ""
    assert rows[45781]["native_country"] == "?"  # stays text
    assert rows[245487]["income"] is None
    assert rows[83311]["capital_gain"] == 0


def test_scan_reads_only_needed_columns(census):
    plan = census.select("age", "income")._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<age:int,income:string>" in plan


def test_random_split_covers_the_rows(spark):
    df = spark.range(1000)
    a, b = random_split(df, [0.8, 0.2], 123)
    assert a.count() + b.count() == 1000
    assert a.intersect(b).count() == 0


def test_hash_split_does_not_depend_on_layout(spark):
    df = spark.range(1000)
    a, b = hash_split(df, "id", [80, 20])
    c, _ = hash_split(df.repartition(7), "id", [80, 20])
    keys = lambda d: {r["id"] for r in d.collect()}
    assert keys(a) == keys(c)
    assert keys(a) | keys(b) == set(range(1000)) and not keys(a) & keys(b)
    assert 740 < a.count() < 860


def test_three_sides_and_bad_weights(spark):
    sides = with_side(spark.range(300), "id", [50, 30, 20]).groupBy("side").count()
    assert {r["side"] for r in sides.collect()} == {0, 1, 2}
    with pytest.raises(ValueError):
        with_side(spark.range(3), "id", [80, 30])


def test_sources_stay_lazy_for_streams(spark, census, tmp_path):
    """The row-wise stages also work on a streaming frame of delimited text."""
    from gapwise.operators.category import CategoryIndexer
    from gapwise.operators.scale import NumericNormalizer

    folder = tmp_path / "in"
    census.write.csv(str(folder), sep=";", header=False)
    stages = [
        CategoryIndexer(inputCols=["race"], outputCols=["race_index"]).fit(census),
        NumericNormalizer(inputCol="age", outputCol="age_norm", mean=40.0, stdDev=10.0),
    ]

    def through(df):
        for s in stages:
            df = s.transform(df)
        return df.select("fnlwgt", "race_index", F.round("age_norm", 6).alias("z"))

    stream = through(spark.readStream.schema(CENSUS_SCHEMA).csv(str(folder), sep=";"))
    q = stream.writeStream.format("memory").queryName("scored").trigger(availableNow=True).start()
    q.awaitTermination(60)
    key = lambda r: r["fnlwgt"]
    got, want = sorted(spark.table("scored").collect(), key=key), sorted(through(census).collect(), key=key)
    assert [repr(r) for r in got] == [repr(r) for r in want]
