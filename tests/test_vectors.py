import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.ml.linalg import DenseVector, SparseVector, Vectors
from pyspark.sql import functions as F

from gapwise.functions import dense_array, has_absent, sparse_struct, to_dense, vector_element, vector_parts
from gapwise.operators.assemble import SparseVectorAssembler, assembler


def test_sparse_assembly_keeps_zero_and_leaves_out_missing(numbers):
    out = SparseVectorAssembler(inputCols=["x", "same"], outputCol="f").transform(numbers)
    got = {r["k"]: r["f"] for r in out.collect()}
    assert got[0] == SparseVector(2, [0, 1], [1.0, 5.0])
    assert list(got[1].indices) == [1] and list(got[2].indices) == [1]  # null and NaN alike
    assert list(got[5].indices) == [0] and list(got[5].values) == [0.0]
    assert all(isinstance(v, SparseVector) for v in got.values())


def test_further_missing_value(numbers):
    stage = SparseVectorAssembler(inputCols=["x", "same"], outputCol="f", missing=0.0)
    got = {r["k"]: list(r["f"].indices) for r in stage.transform(numbers).collect()}
    assert got[3] == [1] and got[5] == []


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.just(float("nan")), st.floats(-5, 5)), min_size=1, max_size=6))
def test_indices_and_missing_make_up_all_positions(spark, row):
    cells = [F.lit(v).cast("double") for v in row]
    parts = spark.range(1).select(sparse_struct(cells).alias("p")).first()["p"]
    gone = {i for i, v in enumerate(row) if v is None or math.isnan(v)}
    assert set(parts["indices"]) | gone == set(range(len(row))) and not set(parts["indices"]) & gone
    assert parts["values"] == [v for i, v in enumerate(row) if i not in gone]
    assert parts["size"] == len(row)


def test_plan_has_one_arrow_step_as_vector_and_none_as_struct(numbers):
    def plan(form):
        df = SparseVectorAssembler(inputCols=["x", "same"], outputCol="f", form=form).transform(numbers)
        return df._jdf.queryExecution().executedPlan().toString()

    assert plan("vector").count("ArrowEvalPython") == 1
    assert "Python" not in plan("struct")


def test_dense_assembly(numbers):
    skipped = assembler(["x", "same"], "f", "skip").transform(numbers)
    assert [r["k"] for r in skipped.orderBy("k").collect()] == [0, 3, 4]
    kept = {r["k"]: r["f"] for r in assembler(["x", "same"], "f", "keep").transform(numbers).collect()}
    assert math.isnan(kept[1][0]) and math.isnan(kept[2][0]) and math.isnan(kept[5][1])
    with pytest.raises(Exception):
        assembler(["x"], "f", "error").transform(numbers).collect()


def test_strings_are_refused(census):
    with pytest.raises(Exception, match="string"):
        assembler(["age", "race"], "f").transform(census)
    with pytest.raises(ValueError, match="must be numeric"):
        SparseVectorAssembler(inputCols=["race"], outputCol="f").transform(census)


def test_dense_or_sparse_is_chosen_by_size(spark):
    names = [f"c{i}" for i in range(13)]
    rows = [[1.0 if i < n else 0.0 for i in range(13)] for n in (7, 8)]
    out = assembler(names, "f").transform(spark.createDataFrame(rows, names)).collect()
    assert isinstance(out[0]["f"], SparseVector) and isinstance(out[1]["f"], DenseVector)


def test_elements_and_dense_twins(spark):
    df = spark.createDataFrame([(0, Vectors.sparse(3, [1], [3.0])), (1, Vectors.dense([1.0, 0.0, 2.0]))], ["k", "v"])
    v = F.col("v")
    rows = df.select(
        vector_element(v, 1).alias("one"),
        vector_element(v, 7).alias("none"),
        has_absent(v).alias("absent"),
        to_dense(v).alias("zeros"),
        dense_array(v).alias("gaps"),
        to_dense(v, float("nan")).alias("gap_vector"),
        vector_parts(v)["type"].alias("type"),
    ).collect()
    assert [r["one"] for r in rows] == [3.0, 0.0] and rows[0]["none"] is None
    assert [r["absent"] for r in rows] == [True, False]
    assert rows[0]["zeros"] == DenseVector([0.0, 3.0, 0.0])
    assert math.isnan(rows[0]["gaps"][0]) and rows[0]["gaps"][1] == 3.0
    assert math.isnan(rows[0]["gap_vector"][2]) and rows[1]["gaps"] == [1.0, 0.0, 2.0]
    plan = df.select(vector_element(v, 1))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan


def test_stage_can_be_saved(numbers, tmp_path):
    stage = SparseVectorAssembler(inputCols=["x", "same"], outputCol="f", form="struct")
    stage.save(str(tmp_path / "s"))
    again = SparseVectorAssembler.load(str(tmp_path / "s"))
    assert again.transform(numbers).collect().__repr__() == stage.transform(numbers).collect().__repr__()
