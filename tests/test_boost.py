import json
import math
import tracemalloc

import numpy as np
import pyarrow as pa

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from gapwise.operators.assemble import SparseVectorAssembler, assembler
from gapwise.operators.boost import (
    BoostedTreeClassifier,
    BoostedTreeModel,
    best_splits,
    bin_columns,
    gradient_histogram,
    split_candidates,
)
from gapwise.operators.boost import classifier as cl
from gapwise.operators.boost import features as ft
from gapwise.operators.boost.features import cut_points
from gapwise.operators.evaluate import area_under_roc, class_score

CUTS = json.dumps([[i / 10 for i in range(1, 10)], [i / 10 for i in range(1, 10)]])


@pytest.fixture(scope="module")
def points(spark):
    """Two uniform features and a label that depends on both."""
    u = lambda salt: (F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(100003)) / 100003.0)
    df = spark.range(3000).select("id", u("a").alias("a"), u("b").alias("b"), u("n").alias("noise"))
    return df.withColumn(
        "label", ((F.col("a") > 0.4) & (F.col("b") < 0.7) | (F.col("noise") < 0.1)).cast("double")
    ).cache()


def auc(model, df):
    return area_under_roc(model.transform(df).withColumn("s", class_score()), "s", "label").first()["auc"]


def brute_best(rows, bins, lam=1.0, weight=1.0):
    """The best first split by trying them all, one row at a time."""
    best = None
    total_g, total_h = sum(r["g"] for r in rows), sum(r["h"] for r in rows)
    score = lambda g, h: g * g / (h + lam)
    for f in range(len(rows[0]["bins"])):
        for b in range(bins):
            for left_default in (True, False):
                side = [r for r in rows if (r["bins"][f] <= b if r["bins"][f] >= 0 else left_default)]
                if not any(r["bins"][f] == b for r in rows):
                    continue
                g, h = sum(r["g"] for r in side), sum(r["h"] for r in side)
                if h < weight or total_h - h < weight:
                    continue
                gain = 0.5 * (score(g, h) + score(total_g - g, total_h - h) - score(total_g, total_h))
                key = (round(gain, 9), -f, -b, left_default)
                if gain > 1e-6 and (best is None or key > best):
                    best = key
    return best


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_best_split_matches_brute_force(spark, seed):
    rows = spark.range(80).select(
        F.lit(1).alias("class"),
        F.lit(1).alias("node"),
        *[(F.pmod(F.xxhash64("id", F.lit(f"{n}{seed}")), F.lit(17)) - 8).cast("bigint").alias(n) for n in ("g",)],
        (F.pmod(F.xxhash64("id", F.lit(f"h{seed}")), F.lit(5)) + 1).alias("h"),
        F.lit(None).cast("array<int>").alias("positions"),
        F.array(F.lit(0), *[(F.pmod(F.xxhash64("id", F.lit(f"{i}{seed}")), F.lit(6)) - 1).cast("int") for i in range(3)]).alias("bins"),
    )
    found = best_splits(split_candidates(gradient_histogram(rows), 1.0, 1.0, 0.0, 1.0)).first()
    stored = [{"g": r["g"], "h": r["h"], "bins": r["bins"][1:]} for r in rows.collect()]
    want = brute_best(stored, 5)
    got = (round(found["gain"], 9), -found["feature"], -found["bin"], found["default_left"])
    assert got == pytest.approx(want)
    assert (found["all_g"], found["all_h"], found["n"]) == (sum(r["g"] for r in stored), sum(r["h"] for r in stored), 80)


@pytest.mark.parametrize("features, bins", [(5, 10), (2000, 250)])
def test_one_split_search_for_few_and_many_lines(spark, features, bins):
    """50 and 500,000 lines of a histogram: the same statement, in one reducer or several, finds the best of all splits."""
    lines = spark.range(features * bins, numPartitions=4).select(
        F.lit(1).alias("class"),
        F.lit(1).alias("node"),
        F.floor(F.col("id") / bins).cast("int").alias("feature"),
        F.pmod("id", F.lit(bins)).cast("smallint").alias("bin"),
        (F.pmod(F.xxhash64("id"), F.lit(201)) - 100).alias("g"),
        (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(50)) + 1).alias("h"),
        F.lit(2).cast("long").alias("n"),
    )
    whole = spark.sql(f"SELECT 1 AS class, 1 AS node, -1 AS feature, 0S AS bin, 77L AS g, {60 * bins}L AS h, {3 * bins}L AS n")
    histogram = lines.unionAll(whole).cache()
    found = best_splits(split_candidates(histogram, 4.0, 1.0, 0.0, 1.0)).first()
    assert best_splits(split_candidates(histogram, 4.0, 1.0, 0.0, 1.0, reducers=1)).first() == found
    table = lines.orderBy("feature", "bin").toPandas()
    g, h = (table[c].to_numpy().reshape(features, bins).cumsum(axis=1) / 4 for c in ("g", "h"))
    best = -1.0
    total_g, total_h = 77 / 4, 60 * bins / 4
    for left_g, left_h in ((g, h), (g + total_g - g[:, -1:], h + total_h - h[:, -1:])):
        right_g, right_h = total_g - left_g, total_h - left_h
        gain = 0.5 * (left_g**2 / (left_h + 1) + right_g**2 / (right_h + 1) - total_g**2 / (total_h + 1))
        best = max(best, gain[(left_h >= 1) & (right_h >= 1)].max())
    assert found["gain"] == pytest.approx(best, rel=1e-12)
    histogram.unpersist()


def wide_rows(spark, rows, width, seed=3):
    """Rows with 8 of ``width`` entries each; entry 0 is often present and tells the label."""
    rng = np.random.default_rng(seed)
    data = []
    for _ in range(rows):
        label = int(rng.random() < 0.5)
        places = sorted({0, *rng.choice(np.arange(1, 90), 7, replace=False).tolist()}) if rng.random() < 0.8 else sorted(rng.choice(np.arange(1, 90), 8, replace=False).tolist())
        values = [float(label) + rng.normal() * 0.3 if p == 0 else float(rng.integers(0, 5)) for p in places]
        data.append((float(label), Vectors.sparse(width, places, values)))
    return spark.createDataFrame(data, ["label", "features"])


def test_width_of_sparse_rows_costs_nothing(spark):
    """400 rows with 8 entries: the same trees among 10,000 features as among 100, and as from numbers with gaps."""
    kw = dict(numRound=2, maxDepth=3, maxBins=32, allowNonZeroForMissing=True)
    narrow = BoostedTreeClassifier(**kw).fit(wide_rows(spark, 400, 100))
    wide = BoostedTreeClassifier(**kw).fit(wide_rows(spark, 400, 10_000))
    assert wide.getOrDefault("trees") == narrow.getOrDefault("trees")
    assert {t.splits[1]["feature"] for t in wide.tree_list()} == {0}
    get = F.udf(lambda v: [dict(zip(v.indices.tolist(), v.values.tolist())).get(i) for i in range(100)], "array<double>")
    gaps = wide_rows(spark, 400, 100).withColumn("v", get("features")).select("label", *[F.col("v")[i].alias(f"c{i}") for i in range(100)])
    columns = BoostedTreeClassifier(inputCols=[f"c{i}" for i in range(100)], **kw).fit(gaps)
    assert columns.getOrDefault("trees") == narrow.getOrDefault("trees")
    scored = wide.transform(wide_rows(spark, 400, 10_000))
    assert scored.filter("prediction = label").count() > 340


def test_only_lighter_children_are_summed(points, monkeypatch):
    """Below the root the rows that a level explodes are half of the table at most."""
    seen = []
    real = cl._derivatives

    def spy(table, growing, depth, scale, count):
        text = real(table, growing, depth, scale, count)
        seen.append((depth, count, {k: dict(t.splits) for k, t in growing.items()}, text))
        return text

    monkeypatch.setattr(cl, "_derivatives", spy)
    read = []
    kind = type(points.sparkSession)
    sql = kind.sql

    def counted(self, text, **frames):
        for depth, _, _, inner in seen[len(read) :]:
            read.append((depth, sql(self, f"SELECT count(*) AS n FROM ({inner})").first()["n"]))
        return sql(self, text, **frames)

    monkeypatch.setattr(kind, "sql", counted)
    BoostedTreeClassifier(inputCols=["a", "b"], numRound=2, maxDepth=3, cutPoints=CUTS).fit(points)
    assert [d for d, _ in read] == [0, 1, 2] * 2
    assert all(n == 3000 if d == 0 else 0 < n <= 1500 for d, n in read)


def test_weighted_cuts_stand_at_even_weight(spark, monkeypatch):
    """Rank error within 1 / (8 x bins) of the weight, with a skewed weight and many merges."""
    monkeypatch.setattr(ft, "HELD_ENTRIES", 4_000)
    monkeypatch.setattr(ft, "MERGED", 4)
    df = spark.range(200_000, numPartitions=16).select(
        F.pow(F.rand(5), F.lit(3.0)).alias("x"), F.when(F.rand(6) < 0.01, 500.0).otherwise(F.rand(7)).alias("w")
    ).cache()
    bins = 64
    (cuts,) = cut_points(df, ["x"], bins, weight="w")
    data = df.toPandas().sort_values("x")
    upto, total = np.concatenate([[0.0], np.cumsum(data["w"])]), data["w"].sum()
    heaviest = data["w"].max() / total
    shares = np.diff(np.concatenate([[0.0], upto[np.searchsorted(data["x"], cuts)] / total, [1.0]]))
    ranks = upto[np.searchsorted(data["x"], cuts)] / total
    assert len(cuts) == bins - 1
    assert np.abs(ranks - (np.arange(bins - 1) + 1) / bins).max() <= 1 / (8 * bins) + heaviest and shares.min() > 0
    df.unpersist()


def test_memory_of_cut_points_does_not_grow_with_rows():
    """What a task holds is bounded by settings, in batches of any number of rows; nothing of the weight is lost."""
    rows, points = 300_000, 64 * 256
    draw = np.random.default_rng(3)

    def batches(n):
        for _ in range(n):
            flat = pa.array(draw.random(2 * rows))
            values = pa.ListArray.from_arrays(np.arange(0, 2 * rows + 1, 2, dtype=np.int32), flat)
            none = pa.ListArray.from_arrays(np.zeros(rows + 1, np.int32), pa.array([], pa.int32()))
            columns = [pa.array(np.ones(rows, np.int8)), pa.nulls(rows, pa.int32()), none, values, pa.array(np.ones(rows))]
            yield pa.RecordBatch.from_arrays(columns, names=["kind", "size", "indices", "values", "weight"])

    def most(n):
        tracemalloc.start()
        weight, lines = 0.0, 0
        for batch in ft.summaries(batches(n), points, math.nan, "missing"):
            weight += sum(w.values.to_numpy().sum() for w in batch.column(4))
            lines += batch.num_rows
        peak = tracemalloc.get_traced_memory()[1] - 8 * 2 * rows  # numbers of the batch itself
        tracemalloc.stop()
        assert weight == pytest.approx(n * 2 * rows) and lines >= 2
        return peak / 1e6

    few, many = most(4), most(16)
    assert many < 45 and many < 1.5 * few + 16


def test_bins_count_cuts_at_or_below_and_missing_is_apart(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (2.5,), (None,)], "b0 double")
    out = bin_columns(df.withColumn("b1", F.col("b0")), ["b0", "b1"], [[1.0, 2.0], []])
    assert [r["b0"] for r in out.collect()] == [0, 1, 2, -1]
    assert [r["b1"] for r in out.collect()] == [0, 0, 0, -1]


def test_rare_categories_get_cuts_of_their_own(spark):
    df = spark.range(10000).select(F.when(F.col("id") == 7, 3.0).when(F.col("id") < 5, 2.0).otherwise(0.0).alias("c"))
    assert cut_points(df, ["c"], 32) == [[2.0, 3.0]]


def test_same_trees_from_any_layout_and_input_form(spark, points):
    kw = dict(numRound=2, maxDepth=2, cutPoints=CUTS)
    one = BoostedTreeClassifier(inputCols=["a", "b"], **kw).fit(points.coalesce(1))
    many = BoostedTreeClassifier(inputCols=["a", "b"], numWorkers=3, **kw).fit(points.repartition(8))
    assert one.getOrDefault("trees") == many.getOrDefault("trees")
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(points)
    dense = BoostedTreeClassifier(allowNonZeroForMissing=True, **kw).fit(vectors)
    sparse = BoostedTreeClassifier(allowNonZeroForMissing=True, **kw).fit(
        SparseVectorAssembler(inputCols=["a", "b"], form="struct").transform(points)
    )
    assert dense.getOrDefault("trees") == sparse.getOrDefault("trees") == one.getOrDefault("trees")
    assert auc(dense, vectors) == auc(one, points)


def test_rewriting_the_table_changes_nothing(points):
    kw = dict(inputCols=["a", "b"], numRound=4, maxDepth=2, cutPoints=CUTS)
    assert (
        BoostedTreeClassifier(rewriteInterval=1, **kw).fit(points).getOrDefault("trees")
        == BoostedTreeClassifier(rewriteInterval=10, **kw).fit(points).getOrDefault("trees")
    )


def test_as_good_as_plain_trees_without_missing(points):
    train, test = points.filter("id % 4 <> 0"), points.filter("id % 4 = 0")
    ours = BoostedTreeClassifier(inputCols=["a", "b"], numRound=6).fit(train)
    v = VectorAssembler(inputCols=["a", "b"], outputCol="features")
    theirs = GBTClassifier(maxDepth=3, maxIter=6, stepSize=0.3).fit(v.transform(train))
    assert abs(auc(ours, test) - auc(theirs, v.transform(test))) < 0.02


def test_missingness_itself_is_learned(spark):
    """A feature whose absence tells the label: learned here, lost by mean imputation."""
    gone = F.floor(F.col("id") / 3) % 2 == 0
    df = spark.range(3000).select(F.when(~gone, (F.col("id") % 3).cast("double")).alias("x"), (~gone).cast("double").alias("label"))
    small = dict(numRound=2, maxDepth=1)
    kept = BoostedTreeClassifier(inputCols=["x"], **small).fit(df)
    sparse = SparseVectorAssembler(inputCols=["x"], form="struct").transform(df)
    absent = BoostedTreeClassifier(allowNonZeroForMissing=True, **small).fit(sparse)
    assert auc(kept, df) == auc(absent, sparse) == 1.0
    assert kept.tree_list()[0].splits[1]["threshold"] is None  # present to one side, missing to the other
    filled = df.withColumn("x", F.coalesce("x", F.lit(df.agg(F.mean("x")).first()[0])))  # the mean is 1, a real value
    assert auc(BoostedTreeClassifier(inputCols=["x"], **small).fit(filled), filled) < 0.9


def test_absent_is_missing_and_zero_is_zero(spark):
    """The same numbers stored dense and sparse: the third entry is zero in one, missing in the other."""
    rows = [(Vectors.sparse(3, [0, 1], [1.0, 1.0]), 1.0), (Vectors.dense([1.0, 1.0, 0.0]), 0.0)] * 20
    df = spark.createDataFrame(rows, ["features", "label"])
    model = BoostedTreeClassifier(numRound=3, allowNonZeroForMissing=True).fit(df)
    assert auc(model, df) == 1.0
    as_zero = BoostedTreeClassifier(numRound=3, allowNonZeroForMissing=True, absent="zero").fit(df)
    assert auc(as_zero, df) == 0.5


def test_value_missing_only_at_scoring_takes_the_stored_side(spark, points):
    model = BoostedTreeClassifier(inputCols=["a", "b"], numRound=1, maxDepth=1).fit(points)
    split = model.tree_list()[0].splits[1]
    weights = model.tree_list()[0].weights
    raw = model.transform(spark.createDataFrame([(None, None)], "a double, b double")).first()["rawPrediction"][1]
    assert raw == weights[2 if split["default_left"] else 3]


def test_settings_are_checked(spark, points):
    vectors = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(points)
    with pytest.raises(ValueError, match="allowNonZeroForMissing"):
        BoostedTreeClassifier(numRound=1).fit(vectors)
    BoostedTreeClassifier(numRound=1, maxDepth=1, missing=0.0).fit(vectors)
    with pytest.raises(ValueError, match="NaN"):
        holes = assembler(["a", "c"], "features", "keep").transform(
            points.withColumn("c", F.when(F.col("id") > 5, F.col("b")))
        )
        BoostedTreeClassifier(numRound=1, missing=0.0).fit(holes)
    with pytest.raises(ValueError, match="label"):
        BoostedTreeClassifier(inputCols=["a"], numRound=1).fit(points.withColumn("label", F.lit(2.0)))
    with pytest.raises(ValueError, match="no rows"):
        BoostedTreeClassifier(inputCols=["a"], numRound=1).fit(points.limit(0))
    with pytest.raises(ValueError, match="objective"):
        BoostedTreeClassifier(inputCols=["a"], objective="reg:squarederror").fit(points)
    with pytest.raises(ValueError, match="unknown"):
        BoostedTreeClassifier.from_options({"etta": 1})
    options = {"eta": 0.3, "allow_non_zero_for_missing": "true", "max_depth": 3, "num_round": 100, "missing": 0}
    made = BoostedTreeClassifier.from_options(options)
    assert made.getOrDefault("allowNonZeroForMissing") is True and made.getOrDefault("missing") == 0.0


def test_sentinel_counts_as_missing(points):
    kw = dict(numRound=1, maxDepth=2, cutPoints=CUTS, inputCols=["a", "b"])
    hole = F.when(F.col("id") % 5 == 0, None).otherwise(F.col("a"))
    gone = points.withColumn("a", hole)
    sentinel = points.withColumn("a", F.coalesce(hole, F.lit(-999999.0)))
    assert (
        BoostedTreeClassifier(**kw).fit(gone).getOrDefault("trees")
        == BoostedTreeClassifier(missing=-999999.0, **kw).fit(sentinel).getOrDefault("trees")
    )


def test_three_classes(points):
    df = points.withColumn("label", F.when(F.col("a") < 0.3, 0.0).when(F.col("b") < 0.5, 1.0).otherwise(2.0))
    model = BoostedTreeClassifier(inputCols=["a", "b"], numClass=3, numRound=4, maxDepth=2).fit(df)
    out = model.transform(df)
    assert out.filter("prediction = label").count() > 2800
    p = out.first()["probability"]
    assert len(p) == 3 and sum(p) == pytest.approx(1.0)
    assert {t.label_class for t in model.tree_list()} == {0, 1, 2}


def test_two_classes_are_mirrored(points):
    """Growing both classes of a two-class problem gives the same splits and opposite weights."""
    two = BoostedTreeClassifier(inputCols=["a", "b"], numRound=2, maxDepth=2, cutPoints=CUTS).fit(points)
    raw = two.transform(points).first()["rawPrediction"]
    assert raw[0] == -raw[1]
    flipped = points.withColumn("label", 1 - F.col("label"))
    other = BoostedTreeClassifier(inputCols=["a", "b"], numRound=2, maxDepth=2, cutPoints=CUTS).fit(flipped)
    for t, o in zip(two.tree_list(), other.tree_list()):
        assert {n: (s["feature"], s["bin"]) for n, s in t.splits.items()} == {
            n: (s["feature"], s["bin"]) for n, s in o.splits.items()
        }
        assert all(o.weights[n] == pytest.approx(-w, rel=1e-6) for n, w in t.weights.items())


def test_scores_are_sums_of_the_trees_weights(points):
    model = BoostedTreeClassifier(inputCols=["a", "b"], numRound=30, maxDepth=3).fit(points)
    assert sum(len(t.splits) for t in model.tree_list()) > 80
    holes = points.withColumn("a", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("a"))).limit(200)

    def weight(tree, row):
        node = 1
        while node in tree.splits:
            s, x = tree.splits[node], row[tree.splits[node]["feature"]]
            gone = x is None or x != x
            left = s["default_left"] if gone else s["threshold"] is None or x < s["threshold"]
            node = 2 * node + (0 if left else 1)
        return tree.weights[node]

    for r in model.transform(holes).select("a", "b", "rawPrediction").collect():
        assert r["rawPrediction"][1] == pytest.approx(sum(weight(t, (r["a"], r["b"])) for t in model.tree_list()), abs=1e-12)


def test_vectors_of_unequal_size_are_an_error(spark):
    short = [(float(i % 2), Vectors.dense([float(i)])) for i in range(20)]
    long = [(float(i % 2), Vectors.dense([float(i), 1.0, 2.0])) for i in range(20)]
    trainer = BoostedTreeClassifier(numRound=1, maxDepth=1, allowNonZeroForMissing=True)
    with pytest.raises(ValueError, match="entries"):
        trainer.fit(spark.createDataFrame(short + long, ["label", "features"]))
    model = trainer.fit(spark.createDataFrame(short, ["label", "features"]))
    with pytest.raises(Exception, match="does not have 1 entries"):
        model.transform(spark.createDataFrame(long, ["label", "features"])).collect()


def test_workers_are_a_lower_bound(spark, points, monkeypatch):
    seen = []
    kind = type(points)
    monkeypatch.setattr(kind, "repartition", lambda self, n, *c, f=kind.repartition: (seen.append(n), f(self, n, *c))[1])
    BoostedTreeClassifier(inputCols=["a", "b"], numRound=1, maxDepth=1, numWorkers=3).fit(points.repartition(16))
    assert max(n for n in seen if isinstance(n, int)) >= spark.sparkContext.defaultParallelism


def test_cuts_beside_a_spike(spark):
    df = spark.range(200_000).select(F.when(F.col("id") % 100 < 92, 0.0).otherwise((F.col("id") * 7919 % 100_000).cast("double")).alias("v"))
    cuts = cut_points(df, ["v"], 32)[0]
    assert len(cuts) <= 31 and len([c for c in cuts if c > 0]) >= 20


def test_no_split_is_still_a_model(spark):
    df = spark.createDataFrame([(1.0, 1.0)] * 10, "a double, label double")
    model = BoostedTreeClassifier(inputCols=["a"], numRound=2).fit(df)
    assert model.tree_list()[0].splits == {}
    assert model.transform(df).first()["probability"][1] > 0.5


def test_saved_model_scores_the_same(points, tmp_path):
    model = BoostedTreeClassifier(inputCols=["a", "b"], numRound=2).fit(points)
    model.save(str(tmp_path / "m"))
    again = BoostedTreeModel.load(str(tmp_path / "m"))
    assert auc(again, points) == auc(model, points)
    gains = {r["feature"]: r["gain"] for r in again.feature_gain(points.sparkSession).collect()}
    assert set(gains) == {0, 1} and all(g > 0 for g in gains.values())


def test_callers_session_is_left_alone_and_tables_are_dropped(spark, points):
    import os

    from gapwise.scratch import scratch_root

    before = spark.conf.get("spark.sql.adaptive.enabled")
    folder = scratch_root(spark).replace("file:", "")
    had = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    BoostedTreeClassifier(inputCols=["a", "b"], numRound=3, rewriteInterval=1, maxDepth=1).fit(points)
    assert spark.conf.get("spark.sql.adaptive.enabled") == before
    left = [os.listdir(os.path.join(folder, d)) for d in set(os.listdir(folder)) - had if d.startswith("gapwise")]
    assert all(not [f for f in files if not f.startswith(".")] for files in left)
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) <= 1  # the fixture's own cache


def test_level_job_moves_sums_only(spark, points):
    """Between the table and the split search only partial sums are shuffled."""
    rows = points.selectExpr("1 AS class", "1 AS node", "1L AS g", "1L AS h", "CAST(NULL AS array<int>) AS positions", "array(0, 1, 2) AS bins")
    plan = gradient_histogram(rows)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan and "Python" not in plan
