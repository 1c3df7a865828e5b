"""Missing-aware boosted trees with the softmax objective.

Rows are binned once, into the positions and bins of the entries they have, and kept as a
compact table in the shared checkpoint folder, cached once. Each tree level is one Spark job: rows
are routed, differentiated and summed into a histogram (``splits``), and one line per node comes back.
Below the root only the lighter child of each node is summed; its sibling is what remains of the
parent. A row's margins are those of the table moved by the trees grown since; every few rounds the
table is written anew, so no lineage grows with the number of rounds and a lost executor costs
its own partitions, recomputed from the last written table.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import (
    HasFeaturesCol,
    HasLabelCol,
    HasPredictionCol,
    HasProbabilityCol,
    HasRawPredictionCol,
    HasSeed,
)
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from gapwise.functions.missing import NAN
from gapwise.operators.boost import features as ft
from gapwise.operators.boost import splits as sp
from gapwise.operators.boost.trees import Tree, among, descended, margin_columns, weight_at
from gapwise.scratch import Scratch

ROWS_PER_PARTITION = 4_000_000  # binned rows are a few bytes per feature
LEVELS_WALKED = 6
TABLE = "boost_rows"  # the training table, in the session of the level jobs
LINES_PER_REDUCER = 1_000_000  # histogram lines that one task merges

# Option names of the settings map, and the parameter each one sets.
_OPTIONS = {
    "eta": "eta",
    "max_depth": "maxDepth",
    "objective": "objective",
    "num_class": "numClass",
    "num_round": "numRound",
    "num_workers": "numWorkers",
    "seed": "seed",
    "missing": "missing",
    "allow_non_zero_for_missing": "allowNonZeroForMissing",
    "allow_non_zero_for_missing_value": "allowNonZeroForMissing",
    "lambda": "regLambda",
    "gamma": "gamma",
    "min_child_weight": "minChildWeight",
    "max_bins": "maxBins",
}


def _param(name: str, doc: str, convert) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=convert)


class _BoostParams(
    HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, HasSeed
):
    inputCols = _param(
        "inputCols", "number columns to train on directly, instead of a vector", TypeConverters.toListString
    )
    numClass = _param("numClass", "number of classes", TypeConverters.toInt)
    missing = _param("missing", "value that counts as missing besides NaN and absence", TypeConverters.toFloat)
    absent = _param("absent", "meaning of an absent sparse entry: missing or zero", TypeConverters.toString)

    def _features(self) -> str | list[str]:
        return self.getOrDefault("inputCols") if self.isSet("inputCols") else self.getFeaturesCol()


class BoostedTreeClassifier(Estimator, _BoostParams, DefaultParamsReadable, DefaultParamsWritable):
    """Boosted trees that learn at each split which side missing values belong to.

    Missing is NaN, null, an entry absent from a sparse vector and, if set, the value
    ``missing``. A ``missing`` other than 0 on a vector column needs
    ``allowNonZeroForMissing``, since an assembler may have left out zeros; ``missing=0``
    fails if NaN is present too. Training draws no random numbers, so ``seed`` is accepted
    but changes nothing.

    With two classes the trees of class 0 are those of class 1 with the sign of every
    weight turned, because the derivatives are; only class 1 is grown.
    """

    eta = _param("eta", "weight of each tree", TypeConverters.toFloat)
    maxDepth = _param("maxDepth", "levels of splits per tree", TypeConverters.toInt)
    numRound = _param("numRound", "boosting rounds", TypeConverters.toInt)
    objective = _param("objective", "multi:softprob", TypeConverters.toString)
    regLambda = _param("regLambda", "added to the second-derivative sum of every node", TypeConverters.toFloat)
    gamma = _param("gamma", "gain a split must exceed", TypeConverters.toFloat)
    minChildWeight = _param("minChildWeight", "least second-derivative sum of a child", TypeConverters.toFloat)
    maxBins = _param("maxBins", "bins per feature", TypeConverters.toInt)
    numWorkers = _param("numWorkers", "least number of partitions; rows and cores may call for more", TypeConverters.toInt)
    allowNonZeroForMissing = _param(
        "allowNonZeroForMissing", "consent to a missing value other than 0", TypeConverters.toBoolean
    )
    rewriteInterval = _param("rewriteInterval", "rounds between rewrites of the training table", TypeConverters.toInt)
    cutPoints = _param("cutPoints", "JSON list of cut points per feature; found if unset", TypeConverters.toString)

    @keyword_only
    def __init__(
        self,
        *,
        featuresCol="features",
        inputCols=None,
        labelCol="label",
        predictionCol="prediction",
        probabilityCol="probability",
        rawPredictionCol="rawPrediction",
        eta=0.3,
        maxDepth=3,
        numRound=100,
        numClass=2,
        objective="multi:softprob",
        regLambda=1.0,
        gamma=0.0,
        minChildWeight=1.0,
        maxBins=256,
        numWorkers=0,
        missing=NAN,
        absent="missing",
        allowNonZeroForMissing=False,
        rewriteInterval=2,
        cutPoints=None,
        seed=0,
    ):
        super().__init__()
        kwargs = self._input_kwargs
        self._setDefault(
            eta=0.3,
            maxDepth=3,
            numRound=100,
            numClass=2,
            objective="multi:softprob",
            regLambda=1.0,
            gamma=0.0,
            minChildWeight=1.0,
            maxBins=256,
            numWorkers=0,
            missing=NAN,
            absent="missing",
            allowNonZeroForMissing=False,
            rewriteInterval=2,
            seed=0,
        )
        self._set(**kwargs)

    @classmethod
    def from_options(cls, options: dict, **params) -> "BoostedTreeClassifier":
        """Build from a settings map such as ``{"eta": 0.3, "max_depth": 3, "missing": 0}``."""
        unknown = set(options) - set(_OPTIONS)
        if unknown:
            raise ValueError(f"unknown options: {sorted(unknown)}")
        chosen = {_OPTIONS[k]: v for k, v in options.items()}
        if isinstance(chosen.get("allowNonZeroForMissing"), str):
            chosen["allowNonZeroForMissing"] = chosen["allowNonZeroForMissing"].lower() == "true"
        return cls(**chosen, **params)

    def setFeaturesCol(self, value: str):
        return self._set(featuresCol=value)

    def setLabelCol(self, value: str):
        return self._set(labelCol=value)

    def _check(self) -> None:
        get = self.getOrDefault
        if get("objective") != "multi:softprob":
            raise ValueError("the only objective is multi:softprob")
        if get("numClass") < 2 or get("maxDepth") < 1 or get("numRound") < 1 or get("maxBins") < 2:
            raise ValueError("numClass and maxBins must be at least 2, maxDepth and numRound at least 1")
        if get("maxBins") > ft.MOST_BINS:
            raise ValueError(f"maxBins is at most {ft.MOST_BINS}, since bins are small integers")
        if not self.isSet("inputCols") and get("missing") != 0 and not get("allowNonZeroForMissing"):
            raise ValueError("missing is not 0: set allowNonZeroForMissing to agree that absent zeros count as missing")

    def _fit(self, df: DataFrame) -> "BoostedTreeModel":
        self._check()
        spark, get = df.sparkSession, self.getOrDefault
        chosen = self._features()
        size = len(chosen) if isinstance(chosen, list) else ft.vector_size(df, chosen)
        label = F.col(self.getLabelCol())
        stored = df.select(
            label.cast("int").alias("y"),
            (label.isNull() | ~label.isin(list(range(get("numClass"))))).alias("bad"),
            (F.lit(size) if isinstance(chosen, list) else ft.vector_entries(df, chosen)).alias("entries"),
            *ft.stored_columns(df, chosen),
        )
        stored = stored.persist(StorageLevel.MEMORY_AND_DISK)  # three passes, one evaluation of the source
        try:
            cuts, rows, held = self._facts(stored, size)
            binned = ft.binned_entries(cuts, get("missing"), get("absent"))
            entries = stored.select("y", binned("kind", "size", "indices", "values").alias("e")).select("y", "e.positions", "e.bins")
            trees = self._grow(spark, entries, cuts, rows, held, stored)
        finally:
            stored.unpersist()
        model = BoostedTreeModel(
            trees=json.dumps([t.as_dict() for t in trees]),
            numFeatures=size,
            **{p: get(p) for p in ("labelCol", "numClass", "missing", "absent")},
            **{p: get(p) for p in ("featuresCol", "predictionCol", "probabilityCol", "rawPredictionCol")},
        )
        if isinstance(chosen, list):
            model._set(inputCols=chosen)
        return model

    def _facts(self, stored: DataFrame, size: int) -> tuple[list[list[float]], int, int]:
        """Cut points, rows and stored entries, after checking what must hold before training."""
        get = self.getOrDefault
        given = json.loads(get("cutPoints")) if self.isSet("cutPoints") else None
        nan_seen = F.exists("values", F.isnan) if get("missing") == 0 else F.lit(False)
        facts = stored.agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if("bad").alias("bad"),
            F.max(nan_seen).alias("nan_seen"),
            F.min("entries").alias("least_entries"),
            F.max("entries").alias("most_entries"),
            F.sum(F.greatest(F.size("values"), F.lit(0)) if get("absent") == "missing" else F.lit(size)).alias("held"),
        ).first()
        if facts["rows"] == 0:
            raise ValueError("no rows to train on")
        if facts["least_entries"] is not None and not facts["least_entries"] == facts["most_entries"] == size:
            raise ValueError(f"vectors have {facts['least_entries']} to {facts['most_entries']} entries, expected {size}")
        if facts["bad"]:
            raise ValueError(f"{facts['bad']} rows have a label that is null or not one of 0..{get('numClass') - 1}")
        if facts["nan_seen"]:
            raise ValueError("missing is 0 but the features hold NaN as well; replace one of the two first")
        if given:
            cuts = [sorted(float(v) for v in c) for c in given]
            if len(cuts) != size:
                raise ValueError(f"cutPoints has {len(cuts)} lists for {size} features")
        else:
            # every row weighs the same: before the first tree all second derivatives are equal
            weighed = stored.withColumn("weight", F.lit(1.0))
            cuts = ft.found_cuts(weighed, size, get("maxBins"), get("missing"), get("absent"))
        return cuts, facts["rows"], facts["held"]

    def _grow(self, spark: SparkSession, binned: DataFrame, cuts: list[list[float]], rows: int, held: int, source: DataFrame) -> list[Tree]:
        get = self.getOrDefault
        classes = [1] if get("numClass") == 2 else list(range(get("numClass")))
        scale = sp.fixed_point_scale(rows)
        parts = max(get("numWorkers"), self._partitions(spark, rows))
        # rounds whose trees one expression walks: with more levels the code of a task outgrows what the JVM compiles
        # (measured: 450 ms instead of 40 for 118,000 rows with three trees of depth 3 instead of one)
        interval = max(1, min(get("rewriteInterval"), LEVELS_WALKED // (len(classes) * get("maxDepth"))))
        # The level jobs have a known, small shuffle, so they run in a session of their own
        # that is tuned for it; the caller's settings stay as they are.
        levels = spark.newSession()
        levels.conf.set("spark.sql.adaptive.enabled", "false")
        # Every task of a level hands on at most a line for each node, feature and bin, and all tasks one for each entry.
        lines = len(classes) * min(2 ** (get("maxDepth") - 1) * sum(len(c) + 2 for c in cuts) * parts, held + rows)
        reducers = max(1, -(-lines // LINES_PER_REDUCER))
        levels.conf.set("spark.sql.shuffle.partitions", str(reducers))
        scratch = Scratch(levels)
        table, path = scratch.write(binned.withColumns({f"m{k}": F.lit(0.0) for k in classes}).repartition(parts))
        source.unpersist()
        table = table.persist(StorageLevel.MEMORY_AND_DISK)
        table.createOrReplaceTempView(TABLE)
        trees: list[Tree] = []
        since: list[dict[int, Tree]] = []  # trees by class, of the rounds after the table was written
        try:
            for number in range(get("numRound")):
                if len(since) == interval:
                    moved, new_path = scratch.write(levels.sql(_moved(TABLE, since, get("maxDepth"))))
                    table.unpersist()
                    scratch.drop(path)
                    table, path, since = moved.persist(StorageLevel.MEMORY_AND_DISK), new_path, []
                    table.createOrReplaceTempView(TABLE)
                growing = {k: Tree(number, k) for k in classes}
                # as many trees in every round, some empty: then the code of a level is the same each time
                walked = since + [{k: Tree.empty(number, k) for k in classes}] * (interval - 1 - len(since))
                self._grow_round(levels, TABLE, walked, cuts, growing, scale, reducers, scratch)
                since.append(growing)
                trees += growing.values()
        finally:
            table.unpersist()
            scratch.drop(path)
            levels.catalog.dropTempView(TABLE)
            levels.catalog.dropTempView("boost_above")
        return trees

    def _grow_round(
        self, levels: SparkSession, table: str, since: list[dict[int, Tree]], cuts: list[list[float]], growing: dict[int, Tree], scale: float, reducers: int, scratch: Scratch
    ) -> None:
        """Grow one tree for each class, level by level; the histogram of a level is a table."""
        get = self.getOrDefault
        rules = (scale, get("regLambda"), get("gamma"), get("minChildWeight"), reducers)
        count = {k: {1} for k in growing}  # nodes whose rows are summed
        heavy, totals, written = {}, None, []
        for depth in range(get("maxDepth")):
            sums = sp.histogram_text(f"({_derivatives(_moved(table, since, get('maxDepth')), growing, depth, scale, count)})")
            if depth:
                sums = sp.siblings_text(f"({sums})", "boost_above", _by_node(heavy, growing, depth - 1), reducers)
            sums = f"({sums})"
            if depth + 1 < get("maxDepth") or not depth:  # read again, for the siblings below
                above, path = scratch.write(levels.sql(sums))
                above.createOrReplaceTempView("boost_above")
                sums = "boost_above"
                written.append(path)
            best = levels.sql(sp.best_text(f"({sp.candidates_text(sums, *rules, totals)})")).collect()
            if depth == 0:
                for row in best:
                    growing[row["class"]].weights[1] = self._weight(row["all_g"] / scale, row["all_h"] / scale)
            best = [row for row in best if row["gain"] is not None]
            if not best:
                break
            count, heavy, totals = self._split(best, cuts, growing, scale)
        for path in written:
            scratch.drop(path)

    def _split(self, best: list, cuts: list[list[float]], growing: dict[int, Tree], scale: float) -> tuple[dict, dict, dict]:
        """Record the splits; return the lighter children by class, the heavier one of each split node, and all children's sums."""
        light: dict[int, set[int]] = {k: set() for k in growing}
        heavy, totals = {}, {}
        for row in best:
            k, node = row["class"], row["node"]
            tree, feature_cuts = growing[k], cuts[row["feature"]]
            tree.splits[node] = {
                "feature": row["feature"],
                "bin": row["bin"],
                "threshold": feature_cuts[row["bin"]] if row["bin"] < len(feature_cuts) else None,
                "default_left": row["default_left"],
                "gain": row["gain"],
            }
            del tree.weights[node]
            left = (row["sum_g"], row["sum_h"], row["left_n"])
            right = (row["all_g"] - row["sum_g"], row["all_h"] - row["sum_h"], row["n"] - row["left_n"])
            for child, sums in ((2 * node, left), (2 * node + 1, right)):
                tree.weights[child] = self._weight(sums[0] / scale, sums[1] / scale)
                totals[k, child] = sums
            lighter = 2 * node + int(right[2] < left[2])
            light[k].add(lighter)
            heavy[k, node] = lighter ^ 1
        return light, heavy, totals

    @staticmethod
    def _partitions(spark: SparkSession, rows: int) -> int:
        """Even partitions for the many passes to come, whatever the layout of the source."""
        return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_PARTITION))

    def _weight(self, g: float, h: float) -> float:
        return -self.getOrDefault("eta") * g / (h + self.getOrDefault("regLambda"))


def _moved(table: str, since: list[dict[int, Tree]], depth: int) -> str:
    """SQL text for the training table with its margins moved by the trees grown since it was written."""
    if not since:
        return f"SELECT * FROM {table}"
    trees = {f"_{k}_{j}": t for j, grown in enumerate(since) for k, t in grown.items()}
    margins = [f"{' + '.join([f'm{k}', *[weight_at(grown[k], depth, f'_{k}_{j}') for j, grown in enumerate(since)]])} AS m{k}" for k in since[0]]
    walked = descended(table, ["y", "positions", "bins", *[f"m{k}" for k in since[0]]], trees, depth)
    return f"SELECT y, positions, bins, {', '.join(margins)} FROM ({walked})"


def _by_node(values: dict[tuple[int, int], int], classes, depth: int) -> str:
    """SQL text for what ``values`` hold for the line's class and node of one level; else null."""
    lists = [[values.get((k, n)) for n in range(2**depth, 2 ** (depth + 1))] for k in range(max(classes) + 1)]
    flat = ", ".join("CAST(NULL AS INT)" if v is None else str(v) for values in lists for v in values)
    return f"get(array({flat}), class * {2**depth} + node - {2**depth})"


def _derivatives(table: str, growing: dict[int, Tree], depth: int, scale: float, count: dict[int, set[int]]) -> str:
    """SQL text for ``class, node, g, h, positions, bins`` of the rows of each modelled class in the nodes to ``count``."""
    walked = descended(f"({table})", ["y", "positions", "bins", *[f"m{k}" for k in growing]], {f"_{k}": t for k, t in growing.items()}, depth)
    if len(growing) == 1:
        share = {k: f"1 / (1 + exp(-2 * m{k}))" for k in growing}
    else:
        top = ", ".join(f"m{k}" for k in growing)
        walked = f"SELECT *, {', '.join(f'exp(m{k} - greatest({top})) AS e{k}' for k in growing)} FROM ({walked})"
        share = {k: f"e{k} / ({' + '.join(f'e{j}' for j in growing)})" for k in growing}
    # lines of an array, so that the test for the nodes is not evaluated a second time below
    lines = ", ".join(f"struct({k} AS class, if({among(count[k], depth, f'_{k}')}, n_{k}, NULL) AS node, {share[k]} AS p)" for k in growing)
    return f"""
      SELECT class, node, {sp.fixed_point('p - if(y = class, 1D, 0D)', scale)} AS g, {sp.fixed_point('2 * p * (1 - p)', scale)} AS h, positions, bins
      FROM (SELECT y, positions, bins, inline(array({lines})) FROM ({walked})) WHERE node IS NOT NULL"""


class BoostedTreeModel(Model, _BoostParams, DefaultParamsReadable, DefaultParamsWritable):
    """Scores rows over Arrow batches of the used features; a value missing here takes each split's own side."""

    trees = _param("trees", "the trees as JSON", TypeConverters.toString)
    numFeatures = _param("numFeatures", "number of features", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self,
        *,
        trees=None,
        numFeatures=None,
        featuresCol="features",
        inputCols=None,
        labelCol="label",
        predictionCol="prediction",
        probabilityCol="probability",
        rawPredictionCol="rawPrediction",
        numClass=2,
        missing=NAN,
        absent="missing",
    ):
        super().__init__()
        kwargs = self._input_kwargs
        self._setDefault(numClass=2, missing=NAN, absent="missing")
        self._set(**kwargs)

    def tree_list(self) -> list[Tree]:
        return [Tree.from_dict(d) for d in json.loads(self.getOrDefault("trees"))]

    def tree_table(self, spark: SparkSession) -> DataFrame:
        """One line per node: its split, or its weight if it is a leaf."""
        rows = []
        for t in self.tree_list():
            for n in sorted(set(t.splits) | set(t.weights)):
                s = t.splits.get(n, {})
                rows.append(
                    (t.round, t.label_class, n, *[s.get(f) for f in ("feature", "bin", "threshold", "default_left", "gain")], t.weights.get(n))
                )
        return spark.createDataFrame(
            rows,
            "round int, class int, node int, feature int, bin int, threshold double, "
            "default_left boolean, gain double, weight double",
        )

    def feature_gain(self, spark: SparkSession) -> DataFrame:
        """Total gain and number of splits per feature."""
        return (
            self.tree_table(spark)
            .filter(F.col("feature").isNotNull())
            .groupBy("feature")
            .agg(F.sum("gain").alias("gain"), F.count(F.lit(1)).alias("splits"))
        )

    def _transform(self, df: DataFrame) -> DataFrame:
        get = self.getOrDefault
        size, k = get("numFeatures"), get("numClass")
        used = sorted({s["feature"] for t in self.tree_list() for s in t.splits.values()})
        columns = ft.apply_missing(ft.feature_columns(df, self._features(), size, get("absent"), checked=True, only=used), get("missing"))
        temporary = [f"_x{i}" for i in used]
        values = {i: F.col(f"_x{i}") for i in used}
        if k == 2:
            raw = [-F.col("_m1"), F.col("_m1")]
        else:
            raw = [F.col(f"_m{c}") for c in range(k)]
        margins = {f"_m{c}": m for c, m in margin_columns(self.tree_list(), values).items()}
        top = F.greatest(*[F.col(f"_r{c}") for c in range(k)])
        powers = {f"_e{c}": F.exp(F.col(f"_r{c}") - top) for c in range(k)}
        total = sum((F.col(f"_e{c}") for c in range(k)), F.lit(0.0))
        scored = (
            df.withColumns(dict(zip(temporary, columns)))
            .withColumns(margins)
            .withColumns({f"_r{c}": raw[c] for c in range(k)})
            .withColumns(powers)
            .withColumns(
                {
                    get("rawPredictionCol"): array_to_vector(F.array(*[F.col(f"_r{c}") for c in range(k)])),
                    get("probabilityCol"): array_to_vector(F.array(*[F.col(f"_e{c}") / total for c in range(k)])),
                    get("predictionCol"): (
                        F.array_position(F.array(*[F.col(f"_r{c}") for c in range(k)]), top) - 1
                    ).cast("double"),
                }
            )
        )
        return scored.drop(*temporary, *margins, *[f"_r{c}" for c in range(k)], *powers)
