"""Frequency-ranked category dictionaries and the stages that apply them.

Rank 0 is the most frequent value; equal counts go in alphabetical order. A dictionary is a
table whatever its size: it is ranked by a range sort, saved with its model, and applied by a
join. A small one is broadcast; for a large one the rows of a frequent value are dealt to
several join tasks and null rows to all of them.
"""

from __future__ import annotations

import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasHandleInvalid, HasInputCol, HasInputCols, HasOutputCol, HasOutputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from gapwise.operators.stage import check_schema
from gapwise.scratch import Scratch

SALTS = 8  # join tasks that may share the rows of one value
BROADCAST_BYTES = 16 << 20  # of a dictionary in memory that goes to every executor
LINE_BYTES = 100  # of a dictionary's line in memory, besides its value
LINES_PER_TASK = 500_000  # lines of a repeated dictionary that one join task sorts
_ROW_BITS = 33  # monotonically_increasing_id keeps the row number in its low 33 bits


def category_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """``column, value, n`` for all columns from one scan and one shuffle of partial counts."""
    entries = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols]
    return (
        df.select(F.inline(F.array(*entries)))
        .filter(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def category_dictionary(counts: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """``column, value, n, idx``: the rank of each value within its column.

    Rows are sorted across range partitions, written once so that every row keeps its
    place, and numbered by partition offset plus place. No task sees more than its range,
    whatever the number of distinct values.
    """
    spark = counts.sparkSession
    scratch = scratch or Scratch(spark)
    order = [F.col("column"), F.desc("n"), F.col("value")]
    placed, _ = scratch.write(
        counts.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id())
    )
    placed = placed.withColumn("part", F.shiftright("place", _ROW_BITS)).withColumn(
        "row", F.col("place") - F.shiftleft("part", _ROW_BITS)
    )
    # One line per (range partition, column): its rows and the first row number in the range.
    runs = placed.groupBy("part", "column").agg(F.count(F.lit(1)).alias("rows"), F.min("row").alias("first"))
    runs = runs.collect()
    starts, seen = [], {}
    for part, column, rows, first in sorted((r["part"], r["column"], r["rows"], r["first"]) for r in runs):
        starts.append((part, column, seen.get(column, 0) - first))
        seen[column] = seen.get(column, 0) + rows
    offsets = spark.createDataFrame(starts, "part bigint, column string, shift bigint")
    return (
        placed.join(F.broadcast(offsets), ["part", "column"])
        .select("column", "value", "n", (F.col("row") + F.col("shift")).alias("idx"))
    )


def ordinal_indexer(labels: list[str], inputCol: str, outputCol: str, handleInvalid: str = "keep") -> StringIndexerModel:
    """Index a category by an order the caller knows, instead of by frequency."""
    return StringIndexerModel.from_labels(labels, inputCol, outputCol, handleInvalid)


class LabelModel(Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Indexes the label and drops rows without a known one.

    A frame that has no label column at all passes through, so that a fitted pipeline can
    score rows whose label is not known yet.
    """

    labelsInOrder = Param(
        Params._dummy(), "labelsInOrder", "label texts by index", typeConverter=TypeConverters.toListString
    )

    @keyword_only
    def __init__(self, *, inputCol=None, outputCol="label", labelsInOrder=None):
        super().__init__()
        self._set(**self._input_kwargs)

    @property
    def labels(self) -> list[str]:
        return self.getOrDefault("labelsInOrder")

    def _transform(self, df: DataFrame) -> DataFrame:
        if self.getInputCol() not in df.columns:
            return df
        inner = StringIndexerModel.from_labels(self.labels, self.getInputCol(), self.getOutputCol(), "skip")
        return inner.transform(df)


def label_indexer(df: DataFrame, inputCol: str, outputCol: str = "label") -> LabelModel:
    """Index the label by frequency; rows without one are dropped."""
    fitted = StringIndexer(inputCol=inputCol, outputCol=outputCol, handleInvalid="skip").fit(df)
    return LabelModel(inputCol=inputCol, outputCol=outputCol, labelsInOrder=list(fitted.labels))


def label_text(labels: list[str], inputCol: str = "prediction", outputCol: str = "predicted_income") -> IndexToString:
    """Turn a predicted index back into its label."""
    return IndexToString(inputCol=inputCol, outputCol=outputCol, labels=labels)


class CategoryIndexer(
    Estimator, HasInputCols, HasOutputCols, HasHandleInvalid, DefaultParamsReadable, DefaultParamsWritable
):
    """Frequency-ranked indices for several string columns, fitted in one job.

    ``keep`` gives null and unseen values the index after the last label, ``skip`` drops
    their rows and ``error`` fails.
    """

    @keyword_only
    def __init__(self, *, inputCols=None, outputCols=None, handleInvalid="keep"):
        super().__init__()
        self._setDefault(handleInvalid="keep")
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "CategoryModel":
        cols, outs = self.getInputCols(), self.getOutputCols()
        check_schema(df.schema, cols, outs, numeric=False)
        scratch = Scratch(df.sparkSession)
        table, path = scratch.write(category_dictionary(category_counts(df, cols), scratch))
        scratch.keep_only(path)
        facts = table.groupBy("column").agg(F.count("*").alias("size"), F.sum(F.octet_length("value")).alias("bytes")).collect()
        sizes, widths = ({r["column"]: r[k] for r in facts} for k in ("size", "bytes"))
        return CategoryModel(
            inputCols=cols,
            outputCols=outs,
            handleInvalid=self.getHandleInvalid(),
            dictionaryPath=path,
            sizes=[sizes.get(c, 0) for c in cols],
            valueBytes=[float(widths.get(c, 0)) for c in cols],
        )


class _TableWriter(DefaultParamsWriter):
    """Stores the dictionary beside the metadata, so that a saved model stands alone."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        table = self.sparkSession.read.parquet(self.instance.getOrDefault("dictionaryPath"))
        table.write.parquet(f"{path}/{_TABLE}")


class _TableReader(DefaultParamsReader):
    def load(self, path: str):
        return super().load(path)._set(dictionaryPath=f"{path}/{_TABLE}")


_TABLE = "dictionary"


class CategoryModel(Model, HasInputCols, HasOutputCols, HasHandleInvalid, DefaultParamsReadable, DefaultParamsWritable):
    """Applies a dictionary table (``column, value, n, idx``); a column the frame lacks is passed over.

    Every index column says in its metadata that it is nominal and how many values it has.
    """

    dictionaryPath = Param(
        Params._dummy(), "dictionaryPath", "parquet table of the dictionary", typeConverter=TypeConverters.toString
    )
    sizes = Param(Params._dummy(), "sizes", "number of labels per column", typeConverter=TypeConverters.toListInt)
    valueBytes = Param(
        Params._dummy(), "valueBytes", "bytes of all labels per column; unset: not known", typeConverter=TypeConverters.toListFloat
    )

    @keyword_only
    def __init__(
        self, *, inputCols=None, outputCols=None, handleInvalid="keep", dictionaryPath=None, sizes=None, valueBytes=None
    ):
        super().__init__()
        self._setDefault(handleInvalid="keep")
        self._set(**self._input_kwargs)

    def write(self) -> DefaultParamsWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> DefaultParamsReader:
        return _TableReader(cls)

    def _transform(self, df: DataFrame) -> DataFrame:
        names = {c.lower() for c in df.columns}
        sizes = self.getOrDefault("sizes")
        widths = self.getOrDefault("valueBytes") if self.isSet("valueBytes") else [math.inf] * len(sizes)
        held = [x for x in zip(self.getInputCols(), self.getOutputCols(), sizes, widths) if x[0].lower() in names]
        check_schema(df.schema, [c for c, *_ in held], [o for _, o, *_ in held], numeric=False)
        table = df.sparkSession.read.parquet(self.getOrDefault("dictionaryPath"))
        policy = self.getHandleInvalid()
        for column, out, size, width in held:
            small = width + LINE_BYTES * size <= BROADCAST_BYTES
            df = _attach_index(df, column, out, table.filter(F.col("column") == column), size, small)
            if policy == "skip":
                df = df.filter(F.col(out) < size)
            elif policy == "error":
                failure = F.raise_error(F.lit(f"null or unseen value in column {column}")).cast("double")
                df = df.withColumn(out, F.when(F.col(out) < size, F.col(out)).otherwise(failure))
            values = size + (1 if policy == "keep" else 0)
            df = df.withMetadata(out, {"ml_attr": {"type": "nominal", "name": out, "num_vals": values}})
        return df


def _attach_index(df: DataFrame, column: str, out: str, dictionary: DataFrame, size: int, small: bool) -> DataFrame:
    value, index = F.col(column).cast("string"), F.col("idx").cast("double").alias("_found")
    if small:
        keyed = df.withColumn("_key", value)
        found = F.broadcast(dictionary.select(F.col("value").alias("_key"), index))
    else:
        keyed, found = _dealt(df, value, dictionary, index, size)
    joined = keyed.join(found, "_key", "left")
    return joined.withColumn(out, F.coalesce("_found", F.lit(float(size)))).drop("_key", "_found")


def _dealt(df: DataFrame, value: Column, dictionary: DataFrame, index: Column, size: int) -> tuple[DataFrame, DataFrame]:
    # Null rows need no match: they get keys of their own kind, spread by content. Rows of one
    # value, seen or not, are dealt to SALTS keys, which the dictionary is repeated for. Both sides
    # are dealt to as many tasks as the repeated dictionary calls for and joined by sorting: its file is
    # small enough for Spark to broadcast it while its repeated lines fill each executor.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lanes = 16 * parts
    parts = max(parts, -(-SALTS * size // LINES_PER_TASK))
    content = [f.name for f in df.schema.fields if isinstance(f.dataType, AtomicType)]
    spread = F.xxhash64(F.spark_partition_id(), *content)
    own = F.concat(F.pmod(spread, F.lit(SALTS)).cast("string"), F.lit("="), value)
    keyed = df.withColumn("_key", F.coalesce(own, F.concat(F.lit("~"), F.pmod(spread, F.lit(lanes)).cast("string"))))
    salted = dictionary.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))).select(
        F.concat(F.col("_salt").cast("string"), F.lit("="), F.col("value")).alias("_key"), index
    )
    return keyed.repartition(parts, "_key"), salted.repartition(parts, "_key").hint("merge")


def rare_to_other(df: DataFrame, column: str, out: str, min_share: float, other: str = "other") -> DataFrame:
    """Keep values that make up at least ``min_share`` of the present rows; the rest become ``other``.

    At most ``1 / min_share`` values can qualify, which bounds the list sent to every task.
    Null stays null.
    """
    if not 0 < min_share <= 1:
        raise ValueError("min_share must be above 0 and at most 1")
    check_schema(df.schema, [column], [out], numeric=False)
    counts = category_counts(df, [column]).persist()
    try:
        total = counts.agg(F.sum("n")).first()[0] or 0
        kept = [r["value"] for r in counts.filter(F.col("n") >= min_share * total).collect()]
    finally:
        counts.unpersist()
    c = F.col(column)
    return df.withColumn(out, F.when(c.isNull() | c.cast("string").isin(kept), c.cast("string")).otherwise(other))


def read_dictionary(spark: SparkSession, model: CategoryModel) -> DataFrame:
    """The dictionary table of a fitted ``CategoryModel``."""
    return spark.read.parquet(model.getOrDefault("dictionaryPath"))
