"""From raw feature columns to the entries that a row has: positions and small integer bins."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, ShortType, StructField, StructType

from gapwise.functions.missing import present_or_null
from gapwise.operators.boost.splits import WHOLE
from gapwise.scratch import Scratch

MISSING_BIN = -1
MOST_BINS = 32_766
POINTS = 64  # points of a summary for each bin
HELD_ENTRIES = 1 << 17  # entries a task holds before it summarises them
HELD_POINTS = 1 << 19  # points of summaries a task holds before it merges them and hands them on
MERGED = 16  # summaries of a feature that are merged at once
ROWS_AT_ONCE = 1024  # rows of a batch whose entries are laid out at once
LINES_PER_BATCH = 16  # summaries that a task hands on at once
SUMMARY = "feature int, part int, exact boolean, value array<double>, weight array<double>"


def vector_size(df: DataFrame, column: str) -> int:
    """Number of entries, from the column's metadata or else from one row."""
    size = df.schema[column].metadata.get("ml_attr", {}).get("num_attrs")
    if size:
        return size
    parts = _parts(df, column)
    row = df.filter(F.col(column).isNotNull()).select(F.coalesce(parts["size"], F.size(parts["values"]))).first()
    if row is None:
        raise ValueError(f"column {column} has no vector to take the number of features from")
    return row[0]


def _parts(df: DataFrame, column: str) -> Column:
    c = F.col(column)
    return c if isinstance(df.schema[column].dataType, StructType) else F.unwrap_udt(c)


def vector_entries(df: DataFrame, column: str) -> Column:
    """The number of entries of each vector; null for a null vector."""
    parts = _parts(df, column)
    return F.when(F.col(column).isNotNull(), F.coalesce(parts["size"], F.size(parts["values"])))


def feature_columns(
    df: DataFrame, features: str | list[str], size: int = 0, absent: str = "missing", checked: bool = False, only: list[int] | None = None
) -> list[Column]:
    """One nullable double per feature, straight from number columns or out of a vector.

    ``absent`` says what an entry left out of a sparse vector means: ``missing``, or
    ``zero`` as in Spark's own algorithms. NaN is left as it is here. ``checked`` fails the
    job at a vector of another size. ``only`` names the features that are wanted.
    """
    wanted = range(size or len(features)) if only is None else only
    if not isinstance(features, str):
        return [F.col(features[i]).cast("double") for i in wanted]
    if absent not in ("missing", "zero"):
        raise ValueError("absent must be missing or zero")
    parts = _parts(df, features)
    columns = []
    for i in wanted:
        stored = F.get(parts["values"], (F.array_position(parts["indices"], i) - 1).cast("int"))
        if absent == "zero":
            stored = F.coalesce(stored, F.lit(0.0))
        value = F.when(parts["type"] == 1, F.get(parts["values"], F.lit(i))).otherwise(stored)
        if checked:
            wrong = F.raise_error(F.lit(f"a vector in {features} does not have {size} entries")).cast("double")
            value = F.when(vector_entries(df, features) != size, wrong).otherwise(value)
        columns.append(value)
    return columns


def apply_missing(columns: list[Column], missing: float) -> list[Column]:
    """Turn NaN, and entries equal to ``missing``, into null."""
    present = [present_or_null(c) for c in columns]
    return present if math.isnan(missing) else [F.nullif(c, F.lit(float(missing))) for c in present]


def stored_columns(df: DataFrame, features: str | list[str]) -> list[Column]:
    """``kind, size, indices, values`` of each row, as vectors are stored; number columns are a dense one.

    Indices that are not there are an empty array: writing null arrays to Arrow takes 20 times as long.
    """
    none = F.array().cast("array<int>")
    if isinstance(features, str):
        parts = _parts(df, features)
        return [parts["type"].alias("kind"), parts["size"].alias("size"), F.coalesce(parts["indices"], none).alias("indices"), parts["values"].alias("values")]
    values = F.array(*[F.col(c).cast("double") for c in features])
    return [F.lit(1).cast("tinyint").alias("kind"), F.lit(None).cast("int").alias("size"), none.alias("indices"), values.alias("values")]


class Entries:
    """The present entries of a batch of rows, flat: row by row their positions and values."""

    def __init__(self, kind: pa.Array, size: pa.Array, indices: pa.Array, values: pa.Array, missing: float, absent: str):
        length = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(values), 0))
        value = pa.compute.list_flatten(values).to_numpy(zero_copy_only=False).astype(np.float64)
        place = np.arange(len(value)) - np.repeat(np.cumsum(length) - length, length)
        sparse = np.asarray(pa.compute.fill_null(kind, 1)) == 0
        if sparse.any():
            inside = np.repeat(sparse, length)
            place[inside] = pa.compute.list_flatten(pa.compute.filter(indices, pa.array(sparse))).to_numpy(zero_copy_only=False)
            if absent == "zero":  # what is left out is there, as zeros
                wide = np.where(sparse, np.asarray(pa.compute.fill_null(size, 0)), length)
                start = np.cumsum(wide) - wide
                full = np.zeros(int(wide.sum()))
                full[np.repeat(start, length) + place] = value
                place, value, length = np.arange(len(full)) - np.repeat(start, wide), full, wide
        held = ~np.isnan(value) if math.isnan(missing) else ~np.isnan(value) & (value != missing)
        ends = np.concatenate([[0], np.cumsum(held)])
        upto = np.cumsum(length)
        self.lengths = ends[upto] - ends[upto - length]
        self.positions, self.values = place[held].astype(np.int32), value[held]


def cut_points(df: DataFrame, names: list[str], max_bins: int, weight: str | None = None) -> list[list[float]]:
    """Ascending split candidates for each of some number columns, see ``found_cuts``."""
    missing = [F.lit(1.0) if weight is None else F.col(weight).cast("double")]
    stored = df.select(*stored_columns(df, names), *[w.alias("weight") for w in missing])
    return found_cuts(stored, len(names), max_bins, math.nan, "missing")


def found_cuts(stored: DataFrame, size: int, max_bins: int, missing: float, absent: str) -> list[list[float]]:
    """Cuts by feature of rows ``kind, size, indices, values, weight``; a split sends ``x < cut`` to the left.

    At most features x bins numbers reach the driver, as the settings say, whatever the rows.

    Cuts stand at even steps of weight. Values that alone fill a bin or more get one of their own, and
    the other bins are spread over the rest, so a spike leaves cuts for what is beside it. A feature
    with few distinct values gets a cut at each of them, so that rare categories can still be told apart.

    Every task sums up its entries by feature in a quantile summary: values with the weight since the
    last one, exact while there are few, else at ``POINTS`` x bins even steps. Summaries merge by
    adding up and thinning out again, first those of a task, as its memory fills, then ``MERGED`` of one
    feature at a time, until they are few enough to be cut. What a task holds does not grow with its rows.
    Every thinning moves ranks by less than 1 / (POINTS x bins) of the weight.
    """
    points = POINTS * max_bins

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return summaries(batches, points, missing, absent)

    def merged(lines: pd.DataFrame) -> tuple[bool, np.ndarray, np.ndarray]:
        return merged_summary(list(lines[["exact", "value", "weight"]].itertuples(index=False, name=None)), points)

    def merge(key: tuple, lines: pd.DataFrame) -> pd.DataFrame:
        exact, value, weight = merged(lines)
        return pd.DataFrame({"feature": [key[0]], "part": [hash(key) % (1 << 30)], "exact": [exact], "value": [value], "weight": [weight]})

    def cut(key: tuple, lines: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"feature": [key[0]], "cuts": [spaced(*merged(lines), max_bins)]})

    read = stored.select("kind", "size", "indices", "values", F.col("weight").cast("double").alias("weight"))
    scratch = Scratch(read.sparkSession)
    lines, path = scratch.write(read.mapInArrow(summarise, SUMMARY))
    while (most := lines.groupBy("feature").count().agg(F.max("count")).first()[0] or 0) > MERGED:
        parts = lines.withColumn("part", F.pmod("part", F.lit(-(-most // MERGED))))
        lines, done = scratch.write(parts.groupBy("feature", "part").applyInPandas(merge, SUMMARY))
        scratch.drop(path)
        path = done
    found = {r["feature"]: list(r["cuts"]) for r in lines.groupBy("feature").applyInPandas(cut, "feature int, cuts array<double>").collect()}
    scratch.drop(path)
    return [found.get(i, []) for i in range(size)]


def summaries(batches: Iterator[pa.RecordBatch], points: int, missing: float, absent: str) -> Iterator[pa.RecordBatch]:
    """Batches of ``SUMMARY`` lines for batches of ``kind, size, indices, values, weight``, see ``found_cuts``."""
    held: list[tuple] = []  # flat entries
    waiting: dict[int, list[tuple]] = {}  # summaries by feature
    count = kept = 0
    task = TaskContext.get()
    draw = np.random.default_rng(task.partitionId() if task else 0)  # parts that differ between tasks

    def sum_up() -> int:
        place, value, weight = (np.concatenate([h[i] for h in held]) for i in range(3))
        held.clear()
        order = np.lexsort([value, place])
        place, value, weight = place[order], value[order], weight[order]
        edges = np.flatnonzero(np.diff(place, prepend=-1, append=np.iinfo(np.int32).max))
        added = 0
        for a, b in zip(edges, edges[1:]):
            line = thinned(value[a:b], weight[a:b], points)
            waiting.setdefault(int(place[a]), []).append(line)
            added += len(line[1])
        return added

    def handed_on() -> Iterator[pa.RecordBatch]:
        features = list(waiting)
        for at in range(0, len(features), LINES_PER_BATCH):
            part = features[at : at + LINES_PER_BATCH]
            lines = [merged_summary(waiting.pop(f), points) for f in part]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(part, pa.int32()),
                    pa.array(draw.integers(0, 1 << 30, len(part)), pa.int32()),
                    *[pa.array([line[k] for line in lines], t) for k, t in enumerate((pa.bool_(), pa.list_(pa.float64()), pa.list_(pa.float64())))],
                ],
                names=["feature", "part", "exact", "value", "weight"],
            )

    for batch in batches:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            some = batch.slice(at, ROWS_AT_ONCE)
            entries = Entries(*some.columns[:4], missing, absent)
            weight = np.repeat(some.column(4).to_numpy(zero_copy_only=False), entries.lengths)
            held.append((entries.positions, entries.values, weight))
            count += len(weight)
            if count > HELD_ENTRIES:
                kept, count = kept + sum_up(), 0
            if kept > HELD_POINTS:
                yield from handed_on()
                kept = 0
    if count:
        sum_up()
    yield from handed_on()


def merged_summary(lines: list[tuple[bool, np.ndarray, np.ndarray]], points: int) -> tuple[bool, np.ndarray, np.ndarray]:
    """One summary for several of the same feature."""
    if len(lines) == 1:
        return lines[0]
    value, weight = (np.concatenate([line[k] for line in lines]) for k in (1, 2))
    order = np.argsort(value, kind="stable")
    exact, value, weight = thinned(value[order], weight[order], points)
    return exact and all(bool(line[0]) for line in lines), value, weight


def thinned(value: np.ndarray, weight: np.ndarray, points: int) -> tuple[bool, np.ndarray, np.ndarray]:
    """(exact, values, weights since the value before): sorted values summed up, at most about 2 x points of them."""
    first = np.flatnonzero(np.diff(value, prepend=np.nan) != 0)
    value, weight = value[first], np.add.reduceat(weight, first)
    if len(value) <= points:
        return True, value, weight
    upto = np.cumsum(weight)
    steps = np.searchsorted(upto, np.arange(1, points + 1) * (upto[-1] / points))
    heavy = np.flatnonzero(weight * points >= upto[-1])  # keep what comes before a heavy value apart from it
    chosen = np.unique(np.concatenate([[0], steps, heavy, heavy - 1, [len(value) - 1]]).clip(0, len(value) - 1))
    return False, value[chosen], np.diff(upto[chosen], prepend=0.0)


def spaced(exact: bool, value: np.ndarray, weight: np.ndarray, max_bins: int) -> list[float]:
    """At most ``max_bins - 1`` cuts from a summary."""
    if len(value) <= max_bins:
        return value[1:].tolist()
    heavy = np.flatnonzero(weight * max_bins >= weight.sum())
    own = np.unique(np.concatenate([heavy, heavy + 1]))
    own = own[(own > 0) & (own < len(value))][: max_bins - 1]
    rest = np.setdiff1d(np.arange(1, len(value)), np.union1d(own, heavy))
    room = max_bins - 1 - len(own)
    if room and len(rest):
        upto = np.cumsum(weight[rest])
        # even steps through the weight of the rest, so the first cut leaves a share below it too
        steps = np.searchsorted(upto, (np.arange(room) + 1) * (upto[-1] / (room + 1)))
        own = np.union1d(own, rest[steps.clip(0, len(rest) - 1)])
    return value[own].tolist()


def binned_entries(cuts: list[list[float]], missing: float, absent: str):
    """A column function of ``kind, size, indices, values``: the entries of each row, in the smaller of two forms.

    A row with at least half of all features has one bin for each of them, -1 where it is missing, and no
    positions. A row with fewer has the positions and bins of those that are present. The first entry
    stands for the whole row, so that a node's totals come with its histogram.
    """
    arrays = [np.array(c, np.float64) for c in cuts]
    size_of = len(cuts)

    @F.arrow_udf(StructType([StructField("positions", ArrayType(IntegerType())), StructField("bins", ArrayType(ShortType()))]))
    def binned(kind: pa.Array, size: pa.Array, indices: pa.Array, values: pa.Array) -> pa.Array:
        entries = Entries(kind, size, indices, values, missing, absent)
        order = np.argsort(entries.positions, kind="stable")
        place, value = entries.positions[order], entries.values[order]
        edges = np.flatnonzero(np.diff(place, prepend=-1, append=np.iinfo(np.int32).max))
        sorted_bins = np.empty(len(place), np.int16)
        for a, b in zip(edges, edges[1:]):
            sorted_bins[a:b] = np.searchsorted(arrays[place[a]], value[a:b], side="right")
        bins = np.empty(len(place), np.int16)
        bins[order] = sorted_bins
        full = 2 * entries.lengths >= size_of
        inside = np.repeat(full, entries.lengths)
        within = np.arange(len(bins)) - np.repeat(np.cumsum(entries.lengths) - entries.lengths, entries.lengths)
        target = np.where(inside, entries.positions, within) + 1  # after the entry of the whole row

        def lists(length: np.ndarray, chosen: np.ndarray, content: np.ndarray, empty: int, whole: int, gone: np.ndarray | None) -> pa.Array:
            starts = np.cumsum(length) - length
            flat = np.full(int(length.sum()), empty, content.dtype)
            flat[starts[length > 0]] = whole
            flat[np.repeat(starts, entries.lengths)[chosen] + target[chosen]] = content[chosen]
            offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int32)
            return pa.ListArray.from_arrays(offsets, flat, mask=None if gone is None else pa.array(gone))

        return pa.StructArray.from_arrays(
            [
                lists(np.where(full, 0, entries.lengths + 1), ~inside, entries.positions, 0, WHOLE, full),
                lists(np.where(full, size_of, entries.lengths) + 1, np.ones(len(bins), bool), bins, MISSING_BIN, 0, None),
            ],
            names=["positions", "bins"],
        )

    return binned


def bin_columns(df: DataFrame, names: list[str], cuts: list[list[float]]) -> DataFrame:
    """Replace each feature by its bin: the number of cuts at or below it, or -1 if missing."""
    inner = [(n, c) for n, c in zip(names, cuts) if c]
    if inner:
        df = Bucketizer(
            splitsArray=[[float("-inf"), *c, float("inf")] for _, c in inner],
            inputCols=[n for n, _ in inner],
            outputCols=[f"_bin_{n}" for n, _ in inner],
            handleInvalid="keep",
        ).transform(df)
    small = "tinyint" if max((len(c) for c in cuts), default=0) < 127 else "smallint"
    bins = {
        n: F.when(F.col(n).isNull(), F.lit(MISSING_BIN)).otherwise(F.col(f"_bin_{n}") if c else F.lit(0)).cast(small)
        for n, c in zip(names, cuts)
    }
    return df.withColumns(bins).drop(*[f"_bin_{n}" for n, _ in inner])


def entry_arrays(df: DataFrame, names: list[str]) -> DataFrame:
    """Columns of bins, -1 for missing, as the entries of ``binned_entries``: all features, no positions."""
    bins = F.array(F.lit(0).cast("smallint"), *[F.col(n).cast("smallint") for n in names])
    return df.withColumns({"positions": F.lit(None).cast("array<int>"), "bins": bins})
