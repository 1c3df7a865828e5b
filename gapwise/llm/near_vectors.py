"""Near-duplicate vectors by Euclidean p-stable hashing.

Vectors are scaled to length one, so a cosine bound is a bound on Euclidean distance. Each of
``tables`` hash tables joins ``projections`` Gaussian projections, shifted and cut into
intervals of ``width``. Vectors that meet in a bucket are compared exactly, in doubles. At a
cosine of 0.95 a pair misses all buckets of the defaults with a probability of 0.001, at 0.97
of 0.00001.

Equal vectors are one class with a count. A bucket is worked off in blocks of at most
``block`` classes: a pair of blocks is one unit of work, compared as a matrix product, so a
bucket that holds a third of all vectors is spread over tasks. Units return sums, not pairs: for
each class the links it found that no earlier table has (both vectors' codes of all tables
travel along), and its nearest way to the unit's smallest linked class for the components.

Defined results: null, zero and empty vectors and those with null or non-finite entries are
linked with nothing; vectors of different lengths are never linked; rows without an id are
linked with nothing and have a null component; repeated rows are vectors of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gapwise.llm.common import mix
from gapwise.llm.components import components
from gapwise.scratch import Scratch


def _codes(vectors: np.ndarray, tables: int, projections: int, width: float, seed: int) -> np.ndarray:
    """32-bit bucket codes, one column for each table."""
    rng = np.random.default_rng([seed, vectors.shape[1]])
    planes = rng.standard_normal((vectors.shape[1], tables * projections))
    shift = rng.uniform(0, width, tables * projections)
    cells = np.floor((vectors @ planes + shift) / width).astype(np.int64).astype(np.uint64)
    out = np.zeros((len(vectors), tables), np.uint64)
    for p in range(projections):
        out = mix(out * np.uint64(31) + cells[:, p::projections] + np.uint64(1))
    return (out >> np.uint64(32)).astype(np.uint32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows * rows).sum(axis=1))[:, None]


def _coded(classes: DataFrame, tables: int, projections: int, width: float, seed: int) -> DataFrame:
    """(id, codes): the codes of a class as 4 bytes for each table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            sizes = np.diff(vectors.offsets.to_numpy())
            flat = vectors.flatten().to_numpy(zero_copy_only=False)
            starts = np.cumsum(np.append(0, sizes))
            for size in np.unique(sizes):
                at = np.flatnonzero(sizes == size)
                for k in range(0, len(at), 2048):
                    part = at[k : k + 2048]
                    rows = _unit(np.stack([flat[starts[i] : starts[i + 1]] for i in part]))
                    codes = _codes(rows, tables, projections, width, seed)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[part]), pa.array([c.astype("<u4").tobytes() for c in codes], pa.binary())], names=["id", "codes"]
                    )

    return classes.select("id", "vector").mapInArrow(run, "id long, codes binary")


def _keys(coded: DataFrame) -> DataFrame:
    def run(batches):
        for batch in batches:
            if batch.num_rows:
                codes = np.frombuffer(b"".join(batch.column(1).to_pylist()), "<u4").reshape(batch.num_rows, -1)
                table = np.arange(codes.shape[1], dtype=np.int64)
                keys = (table[None, :] << 32) | codes.astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(zero_copy_only=False), len(table)))], names=["key", "id"]
                )

    return coded.mapInArrow(run, "key long, id long")


def _roots(n: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Smallest member of each of n places' groups, for links among them."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[left], root[right])
        new = root.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _compared(units: DataFrame, cosine: float) -> DataFrame:
    """Rows (key, i, j, own, id, copies, vector, codes), dealt and sorted by unit, to (id, links, near)."""

    def work(parts):
        table = parts["key"][0] >> 32
        order = np.argsort(parts["id"], kind="stable")
        ids, copies, own = parts["id"][order], parts["copies"][order], parts["own"][order]
        codes = np.stack([np.frombuffer(parts["codes"][k], "<u4") for k in order])
        vectors = [parts["vector"][k] for k in order]
        sizes = np.array([len(v) for v in vectors])
        i, j = parts["i"][0], parts["j"][0]
        links, lefts, rights = np.zeros(len(ids), np.int64), [], []
        for size in np.unique(sizes):
            a = np.flatnonzero((sizes == size) & (own == i))
            b = np.flatnonzero((sizes == size) & (own == j))
            if not len(a) or not len(b):
                continue
            x, y = _unit(np.stack([vectors[k] for k in a])), _unit(np.stack([vectors[k] for k in b]))
            p, q = np.nonzero(x @ y.T >= cosine)
            p, q = a[p], b[q]
            keep = (p < q) if i == j else (ids[p] != ids[q])
            p, q = p[keep], q[keep]
            # 4096 pairs at a time: not those that an earlier table has brought together
            for k in range(0, len(p), 4096):
                u, v = p[k : k + 4096], q[k : k + 4096]
                first = ~(codes[u, :table] == codes[v, :table]).any(axis=1)
                u, v = u[first], v[first]
                np.add.at(links, u, copies[v])
                np.add.at(links, v, copies[u])
                lefts.append(u)
                rights.append(v)
        if not lefts:
            return None
        root = _roots(len(ids), np.concatenate(lefts), np.concatenate(rights))
        on = links > 0
        return ids[on], links[on], ids[root[on]]

    columns = ("key", "i", "j", "own", "id", "copies")

    def run(batches):
        held = None

        def flush(group):
            done = work(group)
            if done is not None and len(done[0]):
                return pa.RecordBatch.from_arrays([pa.array(c) for c in done], names=["id", "links", "near"])
            return None

        for batch in batches:
            if not batch.num_rows:
                continue
            data = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in columns}
            data["codes"] = np.array(batch.column("codes").to_pylist(), object)
            values = batch.column("vector")
            flat, offsets = values.values.to_numpy(zero_copy_only=False).astype(np.float64), values.offsets.to_numpy()
            rows = np.empty(batch.num_rows, object)
            for k in range(batch.num_rows):
                rows[k] = flat[offsets[k] : offsets[k + 1]]
            data["vector"] = rows
            if held is not None:
                data = {c: np.concatenate((held[c], data[c])) for c in data}
            change = (np.diff(data["key"]) != 0) | (np.diff(data["i"]) != 0) | (np.diff(data["j"]) != 0)
            cuts = np.concatenate(([0], np.flatnonzero(change) + 1))
            for start, end in zip(cuts[:-1], cuts[1:]):
                if end - start > 1 and (out := flush({c: v[start:end] for c, v in data.items()})) is not None:
                    yield out
            held = {c: v[cuts[-1] :] for c, v in data.items()}
        if held is not None and (out := flush(held)) is not None:
            yield out

    return units.mapInArrow(run, "id long, links long, near long")


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    cosine: float = 0.95,
    tables: int = 56,
    projections: int = 16,
    width: float = 2.0,
    block: int = 512,
    seed: int = 29,
) -> DataFrame:
    """One row for each vector: id, n_links, component_id, kept."""
    scratch = Scratch(vectors.sparkSession)
    base = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("vector"))
    usable = F.coalesce(
        F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("vector", lambda x: x != 0) & F.col("id").isNotNull(),
        F.lit(False),
    )
    # scaled by the largest entry, so that squares neither overflow nor vanish
    largest = F.array_max(F.transform("vector", F.abs))
    base = base.withColumn("vector", F.when(usable, F.transform("vector", lambda x: x / largest)))
    classes, _ = scratch.write(
        base.filter("vector IS NOT NULL").groupBy("vector").agg(F.min("id").alias("first"), F.count("*").alias("copies")).select(F.col("first").alias("id"), "copies", "vector")
    )
    # one id may stand for several vectors if it is repeated with different ones: classes get numbers of their own
    classes = classes.withColumn("class", F.xxhash64("id", "vector"))
    coded, _ = scratch.write(_coded(classes.select(F.col("class").alias("id"), "vector"), tables, projections, width, seed))
    keys = _keys(coded)
    crowded = keys.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    met, _ = scratch.write(keys.join(crowded, "key").select("key", "id", F.ceil(F.col("n") / F.lit(block)).cast("int").alias("blocks")))
    full = classes.select(F.col("class").alias("id"), "copies", "vector").join(coded, "id")
    rows = met.withColumn("own", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id")
    dealt = rows.join(full, "id").repartition("key", "i", "j").sortWithinPartitions("key", "i", "j")
    found, _ = scratch.write(_compared(dealt.select("key", "i", "j", "own", "id", "copies", "vector", "codes"), cosine))
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    names = classes.select(F.col("class").alias("cid"), F.col("id").alias("name"))
    edges = found.filter("id <> near").select("id", "near").distinct()
    edges = edges.join(names, F.col("id") == F.col("cid")).select(F.col("name").alias("u"), "near").join(names, F.col("near") == F.col("cid")).select("u", F.col("name").alias("v"))
    stars = components(edges, scratch).withColumnRenamed("id", "sid")
    by_class = classes.join(links.withColumnRenamed("id", "lid"), F.col("class") == F.col("lid"), "left").join(stars, F.col("id") == F.col("sid"), "left")
    by_class = by_class.select("vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "id").alias("component_id"))
    linked = base.filter("vector IS NOT NULL").join(by_class, "vector").select("id", "n_links", "component_id")
    alone = base.filter("vector IS NULL").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).select(F.col("id").alias(id_col), "n_links", "component_id", F.coalesce(F.col("component_id") == F.col("id"), F.lit(True)).alias("kept"))
