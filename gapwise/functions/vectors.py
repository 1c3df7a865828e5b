"""Column expressions over feature vectors.

The stored form of a vector is ``struct<type, size, indices, values>``; type 0 is sparse.
A sparse vector built here uses absence for "missing" and keeps zeros, whereas
``vector_to_array`` reads absence as zero. Code that must tell them apart goes through
``vector_parts``.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column
from pyspark.sql import functions as F

from gapwise.functions.missing import NAN, present_or_null


def vector_element(vector: Column, index: int) -> Column:
    """One element of a vector, evaluated in the JVM; an absent entry reads as zero."""
    return F.get(vector_to_array(vector), F.lit(index))


def vector_parts(vector: Column) -> Column:
    """The stored struct of a vector column."""
    return F.unwrap_udt(vector)


def sparse_struct(columns: list[Column], missing: float | None = None) -> Column:
    """Pack numeric columns into a sparse struct that leaves out exactly the missing ones.

    Null and NaN are missing, and so is ``missing`` if given. Zeros are kept.
    """
    entries = []
    for position, c in enumerate(columns):
        value = present_or_null(c)
        if missing is not None:
            value = F.nullif(value, F.lit(float(missing)))
        entries.append(F.struct(F.lit(position).alias("position"), value.alias("value")))
    kept = F.filter(F.array(*entries), lambda e: e["value"].isNotNull())
    return F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(len(columns)).alias("size"),
        kept["position"].alias("indices"),
        kept["value"].alias("values"),
    )


@F.arrow_udf(VectorUDT())
def to_sparse_vector(parts: pa.Array) -> pa.Array:
    """Relabel the stored struct as a vector column.

    Spark has no cast to the vector type, so the struct column alone makes one Arrow round
    trip; the batch is handed back untouched.
    """
    return parts


def dense_array(vector: Column, absent: float = NAN) -> Column:
    """All entries of a vector as an array; absent entries get ``absent``."""
    parts = vector_parts(vector)
    by_position = F.map_from_arrays(parts["indices"], parts["values"])
    spread = F.transform(
        F.sequence(F.lit(0), parts["size"] - 1),
        lambda i: F.coalesce(F.try_element_at(by_position, i), F.lit(float(absent))),
    )
    return F.when(parts["type"] == 1, parts["values"]).otherwise(spread)


def to_dense(vector: Column, absent: float = 0.0) -> Column:
    """The dense twin of a vector.

    ``absent=0.0`` is the usual reading of a sparse vector; ``absent=nan`` is the one for
    vectors whose absent entries are missing.
    """
    if absent == 0.0:
        return array_to_vector(vector_to_array(vector))
    return array_to_vector(dense_array(vector, absent))


def has_absent(vector: Column) -> Column:
    """True for a sparse vector that leaves out at least one entry."""
    parts = vector_parts(vector)
    return (parts["type"] == 0) & (F.size(parts["indices"]) < parts["size"])
