"""Delimited-text scan with a declared schema, and the census column roles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

# The census record layout and its column roles.
_CENSUS_FIELDS = [
    ("age", IntegerType()),
    ("workclass", StringType()),
    ("fnlwgt", IntegerType()),
    ("education", StringType()),
    ("education_num", IntegerType()),
    ("marital_status", StringType()),
    ("occupation", StringType()),
    ("relationship", StringType()),
    ("race", StringType()),
    ("gender", StringType()),
    ("capital_gain", IntegerType()),
    ("capital_loss", IntegerType()),
    ("hours_per_week", IntegerType()),
    ("native_country", StringType()),
    ("income", StringType()),
]
CENSUS_CATEGORICAL = [
    "workclass",
    "education",
    "marital_status",
    "occupation",
    "relationship",
    "race",
    "gender",
    "native_country",
]
CENSUS_NUMERIC = ["age", "fnlwgt", "capital_gain", "capital_loss", "hours_per_week"]
CENSUS_LABEL = "income"

CENSUS_SCHEMA = StructType([StructField(name, dtype, True) for name, dtype in _CENSUS_FIELDS])


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    sep: str = ";",
    header: bool = False,
) -> DataFrame:
    """Scan delimited text under ``schema``; nothing is inferred, so no extra pass is made.

    Empty and unparsable fields arrive as null; any other marker stays text.
    """
    return spark.read.schema(schema).csv(path, sep=sep, header=header, mode="PERMISSIVE")
