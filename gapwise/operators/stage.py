"""Base class for single-column stages and the schema check every stage runs first."""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, NumericType, StructField, StructType


def check_schema(
    schema: StructType,
    inputs: list[str],
    outputs: list[str],
    numeric: bool = True,
    output_type: DataType | None = None,
) -> StructType:
    """Return the schema after a stage, or raise before any job starts.

    Inputs must exist (and be numeric if asked), and outputs must be free. Names are
    compared without case, as Spark does.
    """
    fields = {f.name.lower(): f for f in schema.fields}
    for name in inputs:
        if name.lower() not in fields:
            raise ValueError(f"column {name} does not exist")
        dtype = fields[name.lower()].dataType
        if numeric and not isinstance(dtype, NumericType):
            raise ValueError(f"column {name} must be numeric, not {dtype.simpleString()}")
    taken = set(fields)
    for name in outputs:
        if name.lower() in taken:
            raise ValueError(f"column {name} already exists")
        taken.add(name.lower())
    added = [StructField(name, output_type or DoubleType(), True) for name in outputs]
    return StructType(schema.fields + added)


class ColumnStage(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A pipeline stage that appends one column; subclasses say which in ``expression``.

    A subclass may also narrow or check the rows in ``rows``. Its constructor should
    accept no arguments, so that a saved stage can be read back.
    """

    numeric_input = True

    def setInputCol(self, value: str):
        return self._set(inputCol=value)

    def setOutputCol(self, value: str):
        return self._set(outputCol=value)

    def expression(self, c: Column) -> Column:
        raise NotImplementedError

    def rows(self, df: DataFrame) -> DataFrame:
        return df

    def transformSchema(self, schema: StructType) -> StructType:
        return check_schema(schema, [self.getInputCol()], [self.getOutputCol()], self.numeric_input)

    def _transform(self, df: DataFrame) -> DataFrame:
        self.transformSchema(df.schema)
        return self.rows(df).withColumn(self.getOutputCol(), self.expression(F.col(self.getInputCol())))
