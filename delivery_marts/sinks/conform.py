"""Frames brought to a declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delivery_marts.functions import nan_to_null
from delivery_marts.schemas import TableSpec, storage_schema

FRACTIONS = (T.DoubleType, T.FloatType, T.DecimalType)


def typed(value: Column, source: T.DataType, target: T.DataType) -> Column:
    """Strict cast (out of range raises); fractions are rounded, halves away from zero."""
    if isinstance(source, FRACTIONS) and isinstance(target, T.IntegralType):
        number = value if isinstance(source, T.DecimalType) else nan_to_null(value)
        return F.round(number, 0).cast(target)
    return value if source == target else value.cast(target)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns, in its order and types; decimals are rounded to scale."""
    return df.select(
        *[
            typed(F.col(f.name), df.schema[f.name].dataType, f.dataType).alias(f.name)
            for f in storage_schema(schema)
        ]
    )


def apply_defaults(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Fill NULLs with the table's declared defaults. Opt-in: the load keeps NULLs, for
    it names every column and so never lets a default apply."""
    return df.fillna(spec.defaults) if spec.defaults else df
