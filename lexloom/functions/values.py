"""Values that any JSON reader takes: finite numbers, valid text, ISO times; at any depth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BinaryType, DataType, DateType, DoubleType, FloatType, MapType, StructType, TimestampNTZType, TimestampType

from lexloom.functions.text import finite, iso_timestamp


def safe(value: Column, kind: DataType) -> Column:
    """A value with NaN and infinities as 0, bytes as UTF-8 (what is not valid replaced) and times as ISO text, inside arrays, maps
    and structs too."""
    if isinstance(kind, (DoubleType, FloatType)):
        return finite(value).cast(kind)
    if isinstance(kind, BinaryType):
        return F.make_valid_utf8(value.cast("string"))
    if isinstance(kind, TimestampType):
        return iso_timestamp(value)
    if isinstance(kind, (TimestampNTZType, DateType)):
        return value.cast("string")
    if isinstance(kind, ArrayType):
        return F.transform(value, lambda x: safe(x, kind.elementType))
    if isinstance(kind, MapType):
        return F.transform_values(value, lambda k, v: safe(v, kind.valueType))
    if isinstance(kind, StructType):
        return F.when(value.isNotNull(), F.struct(*(safe(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields)))
    return value


def safe_rows(df: DataFrame) -> DataFrame:
    return df.select(*(safe(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields))
