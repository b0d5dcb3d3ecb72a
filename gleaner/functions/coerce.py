"""Scalar coercion of source values to the declared field types.

Loose typing rules: a string counts as its leading number (none: 0), fractions
are cut toward zero, and only ``''``, ``'0'``, zero and false are false.
Null always stays null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEADING_NUMBER = r"^\s*([+-]?(?:\d+(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?)"
LEADING_INTEGER = r"^\s*([+-]?\d+)(?![\d.eE])"

SPARK_TYPES = {
    "string": T.StringType(),
    "int32": T.IntegerType(),
    "int64": T.LongType(),
    "float": T.DoubleType(),
    "bool": T.BooleanType(),
}


def _number(value: Column, source: T.DataType) -> Column:
    if isinstance(source, T.StringType):
        return F.coalesce(F.regexp_extract(value, LEADING_NUMBER, 1).try_cast("double"), F.lit(0.0))
    if isinstance(source, T.BooleanType):
        return value.cast("int").cast("double")
    return value.cast("double")


def to_int(value: Column, source: T.DataType, target: str = "int64") -> Column:
    spark_type = SPARK_TYPES[target].simpleString()
    if isinstance(source, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return epoch_seconds(value).cast(spark_type)
    if isinstance(source, T.IntegralType):
        return value.try_cast(spark_type)
    number = _number(value, source)
    whole = F.when(F.isnan(number), F.lit(0.0)).otherwise(number).try_cast("bigint")
    if isinstance(source, T.StringType):
        # Long integers do not fit a double: read them directly.
        whole = F.coalesce(F.regexp_extract(value, LEADING_INTEGER, 1).try_cast("bigint"), whole)
    return F.when(value.isNotNull(), whole.try_cast(spark_type))


def to_float(value: Column, source: T.DataType) -> Column:
    return F.when(value.isNotNull(), _number(value, source))


def to_bool(value: Column, source: T.DataType) -> Column:
    if isinstance(source, T.BooleanType):
        return value
    if isinstance(source, T.StringType):
        return ~value.isin("", "0")
    return value != 0


def to_string(value: Column, source: T.DataType) -> Column:
    if isinstance(source, T.BooleanType):
        return F.when(value, F.lit("1")).when(~value, F.lit(""))
    if isinstance(source, (T.DoubleType, T.FloatType)):
        whole = (value == F.floor(value)) & (F.abs(value) < 1e15)
        return F.when(whole, value.try_cast("bigint").cast("string")).otherwise(value.cast("string"))
    return value.cast("string")


def epoch_seconds(value: Column) -> Column:
    return F.unix_timestamp(value.cast("timestamp"))


def coerce(value: Column, source: T.DataType, target: str) -> Column:
    """One value, or every element of an array, as the declared type."""
    if target == "float[]":
        return F.transform(value, lambda v: to_float(v, source.elementType).cast("float"))
    if target.endswith("[]") and isinstance(source, T.ArrayType) and target[:-2] in SPARK_TYPES:
        return F.transform(value, lambda v: coerce(v, source.elementType, target[:-2]))
    if isinstance(source, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        seconds = epoch_seconds(value)
        return seconds.cast("string") if target == "string" else seconds
    if target in ("int32", "int64"):
        return to_int(value, source, target)
    if target == "float":
        return to_float(value, source)
    if target == "bool":
        return to_bool(value, source)
    if target == "string":
        return to_string(value, source)
    return value
