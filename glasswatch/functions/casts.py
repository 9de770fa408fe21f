"""Casts that give NULL instead of failing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def safe_int(c: Column, fractional: bool = False) -> Column:
    """To BIGINT. Set ``fractional`` for float inputs: they are rounded first, since Spark's cast truncates."""
    return (F.round(c) if fractional else c).try_cast("bigint")


def safe_float(c: Column) -> Column:
    return c.try_cast("double")


def safe_text(c: Column) -> Column:
    return c.try_cast("string")


def safe_bool(c: Column) -> Column:
    return c.try_cast("boolean")


def safe_timestamp(c: Column) -> Column:
    return c.try_cast("timestamp_ntz")


def safe_date(c: Column) -> Column:
    return c.try_cast("date")


_BY_KIND = {
    "float": safe_float,
    "text": safe_text,
    "bool": safe_bool,
    "timestamp": safe_timestamp,
    "date": safe_date,
}


def cast_as(df: DataFrame, column: str, kind: str) -> Column:
    """The safe cast of one column of ``df``; looks at the schema to see whether an int cast has to round."""
    if kind == "int":
        fractional = isinstance(df.schema[column].dataType, (T.FloatType, T.DoubleType))
        return safe_int(F.col(column), fractional)
    return _BY_KIND[kind](F.col(column))
