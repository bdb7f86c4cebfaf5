"""Casts from payload text to catalog types; what does not parse becomes null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlens.functions.text import blank_to_null


def cast_text(col: Column, dtype: T.DataType) -> Column:
    """Text to ``dtype``; an empty string is null for everything but text."""
    if isinstance(dtype, T.StringType):
        return col
    text = blank_to_null(col)
    if isinstance(dtype, T.TimestampType):
        return F.try_to_timestamp(text)
    if isinstance(dtype, T.DateType):
        return F.try_to_timestamp(text).cast("date")
    if isinstance(dtype, T.BooleanType):
        return text.try_cast("boolean")
    if isinstance(dtype, T.DoubleType):
        return text.try_cast("double")
    exact = text.try_cast("decimal(38,18)")
    if isinstance(dtype, T.DecimalType):
        return exact.try_cast(dtype)
    return F.round(exact, 0).try_cast(dtype)


def joined_list(col: Column) -> Column:
    """``["a","b"]`` as ``a,b``; other text unchanged."""
    parsed = F.from_json(col, "array<string>")
    return F.when(F.substring(F.trim(col), 1, 1) == "[", F.array_join(parsed, ",")).otherwise(col)
