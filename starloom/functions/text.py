"""Text normalisation and typed casts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DoubleType, FloatType, StringType, TimestampNTZType, TimestampType

WHOLE_FLOAT = r"^\s*([+-]?\d+)\.0*\s*$"
DATE_TEXT = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{2}.*)?\s*$"


def normalize_timestamp(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` where the text parses, else the text unchanged."""
    parsed = c.try_cast("timestamp_ntz")
    return F.coalesce(F.date_format(parsed, "yyyy-MM-dd HH:mm:ss"), c.cast("string"))


def null_text_to_null(c: Column) -> Column:
    """The text ``nan`` in any case becomes null."""
    return F.when(F.lower(F.trim(c)) != "nan", c)


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def canonical_text(c: Column, dtype: DataType) -> Column:
    """One spelling per value, for comparing rows: whole floats as integers,
    dates and timestamps as ``yyyy-MM-dd``, other text trimmed."""
    if isinstance(dtype, (FloatType, DoubleType)):
        whole = (c == F.floor(c)) & (F.abs(c) < F.lit(1e15))
        return F.when(whole, c.try_cast("long").cast("string")).otherwise(c.cast("string"))
    if isinstance(dtype, (DateType, TimestampType, TimestampNTZType)):
        return c.cast("date").cast("string")
    if isinstance(dtype, StringType):
        day = F.when(c.rlike(DATE_TEXT), F.trim(c).try_cast("timestamp_ntz").cast("date").cast("string"))
        return F.coalesce(day, F.trim(F.regexp_replace(c, WHOLE_FLOAT, "$1")))
    return c.cast("string")
