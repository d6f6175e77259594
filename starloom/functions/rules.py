"""Value rules: type checks on raw text and the row rules of the quality gate."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
    TimestampNTZType,
    TimestampType,
)

# Text patterns of the checks.
INT_TEXT = r"^\s*[+-]?[0-9]+\s*$"
FLOAT_TEXT = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"
EMAIL_TEXT = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
PHONE_TEXT = r"^\+?[0-9]{7,15}$"

_INTEGRAL = (ByteType, ShortType, IntegerType, LongType)
_FRACTIONAL = (FloatType, DoubleType, DecimalType)


def type_label(dtype: DataType) -> str:
    """The short type name used in rejection reasons."""
    if isinstance(dtype, _INTEGRAL):
        return "int"
    if isinstance(dtype, _FRACTIONAL):
        return "float"
    if isinstance(dtype, BooleanType):
        return "bool"
    if isinstance(dtype, DateType):
        return "date"
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return "datetime"
    return "str"


def type_ok(c: Column, dtype: DataType) -> Column:
    """Does this raw text hold a value of ``dtype``?  Null in, null out."""
    text = F.trim(c)
    fits = text.try_cast(dtype).isNotNull()
    if isinstance(dtype, StringType):
        ok = F.lit(True)
    elif isinstance(dtype, _INTEGRAL):
        ok = c.rlike(INT_TEXT) & fits
    elif isinstance(dtype, _FRACTIONAL):
        ok = c.rlike(FLOAT_TEXT) & fits
    elif isinstance(dtype, BooleanType):
        ok = F.lower(text).isin("true", "false")
    else:
        ok = fits
    return F.when(c.isNotNull(), ok)


def cast_text(c: Column, dtype: DataType) -> Column:
    """Typed value of checked text."""
    return c if isinstance(dtype, StringType) else F.trim(c).try_cast(dtype)


def email_ok(c: Column) -> Column:
    return c.rlike(EMAIL_TEXT)


def phone_ok(c: Column) -> Column:
    return c.rlike(PHONE_TEXT)


def date_ok(c: Column) -> Column:
    return F.when(c.isNotNull(), F.trim(c).try_cast("timestamp_ntz").isNotNull())


def in_range(c: Column, low=None, high=None) -> Column:
    ok = F.when(c.isNotNull(), F.lit(True))
    if low is not None:
        ok = ok & (c >= F.lit(low))
    if high is not None:
        ok = ok & (c <= F.lit(high))
    return ok


def one_of(c: Column, values: Iterable[str]) -> Column:
    return c.isin(*values)
