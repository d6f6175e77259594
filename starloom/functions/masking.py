"""Hiding personal data."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

REDACTED = "***"


def hash_pii(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Replace each present column by the SHA-256 hex of its text; null stays null."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.sha2(F.col(c).cast("string"), 256) for c in present}) if present else df


def missing_pii(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """Declared personal columns the frame lacks (worth a warning, not a failure)."""
    return [c for c in columns if c not in df.columns]


def redact(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Replace every value, null too, by a constant mask."""
    present = [c for c in columns if c in df.columns]
    return df.withColumns({c: F.lit(REDACTED) for c in present}) if present else df
