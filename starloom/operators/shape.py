"""Projection, renaming, casting and simple row filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from starloom.functions.text import normalize_timestamp, null_text_to_null


def keep_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Exactly these columns in this order; a missing one is an error."""
    columns = list(columns)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*columns)


def rename_present(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist; other names in the mapping are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def drop_present(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.drop(*columns)


def drop_repeated_names(df: DataFrame) -> DataFrame:
    """Keep the first of columns that share a name."""
    if len(set(df.columns)) == len(df.columns):
        return df
    unique = [f"__{i}" for i in range(len(df.columns))]
    first: dict[str, str] = {}
    for name, alias in zip(df.columns, unique):
        first.setdefault(name, alias)
    return df.toDF(*unique).select(*[F.col(alias).alias(name) for name, alias in first.items()])


def filter_equal(df: DataFrame, column: str, value: Any) -> DataFrame:
    return df.filter(F.col(column) == F.lit(value))


def filter_not_equal(df: DataFrame, column: str, value: Any) -> DataFrame:
    """Rows that differ from the value; null rows stay."""
    return df.filter(~F.col(column).eqNullSafe(F.lit(value)))


def filter_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def slicer(df: DataFrame, column: str, values: Iterable[Any]) -> DataFrame:
    """Rows whose value was selected; nothing selected means no filter."""
    values = list(values)
    return df.filter(F.col(column).isin(*values)) if values else df


def hierarchy_slicer(df: DataFrame, levels: tuple[str, ...], picked: Iterable[tuple]) -> DataFrame:
    """Selected nodes of a hierarchy: each pick fixes the first len(pick) levels."""
    cond = None
    for path in picked:
        node = F.lit(True)
        for level, value in zip(levels, path):
            node = node & (F.col(level) == F.lit(value))
        cond = node if cond is None else cond | node
    return df if cond is None else df.filter(cond)


def cast_column(df: DataFrame, column: str, dtype: str | DataType) -> DataFrame:
    """Cast one column; values that do not fit become null."""
    return df.withColumn(column, F.col(column).try_cast(dtype))


def align_to(df: DataFrame, reference: DataFrame) -> DataFrame:
    """Give same-named columns the reference's types; other columns stay."""
    types = {f.name: f.dataType for f in reference.schema.fields}
    casts = {
        f.name: F.col(f.name).try_cast(types[f.name])
        for f in df.schema.fields
        if f.name in types and types[f.name] != f.dataType
    }
    return df.withColumns(casts) if casts else df


def as_text(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("string") for c in columns})


def normalize_text(df: DataFrame, date_columns: Iterable[str] = ()) -> DataFrame:
    """Trim text, turn the text ``nan`` into null, put dates into one format."""
    dates = set(date_columns)
    out = {}
    for f in df.schema.fields:
        if f.name in dates:
            out[f.name] = normalize_timestamp(F.col(f.name))
        elif isinstance(f.dataType, StringType):
            out[f.name] = null_text_to_null(F.trim(F.col(f.name)))
    return df.withColumns(out) if out else df
