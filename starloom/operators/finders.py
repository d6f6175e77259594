"""Reads on warehouse tables: points, attributes, ranges, key sets."""

from __future__ import annotations

from collections.abc import Iterable
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def point_lookup(table: DataFrame, key: str, value: Any) -> DataFrame:
    return table.filter(F.col(key) == F.lit(value)).limit(1)


def attribute_lookup(table: DataFrame, column: str, value: Any) -> DataFrame:
    return table.filter(F.col(column) == F.lit(value))


def columns_of(table: DataFrame, columns: Iterable[str]) -> DataFrame:
    return table.select(*columns)


def all_keys(table: DataFrame, key: str) -> DataFrame:
    return table.select(key).distinct()


def distinct_values(table: DataFrame, column: str) -> DataFrame:
    return table.select(column).dropna().distinct()


def distinct_rows(table: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """Each combination of ``columns`` (default: all) once, null equal to null; reduced before the shuffle."""
    return (table.select(*columns) if columns else table).distinct()


def columns_by_keys(table: DataFrame, columns: Iterable[str], keys: DataFrame, key: str) -> DataFrame:
    """Columns of the rows whose key is in ``keys`` (a frame with column ``key``)."""
    wanted = keys.select(F.col(key).alias("__key")).distinct()
    return table.join(wanted, F.col(key) == F.col("__key"), "left_semi").select(*columns)


def in_range(table: DataFrame, column: str, low: Any, high: Any) -> DataFrame:
    """Both ends included; used for date keys and for timestamps."""
    return table.filter(F.col(column).between(F.lit(low), F.lit(high)))


def any_true(table: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Rows where at least one flag is set."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c)
    return table.filter(cond)


def sla_breached(fact: DataFrame) -> DataFrame:
    return any_true(fact, ["sla_first_response_breached", "sla_resolution_breached"])


def active(dim: DataFrame) -> DataFrame:
    return dim.filter(F.col("is_active"))


def _by(column: str):
    def find(table: DataFrame, value: Any) -> DataFrame:
        return attribute_lookup(table, column, value)

    find.__name__ = f"by_{column}"
    find.__doc__ = f"Rows with this {column}."
    return find


by_customer = _by("customer_id")
by_agent = _by("agent_id")
by_driver = _by("driver_id")
by_restaurant = _by("restaurant_id")
by_region = _by("region_id")
by_segment = _by("segment_name")
by_gender = _by("gender")
by_priority_support = _by("priority_support")
by_shift = _by("shift")
by_vehicle_type = _by("vehicle_type")
by_team = _by("team_name")
by_skill_level = _by("skill_level")
by_category = _by("category_name")
by_price_tier = _by("price_tier")
by_source_file = _by("source_file")
by_batch_source = _by("batch_source")
by_reason = _by("rejected_reason")


def by_source_table(orphans: DataFrame, table: str) -> DataFrame:
    """Orphans of one dimension; the table name is matched in any case."""
    return orphans.filter(F.upper("source_table") == F.lit(table.upper()))
