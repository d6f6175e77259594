"""Changes to tables, as frames that hold the table's next snapshot."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _matches(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def merge_upsert(target: DataFrame, updates: DataFrame, key: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Update matching rows in the supplied columns only, insert the others.

    ``updates`` holds one row per non-null key (see ``latest_per_key``).  A
    supplied null overwrites; columns not supplied keep their stored value.
    Both sides are unique on the key, so the join has no hot key.
    """
    columns = list(columns) if columns is not None else [c for c in updates.columns if c != key]
    unknown = [c for c in [key, *columns] if c not in target.columns]
    if unknown:
        raise ValueError(f"columns not in target: {unknown}")
    types = {f.name: f.dataType for f in target.schema.fields}
    new = updates.select(
        F.col(key).cast(types[key]).alias("__key"),
        F.struct(*[F.col(c).cast(types[c]).alias(c) for c in columns]).alias("__new"),
    )
    supplied = F.col("__new").isNotNull()
    out = [
        F.coalesce(F.col(c), F.col("__key")).alias(c)
        if c == key
        else F.when(supplied, F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c)
        if c in columns
        else F.col(c)
        for c in target.columns
    ]
    return target.join(new, F.col(key) == F.col("__key"), "full").select(*out)


def changed_rows(target: DataFrame, updates: DataFrame, key: str, columns: Iterable[str] | None = None) -> DataFrame:
    """The rows of ``merge_upsert`` that its updates change or insert, in the columns of ``target``.

    This is what an upsert appends where the last row of a key counts.  ``target`` is read only for columns that are
    not supplied, and then only the rows of the updated keys.
    """
    columns = list(columns) if columns is not None else [c for c in updates.columns if c != key]
    unknown = [c for c in [key, *columns] if c not in target.columns]
    if unknown:
        raise ValueError(f"columns not in target: {unknown}")
    types = {f.name: f.dataType for f in target.schema.fields}
    new = updates.select(*[F.col(c).cast(types[c]).alias(c) for c in [key, *columns]])
    others = [c for c in target.columns if c != key and c not in columns]
    if not others:
        return new.select(*target.columns)
    old = target.select(F.col(key).alias("__key"), *others)
    return new.join(old, F.col(key) == F.col("__key"), "left").select(*target.columns)


def merge_small_update(
    target: DataFrame, updates: DataFrame, key: str, columns: Iterable[str] | None = None
) -> DataFrame:
    """``merge_upsert`` for a few changed rows against a large table.

    A full join always shuffles the table.  Here the table is the streamed
    side of a left join, which needs no shuffle of it while the updates fit
    the broadcast threshold; only its keys meet the updates for the inserts.
    """
    columns = list(columns) if columns is not None else [c for c in updates.columns if c != key]
    types = {f.name: f.dataType for f in target.schema.fields}
    new = updates.select(
        F.col(key).cast(types[key]).alias("__key"),
        F.struct(*[F.col(c).cast(types[c]).alias(c) for c in columns]).alias("__new"),
    )
    supplied = F.col("__new").isNotNull()
    updated = target.join(new, F.col(key) == F.col("__key"), "left").select(
        *[
            F.when(supplied, F.col(f"__new.{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)
            for c in target.columns
        ]
    )
    touched = target.select(key).join(new.select("__key"), F.col(key) == F.col("__key"), "left_semi")
    fresh = new.join(touched.select(F.col(key).alias("__hit")), F.col("__key") == F.col("__hit"), "left_anti").select(
        *[
            F.col("__key").alias(c)
            if c == key
            else F.col(f"__new.{c}").alias(c)
            if c in columns
            else F.lit(None).cast(types[c]).alias(c)
            for c in target.columns
        ]
    )
    return updated.unionByName(fresh)


def update_where(df: DataFrame, cond: Column, values: Mapping[str, Any]) -> DataFrame:
    """Set columns on the rows the condition holds for."""
    hit = _matches(cond)
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {
            c: F.when(hit, (v if isinstance(v, Column) else F.lit(v)).cast(types[c])).otherwise(F.col(c))
            for c, v in values.items()
        }
    )


def update_by_id(df: DataFrame, key: str, value: Any, values: Mapping[str, Any]) -> DataFrame:
    return update_where(df, F.col(key) == F.lit(value), values)


def delete_where(df: DataFrame, cond: Column) -> DataFrame:
    """Drop the rows the condition holds for; rows where it is null stay."""
    return df.filter(~_matches(cond))


def delete_by_id(df: DataFrame, key: str, value: Any) -> DataFrame:
    return delete_where(df, F.col(key) == F.lit(value))


def delete_matching(df: DataFrame, filters: Mapping[str, Any]) -> DataFrame:
    """Drop rows equal to all given values; refuses to run without a filter."""
    if not filters:
        raise ValueError("refusing to delete without filters")
    cond = F.lit(True)
    for c, v in filters.items():
        cond = cond & (F.col(c) == F.lit(v))
    return delete_where(df, cond)


def delete_orphaned_fk(orphans: DataFrame, fk_column: str, fk_value: str) -> DataFrame:
    return delete_matching(orphans, {"orphaned_fk_column": fk_column, "orphaned_fk_value": fk_value})


def delete_keys(df: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Drop rows whose key is in ``keys`` (a frame with column ``key``)."""
    gone = keys.select(F.col(key).alias("__key")).distinct()
    return df.join(gone, F.col(key) == F.col("__key"), "left_anti")


def soft_delete(df: DataFrame, cond: Column, clear: Mapping[str, Any] | None = None) -> DataFrame:
    """Deactivate rows instead of dropping them (``is_active`` unless ``clear`` says otherwise)."""
    return update_where(df, cond, clear if clear is not None else {"is_active": False})


def soft_delete_customer(customers: DataFrame, customer_id: Any) -> DataFrame:
    """A customer has no active flag: its support priority and discount are cleared."""
    return soft_delete(
        customers, F.col("customer_id") == F.lit(customer_id), {"priority_support": False, "discount_pct": 0.0}
    )


SCD2_COLUMNS = ("surrogate_key", "valid_from", "valid_to", "is_current")


def scd2_surrogate(key: Column, valid_from: Column) -> Column:
    """Deterministic surrogate key of one version."""
    return F.sha2(F.concat_ws("|", key.cast("string"), valid_from.cast("string")), 256)


def scd2_merge(history: DataFrame, snapshot: DataFrame, key: str, tracked: Iterable[str], as_of: Column) -> DataFrame:
    """Next history of a type-2 dimension, from one full join.

    ``history`` has ``surrogate_key``, ``valid_from``, ``valid_to`` and
    ``is_current`` besides the business columns; ``snapshot`` has one row per
    key.  A change in a tracked column closes the current version at ``as_of``
    and opens a new one; keys missing from the snapshot stay current.
    """
    versions = _scd2_versions(history, snapshot, key, tracked, as_of, True)
    return history.filter(~F.col("is_current")).unionByName(versions)


def scd2_changes(history: DataFrame, snapshot: DataFrame, key: str, tracked: Iterable[str], as_of: Column) -> DataFrame:
    """The versions that ``scd2_merge`` closes or opens: what is appended where the last row of a surrogate key counts."""
    return _scd2_versions(history, snapshot, key, tracked, as_of, False)


def _scd2_versions(history: DataFrame, snapshot: DataFrame, key: str, tracked: Iterable[str], as_of: Column, unchanged: bool) -> DataFrame:
    business = [c for c in history.columns if c not in SCD2_COLUMNS]
    types = {f.name: f.dataType for f in history.schema.fields}
    current = history.filter("is_current").select(F.struct(*history.columns).alias("h"))
    fresh = snapshot.select(F.struct(*[F.col(c).cast(types[c]).alias(c) for c in business]).alias("s"))
    joined = current.join(fresh, F.col(f"h.{key}") == F.col(f"s.{key}"), "full" if unchanged else "right")

    same = F.lit(True)
    for c in tracked:
        same = same & F.col(f"h.{c}").eqNullSafe(F.col(f"s.{c}"))
    start = as_of.cast(types["valid_from"])
    opened = F.struct(
        *[
            scd2_surrogate(F.col(f"s.{key}"), start).alias(c)
            if c == "surrogate_key"
            else start.alias(c)
            if c == "valid_from"
            else F.lit(None).cast(types[c]).alias(c)
            if c == "valid_to"
            else F.lit(True).alias(c)
            if c == "is_current"
            else F.col(f"s.{c}").alias(c)
            for c in history.columns
        ]
    )
    kept = F.struct(*[F.col(f"h.{c}").alias(c) for c in history.columns])
    expired = F.struct(
        *[
            as_of.cast(types[c]).alias(c)
            if c == "valid_to"
            else F.lit(False).alias(c)
            if c == "is_current"
            else F.col(f"h.{c}").alias(c)
            for c in history.columns
        ]
    )
    versions = F.when(F.col("h").isNull(), F.array(opened)).when(F.col("s").isNull() | same, F.array(kept) if unchanged else F.filter(F.array(kept), lambda _: F.lit(False)))
    return joined.select(F.inline(versions.otherwise(F.array(expired, opened))))


def scd2_counts(history: DataFrame, snapshot: DataFrame, key: str, tracked: Iterable[str]) -> DataFrame:
    """What ``scd2_merge`` of the same frames inserts, updates and expires (one row).

    A key without a current version is inserted; a change of a tracked column
    is an update and expires the version before it.
    """
    tracked = list(tracked)
    current = history.filter("is_current").select(F.col(key).alias("__key"), *[F.col(c).alias(f"__h_{c}") for c in tracked])
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.col(f"__h_{c}"))
    known = F.col("__key").isNotNull()
    joined = snapshot.select(key, *tracked).join(current, F.col(key) == F.col("__key"), "left")
    return joined.agg(
        F.count_if(~known).alias("scd_inserted_count"),
        F.count_if(known & ~same).alias("scd_updated_count"),
        F.count_if(known & ~same).alias("scd_expired_count"),
    )
