"""Operators over ordered rows of a key."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, NumericType, StringType, TimestampNTZType, TimestampType

from starloom.functions.derive import elapsed_seconds

# The statuses that close a ticket and those that open it again.
CLOSED = ("resolved", "closed")
OPENED = ("open", "reopened")

# window buckets for each shuffle partition
BUCKETS_PER_PARTITION = 4


def latest_per_key(df: DataFrame, keys: Iterable[str], order: Iterable[Column]) -> DataFrame:
    """The first row of each key in the given order (pass descending columns).

    The rank limit lets Spark keep one row per key in every map task before
    the shuffle, so a hot key never gathers in one task.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(w)).filter(F.col("__rank") == 1).drop("__rank")


def dedup_keep_first(df: DataFrame, keys: Iterable[str], order: Iterable[str]) -> DataFrame:
    """The earliest row of each key."""
    return latest_per_key(df, keys, [F.col(c).asc() for c in order])


def _as_double(df: DataFrame, column: str) -> Column:
    """Number in the order of a numeric, date, timestamp or text column (of texts, by the first six bytes)."""
    dtype, c = df.schema[column].dataType, F.col(column)
    if isinstance(dtype, (DateType, TimestampNTZType)):
        return elapsed_seconds(F.lit("1970-01-01"), c)
    if isinstance(dtype, TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(dtype, NumericType):
        return c.cast("double")
    if isinstance(dtype, StringType):
        return F.conv(F.rpad(F.hex(F.substring(c.cast("binary"), 1, 6)), 12, "0"), 16, 10).cast("double")
    raise ValueError(f"no even buckets over {column!r} of type {dtype.simpleString()}; pass a bucket")


def bucket_count(df: DataFrame) -> int:
    """A few buckets per shuffle partition, so groups shrink as the cluster's settings grow."""
    return BUCKETS_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


#: Stands for no value, below all others.
_NOTHING = -1.7e308
#: Order columns that buckets look at, so that a bucket's number fits 64 bits.
_DEEPEST = 3


def with_even_buckets(df: DataFrame, columns: str | Iterable[str], name: str, buckets: int | None = None) -> DataFrame:
    """Number the rows' buckets so that each holds about the same share of all rows, in the order of ``columns``.

    The borders are quantiles of the whole first column (one pass over it, a
    list of at most ``buckets`` numbers), so a bucket, and with it every (key,
    bucket) group, is bounded by 1.5 times its share of the table however the
    keys are spread.  A value that fills more than a bucket gets buckets of its
    own, with borders from the next column; only then is there another pass.
    Rows without a value come first, as they do in an ascending order.
    """
    columns = [columns] if isinstance(columns, str) else list(columns)[:_DEEPEST]
    n = buckets or bucket_count(df)
    numbered, rest, number = df, df, F.lit(0).cast("long")
    helpers: list[str] = []
    for depth, column in enumerate(columns):
        position = F.coalesce(_as_double(df, column), F.lit(_NOTHING))
        place, cell = f"__position{depth}", f"__quantile{depth}"
        found = rest.select(position.alias(place)).approxQuantile(place, [i / n for i in range(1, n)], 1 / (4 * n))
        heavy = sorted({a for a, b in zip(found, found[1:]) if a == b})
        cut = Bucketizer(splits=[-math.inf, *sorted(set(found) - {-math.inf, math.inf}), math.inf], inputCol=place, outputCol=cell, handleInvalid="keep") if found else None
        numbered = numbered.withColumn(place, position)
        numbered = numbered.withColumn(cell, F.lit(0.0)) if cut is None else cut.transform(numbered)
        # a heavy value is the lower border of its cell; what else is in the cell comes after it
        own = F.col(cell).cast("long") * 2 + F.when(F.col(place).isin(heavy), 0).otherwise(1)
        helpers += [place, cell]
        within = F.lit(True) if depth == 0 else F.col(f"__heavy{depth - 1}")
        number = number * (2 * n + 4) + F.when(within, own).otherwise(0)
        if not heavy:
            break
        numbered = numbered.withColumn(f"__heavy{depth}", within & F.col(place).isin(heavy))
        helpers.append(f"__heavy{depth}")
        rest = rest.filter(position.isin(heavy))
    return numbered.withColumn(name, number).drop(*helpers)


def neighbour_value(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    name: str,
    bucket: Column | None = None,
    following: bool = False,
) -> DataFrame:
    """``lag`` (or ``lead``) of ``value`` per key, without one task per key.

    Windows run per (key, bucket); the value that crosses a bucket border
    comes from a summary of one row per (key, bucket).  Without a ``bucket``
    the order columns are cut into even ones.  A given bucket must not
    decrease along the order.
    """
    cut = with_even_buckets(df, order, "__bucket") if bucket is None else df.withColumn("__bucket", bucket)
    parts = keys + ["__bucket"]
    w = W.partitionBy(*parts).orderBy(*order)
    step = F.lead if following else F.lag
    edge = step(F.lit(True)).over(w).isNull()
    pick = F.min_by if following else F.max_by
    summary = cut.groupBy(*parts).agg(pick(value, F.struct(*order)).alias("__edge_value"))
    across = summary.select(
        *[F.col(c).alias(f"__s_{c}") for c in parts],
        step("__edge_value").over(W.partitionBy(*keys).orderBy("__bucket")).alias("__across"),
    )
    inner = cut.withColumn("__within", step(value).over(w)).withColumn("__edge", edge)
    on = F.lit(True)
    for c in parts:
        on = on & F.col(c).eqNullSafe(F.col(f"__s_{c}"))
    return inner.join(across, on, "left").select(
        *df.columns, F.when(F.col("__edge"), F.col("__across")).otherwise(F.col("__within")).alias(name)
    )


def reopened_events(
    df: DataFrame,
    key: str,
    order: list[str],
    status: str,
    bucket: Column | None = None,
    closed: tuple[str, ...] = CLOSED,
    opened: tuple[str, ...] = OPENED,
) -> DataFrame:
    """Flag events that take a closed ticket back to an open status."""
    out = neighbour_value(df, [key], order, status, "previous_status", bucket)
    again = F.col("previous_status").isin(*closed) & F.col(status).isin(*opened)
    return out.withColumn("is_reopened", F.coalesce(again, F.lit(False)))


def reopened_by_transition(
    events: DataFrame,
    key: str,
    closed: tuple[str, ...] = CLOSED,
    opened: tuple[str, ...] = OPENED,
) -> DataFrame:
    """One flag per ticket where the event carries both statuses: a plain aggregate."""
    hit = F.col("old_status").isin(*closed) & F.col("new_status").isin(*opened)
    return events.groupBy(key).agg(F.bool_or(F.coalesce(hit, F.lit(False))).alias("is_reopened"))


def validity_ranges(df: DataFrame, key: str, valid_from: str, bucket: Column | None = None) -> DataFrame:
    """Versions of a key as ranges: end at the next start; the last is current."""
    out = neighbour_value(df, [key], [valid_from], valid_from, "valid_to", bucket, following=True)
    return out.withColumn("is_current", F.col("valid_to").isNull())
