"""Rejected rows, orphan rows, their retry and their retention."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType, TimestampNTZType

from starloom.functions.masking import hash_pii
from starloom.operators.lookups import MISSING_REFS, ORPHAN_REASON
from starloom.operators.validation import REASON
from starloom.specs import OpResult

# The quarantine tables and their retention in days.
REJECTED_SCHEMA = StructType(
    [
        StructField("rejected_id", StringType()),
        StructField("record_payload", StringType()),
        StructField("rejected_reason", StringType()),
        StructField("batch_source", StringType()),
        StructField("rejected_at", TimestampNTZType()),
    ]
)
ORPHAN_SCHEMA = StructType(
    [
        StructField("quarantine_id", StringType()),
        StructField("record_payload", StringType()),
        StructField("fact_table", StringType()),
        StructField("source_table", StringType()),
        StructField("source_file", StringType()),
        StructField("orphaned_fk_column", StringType()),
        StructField("orphaned_fk_value", StringType()),
        StructField("quarantined_at", TimestampNTZType()),
        StructField("resolved", BooleanType()),
        StructField("resolved_at", TimestampNTZType()),
        # which of several equal rows of its batch this one is, from 1
        StructField("occurrence", LongType()),
    ]
)
ORPHAN_DAYS = 2
REJECTED_DAYS = 30

# microseconds survive the round trip through the payload
JSON_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def payload(columns: Iterable[str]) -> Column:
    """The row as a JSON object (null fields are left out)."""
    return F.to_json(F.struct(*columns), JSON_OPTIONS)


def unpack(df: DataFrame, column: str, schema: StructType, beside: Sequence[str] = ()) -> DataFrame:
    """Payload text back to typed columns, behind the columns ``beside`` it."""
    return df.select(*beside, F.from_json(F.col(column), schema, JSON_OPTIONS).alias("__row")).select(*beside, "__row.*")


def to_rejected(
    bad: DataFrame, batch_source: str, now: Column, reason: Column | None = None, pii: Iterable[str] = ()
) -> DataFrame:
    """Every bad row with its own reason; ``reason`` overrides (one shared by a whole file).

    ``pii`` names personal columns that are still in plain text; they are hashed.
    """
    why = reason if reason is not None else F.col(REASON)
    body = [c for c in bad.columns if c != REASON]
    bad = hash_pii(bad, [c for c in pii if c in bad.columns])
    return bad.select(
        F.expr("uuid()").alias("rejected_id"),
        payload(body).alias("record_payload"),
        why.alias("rejected_reason"),
        F.lit(batch_source).alias("batch_source"),
        now.cast("timestamp_ntz").alias("rejected_at"),
    )


# copies of a row that are numbered by one row of the plan
_COPIES = 1000


def numbered_copies(df: DataFrame, name: str) -> DataFrame:
    """``df`` with equal rows numbered from 1.

    Equal rows are counted on the map side and dealt out again in chunks, so any number of them is spread over tasks.  All
    partitions are kept: a chunk of many rows is of few bytes, and Spark would put them together by their bytes.
    """
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    n, chunk = F.col("__copies"), F.col("__chunk")
    counted = df.groupBy(*df.columns).agg(F.count("*").alias("__copies"))
    chunks = counted.withColumn("__chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / _COPIES)))).repartition(tasks)
    first = chunk * _COPIES + 1
    return chunks.select(*df.columns, F.explode(F.sequence(first, F.least(first + (_COPIES - 1), n))).alias(name))


def to_orphans(bad: DataFrame, fact_table: str, now: Column, source_file: Column | None = None) -> DataFrame:
    """One quarantine row per missing reference of every orphan row; equal rows are told apart by ``occurrence``."""
    body = [c for c in bad.columns if c not in (MISSING_REFS, ORPHAN_REASON)]
    rows = bad.select(
        payload(body).alias("record_payload"),
        (source_file if source_file is not None else F.lit(None).cast("string")).alias("source_file"),
        F.col(MISSING_REFS),
    )
    return numbered_copies(rows, "occurrence").withColumn("ref", F.explode(MISSING_REFS)).select(
        F.expr("uuid()").alias("quarantine_id"),
        "record_payload",
        F.lit(fact_table).alias("fact_table"),
        F.col("ref.dim").alias("source_table"),
        "source_file",
        F.col("ref.fk_column").alias("orphaned_fk_column"),
        F.col("ref.fk_value").alias("orphaned_fk_value"),
        now.cast("timestamp_ntz").alias("quarantined_at"),
        F.lit(False).alias("resolved"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"),
        "occurrence",
    )


def pack_list(column: str) -> Column:
    """The missing references' field as pipe-joined text."""
    return F.array_join(F.transform(F.col(MISSING_REFS), lambda r: r[column]), "|")


def mark_resolved(orphans: DataFrame, dims: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Flag the quarantine rows whose dimension row has arrived.

    ``dims`` maps a dimension name to (table, key column).  All dimensions are
    probed by one join; the dimension keys are first cut to the quarantined
    values, so a small quarantine filters large dimensions by broadcast.
    """
    wanted = orphans.select(F.col("source_table").alias("__t"), F.col("orphaned_fk_value").alias("__v")).distinct()
    keys = [
        table.select(F.lit(name).alias("dim"), F.col(pk).cast("string").alias("key_text"))
        for name, (table, pk) in dims.items()
    ]
    known = (
        reduce(DataFrame.unionByName, keys)
        .join(wanted, (F.col("dim") == F.col("__t")) & (F.col("key_text") == F.col("__v")), "left_semi")
        .distinct()
    )
    on = (F.col("source_table") == F.col("dim")) & (F.col("orphaned_fk_value") == F.col("key_text"))
    return orphans.join(known, on, "left").select(*orphans.columns, F.col("key_text").isNotNull().alias("ref_found"))


FACT_KEY = "fact_key"
READY = "ready"


def tag_retry(
    orphans: DataFrame, dims: Mapping[str, tuple[DataFrame, str]], fact_table: str, fact_key: str
) -> DataFrame:
    """Quarantine rows of one fact: is this reference found, and are all references of the payload (``ready``)?

    Each payload is judged by itself, so one that can be loaded does not wait
    for, and is not lost to, another payload of the same fact key.  Equal rows
    of one batch are payloads of their own (``occurrence``); a row that is sent
    again in a later batch has the payload and the number of the first one.
    """
    mine = orphans.filter(F.col("fact_table") == fact_table)
    tagged = mark_resolved(mine, dims).withColumn(FACT_KEY, F.get_json_object("record_payload", f"$.{fact_key}"))
    tagged = tagged.withColumn("occurrence", F.coalesce("occurrence", F.lit(1).cast("long")))
    # a digest of fixed size is sorted instead of the texts
    whole = W.partitionBy(F.md5("record_payload"), "occurrence")
    return tagged.withColumn(READY, F.min("ref_found").over(whole))


def retry_orphans(
    orphans: DataFrame, dims: Mapping[str, tuple[DataFrame, str]], fact_table: str, fact_key: str
) -> OpResult:
    """Orphans of one fact that can be loaded now, and the quarantine rows that stay.

    ``good``: one row (``record_payload``) for each quarantined row whose
    references all exist now; what was sent again counts once.  ``bad``: the
    quarantine without the rows whose reference was found.
    """
    tagged = tag_retry(orphans, dims, fact_table, fact_key)
    others = orphans.filter(~F.col("fact_table").eqNullSafe(F.lit(fact_table)))
    remaining = tagged.filter(~F.col("ref_found")).select(*orphans.columns)
    good = tagged.filter(READY).select(FACT_KEY, "record_payload", "occurrence").distinct()
    return OpResult(good.drop("occurrence"), remaining.unionByName(others))


def outdated(df: DataFrame, column: str, days: int, now: Column, unresolved_only: bool = False) -> Column:
    """True for rows older than the retention; rows without a time are not."""
    old = F.col(column) < now.cast("timestamp_ntz") - F.expr(f"interval {int(days)} days")
    if unresolved_only:
        old = old & (F.col("resolved") == F.lit(False))
    return F.coalesce(old, F.lit(False))


def expire(df: DataFrame, column: str, days: int, now: Column, unresolved_only: bool = False) -> DataFrame:
    """Drop rows older than the retention; rows without a time stay."""
    return df.filter(~outdated(df, column, days, now, unresolved_only))


def expire_orphans(orphans: DataFrame, now: Column, days: int = ORPHAN_DAYS) -> DataFrame:
    return expire(orphans, "quarantined_at", days, now, unresolved_only=True)


def expire_rejected(rejected: DataFrame, now: Column, days: int = REJECTED_DAYS) -> DataFrame:
    return expire(rejected, "rejected_at", days, now)


def union_bad_rows(frames: Iterable[DataFrame]) -> DataFrame:
    """Bad rows of several steps in one frame; absent columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
