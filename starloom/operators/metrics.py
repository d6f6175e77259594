"""Data-quality metrics from rows tagged with their outcome."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.operators.validation import DUPLICATE, INVALID, NULL_REQUIRED, ORPHAN, OUTCOME, PASSED

# Fixed value: alert when more than this share of the records are orphans.
ORPHAN_ALERT_SHARE = 0.5


def quality_metrics(tagged: DataFrame, by: Iterable[str] = ("file_name",)) -> DataFrame:
    """Counts per file.  Every row counts once, under its outcome."""
    o = F.col(OUTCOME)
    return tagged.groupBy(*by).agg(
        F.count("*").alias("total_records"),
        F.count_if(o == PASSED).alias("passed_count"),
        F.count_if(o == DUPLICATE).alias("duplicate_count"),
        F.count_if(o == NULL_REQUIRED).alias("null_count"),
        F.count_if(o == ORPHAN).alias("orphan_count"),
        F.count_if(o.isin(DUPLICATE, NULL_REQUIRED, ORPHAN, INVALID)).alias("quarantined_count"),
    )


def percent(part: Column, whole: Column) -> Column:
    return F.round(part * F.lit(100.0) / F.greatest(whole, F.lit(1)), 2)


def with_rates(metrics: DataFrame) -> DataFrame:
    """Percentages of the total, referential integrity and the residual bad rows."""
    total = F.col("total_records")
    bad = F.col("quarantined_count") - F.col("duplicate_count") - F.col("null_count") - F.col("orphan_count")
    checked = F.col("passed_count") + F.col("orphan_count")
    return metrics.withColumns(
        {
            "passed_rate": percent(F.col("passed_count"), total),
            "duplicate_rate": percent(F.col("duplicate_count"), total),
            "null_rate": percent(F.col("null_count"), total),
            "orphan_rate": percent(F.col("orphan_count"), total),
            "quarantine_rate": percent(F.col("quarantined_count"), total),
            "bad_rows": bad,
            "bad_rows_rate": percent(bad, total),
            "referential_integrity_rate": percent(checked - F.col("orphan_count"), checked),
        }
    )


def batch_rollup(file_metrics: DataFrame, by: Iterable[str] = ("batch_id",)) -> DataFrame:
    """Batch totals over per-file metrics (with ``file_success``)."""
    ok = F.coalesce(F.col("file_success"), F.lit(True))
    return file_metrics.groupBy(*by).agg(
        F.count("*").alias("files_processed"),
        F.count_if(~ok).alias("files_failed"),
        F.count_if(ok & (F.col("quarantined_count") > 0)).alias("files_with_issues"),
        *[
            F.sum(c).alias(c)
            for c in (
                "total_records",
                "passed_count",
                "duplicate_count",
                "null_count",
                "orphan_count",
                "quarantined_count",
            )
        ],
    )


def batch_totals(log: DataFrame, by: Iterable[str] = ("batch_id",)) -> DataFrame:
    """Run log rows added up by batch.

    Files say what came in, tables what became of it; a row is rejected in one
    of the two.  No record is counted at both.
    """
    is_file, is_table = F.col("stage") == "file", F.col("stage") == "table"
    ok = F.coalesce(F.col("file_success"), F.lit(True))
    total = lambda c, where: F.coalesce(F.sum(F.when(where, F.col(c))), F.lit(0))
    return log.groupBy(*by).agg(
        F.count_if(is_file).alias("files_processed"),
        F.count_if(~ok & (is_file | is_table)).alias("files_failed"),
        F.count_if(ok & is_file & (F.col("quarantined_count") > 0)).alias("files_with_issues"),
        total("total_records", is_file).alias("total_records"),
        total("total_records", is_table).alias("table_records"),
        total("passed_count", is_table).alias("passed_count"),
        total("duplicate_count", is_file | is_table).alias("duplicate_count"),
        total("null_count", is_file | is_table).alias("null_count"),
        total("orphan_count", is_table).alias("orphan_count"),
        total("quarantined_count", is_file | is_table).alias("quarantined_count"),
        F.max(F.when(F.col("stage") == "batch", F.col("processing_latency_ms"))).alias("batch_latency_ms"),
    )


def null_counts(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """One row per column with its null count, from a single pass."""
    columns = list(columns or df.columns)
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("null_count")) for c in columns])
    return counted.select(F.inline(pairs))


def threshold_alerts(metrics: DataFrame, share: float = ORPHAN_ALERT_SHARE) -> DataFrame:
    """Metric rows whose orphan share is above the threshold, with a message."""
    ratio = F.col("orphan_count") / F.greatest(F.col("total_records"), F.lit(1))
    return (
        metrics.withColumn("orphan_share", ratio)
        .filter(F.col("orphan_share") > F.lit(share))
        .withColumn("alert", F.lit(f"orphan share above {share}"))
    )
