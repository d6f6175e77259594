"""Headline queries at one scale; prints a single JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from starloom.queries.catalogue import QUERIES
from starloom.session import local_session

HEADLINE = (
    "join_chain_multi",
    "join_chain_full",
    "star_join",
    "orphan_clean",
    "orphan_exploded",
    "orphan_rows_by_missing_keys",
    "duplicate_rows",
    "nonduplicate_rows",
    "type_split_good",
    "type_split_bad",
    "schema_type_gate",
    "pii_hash",
    "derive_date_diff_m",
    "derive_chain",
    "merge_upsert",
    "merge_latest_of_changes",
    "scd2_merge",
    "latest_per_key",
    "dedup_keep_first",
    "reopened_events",
    "orphan_retry_resolved",
    "retention_orphans",
    "measure_cards",
    "tickets_by_city",
    "tickets_by_restaurant",
    "measures_with_slicers",
    "measures_long",
    "breach_rate_by_city",
    "top_k_reasons",
    "date_rollup",
    "quality_rates",
    "fact_table_build",
    "csv_roundtrip",
    "json_roundtrip",
    "sla_breach_by_region",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = local_session("starloom-bench", cpus, int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    # every table once, so that no query pays for the first read
    for t in ("lineitem", "orders", "customer", "supplier", "part", "nation", "region", "events"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        # the sink takes every row of the full result and keeps nothing
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    total = round(sum(seconds.values()), 3)
    spark.stop()
    line = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds}
    print(json.dumps({**line, "sf": sf_dir.rsplit("sf", 1)[-1], "cpus": cpus}))


if __name__ == "__main__":
    main()
