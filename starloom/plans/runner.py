"""Running a model: daily dimension batches and micro-batches of facts."""

from __future__ import annotations

import time
import uuid
from collections.abc import Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.functions.calendar import date_dimension, day_range
from starloom.operators.lookups import (
    IS_DUPLICATE,
    ORPHAN_REASON,
    MISSING_REFS,
    duplicate_reason,
    stored_candidates,
    tag_duplicates,
    tag_orphans_by_missing_keys,
)
from starloom.operators.merge import SCD2_COLUMNS, changed_rows, scd2_changes, scd2_counts
from starloom.operators.metrics import batch_totals, percent, quality_metrics, threshold_alerts, with_rates
from starloom.operators.quarantine import (
    ORPHAN_DAYS,
    ORPHAN_SCHEMA,
    READY,
    REJECTED_DAYS,
    REJECTED_SCHEMA,
    outdated,
    tag_retry,
    to_orphans,
    to_rejected,
    unpack,
)
from starloom.operators.validation import (
    DUPLICATE,
    NULL_REQUIRED,
    ORPHAN,
    OUTCOME,
    PASSED,
    REASON,
    gate_counts,
    gate_errors,
    missing_columns,
    required_reason,
    schema_errors,
    tag_rows,
)
from starloom.operators.windows import latest_per_key
from starloom.plans.build import Model, bad_rows, build_table, good_rows, table_schema
from starloom.session import delete_folder, exclusive, scratch_path, spread, stage
from starloom.sources.files import CORRUPT, SPARK_ERRORS, error_text, match_sources, scan, tables_with_files
from starloom.sources.tables import BATCH_ID, BatchTable
from starloom.specs import FACT, SourceSpec, TableSpec, columns

RUN_LOG_SCHEMA = columns(
    "run_id string, stage string, file_name string, total_records bigint, passed_count bigint, duplicate_count bigint, "
    "null_count bigint, orphan_count bigint, quarantined_count bigint, null_rate double, orphan_rate double, "
    "processing_latency_ms bigint, "
    "scd_inserted_count bigint, scd_updated_count bigint, scd_expired_count bigint, file_success boolean, message string"
)
ALERT_SCHEMA = columns(
    "file_name string, total_records bigint, orphan_count bigint, orphan_share double, alert string"
)
# what a retry is going to load and take out of the quarantine, written before it does either
RETRY_SCHEMA = columns("quarantine_id string, fact_table string, record_payload string, loads boolean, occurrence bigint")

# what a row of the run log is about
FILE, TABLE, BATCH = "file", "table", "batch"


_ROW, _NEWEST = "__row", "__newest"

# seconds after which the mark of a running retry is taken for that of a dead one
RETRY_LEASE = 24 * 3600

# tables or sources whose jobs are submitted at the same time
PARALLEL_LOADS = 8


class Warehouse:
    """The tables of one model below a root folder."""

    def __init__(self, spark: SparkSession, root: str, model: Model, store_repeats: bool = False):
        """``store_repeats`` also keeps the dimension rows that a snapshot only sends again; they are always counted."""
        self.spark, self.root, self.model, self.store_repeats = spark, root.rstrip("/"), model, store_repeats
        self._tables: dict[str, BatchTable] = {}

    def _open(self, name: str, schema: StructType, **options) -> BatchTable:
        if name not in self._tables:
            self._tables[name] = BatchTable(self.spark, f"{self.root}/{name}", schema, **options)
        return self._tables[name]

    def table(self, name: str) -> BatchTable:
        """A fact holds all rows of its batches, a dimension the last row of each key (with history: of each version)."""
        spec = self.model.tables[name]
        if name in self._tables:
            return self._tables[name]
        schema = table_schema(self.spark, spec, self.model.sources)
        if spec.kind == FACT:
            return self._open(name, schema, partition_by=spec.partition_by)
        return self._open(name, schema, partition_by=spec.partition_by, key="surrogate_key" if spec.tracked else spec.key, latest=True)

    @property
    def rejected(self) -> BatchTable:
        return self._open("RejectedRecords", REJECTED_SCHEMA, key="rejected_id", day_of="rejected_at")

    @property
    def orphans(self) -> BatchTable:
        return self._open("OrphanRecords", ORPHAN_SCHEMA, key="quarantine_id", day_of="quarantined_at")

    @property
    def retries(self) -> BatchTable:
        return self._open("OrphanRetries", RETRY_SCHEMA)

    @property
    def run_log(self) -> BatchTable:
        return self._open("PipelineRunLog", RUN_LOG_SCHEMA)

    @property
    def alerts(self) -> BatchTable:
        return self._open("Alerts", ALERT_SCHEMA)

    def dims_of(self, table: TableSpec) -> dict[str, DataFrame]:
        """The dimensions that the table refers to, of each the key columns alone."""
        keys: dict[str, list[str]] = {}
        for r in table.dims:
            if isinstance(r.fk, str):
                keys.setdefault(r.dim, []).append(r.pk or r.fk)
        return {dim: self.table(dim).read(list(dict.fromkeys(names))) for dim, names in keys.items()}


@dataclass
class RunReport:
    """What a run did.

    ``failed`` names everything that was not loaded and why.  ``errors`` are
    those of them where a job broke, so that the same run may succeed later;
    the others are faults of the data, which is in quarantine.
    """

    batch_id: str
    loaded: list[str] = field(default_factory=list)
    failed: dict[str, list[str]] = field(default_factory=dict)
    errors: list[str] = field(default_factory=list)
    # quarantined facts were tried again; not if another run is doing it
    retried: bool = False


def _now_or(now: Column | None) -> Column:
    # one instant per run, so every row of a batch carries the same time
    return now if now is not None else F.lit(time.strftime("%Y-%m-%d %H:%M:%S", time.gmtime())).cast("timestamp_ntz")


class _Run:
    """State of one run; every write is keyed by the batch, so a repeat replaces it."""

    def __init__(self, wh: Warehouse, batch_id: str, now: Column | None):
        self.wh, self.batch_id, self.now = wh, batch_id, _now_or(now)
        self.started = time.monotonic()
        self.scratch = scratch_path(wh.spark, "run")
        self.report = RunReport(batch_id)
        self.rejected: list[DataFrame] = []
        self.orphans: list[DataFrame] = []
        self.log: list[DataFrame] = []

    def fail(self, name: str, errors: Sequence[str], started: float, what: str = FILE) -> None:
        self.report.failed.setdefault(name, []).extend(errors)
        row = self.wh.spark.range(1).select(
            F.lit(name).alias("file_name"), F.lit(0).alias("total_records"), F.lit("; ".join(errors)).alias("message")
        )
        self._log(row, started, False, what)

    def _log(
        self,
        metrics: DataFrame,
        started: float,
        ok: bool,
        what: str,
        inserted: Column | None = None,
        expired: Column | None = None,
    ) -> None:
        """One row per file or table; dimension loads also say how many rows they changed."""
        ms = int((time.monotonic() - started) * 1000)
        counts = ("total_records", "passed_count", "duplicate_count", "null_count", "orphan_count", "quarantined_count")
        rates = (("null_count", "null_rate"), ("orphan_count", "orphan_rate"))
        have = set(metrics.columns)
        self.log.append(
            metrics.select(
                F.lit(self.batch_id).alias("run_id"),
                F.lit(what).alias("stage"),
                "file_name",
                *[(F.col(c) if c in have else F.lit(0)).cast("long").alias(c) for c in counts],
                *[percent(F.col(c) if c in have else F.lit(0), F.col("total_records")).alias(n) for c, n in rates],
                F.lit(ms).cast("long").alias("processing_latency_ms"),
                *[
                    (c if c is not None else F.lit(None)).cast("long").alias(f"scd_{k}_count")
                    for k, c in (
                        ("inserted", inserted),
                        ("updated", None if inserted is None else F.col("passed_count") - inserted),
                        ("expired", expired),
                    )
                ],
                F.lit(ok).alias("file_success"),
                (F.col("message") if "message" in have else F.lit(None).cast("string")).alias("message"),
            )
        )

    def broken(self, name: str, error: Exception, started: float, what: str = FILE) -> None:
        self.report.errors.append(name)
        self.fail(name, [error_text(error)], started, what)

    def source(self, spec: SourceSpec, paths: Sequence[str]) -> DataFrame | None:
        """Read, gate, split and mask one source; None if the file is rejected."""
        started = time.monotonic()
        try:
            read = scan(self.wh.spark, spec, paths, with_corrupt=True)
            if not read.ok:
                self.report.errors.append(spec.file)
                self.fail(spec.file, read.errors, started)
                return None
            raw = spread(read.df)
            errors = missing_columns(raw, spec) if spec.validate else []
            if errors:
                errors = schema_errors(raw.drop(CORRUPT), spec)
                tagged = raw
            else:
                # one scan: the frame that forks into good rows, bad rows and counts is written, and the gate counts on the way
                gate = Observation(f"gate-{spec.name}")
                counts = gate_counts(raw.columns, spec.schema) if spec.validate else []
                tagged = stage(tag_rows(raw.observe(gate, *counts) if counts else raw, spec), spec.name, self.scratch)
                errors = gate_errors(gate.get, spec) if counts else []
            if errors:
                # the whole file is quarantined under the shared reason
                whole = tagged.select(*raw.columns)
                self.rejected.append(to_rejected(whole, spec.file, self.now, F.lit("; ".join(errors)), spec.pii))
                self.fail(spec.file, errors, started)
                return None
        except SPARK_ERRORS as e:
            self.broken(spec.file, e, started)
            return None
        self.rejected.append(to_rejected(bad_rows(tagged), spec.file, self.now, pii=spec.pii))
        self._log(quality_metrics(tagged.withColumn("file_name", F.lit(spec.file))), started, True, FILE)
        return good_rows(tagged, spec).drop(CORRUPT)

    def set_aside(self, table: TableSpec, inputs: Mapping[str, DataFrame], why: str) -> None:
        """Quarantine the sound sources of a fact that cannot be built; nobody sends them again."""
        for s, df in inputs.items():
            self.rejected.append(to_rejected(df, self.wh.model.sources[s].file, self.now, F.lit(f"{table.name} not built: {why}")))

    def split(
        self, table: TableSpec, built: DataFrame, check_refs: bool, newest: Sequence[Column] = ()
    ) -> tuple[DataFrame, DataFrame]:
        """Required fields, duplicates and orphans of a built table; the rows to load and their counts.

        With ``newest``, of several rows of one key only the first in that
        order is loaded; the others are counted and quarantined as duplicates.
        """
        store = self.wh.table(table.name)
        if newest or len(table.sources) > 1:
            df = stage(built.withColumn(_ROW, F.monotonically_increasing_id()), table.name, self.scratch)
        else:
            # expressions over a staged source: the keys are computed again, instead of writing all rows once more
            df = built.withColumn(_ROW, F.lit(None).cast("long"))
        if newest:
            # one row a key and task is shuffled; the join back is on unique row numbers
            first = latest_per_key(df.filter(F.col(table.key).isNotNull()), [table.key], newest).select(_ROW, F.lit(True).alias(_NEWEST))
            df = stage(df.join(first, _ROW, "left"), table.name, self.scratch)
        else:
            df = df.withColumn(_NEWEST, F.lit(True))
        ignore = [*self.wh.model.pii_of(table), *table.date_columns, _ROW, _NEWEST]
        # rows this batch wrote in an earlier attempt are not its duplicates
        stored = store.read(without=self.batch_id)
        if table.kind == FACT:
            stored = stored_candidates(df, stored, table.key, table.partition_by, self.scratch)
        if table.tracked:
            stored = stored.filter("is_current").drop(*SCD2_COLUMNS)
        tagged = tag_duplicates(df, stored, table.key, ignore)
        if check_refs:
            refs = [r for r in table.dims if isinstance(r.fk, str)]
            tagged = tag_orphans_by_missing_keys(tagged, self.wh.dims_of(table), refs, df, self.scratch)
        else:
            tagged = tagged.withColumns({MISSING_REFS: F.array(), ORPHAN_REASON: F.lit("")})
        required = list(dict.fromkeys([*table.required, *([table.key] if newest else [])]))
        null_reason = required_reason(required) if required else F.lit(None).cast("string")
        tagged = tagged.withColumn(REASON, null_reason).withColumn(
            OUTCOME,
            F.when(F.col(REASON).isNotNull(), NULL_REQUIRED)
            .when(F.col(IS_DUPLICATE) | F.col(_NEWEST).isNull(), DUPLICATE)
            .when(F.size(MISSING_REFS) > 0, ORPHAN)
            .otherwise(PASSED),
        )
        tagged = stage(tagged, f"{table.name}-tagged", self.scratch)

        cols = built.columns
        o = F.col(OUTCOME)
        self.rejected.append(to_rejected(tagged.filter(o == NULL_REQUIRED).select(*cols, REASON), table.name, self.now))
        repeats = tagged.filter((o == DUPLICATE) & F.col(_NEWEST).isNotNull()).select(*cols)
        if table.kind == FACT or self.wh.store_repeats:
            self.rejected.append(to_rejected(repeats, table.name, self.now, duplicate_reason(table.key, table.name)))
        if newest:
            older = tagged.filter((o == DUPLICATE) & F.col(_NEWEST).isNull()).select(*cols)
            self.rejected.append(to_rejected(older, table.name, self.now, F.lit(f"a newer row of the same {table.key} came with it")))
        if check_refs:
            lost = tagged.filter(o == ORPHAN).select(*cols, MISSING_REFS)
            self.orphans.append(
                to_orphans(lost, table.name, self.now, F.lit(self.wh.model.sources[table.sources[0]].file))
            )
        metrics = quality_metrics(tagged.withColumn("file_name", F.lit(table.name)))
        return tagged.filter(o == PASSED).select(*cols), metrics

    def finish(self) -> RunReport:
        whole = self.wh.spark.range(1).select(F.lit(self.batch_id).alias("file_name"), F.lit(0).alias("total_records"))
        self._log(whole, self.started, not self.report.failed, BATCH)
        for store, frames in (
            (self.wh.rejected, self.rejected),
            (self.wh.orphans, self.orphans),
            (self.wh.run_log, self.log),
        ):
            if frames:
                out = frames[0]
                for f in frames[1:]:
                    out = out.unionByName(f)
                store.append(out, self.batch_id)
        # the share of orphans among the rows of all tables of the batch
        totals = batch_summary(self.wh, self.batch_id).withColumn("total_records", F.col("table_records"))
        self.wh.alerts.append(threshold_alerts(totals.withColumnRenamed(BATCH_ID, "file_name")), self.batch_id)
        # all that the run has staged is written by now
        delete_folder(self.wh.spark, self.scratch)
        return self.report


def _load(run: _Run, facts: bool, paths: Iterable[str], check_dimension_keys: bool) -> None:
    """Build and store the tables that have arrived files.

    Sources are independent of each other, and so are the tables of a wave;
    their jobs are submitted together, so small tables share the cluster
    instead of queueing.
    """
    model = run.wh.model
    arrived = match_sources(paths, model.sources.values())
    targets = {t.name for t in tables_with_files(model.tables.values(), arrived) if (t.kind == FACT) == facts}
    waves = [[t for t in wave if t.name in targets] for wave in model.load_waves()]
    used = sorted({s for wave in waves for t in wave for s in t.sources if s in arrived})
    with ThreadPoolExecutor(PARALLEL_LOADS) as pool:
        prepared = dict(zip(used, pool.map(lambda s: run.source(model.sources[s], arrived[s]), used)))
        for wave in waves:
            list(pool.map(lambda t: _load_table(run, t, prepared, check_dimension_keys), wave))


def _load_table(run: _Run, table: TableSpec, prepared: Mapping[str, DataFrame | None], check_dimension_keys: bool) -> None:
    started = time.monotonic()
    inputs = {s: prepared[s] for s in table.sources if prepared.get(s) is not None}
    try:
        built = build_table(inputs, table)
        store = run.wh.table(table.name)
        if table.kind == FACT:
            rows, metrics = run.split(table, built, True)
            store.append(rows, run.batch_id)
            run._log(metrics, started, True, TABLE)
        else:
            rows, metrics = run.split(table, built, check_dimension_keys, _newest_first(built, table))
            before = store.read(without=run.batch_id)
            if table.tracked:
                counts = scd2_counts(before, rows, table.key, table.tracked).first()
                changes = scd2_changes(before, rows, table.key, table.tracked, run.now)
                new, expired = F.lit(counts.scd_inserted_count), F.lit(counts.scd_expired_count)
            else:
                changes, expired = changed_rows(before, rows, table.key), F.lit(0)
                known = store.read([table.key], without=run.batch_id).withColumnRenamed(table.key, "__known")
                new = F.lit(rows.select(table.key).join(known, F.col(table.key) == F.col("__known"), "left_anti").count())
            store.append(changes, run.batch_id)
            run._log(metrics, started, True, TABLE, new, expired)
        run.report.loaded.append(table.name)
    # a failing table is recorded; the others go on
    except ValueError as e:
        if table.kind == FACT:
            run.set_aside(table, inputs, str(e))
        run.fail(table.name, [str(e)], started, TABLE)
    except SPARK_ERRORS as e:
        run.broken(table.name, e, started, TABLE)


def _newest_first(df: DataFrame, table: TableSpec) -> list[Column]:
    order = [F.col("updated_at").desc_nulls_last()] if "updated_at" in df.columns else []
    rest = F.struct(*[F.col(c) for c in df.columns if c != table.key])
    return [*order, rest.desc()]


def run_batch(
    wh: Warehouse,
    paths: Iterable[str],
    batch_id: str | None = None,
    now: Column | None = None,
    check_dimension_keys: bool = False,
) -> RunReport:
    """Load the dimensions of one daily snapshot, then retry quarantined facts once."""
    run = _Run(wh, batch_id or f"batch-{uuid.uuid4().hex}", now)
    _load(run, False, paths, check_dimension_keys)
    report = run.finish()
    report.retried = retry_quarantine(wh)
    return report


def load_calendar(wh: Warehouse, start: str, end: str, name: str = "DateDim") -> None:
    """Fill the generated date dimension."""
    wh.table(name).append(date_dimension(day_range(wh.spark, start, end)), "calendar")


def run_micro_batch(wh: Warehouse, paths: Iterable[str], batch_id: str, now: Column | None = None) -> RunReport:
    """Append the facts of the given files; the same ``batch_id`` replaces its own rows."""
    run = _Run(wh, batch_id, now)
    _load(run, True, paths, False)
    return run.finish()


def _apply_retry(wh: Warehouse, plan: DataFrame, retry_id: str) -> None:
    """Load a planned retry and take its rows out of the quarantine; doing it again changes nothing."""
    # equal rows of one batch are loaded as often as they came, a row that was sent again once
    loads = plan.filter("loads").select("fact_table", "record_payload", "occurrence").distinct()
    for table in wh.model.tables.values():
        if table.kind == FACT:
            store = wh.table(table.name)
            ready = loads.filter(F.col("fact_table") == table.name)
            if not ready.isEmpty():
                store.append(unpack(ready, "record_payload", store.schema), retry_id)
    wh.orphans.remove(plan.select("quarantine_id"), retry_id)


def retry_quarantine(wh: Warehouse) -> bool:
    """Load orphans whose dimensions have arrived; false if another retry of the warehouse is running.

    What is going to be loaded is written down first, under a name of its own.
    A retry that stops halfway is finished by the next one under that name, so
    nothing is loaded twice; rows quarantined meanwhile are not touched.  One
    retry runs at a time: two at once would both load what both find ready.
    What a retry leaves because another one runs, the next one finds.
    """
    with exclusive(wh.spark, f"{wh.root}/OrphanRetries.running", RETRY_LEASE) as alone:
        if alone:
            _retry(wh)
    return alone


def _retry(wh: Warehouse) -> None:
    held = wh.orphans.read()
    open_ids = held.select("quarantine_id")
    begun = wh.retries.read_batches().join(open_ids, "quarantine_id", "left_semi").select(BATCH_ID).distinct()
    for r in begun.collect():  # the retries that did not finish
        _apply_retry(wh, wh.retries.read_batches().filter(F.col(BATCH_ID) == r[0]), r[0])
    scratch = scratch_path(wh.spark, "retry")
    plans = []
    for table in wh.model.tables.values():
        if table.kind == FACT:
            dims = wh.dims_of(table)
            refs = {r.dim: (dims[r.dim], r.pk or r.fk) for r in table.dims if isinstance(r.fk, str)}
            if refs:
                tagged = tag_retry(wh.orphans.read(), refs, table.name, table.key).filter("ref_found")
                plans.append(tagged.select("quarantine_id", "fact_table", "record_payload", F.col(READY).alias("loads"), "occurrence"))
    if not plans:
        return
    plan = plans[0]
    for p in plans[1:]:
        plan = plan.unionByName(p)
    plan = stage(plan, "plan", scratch)
    if not plan.isEmpty():
        retry_id = f"retry-{uuid.uuid4().hex}"
        wh.retries.append(plan, retry_id)
        _apply_retry(wh, wh.retries.read_batches().filter(F.col(BATCH_ID) == retry_id), retry_id)
    delete_folder(wh.spark, scratch)


def apply_retention(wh: Warehouse, now: Column) -> None:
    """Drop old unresolved orphans and old rejected rows, whole days as folders; rows appended meanwhile stay."""
    removal = f"retention-{uuid.uuid4().hex}"
    for store, column, days, unresolved in (
        (wh.orphans, "quarantined_at", ORPHAN_DAYS, True),
        (wh.rejected, "rejected_at", REJECTED_DAYS, False),
    ):
        store.expire(outdated(store.read(), column, days, now, unresolved), removal)


def batch_summary(wh: Warehouse, batch_id: str) -> DataFrame:
    """Totals and rates of one run: what its files held, what became of the rows of its tables, and how long it took."""
    return _summary(wh.run_log.read_batches().filter(F.col(BATCH_ID) == batch_id))


def stream_summary(wh: Warehouse, name: str) -> DataFrame:
    """The same over all triggers of the streams of one name; the latency is that of the slowest trigger."""
    stream = F.regexp_replace(BATCH_ID, r"-[0-9a-f-]{36}-\d{10,}$", "")
    return _summary(wh.run_log.read_batches().filter((stream == name) & (stream != F.col(BATCH_ID))), by=())


def _summary(log: DataFrame, by: Sequence[str] = (BATCH_ID,)) -> DataFrame:
    return with_rates(batch_totals(log, by)).withColumn("orphan_rate", percent(F.col("orphan_count"), F.col("table_records")))
