"""File round trips, declarative table builds and streams over the driver tables."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators.finders import distinct_rows
from starloom.operators.validation import to_model
from starloom.plans.build import Model, build_table, prepare_source
from starloom.plans.mapping import model_from_mapping
from starloom.plans.runner import Warehouse, run_batch, stream_summary
from starloom.queries.registry import query
from starloom.queries.roles import FACT_SQL, table
from starloom.session import scratch_path
from starloom.sources.files import date_hour_from_path, list_files, read_source
from starloom.sources.tables import BatchTable
from starloom.specs import (
    DYNAMIC_DIMENSION,
    FACT,
    Compare,
    DateDiff,
    DateKey,
    DimRef,
    JoinStep,
    SourceSpec,
    TableSpec,
    columns,
)
from starloom.streaming.micro_batch import start_stream

NOW = "timestamp_ntz '2024-02-01 00:00:00'"

ORDERS_CSV = SourceSpec(
    "orders",
    "orders.csv",
    columns(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    required=("o_orderkey", "o_custkey"),
)
EVENTS_JSON = SourceSpec(
    "events",
    "events.json",
    columns("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"),
    required=("event_id", "user_id"),
    json_lines=True,
)
TIMESTAMP = "yyyy-MM-dd HH:mm:ss.SSSSSS"

# Fixed value: records of one array; a power of two, so that no chunk holds rows of two tasks.
ARRAY_ROWS = 8192


@query("csv_roundtrip", "SELECT * FROM orders")
def csv_roundtrip(spark, sf):
    path = scratch_path(spark, "csv")
    table(spark, sf, "orders").write.option("header", "true").option("timestampNTZFormat", TIMESTAMP).csv(f"{path}/orders.csv")
    raw = read_source(spark, ORDERS_CSV, [f"{path}/orders.csv"])
    return to_model(raw, ORDERS_CSV.schema)


@query("json_roundtrip", "SELECT * FROM events")
def json_roundtrip(spark, sf):
    path = scratch_path(spark, "json")
    table(spark, sf, "events").write.option("timestampNTZFormat", TIMESTAMP).json(f"{path}/events.json")
    raw = read_source(spark, EVENTS_JSON, [f"{path}/events.json"])
    return to_model(raw, EVENTS_JSON.schema)


_BROKEN_LINE = "o_orderpriority || chr(10) || o_orderstatus"


@query("csv_multiline_roundtrip", f"SELECT o_orderkey, {_BROKEN_LINE} AS note FROM orders")
def csv_multiline_roundtrip(spark, sf):
    """Fields with line breaks stay one record."""
    path = f"{scratch_path(spark, 'csv-lines')}/notes.csv"
    notes = table(spark, sf, "orders").select("o_orderkey", F.expr(_BROKEN_LINE.replace("chr(10)", "'\n'")).alias("note"))
    notes.write.option("header", "true").csv(path)
    spec = SourceSpec("notes", "notes.csv", columns("o_orderkey bigint, note string"), multiline=True)
    return to_model(read_source(spark, spec, [path]), spec.schema)


@query("json_array_roundtrip", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def json_array_roundtrip(spark, sf):
    """Files that hold one array of records each; a day has as many as it takes."""
    path = scratch_path(spark, "json-arrays")
    events = table(spark, sf, "events")
    days = events.select(F.date_format("ts", "yyyy-MM-dd").alias("dt"), F.struct("*").alias("event"))
    # a busy day is split over tasks; rows are numbered within a task, sorted so that a repeated task numbers them alike
    by = ["dt", *[f"event.{c}" for c in events.columns]]
    numbered = days.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("n", F.monotonically_increasing_id())
    arrays = numbered.groupBy("dt", F.floor(F.col("n") / ARRAY_ROWS).alias("chunk")).agg(
        F.to_json(F.collect_list("event"), {"timestampNTZFormat": TIMESTAMP}).alias("value")
    )
    arrays.select("dt", "value").write.partitionBy("dt").option("maxRecordsPerFile", 1).text(path)
    spec = SourceSpec("events", "events.json", EVENTS_JSON.schema)
    return to_model(read_source(spark, spec, [f"{path}/*"]), spec.schema)


_EXTRA_SQL = "CAST(o_orderkey AS VARCHAR) || ',' || o_orderstatus || CASE WHEN o_orderkey % 7 = 0 THEN ',extra' ELSE '' END"


@query(
    "corrupt_rows",
    f"""SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderkey % 7 = 0 THEN {_EXTRA_SQL} END AS malformed_record FROM orders""",
)
def corrupt_rows(spark, sf):
    """Records with a field too many keep their text."""
    path = f"{scratch_path(spark, 'csv-extra')}/orders.csv"
    lines = table(spark, sf, "orders").select(F.expr(_EXTRA_SQL.replace("VARCHAR", "STRING")).alias("o_orderkey,o_orderstatus"))
    # written as one column under a header of two; nothing is quoted
    lines.write.options(header="true", quote="", sep="|").csv(path)
    spec = SourceSpec("orders", "orders.csv", columns("o_orderkey bigint, o_orderstatus string"))
    return to_model(read_source(spark, spec, [path], with_corrupt=True), spec.schema)


def _write_folders(events: DataFrame, root: str, hours: int = 6) -> None:
    """Events as arrival folders ``<date>/<hour>/events.json``, one per ``hours`` hours."""
    hour = (F.floor(F.hour("ts") / hours) * hours).cast("string")
    parts = events.withColumns(
        {"dt": F.date_format("ts", "yyyy-MM-dd"), "hr": F.lpad(hour, 2, "0"), "file": F.lit("events.json")}
    )
    # ordered by time, so a task writes few folders and a busy folder is split over tasks
    parts.repartitionByRange("dt", "hr", "event_id").write.partitionBy("dt", "hr", "file").option(
        "timestampNTZFormat", TIMESTAMP
    ).json(root)


@query(
    "path_partitions",
    """SELECT event_id, ts, strftime(ts, '%Y-%m-%d') AS file_date, lpad(CAST(hour(ts) // 6 * 6 AS VARCHAR), 2, '0') AS file_hour
       FROM events""",
)
def path_partitions(spark, sf):
    """Date and hour read back from the folder names."""
    root = scratch_path(spark, "hours")
    _write_folders(table(spark, sf, "events"), root)
    raw = read_source(spark, EVENTS_JSON, [f"{root}/*/*/*"], with_file=True)
    return date_hour_from_path(to_model(raw, EVENTS_JSON.schema)).select("event_id", "ts", "file_date", "file_hour")


@query("table_scan", "SELECT * FROM part")
def table_scan(spark, sf):
    """A whole warehouse table, written in two batches."""
    part = table(spark, sf, "part")
    store = BatchTable(spark, scratch_path(spark, "table-scan"), part.schema)
    store.append(part.filter("p_size < 25"), "small")
    store.append(part.filter("p_size >= 25 or p_size is null"), "others")
    return store.read()


@query("dedup_rows_scan", "SELECT DISTINCT * FROM lineitem")
def dedup_rows_scan(spark, sf):
    return distinct_rows(table(spark, sf, "lineitem"))


# ---- declarative builds: the driver tables as prepared sources


def _sources(spark, sf):
    orders = table(spark, sf, "orders").join(
        table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("region_id")),
        "o_custkey",
        "left",
    )
    tickets = table(spark, sf, "lineitem").withColumnsRenamed(
        {"l_orderkey": "order_id", "l_linenumber": "line_no", "l_shipdate": "resolved_at", "l_linestatus": "ticket_status"}
    )
    renames = {"o_orderkey": "order_id", "o_custkey": "customer_id", "o_orderdate": "created_at"}
    return {"tickets": tickets, "orders": orders.withColumnsRenamed(renames)}


_FACT_TABLE = TableSpec(
    "FactLines",
    FACT,
    "order_id",
    ("tickets", "orders"),
    (JoinStep("orders", "order_id", "order_id"),),
    derived=(
        DateDiff("resolution_time_min", end="resolved_at", start="created_at"),
        Compare("shipped_late", "resolved_at", ">", "created_at"),
        DateKey("date_key_created", "created_at"),
    ),
    renamed={"ticket_status": "status", "absent": "ignored"},
    keep=(
        "order_id", "line_no", "customer_id", "region_id", "status", "resolution_time_min", "shipped_late", "date_key_created",
    ),
)


@query(
    "fact_table_build",
    f"""WITH {FACT_SQL} SELECT ticket_id AS order_id, line_no, customer_id, region_id, status, resolution_time_min,
          coalesce(resolved_at > created_at, FALSE) AS shipped_late, date_key_created FROM fact""",
)
def fact_table_build(spark, sf):
    return build_table(_sources(spark, sf), _FACT_TABLE)


_CUSTOMERS = SourceSpec(
    "customers",
    "customer.parquet",
    columns("c_custkey int, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    required=("c_custkey", "c_name"),
    pii=("c_name",),
)
_NATIONS = SourceSpec("nations", "nation.parquet", columns("n_nationkey int, n_name string, n_regionkey int"), dynamic=False)
_CUSTOMERS_DIM = TableSpec(
    "CustomersDim",
    DYNAMIC_DIMENSION,
    "customer_id",
    ("customers", "nations"),
    (JoinStep("nations", "c_nationkey", "n_nationkey"),),
    renamed={"c_custkey": "customer_id", "c_name": "full_name", "n_name": "region_name", "c_mktsegment": "segment_name"},
    keep=("customer_id", "full_name", "region_name", "segment_name", "c_acctbal"),
    required=("customer_id", "full_name"),
)
_DIM_SQL = """SELECT CAST(c_custkey AS INTEGER) AS customer_id, sha256(c_name) AS full_name, n_name AS region_name,
    c_mktsegment AS segment_name, c_acctbal FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey"""


@query("dim_table_build", _DIM_SQL)
def dim_table_build(spark, sf):
    """Read as text, check, cast, hash and join."""
    inputs = {
        s.name: prepare_source(read_source(spark, s, [f"{sf}/{s.file}"]), s).good for s in (_CUSTOMERS, _NATIONS)
    }
    return build_table(inputs, _CUSTOMERS_DIM)


@query("source_chain", "SELECT sha256(s_name) AS s_name, s_suppkey, s_nationkey FROM supplier")
def source_chain(spark, sf):
    spec = SourceSpec("suppliers", "supplier.parquet", columns("s_suppkey bigint, s_name string, s_nationkey int"), pii=("s_name",))
    suppliers = read_source(spark, spec, [f"{sf}/{spec.file}"]).drop("s_acctbal")
    return prepare_source(suppliers, spec).good


# ---- batch and stream runs into a warehouse of one dimension and one fact

_EVENT_FACT = TableSpec(
    "FactEvents",
    FACT,
    "event_id",
    ("events",),
    derived=(DateKey("date_key", "ts"),),
    renamed={"user_id": "customer_id"},
    keep=("event_id", "customer_id", "event_type", "value", "ts", "date_key"),
    dims=(DimRef("CustomersDim", "customer_id"),),
    date_columns=("ts", "date_key"),
)
_EVENT_MODEL = Model(
    {s.name: s for s in (_CUSTOMERS, _NATIONS, EVENTS_JSON)}, {t.name: t for t in (_CUSTOMERS_DIM, _EVENT_FACT)}
)


def _loaded_dims(spark: SparkSession, sf: str, wh: Warehouse) -> None:
    """The daily snapshot of the dimension: the customers that are not in debt."""
    day = f"{wh.root}-raw/batch/2024-01-01"
    table(spark, sf, "customer").filter("c_acctbal >= 0").write.parquet(f"{day}/customer.parquet")
    table(spark, sf, "nation").write.parquet(f"{day}/nation.parquet")
    paths = [f"{day}/customer.parquet", f"{day}/nation.parquet"]
    run_batch(wh, paths, "2024-01-01", F.expr(NOW))


def _stored_dims(spark: SparkSession, sf: str, wh: Warehouse) -> None:
    """The same dimension written directly."""
    wh.table("CustomersDim").append(dim_table_build(spark, sf).filter("c_acctbal >= 0"), "first")


def _warehouse(spark: SparkSession, name: str) -> Warehouse:
    return Warehouse(spark, scratch_path(spark, name), _EVENT_MODEL)


@query("batch_run_dimension", _DIM_SQL + " WHERE c_acctbal >= 0")
def batch_run_dimension(spark, sf):
    wh = _warehouse(spark, "batch")
    _loaded_dims(spark, sf, wh)
    return wh.table("CustomersDim").read()


@query(
    "batch_rejections",
    """SELECT c_custkey AS id, 'no value in c_name' AS reason, 'customer.parquet' AS batch_source FROM customer WHERE c_mktsegment = 'BUILDING'
       UNION ALL SELECT c_custkey, 'no value in region_name', 'CustomersDim' FROM customer WHERE c_mktsegment <> 'BUILDING' AND c_nationkey >= 20""",
)
def batch_rejections(spark, sf):
    """Rows that a batch rejects: in the source for its required fields, in the built table for its own."""
    table_ = replace(_CUSTOMERS_DIM, required=(*_CUSTOMERS_DIM.required, "region_name"))
    wh = Warehouse(spark, scratch_path(spark, "rejections"), Model({s.name: s for s in (_CUSTOMERS, _NATIONS)}, {table_.name: table_}))
    day = f"{wh.root}-raw/batch/2024-01-01"
    nameless = F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_name"))
    table(spark, sf, "customer").withColumn("c_name", nameless).write.parquet(f"{day}/customer.parquet")
    table(spark, sf, "nation").filter("n_nationkey < 20").write.parquet(f"{day}/nation.parquet")
    run_batch(wh, [f"{day}/customer.parquet", f"{day}/nation.parquet"], "2024-01-01", F.expr(NOW))
    key = F.coalesce(*[F.get_json_object("record_payload", f"$.{c}") for c in ("c_custkey", "customer_id")]).cast("long")
    return wh.rejected.read().select(key.alias("id"), F.col("rejected_reason").alias("reason"), "batch_source")


@query(
    "batch_fault_isolation",
    """SELECT 'customer.parquet' AS file_name, TRUE AS file_success, count(*) AS total_records FROM customer
       UNION ALL SELECT 'CustomersDim', TRUE, count(*) FROM customer
       UNION ALL SELECT 'nation.parquet', FALSE, 0 UNION ALL SELECT 'NationsDim', FALSE, 0""",
)
def batch_fault_isolation(spark, sf):
    """A file that cannot be read and the table that needs it are recorded as failed; the other table is loaded."""
    tables = (
        replace(_CUSTOMERS_DIM, sources=("customers",), joins=(), keep=("customer_id", "full_name", "segment_name")),
        TableSpec("NationsDim", DYNAMIC_DIMENSION, "n_nationkey", ("nations",)),
    )
    wh = Warehouse(spark, scratch_path(spark, "faults"), Model({s.name: s for s in (_CUSTOMERS, _NATIONS)}, {t.name: t for t in tables}))
    day = f"{wh.root}-raw/batch/2024-01-01"
    table(spark, sf, "customer").write.parquet(f"{day}/customer.parquet")
    # text in files that are named as parquet
    table(spark, sf, "nation").select("n_name").write.text(f"{day}/nation.parquet")
    files = [r.path for r in list_files(spark, day).collect()]  # a few files
    run_batch(wh, files, "2024-01-01", F.expr(NOW))
    return wh.run_log.read().filter("stage <> 'batch'").select("file_name", "file_success", "total_records")


_STREAM_SQL = """SELECT event_id, user_id AS customer_id, event_type, value, ts, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key
  FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)"""


def _stream(spark: SparkSession, wh: Warehouse, root: str, checkpoint: str, name: str | None = None) -> None:
    stream = start_stream(wh, root, f"{wh.root}-{checkpoint}", available_now=True, now=F.expr(NOW), name=name or checkpoint)
    stream.awaitTermination()


@query("stream_micro_batch", _STREAM_SQL)
def stream_micro_batch(spark, sf):
    """Hour folders of events through the streaming load; the fact is returned."""
    wh = _warehouse(spark, "stream")
    _stored_dims(spark, sf, wh)
    hours = f"{wh.root}-raw/stream"
    _write_folders(table(spark, sf, "events"), hours)
    _stream(spark, wh, hours, "first")
    return wh.table("FactEvents").read()


# the same warehouse as a mapping, as it would be read from a file
_EVENT_MAPPING = {
    "files": {
        "customers": {"file_name": "customer.parquet", "model_class": "Customer", "required_fields": ["c_custkey", "c_name"], "pii_fields": ["c_name"]},
        "nations": {"file_name": "nation.parquet", "file_type": "static", "model_class": "Nation"},
        "events": {"file_name": "events.json", "file_type": "dynamic", "model_class": "Event", "required_fields": ["event_id", "user_id"], "json_lines": True},
    },
    "tables": {
        "CustomersDim": {
            "source": ["customers", "nations"],
            "joins": [{"left": "customers", "right": ["nations"], "left_keys": ["c_nationkey"], "right_keys": ["n_nationkey"], "type": "left"}],
            "renamed_columns": {"c_custkey": "CUSTOMER_ID", "c_name": "full_name", "n_name": "region_name", "c_mktsegment": "segment_name"},
            "table_type": "dynamic_dimension",
            "primary_key": "customer_id",
            "keep_columns": ["CUSTOMER_ID", "full_name", "region_name", "segment_name", "c_acctbal"],
            "required_fields": ["customer_id", "full_name"],
        },
        "FactEvents": {
            "source": "events",
            "renamed_columns": {"user_id": "customer_id", "date_key_event": "DATE_KEY"},
            "dimension_sources": [{"dim": "CustomersDim", "fk": "customer_id", "type": "left"}],
            "table_type": "fact",
            "primary_key": "event_id",
            "keep_columns": ["event_id", "customer_id", "event_type", "value", "ts", "DATE_KEY"],
            "date_columns": ["ts", "DATE_KEY"],
            "aggregated_columns": [
                {"component": "Transformer", "actions": [{"name": "date_key_event", "type": "date_to_key", "params": {"column": "ts"}}]}
            ],
        },
        "RejectedRecords": {"table_type": "quarantine_zone", "primary_key": "rejected_id"},
    },
}
_EVENT_SCHEMAS = {"Customer": _CUSTOMERS.schema, "Nation": _NATIONS.schema, "Event": EVENTS_JSON.schema}


@query("mapped_model_run", _STREAM_SQL)
def mapped_model_run(spark, sf):
    """A warehouse from a mapping: the daily snapshot of its dimension, then its fact from hour folders."""
    wh = Warehouse(spark, scratch_path(spark, "mapped"), model_from_mapping(_EVENT_MAPPING, _EVENT_SCHEMAS))
    _loaded_dims(spark, sf, wh)
    hours = f"{wh.root}-raw/stream"
    _write_folders(table(spark, sf, "events"), hours)
    _stream(spark, wh, hours, "mapped")
    return wh.table("FactEvents").read()


@query("stream_restart_new_checkpoint", _STREAM_SQL)
def stream_restart_new_checkpoint(spark, sf):
    """A stream of the same name with a new checkpoint adds to what the first one has loaded."""
    wh = _warehouse(spark, "restart")
    _stored_dims(spark, sf, wh)
    events, hours = table(spark, sf, "events"), f"{wh.root}-raw/stream"
    early = F.col("ts") < F.expr("timestamp_ntz '2024-01-15 00:00:00'")
    _write_folders(events.filter(early), f"{hours}/a")
    _stream(spark, wh, hours, "first", "events")
    _write_folders(events.filter(~early), f"{hours}/b")
    _stream(spark, wh, hours, "second", "events")
    return wh.table("FactEvents").read()


@query("late_files_loaded", _STREAM_SQL)
def late_files_loaded(spark, sf):
    """A third of the events comes when their hour folders are loaded already: the fact is that of a timely load."""
    wh = _warehouse(spark, "late")
    _stored_dims(spark, sf, wh)
    events, hours = table(spark, sf, "events"), f"{wh.root}-raw/stream"
    late = F.col("event_id") % 3 == 0
    _write_folders(events.filter(~late), f"{hours}/a")
    _stream(spark, wh, hours, "first")
    _write_folders(events.filter(late), f"{hours}/b")
    _stream(spark, wh, hours, "first")
    return wh.table("FactEvents").read()


@query("stream_replay_idempotent", _STREAM_SQL)
def stream_replay_idempotent(spark, sf):
    """The same folders sent again by a second stream: its rows are duplicates."""
    wh = _warehouse(spark, "replay")
    _stored_dims(spark, sf, wh)
    hours = f"{wh.root}-raw/stream"
    _write_folders(table(spark, sf, "events"), hours)
    _stream(spark, wh, hours, "first")
    _stream(spark, wh, hours, "second")
    return wh.table("FactEvents").read()


@query(
    "stream_orphans_retried",
    """SELECT event_id, user_id AS customer_id, event_type, value, ts, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key
       FROM events WHERE user_id IN (SELECT c_custkey FROM customer)""",
)
def stream_orphans_retried(spark, sf):
    """Orphans of the stream are loaded once their customers arrive with the next snapshot."""
    wh = _warehouse(spark, "retry")
    _stored_dims(spark, sf, wh)
    hours = f"{wh.root}-raw/stream"
    _write_folders(table(spark, sf, "events"), hours)
    _stream(spark, wh, hours, "first")
    day = f"{wh.root}-raw/batch/2024-01-02"
    table(spark, sf, "customer").write.parquet(f"{day}/customer.parquet")
    table(spark, sf, "nation").write.parquet(f"{day}/nation.parquet")
    paths = [r.path for r in list_files(spark, day).collect()]
    run_batch(wh, paths, "2024-01-02", F.expr(NOW))
    return wh.table("FactEvents").read()


@query(
    "run_log_metrics",
    """SELECT 'FactEvents' AS file_name, count(*) AS total_records,
          count(*) FILTER (user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) AS passed_count,
          count(*) FILTER (user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) AS orphan_count FROM events
       UNION ALL SELECT 'events.json', count(*), count(*), 0 FROM events""",
)
def run_log_metrics(spark, sf):
    """The run log of a streamed load: one row per file and per table."""
    wh = _warehouse(spark, "log")
    _stored_dims(spark, sf, wh)
    hours = f"{wh.root}-raw/stream"
    _write_folders(table(spark, sf, "events"), hours)
    _stream(spark, wh, hours, "first")
    log = wh.run_log.read_batches().filter(F.col("batch_id").startswith("first") & (F.col("stage") != "batch"))
    return log.select("file_name", "total_records", "passed_count", "orphan_count")


@query(
    "batch_summary",
    """SELECT count(*) AS total_records, count(*) AS table_records,
          count(*) FILTER (user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) AS passed_count,
          count(*) FILTER (user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) AS orphan_count,
          round(count(*) FILTER (user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)) * 100.0 / count(*), 2) AS orphan_rate
       FROM events""",
)
def batch_summary_query(spark, sf):
    """Totals of a streamed load: every record counts once."""
    wh = _warehouse(spark, "summary")
    _stored_dims(spark, sf, wh)
    hours = f"{wh.root}-raw/stream"
    _write_folders(table(spark, sf, "events"), hours)
    _stream(spark, wh, hours, "first")
    summary = stream_summary(wh, "first")
    return summary.select("total_records", "table_records", "passed_count", "orphan_count", "orphan_rate")
