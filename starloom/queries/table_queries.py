"""Table changes, history, quarantine and retention on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions.derive import date_to_key
from starloom.operators.finders import (
    all_keys,
    any_true,
    attribute_lookup,
    columns_by_keys,
    columns_of,
    distinct_rows,
    distinct_values,
    in_range,
    point_lookup,
)
from starloom.operators.lookups import split_duplicates, split_orphans
from starloom.operators.merge import (
    changed_rows,
    delete_orphaned_fk,
    delete_by_id,
    delete_keys,
    delete_matching,
    delete_where,
    merge_small_update,
    merge_upsert,
    scd2_counts,
    scd2_merge,
    scd2_surrogate,
    soft_delete,
    update_by_id,
    update_where,
)
from starloom.operators.quarantine import expire_orphans, expire_rejected, outdated, retry_orphans, to_orphans, to_rejected, union_bad_rows, unpack
from starloom.operators.shape import filter_equal, filter_not_equal, filter_not_null, hierarchy_slicer, slicer
from starloom.operators.windows import dedup_keep_first, latest_per_key, reopened_events, validity_ranges
from starloom.queries.registry import query
from starloom.queries.roles import FACT_SQL, TICKETS_SQL, fact, table, tickets
from starloom.session import scratch_path, stage
from starloom.sources.tables import BatchTable
from starloom.specs import DimRef, columns

NOW = "timestamp_ntz '2024-01-31 00:00:00'"


def _now():
    return F.expr(NOW)


# ---- upsert: stored customers without the machinery segment; the snapshot
# brings the customers with a balance from 1000 up, changed


def _stored(spark, sf):
    return table(spark, sf, "customer").filter("c_mktsegment <> 'MACHINERY'")


def _snapshot(spark, sf):
    return (
        table(spark, sf, "customer")
        .filter("c_acctbal >= 1000")
        .select(
            "c_custkey",
            F.upper("c_name").alias("c_name"),
            "c_nationkey",
            F.expr("CASE WHEN c_acctbal < 9000 THEN c_acctbal + 1 END").alias("c_acctbal"),
            "c_mktsegment",
        )
    )


_MERGE_SQL = """WITH t AS (SELECT * FROM customer WHERE c_mktsegment <> 'MACHINERY'),
u AS (SELECT c_custkey, upper(c_name) AS c_name, c_nationkey, CASE WHEN c_acctbal < 9000 THEN c_acctbal + 1 END AS c_acctbal,
             c_mktsegment FROM customer WHERE c_acctbal >= 1000)
"""


@query(
    "merge_upsert",
    _MERGE_SQL + "SELECT * FROM u UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.c_custkey = t.c_custkey)",
)
def merge_upsert_query(spark, sf):
    return merge_upsert(_stored(spark, sf), _snapshot(spark, sf), "c_custkey")


_PARTIAL_SQL = (
    _MERGE_SQL
    + """SELECT coalesce(t.c_custkey, u.c_custkey) AS c_custkey, CASE WHEN u.c_custkey IS NULL THEN t.c_name ELSE u.c_name END AS c_name,
           t.c_nationkey, CASE WHEN u.c_custkey IS NULL THEN t.c_acctbal ELSE u.c_acctbal END AS c_acctbal, t.c_mktsegment
         FROM t FULL JOIN u ON t.c_custkey = u.c_custkey"""
)


@query("merge_partial_columns", _PARTIAL_SQL)
def merge_partial_columns(spark, sf):
    return merge_upsert(_stored(spark, sf), _snapshot(spark, sf), "c_custkey", ["c_name", "c_acctbal"])


@query("merge_small_update", _PARTIAL_SQL)
def merge_small_update_query(spark, sf):
    return merge_small_update(_stored(spark, sf), _snapshot(spark, sf), "c_custkey", ["c_name", "c_acctbal"])


@query(
    "merge_latest_of_changes",
    """WITH ranked AS (SELECT l_partkey, l_extendedprice, l_shipdate, row_number() OVER (PARTITION BY l_partkey
           ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS r
         FROM lineitem)
       SELECT p_partkey, p_name, CASE WHEN l_partkey IS NULL THEN p_retailprice ELSE l_extendedprice END AS p_retailprice
       FROM part LEFT JOIN ranked ON l_partkey = p_partkey AND r = 1""",
)
def merge_latest_of_changes(spark, sf):
    """Several changes per key: only the latest may reach the merge."""
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey", "l_quantity", "l_extendedprice"]
    latest = latest_per_key(table(spark, sf, "lineitem"), ["l_partkey"], [F.col(c).desc() for c in order])
    changes = latest.select(F.col("l_partkey").alias("p_partkey"), F.col("l_extendedprice").alias("p_retailprice"))
    return merge_upsert(table(spark, sf, "part").select("p_partkey", "p_name", "p_retailprice"), changes, "p_partkey")


@query(
    "update_where",
    """SELECT o_orderkey, o_custkey, CASE WHEN o_totalprice > 300000 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
              CASE WHEN o_totalprice > 300000 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders""",
)
def update_where_query(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")
    return update_where(orders, F.col("o_totalprice") > 300000, {"o_orderstatus": "X", "o_totalprice": F.col("o_totalprice") * 2})


@query(
    "update_by_id",
    "SELECT s_suppkey, CASE WHEN s_suppkey = 7 THEN 'renamed' ELSE s_name END AS s_name, s_nationkey, s_acctbal FROM supplier",
)
def update_by_id_query(spark, sf):
    return update_by_id(table(spark, sf, "supplier"), "s_suppkey", 7, {"s_name": "renamed"})


@query("delete_by_id", "SELECT * FROM supplier WHERE s_suppkey <> 7")
def delete_by_id_query(spark, sf):
    return delete_by_id(table(spark, sf, "supplier"), "s_suppkey", 7)


@query("delete_keys", "SELECT * FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def delete_keys_query(spark, sf):
    big = table(spark, sf, "orders").filter("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey"))
    return delete_keys(table(spark, sf, "customer"), big, "c_custkey")


@query("delete_filters", "SELECT * FROM customer WHERE NOT (c_mktsegment = 'HOUSEHOLD' AND c_nationkey = 2)")
def delete_filters(spark, sf):
    return delete_matching(table(spark, sf, "customer"), {"c_mktsegment": "HOUSEHOLD", "c_nationkey": 2})


@query(
    "delete_where_null_stays",
    "SELECT l_orderkey, l_linenumber, nullif(l_discount, 0) AS discount FROM lineitem WHERE l_discount = 0 OR l_discount < 0.05",
)
def delete_where_null_stays(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", F.expr("nullif(l_discount, 0)").alias("discount"))
    return delete_where(lines, F.col("discount") >= 0.05)


@query(
    "soft_delete",
    """SELECT s_suppkey, s_name, s_acctbal, s_acctbal >= 0 AS is_active FROM supplier""",
)
def soft_delete_query(spark, sf):
    suppliers = table(spark, sf, "supplier").select("s_suppkey", "s_name", "s_acctbal", F.lit(True).alias("is_active"))
    return soft_delete(suppliers, F.col("s_acctbal") < 0)


# ---- history


def _history(spark, sf):
    """Stored versions: current for most segments, closed for automobiles."""
    start = F.expr("date '2020-01-01'")
    closed = F.col("c_mktsegment") == "AUTOMOBILE"
    return _stored(spark, sf).select(
        "c_custkey",
        "c_name",
        "c_acctbal",
        scd2_surrogate(F.col("c_custkey"), start).alias("surrogate_key"),
        start.alias("valid_from"),
        F.when(closed, F.expr("date '2021-06-30'")).alias("valid_to"),
        (~closed).alias("is_current"),
    )


_HISTORY_SQL = """WITH h AS (SELECT c_custkey, c_name, c_acctbal, sha256(c_custkey || '|2020-01-01') AS surrogate_key,
    DATE '2020-01-01' AS valid_from, CASE WHEN c_mktsegment = 'AUTOMOBILE' THEN DATE '2021-06-30' END AS valid_to,
    c_mktsegment <> 'AUTOMOBILE' AS is_current FROM customer WHERE c_mktsegment <> 'MACHINERY'),
s AS (SELECT c_custkey, CASE WHEN c_nationkey < 12 THEN upper(c_name) ELSE c_name END AS c_name, c_acctbal + 5 AS c_acctbal FROM customer
      WHERE c_acctbal >= 1000),
fresh AS (SELECT s.*, sha256(s.c_custkey || '|2024-01-01') AS surrogate_key, DATE '2024-01-01' AS valid_from, CAST(NULL AS DATE) AS valid_to,
            TRUE AS is_current FROM s LEFT JOIN h ON h.c_custkey = s.c_custkey AND h.is_current
          WHERE h.c_custkey IS NULL OR h.c_name IS DISTINCT FROM s.c_name),
merged AS (
  SELECT h.* FROM h WHERE NOT is_current OR NOT EXISTS (SELECT 1 FROM s WHERE s.c_custkey = h.c_custkey AND s.c_name IS DISTINCT FROM h.c_name)
  UNION ALL
  SELECT h.c_custkey, h.c_name, h.c_acctbal, h.surrogate_key, h.valid_from, DATE '2024-01-01', FALSE FROM h
  JOIN s ON s.c_custkey = h.c_custkey WHERE h.is_current AND s.c_name IS DISTINCT FROM h.c_name
  UNION ALL SELECT * FROM fresh)
"""


def _scd2(spark, sf):
    snapshot = (
        table(spark, sf, "customer")
        .filter("c_acctbal >= 1000")
        .select(
            "c_custkey",
            F.expr("CASE WHEN c_nationkey < 12 THEN upper(c_name) ELSE c_name END").alias("c_name"),
            (F.col("c_acctbal") + 5).alias("c_acctbal"),
        )
    )
    return _history(spark, sf), snapshot


@query("scd2_merge", _HISTORY_SQL + "SELECT * FROM merged")
def scd2_merge_query(spark, sf):
    return scd2_merge(*_scd2(spark, sf), "c_custkey", ["c_name"], F.expr("date '2024-01-01'"))


@query(
    "scd2_counts",
    _HISTORY_SQL
    + """SELECT count(*) FILTER (c_custkey NOT IN (SELECT c_custkey FROM h WHERE is_current)) AS scd_inserted_count,
                count(*) FILTER (c_custkey IN (SELECT c_custkey FROM h WHERE is_current)) AS scd_updated_count,
                (SELECT count(*) FROM h JOIN merged m ON h.surrogate_key = m.surrogate_key WHERE h.is_current AND NOT m.is_current)
                  AS scd_expired_count FROM fresh""",
)
def scd2_counts_query(spark, sf):
    return scd2_counts(*_scd2(spark, sf), "c_custkey", ["c_name"])


@query(
    "validity_ranges",
    """SELECT event_id, user_id, ts AS valid_from, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS valid_to,
              lead(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL AS is_current FROM events""",
)
def validity_ranges_query(spark, sf):
    versions = table(spark, sf, "events").select("event_id", "user_id", F.col("ts").alias("valid_from"))
    return validity_ranges(versions, "user_id", "valid_from")


@query(
    "latest_per_key",
    """SELECT event_id, user_id, event_type, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r
       FROM events) WHERE r = 1""",
)
def latest_per_key_query(spark, sf):
    events = table(spark, sf, "events").select("event_id", "user_id", "event_type", "ts")
    return latest_per_key(events, ["user_id"], [F.col("ts").desc(), F.col("event_id").desc()])


_LINE_ORDER = "l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"


@query(
    "dedup_keep_first",
    f"""SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_LINE_ORDER}) AS r
        FROM lineitem) WHERE r = 1""",
)
def dedup_keep_first_query(spark, sf):
    return dedup_keep_first(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], _LINE_ORDER.split(", "))


_STATUS = "CASE event_type WHEN 'purchase' THEN 'resolved' WHEN 'error' THEN 'closed' WHEN 'signup' THEN 'open' ELSE 'pending' END"


@query(
    "reopened_events",
    f"""WITH e AS (SELECT event_id, user_id AS ticket_id, ts AS event_ts, {_STATUS} AS new_status FROM events),
        p AS (SELECT *, lag(new_status) OVER (PARTITION BY ticket_id ORDER BY event_ts, event_id) AS previous_status FROM e)
        SELECT *, coalesce(previous_status IN ('resolved', 'closed') AND new_status IN ('open', 'reopened'), FALSE) AS is_reopened
        FROM p""",
)
def reopened_events_query(spark, sf):
    events = table(spark, sf, "events").select(
        "event_id", F.col("user_id").alias("ticket_id"), F.col("ts").alias("event_ts"), F.expr(_STATUS).alias("new_status")
    )
    return reopened_events(events, "ticket_id", ["event_ts", "event_id"], "new_status")


# ---- quarantine


def _event_fact(spark, sf):
    return table(spark, sf, "events").select("event_id", "ts", F.col("user_id").alias("customer_id"), "event_type", "value")


def _loaded_customers(spark, sf, low):
    return table(spark, sf, "customer").filter(F.col("c_acctbal") >= low).select(F.col("c_custkey").alias("customer_id"))


def _types(spark, sf, kinds):
    names = table(spark, sf, "events").select(F.col("event_type")).distinct()
    return names.filter(F.col("event_type").isin(*kinds))


_REFS = [DimRef("CustomersDim", "customer_id"), DimRef("TypesDim", "event_type")]


def _quarantine(spark, sf):
    """Orphans of the event fact: rich customers only, three event types known."""
    dims = {"CustomersDim": _loaded_customers(spark, sf, 3000), "TypesDim": _types(spark, sf, ["click", "view", "purchase"])}
    bad = split_orphans(_event_fact(spark, sf), dims, _REFS).bad
    return to_orphans(bad, "FactEvents", _now(), F.lit("events.json"))


_QUARANTINE_SQL = """WITH q AS (
  SELECT event_id, 'CustomersDim' AS source_table, 'customer_id' AS orphaned_fk_column, CAST(user_id AS VARCHAR) AS orphaned_fk_value
  FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 3000)
  UNION ALL SELECT event_id, 'TypesDim', 'event_type', event_type FROM events WHERE event_type NOT IN ('click', 'view', 'purchase'))
"""


@query(
    "orphan_quarantine",
    _QUARANTINE_SQL
    + """SELECT event_id, source_table, orphaned_fk_column, orphaned_fk_value, 'FactEvents' AS fact_table, 'events.json' AS source_file,
                timestamp '2024-01-31 00:00:00' AS quarantined_at, FALSE AS resolved FROM q""",
)
def orphan_quarantine(spark, sf):
    return _quarantine(spark, sf).select(
        F.get_json_object("record_payload", "$.event_id").cast("long").alias("event_id"),
        "source_table",
        "orphaned_fk_column",
        "orphaned_fk_value",
        "fact_table",
        "source_file",
        "quarantined_at",
        "resolved",
    )


_FACT_COLUMNS = columns("event_id bigint, ts timestamp_ntz, customer_id bigint, event_type string, value double")


def _retry(spark, sf):
    """The customers down to a zero balance and the sign-ups have arrived since."""
    dims = {
        "CustomersDim": (_loaded_customers(spark, sf, 0), "customer_id"),
        "TypesDim": (_types(spark, sf, ["click", "view", "purchase", "signup"]), "event_type"),
    }
    return retry_orphans(stage(_quarantine(spark, sf), "quarantine"), dims, "FactEvents", "event_id")


_RETRY_SQL = (
    _QUARANTINE_SQL
    + """, r AS (SELECT q.*, CASE source_table WHEN 'TypesDim' THEN orphaned_fk_value = 'signup'
       ELSE CAST(orphaned_fk_value AS VARCHAR) IN (SELECT CAST(c_custkey AS VARCHAR) FROM customer WHERE c_acctbal >= 0) END AS found FROM q)
"""
)


@query(
    "orphan_retry_resolved",
    _RETRY_SQL
    + """SELECT event_id, ts, user_id AS customer_id, event_type, value FROM events
         WHERE event_id IN (SELECT event_id FROM r GROUP BY event_id HAVING bool_and(found))""",
)
def orphan_retry_resolved(spark, sf):
    return unpack(_retry(spark, sf).good, "record_payload", _FACT_COLUMNS)


@query("orphan_retry_remaining", _RETRY_SQL + "SELECT event_id, source_table, orphaned_fk_value FROM r WHERE NOT found")
def orphan_retry_remaining(spark, sf):
    return _retry(spark, sf).bad.select(
        F.get_json_object("record_payload", "$.event_id").cast("long").alias("event_id"), "source_table", "orphaned_fk_value"
    )


# lines of one order are payloads of one fact key; half of the parts and of the suppliers arrive late
_LATE_SQL = "l_partkey % 5 = 0 OR l_suppkey % 4 = 0"


def _line_retries(spark, sf):
    """Two retries: the suppliers arrive first, then the parts."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity")
    parts = table(spark, sf, "part").select("p_partkey")
    suppliers = table(spark, sf, "supplier").select("s_suppkey")
    refs = [DimRef("PartsDim", "l_partkey", "p_partkey"), DimRef("SuppliersDim", "l_suppkey", "s_suppkey")]
    early = {"PartsDim": parts.filter("p_partkey % 5 <> 0"), "SuppliersDim": suppliers.filter("s_suppkey % 4 <> 0")}
    held = stage(to_orphans(split_orphans(lines, early, refs).bad, "FactLines", _now()), "lines-held")
    first = retry_orphans(held, {"PartsDim": (early["PartsDim"], "p_partkey"), "SuppliersDim": (suppliers, "s_suppkey")}, "FactLines", "l_orderkey")
    rest = stage(first.bad, "lines-rest")
    second = retry_orphans(rest, {"PartsDim": (parts, "p_partkey"), "SuppliersDim": (suppliers, "s_suppkey")}, "FactLines", "l_orderkey")
    loaded = first.good.withColumn("retry", F.lit(1)).unionByName(second.good.withColumn("retry", F.lit(2)))
    return loaded, second.bad


@query(
    "orphan_retry_by_payload",
    f"""SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, CASE WHEN l_partkey % 5 = 0 THEN 2 ELSE 1 END AS retry
        FROM lineitem WHERE {_LATE_SQL}""",
)
def orphan_retry_by_payload(spark, sf):
    """Fact keys with several payloads: each is loaded when its own references are there, none is lost."""
    loaded, _ = _line_retries(spark, sf)
    schema = columns("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double")
    rows = loaded.select("retry", F.from_json("record_payload", schema).alias("r"))
    return rows.select("r.*", "retry")


# few columns, so that many lines are equal rows
_BAG = columns("l_partkey bigint, l_suppkey bigint, l_returnflag string")


@query("orphan_retry_bag", "SELECT l_suppkey % 20 AS l_partkey, l_suppkey, l_returnflag FROM lineitem")
def orphan_retry_bag(spark, sf):
    """What was clean and what a retry loads are the input again, equal rows as often as they came, also when a batch was sent twice."""
    lines = table(spark, sf, "lineitem").select((F.col("l_suppkey") % 20).alias("l_partkey"), "l_suppkey", "l_returnflag")
    parts = table(spark, sf, "part").select("p_partkey").union(spark.range(1).toDF("p_partkey"))
    suppliers = table(spark, sf, "supplier").select("s_suppkey")
    refs = [DimRef("PartsDim", "l_partkey", "p_partkey"), DimRef("SuppliersDim", "l_suppkey", "s_suppkey")]
    split = split_orphans(lines, {"PartsDim": parts.filter("p_partkey % 5 <> 0"), "SuppliersDim": suppliers.filter("s_suppkey % 4 <> 0")}, refs)
    sent = [stage(to_orphans(split.bad, "FactLines", _now(), F.lit(f)), "bag-held") for f in ("first.csv", "again.csv")]
    found = {"PartsDim": (parts, "p_partkey"), "SuppliersDim": (suppliers, "s_suppkey")}
    late = unpack(retry_orphans(sent[0].unionByName(sent[1]), found, "FactLines", "l_suppkey").good, "record_payload", _BAG)
    return split.good.unionByName(late)


@query(
    "delete_orphaned_fk",
    _QUARANTINE_SQL + "SELECT event_id, source_table, orphaned_fk_value FROM q WHERE NOT (orphaned_fk_column = 'event_type' AND orphaned_fk_value = 'error')",
)
def delete_orphaned_fk_query(spark, sf):
    """The quarantine without one foreign key, written and read back."""
    held = stage(_quarantine(spark, sf), "held")
    store = BatchTable(spark, scratch_path(spark, "orphans"), held.schema, key="quarantine_id")
    store.append(held, "all")
    # the rows that the delete drops are removed by key
    left = delete_orphaned_fk(store.read(), "event_type", "error").select(F.col("quarantine_id").alias("__left"))
    store.remove(store.read(["quarantine_id"]).join(left, F.col("quarantine_id") == F.col("__left"), "left_anti"), "deleted")
    return store.read().select(F.get_json_object("record_payload", "$.event_id").cast("long").alias("event_id"), "source_table", "orphaned_fk_value")


@query(
    "retention_keeps_later_appends",
    """SELECT event_id, ts AS rejected_at, CASE WHEN event_id % 2 = 0 THEN 'first' ELSE 'later' END AS batch_id FROM events
       WHERE NOT (event_id % 2 = 0 AND ts < timestamp '2024-02-05' - INTERVAL 30 DAY)""",
)
def retention_keeps_later_appends(spark, sf):
    """One writer expires what it has read while another appends."""
    rows = table(spark, sf, "events").select("event_id", F.col("ts").alias("rejected_at"))
    path = scratch_path(spark, "rejected")
    one, two = (BatchTable(spark, path, rows.schema, key="event_id") for _ in range(2))
    one.append(rows.filter("event_id % 2 = 0"), "first")
    seen = two.read()
    old = seen.filter(outdated(seen, "rejected_at", 30, F.expr("timestamp_ntz '2024-02-05 00:00:00'"))).select("event_id")
    one.append(rows.filter("event_id % 2 = 1"), "later")
    two.remove(old, "expired")
    return one.read_batches()


@query(
    "table_update_delete",
    """SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS c_acctbal, c_mktsegment
       FROM customer WHERE c_mktsegment <> 'BUILDING'""",
)
def table_update_delete(spark, sf):
    """An update appends the changed rows, a delete their keys; then the batches are put together."""
    customers = table(spark, sf, "customer")
    store = BatchTable(spark, scratch_path(spark, "customers"), customers.schema, key="c_custkey", latest=True)
    store.append(customers, "all")
    in_debt = F.col("c_acctbal") < 0
    store.append(update_where(store.read().filter(in_debt), in_debt, {"c_acctbal": 0.0}), "no-debt")
    left = delete_where(store.read(["c_custkey", "c_mktsegment"]), F.col("c_mktsegment") == "BUILDING")
    store.remove(store.read(["c_custkey"]).exceptAll(left.select("c_custkey")), "no-building")
    store.compact()
    return store.read()


@query(
    "rejected_rows",
    """SELECT event_id, 'Rule ''value'' failed on ''value''' AS rejected_reason, 'events' AS batch_source,
              timestamp '2024-01-31 00:00:00' AS rejected_at FROM events WHERE value > 50""",
)
def rejected_rows(spark, sf):
    bad = _event_fact(spark, sf).filter("value > 50")
    rejected = to_rejected(bad, "events", _now(), F.lit("Rule 'value' failed on 'value'"))
    return rejected.select(
        F.get_json_object("record_payload", "$.event_id").cast("long").alias("event_id"), "rejected_reason", "batch_source", "rejected_at"
    )


@query("payload_json", "SELECT event_id, ts, user_id AS customer_id, event_type, value FROM events")
def payload_json(spark, sf):
    """Packed into the payload and read back, microseconds included."""
    packed = to_rejected(_event_fact(spark, sf), "events", _now(), F.lit("any"))
    return unpack(packed, "record_payload", _FACT_COLUMNS)


@query("payload_field", "SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def payload_field(spark, sf):
    return unpack(table(spark, sf, "events"), "props", columns("k string"), ["event_id"])


@query(
    "retention_orphans",
    """SELECT event_id, ts AS quarantined_at, event_type = 'error' AS resolved FROM events
       WHERE NOT (event_type <> 'error' AND ts < timestamp '2024-01-31' - INTERVAL 2 DAY)""",
)
def retention_orphans(spark, sf):
    held = table(spark, sf, "events").select("event_id", F.col("ts").alias("quarantined_at"), F.expr("event_type = 'error'").alias("resolved"))
    return expire_orphans(held, _now())


@query(
    "retention_rejected",
    "SELECT event_id, ts AS rejected_at FROM events WHERE NOT (ts < timestamp '2024-02-05' - INTERVAL 30 DAY)",
)
def retention_rejected(spark, sf):
    held = table(spark, sf, "events").select("event_id", F.col("ts").alias("rejected_at"))
    return expire_rejected(held, F.expr("timestamp_ntz '2024-02-05 00:00:00'"))


@query(
    "union_bad_rows",
    """SELECT o_orderkey AS id, o_totalprice AS amount, CAST(NULL AS VARCHAR) AS name, 'expensive' AS reason FROM orders WHERE o_totalprice > 400000
       UNION ALL SELECT c_custkey, NULL, c_name, 'in debt' FROM customer WHERE c_acctbal < 0""",
)
def union_bad_rows_query(spark, sf):
    a = table(spark, sf, "orders").filter("o_totalprice > 400000")
    b = table(spark, sf, "customer").filter("c_acctbal < 0")
    return union_bad_rows(
        [
            a.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), F.lit("expensive").alias("reason")),
            b.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lit("in debt").alias("reason")),
        ]
    )


@query(
    "append_idempotent",
    """SELECT o_orderkey, o_orderstatus, 'load-' || lower(o_orderstatus) AS batch_id FROM orders""",
)
def append_idempotent(spark, sf):
    """Three batches appended, one of them twice."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    store = BatchTable(spark, scratch_path(spark, "append"), orders.schema)
    for status in ("F", "O", "P", "O"):
        store.append(orders.filter(F.col("o_orderstatus") == status), f"load-{status.lower()}")
    return store.read_batches()


@query(
    "stored_date_range",
    """SELECT event_id, ts, CAST(strftime(ts, '%Y%m%d') AS INTEGER) AS date_key FROM events
       WHERE CAST(strftime(ts, '%Y%m%d') AS INTEGER) BETWEEN 20240108 AND 20240114""",
)
def stored_date_range(spark, sf):
    """A date range on a table stored by date: only its folders are read."""
    events = table(spark, sf, "events").select("event_id", "ts", date_to_key("ts").alias("date_key"))
    store = BatchTable(spark, scratch_path(spark, "by-date"), events.schema, partition_by=("date_key",))
    store.append(events, "all")
    return in_range(store.read(), "date_key", 20240108, 20240114)


@query(
    "upsert_sink",
    _MERGE_SQL + "SELECT * FROM u UNION ALL SELECT * FROM t WHERE NOT EXISTS (SELECT 1 FROM u WHERE u.c_custkey = t.c_custkey)",
)
def upsert_sink(spark, sf):
    """The merge through a written table: changed rows are appended, the last row of each key is read back."""
    store = BatchTable(spark, scratch_path(spark, "upsert"), table(spark, sf, "customer").schema, key="c_custkey", latest=True)
    store.append(_stored(spark, sf), "first")
    store.append(changed_rows(store.read(), _snapshot(spark, sf), "c_custkey"), "second")
    return store.read()


@query("upsert_sink_partial", _PARTIAL_SQL)
def upsert_sink_partial(spark, sf):
    """The same with two columns supplied: the others are taken from the stored row."""
    store = BatchTable(spark, scratch_path(spark, "upsert"), table(spark, sf, "customer").schema, key="c_custkey", latest=True)
    store.append(_stored(spark, sf), "first")
    store.append(changed_rows(store.read(), _snapshot(spark, sf), "c_custkey", ["c_name", "c_acctbal"]), "second")
    return store.read()


@query(
    "retention_by_day",
    """SELECT event_id, ts AS rejected_at, event_id % 3 = 0 AS resolved FROM events
       WHERE NOT (ts < timestamp '2024-02-10 12:00:00' - INTERVAL 30 DAY AND event_id % 3 <> 0)""",
)
def retention_by_day(spark, sf):
    """Outdated rows of a table stored by day: whole days go as folders, the day at the border by key; what is left is read back."""
    rows = table(spark, sf, "events").select("event_id", F.col("ts").alias("rejected_at"), (F.col("event_id") % 3 == 0).alias("resolved"))
    store = BatchTable(spark, scratch_path(spark, "by-day"), rows.schema, key="event_id", day_of="rejected_at")
    for kept in (True, False):
        store.append(rows.filter(F.col("resolved") == kept), f"resolved-{kept}")
    now = F.expr("timestamp_ntz '2024-02-10 12:00:00'")
    store.expire(outdated(store.read(), "rejected_at", 30, now, unresolved_only=True), "expired")
    return store.read()


@query(
    "replay_adds_nothing",
    "SELECT *, o_totalprice > 400000 AS is_new FROM orders",
)
def replay_adds_nothing(spark, sf):
    """A batch sent again, with some prices changed: its own stored rows are known, the changed ones are new."""
    orders = table(spark, sf, "orders")
    again = orders.withColumn("o_totalprice", F.expr("if(o_totalprice > 400000, o_totalprice + 1, o_totalprice)"))
    new, known = split_duplicates(again, orders, "o_orderkey", ["o_orderdate"])[:2]
    back = new.withColumn("o_totalprice", F.expr("o_totalprice - 1"))
    return back.withColumn("is_new", F.lit(True)).unionByName(known.withColumn("is_new", F.lit(False)))


# ---- reads


@query("point_lookup", "SELECT * FROM orders WHERE o_orderkey = 1234")
def point_lookup_query(spark, sf):
    return point_lookup(table(spark, sf, "orders"), "o_orderkey", 1234)


@query("attr_lookup", "SELECT * FROM customer WHERE c_mktsegment = 'BUILDING'")
def attr_lookup(spark, sf):
    return attribute_lookup(table(spark, sf, "customer"), "c_mktsegment", "BUILDING")


@query(
    "columns_by_ids",
    "SELECT p_partkey, p_name, p_brand FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 49)",
)
def columns_by_ids(spark, sf):
    keys = table(spark, sf, "lineitem").filter("l_quantity >= 49").select(F.col("l_partkey").alias("p_partkey"))
    return columns_by_keys(table(spark, sf, "part"), ["p_partkey", "p_name", "p_brand"], keys, "p_partkey")


@query("column_scan", "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders")
def column_scan(spark, sf):
    return columns_of(table(spark, sf, "orders"), ["o_orderkey", "o_orderpriority", "o_totalprice"])


@query("all_ids", "SELECT DISTINCT l_orderkey FROM lineitem")
def all_ids(spark, sf):
    return all_keys(table(spark, sf, "lineitem"), "l_orderkey")


@query("distinct_values", "SELECT DISTINCT l_shipdate FROM lineitem WHERE l_shipdate IS NOT NULL")
def distinct_values_query(spark, sf):
    return distinct_values(table(spark, sf, "lineitem"), "l_shipdate")


@query(
    "date_key_range",
    f"WITH {FACT_SQL} SELECT ticket_id, line_no, date_key_created FROM fact WHERE date_key_created BETWEEN 19970101 AND 19971231",
)
def date_key_range(spark, sf):
    return in_range(fact(spark, sf), "date_key_created", 19970101, 19971231).select("ticket_id", "line_no", "date_key_created")


@query(
    "ts_range",
    "SELECT event_id, ts FROM events WHERE ts BETWEEN timestamp '2024-01-10 06:00:00' AND timestamp '2024-01-20 18:00:00'",
)
def ts_range(spark, sf):
    low, high = F.expr("timestamp_ntz '2024-01-10 06:00:00'"), F.expr("timestamp_ntz '2024-01-20 18:00:00'")
    return columns_of(in_range(table(spark, sf, "events"), "ts", low, high), ["event_id", "ts"])


@query(
    "sla_breached",
    f"""WITH {FACT_SQL} SELECT ticket_id, line_no, sla_first_response_breached, sla_resolution_breached FROM fact
        WHERE sla_first_response_breached OR sla_resolution_breached""",
)
def sla_breached_query(spark, sf):
    flags = ["sla_first_response_breached", "sla_resolution_breached"]
    return any_true(fact(spark, sf), flags).select("ticket_id", "line_no", *flags)


@query("equality_filter", "SELECT * FROM orders WHERE o_orderstatus = 'O'")
def equality_filter(spark, sf):
    return filter_equal(table(spark, sf, "orders"), "o_orderstatus", "O")


@query(
    "not_equal_filter",
    f"""WITH {TICKETS_SQL} SELECT ticket_id, line_no, refund_amount FROM tickets
        WHERE refund_amount IS DISTINCT FROM 25""",
)
def not_equal_filter(spark, sf):
    rows = filter_not_equal(tickets(spark, sf), "refund_amount", 25)
    return rows.select("ticket_id", "line_no", "refund_amount")


@query(
    "exclude_null",
    f"WITH {TICKETS_SQL} SELECT ticket_id, line_no, refund_amount FROM tickets WHERE refund_amount IS NOT NULL",
)
def exclude_null(spark, sf):
    return filter_not_null(tickets(spark, sf), "refund_amount").select("ticket_id", "line_no", "refund_amount")


@query("slicer", "SELECT p_partkey, p_brand FROM part WHERE p_brand IN ('Brand#2', 'Brand#17', 'Brand#4')")
def slicer_query(spark, sf):
    return slicer(table(spark, sf, "part"), "p_brand", ["Brand#2", "Brand#17", "Brand#4"]).select("p_partkey", "p_brand")


@query(
    "slicer_hierarchy",
    """SELECT p_partkey, p_type, p_brand FROM part
       WHERE (p_type = 'ECONOMY') OR (p_type = 'SMALL' AND p_brand = 'Brand#4')""",
)
def slicer_hierarchy(spark, sf):
    picked = [("ECONOMY",), ("SMALL", "Brand#4")]
    return hierarchy_slicer(table(spark, sf, "part"), ("p_type", "p_brand"), picked).select("p_partkey", "p_type", "p_brand")


@query("distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows_query(spark, sf):
    return distinct_rows(table(spark, sf, "lineitem"), ["l_suppkey", "l_returnflag", "l_linestatus"])
