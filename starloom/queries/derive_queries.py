"""Derived columns, validation, masking and text on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from starloom.functions.derive import apply_derived, compare, date_diff
from starloom.functions.masking import hash_pii, redact
from starloom.functions.rules import EMAIL_TEXT, FLOAT_TEXT, INT_TEXT, PHONE_TEXT, date_ok, email_ok, in_range, one_of, phone_ok
from starloom.functions.text import canonical_text, nan_to_null
from starloom.operators.shape import (
    align_to,
    as_text,
    cast_column,
    drop_present,
    drop_repeated_names,
    keep_columns,
    normalize_text,
    rename_present,
)
from starloom.operators.validation import schema_gate, split_rows, tag_rows, validation_stats
from starloom.queries.registry import query
from starloom.queries.roles import TICKETS_SQL, table, tickets
from starloom.specs import Arithmetic, Compare, DateDiff, DateKey, Expr, Rule, SourceSpec, Term, columns

_UNIT_SQL = {
    "s": "CAST(round_even({d} / 1000000.0, 0) AS BIGINT)",
    "m": "CAST(round_even({d} / 60000000.0, 0) AS BIGINT)",
    "h": "CAST(round_even({d} / 3600000000.0, 0) AS BIGINT)",
    "d": "CAST(floor({d} / 86400000000.0) AS BIGINT)",
}

# Time to the next purchase-like moment: events have microseconds, so halves
# and negative spans occur; errors have no end.
_END = "CASE WHEN event_type <> 'error' THEN timestamp '2024-01-15 12:00:30' END"


def _diff(unit):
    def run(spark, sf):
        events = table(spark, sf, "events").withColumn(
            "end_ts", F.expr("CASE WHEN event_type <> 'error' THEN timestamp_ntz '2024-01-15 12:00:30' END")
        )
        return events.select("event_id", date_diff("ts", "end_ts", unit).alias("span"))

    return run


for _u, _sql in _UNIT_SQL.items():
    _d = f"date_diff('microsecond', ts, {_END})"
    query(f"derive_date_diff_{_u}", f"SELECT event_id, coalesce({_sql.format(d=_d)}, 0) AS span FROM events")(_diff(_u))


@query(
    "derive_date_diff_halves",
    """WITH h AS (SELECT l_orderkey, l_linenumber, l_quantity,
                to_microseconds(CAST(l_quantity AS BIGINT) * 30000000) AS gap FROM lineitem)
       SELECT l_orderkey, l_linenumber, l_quantity,
              CAST(round_even(date_diff('microsecond', timestamp '2024-01-01', timestamp '2024-01-01' + gap) / 60000000.0, 0)
                   AS BIGINT) AS up,
              CAST(round_even(date_diff('microsecond', timestamp '2024-01-01', timestamp '2024-01-01' - gap) / 60000000.0, 0)
                   AS BIGINT) AS down
       FROM h""",
)
def derive_date_diff_halves(spark, sf):
    """Multiples of 30 seconds: every odd quantity is a half minute."""
    start = F.expr("timestamp_ntz '2024-01-01 00:00:00'")
    gap = F.expr("make_dt_interval(0, 0, 0, l_quantity * 30)")
    lines = table(spark, sf, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", "l_quantity", date_diff(start, start + gap).alias("up"), date_diff(start, start - gap).alias("down")
    )


_OPS = {"lt": "<", "le": "<=", "gt": ">", "ge": ">=", "eq": "==", "ne": "!="}


def _comparison(op):
    def run(spark, sf):
        return tickets(spark, sf).select(
            "ticket_id",
            "line_no",
            compare("refund_amount", op, "order_amount").alias("on_numbers"),
            compare("resolved_at", op, "sla_resolve_due_at").alias("on_times"),
            compare("reason_code", op, "status").alias("on_text"),
        )

    return run


for _n, _op in _OPS.items():
    _sql_op = {"==": "=", "!=": "<>"}.get(_op, _op)
    _null = "TRUE" if _op == "!=" else "FALSE"
    query(
        f"derive_compare_{_n}",
        f"""WITH {TICKETS_SQL}
        SELECT ticket_id, line_no, coalesce(refund_amount {_sql_op} order_amount, {_null}) AS on_numbers,
               coalesce(resolved_at {_sql_op} sla_resolve_due_at, {_null}) AS on_times,
               coalesce(reason_code {_sql_op} status, {_null}) AS on_text FROM tickets""",
    )(_comparison(_op))


# customers' balances as text with some that are no numbers
_BALANCE = "CASE WHEN c_acctbal < 0 THEN 'in debt' ELSE CAST(c_acctbal AS {text}) END"


@query(
    "derive_arithmetic",
    """SELECT c_custkey,
         CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END * 2.0 + c_nationkey * 1.0 - c_custkey * 0.5 AS total,
         (CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END * 1.0) * (c_nationkey * 3.0) AS product,
         (c_custkey * 1.0) / nullif(c_nationkey * 1.0, 0) AS ratio,
         CAST(c_nationkey * c_nationkey AS DOUBLE) AS own_square
       FROM customer""",
)
def derive_arithmetic(spark, sf):
    customers = table(spark, sf, "customer").withColumn("balance", F.expr(_BALANCE.format(text="STRING")))
    steps = [
        Arithmetic("total", (Term("balance", "-", 2), Term("c_nationkey", "+"), Term("c_custkey", "-", 0.5))),
        Arithmetic("product", (Term("balance"), Term("c_custkey", "*", 3, right_column="c_nationkey"))),
        Arithmetic("ratio", (Term("c_custkey"), Term("c_acctbal", "/", 1, right_column="c_nationkey"))),
        Arithmetic("own_square", (Term("c_nationkey"), Term("c_nationkey", "*"))),
    ]
    return apply_derived(customers, steps).select("c_custkey", "total", "product", "ratio", "own_square")


@query(
    "derive_date_key",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) END
              AS date_key FROM orders""",
)
def derive_date_key(spark, sf):
    """Open orders have a text that is no date."""
    orders = table(spark, sf, "orders").withColumn(
        "finished", F.expr("CASE WHEN o_orderstatus = 'O' THEN 'not yet' ELSE CAST(o_orderdate AS STRING) END")
    )
    return apply_derived(orders, [DateKey("date_key", "finished")]).select("o_orderkey", "date_key")


@query(
    "derive_expr",
    f"""WITH {TICKETS_SQL}
        SELECT ticket_id, line_no, first_response_at > sla_first_due_at AS late_first,
               NOT (first_response_at > sla_first_due_at) AS on_time FROM tickets""",
)
def derive_expr(spark, sf):
    steps = [Expr("late_first", "first_response_at > sla_first_due_at"), Expr("on_time", "not late_first")]
    return apply_derived(tickets(spark, sf), steps).select("ticket_id", "line_no", "late_first", "on_time")


@query(
    "derive_chain",
    f"""WITH {TICKETS_SQL}
        SELECT ticket_id, line_no,
          CAST(round_even(date_diff('microsecond', created_at, resolved_at) / 3600000000.0, 0) AS BIGINT) AS hours,
          CAST(round_even(date_diff('microsecond', created_at, resolved_at) / 3600000000.0, 0) AS BIGINT)::DOUBLE
            - line_no AS hours_left,
          coalesce(CAST(round_even(date_diff('microsecond', created_at, resolved_at) / 3600000000.0, 0) AS BIGINT) > line_no,
                   FALSE) AS slow
        FROM tickets""",
)
def derive_chain(spark, sf):
    steps = [
        DateDiff("hours", end="resolved_at", start="created_at", unit="h"),
        Arithmetic("hours_left", (Term("hours"), Term("line_no", "-"))),
        Compare("slow", "hours", ">", "line_no"),
    ]
    return apply_derived(tickets(spark, sf), steps).select("ticket_id", "line_no", "hours", "hours_left", "slow")


# ---- validation: orders as a raw text file with dirt in every checked column

_MODEL = columns("order_id int, customer_id int, price double, ordered_at timestamp_ntz, urgent boolean, note string")
_SPEC = SourceSpec("orders", "orders.csv", _MODEL, required=("order_id", "customer_id", "price"))

_RAW = """
  CAST(o_orderkey AS {text}) AS order_id,
  CASE WHEN o_totalprice > 480000 THEN NULL WHEN o_totalprice > 470000 THEN CAST(o_custkey AS {text}) || '.5'
       ELSE CAST(o_custkey AS {text}) END AS customer_id,
  CASE WHEN o_totalprice < 5000 THEN NULL WHEN o_totalprice < 15000 THEN 'cheap' ELSE CAST(o_totalprice AS {text}) END AS price,
  CASE WHEN o_orderpriority = '5-LOW' AND o_totalprice > 400000 THEN 'invalid-date'
       ELSE {ts} END AS ordered_at,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'True' WHEN '2-HIGH' THEN 'true' WHEN '3-MEDIUM' THEN 'yes' ELSE 'false' END AS urgent,
  o_orderstatus AS note"""


def _raw_orders(spark, sf):
    ts = "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss')"
    return table(spark, sf, "orders").selectExpr(*_columns(_RAW.format(text="STRING", ts=ts)))


def _columns(text):
    """Split a select list at the commas outside of brackets."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(text):
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(text[start:i])
            start = i + 1
    return [*out, text[start:]]


_RAW_SQL = (
    "raw AS (SELECT "
    + _RAW.format(text="VARCHAR", ts="strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')")
    + " FROM orders)"
)
_TAGGED_SQL = f"""WITH {_RAW_SQL}, tagged AS (SELECT *, CASE
    WHEN customer_id IS NULL OR price IS NULL THEN 'no value in ' || concat_ws(', ',
         CASE WHEN customer_id IS NULL THEN 'customer_id' END, CASE WHEN price IS NULL THEN 'price' END)
    WHEN NOT regexp_matches(order_id, '{INT_TEXT}') THEN 'order_id is not of type int'
    WHEN NOT regexp_matches(customer_id, '{INT_TEXT}') THEN 'customer_id is not of type int'
    WHEN NOT regexp_matches(price, '{FLOAT_TEXT}') THEN 'price is not of type float'
    WHEN try_strptime(ordered_at, '%Y-%m-%d %H:%M:%S') IS NULL THEN 'ordered_at is not of type datetime'
    WHEN lower(urgent) NOT IN ('true', 'false') THEN 'urgent is not of type bool'
    END AS rejected_reason FROM raw)
"""


@query(
    "type_split_good",
    _TAGGED_SQL
    + """SELECT CAST(order_id AS INTEGER) AS order_id, CAST(customer_id AS INTEGER) AS customer_id, CAST(price AS DOUBLE) AS price,
                CAST(ordered_at AS TIMESTAMP) AS ordered_at, lower(urgent) = 'true' AS urgent, note
         FROM tagged WHERE rejected_reason IS NULL""",
)
def type_split_good(spark, sf):
    return split_rows(_raw_orders(spark, sf), _SPEC).good


@query("type_split_bad", _TAGGED_SQL + "SELECT * FROM tagged WHERE rejected_reason IS NOT NULL")
def type_split_bad(spark, sf):
    return split_rows(_raw_orders(spark, sf), _SPEC).bad


@query(
    "required_null_split",
    _TAGGED_SQL + "SELECT order_id, rejected_reason FROM tagged WHERE rejected_reason LIKE 'no value in %'",
)
def required_null_split(spark, sf):
    tagged = tag_rows(_raw_orders(spark, sf), _SPEC)
    return tagged.filter("outcome = 'null'").select("order_id", "rejected_reason")


@query(
    "validation_stats",
    _TAGGED_SQL
    + """SELECT count(*) AS total_rows, count(*) FILTER (rejected_reason IS NULL) AS passed_count,
                count(*) FILTER (customer_id IS NULL OR price IS NULL) AS null_count,
                count(*) FILTER (rejected_reason IS NOT NULL AND customer_id IS NOT NULL AND price IS NOT NULL) AS quarantined_count
         FROM tagged""",
)
def validation_stats_query(spark, sf):
    return validation_stats(tag_rows(_raw_orders(spark, sf), _SPEC))


_GATE_MODEL = columns("order_id int, customer_id int, price double, ordered_at timestamp_ntz, urgent boolean, note int")


@query(
    "schema_type_gate",
    f"""WITH {_RAW_SQL}, counts AS (
      SELECT 'order_id' AS column_name, 'int' AS expected_type, count(order_id) AS value_count,
             count(*) FILTER (regexp_matches(order_id, '{INT_TEXT}')) AS castable_count FROM raw
      UNION ALL SELECT 'customer_id', 'int', count(customer_id), count(*) FILTER (regexp_matches(customer_id, '{INT_TEXT}')) FROM raw
      UNION ALL SELECT 'price', 'float', count(price), count(*) FILTER (regexp_matches(price, '{FLOAT_TEXT}')) FROM raw
      UNION ALL SELECT 'ordered_at', 'datetime', count(ordered_at),
                       count(*) FILTER (try_strptime(ordered_at, '%Y-%m-%d %H:%M:%S') IS NOT NULL) FROM raw
      UNION ALL SELECT 'urgent', 'bool', count(urgent), count(*) FILTER (lower(urgent) IN ('true', 'false')) FROM raw
      UNION ALL SELECT 'note', 'int', count(note), count(*) FILTER (regexp_matches(note, '{INT_TEXT}')) FROM raw)
      SELECT *, value_count = 0 OR castable_count > 0 AS passes FROM counts""",
)
def schema_type_gate(spark, sf):
    return schema_gate(_raw_orders(spark, sf), _GATE_MODEL)


# ---- single rules; contact data is made from the customers

_CONTACT = """c_custkey,
  CASE WHEN c_acctbal < 0 THEN c_name WHEN c_acctbal > 9500 THEN '@' || lower(c_mktsegment)
       WHEN c_nationkey = 24 THEN NULL ELSE c_name || '@' || lower(c_mktsegment) || '.example.org' END AS email,
  CASE WHEN c_acctbal < 0 THEN '' WHEN c_mktsegment = 'MACHINERY' THEN 'abc1234'
       ELSE '+20' || CAST(100000 + c_custkey AS {text}) END AS phone"""


def _contacts(spark, sf):
    return table(spark, sf, "customer").selectExpr(*_columns(_CONTACT.format(text="STRING")))


_CONTACT_SQL = "WITH contacts AS (SELECT " + _CONTACT.format(text="VARCHAR") + " FROM customer) "


@query("rule_email", _CONTACT_SQL + f"SELECT c_custkey, email, regexp_matches(email, '{EMAIL_TEXT}') AS ok FROM contacts")
def rule_email(spark, sf):
    return _contacts(spark, sf).select("c_custkey", "email", email_ok(F.col("email")).alias("ok"))


@query("rule_phone", _CONTACT_SQL + f"SELECT c_custkey, phone, regexp_matches(phone, '{PHONE_TEXT}') AS ok FROM contacts")
def rule_phone(spark, sf):
    return _contacts(spark, sf).select("c_custkey", "phone", phone_ok(F.col("phone")).alias("ok"))


@query("rule_range", "SELECT c_custkey, c_acctbal, c_acctbal BETWEEN 0 AND 5000 AS ok, c_acctbal >= 0 AS not_negative FROM customer")
def rule_range(spark, sf):
    c = F.col("c_acctbal")
    return table(spark, sf, "customer").select("c_custkey", c, in_range(c, 0, 5000).alias("ok"), in_range(c, 0).alias("not_negative"))


@query("rule_category", "SELECT event_id, event_type, event_type IN ('click', 'view', 'purchase') AS ok FROM events")
def rule_category(spark, sf):
    c = F.col("event_type")
    return table(spark, sf, "events").select("event_id", c, one_of(c, ("click", "view", "purchase")).alias("ok"))


@query(
    "rule_date",
    f"WITH {_RAW_SQL} SELECT order_id, ordered_at, try_strptime(ordered_at, '%Y-%m-%d %H:%M:%S') IS NOT NULL AS ok FROM raw",
)
def rule_date(spark, sf):
    return _raw_orders(spark, sf).select("order_id", "ordered_at", date_ok(F.col("ordered_at")).alias("ok"))


@query(
    "rule_split",
    _CONTACT_SQL
    + f"""SELECT c_custkey, email, phone, CASE
            WHEN NOT regexp_matches(email, '{EMAIL_TEXT}') THEN 'Rule ''email'' failed on ''email'''
            WHEN NOT regexp_matches(phone, '{PHONE_TEXT}') THEN 'Rule ''phone'' failed on ''phone''' END AS rejected_reason
          FROM contacts WHERE NOT regexp_matches(email, '{EMAIL_TEXT}') OR NOT regexp_matches(phone, '{PHONE_TEXT}')""",
)
def rule_split(spark, sf):
    spec = SourceSpec(
        "contacts",
        "contacts.csv",
        columns("email string, phone string"),
        rules=(Rule("email", "email", email_ok), Rule("phone", "phone", phone_ok)),
    )
    return split_rows(_contacts(spark, sf), spec).bad


# ---- masking


@query("pii_hash", _CONTACT_SQL + "SELECT c_custkey, sha256(email) AS email, sha256(phone) AS phone FROM contacts")
def pii_hash(spark, sf):
    return hash_pii(_contacts(spark, sf), ["email", "phone", "national_id"])


@query("pii_hash_numbers", "SELECT sha256(CAST(s_suppkey AS VARCHAR)) AS s_suppkey, sha256(s_name) AS s_name FROM supplier")
def pii_hash_numbers(spark, sf):
    return hash_pii(table(spark, sf, "supplier").select("s_suppkey", "s_name"), ["s_suppkey", "s_name"])


@query("pii_redact", _CONTACT_SQL + "SELECT c_custkey, '***' AS email, phone FROM contacts")
def pii_redact(spark, sf):
    return redact(_contacts(spark, sf), ["email", "national_id"])


# ---- shape and text


@query(
    "keep_rename_drop",
    "SELECT o_orderkey AS order_id, o_totalprice AS total, o_orderstatus AS status FROM orders",
)
def keep_rename_drop(spark, sf):
    renamed = rename_present(
        table(spark, sf, "orders"), {"o_orderkey": "order_id", "o_totalprice": "total", "o_orderstatus": "status", "absent": "x"}
    )
    return keep_columns(drop_present(renamed, ["o_custkey", "absent"]), ["order_id", "total", "status"])


@query(
    "drop_repeated_names",
    "SELECT o_orderkey AS id, o_totalprice AS amount FROM orders LEFT JOIN customer ON o_custkey = c_custkey",
)
def drop_repeated_names_query(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"), "o_custkey")
    customers = table(spark, sf, "customer").select("c_custkey", F.col("c_acctbal").alias("amount"))
    joined = orders.join(customers, F.col("o_custkey") == F.col("c_custkey"), "left").drop("o_custkey", "c_custkey")
    return drop_repeated_names(joined)


_DIRTY = """o_orderkey, CASE WHEN o_orderstatus = 'P' THEN ' NaN ' ELSE '  ' || o_orderpriority || ' ' END AS priority,
  CASE WHEN o_totalprice > 400000 THEN 'soon' ELSE {ts} END AS ordered"""


@query(
    "normalize_text",
    """SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderpriority END AS priority,
              CASE WHEN o_totalprice > 400000 THEN 'soon' ELSE strftime(o_orderdate, '%Y-%m-%d') || ' 00:00:00' END AS ordered
       FROM orders""",
)
def normalize_text_query(spark, sf):
    dirty = table(spark, sf, "orders").selectExpr(*_columns(_DIRTY.format(ts="date_format(o_orderdate, 'yyyy-MM-dd')")))
    return normalize_text(dirty, ["ordered"])


@query(
    "canonical_text",
    """SELECT l_orderkey, l_linenumber,
         CASE WHEN l_quantity = floor(l_quantity) THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) END AS quantity,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped,
         CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped_text,
         CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS quantity_text, l_returnflag AS flag
       FROM lineitem""",
)
def canonical_text_query(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_quantity").alias("quantity"),
        F.col("l_shipdate").alias("shipped"),
        F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss").alias("shipped_text"),
        F.concat(F.col("l_quantity").cast("long").cast("string"), F.lit(".0 ")).alias("quantity_text"),
        F.concat(F.lit(" "), "l_returnflag", F.lit("  ")).alias("flag"),
    )
    types = {f.name: f.dataType for f in lines.schema.fields}
    out = ["quantity", "shipped", "shipped_text", "quantity_text", "flag"]
    return lines.select("l_orderkey", "l_linenumber", *[canonical_text(F.col(c), types[c]).alias(c) for c in out])


@query(
    "nan_to_null",
    "SELECT c_custkey, CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance FROM customer",
)
def nan_to_null_query(spark, sf):
    balance = F.expr("CASE WHEN c_acctbal < 0 THEN double('NaN') ELSE c_acctbal END")
    return table(spark, sf, "customer").select("c_custkey", nan_to_null(balance).alias("balance"))


@query(
    "cast_column",
    f"WITH {_RAW_SQL} SELECT order_id, CASE WHEN regexp_matches(price, '{FLOAT_TEXT}') THEN CAST(price AS DOUBLE) END AS price FROM raw",
)
def cast_column_query(spark, sf):
    return cast_column(_raw_orders(spark, sf).select("order_id", "price"), "price", "double")


@query(
    "align_types",
    """SELECT CAST(c_custkey AS INTEGER) AS id, CAST(c_acctbal AS DOUBLE) AS amount, c_name AS name FROM customer
       UNION ALL SELECT CAST(s_suppkey AS INTEGER), s_acctbal, s_name FROM supplier""",
)
def align_types(spark, sf):
    """Customers read as text, given the suppliers' types, in one frame with them."""
    suppliers = table(spark, sf, "supplier").select(
        F.col("s_suppkey").cast("int").alias("id"), F.col("s_acctbal").alias("amount"), F.col("s_name").alias("name")
    )
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").cast("string").alias("id"), F.col("c_acctbal").cast("string").alias("amount"), F.col("c_name").alias("name")
    )
    return align_to(customers, suppliers).unionByName(suppliers)


@query(
    "text_keys",
    "SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_totalprice FROM orders",
)
def text_keys(spark, sf):
    return as_text(table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), ["o_orderkey", "o_custkey"])


@query(
    "fact_money",
    f"""WITH {TICKETS_SQL} SELECT ticket_id, line_no, order_amount,
        refund_amount, coalesce(refund_amount, 0) + discount_amount
        AS revenue_impact FROM tickets""",
)
def fact_money(spark, sf):
    step = Arithmetic("revenue_impact", (Term("refund_amount"), Term("discount_amount")))
    return apply_derived(tickets(spark, sf), [step]).select("ticket_id", "line_no", "order_amount", "refund_amount", "revenue_impact")
