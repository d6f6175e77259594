"""Joins and lookups on the driver tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.functions.calendar import calendar_for, date_dimension, with_hierarchy
from starloom.operators.joins import (
    Edge,
    cross_filter,
    cross_filter_all,
    date_part_join,
    existing_keys,
    join_chain,
    missing_keys,
    role_date_join,
    snowflake_join,
    star_join,
)
from starloom.operators.lookups import (
    MISSING_REFS,
    ORPHAN_REASON,
    split_duplicates,
    split_orphans,
    split_tagged_orphans,
    stored_candidates,
    tag_orphans_by_missing_keys,
)
from starloom.operators.quarantine import pack_list
from starloom.queries.registry import query
from starloom.queries.roles import table
from starloom.specs import DimRef, JoinStep


def _customers(spark, sf):
    """Customers named like orders' columns where they overlap, to show the suffix."""
    return table(spark, sf, "customer").select(
        F.col("c_custkey").alias("custkey"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount")
    )


def _named_orders(orders):
    return orders.select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"), F.col("o_totalprice").alias("amount")
    )


def _orders(spark, sf):
    return _named_orders(table(spark, sf, "orders"))


# a customer dimension that has not loaded the customers in debt yet
def _known_customers(spark, sf):
    return _customers(spark, sf).filter(F.col("amount") >= 0)


# whole tables, with keys that make rows without partner on both sides
_ORDER_KEY = "CASE WHEN o_custkey % 10 = 3 THEN -o_custkey ELSE o_custkey END"
_CUSTOMER_KEY = "CASE WHEN c_custkey % 10 = 7 THEN 1000000000 + c_custkey ELSE c_custkey END"


def _moved(spark, sf):
    orders = table(spark, sf, "orders").withColumn("o_custkey", F.expr(_ORDER_KEY))
    customers = table(spark, sf, "customer").select(
        F.expr(_CUSTOMER_KEY).alias("custkey"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount")
    )
    return _named_orders(orders), customers


_JOIN_SQL = f"""
WITH o AS (SELECT o_orderkey AS orderkey, {_ORDER_KEY} AS custkey, o_totalprice AS amount FROM orders),
     c AS (SELECT {_CUSTOMER_KEY} AS custkey, c_name AS name, c_acctbal AS amount FROM customer)
"""
_JOIN_SQL += """
SELECT o.orderkey, {key} AS custkey, o.amount, c.name, c.amount AS amount_customers
FROM o {how} JOIN c ON o.custkey = c.custkey"""


def _chain(how, key):
    @query(f"join_chain_{how}", _JOIN_SQL.format(how=how.upper(), key=key))
    def run(spark, sf):
        orders, customers = _moved(spark, sf)
        return join_chain(orders, {"customers": customers}, [JoinStep("customers", "custkey", "custkey", how)])


_chain("left", "o.custkey")
_chain("inner", "o.custkey")
_chain("right", "c.custkey")
_chain("full", "coalesce(o.custkey, c.custkey)")


@query(
    "join_chain_multi",
    """SELECT l_orderkey AS ticket_id, l_linenumber AS line_no, l_orderkey AS order_id, o_custkey AS customer_id,
              c_name AS full_name, n_name AS nation_name
       FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
       LEFT JOIN nation ON c_nationkey = n_nationkey""",
)
def join_chain_multi(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("ticket_id"), F.col("l_linenumber").alias("line_no"), F.col("l_orderkey").alias("order_id")
    )
    rights = {
        "orders": table(spark, sf, "orders").select(
            F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")
        ),
        "customers": table(spark, sf, "customer").select(
            F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("full_name"), "c_nationkey"
        ),
        "nations": table(spark, sf, "nation").select("n_nationkey", F.col("n_name").alias("nation_name")),
    }
    steps = [
        JoinStep("orders", "order_id", "order_id"),
        JoinStep("customers", "customer_id", "customer_id"),
        JoinStep("nations", "c_nationkey", "n_nationkey"),
    ]
    return join_chain(lines, rights, steps).drop("c_nationkey", "n_nationkey")


# account states without a code for the default: null keys on both sides
_STATE = "CASE WHEN {c} < 0 THEN 'debt' WHEN {c} > 9000 THEN 'rich' END"


@query(
    "join_null_safe",
    f"""WITH c AS (SELECT c_custkey AS custkey, {_STATE.format(c='c_acctbal')} AS state FROM customer),
             s AS (SELECT {_STATE.format(c='s_acctbal')} AS state, count(*) AS suppliers FROM supplier GROUP BY 1)
        SELECT c.custkey, c.state, s.suppliers FROM c LEFT JOIN s ON c.state IS NOT DISTINCT FROM s.state""",
)
def join_null_safe(spark, sf):
    customers = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("custkey"), F.expr(_STATE.format(c="c_acctbal")).alias("state")
    )
    suppliers = (
        table(spark, sf, "supplier")
        .groupBy(F.expr(_STATE.format(c="s_acctbal")).alias("state"))
        .agg(F.count("*").alias("suppliers"))
    )
    return join_chain(customers, {"suppliers": suppliers}, [JoinStep("suppliers", "state", "state")], null_safe=True)


@query(
    "star_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, p_name, p_brand, s_name
       FROM lineitem LEFT JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey""",
)
def star_join_query(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    dims = {
        "parts": table(spark, sf, "part").select("p_partkey", "p_name", "p_brand"),
        "suppliers": table(spark, sf, "supplier").select("s_suppkey", "s_name"),
    }
    return star_join(lines, dims, [DimRef("parts", "l_partkey", "p_partkey"), DimRef("suppliers", "l_suppkey", "s_suppkey")])


@query(
    "snowflake_join",
    """SELECT c_custkey, c_nationkey, n_name, n_regionkey, r_name FROM customer
       LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey""",
)
def snowflake_join_query(spark, sf):
    nations = snowflake_join(table(spark, sf, "nation"), table(spark, sf, "region"), "n_regionkey", "r_regionkey", "regions")
    customers = table(spark, sf, "customer").select("c_custkey", "c_nationkey")
    return snowflake_join(customers, nations, "c_nationkey", "n_nationkey", "nations").drop("n_nationkey", "r_regionkey")


_DAYS_SQL = """days AS (SELECT CAST(d AS DATE) AS full_date FROM (SELECT unnest(generate_series(
    date_trunc('year', (SELECT min({c}) FROM {t})), date_trunc('year', (SELECT max({c}) FROM {t})) + INTERVAL 1 YEAR
    - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d))"""


@query(
    "role_date_join",
    "WITH " + _DAYS_SQL.format(c="o_orderdate", t="orders") + """
       SELECT o_orderkey, CAST(strftime(o_orderdate, '%Y%m%d') AS INTEGER) AS date_key_created,
              full_date AS created_full_date, strftime(full_date, '%A') AS created_day,
              CAST(isodow(full_date) - 1 AS INTEGER) AS created_day_of_week, isodow(full_date) >= 6 AS created_is_weekend
       FROM orders LEFT JOIN days ON CAST(o_orderdate AS DATE) = full_date""",
)
def role_date_join_query(spark, sf):
    orders = table(spark, sf, "orders")
    fact = orders.select("o_orderkey", F.date_format("o_orderdate", "yyyyMMdd").cast("int").alias("date_key_created"))
    dim = date_dimension(calendar_for(orders, "o_orderdate")).select(
        "date_id", "full_date", "day", "day_of_week", "is_weekend"
    )
    return role_date_join(fact, dim, "date_key_created", "created").drop("created_date_id")


@query(
    "date_part_join",
    "WITH " + _DAYS_SQL.format(c="ts", t="events") + """
       SELECT event_id, ts, full_date, CAST(year(full_date) AS INTEGER) AS year, strftime(full_date, '%B') AS month,
              'Qtr ' || quarter(full_date) AS quarter
       FROM events LEFT JOIN days ON CAST(ts AS DATE) = full_date""",
)
def date_part_join_query(spark, sf):
    events = table(spark, sf, "events")
    days = with_hierarchy(calendar_for(events, "ts")).select("full_date", "year", "month", "quarter")
    return date_part_join(events.select("event_id", "ts"), "ts", days)


@query(
    "cross_filter_dim",
    """SELECT s_suppkey, s_name FROM supplier
       WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_suppkey = s_suppkey AND l_quantity >= 50 AND l_returnflag = 'R')""",
)
def cross_filter_dim(spark, sf):
    lines = table(spark, sf, "lineitem").filter((F.col("l_quantity") >= 50) & (F.col("l_returnflag") == "R"))
    return cross_filter(table(spark, sf, "supplier").select("s_suppkey", "s_name"), lines, "s_suppkey", "l_suppkey")


_MODEL_SQL = """WITH lines AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  WHERE n_name IN (SELECT n_name FROM nation ORDER BY n_nationkey LIMIT 3) AND p_size < 10)
SELECT 'part' AS dim, CAST(p_partkey AS BIGINT) AS id FROM part WHERE p_size < 10 AND EXISTS (SELECT 1 FROM lines WHERE lines.l_partkey = part.p_partkey)
UNION ALL SELECT 'supplier', s_suppkey FROM supplier WHERE EXISTS (SELECT 1 FROM lines WHERE lines.l_suppkey = supplier.s_suppkey)
UNION ALL SELECT 'orders', o_orderkey FROM orders WHERE EXISTS (SELECT 1 FROM lines WHERE lines.l_orderkey = orders.o_orderkey)
UNION ALL SELECT 'customer', c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM lines WHERE lines.o_custkey = customer.c_custkey)
UNION ALL SELECT 'region', r_regionkey FROM region"""


@query("cross_filter_model", _MODEL_SQL)
def cross_filter_model(spark, sf):
    """Slicers on nations and parts cut all tables that filters reach; regions are filtered by nobody."""
    names = ("region", "nation", "customer", "orders", "lineitem", "part", "supplier")
    tables = {t: table(spark, sf, t) for t in names}
    edges = [
        Edge("nation", "n_regionkey", "region", "r_regionkey"),
        Edge("customer", "c_nationkey", "nation", "n_nationkey", both=True),
        Edge("orders", "o_custkey", "customer", "c_custkey", both=True),
        Edge("lineitem", "l_orderkey", "orders", "o_orderkey", both=True),
        Edge("lineitem", "l_partkey", "part", "p_partkey", both=True),
        Edge("lineitem", "l_suppkey", "supplier", "s_suppkey", both=True),
    ]
    left = cross_filter_all(tables, edges, {"nation": F.col("n_nationkey") < 3, "part": F.col("p_size") < 10})
    keys = {"part": "p_partkey", "supplier": "s_suppkey", "orders": "o_orderkey", "customer": "c_custkey", "region": "r_regionkey"}
    frames = [left[t].select(F.lit(t).alias("dim"), F.col(k).cast("long").alias("id")) for t, k in keys.items()]
    return reduce(DataFrame.unionByName, frames)


@query(
    "existing_keys",
    """SELECT DISTINCT o_custkey AS custkey FROM orders
       WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
)
def existing_keys_query(spark, sf):
    return existing_keys(_orders(spark, sf), "custkey", _known_customers(spark, sf), "custkey")


@query(
    "missing_keys",
    """SELECT DISTINCT o_custkey AS custkey FROM orders
       WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""",
)
def missing_keys_query(spark, sf):
    return missing_keys(_orders(spark, sf), "custkey", _known_customers(spark, sf), "custkey")


# Fact rows with three checked references: two dimensions are not complete yet,
# one reference is null for rows without discount.
def _fact_and_dims(spark, sf):
    orders = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id")
    )
    lines = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("restaurant_id"),
        F.when(F.col("l_discount") > 0, F.col("l_suppkey")).alias("driver_id"),
    )
    fact = join_chain(lines, {"orders": orders}, [JoinStep("orders", "order_id", "order_id")])
    dims = {
        "CustomersDim": _known_customers(spark, sf).select(F.col("custkey").alias("customer_id")),
        "RestaurantsDim": table(spark, sf, "part").filter("p_size > 5").select(F.col("p_partkey").alias("restaurant_id")),
        "DriversDim": table(spark, sf, "supplier").filter("s_acctbal >= 0").select(F.col("s_suppkey").alias("driver_id")),
    }
    refs = [
        DimRef("CustomersDim", "customer_id"),
        DimRef("RestaurantsDim", "restaurant_id"),
        DimRef("DriversDim", "driver_id"),
        DimRef("DateDim", ("date_key_created", "date_key_resolved")),
    ]
    return fact, dims, refs


_ORPHAN_SQL = """WITH f AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, l_partkey AS restaurant_id,
         CASE WHEN l_discount > 0 THEN l_suppkey END AS driver_id, o_custkey AS customer_id
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey),
t AS (SELECT f.*,
        customer_id IS NOT NULL AND customer_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) AS m1,
        restaurant_id IS NOT NULL AND restaurant_id NOT IN (SELECT p_partkey FROM part WHERE p_size > 5) AS m2,
        driver_id IS NOT NULL AND driver_id NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) AS m3
      FROM f)
"""


@query(
    "orphan_clean",
    _ORPHAN_SQL + "SELECT order_id, line_no, restaurant_id, driver_id, customer_id FROM t WHERE NOT (m1 OR m2 OR coalesce(m3, FALSE))",
)
def orphan_clean(spark, sf):
    return split_orphans(*_fact_and_dims(spark, sf)).good


@query(
    "orphan_rows",
    _ORPHAN_SQL
    + """SELECT order_id, line_no, restaurant_id, driver_id, customer_id,
           concat_ws('|', CASE WHEN m1 THEN 'CustomersDim' END, CASE WHEN m2 THEN 'RestaurantsDim' END,
                     CASE WHEN m3 THEN 'DriversDim' END) AS orphan_dim,
           concat_ws('|', CASE WHEN m1 THEN 'customer_id' END, CASE WHEN m2 THEN 'restaurant_id' END,
                     CASE WHEN m3 THEN 'driver_id' END) AS orphan_fk,
           concat_ws('', CASE WHEN m1 THEN 'customer_id is not in CustomersDim; ' END,
                     CASE WHEN m2 THEN 'restaurant_id is not in RestaurantsDim; ' END,
                     CASE WHEN m3 THEN 'driver_id is not in DriversDim; ' END) AS orphan_reason
         FROM t WHERE m1 OR m2 OR coalesce(m3, FALSE)""",
)
def orphan_rows(spark, sf):
    bad = split_orphans(*_fact_and_dims(spark, sf)).bad
    return bad.withColumns({"orphan_dim": pack_list("dim"), "orphan_fk": pack_list("fk_column")}).drop(MISSING_REFS)


@query(
    "orphan_exploded",
    _ORPHAN_SQL
    + """SELECT order_id, line_no, 'CustomersDim' AS source_table, 'customer_id' AS orphaned_fk_column,
                CAST(customer_id AS VARCHAR) AS orphaned_fk_value FROM t WHERE m1
         UNION ALL SELECT order_id, line_no, 'RestaurantsDim', 'restaurant_id', CAST(restaurant_id AS VARCHAR) FROM t WHERE m2
         UNION ALL SELECT order_id, line_no, 'DriversDim', 'driver_id', CAST(driver_id AS VARCHAR) FROM t WHERE m3""",
)
def orphan_exploded(spark, sf):
    bad = split_orphans(*_fact_and_dims(spark, sf)).bad
    return bad.select("order_id", "line_no", F.inline(MISSING_REFS)).select(
        "order_id",
        "line_no",
        F.col("dim").alias("source_table"),
        F.col("fk_column").alias("orphaned_fk_column"),
        F.col("fk_value").alias("orphaned_fk_value"),
    )


@query(
    "orphan_rows_by_missing_keys",
    _ORPHAN_SQL
    + """SELECT order_id, line_no,
           concat_ws('', CASE WHEN m1 THEN 'customer_id is not in CustomersDim; ' END,
                     CASE WHEN m2 THEN 'restaurant_id is not in RestaurantsDim; ' END,
                     CASE WHEN m3 THEN 'driver_id is not in DriversDim; ' END) AS orphan_reason
         FROM t WHERE m1 OR m2 OR coalesce(m3, FALSE)""",
)
def orphan_rows_by_missing_keys(spark, sf):
    bad = split_tagged_orphans(tag_orphans_by_missing_keys(*_fact_and_dims(spark, sf))).bad
    return bad.select("order_id", "line_no", ORPHAN_REASON)


# Stored lines: what was loaded for finished orders, with the flag as it was then
# (open lines have none) and a later ship date; incoming: every line.
def _incoming_lines(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_quantity", F.expr("nullif(l_returnflag, 'N')").alias("flag"), "l_shipdate"
    )


def _stored_lines(spark, sf):
    return (
        table(spark, sf, "lineitem")
        .filter("l_linestatus = 'F'")
        .select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            F.expr("CASE WHEN l_quantity > 40 THEN 40 ELSE l_quantity END").alias("l_quantity"),
            F.expr("nullif(l_returnflag, 'N')").alias("flag"),
            F.expr("l_shipdate + interval '1' day").alias("l_shipdate"),
        )
    )


_DUP_SQL = """WITH i AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, nullif(l_returnflag, 'N') AS flag, l_shipdate
  FROM lineitem),
s AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_quantity > 40 THEN 40 ELSE l_quantity END AS l_quantity,
        nullif(l_returnflag, 'N') AS flag FROM lineitem WHERE l_linestatus = 'F')
SELECT i.* FROM i WHERE {neg} EXISTS (SELECT 1 FROM s WHERE s.l_orderkey = i.l_orderkey
  AND s.l_linenumber IS NOT DISTINCT FROM i.l_linenumber AND s.l_partkey IS NOT DISTINCT FROM i.l_partkey
  AND s.l_quantity IS NOT DISTINCT FROM i.l_quantity AND s.flag IS NOT DISTINCT FROM i.flag)"""


@query("duplicate_rows", _DUP_SQL.format(neg=""))
def duplicate_rows(spark, sf):
    return split_duplicates(_incoming_lines(spark, sf), _stored_lines(spark, sf), "l_orderkey", ["l_shipdate"]).bad


@query("nonduplicate_rows", _DUP_SQL.format(neg="NOT"))
def nonduplicate_rows(spark, sf):
    return split_duplicates(_incoming_lines(spark, sf), _stored_lines(spark, sf), "l_orderkey", ["l_shipdate"]).good


@query("duplicate_rows_of_candidates", _DUP_SQL.format(neg=""))
def duplicate_rows_of_candidates(spark, sf):
    """The stored side narrowed by a scan of its keys first, as for a large stored fact."""
    incoming = _incoming_lines(spark, sf)
    known = stored_candidates(incoming, _stored_lines(spark, sf), "l_orderkey")
    return split_duplicates(incoming, known, "l_orderkey", ["l_shipdate"]).bad
