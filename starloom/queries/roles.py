"""The driver tables in the roles of the ticket warehouse.

A ticket is a line item with its order; region and city are nation and region;
customers, agents (and drivers) and restaurants are customer, supplier and part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.derive import apply_derived
from starloom.operators.joins import join_chain
from starloom.operators.measures import Dim
from starloom.specs import Arithmetic, Compare, DateDiff, DateKey, JoinStep, Term, columns

# The columns of the given tables.  With a declared schema Spark
# opens no file before the query runs.
SCHEMAS = {
    "region": columns("r_regionkey int, r_name string"),
    "nation": columns("n_nationkey int, n_name string, n_regionkey int"),
    "customer": columns("c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    "supplier": columns("s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double"),
    "part": columns("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"),
    "orders": columns(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, o_orderdate timestamp_ntz, "
        "o_orderpriority string"
    ),
    "lineitem": columns(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": columns("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def tickets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with their order and region: tickets before any derivation.

    Orders meet customers before they meet the (four times larger) line items,
    so line items are shuffled once.
    """
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").alias("total_amount"),
        F.col("o_orderdate").alias("created_at"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("sla_days"),
    )
    regions = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_nationkey").alias("region_id")
    )
    orders = join_chain(orders, {"regions": regions}, [JoinStep("regions", "customer_id", "customer_id")])
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("ticket_id"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_suppkey").alias("agent_id"),
        F.col("l_suppkey").alias("driver_id"),
        F.col("l_partkey").alias("restaurant_id"),
        F.col("l_linestatus").alias("status"),
        F.col("l_returnflag").alias("reason_code"),
        F.col("l_extendedprice").alias("order_amount"),
        F.col("l_quantity").alias("discount_amount"),
        F.col("l_tax").alias("delivery_fee"),
        F.when(F.col("l_returnflag") == "R", F.col("l_extendedprice")).alias("refund_amount"),
        F.col("l_shipdate").alias("resolved_at"),
    )
    joined = join_chain(lines, {"orders": orders}, [JoinStep("orders", "order_id", "order_id")])
    created = F.col("created_at")
    return joined.withColumns(
        {
            "first_response_at": created + F.expr("make_dt_interval(0, line_no)"),
            "sla_first_due_at": created + F.expr("interval '4' hour"),
            "sla_resolve_due_at": created + F.expr("make_dt_interval(sla_days)"),
        }
    ).drop("sla_days")


TICKETS_SQL = """tickets AS (
  SELECT l_orderkey AS ticket_id, l_linenumber AS line_no, l_orderkey AS order_id, l_suppkey AS agent_id,
         l_suppkey AS driver_id, l_partkey AS restaurant_id, l_linestatus AS status, l_returnflag AS reason_code,
         l_extendedprice AS order_amount, l_quantity AS discount_amount, l_tax AS delivery_fee,
         CASE WHEN l_returnflag = 'R' THEN l_extendedprice END AS refund_amount,
         l_shipdate AS resolved_at, o_custkey AS customer_id, o_totalprice AS total_amount,
         o_orderdate AS created_at, c_nationkey AS region_id,
         o_orderdate + to_hours(l_linenumber) AS first_response_at,
         o_orderdate + INTERVAL 4 HOUR AS sla_first_due_at,
         o_orderdate + to_days(CAST(substr(o_orderpriority, 1, 1) AS INTEGER)) AS sla_resolve_due_at
  FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey)"""

DERIVED = (
    DateDiff("resolution_time_min", end="resolved_at", start="created_at"),
    DateDiff("first_response_time_min", end="first_response_at", start="created_at"),
    Compare("sla_first_response_breached", "first_response_at", ">", "sla_first_due_at"),
    Compare("sla_resolution_breached", "resolved_at", ">", "sla_resolve_due_at"),
    Arithmetic("revenue_impact", (Term("refund_amount"), Term("discount_amount"))),
    DateKey("date_key_created", "created_at"),
    DateKey("date_key_resolved", "resolved_at"),
)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tickets with the derived fact columns."""
    return apply_derived(tickets(spark, sf_dir), DERIVED)


FACT_SQL = (
    TICKETS_SQL
    + """, fact AS (
  SELECT *,
         CAST(round_even(date_diff('microsecond', created_at, resolved_at) / 60000000.0, 0) AS BIGINT) AS resolution_time_min,
         CAST(round_even(date_diff('microsecond', created_at, first_response_at) / 60000000.0, 0) AS BIGINT)
           AS first_response_time_min,
         coalesce(first_response_at > sla_first_due_at, FALSE) AS sla_first_response_breached,
         coalesce(resolved_at > sla_resolve_due_at, FALSE) AS sla_resolution_breached,
         coalesce(refund_amount, 0) + coalesce(discount_amount, 0) AS revenue_impact,
         CAST(strftime(created_at, '%Y%m%d') AS INTEGER) AS date_key_created,
         CAST(strftime(resolved_at, '%Y%m%d') AS INTEGER) AS date_key_resolved
  FROM tickets)"""
)


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("city_id"), F.col("r_name").alias("city_name")
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("region_id"), F.col("n_name").alias("region_name"), F.col("n_regionkey").alias("city_id")
    )


def region_with_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return join_chain(
        regions(spark, sf_dir), {"cities": cities(spark, sf_dir)}, [JoinStep("cities", "city_id", "city_id")]
    )


def restaurants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("restaurant_id"),
        F.col("p_name").alias("restaurant_name"),
        F.col("p_brand").alias("category_name"),
        F.col("p_type").alias("price_tier"),
        F.col("p_retailprice").alias("rating_avg"),
    )


def agents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("agent_id"), F.col("s_name").alias("agent_name"), F.col("s_nationkey").alias("team_id")
    )


def dims(spark: SparkSession, sf_dir: str, *names: str) -> dict[str, Dim]:
    """The named dimensions as a measure query takes them."""
    build = {
        "regions": lambda: Dim(region_with_city(spark, sf_dir), "region_id", "region_id"),
        "restaurants": lambda: Dim(restaurants(spark, sf_dir).drop("rating_avg"), "restaurant_id", "restaurant_id"),
        "agents": lambda: Dim(agents(spark, sf_dir).select("agent_id", "agent_name"), "agent_id", "agent_id"),
    }
    return {n: build[n]() for n in names}
