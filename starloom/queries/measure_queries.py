"""Measures, quality metrics and calendars on the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.functions.calendar import calendar_for, date_dimension, with_hierarchy
from starloom.operators.lookups import MISSING_REFS, split_orphans, tag_orphans
from starloom.operators.measures import (
    RESPONSE_MEASURES,
    TICKET_MEASURES,
    Dim,
    breach_rate_percent,
    date_rollup,
    measure_query,
    measures_long,
    pick_measures,
    top_groups,
)
from starloom.operators.metrics import batch_rollup, null_counts, quality_metrics, threshold_alerts, with_rates
from starloom.operators.validation import INVALID, NULL_REQUIRED, ORPHAN, OUTCOME, PASSED
from starloom.queries.registry import query
from starloom.queries.roles import FACT_SQL, TICKETS_SQL, agents, dims, fact, region_with_city, table
from starloom.specs import DimRef

def _exact(column):
    return f"CAST(sum(CAST({column} AS DECIMAL(28,6))) AS DOUBLE)"


# one SQL text per measure
_SQL = {
    "total_tickets": "count(ticket_id)",
    "sla_breach_rate": "count(*) FILTER (sla_resolution_breached) / CAST(count(*) AS DOUBLE)",
    "avg_resolution_time": "CAST(sum(resolution_time_min) AS DOUBLE) / count(resolution_time_min)",
    "first_response_time": "CAST(sum(first_response_time_min) AS DOUBLE) / count(first_response_time_min)",
    "total_refund_amount": _exact("refund_amount"),
    "total_sales": _exact("total_amount"),
    "total_revenue_impact": _exact("revenue_impact"),
    "net_profit": "CAST(sum(CAST(total_amount AS DECIMAL(28,6))) - sum(CAST(revenue_impact AS DECIMAL(28,6))) AS DOUBLE)",
}


def _list(names):
    return ", ".join(f"{_SQL[n]} AS {n}" for n in names)


_ALL = tuple(_SQL)

_JOINED_SQL = (
    f"WITH {FACT_SQL}, joined AS (SELECT fact.*, n_name AS region_name, r_name AS city_name, p_name AS restaurant_name, "
    "p_brand AS category_name, p_type AS price_tier, s_name AS agent_name FROM fact LEFT JOIN nation ON region_id = n_nationkey "
    "LEFT JOIN region ON n_regionkey = r_regionkey LEFT JOIN part ON restaurant_id = p_partkey "
    "LEFT JOIN supplier ON agent_id = s_suppkey) "
)


@query("measure_cards", f"WITH {FACT_SQL} SELECT {_list(_ALL)} FROM fact")
def measure_cards(spark, sf):
    return measure_query(fact(spark, sf), measures=_ALL)


@query(
    "measures_below_cents",
    """SELECT l_returnflag, CAST(sum(CAST(l_extendedprice * l_discount * l_tax AS DECIMAL(28,6))) AS DOUBLE) AS total_sales
       FROM lineitem GROUP BY l_returnflag""",
)
def measures_below_cents(spark, sf):
    """Derived money with fractions of a cent: nothing is rounded to cents before it is added."""
    lines = table(spark, sf, "lineitem").select("l_returnflag", F.expr("l_extendedprice * l_discount * l_tax").alias("total_amount"))
    return measure_query(lines, ["l_returnflag"], ["total_sales"])


@query("net_profit", _JOINED_SQL + f"SELECT city_name, {_list(['net_profit'])} FROM joined GROUP BY city_name")
def net_profit(spark, sf):
    return measure_query(fact(spark, sf), ["city_name"], ["net_profit"], dims(spark, sf, "regions"))


def _grouped(name, by, measures, dim):
    keys = ", ".join(by)

    @query(name, _JOINED_SQL + f"SELECT {keys}, {_list(measures)} FROM joined GROUP BY {keys}")
    def run(spark, sf):
        order = [F.col(measures[0]).desc(), *[F.col(c).asc() for c in by]]
        return measure_query(fact(spark, sf), by, measures, dims(spark, sf, dim), order=order)

    return run


_grouped("tickets_by_region", ["region_name"], TICKET_MEASURES, "regions")
_grouped("tickets_by_city", ["city_name"], TICKET_MEASURES, "regions")
_grouped("tickets_by_city_region", ["city_name", "region_name"], ("total_tickets", "sla_breach_rate"), "regions")
_grouped("tickets_by_category", ["category_name"], TICKET_MEASURES, "restaurants")
_grouped("tickets_by_restaurant", ["restaurant_id", "restaurant_name"], ("total_tickets", "total_sales"), "restaurants")
_grouped("tickets_by_agent", ["agent_id", "agent_name"], RESPONSE_MEASURES, "agents")


@query(
    "tickets_by_driver",
    _JOINED_SQL
    + f"""SELECT driver_id, s_name AS driver_name, {_list(["total_tickets", "avg_resolution_time"])}
          FROM joined JOIN supplier ON driver_id = s_suppkey WHERE s_suppkey <> 76 GROUP BY driver_id, s_name""",
)
def tickets_by_driver(spark, sf):
    """Drivers without the one excluded on import, by key descending."""
    drivers = agents(spark, sf).select(F.col("agent_id").alias("driver_id"), F.col("agent_name").alias("driver_name"))
    return measure_query(
        fact(spark, sf),
        ["driver_id", "driver_name"],
        ["total_tickets", "avg_resolution_time"],
        {"drivers": Dim(drivers, "driver_id", "driver_id")},
        dim_filters={"drivers": ~F.col("driver_id").eqNullSafe(F.lit(76))},
        order=[F.col("driver_id").desc()],
    )


@query(
    "measures_with_slicers",
    _JOINED_SQL
    + f"""SELECT region_name, {_list(RESPONSE_MEASURES)} FROM joined
          WHERE city_name IN ('ASIA', 'EUROPE') AND price_tier = 'ECONOMY' AND refund_amount IS NOT NULL GROUP BY region_name""",
)
def measures_with_slicers(spark, sf):
    return measure_query(
            fact(spark, sf),
            ["region_name"],
            RESPONSE_MEASURES,
            dims(spark, sf, "regions", "restaurants"),
            where=F.col("refund_amount").isNotNull(),
            dim_filters={"regions": F.col("city_name").isin("ASIA", "EUROPE"), "restaurants": F.col("price_tier") == "ECONOMY"},
        )


@query(
    "measures_long",
    _JOINED_SQL
    + " UNION ALL ".join(
        f"SELECT region_name, {i} AS measure_order, '{n}' AS measure, CAST({_SQL[n]} AS DOUBLE) AS value FROM joined GROUP BY region_name"
        for i, n in enumerate(TICKET_MEASURES)
    ),
)
def measures_long_query(spark, sf):
    wide = measure_query(fact(spark, sf), ["region_name"], TICKET_MEASURES, dims(spark, sf, "regions"))
    return measures_long(wide, ["region_name"], TICKET_MEASURES)


@query(
    "measures_picked",
    _JOINED_SQL + f"SELECT category_name, {_list(['total_revenue_impact', 'total_sales'])} FROM joined GROUP BY category_name",
)
def measures_picked(spark, sf):
    names = pick_measures(["total_sales", "total_revenue_impact"], TICKET_MEASURES)
    return measure_query(fact(spark, sf), ["category_name"], names, dims(spark, sf, "restaurants"))


@query(
    "breach_rate_by_city",
    _JOINED_SQL
    + """SELECT city_name, round(count(*) FILTER (sla_resolution_breached) * 100.0 / count(*), 2)::DOUBLE AS breach_rate_pct
         FROM joined WHERE city_name IS NOT NULL GROUP BY city_name""",
)
def breach_rate_by_city(spark, sf):
    return breach_rate_percent(fact(spark, sf), ["city_name"], dims(spark, sf, "regions"), "sla_resolution_breached")


_REASONS_SQL = _JOINED_SQL + "SELECT price_tier AS reason_name, category_name, count(*) AS ticket_count FROM joined GROUP BY 1, 2"


def _reasons(spark, sf):
    return {
        "reasons": Dim(
            table(spark, sf, "part").select("p_partkey", F.col("p_type").alias("reason_name"), F.col("p_brand").alias("category_name")),
            "restaurant_id",
            "p_partkey",
        )
    }


@query("top_reasons", _REASONS_SQL)
def top_reasons(spark, sf):
    return top_groups(fact(spark, sf), ["reason_name", "category_name"], _reasons(spark, sf))


@query("top_k_reasons", _REASONS_SQL + " ORDER BY ticket_count DESC, reason_name, category_name LIMIT 10")
def top_k_reasons(spark, sf):
    return top_groups(fact(spark, sf), ["reason_name", "category_name"], _reasons(spark, sf), k=10)


@query(
    "measures_by_month",
    f"""WITH {FACT_SQL} SELECT CAST(year(created_at) AS INTEGER) AS year, CAST(month(created_at) AS INTEGER) AS month_no,
          strftime(created_at, '%B') AS month, {_list(["total_tickets", "sla_breach_rate"])} FROM fact GROUP BY ALL""",
)
def measures_by_month(spark, sf):
    """Month labels in the order of their month numbers."""
    tickets = fact(spark, sf)
    days = date_dimension(calendar_for(table(spark, sf, "orders"), "o_orderdate")).withColumn("month_no", F.month("full_date"))
    calendar = {"days": Dim(days.select("date_id", "year", "month_no", "month"), "date_key_created", "date_id")}
    return measure_query(
        tickets,
        ["year", "month_no", "month"],
        ["total_tickets", "sla_breach_rate"],
        calendar,
        order=[F.col("year"), F.col("month_no")],
    )


@query(
    "measures_by_resolved_year",
    f"WITH {FACT_SQL} SELECT CAST(year(resolved_at) AS INTEGER) AS year, {_list(['total_tickets'])} FROM fact GROUP BY 1",
)
def measures_by_resolved_year(spark, sf):
    """The date dimension in its inactive role, chosen at query time."""
    lines = table(spark, sf, "lineitem")
    days = date_dimension(calendar_for(lines, "l_shipdate")).select("date_id", "year")
    return measure_query(fact(spark, sf), ["year"], ["total_tickets"], {"days": Dim(days, "date_key_resolved", "date_id")})


@query(
    "date_rollup",
    f"""WITH {FACT_SQL}, d AS (SELECT *, CAST(year(created_at) AS INTEGER) AS year, CAST(quarter(created_at) AS INTEGER) AS quarter,
          CAST(month(created_at) AS INTEGER) AS month, CAST(day(created_at) AS INTEGER) AS day FROM fact)
        SELECT year, quarter, month, day, CAST(grouping_id(year, quarter, month, day) AS BIGINT) AS level,
               {_list(["total_tickets", "avg_resolution_time", "net_profit"])}
        FROM d GROUP BY ROLLUP (year, quarter, month, day)""",
)
def date_rollup_query(spark, sf):
    return date_rollup(fact(spark, sf), "created_at", ["total_tickets", "avg_resolution_time", "net_profit"])


# ---- calendars

_DAYS_SQL = """WITH days AS (SELECT CAST(d AS DATE) AS full_date FROM (SELECT unnest(generate_series(
    date_trunc('year', (SELECT min(l_shipdate) FROM lineitem)),
    date_trunc('year', (SELECT max(l_shipdate) FROM lineitem)) + INTERVAL 1 YEAR - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d))
"""


@query(
    "calendar",
    _DAYS_SQL
    + """SELECT full_date, CAST(year(full_date) AS INTEGER) AS year, CAST(month(full_date) AS INTEGER) AS month_no,
           strftime(full_date, '%B') AS month, CAST(quarter(full_date) AS INTEGER) AS quarter_no,
           'Qtr ' || quarter(full_date) AS quarter, CAST(day(full_date) AS INTEGER) AS day FROM days""",
)
def calendar_query(spark, sf):
    return with_hierarchy(calendar_for(table(spark, sf, "lineitem"), "l_shipdate"))


@query(
    "date_dim",
    _DAYS_SQL
    + """SELECT CAST(strftime(full_date, '%Y%m%d') AS INTEGER) AS date_id, full_date, strftime(full_date, '%A') AS day,
           strftime(full_date, '%B') AS month, 'Q' || quarter(full_date) AS quarter, CAST(year(full_date) AS INTEGER) AS year,
           CAST(isodow(full_date) - 1 AS INTEGER) AS day_of_week, isodow(full_date) >= 6 AS is_weekend FROM days""",
)
def date_dim_query(spark, sf):
    return date_dimension(calendar_for(table(spark, sf, "lineitem"), "l_shipdate"))


# ---- quality metrics: lines tagged by outcome, one "file" per ship mode flag


def _tagged(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        F.concat("l_returnflag", F.lit("_"), "l_linestatus", F.lit(".csv")).alias("file_name"),
        F.col("l_returnflag").alias("batch_id"),
        F.expr("CASE WHEN l_quantity >= 2 THEN l_quantity END").alias("quantity"),
        "l_discount",
        "l_partkey",
        "l_suppkey",
    )
    known = {
        "PartsDim": table(spark, sf, "part").filter("p_size > 3"),
        "SuppliersDim": table(spark, sf, "supplier").filter("s_acctbal >= 0"),
    }
    refs = [DimRef("PartsDim", "l_partkey", "p_partkey"), DimRef("SuppliersDim", "l_suppkey", "s_suppkey")]
    outcome = (
        F.when(F.col("quantity").isNull(), NULL_REQUIRED)
        .when(F.col("l_discount") > 0.09, INVALID)
        .when(F.size(MISSING_REFS) > 0, ORPHAN)
        .otherwise(PASSED)
    )
    return tag_orphans(lines, known, refs).withColumn(OUTCOME, outcome)


_METRICS_SQL = """WITH tagged AS (SELECT l_returnflag || '_' || l_linestatus || '.csv' AS file_name, l_returnflag AS batch_id,
    CASE WHEN l_quantity < 2 THEN 'null' WHEN l_discount > 0.09 THEN 'invalid'
         WHEN l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 3)
           OR l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0) THEN 'orphan' ELSE 'passed' END AS outcome FROM lineitem),
m AS (SELECT batch_id, file_name, count(*) AS total_records, count(*) FILTER (outcome = 'passed') AS passed_count,
        CAST(0 AS BIGINT) AS duplicate_count, count(*) FILTER (outcome = 'null') AS null_count,
        count(*) FILTER (outcome = 'orphan') AS orphan_count, count(*) FILTER (outcome <> 'passed') AS quarantined_count
      FROM tagged GROUP BY batch_id, file_name)
"""


def _metrics(spark, sf):
    return quality_metrics(_tagged(spark, sf), ["batch_id", "file_name"])


@query("quality_metrics", _METRICS_SQL + "SELECT * FROM m")
def quality_metrics_query(spark, sf):
    return _metrics(spark, sf)


@query(
    "quality_rates",
    _METRICS_SQL
    + """SELECT *, round(passed_count * 100.0 / total_records, 2)::DOUBLE AS passed_rate, 0.0::DOUBLE AS duplicate_rate,
           round(null_count * 100.0 / total_records, 2)::DOUBLE AS null_rate, round(orphan_count * 100.0 / total_records, 2)::DOUBLE AS orphan_rate,
           round(quarantined_count * 100.0 / total_records, 2)::DOUBLE AS quarantine_rate, quarantined_count - null_count - orphan_count AS bad_rows,
           round((quarantined_count - null_count - orphan_count) * 100.0 / total_records, 2)::DOUBLE AS bad_rows_rate,
           round(passed_count * 100.0 / (passed_count + orphan_count), 2)::DOUBLE AS referential_integrity_rate FROM m""",
)
def quality_rates(spark, sf):
    return with_rates(_metrics(spark, sf))


@query(
    "batch_rollup",
    _METRICS_SQL
    + """SELECT batch_id, count(*) AS files_processed, count(*) FILTER (total_records < 100) AS files_failed,
           count(*) FILTER (total_records >= 100 AND quarantined_count > 0) AS files_with_issues,
           CAST(sum(total_records) AS BIGINT) AS total_records, CAST(sum(passed_count) AS BIGINT) AS passed_count,
           CAST(sum(duplicate_count) AS BIGINT) AS duplicate_count, CAST(sum(null_count) AS BIGINT) AS null_count,
           CAST(sum(orphan_count) AS BIGINT) AS orphan_count, CAST(sum(quarantined_count) AS BIGINT) AS quarantined_count
         FROM m GROUP BY batch_id""",
)
def batch_rollup_query(spark, sf):
    """A file of fewer than 100 lines counts as failed."""
    return batch_rollup(_metrics(spark, sf).withColumn("file_success", F.col("total_records") >= 100))


@query(
    "null_counts",
    f"""WITH {TICKETS_SQL} SELECT 'ticket_id' AS column_name, count(*) FILTER (ticket_id IS NULL) AS null_count FROM tickets
        UNION ALL SELECT 'refund_amount', count(*) FILTER (refund_amount IS NULL) FROM tickets
        UNION ALL SELECT 'customer_id', count(*) FILTER (customer_id IS NULL) FROM tickets""",
)
def null_counts_query(spark, sf):
    return null_counts(fact(spark, sf), ["ticket_id", "refund_amount", "customer_id"])


@query(
    "threshold_alert",
    """WITH m AS (SELECT l_returnflag AS batch_id, count(*) AS total_records,
            count(*) FILTER (l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 6000)) AS orphan_count
          FROM lineitem GROUP BY 1)
       SELECT batch_id, total_records, orphan_count, orphan_count / CAST(total_records AS DOUBLE) AS orphan_share,
              'orphan share above 0.5' AS alert FROM m WHERE orphan_count / CAST(total_records AS DOUBLE) > 0.5""",
)
def threshold_alert(spark, sf):
    lines = table(spark, sf, "lineitem").select(F.col("l_returnflag").alias("batch_id"), "l_suppkey")
    tagged = tag_orphans(
        lines,
        {"SuppliersDim": table(spark, sf, "supplier").filter("s_acctbal >= 6000")},
        [DimRef("SuppliersDim", "l_suppkey", "s_suppkey")],
    )
    tagged = tagged.withColumn(OUTCOME, F.when(F.size(MISSING_REFS) > 0, ORPHAN).otherwise(PASSED))
    return threshold_alerts(quality_metrics(tagged, ["batch_id"]).select("batch_id", "total_records", "orphan_count"))


# ---- the flagship


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """SLA breach rate by region: join, derive, split orphans, aggregate, sort.

    The customers in debt are not loaded yet, so their tickets are orphans.
    """
    known = table(spark, sf, "customer").filter("c_acctbal >= 0").select(F.col("c_custkey").alias("customer_id"))
    clean = split_orphans(fact(spark, sf), {"CustomersDim": known}, [DimRef("CustomersDim", "customer_id")]).good
    return measure_query(
        clean,
        ["city_name", "region_name"],
        ["total_tickets", "sla_breach_rate", "avg_resolution_time"],
        {"regions": Dim(region_with_city(spark, sf), "region_id", "region_id")},
        order=[F.col("sla_breach_rate").desc(), F.col("region_name").asc()],
    )


query(
    "sla_breach_by_region",
    _JOINED_SQL
    + f"""SELECT city_name, region_name, {_list(["total_tickets", "sla_breach_rate", "avg_resolution_time"])} FROM joined
          WHERE customer_id IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0) GROUP BY city_name, region_name""",
)(flagship)
