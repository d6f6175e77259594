"""Business measures over a fact and its dimensions.

Every measure is a set of sums that can be added up again, plus a final
expression over them.  A query first aggregates the fact by its foreign keys,
then joins the dimensions to that much smaller result and aggregates again, so
the join moves one row per key and map task instead of every fact row and a
hot key collapses before it is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Measure:
    """``sums`` maps a partial name to its aggregate text; ``final`` is over those names."""

    sums: tuple[tuple[str, str], ...]
    final: str


def _avg(column: str) -> Measure:
    return Measure(
        ((f"sum_{column}", f"sum({column})"), (f"n_{column}", f"count({column})")),
        f"try_divide(cast(sum_{column} as double), n_{column})",
    )


def _money(column: str) -> tuple[tuple[str, str], tuple[str, str]]:
    """Sums of whole units and of millionths, as 64-bit integers.

    They do not depend on the order of the rows, so a repeated run gives the same digits.  Amounts are rounded at the
    sixth decimal, one by one; the sum of their whole units must stay below 9.2e18.
    """
    fraction = f"{column} - floor({column})"
    return (f"units_{column}", f"sum(cast(floor({column}) as bigint))"), (f"micros_{column}", f"sum(cast(round(({fraction}) * 1000000) as bigint))")


def _total(column: str) -> str:
    """Millionths of the sum, exactly."""
    return f"(cast(units_{column} as decimal(38, 0)) * 1000000 + micros_{column})"


def _sum(column: str) -> Measure:
    return Measure(_money(column), f"cast({_total(column)} / 1000000 as double)")


# The measures of the semantic model.
MEASURES: dict[str, Measure] = {
    "total_tickets": Measure((("n_ticket_id", "count(ticket_id)"),), "n_ticket_id"),
    "sla_breach_rate": Measure(
        (("n_breached", "count_if(sla_resolution_breached)"), ("n_rows", "count(*)")),
        "try_divide(cast(n_breached as double), n_rows)",
    ),
    "avg_resolution_time": _avg("resolution_time_min"),
    "first_response_time": _avg("first_response_time_min"),
    "total_refund_amount": _sum("refund_amount"),
    "total_sales": _sum("total_amount"),
    "total_revenue_impact": _sum("revenue_impact"),
    "net_profit": Measure(
        (*_money("total_amount"), *_money("revenue_impact")),
        # a blank operand counts as 0, two blanks stay blank
        "case when units_total_amount is null and units_revenue_impact is null then null "
        f"else cast((coalesce({_total('total_amount')}, 0) - coalesce({_total('revenue_impact')}, 0)) / 1000000 as double) end",
    ),
}

# The two selectable measure lists, in display order.
TICKET_MEASURES = ("total_tickets", "total_revenue_impact", "total_refund_amount", "total_sales", "net_profit")
RESPONSE_MEASURES = ("avg_resolution_time", "first_response_time", "net_profit", "sla_breach_rate")


@dataclass(frozen=True)
class Dim:
    """A dimension as a measure query sees it."""

    table: DataFrame
    fk: str
    pk: str


def _partials(names: Sequence[str], registry: Mapping[str, Measure]) -> dict[str, str]:
    out: dict[str, str] = {}
    for n in names:
        out.update(registry[n].sums)
    return out


def aggregate(df: DataFrame, by: Sequence[str], names: Sequence[str], registry: Mapping[str, Measure]) -> DataFrame:
    """Measures of one frame, grouped or (without keys) as a single row."""
    sums = _partials(names, registry)
    out = df.groupBy(*by).agg(*[F.expr(e).alias(p) for p, e in sums.items()])
    return out.select(*by, *[F.expr(registry[n].final).alias(n) for n in names])


def measure_query(
    fact: DataFrame,
    by: Sequence[str] = (),
    measures: Sequence[str] = ("total_tickets",),
    dims: Mapping[str, Dim] | None = None,
    where: Column | None = None,
    dim_filters: Mapping[str, Column] | None = None,
    order: Sequence[Column] = (),
    limit: int | None = None,
    registry: Mapping[str, Measure] = MEASURES,
    inner: bool = False,
) -> DataFrame:
    """Group the fact by fact or dimension attributes and compute measures.

    ``dims`` are joined on their keys where ``by`` or ``dim_filters`` needs
    them; rows without a dimension row stay under null unless ``inner``.
    """
    dims, dim_filters = dict(dims or {}), dict(dim_filters or {})
    if where is not None:
        fact = fact.filter(where)
    from_fact = [c for c in by if c in fact.columns]
    wanted = [c for c in by if c not in from_fact]
    used = {n: d for n, d in dims.items() if n in dim_filters or any(c in d.table.columns for c in wanted)}
    missing = [c for c in wanted if not any(c in d.table.columns for d in used.values())]
    if missing:
        raise ValueError(f"unknown group columns: {missing}")

    if not used:
        out = aggregate(fact, by, measures, registry)
    else:
        sums = _partials(measures, registry)
        # filtered dimensions cut the fact before it is aggregated
        tables = {n: d.table.filter(dim_filters[n]) if n in dim_filters else d.table for n, d in used.items()}
        for name in dim_filters:
            keys = tables[name].select(F.col(used[name].pk).alias("__wanted"))
            fact = fact.join(keys, F.col(used[name].fk) == F.col("__wanted"), "left_semi")
        # a dimension that only filters is not joined again
        used = {n: d for n, d in used.items() if any(c in d.table.columns for c in wanted)}
        keys = list(dict.fromkeys([*from_fact, *[d.fk for d in used.values()]]))
        out = fact.groupBy(*keys).agg(*[F.expr(e).alias(p) for p, e in sums.items()])
        left = list(wanted)
        for name, d in used.items():
            attrs = [c for c in left if c in d.table.columns]
            left = [c for c in left if c not in attrs]
            table = tables[name].select(F.col(d.pk).alias(f"__pk_{name}"), *attrs)
            how = "inner" if inner or name in dim_filters else "left"
            out = out.join(table, F.col(d.fk) == F.col(f"__pk_{name}"), how)
        out = out.groupBy(*by).agg(*[F.sum(p).alias(p) for p in sums])
        out = out.select(*by, *[F.expr(registry[n].final).alias(n) for n in measures])
    if order:
        out = out.orderBy(*order)
    return out.limit(limit) if limit is not None else out


def measures_long(wide: DataFrame, by: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """One row per group and measure, with the measure's display order."""
    pairs = F.array(
        *[
            F.struct(F.lit(i).alias("measure_order"), F.lit(n).alias("measure"), F.col(n).cast("double").alias("value"))
            for i, n in enumerate(measures)
        ]
    )
    return wide.select(*by, F.inline(pairs))


def pick_measures(names: Iterable[str], allowed: Sequence[str]) -> list[str]:
    """The selected measures in display order."""
    names = set(names)
    unknown = names - set(allowed)
    if unknown:
        raise ValueError(f"unknown measures: {sorted(unknown)}")
    return [n for n in allowed if n in names]


def date_rollup(fact: DataFrame, column: str, measures: Sequence[str], registry: Mapping[str, Measure] = MEASURES) -> DataFrame:
    """Measures at every level of year > quarter > month > day, with the grand total.

    The fact is aggregated to days first; only the days are rolled up.
    """
    sums = _partials(measures, registry)
    daily = fact.groupBy(F.to_date(F.col(column)).alias("__day")).agg(*[F.expr(e).alias(p) for p, e in sums.items()])
    day = F.col("__day")
    levels = daily.withColumns(
        {"year": F.year(day), "quarter": F.quarter(day), "month": F.month(day), "day": F.dayofmonth(day)}
    )
    out = levels.rollup("year", "quarter", "month", "day").agg(
        F.grouping_id().alias("level"), *[F.sum(p).alias(p) for p in sums]
    )
    return out.select(
        "year", "quarter", "month", "day", "level", *[F.expr(registry[n].final).alias(n) for n in measures]
    )


def breach_rate_percent(fact: DataFrame, by: Sequence[str], dims: Mapping[str, Dim], flag: str) -> DataFrame:
    """Share of breached tickets in percent, two decimals."""
    registry = {
        "breach_rate_pct": Measure(
            (("n_hit", f"count_if({flag})"), ("n_all", "count(*)")), "round(n_hit * 100.0D / n_all, 2)"
        )
    }
    return measure_query(fact, by, ["breach_rate_pct"], dims, registry=registry, inner=True)


def top_groups(
    fact: DataFrame, by: Sequence[str], dims: Mapping[str, Dim], k: int | None = None, count: str = "ticket_count"
) -> DataFrame:
    """Row counts per group, largest first; ``k`` keeps the top groups."""
    registry = {count: Measure((("n_all", "count(*)"),), "n_all")}
    order = [F.col(count).desc(), *[F.col(c).asc() for c in by]]
    return measure_query(fact, by, [count], dims, registry=registry, inner=True, order=order, limit=k)
