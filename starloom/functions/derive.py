"""Derived columns: time differences, comparisons, arithmetic, date keys."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.specs import Arithmetic, Compare, DateDiff, DateKey, DeriveStep, Expr, Term

SECONDS_PER = {"s": 1, "m": 60, "h": 3600, "d": 86400}

COMPARE = {
    "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b,
    ">": lambda a, b: a > b,
    ">=": lambda a, b: a >= b,
    "==": lambda a, b: a == b,
    "!=": lambda a, b: a != b,
}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_timestamp(c: Column | str) -> Column:
    """Zone-free timestamp; anything unparseable becomes null."""
    return _col(c).try_cast("timestamp_ntz")


def as_number(c: Column | str) -> Column:
    """Double; null and unparseable values become 0."""
    return F.coalesce(_col(c).try_cast("double"), F.lit(0.0))


def elapsed_seconds(start: Column | str, end: Column | str) -> Column:
    """Exact seconds between two zone-free timestamps, with microseconds.

    Interval arithmetic keeps the session zone (and its clock changes) out.
    """
    span = as_timestamp(end) - as_timestamp(start)
    return span.cast("interval second").cast("decimal(20,6)").cast("double")


def date_diff(start: Column | str, end: Column | str, unit: str = "m", null_as_zero: bool = True) -> Column:
    """Whole units between two timestamps: half-even rounding, floor for days."""
    if unit not in SECONDS_PER:
        raise ValueError(f"unknown time unit {unit!r}")
    amount = elapsed_seconds(start, end) / F.lit(float(SECONDS_PER[unit]))
    whole = (F.floor(amount) if unit == "d" else F.rint(amount)).cast("long")
    return F.coalesce(whole, F.lit(0).cast("long")) if null_as_zero else whole


def compare(left: Column | str, op: str, right: Column | str, as_type: str | None = None) -> Column:
    """Two-valued comparison: a null operand makes ``!=`` true, all others false.

    ``as_type`` ("timestamp" or "number") parses text operands first.
    """
    if op not in COMPARE:
        raise ValueError(f"unknown comparison {op!r}")
    a, b = _col(left), _col(right)
    if as_type == "timestamp":
        a, b = as_timestamp(a), as_timestamp(b)
    elif as_type == "number":
        a, b = a.try_cast("double"), b.try_cast("double")
    return F.coalesce(COMPARE[op](a, b), F.lit(op == "!="))


def arithmetic(terms: Iterable[Term]) -> Column:
    """Left-to-right arithmetic over columns.

    The first term only starts the value (its operator is not used).  With a
    ``right_column``, ``*`` and ``/`` use that column in place of ``column``.
    Division by zero gives null.
    """
    total: Column | None = None
    for t in terms:
        factor = F.lit(float(t.factor))
        if total is None:
            total = as_number(t.column) * factor
        elif t.op == "+":
            total = total + as_number(t.column) * factor
        elif t.op == "-":
            total = total - as_number(t.column) * factor
        elif t.op in ("*", "/"):
            operand = as_number(t.right_column or t.column) * factor
            total = total * operand if t.op == "*" else F.try_divide(total, operand)
        else:
            raise ValueError(f"unknown arithmetic operator {t.op!r}")
    if total is None:
        raise ValueError("arithmetic needs at least one term")
    return total


def date_to_key(c: Column | str) -> Column:
    """yyyymmdd as an integer; null for null or unparseable input."""
    day = as_timestamp(c).cast("date")
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def derive_column(step: DeriveStep) -> Column:
    if isinstance(step, DateDiff):
        return date_diff(step.start, step.end, step.unit, step.null_as_zero)
    if isinstance(step, Compare):
        return compare(step.left, step.op, step.right, step.as_type)
    if isinstance(step, Arithmetic):
        return arithmetic(step.terms)
    if isinstance(step, DateKey):
        return date_to_key(step.column)
    if isinstance(step, Expr):
        return F.expr(step.sql)
    raise TypeError(f"unknown derive step {type(step).__name__}")


def _reads(step: DeriveStep) -> set[str] | None:
    """Columns a step reads; unknown for a free expression."""
    if isinstance(step, DateDiff):
        return {step.start, step.end}
    if isinstance(step, Compare):
        return {step.left, step.right}
    if isinstance(step, Arithmetic):
        return {c for t in step.terms for c in (t.column, t.right_column) if c}
    return {step.column} if isinstance(step, DateKey) else None


def apply_derived(df: DataFrame, steps: Iterable[DeriveStep]) -> DataFrame:
    """Add derived columns in order; later steps may read earlier ones.

    Steps that do not read each other share one projection.
    """
    group: dict[str, Column] = {}
    for step in steps:
        reads = _reads(step)
        if group and (reads is None or step.name in group or reads & group.keys()):
            df, group = df.withColumns(group), {}
        group[step.name] = derive_column(step)
    return df.withColumns(group) if group else df
