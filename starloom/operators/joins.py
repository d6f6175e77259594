"""Joins between sources and between facts and dimensions.

No join forces a broadcast: Spark broadcasts a side only where its size, from
file statistics or measured after a shuffle, is below the session threshold,
and shuffles otherwise.  A hot key on the driving (left) side is then split by
the adaptive skew join; right and full joins are phrased so that the same
split applies to them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.specs import DimRef, JoinStep

JOIN_TYPES = {"left": "left", "right": "right", "inner": "inner", "full": "full", "outer": "full"}
_KEY = "__right_key"


def join_step(left: DataFrame, right: DataFrame, step: JoinStep, null_safe: bool = False) -> DataFrame:
    """One equi-join.

    Overlapping right columns get the suffix ``_<right name>``; a key of the
    same name on both sides stays one column.
    """
    if step.how not in JOIN_TYPES:
        raise ValueError(f"unsupported join type {step.how!r}")
    how = JOIN_TYPES[step.how]
    for side, df, key in (("left", left, step.left_key), ("right", right, step.right_key)):
        if key not in df.columns:
            raise ValueError(f"join with {step.right}: {side} key {key!r} not found")

    shared = step.left_key == step.right_key
    renames = {c: f"{c}_{step.right}" for c in right.columns if c in left.columns and not (shared and c == step.right_key)}
    right_out = [renames.get(c, c) for c in right.columns if not (shared and c == step.right_key)]
    right = right.withColumn(_KEY, F.col(step.right_key)).withColumnsRenamed(renames)
    if shared:
        right = right.drop(step.right_key)
    left_key, right_key = F.col(step.left_key), F.col(_KEY)
    on = left_key.eqNullSafe(right_key) if null_safe else left_key == right_key

    matched = left.join(right, on, "left" if how in ("left", "full") else "inner").select(*left.columns, *right_out)
    if how in ("left", "inner"):
        return matched
    # right rows without partner; the left keys are reduced before they are shuffled
    keys = left.select(left_key.alias("__left_key")).distinct()
    on = F.col("__left_key").eqNullSafe(right_key) if null_safe else F.col("__left_key") == right_key
    types = {f.name: f.dataType for f in left.schema.fields}
    blanks = [
        (right_key if shared and c == step.left_key else F.lit(None).cast(types[c])).alias(c) for c in left.columns
    ]
    alone = right.join(keys, on, "left_anti").select(*blanks, *right_out)
    return matched.unionByName(alone)


def join_chain(
    base: DataFrame, rights: Mapping[str, DataFrame], steps: Iterable[JoinStep], null_safe: bool = False
) -> DataFrame:
    """Join the right tables onto the base in the given order; no steps, no change."""
    out = base
    for step in steps:
        if step.right not in rights:
            raise ValueError(f"right table {step.right!r} not found")
        out = join_step(out, rights[step.right], step, null_safe)
    return out


def star_join(fact: DataFrame, dims: Mapping[str, DataFrame], refs: Iterable[DimRef]) -> DataFrame:
    """Fact with the attributes of each declared dimension (left joins)."""
    out = fact
    for ref in refs:
        if isinstance(ref.fk, tuple) or ref.fk not in out.columns:
            continue
        pk = ref.pk or ref.fk
        dim = dims[ref.dim].withColumnRenamed(pk, _KEY)
        clash = {c: f"{c}_{ref.dim}" for c in dim.columns if c in out.columns}
        out = out.join(dim.withColumnsRenamed(clash), F.col(ref.fk) == F.col(_KEY), "left").drop(_KEY)
    return out


def snowflake_join(child: DataFrame, parent: DataFrame, fk: str, pk: str | None = None, name: str = "parent") -> DataFrame:
    """A dimension with the attributes of its own parent dimension."""
    return join_step(child, parent, JoinStep(name, fk, pk or fk))


def role_date_join(fact: DataFrame, date_dim: DataFrame, role_key: str, prefix: str) -> DataFrame:
    """Date attributes for one of several date keys, under a role prefix."""
    role = date_dim.select(*[F.col(c).alias(f"{prefix}_{c}") for c in date_dim.columns])
    return fact.join(role, F.col(role_key) == F.col(f"{prefix}_date_id"), "left")


def date_part_join(df: DataFrame, column: str, days: DataFrame, day: str = "full_date") -> DataFrame:
    """Join a timestamp to a calendar by its date part."""
    return df.join(days, F.to_date(F.col(column)) == F.col(day), "left")


def cross_filter(dim: DataFrame, fact: DataFrame, dim_key: str, fk: str) -> DataFrame:
    """Dimension rows that the (filtered) fact refers to."""
    used = fact.select(F.col(fk).alias(_KEY)).distinct()
    return dim.join(used, F.col(dim_key) == F.col(_KEY), "left_semi")


@dataclass(frozen=True)
class Edge:
    """A relationship of a model: ``fk`` of the table ``many`` names a row of the table ``one`` by its ``pk``.

    Filters go from ``one`` to ``many``, and with ``both`` back as well.
    """

    many: str
    fk: str
    one: str
    pk: str
    both: bool = False


def cross_filter_all(tables: Mapping[str, DataFrame], edges: Iterable[Edge], slicers: Mapping[str, Column]) -> dict[str, DataFrame]:
    """Every table cut to what the slicers of all tables leave of it.

    Filters travel along the relationships, through any number of tables, by
    semi-joins on distinct keys.  The relationships must not form a circle; a
    branch without slicers costs nothing.
    """
    edges = list(edges)
    links: dict[str, list[tuple[str, str, str, bool]]] = {t: [] for t in tables}
    for e in edges:
        # (neighbour, own key, its key, whether its filter reaches this table)
        links[e.many].append((e.one, e.fk, e.pk, True))
        links[e.one].append((e.many, e.pk, e.fk, e.both))
    _refuse_circles(links)

    def sliced(name: str, origin: str | None) -> bool:
        return name in slicers or any(reaches and sliced(n, name) for n, _, _, reaches in links[name] if n != origin)

    def cut(name: str, origin: str | None) -> DataFrame:
        out = tables[name].filter(slicers[name]) if name in slicers else tables[name]
        for n, own, other, reaches in links[name]:
            if n != origin and reaches and sliced(n, name):
                keys = cut(n, name).select(F.col(other).alias(_KEY)).distinct()
                out = out.join(keys, F.col(own) == F.col(_KEY), "left_semi")
        return out

    return {name: cut(name, None) for name in tables}


def _refuse_circles(links: Mapping[str, list[tuple[str, str, str, bool]]]) -> None:
    seen: set[str] = set()
    for start in links:
        if start in seen:
            continue
        todo: list[tuple[str, str | None]] = [(start, None)]
        while todo:
            name, origin = todo.pop()
            if name in seen:
                raise ValueError(f"the relationships form a circle at {name!r}")
            seen.add(name)
            neighbours = [n for n, *_ in links[name]]
            if origin is not None:
                neighbours.remove(origin)
            todo += [(n, name) for n in neighbours]


def existing_keys(keys: DataFrame, column: str, table: DataFrame, pk: str) -> DataFrame:
    """Distinct values of ``column`` that occur as ``pk`` in the table."""
    known = table.select(F.col(pk).alias(_KEY))
    return keys.select(column).dropna().distinct().join(known, F.col(column) == F.col(_KEY), "left_semi")


def missing_keys(keys: DataFrame, column: str, table: DataFrame, pk: str) -> DataFrame:
    """Distinct non-null values of ``column`` that do not occur as ``pk``."""
    known = table.select(F.col(pk).alias(_KEY))
    return keys.select(column).dropna().distinct().join(known, F.col(column) == F.col(_KEY), "left_anti")
