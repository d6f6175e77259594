"""A model from a mapping, as a JSON or YAML file of ``files`` and ``tables`` holds it.

Columns are named in lower case.  Types come from ``schemas`` (by ``model_class``), as a struct or as text for
``specs.columns``; row rules from ``rules`` (by file).  A table without ``source`` is generated, one of the quarantine is
left to the warehouse, which has its own.  One error names the faults of all files, tables, joins and
derived columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from typing import Any

from pyspark.sql.types import StructType

from starloom.functions.derive import COMPARE, SECONDS_PER
from starloom.plans.build import Model
from starloom.specs import (
    LOAD_ORDER,
    QUARANTINE,
    Arithmetic,
    Compare,
    DateDiff,
    DateKey,
    DeriveStep,
    DimRef,
    Expr,
    JoinStep,
    Rule,
    SourceSpec,
    TableSpec,
    Term,
    columns,
)

# Kinds of files, of joins and of arithmetic in a mapping.
FILE_KINDS = {"dynamic": True, "static": False}
JOINS = ("left", "inner", "right", "outer")
OPERATORS = ("+", "-", "*", "/")


def _names(values: Any) -> tuple[str, ...]:
    """One name or a list of them, in lower case."""
    return tuple(v.lower() for v in ([values] if isinstance(values, str) else values or ()))


def _derived(action: Mapping[str, Any], faults: list[str]) -> DeriveStep | None:
    name, kind, given = action["name"].lower(), action["type"], action.get("params", {})
    if kind == "arithmetic":
        terms = [Term(p["column"].lower(), p.get("op", "+"), p.get("factor", 1), p["right_column"].lower() if "right_column" in p else None) for p in given]
        faults += [f"column {name}: unknown operator {t.op!r}" for t in terms if t.op not in OPERATORS]
        if not terms:
            faults.append(f"column {name}: no terms")
        return Arithmetic(name, tuple(terms))
    if kind == "date_diff":
        if given.get("unit", "m") not in SECONDS_PER:
            faults.append(f"column {name}: unknown unit {given['unit']!r}")
        return DateDiff(name, given["end"].lower(), given["start"].lower(), given.get("unit", "m"), given.get("null_as_zero", True))
    if kind == "comparison":
        if given["op"] not in COMPARE:
            faults.append(f"column {name}: unknown comparison {given['op']!r}")
        return Compare(name, given["left"].lower(), given["op"], given["right"].lower(), given.get("as_type"))
    if kind == "date_to_key":
        return DateKey(name, given["column"].lower())
    if kind == "sql":
        return Expr(name, given["text"])
    faults.append(f"column {name}: unknown type {kind!r}")
    return None


def _all_derived(actions: Iterable[Mapping[str, Any]], faults: list[str]) -> tuple[DeriveStep, ...]:
    steps = []
    for a in actions:
        try:
            steps.append(_derived(a, faults))
        except KeyError as e:
            faults.append(f"column {a.get('name')}: no {e.args[0]}")
    return tuple(s for s in steps if s is not None)


def _joins(entries: Iterable[Mapping[str, Any]], sources: Sequence[str], faults: list[str]) -> tuple[JoinStep, ...]:
    steps = []
    for entry in entries:
        rights, left, right = _names(entry["right"]), _names(entry["left_keys"]), _names(entry["right_keys"])
        how = entry.get("type", "left")
        if not len(rights) == len(left) == len(right):
            faults.append(f"join of {', '.join(rights)}: {len(left)} left and {len(right)} right keys")
        if how not in JOINS:
            faults.append(f"join of {', '.join(rights)}: unknown type {how!r}")
        faults += [f"join of {r}: not a source of the table" for r in (*rights, entry["left"].lower()) if r not in sources]
        steps += [JoinStep(r, a, b, how) for r, a, b in zip(rights, left, right)]
    return tuple(steps)


def _references(entry: Mapping[str, Any], renamed: Mapping[str, str], faults: list[str]) -> tuple[DimRef, ...]:
    """References by ``dimension_sources`` and ``foreign_keys``, by the names that their columns have in the table."""
    refs = {}
    for d in entry.get("dimension_sources", ()):
        fk = tuple(renamed.get(c, c) for c in _names(d["fk"]))
        refs[fk] = DimRef(d["dim"], fk[0] if isinstance(d["fk"], str) else fk)
    for fk, to in entry.get("foreign_keys", {}).items():
        dim, pk = (to["dim_table"], to.get("pk_column")) if isinstance(to, Mapping) else (to.rsplit(".", 1) if "." in to else (to, None))
        fk = renamed.get(fk.lower(), fk.lower())
        if (fk,) in refs and refs[(fk,)].dim != dim:
            faults.append(f"{fk} refers to {refs[(fk,)].dim} and to {dim}")
        refs[(fk,)] = DimRef(dim, fk, pk.lower() if pk else None)
    return tuple(refs.values())


def _source(name: str, entry: Mapping[str, Any], schemas: Mapping[str, StructType | str], rules: Iterable[Rule], faults: list[str]) -> SourceSpec:
    schema = schemas.get(entry.get("model_class", ""))
    if schema is None:
        faults.append(f"no schema of {entry.get('model_class')!r}")
    schema = columns(schema) if isinstance(schema, str) else schema or StructType([])
    if entry.get("file_type", "dynamic") not in FILE_KINDS:
        faults.append(f"unknown file type {entry['file_type']!r}")
    known = {c.lower() for c in schema.names}
    for what in ("required_fields", "pii_fields"):
        faults += [f"{what}: {c} is not in its schema" for c in _names(entry.get(what)) if schema.names and c not in known]
    return SourceSpec(
        name,
        entry["file_name"],
        schema,
        required=_names(entry.get("required_fields")),
        pii=_names(entry.get("pii_fields")),
        dynamic=FILE_KINDS.get(entry.get("file_type", "dynamic"), True),
        validate=entry.get("validate", True),
        rules=tuple(rules),
        json_lines=entry.get("json_lines", False),
        multiline=entry.get("multiline", False),
    )


def _table(name: str, entry: Mapping[str, Any], sources: Mapping[str, SourceSpec], faults: list[str]) -> TableSpec:
    used = _names(entry.get("source"))
    faults += [f"unknown source {s}" for s in used if s not in sources]
    if entry["table_type"] not in LOAD_ORDER:
        faults.append(f"unknown table type {entry['table_type']!r}")
    derived = _all_derived((a for part in entry.get("aggregated_columns", ()) for a in part["actions"]), faults)
    renamed = {a.lower(): b.lower() for a, b in entry.get("renamed_columns", {}).items()}
    # a column that takes the name of another one takes its place
    raw = {c.lower() for s in used if s in sources for c in sources[s].schema.names}
    replaced = {b: f"source_{b}" for a, b in renamed.items() if a != b and b in raw and b not in renamed}
    tracked = _names(entry.get("tracked_columns"))
    return TableSpec(
        name,
        entry["table_type"],
        entry["primary_key"].lower(),
        used,
        _joins(entry.get("joins", ()), used, faults),
        derived,
        {**replaced, **{a: b for a, b in renamed.items() if a != b}},
        _names(entry.get("keep_columns")) if used else (),
        _references(entry, renamed, faults),
        _names(entry.get("required_fields")) if used else (),
        tuple(renamed.get(c, c) for c in _names(entry.get("date_columns"))) if used else (),
        generated=not used,
        null_safe_joins=entry.get("null_safe_joins", False),
        partition_by=_names(entry.get("partition_by")),
        tracked=tracked,
    )


def model_from_mapping(
    config: Mapping[str, Any], schemas: Mapping[str, StructType | str], rules: Mapping[str, Iterable[Rule]] | None = None
) -> Model:
    """The model that ``config`` describes; one ValueError names all that is wrong with it."""
    faults: list[str] = []

    def part(kind: str, name: str, make, *args):
        found: list[str] = []
        try:
            made = make(name, *args, found)
        except KeyError as e:
            made = None
            found.append(f"no {e.args[0]}")
        faults.extend(f"{kind} {name}: {f}" for f in found)
        return made

    rules = rules or {}
    faults += [f"rules of an unknown file {n}" for n in rules if n.lower() not in {f.lower() for f in config["files"]}]
    sources = {n.lower(): part("file", n.lower(), _source, e, schemas, rules.get(n, ())) for n, e in config["files"].items()}
    sound = {n: s for n, s in sources.items() if s is not None}
    entries = {n: e for n, e in config["tables"].items() if e.get("table_type") != QUARANTINE}
    tables = {n: part("table", n, _table, e, sound) for n, e in entries.items()}
    for t in tables.values():
        faults.extend(f"table {t.name}: refers to the unknown table {r.dim}" for r in (t.dims if t else ()) if r.dim not in tables)
    if faults:
        raise ValueError("; ".join(faults))
    # a reference that names no key means the key of its dimension, where that is called otherwise
    for n, t in tables.items():
        keyed = tuple(r if r.pk or tables[r.dim].key == r.fk else DimRef(r.dim, r.fk, tables[r.dim].key) for r in t.dims)
        if keyed != t.dims:
            tables[n] = TableSpec(**{**t.__dict__, "dims": keyed})
    model = Model(sources, tables)
    model.load_waves()  # tables that refer to each other in a circle cannot be loaded
    return model
