"""Declarative descriptions of sources and target tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable, NamedTuple, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DoubleType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

STATIC_DIMENSION = "static_dimension"
DYNAMIC_DIMENSION = "dynamic_dimension"
FACT = "fact"
QUARANTINE = "quarantine_zone"

TYPES: dict[str, DataType] = {
    "int": IntegerType(),
    "bigint": LongType(),
    "double": DoubleType(),
    "string": StringType(),
    "boolean": BooleanType(),
    "date": DateType(),
    "timestamp_ntz": TimestampNTZType(),
}


def columns(text: str) -> StructType:
    """``"id int, name string"`` as a schema, without a running session."""
    pairs = [c.split() for c in text.split(",")]
    return StructType([StructField(name, TYPES[kind]) for name, kind in pairs])


# dimensions load before facts
LOAD_ORDER = {STATIC_DIMENSION: 0, DYNAMIC_DIMENSION: 1, FACT: 2, QUARANTINE: 3}


@dataclass(frozen=True)
class Rule:
    """A named row rule; ``check`` yields true for rows that pass (null passes)."""

    name: str
    column: str
    check: Callable[[Column], Column]


@dataclass(frozen=True)
class SourceSpec:
    """One raw file kind.  ``schema`` is the model; its order is the check order."""

    name: str
    file: str
    schema: StructType
    required: tuple[str, ...] = ()
    pii: tuple[str, ...] = ()
    dynamic: bool = True
    validate: bool = True
    rules: tuple[Rule, ...] = ()
    json_lines: bool = False
    # CSV fields may hold line breaks (then a file is read by one task)
    multiline: bool = False

    @property
    def format(self) -> str:
        return self.file.rsplit(".", 1)[-1].lower()


@dataclass(frozen=True)
class JoinStep:
    right: str
    left_key: str
    right_key: str
    how: str = "left"


@dataclass(frozen=True)
class DateDiff:
    name: str
    end: str
    start: str
    unit: str = "m"
    null_as_zero: bool = True


@dataclass(frozen=True)
class Compare:
    name: str
    left: str
    op: str
    right: str
    as_type: str | None = None


@dataclass(frozen=True)
class Term:
    column: str
    op: str = "+"
    factor: float = 1
    right_column: str | None = None


@dataclass(frozen=True)
class Arithmetic:
    name: str
    terms: tuple[Term, ...]


@dataclass(frozen=True)
class DateKey:
    name: str
    column: str


@dataclass(frozen=True)
class Expr:
    name: str
    sql: str


DeriveStep = Union[DateDiff, Compare, Arithmetic, DateKey, Expr]


@dataclass(frozen=True)
class DimRef:
    """A foreign key of a table.  A tuple ``fk`` (role-playing dates) is not checked."""

    dim: str
    fk: str | tuple[str, ...]
    pk: str | None = None


@dataclass(frozen=True)
class TableSpec:
    name: str
    kind: str
    key: str
    sources: tuple[str, ...] = ()
    joins: tuple[JoinStep, ...] = ()
    derived: tuple[DeriveStep, ...] = ()
    renamed: dict[str, str] = field(default_factory=dict)
    keep: tuple[str, ...] = ()
    dims: tuple[DimRef, ...] = ()
    required: tuple[str, ...] = ()
    date_columns: tuple[str, ...] = ()
    generated: bool = False
    null_safe_joins: bool = False
    partition_by: tuple[str, ...] = ()
    # a dimension with tracked columns keeps its history (type 2)
    tracked: tuple[str, ...] = ()


class OpResult(NamedTuple):
    """What a splitting operator returns: rows to go on with, rows to quarantine."""

    good: DataFrame
    bad: DataFrame
    metrics: DataFrame | None = None
