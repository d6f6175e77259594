"""From source and table descriptions to lazy plans."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starloom.functions.calendar import date_dimension, day_range
from starloom.functions.derive import apply_derived
from starloom.functions.masking import hash_pii
from starloom.operators.joins import join_chain
from starloom.operators.shape import drop_repeated_names, keep_columns, rename_present
from starloom.operators.validation import OUTCOME, PASSED, REASON, tag_rows, to_model, validation_stats
from starloom.specs import DYNAMIC_DIMENSION, LOAD_ORDER, OpResult, SourceSpec, TableSpec, columns


HISTORY_COLUMNS = columns("surrogate_key string, valid_from date, valid_to date, is_current boolean")


@dataclass(frozen=True)
class Model:
    """All sources and target tables of one warehouse."""

    sources: Mapping[str, SourceSpec]
    tables: Mapping[str, TableSpec]

    def load_waves(self) -> list[list[TableSpec]]:
        """Dimensions before facts, parents before the tables that refer to them.

        Tables of one wave do not depend on each other.
        """
        waves: list[list[TableSpec]] = []
        todo = [t for t in self.tables.values() if not t.generated]
        while todo:
            names = {t.name for t in todo}
            first = min(LOAD_ORDER[t.kind] for t in todo)
            wave = [
                t
                for t in todo
                if LOAD_ORDER[t.kind] <= max(first, LOAD_ORDER[DYNAMIC_DIMENSION])
                and not any(r.dim in names and r.dim != t.name for r in t.dims)
            ]
            if not wave:
                raise ValueError(f"tables refer to each other in a circle: {sorted(names)}")
            waves.append(wave)
            todo = [t for t in todo if t not in wave]
        return waves

    def pii_of(self, table: TableSpec) -> list[str]:
        return [c for s in table.sources for c in self.sources[s].pii]


def prepare_source(df: DataFrame, spec: SourceSpec) -> OpResult:
    """Raw text rows to typed, checked and masked rows, plus the rejected ones."""
    if not spec.validate:
        return OpResult(hash_pii(to_model(df, spec.schema), spec.pii), df.filter(F.lit(False)).withColumn(REASON, F.lit("")))
    tagged = tag_rows(df, spec)
    return OpResult(good_rows(tagged, spec), bad_rows(tagged), validation_stats(tagged))


def good_rows(tagged: DataFrame, spec: SourceSpec) -> DataFrame:
    good = tagged.filter(F.col(OUTCOME) == PASSED).drop(OUTCOME, REASON)
    return hash_pii(to_model(good, spec.schema), spec.pii)


def bad_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(OUTCOME) != PASSED).drop(OUTCOME)


def build_table(inputs: Mapping[str, DataFrame], table: TableSpec) -> DataFrame:
    """Join the sources, derive, rename and project to the table's columns."""
    base, *_ = table.sources
    if base not in inputs:
        raise ValueError(f"base table {base!r} not found for {table.name}")
    joined = join_chain(inputs[base], inputs, table.joins, table.null_safe_joins)
    shaped = rename_present(apply_derived(joined, table.derived), table.renamed)
    return keep_columns(drop_repeated_names(shaped), table.keep) if table.keep else shaped


def source_schema(spec: SourceSpec) -> StructType:
    """Types of a prepared source: the model's, with text for hashed columns."""
    return StructType(
        [StructField(f.name, StringType() if f.name in spec.pii else f.dataType) for f in spec.schema.fields]
    )


def table_schema(spark: SparkSession, table: TableSpec, sources: Mapping[str, SourceSpec]) -> StructType:
    """The table's columns and types, from its plan over empty sources."""
    if table.generated:
        return date_dimension(day_range(spark, "2000-01-01", "2000-01-01")).schema
    empty = {s: spark.createDataFrame([], source_schema(sources[s])) for s in table.sources}
    built = build_table(empty, table).schema
    return StructType([*built.fields, *HISTORY_COLUMNS.fields]) if table.tracked else built


def sources_of(tables: Iterable[TableSpec]) -> set[str]:
    return {s for t in tables for s in t.sources}
