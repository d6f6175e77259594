"""The quality gate: file-level schema check, row-level split."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from starloom.functions.rules import cast_text, type_label, type_ok
from starloom.sources.files import CORRUPT
from starloom.specs import OpResult, Rule, SourceSpec

REASON = "rejected_reason"
OUTCOME = "outcome"
PASSED, NULL_REQUIRED, INVALID, DUPLICATE, ORPHAN = "passed", "null", "invalid", "duplicate", "orphan"


def missing_columns(df: DataFrame, spec: SourceSpec) -> list[str]:
    """Required columns the file lacks (no job)."""
    return [c for c in spec.required if c not in df.columns]


def gate_counts(names: Iterable[str], model: StructType) -> list[Column]:
    """Aggregates of the file gate: per model column the non-null and the castable values."""
    names, aggs = set(names), []
    for f in model.fields:
        if f.name in names:
            aggs.append(F.count(f.name).alias(f"{f.name}_values"))
            aggs.append(F.count_if(type_ok(F.col(f.name), f.dataType)).alias(f"{f.name}_castable"))
    return aggs


def type_counts(df: DataFrame, model: StructType) -> DataFrame:
    """One row: per model column the non-null and the castable count, in one pass."""
    return df.agg(*gate_counts(df.columns, model))


def schema_gate(df: DataFrame, model: StructType) -> DataFrame:
    """Per present model column: counts and whether the column passes.

    A column fails when it has values and none of them is castable.
    """
    fields = [f for f in model.fields if f.name in df.columns]
    rows = F.array(
        *[
            F.struct(
                F.lit(f.name).alias("column_name"),
                F.lit(type_label(f.dataType)).alias("expected_type"),
                F.col(f"{f.name}_values").alias("value_count"),
                F.col(f"{f.name}_castable").alias("castable_count"),
            )
            for f in fields
        ]
    )
    return (
        type_counts(df, model)
        .select(F.inline(rows))
        .withColumn("passes", (F.col("value_count") == 0) | (F.col("castable_count") > 0))
    )


def schema_errors(df: DataFrame, spec: SourceSpec) -> list[str]:
    """Why the whole file must be rejected; empty if it may go on."""
    missing = missing_columns(df, spec)
    if missing:
        return [f"lacks the columns {missing}"]
    # one row, two numbers a column of the model: bounded by the schema, not by the data
    return gate_errors(type_counts(df, spec.schema).first().asDict(), spec)


def gate_errors(counts: Mapping[str, int], spec: SourceSpec) -> list[str]:
    """Why the whole file must be rejected, from its ``gate_counts``."""
    failed = [f for f in spec.schema.fields if counts.get(f"{f.name}_values", 0) and not counts[f"{f.name}_castable"]]
    return [f"no value of {f.name} is of type {type_label(f.dataType)}" for f in failed]


def required_reason(required: Iterable[str]) -> Column:
    """Reason text naming the null required fields, or null."""
    names = F.array_compact(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]))
    return F.when(
        F.size(names) > 0, F.concat(F.lit("no value in "), F.array_join(names, ", "))
    )


def type_reason(columns: Iterable[str], model: StructType) -> Column:
    """Reason of the first column, in model order, whose text has the wrong type."""
    columns = set(columns)
    checks = [
        F.when(
            ~type_ok(F.col(f.name), f.dataType),
            F.lit(f"{f.name} is not of type {type_label(f.dataType)}"),
        )
        for f in model.fields
        if f.name in columns
    ]
    return F.coalesce(*checks) if checks else F.lit(None).cast("string")


def rule_reason(rules: Iterable[Rule]) -> Column:
    checks = [F.when(~r.check(F.col(r.column)), F.lit(f"Rule '{r.name}' failed on '{r.column}'")) for r in rules]
    return F.coalesce(*checks) if checks else F.lit(None).cast("string")


def tag_rows(df: DataFrame, spec: SourceSpec) -> DataFrame:
    """Every row with its outcome and, unless it passed, the first reason.

    Rows of records that did not parse (``malformed_record``) are invalid,
    whatever else they hold.
    """
    broken = F.col(CORRUPT).isNotNull() if CORRUPT in df.columns else F.lit(False)
    null_reason = required_reason(spec.required) if spec.required else F.lit(None).cast("string")
    other = F.coalesce(type_reason(df.columns, spec.schema), rule_reason(spec.rules))
    return (
        df.withColumn("__null", null_reason)
        .withColumn(REASON, F.when(broken, F.lit("the record does not parse")).otherwise(F.coalesce(F.col("__null"), other)))
        .withColumn(
            OUTCOME,
            F.when(broken, INVALID).when(F.col("__null").isNotNull(), NULL_REQUIRED).when(F.col(REASON).isNotNull(), INVALID).otherwise(PASSED),
        )
        .drop("__null")
    )


def to_model(df: DataFrame, model: StructType) -> DataFrame:
    """Cast checked text columns to the model types; extra columns stay as they are."""
    types = {f.name: f.dataType for f in model.fields}
    return df.select(*[cast_text(F.col(c), types[c]).alias(c) if c in types else F.col(c) for c in df.columns])


def split_rows(df: DataFrame, spec: SourceSpec) -> OpResult:
    """Typed good rows; raw bad rows with their reason."""
    tagged = tag_rows(df, spec)
    good = tagged.filter(F.col(OUTCOME) == PASSED).drop(OUTCOME, REASON)
    return OpResult(to_model(good, spec.schema), tagged.filter(F.col(OUTCOME) != PASSED).drop(OUTCOME))


def validation_stats(tagged: DataFrame) -> DataFrame:
    return tagged.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col(OUTCOME) == PASSED).alias("passed_count"),
        F.count_if(F.col(OUTCOME) == NULL_REQUIRED).alias("null_count"),
        F.count_if(F.col(OUTCOME) == INVALID).alias("quarantined_count"),
    )


def validate(df: DataFrame, spec: SourceSpec) -> OpResult:
    """Row split plus its statistics, all from one tagged frame."""
    tagged = tag_rows(df, spec)
    good = tagged.filter(F.col(OUTCOME) == PASSED).drop(OUTCOME, REASON)
    bad = tagged.filter(F.col(OUTCOME) != PASSED).drop(OUTCOME)
    return OpResult(to_model(good, spec.schema), bad, validation_stats(tagged))
