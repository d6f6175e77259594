"""Raw files: listing, matching to logical sources, reading as text columns."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from starloom.specs import SourceSpec, TableSpec

SOURCE_FILE = "source_file"
# the text of a record that does not parse
CORRUPT = "malformed_record"

# Texts a CSV field may use for null.
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

# .../2024-01-31/05/... with or without a "name=" in front of each value
DATE_HOUR = r"/(?:\w+=)?(\d{4}-\d\d-\d\d)/(?:\w+=)?(\d\d)/"
DATE_DIR = r"/(?:\w+=)?(\d{4}-\d\d-\d\d)/"
# a file written in parts is a directory named like the file
IN_PARTS = r"/(?:\w+=)?([^/=]+\.[A-Za-z]+)/part-[^/]*$"
BASENAME = r"([^/]+)$"


def logical_file(path: str) -> str:
    """The exact file name a path stands for."""
    parts = re.search(IN_PARTS, path)
    return parts.group(1) if parts else path.rsplit("/", 1)[-1]


def logical_file_of(path: Column) -> Column:
    parts = F.regexp_extract(path, IN_PARTS, 1)
    return F.when(parts != "", parts).otherwise(F.regexp_extract(path, BASENAME, 1))


def parts_folder(path: Column) -> Column:
    """The directory of a file written in parts, null for other files."""
    return F.when(path.rlike(IN_PARTS), F.regexp_extract(path, r"^(.*)/[^/]*$", 1))


def date_of(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, DATE_DIR, 1), F.lit(""))


def hour_of(path: Column) -> Column:
    return F.nullif(F.regexp_extract(path, DATE_HOUR, 2), F.lit(""))


def date_hour_from_path(df: DataFrame, path: str = SOURCE_FILE) -> DataFrame:
    """Add the date and hour named by the directories of the file."""
    return df.withColumns({"file_date": date_of(F.col(path)), "file_hour": hour_of(F.col(path))})


def list_files(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """Paths below a directory, or several; the file contents are not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")


def match_sources(paths: Iterable[str], specs: Iterable[SourceSpec]) -> dict[str, list[str]]:
    """Arrived paths per logical source, by exact file name."""
    by_file = {s.file: s.name for s in specs}
    out: dict[str, list[str]] = {}
    for p in paths:
        name = by_file.get(logical_file(p))
        if name is not None:
            out.setdefault(name, []).append(p)
    return out


def tables_with_files(tables: Iterable[TableSpec], arrived: Iterable[str]) -> list[TableSpec]:
    """Tables to build: not generated, at least one source arrived."""
    arrived = set(arrived)
    return [t for t in tables if not t.generated and arrived.intersection(t.sources)]


def text_schema(spec: SourceSpec) -> StructType:
    return StructType([StructField(f.name, StringType()) for f in spec.schema.fields])


def _null_texts_to_null(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    texts = ", ".join(f"'{t}'" for t in NULL_TEXTS)
    named = set(columns)
    return df.selectExpr(*[f"CASE WHEN `{c}` NOT IN ({texts}) THEN `{c}` END AS `{c}`" if c in named else f"`{c}`" for c in df.columns])


def _csv(spark: SparkSession, spec: SourceSpec, paths: list[str]) -> DataFrame:
    """Columns of the header; a record with more fields than the header is malformed, missing fields are null."""
    options = {"escape": '"', "multiLine": str(spec.multiline).lower()}
    reader = spark.read.options(header="true", enforceSchema="false", columnNameOfCorruptRecord=CORRUPT, **options)
    names = reader.csv(paths[0]).columns
    schema = StructType([StructField(c, StringType()) for c in [*names, CORRUPT]])
    # Spark marks short records too.  A text longer than the record is put behind its last field; it is among the columns
    # of the header only if the record is short.  An empty field is null like an absent one, so their values do not tell
    columns = ", ".join(f"c{i} string" for i in range(len(names)))
    behind = F.concat(F.regexp_replace(CORRUPT, r"[\r\n]+$", ""), F.lit(","), F.repeat(F.lit("x"), F.length(CORRUPT) + 1))
    parsed = F.from_csv(behind, columns, options)
    short = F.exists(F.array(*[parsed[f"c{i}"] for i in range(len(names))]), lambda v: F.length(v) > F.length(CORRUPT))
    extra_field = F.when(F.col(CORRUPT).isNotNull() & ~F.coalesce(short, F.lit(False)), F.col(CORRUPT))
    return reader.schema(schema).csv(paths).withColumn(CORRUPT, extra_field)


# Parsed as a stream (multiLine), a file is opened again for each number in it, to keep the digits as they were written.  As
# one long line it is read once.  Spark cuts lines at this byte, which no JSON text in UTF-8 has
WHOLE_FILE = {"lineSep": "\0"}


def read_source(
    spark: SparkSession, spec: SourceSpec, paths: Sequence[str], with_file: bool = False, with_corrupt: bool = False
) -> DataFrame:
    """All columns as text, nothing inferred.

    CSV takes its column names from the header, which must agree between the
    files of one call.  JSON is one array of records per file, or one record
    per line where the source says so (such files are read in splits).  A
    record that does not parse is in the column ``malformed_record`` with
    ``with_corrupt``; without it the read fails there, as it must not lose it.
    """
    paths = list(paths)
    if spec.format == "csv":
        df = _csv(spark, spec, paths)
    elif spec.format in ("json", "jsonl"):
        lines = spec.json_lines or spec.format == "jsonl"
        schema = StructType([*text_schema(spec).fields, StructField(CORRUPT, StringType())])
        df = spark.read.schema(schema).options(columnNameOfCorruptRecord=CORRUPT, **({} if lines else WHOLE_FILE)).json(paths)
    elif spec.format == "parquet":
        df = spark.read.parquet(*paths)
        df = df.select(*[F.col(c).cast("string").alias(c) for c in df.columns], F.lit(None).cast("string").alias(CORRUPT))
    else:
        raise ValueError(f"unsupported file type {spec.format!r} of source {spec.name!r}")
    columns = [c for c in df.columns if c != CORRUPT]
    extra = [F.col("_metadata.file_path").alias(SOURCE_FILE)] if with_file else []
    df = df.select(*columns, CORRUPT, *extra)
    if spec.format == "csv":
        df = _null_texts_to_null(df, columns)
    if with_corrupt:
        return df
    why = F.concat(F.lit(f"malformed record in source {spec.name!r}: "), F.col(CORRUPT))
    checked = F.when(F.col(CORRUPT).isNotNull(), F.raise_error(why).cast("string")).otherwise(F.col(columns[0]))
    return df.withColumn(columns[0], checked).drop(CORRUPT)


# failures of a job come as either of them
SPARK_ERRORS = (PySparkException, Py4JJavaError)


def error_text(e: Exception) -> str:
    """The first line that says what went wrong."""
    text = str(e.java_exception.getMessage()) if isinstance(e, Py4JJavaError) else str(e)
    return (text.splitlines() or [""])[0]


class Scan(NamedTuple):
    ok: bool
    df: DataFrame | None
    errors: list[str]


def scan(
    spark: SparkSession, spec: SourceSpec, paths: Sequence[str], with_file: bool = False, with_corrupt: bool = False
) -> Scan:
    """``read_source`` with a status instead of an exception."""
    if not paths:
        return Scan(False, None, [f"no file for source {spec.name!r}"])
    try:
        return Scan(True, read_source(spark, spec, paths, with_file, with_corrupt), [])
    except (*SPARK_ERRORS, ValueError) as e:
        return Scan(False, None, [f"read failed for source {spec.name!r}: {error_text(e)}"])


def counted(df: DataFrame, name: str = "total_in_records") -> tuple[DataFrame, Observation]:
    """Count the rows while the frame is used; the count is ready after its first action."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias(name)), seen
