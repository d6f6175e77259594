"""From raw documents to packed training sequences: five stages, each written as Parquet and read by the next.

Language ID drops documents of no language, the similarity join keeps one document of each group of near copies,
repeated passages are cut, secrets are masked, and what remains is packed.  Columns other than text and n_chars stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.language_crf import accepted
from starloom.llm.ngram_jaccard import one_of_each
from starloom.llm.packing import pieces
from starloom.llm.runtime import prepare, table
from starloom.llm.secret_scan import redacted
from starloom.llm.substring_dedup import deduplicated
from starloom.session import scratch_path


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else docs


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    prepare(spark)
    return accepted(docs)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one with the smallest doc_id."""
    prepare(spark)
    return one_of_each(docs)


def passages_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that a smaller document has."""
    prepare(spark)
    return _measured(deduplicated(docs))


def secrets_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a mark in place of each secret."""
    prepare(spark)
    return _measured(redacted(docs))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 ids, with the ids (little-endian, 32 bits each)."""
    prepare(spark)
    return pieces(docs, with_ids=True)


STAGES = [
    ("language_id", language_stage),
    ("ngram_jaccard_join", near_copies_stage),
    ("substring_dedup", passages_stage),
    ("secret_scans", secrets_stage),
    ("packing", packing_stage),
]

#: The language model is trained, and ids come from a tokenizer: SQL cannot say either.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last one."""
    docs = table(prepare(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
