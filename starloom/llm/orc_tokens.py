"""Token ids in ORC files: run-length encoded integers, row indexes, Bloom filters on document ids.

Documents are range-partitioned by doc_id and sorted, so files and stripes hold disjoint ranges of it: readers take
stripes in parallel, and a lookup by doc_id skips files, stripes and row groups by their statistics and Bloom filters.
Each file knows only places within itself; what lies before it follows from the files' totals (``packing.part_offsets``),
read from the narrow columns alone.

Defined cases: null and empty texts are the end id alone; documents with one doc_id stand in the order of their texts; a
null doc_id comes first; repeated rows stay; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.packing import tokenized, with_offsets

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
END_ID = 1
SCHEMA = "doc_id long, part int, begin long, n_tokens long, ids array<int>"
FORMAT = {
    "compression": "zstd",
    "orc.create.index": "true",
    "orc.row.index.stride": "1000",
    "orc.stripe.size": str(16 << 20),
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def write_tokens(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text") -> None:
    """Tokenize ``docs`` and write the files in ascending doc_id order."""
    ordered = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")

    tokenized(ordered, tokenizer, end_id, arrays=True).write.format("orc").options(**FORMAT).save(path)


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids."""
    return with_offsets(spark.read.schema(SCHEMA).orc(path)).select("doc_id", F.col("at").alias("start"), "n_tokens", "ids")


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Ids of a few documents; the filter reaches the ORC reader, which skips by statistics and Bloom filters."""
    return spark.read.schema(SCHEMA).orc(path).filter(F.col("doc_id").isin(doc_ids)).select("doc_id", "n_tokens", "ids")


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of what read_tokens() returns."""

    def run(batches):
        for batch in batches:
            lists = batch.column("ids")
            ids = lists.flatten().to_numpy(zero_copy_only=False).astype("<u4").tobytes()
            ends = np.cumsum([0, *np.diff(lists.offsets.to_numpy())]).tolist()
            crc = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "start")), pa.array(np.diff(ends).astype(np.int64)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
