"""Packing of tokenized documents into training sequences: concatenate and cut.

All documents follow each other as one stream of ids, an end id after each; sequence k is what lies in
[k * size, (k + 1) * size).  Only the last sequence is short.

Pass one tokenizes, writes the ids to the shared folder and notes where each document begins in its partition.  The
partitions' totals, one row each, become prefix sums, so pass two knows every document's place in the stream and cuts
it at multiples of ``size``; a document over a border gives a piece to each side.

Defined cases: null and empty texts are the end id alone; repeated rows stay; the order is that of partitions and rows
as they were read; extra columns are ignored; an empty table gives no pieces.
"""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.runtime import chunks, stage
from starloom.llm.tokens import encoder

SIZE = 1024
END_ID = 0
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
#: Text that is tokenized at once; the more, the fewer of its words are distinct.
CHUNK_BYTES = 3 << 20


def tokenized(docs: DataFrame, tokenizer: str = TOKENIZER, end_id: int = END_ID, doc_id: str = "doc_id", text: str = "text", arrays: bool = False) -> DataFrame:
    """doc_id, part, begin (in the part), n_tokens, ids, in the order of the rows.

    The ids are an array of int with ``arrays``; else the bytes of all of them, and ``width`` says how many an id has.
    """

    def run(batches):
        coder, part, begin = encoder(tokenizer), TaskContext.get().partitionId(), 0
        width = coder.dtype.itemsize
        for batch in batches:
            for piece in chunks(batch, "text", CHUNK_BYTES):
                ids, at = coder.column(piece.column("text"), end_id)
                count = np.diff(at)
                made = {"doc_id": piece.column("doc_id"), "part": pa.array(np.full(len(count), part, np.int32)), "begin": pa.array(begin + at[:-1]), "n_tokens": pa.array(count)}
                if arrays:
                    made["ids"] = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
                else:
                    made["width"] = pa.array(np.full(len(count), width, np.int32))
                    made["ids"] = pa.Array.from_buffers(pa.binary(), len(count), [None, pa.py_buffer((at * width).astype(np.int32)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(list(made.values()), names=list(made))
                begin += len(ids)

    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return docs.mapInArrow(run, "doc_id long, part int, begin long, n_tokens long, " + ("ids array<int>" if arrays else "width int, ids binary"))


def part_offsets(rows: DataFrame) -> DataFrame:
    """part, before (ids in all parts before it): one row for each partition that was written."""
    totals = rows.groupBy("part").agg(F.max(F.col("begin") + F.col("n_tokens")).alias("total"))
    before = F.sum("total").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    return totals.select("part", F.coalesce(before, F.lit(0)).alias("before"))


def with_offsets(rows: DataFrame) -> DataFrame:
    """``rows`` with the place of their first id in the whole stream; the offsets are one small row a partition."""
    return rows.join(F.broadcast(part_offsets(rows)), "part").withColumn("at", F.col("before") + F.col("begin"))


def pieces(docs: DataFrame, tokenizer: str = TOKENIZER, size: int = SIZE, end_id: int = END_ID, with_ids: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, crosses (a border), and the ids if asked for."""
    rows = stage(tokenized(docs, tokenizer, end_id, doc_id, text), "packing-ids")

    def cut(batches):
        for batch in batches:
            for piece in chunks(batch, "ids"):
                out = {n: [] for n in ("row", "start", "length", "crc", "sequence", "offset", "ids")}
                at, count = piece.column("at").to_pylist(), piece.column("n_tokens").to_pylist()
                for i, (raw, width) in enumerate(zip(piece.column("ids"), piece.column("width").to_pylist(), strict=True)):
                    ids, start = np.frombuffer(raw.as_py(), f"<u{width}").astype("<u4"), 0
                    while start < count[i]:
                        place = at[i] + start
                        n = min(count[i] - start, size - place % size)
                        own = ids[start : start + n].tobytes()
                        for name, value in (("row", i), ("start", start), ("length", n), ("crc", zlib.crc32(own)), ("sequence", place // size), ("offset", place % size), ("ids", own if with_ids else None)):
                            out[name].append(value)
                        start += n
                row = np.array(out["row"], np.int64)
                tokens = np.array(count, np.int64)[row]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column("doc_id").take(pa.array(row)),
                        *(pa.array(out[n], pa.int64()) for n in ("start", "length", "crc")),
                        pa.array(tokens),
                        *(pa.array(out[n], pa.int64()) for n in ("sequence", "offset")),
                        pa.array(tokens != np.array(out["length"], np.int64)),
                        pa.array(out["ids"], pa.binary()),
                    ],
                    names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "crosses", "ids"],
                )

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, crosses boolean, ids binary"
    made = with_offsets(rows).select("doc_id", "at", "n_tokens", "width", "ids").mapInArrow(cut, schema)
    return made if with_ids else made.drop("ids")


def sequences(docs: DataFrame, **options) -> DataFrame:
    """sequence_id, n_tokens, ids (little-endian, 32 bits each): what a trainer reads; at most ``size`` ids in a group."""
    parts = pieces(docs, with_ids=True, **options).groupBy("sequence_id")
    parts = parts.agg(F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
    joined = F.aggregate("parts", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"]))
    return parts.select("sequence_id", "n_tokens", joined.alias("ids"))
