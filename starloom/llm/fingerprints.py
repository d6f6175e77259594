"""MinHash fingerprints of documents: signatures in numpy, near copies by signature bands joined in Spark.

A text is the set of its five-word shingles (words are runs of bytes other than ASCII white space; a text of one to
four words is one shingle, a text without words has none).  Each of ``PERMUTATIONS`` universal hash permutations
keeps the smallest value over the set; the fingerprint is the low byte of each, in hex.

Defined cases: null text counts as empty; texts without words share one fingerprint (all bits set), are alike to
each other (1.0) and to nothing else; equal texts have equal fingerprints; repeated rows stay, one result each; extra
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.kernels import minhash, mix, shingle_rows
from starloom.llm.runtime import chunks, map_texts, stage

PERMUTATIONS = 128
SHINGLE_WORDS = 5
THRESHOLD = 0.8
#: 32 bands of 4 values: a pair of similarity 0.8 shares none with probability 5e-8.
BAND_ROWS = 4


def signatures(column: pa.Array) -> np.ndarray:
    return minhash(*shingle_rows(column, SHINGLE_WORDS), PERMUTATIONS)


def hex_rows(signature: np.ndarray) -> list[str]:
    low = signature.astype(np.uint8).tobytes()
    return [low[i : i + PERMUTATIONS].hex() for i in range(0, len(low), PERMUTATIONS)]


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Share of equal bytes in two fingerprints, less what bytes share by chance."""
    same = (a.astype(np.uint8) == b.astype(np.uint8)).mean(axis=1)
    return np.maximum(0.0, (same - 1 / 256) / (1 - 1 / 256))


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, fingerprint of each row."""

    def make():
        return lambda part: {"doc_id": part.column(0), "fingerprint": hex_rows(signatures(part.column(1)))}

    return map_texts(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), make, "doc_id long, fingerprint string")


def near_pairs(docs: DataFrame, threshold: float = THRESHOLD, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(pairs, members): pairs of classes with verified Jaccard similarity, and the class of each document.

    A class holds the documents with one and the same shingle set; its id is their smallest doc_id.  Classes that
    share a band are candidates; their shingle sets are intersected exactly.  Texts without words are in no pair.
    """
    spark = docs.sparkSession

    def make():
        def part_rows(part):
            values, first = shingle_rows(part.column(1), SHINGLE_WORDS)
            sign = minhash(values, first, PERMUTATIONS)
            sets = [np.unique(values[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
            return {
                "doc_id": part.column(0),
                "set_key": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets],
                "shingles": pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                "bands": pa.array([s.view(np.int64) for s in band_keys(sign)], pa.list_(pa.int64())),
            }

        return part_rows

    rows = stage(
        map_texts(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), make, "doc_id long, set_key binary, shingles array<bigint>, bands array<bigint>"),
        "fingerprint-sets",
    )
    classes = rows.filter(F.size("shingles") > 0).groupBy("set_key").agg(F.min("doc_id").alias("class_id"))
    members = rows.join(classes, "set_key", "left").select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"))
    heads = rows.join(classes, (rows.set_key == classes.set_key) & (rows.doc_id == classes.class_id)).select("class_id", "shingles", "bands").dropDuplicates(["class_id"])
    keys = stage(heads.select("class_id", F.posexplode("bands").alias("band", "key")), "fingerprint-bands")
    pairs = (
        keys.alias("a").join(keys.alias("b"), ["band", "key"]).filter("a.class_id < b.class_id").select(F.col("a.class_id").alias("a_id"), F.col("b.class_id").alias("b_id")).distinct()
    )
    left = heads.select(F.col("class_id").alias("a_id"), F.col("shingles").alias("a_set"))
    right = heads.select(F.col("class_id").alias("b_id"), F.col("shingles").alias("b_set"))
    common = F.size(F.array_intersect("a_set", "b_set"))
    scored = pairs.join(left, "a_id").join(right, "b_id").select("a_id", "b_id", (common / (F.size("a_set") + F.size("b_set") - common)).alias("jaccard"))
    return scored.filter(F.col("jaccard") >= threshold), stage(members, "fingerprint-members")


def band_keys(signature: np.ndarray) -> np.ndarray:
    """A 64-bit key for each band of each row."""
    bands = signature.reshape(len(signature), -1, BAND_ROWS).astype(np.uint64)
    key = np.zeros(bands.shape[:2], np.uint64)
    for j in range(BAND_ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, j] + np.uint64(1))
    return key


_RESULT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of the text whose last third is replaced by the start of the next document.

    Next means descending doc_id (equal ids: by text), the first one after the last.  One range partitioning puts
    neighbours together; each partition streams through its rows in order, and only its first and last rows meet
    those of other partitions, in a second and small step.
    """
    ordered = (
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        .repartitionByRange(F.desc("doc_id"))
        .sortWithinPartitions(F.desc("doc_id"), "text")
    )
    # the text of a row is kept only where it meets another partition
    rows = stage(ordered.mapInArrow(_stream, f"part int, edge string, edge_text string, {_RESULT}"), "fingerprint-edges")
    inner = rows.filter("edge = ''").select(*[c.split()[0] for c in _RESULT.split(", ")])
    # two rows for each partition: this window is as long as there are partitions
    edges = rows.filter("edge <> ''").select("part", "edge", "doc_id", F.col("edge_text").alias("text"))
    heads = edges.filter("edge = 'head'")
    in_order = W.orderBy("part")
    nexts = heads.select(F.lag("part").over(in_order).alias("part"), F.col("doc_id").alias("next_id"), F.col("text").alias("next_text"))
    last = edges.agg(F.max("part").alias("part"))
    nexts = nexts.withColumn("part", F.coalesce("part", F.lit(-1)))
    tails = edges.filter("edge = 'tail'").join(F.broadcast(last.withColumn("is_last", F.lit(True))), "part", "left")
    tails = tails.withColumn("part", F.when(F.col("is_last"), F.lit(-1)).otherwise(F.col("part")))
    met = tails.join(nexts, "part").select("doc_id", "text", "next_text")
    return inner.unionByName(met.mapInArrow(_meet, _RESULT))


def _edited(text: str, following: str) -> str:
    take = len(text) // 3
    return text[: len(text) - take] + following[:take]


def _rows(ids: list, texts: list[str], nexts: list[str], own: np.ndarray, after: np.ndarray) -> dict:
    edited = [_edited(a, b) for a, b in zip(texts, nexts, strict=True)]
    changed = signatures(pa.array(edited, pa.large_string()))
    return {
        "doc_id": pa.array(ids, pa.int64()),
        "n_chars": pa.array([len(x) for x in texts], pa.int64()),
        "edited_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in edited],
        "fingerprint": hex_rows(own),
        "edited_fingerprint": hex_rows(changed),
        "near_edited": likeness(own, changed),
        "near_next": likeness(own, after),
    }


def _batch(part: list[int], edge: list[str], kept: list, columns: dict) -> pa.RecordBatch:
    names = ["part", "edge", "edge_text", *columns]
    arrays = [pa.array(part, pa.int32()), pa.array(edge, pa.string()), pa.array(kept, pa.string()), *(v if isinstance(v, pa.Array) else pa.array(v) for v in columns.values())]
    return pa.RecordBatch.from_arrays(arrays, names=names)


def _edge(part: int, name: str, doc: object, text: str) -> pa.RecordBatch:
    blank = {"doc_id": pa.array([doc], pa.int64()), "n_chars": pa.array([None], pa.int64())}
    blank |= {c: pa.array([None], pa.string()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")}
    blank |= {c: pa.array([None], pa.float64()) for c in ("near_edited", "near_next")}
    return _batch([part], [name], [text], blank)


def _stream(batches):
    """Rows of one partition in order: each meets the one after it; the first and the last are kept as edges."""
    part, held = TaskContext.get().partitionId(), None
    for batch in batches:
        for piece in chunks(batch, "text"):
            ids, texts = piece.column("doc_id").to_pylist(), piece.column("text").to_pylist()
            sign = signatures(piece.column("text"))
            if held is None:
                yield _edge(part, "head", ids[0], texts[0])
            else:
                ids, texts, sign = [held[0], *ids], [held[1], *texts], np.concatenate([held[2], sign])
            if n := len(ids) - 1:
                yield _batch([part] * n, [""] * n, [None] * n, _rows(ids[:-1], texts[:-1], texts[1:], sign[:-1], sign[1:]))
            held = ids[-1], texts[-1], sign[-1:]
    if held is not None:
        yield _edge(part, "tail", held[0], held[1])


def _meet(batches):
    for batch in batches:
        for piece in chunks(batch, "text"):
            texts, nexts = piece.column("text").to_pylist(), piece.column("next_text").to_pylist()
            made = _rows(piece.column("doc_id").to_pylist(), texts, nexts, signatures(piece.column("text")), signatures(piece.column("next_text")))
            yield pa.RecordBatch.from_arrays([v if isinstance(v, pa.Array) else pa.array(v) for v in made.values()], names=list(made))
