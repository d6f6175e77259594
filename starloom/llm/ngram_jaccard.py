"""Similarity join of documents by the Jaccard index of their word n-grams, with Bayesian pruning of candidates.

1. Each text becomes the set of its five-word shingles and a MinHash signature (``fingerprints.py`` has the same
   permutations).  Documents with one set form a node of a number of its own, whatever their doc_ids are.
2. Representatives that share one of 32 bands of 4 values are candidates (a pair of similarity 0.8 shares none with
   probability 5e-8).  Inside a bucket the low bytes of the signatures are compared 16 values at a time; a pair is
   dropped as soon as the posterior probability that its similarity reaches the threshold is below ``TOLERANCE``.
   Only the edges that connect the rest leave a task, not the pairs.
3. Within each connected component of what is left, the shingles themselves are intersected, told apart by their words:
   links are counted exactly, and edges of verified links give the classes.

Buckets and components of any size are dealt with in pairs of blocks of bounded size, so a hot group is spread over
tasks.  Defined cases: null texts and texts without words link to nothing, not even to each other; a text of one to
four words is one shingle; rows that repeat count as documents of their own, and so do different texts of one doc_id;
rows without doc_id have no class and no links; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.components import components
from starloom.llm.fingerprints import BAND_ROWS, PERMUTATIONS, SHINGLE_WORDS, THRESHOLD, band_keys
from starloom.llm.kernels import exact_shingles, minhash, shingle_rows, text_bytes
from starloom.llm.runtime import map_runs, map_texts, maybe_among, stage

TOLERANCE = 1e-8
#: Signature values that are compared before a pair is judged again.
STEP = 16
#: Members of a block in the candidate and in the exact step.
SIGNATURE_BLOCK = 512
SET_BLOCK = 192


@cache
def needed_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE, n: int = PERMUTATIONS, step: int = STEP) -> dict[int, int]:
    """For so many compared values, the least number of equal ones that keeps a pair.

    The prior of the similarity is uniform; two bytes are also equal by chance in one of 256 cases.
    """
    grid = (np.arange(20_000) + 0.5) / 20_000
    equal = np.log(grid + (1 - grid) / 256), np.log1p(-(grid + (1 - grid) / 256))
    out = {}
    for seen in range(step, n + 1, step):
        for m in range(seen + 1):
            weight = m * equal[0] + (seen - m) * equal[1]
            weight = np.exp(weight - weight.max())
            if weight[grid >= threshold].sum() >= tolerance * weight.sum():
                out[seen] = m
                break
    return out


def survivors(one: np.ndarray, others: np.ndarray, needed: dict[int, int]) -> np.ndarray:
    """Indexes of the signatures that stay candidates of ``one`` to the end."""
    index, matches, done = np.arange(len(others)), np.zeros(len(others), np.int32), 0
    for seen, least in needed.items():
        matches = matches + (others[index, done:seen] == one[done:seen]).sum(axis=1)
        keep = matches >= least
        index, matches, done = index[keep], matches[keep], seen
        if not len(index):
            break
    return index


def candidate_forest(signs: np.ndarray, needed: dict[int, int]) -> list[tuple[int, int]]:
    """Edges that connect what any surviving pair connects; pairs that are connected already are not compared."""
    n = len(signs)
    group, covered, edges = np.arange(n), np.zeros(n, bool), []

    def join(i: int, found: np.ndarray) -> None:
        for j in found:
            if group[i] != group[j]:
                edges.append((i, int(j)))
                group[group == group[j]] = group[i]

    for i in range(n):
        if not covered[i]:
            found = survivors(signs[i], signs, needed)
            join(i, found)
            covered[found] = True
            covered[i] = True
    sizes = np.bincount(group, minlength=n)
    if (sizes > 0).sum() > 1:
        largest = sizes.argmax()
        for i in np.flatnonzero(group != largest):
            rest = np.flatnonzero(group != group[i])
            join(int(i), rest[survivors(signs[i], signs[rest], needed)])
    return edges


def connected(ids: np.ndarray, edges: list[tuple[int, int]]) -> np.ndarray:
    """The smallest id that edges connect each id to; all buckets of a group then name the same few ids."""
    root = ids.copy()
    for i, j in edges:
        a, b = root[i], root[j]
        root[(root == a) | (root == b)] = min(a, b)
    return root


def exact_links(sets: list[np.ndarray], threshold: float, columns: int = 8192) -> np.ndarray:
    """Matrix of the pairs whose Jaccard index is at least ``threshold``."""
    sizes = np.array([len(s) for s in sets])
    if len(sets) == 2:
        common = np.array([[sizes[0], 0], [0, sizes[1]]], float)
        common[0, 1] = common[1, 0] = len(np.intersect1d(*sets, assume_unique=True))
    else:
        who = np.repeat(np.arange(len(sets)), sizes)
        values, where, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        number = np.cumsum(count > 1) - 1
        shared = (count > 1)[where]
        who, where = who[shared], number[where[shared]]
        order = np.argsort(where, kind="stable")
        who, where = who[order], where[order]
        common = np.zeros((len(sets), len(sets)), np.float64)
        for a in range(0, int((count > 1).sum()), columns):
            i, j = np.searchsorted(where, [a, a + columns])
            has = np.zeros((len(sets), columns), np.float32)
            has[who[i:j], where[i:j] - a] = 1
            common += has @ has.T
        common[np.arange(len(sets)), np.arange(len(sets))] = sizes
    return common >= threshold * (sizes[:, None] + sizes[None, :] - common) - 1e-9


def _block_pairs(size: Column, block: int, key: Column, own: bool) -> Column:
    """The (low, high) block pairs that a member of a group of ``size`` goes to; with ``own``, also its block alone."""
    count = F.ceil(size / block).cast("int")
    mine = F.pmod(F.xxhash64(key), count).cast("int")
    pairs = F.transform(F.sequence(F.lit(0), count - 1), lambda j: F.struct(F.least(mine, j).alias("low"), F.greatest(mine, j).alias("high")))
    return pairs if own else F.when(count == 1, pairs).otherwise(F.filter(pairs, lambda p: p.low < p.high))


def _set_keys(values: np.ndarray, first: np.ndarray) -> tuple[list[np.ndarray], list[bytes]]:
    """The shingle set of each row, and a key of it."""
    sets = [np.unique(values[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    return sets, [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]


def _rows(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text, text_key (tells the texts of one doc_id apart)."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), text_key(F.col(text)).alias("text_key"))


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def classes(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text_key, group (of those that links connect; null: in none), class_id, n_links of each row."""
    needed = needed_matches(threshold, tolerance)
    docs = _rows(docs, doc_id, text)

    def make():
        def signed(part):
            values, first = shingle_rows(part.column("text"), SHINGLE_WORDS)
            sets, keys = _set_keys(values, first)
            flat = minhash(values, first, PERMUTATIONS).tobytes()
            width = 4 * PERMUTATIONS
            return {
                "doc_id": part.column("doc_id"),
                "text_key": part.column("text_key"),
                "n": pa.array([len(s) for s in sets], pa.int32()),
                "set_key": keys,
                "signature": [flat[i : i + width] for i in range(0, len(flat), width)],
            }

        return signed

    rows = stage(map_texts(docs, make, "doc_id long, text_key binary, n int, set_key binary, signature binary"), "jaccard-rows")
    heads = rows.filter("n > 0 and doc_id is not null").groupBy("set_key")
    heads = heads.agg(F.min("doc_id").alias("low"), F.count("*").alias("copies"), F.first("signature").alias("signature"))
    heads = stage(heads.select(F.monotonically_increasing_id().alias("head"), "*"), "jaccard-heads")

    near = components(_candidate_edges(heads.select("head", "signature"), needed))
    checked = _checked(docs, heads.select("head", "set_key", "low", "copies"), near, threshold)
    links = checked.groupBy("head").agg(F.sum("links").alias("links"))
    groups = components(checked.filter("head <> root").select("head", "root"), "head", "root")

    known = heads.select("set_key", "head", "low", "copies").join(links, "head", "left")
    known = known.join(groups.withColumnsRenamed({"node": "head", "component": "group"}), "head", "left").withColumn("group", F.coalesce("group", "head"))
    lowest = known.groupBy("group").agg(F.min("low").alias("class_id"))
    known = known.join(lowest, "group").select(F.col("set_key").alias("k"), "group", "class_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"))
    joined = rows.drop("signature").join(known, (rows.set_key == F.col("k")) & F.col("doc_id").isNotNull(), "left")
    return joined.select("doc_id", "text_key", "group", F.coalesce("class_id", "doc_id").alias("class_id"), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"))


def jaccard_links(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, class_id (smallest doc_id of all that links connect), n_links (documents at or above the threshold)."""
    return classes(docs, threshold, tolerance, doc_id, text).select("doc_id", "class_id", "n_links")


def _candidate_edges(heads: DataFrame, needed: dict[int, int]) -> DataFrame:
    """Edges that connect all pairs of representatives which survive the pruning, from the buckets of all bands."""
    bands = PERMUTATIONS // BAND_ROWS

    def keyed(batches):
        for batch in batches:
            sign = text_bytes(batch.column("signature"))[0].view(np.uint32).reshape(-1, PERMUTATIONS)
            # the band is part of the key
            keys = band_keys(sign) ^ (np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))[None, :]
            ids = batch.column("head").to_numpy()
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(ids, bands))], names=["bucket", "head"])

    keys = stage(heads.mapInArrow(keyed, "bucket long, head long"), "jaccard-buckets")
    sizes = keys.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    pairs = F.explode(_block_pairs(F.col("size"), SIGNATURE_BLOCK, F.col("head"), own=False)).alias("p")
    members = keys.join(sizes, "bucket").join(heads, "head").select("bucket", "head", "signature", pairs)
    members = members.select("bucket", "p.low", "p.high", "head", "signature")

    def connect(_, group):
        signs = text_bytes(group.column("signature"))[0].view(np.uint32).reshape(-1, PERMUTATIONS).astype(np.uint8)
        ids = group.column("head").to_numpy()
        root = connected(ids, candidate_forest(signs, needed))
        if (away := root != ids).any():
            return {"a": pa.array(root[away]), "b": pa.array(ids[away])}
        return None

    return stage(map_runs(members, ("bucket", "low", "high"), connect, "a long, b long").distinct(), "jaccard-edges")


def _checked(docs: DataFrame, heads: DataFrame, near: DataFrame, threshold: float) -> DataFrame:
    """head, links, root: links counted in one pair of blocks, and the smallest head that they lead to there."""
    sizes = near.groupBy("component").agg(F.count("*").alias("size"))
    members = near.join(sizes, "component").join(heads, F.col("node") == F.col("head")).drop("node")

    def make():
        return lambda part: {"doc_id": part.column("doc_id"), "text": part.column("text"), "set_key": _set_keys(*shingle_rows(part.column("text"), SHINGLE_WORDS))[1]}

    # the texts of the smallest doc_ids; where one has several, its keys say which of them is meant
    ids = stage(members.select(F.col("low").alias("doc_id")).distinct(), "jaccard-wanted")
    wanted = maybe_among(docs.select("doc_id", "text"), "doc_id", ids).filter("_maybe").join(ids, "doc_id", "left_semi").drop("_maybe")
    texts = map_texts(wanted, make, "doc_id long, text string, set_key binary").withColumnsRenamed({"doc_id": "low", "set_key": "k"})
    texts = texts.join(members.withColumnRenamed("low", "l"), (F.col("k") == F.col("set_key")) & (F.col("low") == F.col("l"))).dropDuplicates(["head"])
    pairs = F.explode(_block_pairs(F.col("size"), SET_BLOCK, F.col("head"), own=True)).alias("p")
    count = F.ceil(F.col("size") / SET_BLOCK).cast("int")
    dealt = texts.select("component", "head", "copies", "text", F.pmod(F.xxhash64("head"), count).cast("int").alias("block"), pairs)
    dealt = dealt.select("component", "p.low", "p.high", "block", "head", "copies", "text")

    def check(key, group):
        values, first = exact_shingles(group.column("text"), SHINGLE_WORDS)
        sets = [np.unique(values[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
        heads, copies, block = (group.column(c).to_numpy() for c in ("head", "copies", "block"))
        linked = exact_links(sets, threshold) if len(sets) > 1 else np.zeros((1, 1), bool)
        if key[1] != key[2]:
            linked &= block[:, None] != block[None, :]
        np.fill_diagonal(linked, False)
        root = heads.copy()
        while True:  # smallest head over links, until it stays
            lower = np.minimum(root, np.where(linked, root[None, :], root[:, None]).min(axis=1))
            if (lower == root).all():
                break
            root = lower
        return {"head": pa.array(heads), "links": pa.array((linked * copies[None, :]).sum(axis=1)), "root": pa.array(root)}

    return stage(map_runs(dealt, ("component", "low", "high"), check, "head long, links long, root long"), "jaccard-links")


def one_of_each(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without those that links connect to a smaller doc_id; rows that repeat stay once.

    Of several texts of one doc_id, one of each class stays.  Rows without doc_id, and texts without words, stay.
    """
    found = stage(classes(docs, threshold).filter("group is not null"), "jaccard-classes")
    texts = found.groupBy("group", "doc_id", "text_key").agg(F.count("*").alias("_rows"))
    best = texts.groupBy("group").agg(F.min(F.struct("doc_id", "text_key")).alias("_best"))
    same = F.struct("doc_id", "text_key") == F.col("_best")
    # only what goes, and what stays once of several rows, meets the documents
    marked = texts.join(best, "group").filter(~same | (F.col("_rows") > 1)).select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), same.alias("_stays"))
    marked = stage(marked, "jaccard-marked")
    on = lambda d: (F.col("_doc") == d["_id"]) & (text_key(F.col("text")) == d["_key"])
    rows = maybe_among(docs.withColumn("_doc", F.col("doc_id").cast("long")), "_doc", marked.select("_id"))
    kept = rows.filter("not _maybe").select(docs.columns).union(rows.filter("_maybe").join(marked, on(marked), "left_anti").select(docs.columns))
    again = marked.filter("_stays")
    if again.isEmpty():
        return kept
    once = rows.filter("_maybe").join(again, on(again)).dropDuplicates(["_id", "_key"]).select(docs.columns)
    return kept.union(once)
