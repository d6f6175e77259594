"""Near-duplicate vectors by cosine: a pigeonhole join over subspaces, verified in double precision.

1. Vectors with the same components form a class; one of them stands for it.
2. The classes' unit vectors are rotated to their principal axes, and the axes are dealt to blocks of ``BLOCK_DIMS``
   dimensions.  A cosine of t means a squared distance of 2 - 2t; each block gets a share of it in proportion to its
   energy, so a pair that is near enough is within the share of one block at least.
3. In each block the vectors are range-partitioned by its first axis and cut into tiles.  Tiles whose ranges are
   closer than the block's radius meet, as pairs of tiles; inside, sorted slices are compared in the block's subspace.
4. Candidates are verified with their whole vectors.  A pair belongs to the block that it fits best, so that it counts
   once though several blocks find it.  Counts and the edges that connect a tile pair's vectors leave a task, not pairs.

Only the second moments (dimensions squared) reach the driver.  Results do not hang on the rotation.  What the blocks
cannot part costs time in the square of the number of distinct vectors; tile pairs spread it over tasks.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing, as do rows
without vec_id (their component is null, and they are not kept); vectors of different lengths do not link; rows that
repeat count as vectors of their own, also with one vec_id; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.components import components
from starloom.llm.runtime import runs, stage

THRESHOLD = 0.9
BLOCK_DIMS = 16
#: Vectors of a tile: so many that a table has about TILES tiles, between these bounds.
TILES, LEAST_TILE, MOST_TILE = 8, 4096, 32768
#: Vectors of a row of a tile, and of a slice that is compared at once.
ROW_VECTORS = 256
SLICE = 512
#: Rotated coordinates are rounded to this grid, so that all tasks see the same ones; SLACK covers the rounding.
GRID = float(1 << 20)
SLACK = 1e-5
#: Pairs that are verified at once.
VERIFIED = 1 << 15


class Subspaces:
    """The rotation, its blocks, and what each may spend of the squared distance."""

    def __init__(self, moments: np.ndarray, threshold: float, block_dims: int):
        energy, axes = np.linalg.eigh(moments)
        energy, axes = np.maximum(energy[::-1], 0), axes[:, ::-1]
        n = max(1, len(energy) // block_dims)
        # there and back again, so that no block gets all strong axes; each begins with its strongest
        block = np.minimum(np.arange(len(energy)) % (2 * n), 2 * n - 1 - np.arange(len(energy)) % (2 * n))
        order = np.argsort(block, kind="stable")
        self.axes = np.ascontiguousarray(axes[:, order])
        self.starts = np.searchsorted(block[order], np.arange(n))
        self.ends = np.append(self.starts[1:], len(energy))
        share = np.add.reduceat(energy[order], self.starts)
        self.threshold = threshold
        self.budget = 2 * (1 - threshold) * share / max(share.sum(), 1e-300)
        self.limit = self.budget * (1 + 1e-4) + SLACK
        self.radius = np.sqrt(self.limit) + SLACK

    def __len__(self) -> int:
        return len(self.starts)

    def rotated(self, unit: np.ndarray) -> np.ndarray:
        return (np.rint(unit @ self.axes * GRID) / GRID).astype(np.float32)

    def owner(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """The block that a pair fits best; the sums are exact, so that all tasks agree."""
        gap = np.square(np.rint((one.astype(np.float64) - other) * GRID))
        return (np.add.reduceat(gap, self.starts, axis=1) / np.maximum(self.budget, 1e-12)).argmin(axis=1)


def unit_vectors(values: np.ndarray) -> np.ndarray:
    """Rows of length one; they are scaled by powers of two first, so that squares neither overflow nor vanish."""
    values = values.astype(np.float64)
    _, exponent = np.frexp(np.abs(values).max(axis=1, initial=0))
    values = np.ldexp(values, -exponent[:, None])
    return values / np.sqrt(np.einsum("ij,ij->i", values, values))[:, None]


def _read(kind: str):
    """Rows (vec_id, key, n, vector) of an Arrow stream; the key is null where a vector links with nothing."""

    def run(batches):
        for batch in batches:
            ids, lists = batch.column("vec_id"), batch.column("embedding")
            if isinstance(lists, pa.ChunkedArray):
                lists = lists.combine_chunks()
            offsets = lists.offsets.to_numpy().astype(np.int64)
            flat = lists.values
            bad = flat.is_null().to_numpy(zero_copy_only=False)
            values = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(kind)
            bad = bad | ~np.isfinite(values)
            missing = lists.is_null().to_numpy(zero_copy_only=False) | ids.is_null().to_numpy(zero_copy_only=False)
            keys, sizes, vectors = [], [], []
            for gone, a, b in zip(missing.tolist(), offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                own = values[a:b]
                if gone or bad[a:b].any() or not own.any():
                    keys.append(None), sizes.append(None), vectors.append(None)
                else:
                    raw = own.tobytes()
                    keys.append(hashlib.blake2b(raw, digest_size=32).digest()), sizes.append(b - a), vectors.append(raw)
            yield pa.RecordBatch.from_arrays([ids, pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(vectors, pa.binary())], names=["vec_id", "key", "n", "vector"])

    return run


def _padded(column: pa.Array, kind: str, dims: int) -> np.ndarray:
    """Vectors of a binary column as rows of a matrix, shorter ones with zeros behind them."""
    raw = column.to_pylist()
    if all(len(x) == dims * np.dtype(kind).itemsize for x in raw):
        return np.frombuffer(b"".join(raw), kind).reshape(len(raw), dims)
    out = np.zeros((len(raw), dims), kind)
    for i, x in enumerate(raw):
        own = np.frombuffer(x, kind)
        out[i, : len(own)] = own
    return out


def second_moments(heads: DataFrame, kind: str, dims: int) -> np.ndarray:
    """Sum of the outer products of all unit vectors, added up in Spark."""

    def run(batches):
        total = np.zeros((dims, dims))
        for batch in batches:
            if batch.num_rows:
                unit = unit_vectors(_padded(batch.column("vector"), kind, dims))
                total += unit.T @ unit
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "sums"])

    parts = heads.select("vector").mapInArrow(run, "i int, sums array<double>").select("i", F.posexplode("sums").alias("j", "x"))
    out = np.zeros((dims, dims))
    for r in parts.groupBy("i", "j").agg(F.sum("x").alias("x")).collect():  # dims x dims
        out[r.i, r.j] = r.x
    return (out + out.T) / 2


def _tiles(heads: DataFrame, spaces: Subspaces, kind: str, dims: int, size: int, total: int) -> DataFrame:
    """Rows of tiles: every vector once in each block, in the order of the block's first axis."""
    sent = heads.sparkSession.sparkContext.broadcast(spaces)  # dims x dims
    blocks = len(spaces)

    def place(batches):
        own = sent.value
        for batch in batches:
            if not batch.num_rows:
                continue
            axis = own.rotated(unit_vectors(_padded(batch.column("vector"), kind, dims)))[:, own.starts]
            at = pa.array(np.repeat(np.arange(batch.num_rows), blocks))
            block = pa.array(np.tile(np.arange(blocks, dtype=np.int32), batch.num_rows))
            yield pa.RecordBatch.from_arrays([block, pa.array(axis.ravel().astype(np.float64)), *(batch.column(c).take(at) for c in ("node", "copies", "n", "vector"))], names=["block", "axis", "node", "copies", "n", "vector"])

    def cut(batches):
        part, tiles, last, left, seq = TaskContext.get().partitionId(), 0, None, 0, 0
        for batch in batches:
            block = batch.column("block").to_numpy()
            at = 0
            while at < batch.num_rows:
                if block[at] != last or not left:
                    last, left, tiles, seq = block[at], size, tiles + 1, 0
                end = min(at + min(ROW_VECTORS, left), int(np.searchsorted(block, last, "right")))
                own = batch.slice(at, end - at)
                axis = own.column("axis").to_numpy()
                blobs = [own.column(c).to_numpy().astype(f"<i{w}").tobytes() for c, w in (("node", 8), ("copies", 8), ("n", 4))]
                blobs.append(_padded(own.column("vector"), kind, dims).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([int(last)], pa.int32()), pa.array([(part << 32) + tiles]), pa.array([seq], pa.int32()),
                        pa.array([float(axis[0])]), pa.array([float(axis[-1])]), *(pa.array([x], pa.binary()) for x in blobs),
                    ],
                    names=["block", "tile", "seq", "low", "high", "nodes", "copies", "sizes", "vectors"],
                )
                left, seq, at = left - (end - at), seq + 1, end

    placed = heads.mapInArrow(place, "block int, axis double, node long, copies long, n int, vector binary")
    ordered = placed.repartitionByRange(max(1, -(-total * blocks // size)), "block", "axis").sortWithinPartitions("block", "axis", "node")
    return stage(ordered.mapInArrow(cut, "block int, tile long, seq int, low double, high double, nodes binary, copies binary, sizes binary, vectors binary"), "subspace-tiles")


def _tile_pairs(tiles: DataFrame, spaces: Subspaces) -> DataFrame:
    """(block, one, other): tiles whose ranges on the first axis come within the radius, each pair once."""
    radius = F.element_at(F.array(*map(F.lit, spaces.radius.tolist())), F.col("block") + 1)
    bounds = tiles.groupBy("block", "tile").agg(F.min("low").alias("low"), F.max("high").alias("high")).withColumn("radius", radius)
    cell = lambda x: F.floor(x / F.col("radius")).cast("long")
    bounds = stage(bounds.withColumn("cell", cell(F.col("low"))), "subspace-bounds")
    probes = bounds.select("block", F.col("tile").alias("one"), F.col("low").alias("from"), (F.col("high") + F.col("radius")).alias("to"), "radius")
    probes = probes.withColumn("cell", F.explode(F.sequence(cell(F.col("from")), cell(F.col("to")))))
    met = probes.join(bounds.select("block", "cell", F.col("tile").alias("other"), "low"), ["block", "cell"])
    after = (F.col("low") > F.col("from")) | ((F.col("low") == F.col("from")) & (F.col("other") >= F.col("one")))
    return stage(met.filter(after & (F.col("low") <= F.col("to"))).select("block", "one", "other"), "subspace-pairs")


class Side:
    """The vectors of one tile."""

    def __init__(self, rows: pa.Table, spaces: Subspaces, kind: str, dims: int):
        joined = {c: b"".join(rows.column(c).to_pylist()) for c in ("nodes", "copies", "sizes", "vectors")}
        self.nodes, self.copies = np.frombuffer(joined["nodes"], "<i8"), np.frombuffer(joined["copies"], "<i8")
        self.sizes = np.frombuffer(joined["sizes"], "<i4")
        self.unit = unit_vectors(np.frombuffer(joined["vectors"], kind).reshape(-1, dims))
        self.rotated = spaces.rotated(self.unit)


def linked_pairs(one: Side, other: Side, block: int, spaces: Subspaces):
    """Verified pairs of indexes whose block this is, slice by slice; within one tile (``one is other``) each pair once."""
    cols = slice(int(spaces.starts[block]), int(spaces.ends[block]))
    a, b = one.rotated[:, cols], other.rotated[:, cols]
    squares = np.einsum("ij,ij->i", b, b)
    for at in range(0, len(a), SLICE):
        own = a[at : at + SLICE]
        low = int(np.searchsorted(b[:, 0], own[0, 0] - spaces.radius[block]))
        high = int(np.searchsorted(b[:, 0], own[-1, 0] + spaces.radius[block], "right"))
        low = max(low, at + 1) if one is other else low
        if low >= high:
            continue
        gap = own @ b[low:high].T
        gap *= -2
        gap += np.einsum("ij,ij->i", own, own)[:, None]
        gap += squares[None, low:high]
        i, j = np.nonzero(gap <= np.float32(spaces.limit[block]))
        i, j = i + at, j + low
        if one is other:
            once = i < j
            i, j = i[once], j[once]
        found = []
        for k in range(0, len(i), VERIFIED):
            p, q = i[k : k + VERIFIED], j[k : k + VERIFIED]
            ok = np.einsum("ij,ij->i", one.unit[p], other.unit[q]) >= spaces.threshold
            ok &= one.sizes[p] == other.sizes[q]
            p, q = p[ok], q[ok]
            mine = spaces.owner(one.rotated[p], other.rotated[q]) == block if len(p) else np.zeros(0, bool)
            found.append((p[mine], q[mine]))
        if found:
            yield np.concatenate([p for p, _ in found]), np.concatenate([q for _, q in found])


def _lowest(labels: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Give all that pairs connect the smallest of their labels; a label is an index and has a label itself."""
    while True:
        least = np.minimum(labels[i], labels[j])
        before = labels.copy()
        for x in (i, j):
            np.minimum.at(labels, before[x], least)
            np.minimum.at(labels, x, least)
        labels[:] = labels[labels]
        if (labels == before).all():
            return


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, block_dims: int = BLOCK_DIMS, tile: int | None = None, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, n_links (other vectors with a cosine of ``threshold`` or more), component_id (smallest vec_id that links lead to), kept."""
    element = vectors.schema[embedding].dataType.elementType
    kind, sql = ("<f4", "array<float>") if isinstance(element, T.FloatType) else ("<f8", "array<double>")
    read = vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast(sql).alias("embedding"))
    rows = stage(read.mapInArrow(_read(kind), "vec_id long, key binary, n int, vector binary"), "subspace-rows")
    heads = rows.filter("key is not null").groupBy("key").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("vector").alias("vector"))
    heads = stage(heads.select(F.monotonically_increasing_id().alias("node"), "*"), "subspace-heads")
    total, dims = heads.agg(F.count("*"), F.max("n")).first()
    if not total:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept"))
    spaces = Subspaces(second_moments(heads, kind, dims), threshold, block_dims)
    size = tile or min(MOST_TILE, max(LEAST_TILE, -(-total // TILES)))
    tiles = _tiles(heads, spaces, kind, dims, size, total)
    pairs = _tile_pairs(tiles, spaces)
    ends = pairs.select("one", "other", F.explode(F.when(F.col("one") == F.col("other"), F.array("one")).otherwise(F.array("one", "other"))).alias("tile"))
    dealt = tiles.drop("low", "high").join(ends, "tile")
    sent = vectors.sparkSession.sparkContext.broadcast(spaces)

    def meet(batches):
        own = sent.value
        for _, group in runs(batches, ("one", "other")):
            group = group.sort_by([("tile", "ascending"), ("seq", "ascending")]).combine_chunks()
            tile_of, first = group.column("tile").to_numpy(), group.column("one")[0].as_py()
            one = Side(group.filter(pa.array(tile_of == first)), own, kind, dims)
            other = one if (tile_of == first).all() else Side(group.filter(pa.array(tile_of != first)), own, kind, dims)
            block, shift = group.column("block")[0].as_py(), 0 if other is one else len(one.nodes)
            nodes = one.nodes if other is one else np.concatenate([one.nodes, other.nodes])
            copies = one.copies if other is one else np.concatenate([one.copies, other.copies])
            links, labels = np.zeros(len(nodes)), np.arange(len(nodes))
            for i, j in linked_pairs(one, other, block, own):
                j = j + shift
                links += np.bincount(i, copies[j], len(nodes)) + np.bincount(j, copies[i], len(nodes))
                _lowest(labels, i, j)
            hit = np.flatnonzero(links)
            if len(hit):
                yield pa.RecordBatch.from_arrays([pa.array(nodes[hit]), pa.array(links[hit].astype(np.int64)), pa.array(nodes[labels[hit]])], names=["node", "links", "root"])

    met = dealt.repartition("one", "other").sortWithinPartitions("one", "other").mapInArrow(meet, "node long, links long, root long")
    met = stage(met, "subspace-links")
    near = components(met.filter("node <> root").select("node", "root"), "node", "root")
    known = heads.select("key", "node", "low", "copies").join(met.groupBy("node").agg(F.sum("links").alias("links")), "node", "left").join(near, "node", "left")
    known = known.withColumn("component", F.coalesce("component", "node"))
    lowest = known.groupBy("component").agg(F.min("low").alias("component_id"))
    known = known.join(lowest, "component").select(F.col("key").alias("k"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), "component_id")
    result = rows.select("vec_id", "key").join(known, rows.key == F.col("k"), "left")
    return result.select(
        "vec_id", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"),
        F.coalesce(F.col("vec_id") == F.coalesce("component_id", "vec_id"), F.lit(False)).alias("kept"),
    )
