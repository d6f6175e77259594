"""Prefix tries of conversations as burst tries: which conversations begin alike, and what sharing that would save.

A conversation is its turns (role, text) in order; each distinct sequence of first turns is a node.  A turn's id is
half of a SHA-256 of role and text, a conversation's sequence the ids one after another, so that sequences sort as
their turns do and a prefix of turns is a prefix of bytes.

1. Conversations with one and the same sequence become one, with a count, the smallest conv_id and a digest of all
   their conv_ids.  The ids of a hot sequence are sorted by all tasks and streamed through one digest as packed text.
2. A container holds the sequences (suffixes) under one head, a path from the root.  At first the root's holds all.
   Each round finds the oversized ones, and how far all their sequences agree; the container bursts there, and its
   sequences are dealt to new containers by the next turn id.  A round costs one small aggregate and one pass over
   the sequences that are still in oversized containers.
3. The remaining containers are bounded.  Each is sorted and swept once with a stack: neighbours' common prefixes give
   the nodes.
4. The nodes of burst heads are put together from the containers below, last round first.

Defined cases: null role or text is empty; null turns come first, equal turns follow the order of their ids; rows
without conv_id are left out; rows that repeat are turns of their own; extra columns are ignored; an empty table has no
nodes; a conversation without turns is a member of the root alone.  A sequence is one value of 16 bytes a turn.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.runtime import map_runs, stage

#: Distinct sequences, and bytes of them, that a container may hold.
CONTAINER = 2048
CONTAINER_BYTES = 8 << 20
ID_BYTES = 16
#: conv_ids of a packed row.
PACKED = 8192
NO_ENDS = hashlib.sha256().hexdigest()
NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def turn_lists(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turns (array of (id, size)) in order; texts do not leave the scan, only their digests and lengths."""
    role_, text_ = (F.coalesce(F.col(c), F.lit("")) for c in (role, text))
    digest = F.unhex(F.substring(F.sha2(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_), 256), 1, 2 * ID_BYTES))
    rows = conversations.filter(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"), F.struct(F.col(turn).alias("turn"), digest.alias("id"), F.length(text_).cast("int").alias("size")).alias("t")
    )
    lists = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return lists.select("conv_id", F.transform("t", lambda t: F.struct(t["id"].alias("id"), t["size"].alias("size"))).alias("turns"))


def shared_openings(lists: DataFrame, every: int = 100, most: int = 6) -> DataFrame:
    """Each conversation with its first turns replaced by those of the one its hundred begins with.

    How many turns: crc32 of the decimal conv_id modulo ``most``.  A first conversation serves at most ``2 * every`` others.
    """
    lists = stage(lists, "trie-lists")
    h = F.pmod(F.crc32(F.col("conv_id").cast("string")), F.lit(most)).cast("int")
    base = F.col("conv_id") - F.col("conv_id") % every
    first = lists.filter(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("opening"))
    joined = lists.withColumn("h", h).withColumn("base", base).join(first, "base", "left")
    own = F.slice("turns", F.col("h") + 1, F.size("turns"))
    opening = F.coalesce(F.slice("opening", F.lit(1), F.col("h")), F.slice("turns", 1, 0))
    return joined.select("conv_id", F.concat(opening, own).alias("turns"))


def _sequences(lists: DataFrame) -> DataFrame:
    """seq, sizes, n, low (smallest conv_id), ends (digest of all conv_ids): one row for each distinct sequence."""
    seq = F.aggregate("turns", F.lit(b"").cast("binary"), lambda a, t: F.concat(a, t["id"]))
    rows = lists.select("conv_id", F.coalesce(seq, F.lit(b"").cast("binary")).alias("seq"), F.transform("turns", lambda t: t["size"]).alias("sizes"))
    rows = rows.withColumn("key", F.unhex(F.sha2("seq", 256)))
    # ranges of (key, conv_id): a sequence that many conversations have is spread over tasks
    ordered = rows.repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")

    def pack(batches):
        held = None  # key, seq, sizes, ids

        def row():
            ids = held[3]
            return [held[0], held[1], held[2], ids[0], len(ids), ",".join(map(str, ids))]

        def batch_of(out):
            names = ["key", "seq", "sizes", "first", "n", "ids"]
            types = [pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=names)

        for batch in batches:
            out = []
            for key, seq, sizes, conv in zip(*(batch.column(c).to_pylist() for c in ("key", "seq", "sizes", "conv_id")), strict=True):
                if held is None or held[0] != key or len(held[3]) >= PACKED:
                    if held is not None:
                        out.append(row())
                    held = [key, seq, sizes, []]
                held[3].append(conv)
            if out:
                yield batch_of(out)
        if held is not None:
            yield batch_of([row()])

    def digest(batches):
        held = None  # key, seq, sizes, n, low, sha

        def batch_of(out):
            types = [pa.binary(), pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate(types)], names=["seq", "sizes", "n", "low", "ends"])

        def row():
            return [*held[1:5], held[5].hexdigest()]

        for batch in batches:
            out = []
            for key, seq, sizes, first, n, ids in zip(*(batch.column(c).to_pylist() for c in ("key", "seq", "sizes", "first", "n", "ids")), strict=True):
                if held is not None and held[0] == key:
                    held[3] += n
                    held[5].update(b"," + ids.encode())
                    continue
                if held is not None:
                    out.append(row())
                held = [key, seq, sizes, n, first, hashlib.sha256(ids.encode())]
            if out:
                yield batch_of(out)
        if held is not None:
            yield batch_of([row()])

    packed = ordered.mapInArrow(pack, "key binary, seq binary, sizes array<int>, first long, n long, ids string")
    packed = packed.repartition("key").sortWithinPartitions("key", "first")
    return stage(packed.mapInArrow(digest, "seq binary, sizes array<int>, n long, low long, ends string"), "trie-sequences")


def _path(depth: Column) -> Column:
    """The first ``depth`` turns of a sequence, as a key of fixed size."""
    return F.unhex(F.substring(F.sha2(F.substring(F.col("seq"), F.lit(1), (depth * ID_BYTES).cast("int")), 256), 1, 2 * ID_BYTES))


def _common() -> Column:
    """How many turns the smallest and the largest sequence of a container have in common, and so all that it holds."""
    most = (F.least(F.length("least"), F.length("greatest")) / ID_BYTES).cast("int")
    at = lambda c, k: F.substring(F.col(c), k * ID_BYTES + 1, F.lit(ID_BYTES))
    differ = F.filter(F.sequence(F.lit(0), most), lambda k: (k >= most) | (at("least", k) != at("greatest", k)))
    return differ[0]


def _sweep(_, group: pa.Table) -> dict:
    """All nodes of one container, in one pass over its sorted sequences; ``top`` marks the highest."""
    group = group.sort_by([("seq", "ascending")])
    seqs, sizes, counts, lows, ends = (group.column(c).to_pylist() for c in ("seq", "sizes", "n", "low", "ends"))
    top, above, up = (group.column(c)[0].as_py() for c in ("depth", "parent_low", "up"))
    out: list[list] = []
    # nodes of the path that is open: [depth, size of the last text, members, smallest, children, leaves, saved, ends, rows of the children]
    path: list[list] = []

    def close() -> None:
        depth, size, n, low, children, leaves, saved, digest, below = path.pop()
        leaves, saved = leaves if children else 1, saved + (n - 1) * size
        for r in below:
            out[r][2] = low
        if path:
            over = path[-1]
            over[2:7] = over[2] + n, min(over[3], low), over[4] + 1, over[5] + leaves, over[6] + saved
            over[8].append(len(out))
        out.append([low, depth, above, n, children, leaves, saved, digest])

    last = None
    for seq, size, n, low, digest in zip(seqs, sizes, counts, lows, ends, strict=True):
        shared = top - 1 if last is None else _shared(last, seq)
        while path and path[-1][0] > shared:
            close()
        # sequences are distinct and sorted, so the last of these is where this one ends
        path.extend([d, size[d - 1] if d else 0, 0, low, 0, 0, 0, NO_ENDS, []] for d in range(shared + 1, len(seq) // ID_BYTES + 1))
        own = path[-1]
        own[2:4], own[7] = (own[2] + n, min(own[3], low)), digest
        last = seq
    while path:
        close()
    names = [c.split()[0] for c in NODE.split(", ")]
    made = {c: pa.array([r[k] for r in out], pa.string() if c == "ends_sha256" else pa.int64()) for k, c in enumerate(names)}
    return made | {"up": pa.array([up] * len(out), pa.binary()), "top": pa.array([r[1] == top for r in out])}


def _shared(one: bytes, other: bytes) -> int:
    """Turns that two sequences begin with alike."""
    n = min(len(one), len(other))
    differ = np.flatnonzero(np.frombuffer(one, np.uint8, n) != np.frombuffer(other, np.uint8, n))
    return (int(differ[0]) if len(differ) else n) // ID_BYTES


def trie_nodes(lists: DataFrame, container: int = CONTAINER, container_bytes: int = CONTAINER_BYTES) -> DataFrame:
    """One row for each node of the trie over (conv_id, turns): see ``NODE``."""
    # head: the container's path; depth: turns of it; up: the head that burst above; parent_low: smallest conv_id there
    root = F.unhex(F.substring(F.sha2(F.lit(b"").cast("binary"), 256), 1, 2 * ID_BYTES))
    rows = _sequences(lists).select("*", root.alias("head"), F.lit(0).alias("depth"), F.lit(None).cast("binary").alias("up"), F.lit(None).cast("long").alias("parent_low"))
    settled, bursts = [], []
    while True:
        sizes = rows.groupBy("head").agg(
            F.count("*").alias("held"), F.sum(F.length("seq") + 40).alias("bytes"), F.sum("n").alias("n_convs"), F.min("low").alias("head_low"),
            F.min("seq").alias("least"), F.max("seq").alias("greatest"), F.first("depth").alias("top"), F.first("up").alias("above"), F.first("parent_low").alias("above_low"),
        ).filter((F.col("held") > container) | ((F.col("held") > 1) & (F.col("bytes") > container_bytes)))
        over = stage(sizes.select("head", "top", "above", "above_low", "n_convs", "head_low", F.col("least").alias("seq"), _common().alias("until")), f"trie-burst-{len(bursts)}")
        over = over.withColumn("chain", _path(F.col("until")))
        if over.isEmpty():
            settled.append(rows)
            break
        marks = over.select("head", "until", F.col("head_low").alias("new_low"), "chain")
        met = stage(rows.join(marks, "head", "left"), f"trie-rows-{len(bursts)}")
        settled.append(met.filter("until is null").select(rows.columns))
        ended = met.filter(F.length("seq") == F.col("until") * ID_BYTES).select("head", "ends")
        sample = met.filter("until is not null").groupBy("head").agg(F.first("sizes").alias("sizes"))
        bursts.append(stage(over.drop("seq").join(sample, "head").join(ended, "head", "left"), f"trie-heads-{len(bursts)}"))
        # what is left is dealt by one more turn
        deeper = met.filter(F.length("seq") > F.col("until") * ID_BYTES)
        rows = deeper.select("seq", "sizes", "n", "low", "ends", _path(F.col("until") + 1).alias("head"), (F.col("until") + 1).alias("depth"), F.col("chain").alias("up"), F.col("new_low").alias("parent_low"))

    held = settled[0]
    for part in settled[1:]:
        held = held.unionByName(part)
    nodes = stage(map_runs(held, ("head",), _sweep, f"{NODE}, up binary, top boolean"), "trie-nodes")
    columns = [c.split()[0] for c in NODE.split(", ")]
    result = nodes.select(columns)
    # tops of containers, and then of bursts, count at the burst above them
    tops = nodes.filter("top and up is not null").select("up", "n_leaves", "saved_tokens")
    for over in reversed(bursts):
        below = tops.groupBy("up").agg(F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("below"))
        whole = stage(over.join(below.withColumnRenamed("up", "chain"), "chain"), "trie-chain")
        step = F.col("n_convs") - 1
        cost = lambda d: F.when(d > 0, F.element_at("sizes", F.greatest(d, F.lit(1))).cast("long")).otherwise(F.lit(0).cast("long"))
        # a chain of nodes with the same members, from the head's own turn to the one at which it burst
        saved = lambda d: F.col("below") + step * F.aggregate(F.sequence(d, F.col("until")), F.lit(0).cast("long"), lambda a, k: a + cost(k))
        chain = whole.withColumn("d", F.explode(F.sequence("top", "until")))
        d = F.col("d")
        chain = chain.select(
            F.col("head_low").alias("conv_id"), d.cast("long").alias("depth"), F.when(d > F.col("top"), F.col("head_low")).otherwise(F.col("above_low")).alias("parent_conv_id"),
            "n_convs", F.when(d < F.col("until"), F.lit(1).cast("long")).otherwise(F.col("n_children")).alias("n_children"), "n_leaves",
            saved(d).alias("saved_tokens"), F.when(d < F.col("until"), F.lit(NO_ENDS)).otherwise(F.coalesce("ends", F.lit(NO_ENDS))).alias("ends_sha256"),
        )
        result = result.unionByName(chain)
        tops = tops.unionByName(whole.filter("above is not null").select(F.col("above").alias("up"), "n_leaves", saved(F.col("top")).alias("saved_tokens")))
    return result


def prefix_trie(conversations: DataFrame, **options) -> DataFrame:
    """The trie of conversations as they are."""
    return trie_nodes(turn_lists(conversations), **options)
