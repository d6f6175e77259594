"""Spelling variants: words at one edit of each other, found in a trie of letter-group counts.

Letters are dealt to ``GROUPS`` groups of about equal frequency; a word's vector says how many letters of each group it
has.  One edit changes a vector by at most one surplus and one deficit.

1. Words of the corpus are counted, with column expressions and a map-side sum.
2. The trie over the vectors is cut into shards by its first levels, so many that no shard has more than ``SHARD`` words
   (as long as vectors differ).  A word lives in one shard and visits the later ones that its budget reaches.
3. Inside a shard the trie is walked depth first with all visitors at once: at each node those go on whose surplus and
   deficit still suffice.  Small subtrees are compared directly.
4. The words at the leaves are verified, letter by letter.  A word leaves with the number of its neighbours there and
   the best of them; the shards' answers are combined by word.

Letters are A-Z (lower-cased), a-z and U+00C0 to U+00FF: one byte each in Latin-1.

Defined cases: null and empty texts have no words; in rows without doc_id no letter is deleted; rows that repeat count
again; extra columns are ignored; words of any length are compared whole; an empty table has no words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.runtime import map_runs, stage

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
RUN = "([a-zÀ-ÿ]+)"
LEAST_CHARS = 5
LEAST_TIMES = 3
#: A run loses a letter if this divides its checksum.
THIN = 97
GROUPS = 12
#: Levels of the trie that shards are cut at, at least; words of a shard, at most.
LEAST_HEAD = 3
SHARD = 8000
#: Words of a subtree that are compared directly.
LEAF = 16
#: Pairs that are verified at once.
VERIFIED = 1 << 16


def corpus_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """word, n: the corpus's words of five letters or more that occur three times or more."""
    run = F.explode(F.regexp_extract_all(F.translate(F.col(text), UPPER, UPPER.lower()), F.lit(RUN), F.lit(1)))
    runs = docs.select(F.col(doc_id).cast("long").cast("string").alias("id"), run.alias("run")).filter(F.length("run") >= LEAST_CHARS)
    h = F.crc32(F.concat("id", F.lit(":"), "run"))
    at = (F.col("h") % F.length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % THIN == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.filter(F.length("word") >= LEAST_CHARS).groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_TIMES)


def letter_groups(words: DataFrame, groups: int = GROUPS) -> np.ndarray:
    """Group of each Latin-1 byte, so that groups are about equally frequent."""
    counts = words.select(F.explode(F.split("word", "")).alias("letter")).filter("letter <> ''").groupBy("letter").agg(F.count("*").alias("n")).collect()  # one row a letter
    table, load = np.zeros(256, np.int64), np.zeros(groups)
    for r in sorted(counts, key=lambda r: (-r.n, r.letter)):
        table[ord(r.letter)] = load.argmin()
        load[load.argmin()] += r.n
    return table


def vectors(words: list[str], table: np.ndarray, groups: int) -> np.ndarray:
    """Letters of each group in each word; beyond 32767 they count as so many, which only brings words nearer."""
    body = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return np.minimum(np.bincount(row * groups + table[body], minlength=len(words) * groups).reshape(len(words), groups), 32767).astype(np.int16)


def reach(head: np.ndarray) -> list[np.ndarray]:
    """Heads that differ by at most one surplus and one deficit."""
    n = len(head)
    steps = [(0, 0)] + [(i, 0) for i in range(1, n + 1)] + [(0, j) for j in range(1, n + 1)] + [(i, j) for i in range(1, n + 1) for j in range(1, n + 1) if i != j]
    out = np.repeat(head[None, :], len(steps), axis=0)
    for k, (i, j) in enumerate(steps):
        if i:
            out[k, i - 1] += 1
        if j:
            out[k, j - 1] -= 1
    return out[(out >= 0).all(axis=1)]


def _key(heads: np.ndarray) -> list[bytes]:
    """Heads as bytes that sort as they do."""
    raw, width = heads.astype(">i2").tobytes(), 2 * heads.shape[1]
    return [raw[i : i + width] for i in range(0, len(raw), width)]


def walk(inside: np.ndarray, visitors: np.ndarray, surplus: np.ndarray, deficit: np.ndarray, leaf: int = LEAF):
    """(visitor, word) indexes that the budgets allow; ``inside`` is sorted.  The trie's nodes are ranges of it."""
    levels = inside.shape[1]
    open_ = [(0, 0, len(inside), np.arange(len(visitors)), surplus, deficit)]
    while open_:
        level, low, high, who, plus, minus = open_.pop()
        if not len(who):
            continue
        if level == levels or high - low <= leaf:
            over, under = np.zeros((len(who), high - low), np.int16), np.zeros((len(who), high - low), np.int16)
            for k in range(level, levels):
                gap = visitors[who, k][:, None] - inside[low:high, k][None, :]
                over += np.maximum(gap, 0)
                under += np.maximum(-gap, 0)
                np.minimum(over, 2, out=over)
                np.minimum(under, 2, out=under)
            i, j = np.nonzero((over <= plus[:, None]) & (under <= minus[:, None]))
            if len(i):
                yield who[i], j + low
            continue
        column = inside[low:high, level]
        cuts = [low, *(np.flatnonzero(column[1:] != column[:-1]) + 1 + low).tolist(), high]
        own = visitors[who, level]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            gap = own - inside[a, level]
            more, less = gap == 1, gap == -1
            go = (gap == 0) | (more & (plus > 0)) | (less & (minus > 0))
            if go.any():
                open_.append((level + 1, a, b, who[go], (plus - more)[go], (minus - less)[go]))


class Letters:
    """Words as rows of bytes, for edits to be checked many at a time."""

    def __init__(self, words: list[str], widest: int = 64):
        self.words = words
        self.sizes = np.array([len(w) for w in words], np.int64)
        self.widest = widest
        width = int(min(self.sizes.max(initial=1), widest)) + 1
        self.rows = np.zeros((len(words), width), np.uint8)
        short = np.flatnonzero(self.sizes <= widest)
        body = np.frombuffer("".join([words[i] for i in short.tolist()]).encode("latin-1"), np.uint8)
        own = self.sizes[short]
        at = np.arange(len(body)) - np.repeat(np.cumsum(own) - own, own)
        self.rows[np.repeat(short, own), at] = body

    def one_edit(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Which pairs differ by exactly one inserted, deleted or replaced letter."""
        gap = self.sizes[i] - self.sizes[j]
        i, j = np.where(gap > 0, j, i), np.where(gap > 0, i, j)  # i is not the longer one
        ok = np.abs(gap) <= 1
        long_ = ok & (self.sizes[j] > self.widest)
        for k in np.flatnonzero(long_):
            ok[k] = _one_edit(self.words[i[k]], self.words[j[k]])
        same = np.flatnonzero(ok & (gap == 0) & ~long_)
        ok[same] = (self.rows[i[same]] != self.rows[j[same]]).sum(axis=1) == 1
        longer = np.flatnonzero(ok & (gap != 0) & ~long_)
        a, b = self.rows[i[longer]], self.rows[j[longer]]
        # after the first difference the longer word must go on one letter later
        differ = a != b
        at = np.arange(a.shape[1])
        first = np.where(differ.any(axis=1), differ.argmax(axis=1), a.shape[1])
        later = (a[:, :-1] != b[:, 1:]) & (at[:-1] >= first[:, None]) & (at[:-1] < self.sizes[i[longer]][:, None])
        ok[longer] = ~later.any(axis=1)
        return ok


def _one_edit(a: str, b: str) -> bool:
    n = min(len(a), len(b))
    k = next((x for x in range(n) if a[x] != b[x]), n)
    return a != b and (a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :])


def neighbours(words: DataFrame, groups: int = GROUPS, shard: int = SHARD, leaf: int = LEAF) -> DataFrame:
    """word, n_near, best (struct of minus its n, and word): words with a neighbour at one edit, of a table (word, n)."""
    table = letter_groups(words, groups)

    def measure(batches):
        for batch in batches:
            own = vectors(batch.column("word").to_pylist(), table, groups)
            yield pa.RecordBatch.from_arrays([pa.array(_key(own), pa.binary())], names=["vector"])

    # how many words each head has, for each length of heads
    counted = words.select("word").mapInArrow(measure, "vector binary").groupBy("vector").agg(F.count("*").alias("n"))
    heads = counted.select(F.explode(F.sequence(F.lit(min(LEAST_HEAD, groups)), F.lit(groups))).alias("level"), "vector", "n")
    heads = heads.groupBy("level", F.expr("substring(vector, 1, 2 * level)").alias("head")).agg(F.sum("n").alias("n"))
    largest = {r.level: r.n for r in heads.groupBy("level").agg(F.max("n").alias("n")).collect()}  # one row a level
    level = next((k for k in sorted(largest) if largest[k] <= shard), groups)

    def deal(batches):
        near: dict[bytes, list[bytes]] = {}
        for batch in batches:
            own = vectors(batch.column("word").to_pylist(), table, groups)[:, :level]
            at, shards = [], []
            for i, key in enumerate(_key(own)):
                if key not in near:
                    if len(near) > 100_000:
                        near.clear()
                    near[key] = [x for x in _key(reach(own[i])) if x >= key]
                shards += near[key]
                at += [i] * len(near[key])
            rows = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(shards, pa.binary()), *rows.columns], names=["shard", "word", "n"])

    def meet(key, group):
        texts, n = group.column("word").to_pylist(), group.column("n").to_numpy()
        own = vectors(texts, table, groups)
        head = np.frombuffer(key[0], ">i2").astype(np.int16)
        gap = own[:, :level] - head
        home = ~gap.any(axis=1)
        if not home.any():
            return None
        residents = np.flatnonzero(home)
        residents = residents[np.lexsort(own[residents].T[::-1])]
        surplus, deficit = 1 - np.maximum(gap, 0).sum(axis=1), 1 - np.maximum(-gap, 0).sum(axis=1)
        letters = Letters(texts)
        order = sorted(range(len(texts)), key=lambda i: (-n[i], texts[i]))
        rank = np.empty(len(texts), np.int64)
        rank[order] = np.arange(len(texts))
        near, best = np.zeros(len(texts), np.int64), np.full(len(texts), len(texts))

        def verify(pairs):
            i, j = np.concatenate([p for p, _ in pairs]), residents[np.concatenate([q for _, q in pairs])]
            once = ~home[i] | (i < j)  # two residents find each other twice
            i, j = i[once], j[once]
            for k in range(0, len(i), VERIFIED):
                p, q = i[k : k + VERIFIED], j[k : k + VERIFIED]
                ok = letters.one_edit(p, q)
                p, q = p[ok], q[ok]
                for one, other in ((p, q), (q, p)):
                    near[:] += np.bincount(one, minlength=len(near))
                    np.minimum.at(best, one, rank[other])

        held, size = [], 0
        for found in walk(own[residents][:, level:], own[:, level:], surplus, deficit, leaf):
            held.append(found)
            size += len(found[0])
            if size >= VERIFIED:
                verify(held)
                held, size = [], 0
        if held:
            verify(held)
        hit = np.flatnonzero(near)
        top = np.array(order)[best[hit]]
        return {"word": [texts[i] for i in hit], "near": pa.array(near[hit]), "best_n": pa.array(n[top]), "best": [texts[i] for i in top]} if len(hit) else None

    dealt = words.mapInArrow(deal, "shard binary, word string, n long")
    found = map_runs(dealt, ("shard",), meet, "word string, near long, best_n long, best string")
    return found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("minus"), "best")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root of a table (word, form) without circles: each round follows the way twice as far."""
    way = stage(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        step = way.select(F.col("word").alias("root"), F.col("root").alias("further"))
        way = stage(way.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "variant-roots")
        if way.filter("moved").isEmpty():
            return way.select("word", "root")
        way = way.select("word", "root")


def spelling_variants(words: DataFrame, times: int = 2, **options) -> DataFrame:
    """word, form, root, n, n_near, form_n of a table of distinct words (word, n)."""
    words = stage(words.select("word", F.col("n").cast("long").alias("n")), "variant-words")
    near = words.join(neighbours(words, **options), "word", "left")
    good = -F.col("best.minus") >= times * F.col("n")
    made = stage(
        near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("best.best")).alias("form"), F.when(good, -F.col("best.minus")).alias("form_n")),
        "variant-forms",
    )
    last = roots(made.filter("form is not null"))
    return made.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
