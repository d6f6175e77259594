"""Toxicity of whole texts: a convolutional classifier over hashed word embeddings, trained in numpy inside tasks.

A word (run of letters and digits, ASCII letters in lower case) is the mean of the embeddings of its hash and of the
hashes of its first four, five and six bytes, so that inflected forms are known by their stems.  Filters over one,
two and three words give their largest value over the whole text (ReLU); a logistic layer follows.  Embeddings start
with the log odds of each bucket in one coordinate, the rest is trained with Adagrad on the positions that won.

The decision threshold is calibrated for each language on training rows that the fit has not seen, and moved to 0.5.
At scoring, the language is guessed from the words of the text; the columns lang, source and labels are not read.

The fit takes every labelled row outside the held-out fold, whole texts.  They are dealt into shards of about
``SHARD_BYTES`` by hash of the doc_id; the shuffle that brings them to their labels deals them, each shard is written to one
file, and everything after it reads these files, so a text is shuffled once.  In each of ``ROUNDS`` rounds a shard trains on its rows from the common model, and
the changes are averaged over the shards that made them, block by block; one row in five is left to the thresholds, which
are read from counts by log odds in steps of 1 / ``STEPS``.  Only the model and such counts, of fixed size for each
language, reach the driver.  All sums are taken in the order of the shards, so a repeated run gives the same scores.

Defined cases: null and empty texts have no words and get the score of the bias; repeated rows stay; null labels, null
doc_ids and held-out rows are not learned from; without any training rows (or with one class) every score is the share
of toxic training rows, or 0; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import copy
from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.kernels import U64, Spans, text_bytes, word_spans
from starloom.llm.runtime import chunks, crc_mod, map_runs, map_texts, maybe_among, runs, stage

#: Bytes of text that train together in one task, all of them being shared out.
SHARD_BYTES = 16 << 20
#: Rows of the table of embeddings that are summed together.
BLOCK = 1 << 10
#: Steps of the log odds that the thresholds are chosen from, for each unit, and the largest one.
STEPS = 256
LARGEST = 64 * STEPS
BUCKETS = 1 << 18
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
STEMS = (4, 5, 6)
ROUNDS = 2
EPOCHS = 2
BATCH = 32
FOLDS = 5

_GAP = np.ones(256, bool)
_GAP[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word (its hash and its stems), and the first word of each row."""
    body, offsets = text_bytes(column)
    body = _LOWER[body]
    starts, ends, first = word_spans(body, offsets, _GAP)
    spans = Spans(body)
    made = [spans.of(starts, ends)] + [spans.of(starts, np.minimum(starts + k, ends)) * U64(2 * k + 1) for k in STEMS]
    return np.stack([(h >> U64(40)).astype(np.int64) % BUCKETS for h in made], axis=1).astype(np.int32), first


def _all_features(column: pa.Array, rows: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """features() of many rows, some at a time: what it needs for each byte is not held for all of them."""
    made = [features(column.slice(i, rows)) for i in range(0, len(column), rows)]
    counts = np.concatenate([np.diff(f) for _, f in made])
    return np.concatenate([b for b, _ in made]), np.concatenate([[0], np.cumsum(counts)]).astype(np.int64)


@dataclass
class Model:
    embedding: np.ndarray
    filters: dict[int, np.ndarray]
    weights: np.ndarray
    bias: float
    languages: list[str] = field(default_factory=list)
    profile: np.ndarray | None = None
    #: decision threshold (log odds) of each language, and where the language is unknown
    thresholds: np.ndarray | None = None
    threshold: float = 0.0

    def vectors(self, buckets: np.ndarray) -> np.ndarray:
        return sum(self.embedding[buckets[:, k]] for k in range(buckets.shape[1])) / buckets.shape[1]

    def pooled(self, x: np.ndarray, first: np.ndarray, winners: bool = False):
        """Largest value of each filter in each row (0 at least), and where it was."""
        rows = len(first) - 1
        out, where = np.zeros((rows, FILTERS * len(WIDTHS)), np.float32), np.full((rows, FILTERS * len(WIDTHS)), -1, np.int64)
        for w, kernel in self.filters.items():
            column = slice((w - 1) * FILTERS, w * FILTERS)
            if len(x) < w:
                continue
            n = len(x) - w + 1
            value = x[:n] @ kernel[0]
            for j in range(1, w):
                value += x[j : j + n] @ kernel[j]
            count = np.maximum(np.diff(first) - w + 1, 0)
            full = np.flatnonzero(count)
            if not len(full):
                continue
            # windows that cross into the next row must not win
            for back in range(1, w):
                crossing = first[1:-1] - back
                value[crossing[(crossing >= 0) & (crossing < n)]] = -np.inf
            out[full, column] = np.maximum(np.maximum.reduceat(value, first[:-1][full], axis=0), 0)
            for r in full if winners else ():
                best = value[first[r] : first[r] + count[r]].argmax(axis=0) + first[r]
                where[r, column] = np.where(out[r, column] > 0, best, -1)
        return out, where

    def language(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Index of the likeliest language of each row; -1 where nothing speaks for one."""
        if not self.languages:
            return np.full(len(first) - 1, -1)
        sums = np.zeros((len(buckets) + 1, len(self.languages)))
        np.cumsum(self.profile[buckets[:, 0]], axis=0, out=sums[1:])
        total = sums[first[1:]] - sums[first[:-1]]
        return np.where(np.abs(total).sum(axis=1) > 0, total.argmax(axis=1), -1)

    def logits(self, buckets: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.pooled(self.vectors(buckets), first)[0] @ self.weights + self.bias

    def scores(self, column: pa.Array) -> np.ndarray:
        buckets, first = features(column)
        spoken = self.language(buckets, first)
        least = self.threshold if self.thresholds is None else np.where(spoken < 0, self.threshold, self.thresholds[spoken])
        return 1 / (1 + np.exp(-np.clip(self.logits(buckets, first) - least, -500, 500)))


def _cut(buckets: np.ndarray, first: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.concatenate([np.arange(first[r], first[r + 1]) for r in rows]) if len(rows) else np.zeros(0, np.int64)
    return buckets[at], np.concatenate([[0], np.cumsum(np.diff(first)[rows])]).astype(np.int64)


def blank(share: float, seed: int = 1) -> Model:
    """The model before training; ``share`` of the rows are toxic, and no class is learned if that is all or none."""
    random = np.random.default_rng(seed)
    width = FILTERS * len(WIDTHS)
    model = Model(
        random.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32),
        {w: random.normal(0, 0.5 / w, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS},
        random.normal(0, 0.1, width).astype(np.float32),
        0.0,
    )
    model.bias = float(np.log((share + 1e-6) / (1 - share + 1e-6)))
    if share in (0.0, 1.0):
        model.weights[:] = 0
    return model


def count(
    buckets: np.ndarray, first: np.ndarray, toxic: np.ndarray, held: np.ndarray, languages: list[str | None], names: list[str], seen: np.ndarray | None = None
) -> np.ndarray:
    """Of each bucket: the clean and the toxic documents to train on, and its words in each language; added to ``seen``."""
    seen = np.zeros((BUCKETS, 2 + len(names)), np.float32) if seen is None else seen
    place = {name: 2 + k for k, name in enumerate(names)}
    for r, name in enumerate(languages):
        own = buckets[first[r] : first[r + 1]]
        if not held[r]:
            seen[np.unique(own), int(toxic[r])] += 1
        if name:
            np.add.at(seen[:, place[name]], own[:, 0], 1)
    return seen


def inform(model: Model, seen: np.ndarray, clean: int, toxic: int, names: list[str]) -> dict:
    """Log odds of each bucket, by documents, and word profiles of the languages; returns the state of Adagrad."""
    odds = np.log((seen[:, 1] + 0.5) / (toxic + 1)) - np.log((seen[:, 0] + 0.5) / (clean + 1))
    model.embedding[:, 0] = np.clip(odds, -4, 4) / 4 * (seen[:, :2].sum(axis=1) > 2)
    for kernel in model.filters.values():
        kernel[:, 0, : FILTERS // 2] = np.abs(kernel[:, 0, : FILTERS // 2]) + 0.5
    _languages(model, seen[:, 2:], names)
    squares = {w: np.full(k.shape, 0.1, np.float32) for w, k in model.filters.items()}
    return squares | {"embedding": np.full(model.embedding.shape, 0.1, np.float32), "weights": np.full(len(model.weights), 0.1, np.float32), "bias": 0.1}


def train(model: Model, squares: dict, buckets: np.ndarray, first: np.ndarray, toxic: np.ndarray, share: float, random: np.random.Generator, epochs: int = EPOCHS) -> None:
    rate = 0.1
    for _ in range(epochs):
        for rows in np.array_split(random.permutation(len(toxic)), max(1, len(toxic) // BATCH)):
            if not len(rows):
                continue
            own, at = _cut(buckets, first, rows)
            x = model.vectors(own)
            pooled, where = model.pooled(x, at, winners=True)
            error = 1 / (1 + np.exp(-np.clip(pooled @ model.weights + model.bias, -30, 30))) - toxic[rows]
            error *= np.where(toxic[rows] > 0, 0.5 / share, 0.5 / (1 - share)) / len(rows)
            back = error[:, None] * model.weights[None, :]
            grad = error @ pooled
            squares["weights"] += grad**2
            model.weights -= (rate * grad / np.sqrt(squares["weights"])).astype(np.float32)
            squares["bias"] += float(error.sum()) ** 2
            model.bias -= rate * float(error.sum()) / squares["bias"] ** 0.5
            for w, kernel in model.filters.items():
                row, column = np.nonzero(where[:, (w - 1) * FILTERS : w * FILTERS] >= 0)
                place, slope = where[row, (w - 1) * FILTERS + column], back[row, (w - 1) * FILTERS + column].astype(np.float32)
                for j in range(w):
                    by_kernel = np.zeros_like(kernel[j])
                    np.add.at(by_kernel.T, column, slope[:, None] * x[place + j])
                    by_word = (slope[:, None] * kernel[j].T[column]).astype(np.float32) / own.shape[1]
                    for k in range(own.shape[1]):
                        touched, index = np.unique(own[place + j, k], return_inverse=True)
                        total = np.zeros((len(touched), DIMENSIONS), np.float32)
                        np.add.at(total, index, by_word)
                        squares["embedding"][touched] += total**2
                        model.embedding[touched] -= rate * total / np.sqrt(squares["embedding"][touched])
                    squares[w][j] += by_kernel**2
                    kernel[j] -= rate * by_kernel / np.sqrt(squares[w][j])


def fit(texts: pa.Array, toxic: np.ndarray, languages: list[str | None], seed: int = 1) -> Model:
    """The fit of one shard in memory: train on whole texts; one row in five sets the thresholds."""
    share = float(toxic.mean()) if len(toxic) else 0.0
    model = blank(share, seed)
    if share in (0.0, 1.0):
        return model
    random = np.random.default_rng(seed)
    buckets, first = _all_features(texts)
    held = random.permutation(len(toxic)) % 5 == 0
    names = sorted({x for x in languages if x})
    squares = inform(model, count(buckets, first, toxic, held, languages, names), int((1 - toxic[~held]).sum()), int(toxic[~held].sum()), names)
    own, at = _cut(buckets, first, np.flatnonzero(~held))
    train(model, squares, own, at, toxic[~held], share, random, ROUNDS * EPOCHS)
    own, at = _cut(buckets, first, np.flatnonzero(held))
    _calibrate(model, model.logits(own, at), model.language(own, at), toxic[held], np.ones(held.sum()))
    return model


def _calibrate(model: Model, logits: np.ndarray, spoken: np.ndarray, toxic: np.ndarray, rows: np.ndarray) -> None:
    model.threshold = threshold(logits, toxic, rows=rows)
    own = [spoken == k for k in range(len(model.languages))]
    model.thresholds = np.array([threshold(logits[k], toxic[k], model.threshold, rows=rows[k]) for k in own])


def _languages(model: Model, counts: np.ndarray, names: list[str]) -> None:
    """Word profile of each language, from the training rows that have one."""
    model.languages = names
    if not names:
        return
    profile = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * BUCKETS))
    model.profile = ((profile - profile.mean(axis=1, keepdims=True)) * (counts.sum(axis=1, keepdims=True) > 0)).astype(np.float32)


def threshold(logits: np.ndarray, toxic: np.ndarray, otherwise: float = 0.0, least: int = 10, rows: np.ndarray | None = None) -> float:
    """Middle of the range of log odds that gives the best F1; ``otherwise`` where a class has too few rows.

    Each value can stand for several ``rows``, ``toxic`` of them being toxic.
    """
    rows = np.ones(len(logits)) if rows is None else rows
    if toxic.sum() < least or (rows - toxic).sum() < least:
        return otherwise
    order = np.argsort(-logits, kind="stable")
    value, hit = logits[order], np.cumsum(toxic[order])
    f1 = 2 * hit / (np.cumsum(rows[order]) + toxic.sum())
    f1[:-1][value[:-1] == value[1:]] = -1  # ties are not parted
    k = int(f1.argmax())
    return float(value[k] - 1 if k + 1 == len(value) else (value[k] + value[k + 1]) / 2)


def _labelled(texts: pa.Table, known: pa.Table) -> pa.Table:
    """The texts of a shard that have a label, with it, in an order that does not depend on how they came."""
    known = known.group_by("doc_id").aggregate([("toxic", "max")])
    place = pc.index_in(texts["doc_id"], known["doc_id"])
    toxic = pc.not_equal(known["toxic_max"].take(place), 0).cast(pa.int32())
    texts = texts.append_column("toxic", toxic).filter(place.is_valid())
    return texts.select(["doc_id", "text", "lang", "toxic", "shard"]).sort_by([(c, "ascending") for c in ("doc_id", "text", "lang")])


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, text, lang, toxic (0 or 1), shard of all labelled rows outside the held-out fold; a shard in one partition."""
    known = labels.filter("toxic is not null and doc_id is not null").filter(crc_mod("doc_id", FOLDS) != 0)
    known = known.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("double").alias("toxic"))
    # only texts that may have a label are shuffled
    own = maybe_among(docs.select("doc_id", "text", "lang"), "doc_id", known.select("doc_id")).filter("_maybe").drop("_maybe")
    size = own.agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 64)).first()[0] or 0
    shards = 1 + size // SHARD_BYTES
    dealt = [df.withColumn("shard", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(shards))).repartition(shards, "shard").groupBy("shard") for df in (own, known)]
    return dealt[0].cogroup(dealt[1]).applyInArrow(_labelled, "doc_id long, text string, lang string, toxic int, shard long")


_PARTS = "block int, shard long, part binary, width int"


def _blocks(made: np.ndarray, shard: int) -> dict:
    made = made.astype(np.float32)
    blocks = [made[i : i + BLOCK] for i in range(0, len(made), BLOCK)]
    kept = [i for i, b in enumerate(blocks) if b.any()]
    return {
        "block": pa.array(kept, pa.int32()),
        "shard": pa.array([shard] * len(kept), pa.int64()),
        "part": pa.array([blocks[i].tobytes() for i in kept], pa.binary()),
        "width": pa.array([made.shape[1]] * len(kept), pa.int32()),
    }


def _of_shards(rows: DataFrame, f: Callable[[int, np.ndarray, np.ndarray, pa.Table], np.ndarray]) -> DataFrame:
    """Blocks of ``f(shard, buckets, first, table)``, an array of numbers; ``rows`` come from files that hold shards whole."""

    def run(batches):
        # a file that is too large for one task comes in pieces, each trains as a shard
        for (shard,), part in runs(batches, ("shard",)):
            yield pa.RecordBatch.from_pydict(_blocks(f(int(shard), *_all_features(part.column("text").combine_chunks()), part), int(shard)))

    return rows.mapInArrow(run, _PARTS)


def _counts(rows: DataFrame, names: list[str]) -> DataFrame:
    """Blocks of ``count`` over the rows of each task; whole numbers, so their order is of no account."""

    def run(batches):
        total = None
        for batch in batches:
            for part in chunks(batch, "text"):
                marks = [part.column(c).to_numpy(zero_copy_only=False) for c in ("toxic", "held")]
                total = count(*features(part.column("text")), *marks, part.column("lang").to_pylist(), names, total)
        if total is not None:
            yield pa.RecordBatch.from_pydict(_blocks(total, 0))

    return rows.select("text", "lang", "toxic", "held").mapInArrow(run, _PARTS)


def _summed(made: DataFrame) -> np.ndarray:
    """The sum of arrays that come in blocks, added up in tasks in the order of the shards."""

    def add(key, part):
        part = part.sort_by([("shard", "ascending"), ("part", "ascending")])
        total = sum(np.frombuffer(x.as_py(), np.float32).astype(np.float64) for x in part.column("part"))
        return {"block": pa.array([int(key[0])], pa.int32()), "part": pa.array([total.tobytes()], pa.binary()), "width": part.column("width").combine_chunks()[:1]}

    summed = map_runs(made, ("block",), add, "block int, part binary, width int").toArrow().to_pylist()
    width = summed[0]["width"] if summed else 1
    out = np.zeros(((1 + max((r["block"] for r in summed), default=0)) * BLOCK, width))
    for r in summed:
        values = np.frombuffer(r["part"], np.float64).reshape(-1, width)
        out[r["block"] * BLOCK : r["block"] * BLOCK + len(values)] = values
    return out


def _dense(state: dict, weights: np.ndarray, bias: float) -> np.ndarray:
    return np.concatenate([*[state[w].ravel() for w in WIDTHS], weights, [bias]])


def _train_shard(model: Model, squares: dict, share: float, shard: int, turn: int, buckets, first, part: pa.Table) -> np.ndarray:
    """What training on a shard adds to the embeddings and their squares, which rows it touched; then the other parameters and a one."""
    before, old = copy.deepcopy(model), copy.deepcopy(squares)
    toxic = part.column("toxic").to_numpy().astype(np.float64)
    own, at = _cut(buckets, first, np.flatnonzero(~part.column("held").to_numpy()))
    train(model, squares, own, at, toxic[~part.column("held").to_numpy()], share, np.random.default_rng([turn, shard]))
    more = squares["embedding"] - old["embedding"]
    table = np.concatenate([model.embedding - before.embedding, more, more.any(axis=1, keepdims=True)], axis=1)
    moved = _dense(model.filters, model.weights, model.bias) - _dense(before.filters, before.weights, before.bias)
    grown = _dense(squares, squares["weights"], squares["bias"]) - _dense(old, old["weights"], old["bias"])
    rows = -(-len(moved) // table.shape[1])
    rest = np.zeros((2 * rows + 1, table.shape[1]))
    for i, values in enumerate((moved, grown)):
        rest[i * rows :].ravel()[: len(values)] = values
    rest[-1, 0] = 1
    return np.concatenate([table, rest])


def _move(model: Model, squares: dict, total: np.ndarray) -> None:
    """Apply the sums of ``_train_shard``: the mean over the shards that touched a bucket, of the others over all."""
    touched = np.maximum(total[:BUCKETS, 2 * DIMENSIONS :][:, :1], 1)
    model.embedding += (total[:BUCKETS, :DIMENSIONS] / touched).astype(np.float32)
    squares["embedding"] += (total[:BUCKETS, DIMENSIONS : 2 * DIMENSIONS] / touched).astype(np.float32)
    size = len(_dense(model.filters, model.weights, model.bias))
    rows = -(-size // total.shape[1])
    shards = max(1, total[BUCKETS + 2 * rows, 0])
    for state, weights, at in ((model.filters, model.weights, BUCKETS), (squares, squares["weights"], BUCKETS + rows)):
        change, i = (total[at : at + rows].ravel()[:size] / shards).astype(np.float32), 0
        for target in (*[state[w] for w in WIDTHS], weights):
            target += change[i : i + target.size].reshape(target.shape)
            i += target.size
        if state is squares:
            squares["bias"] += float(change[i])
        else:
            model.bias += float(change[i])


def fit_rows(rows: DataFrame) -> Model:
    """Train on all of ``rows`` (see ``training_rows``), which are written to the shared folder."""
    held = F.pmod(F.xxhash64("doc_id", F.lit(2)), F.lit(5)) == 0
    rows = stage(rows.withColumn("held", held), "toxic-training")
    n, toxic, own, own_toxic = rows.agg(F.count("*"), F.sum("toxic"), F.count_if(~F.col("held")), F.sum(F.when(~F.col("held"), F.col("toxic")))).first()
    share = toxic / n if n else 0.0
    model = blank(share)
    if share in (0.0, 1.0):
        return model
    context = rows.sparkSession.sparkContext
    names = sorted(r[0] for r in rows.select("lang").distinct().collect() if r[0])
    learning = rows.filter("not held")

    seen = np.zeros((BUCKETS, 2 + len(names)))
    total = _summed(_counts(rows, names))
    if total.shape[1] == seen.shape[1]:
        seen[: len(total)] = total[:BUCKETS]
    squares = inform(model, seen, own - (own_toxic or 0), own_toxic or 0, names)
    for turn in range(ROUNDS if own else 0):
        sent = context.broadcast((model, squares))  # BUCKETS fixes its size

        def trained(shard, buckets, first, part, sent=sent, turn=turn):
            return _train_shard(*copy.deepcopy(sent.value), share, shard, turn, buckets, first, part)

        total = _summed(_of_shards(learning, trained))
        size = BUCKETS + 2 * BLOCK
        _move(model, squares, np.pad(total, ((0, max(0, size - len(total))), (0, max(0, 2 * DIMENSIONS + 1 - total.shape[1])))))
        sent.unpersist()
    sent = context.broadcast(model)

    def make():
        def judge(part):
            buckets, first = features(part.column("text"))
            step = np.clip(np.rint(sent.value.logits(buckets, first) * STEPS), -LARGEST, LARGEST).astype(np.int64)
            return {"step": step, "spoken": sent.value.language(buckets, first).astype(np.int64), "toxic": part.column("toxic")}

        return judge

    judged = map_texts(rows.filter("held").select("text", "toxic"), make, "step long, spoken long, toxic int")
    # at most 2 * LARGEST + 1 rows for each language
    steps = judged.groupBy("spoken", "step").agg(F.sum("toxic").alias("toxic"), F.count("*").alias("n")).orderBy("spoken", "step").toArrow()
    column = {c: steps.column(c).to_numpy().astype(np.float64) for c in steps.column_names}
    _calibrate(model, column["step"] / STEPS, column["spoken"], column["toxic"], column["n"])
    return model


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit_rows(training_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang"), labels))
    sent = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS fixes its size

    def make():
        return lambda part: {"doc_id": part.column("doc_id"), "score": pa.array(sent.value.scores(part.column("text")), pa.float64())}

    scored = map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, "doc_id long, score double")
    held = F.coalesce(crc_mod("doc_id", FOLDS) == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
