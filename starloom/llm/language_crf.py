"""Language of words and texts by a linear-chain conditional random field.

Words are runs of letters (bytes of ASCII letters or above ASCII; capitals of ASCII and Latin-1 in lower case).  The
weights of a word's prefixes and suffixes of one to four bytes, of its byte trigrams and of the word itself, and a
lexicon (log odds of the word among the languages in the training texts), speak for each language; learned transitions
join neighbouring words.  Forward-backward gives the probability of each language at each word, so stretches of
different languages in one text are told apart; a text's language has the largest mean.

The weights are trained in numpy on a bounded sample (``MAX_PER_LANGUAGE`` texts of each language, whole, by hash of
the doc_id), cut into stretches that are joined across languages, as code-switched text is.

Defined cases: a null text, or one without any letter, is ``und`` with score 0; so is every text if there is nothing to
learn from; held-out rows, null languages and null doc_ids are not learned from; repeated rows stay; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from starloom.llm.kernels import U64, Spans, text_bytes, word_spans
from starloom.llm.runtime import chunks, crc_mod, map_texts

#: Texts of each language that the fit looks at.
MAX_PER_LANGUAGE = 300
BUCKETS = 1 << 17
AFFIXES = (1, 2, 3, 4)
SEQUENCE, BATCH = 48, 64
#: Words of one language in a row, on average, in the training sequences.
STRETCH = 24
EPOCHS = 2
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
#: Below this, a text has no main language; mixed texts of two languages stay.
LEAST_SCORE = 0.4

_GAP = np.ones(256, bool)
_GAP[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32


def lower(body: np.ndarray) -> np.ndarray:
    """ASCII and Latin-1 capitals in lower case."""
    out = _LOWER[body]
    latin = np.zeros(len(body), bool)
    latin[1:] = (body[:-1] == 0xC3) & (body[1:] >= 0x80) & (body[1:] <= 0x9E) & (body[1:] != 0x97)
    out[latin] += 0x20
    return out


class Words:
    """Words of a text column, with the buckets of their features."""

    def __init__(self, column: pa.Array):
        body, offsets = text_bytes(column)
        body = lower(body)
        self.starts, self.ends, self.first = word_spans(body, offsets, _GAP)
        letters = np.concatenate([[0], np.cumsum((body >= 0x61) & (body <= 0x7A))])
        self.plain = letters[offsets[1:]] > letters[offsets[:-1]]  # rows with an ASCII letter
        spans = Spans(body)
        self.hashes = spans.of(self.starts, self.ends)
        made = [self.hashes]
        for k in AFFIXES:
            made.append(spans.of(self.starts, np.minimum(self.starts + k, self.ends)) * U64(4 * k + 1))
            made.append(spans.of(np.maximum(self.ends - k, self.starts), self.ends) * U64(4 * k + 3))
        self.buckets = np.stack([(h >> U64(32)).astype(np.int64) % BUCKETS for h in made], axis=1).astype(np.int32)
        at = np.arange(max(0, len(body) - 2))
        self.trigrams = ((spans.of(at, at + 3) >> U64(32)).astype(np.int64) % BUCKETS).astype(np.int32)
        self.grams = np.maximum(self.ends - self.starts - 2, 0)


@dataclass
class Crf:
    languages: list[str]
    weights: np.ndarray
    lexicon: np.ndarray
    trust: float
    transitions: np.ndarray

    def emissions(self, words: Words) -> np.ndarray:
        out = self.trust * self.lexicon[words.buckets[:, 0]]
        for k in range(words.buckets.shape[1]):
            out += self.weights[words.buckets[:, k]]
        sums = np.zeros((len(words.trigrams) + 1, len(self.languages)))
        np.cumsum(self.weights[words.trigrams], axis=0, dtype=np.float64, out=sums[1:])
        low = np.minimum(words.starts, len(words.trigrams))
        high = np.minimum(words.starts + words.grams, len(words.trigrams))
        return out + sums[high] - sums[low]

    def marginals(self, emissions: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Probability of each language at each word, by forward-backward over all rows at once."""
        step = np.exp(self.transitions - self.transitions.max())
        odds = np.exp(emissions - emissions.max(axis=1, keepdims=True)) if len(emissions) else emissions
        counts = np.diff(first)
        order = np.argsort(-counts, kind="stable")
        begin, length = first[:-1][order], counts[order]
        # rows that still have a word at each step, the longest first
        alive = np.searchsorted(-length, -np.arange(int(length[0]) if len(length) else 0), "left")
        forward, backward = np.empty_like(odds), np.empty_like(odds)
        for t, m in enumerate(alive):
            at = begin[:m] + t
            now = odds[at] if t == 0 else (state[:m] @ step) * odds[at]
            state = now / now.sum(axis=1, keepdims=True)
            forward[at] = state
        state = np.ones((len(length), odds.shape[1]))
        for t in range(len(alive) - 1, -1, -1):
            m = alive[t]
            at = begin[:m] + t
            backward[at] = state[:m]
            now = (state[:m] * odds[at]) @ step.T
            state[:m] = now / now.sum(axis=1, keepdims=True)
        both = forward * backward
        return both / both.sum(axis=1, keepdims=True) if len(both) else both

    def texts(self, column: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray, Words]:
        """Language and score of each row, and the probabilities of its words."""
        words = Words(column)
        rows = len(words.first) - 1
        if not self.languages:
            return [UNKNOWN] * rows, np.zeros(rows), np.zeros((len(words.starts), 0)), words
        chance = self.marginals(self.emissions(words), words.first)
        sums = np.zeros((len(chance) + 1, len(self.languages)))
        np.cumsum(chance, axis=0, out=sums[1:])
        counts = np.diff(words.first)
        mean = (sums[words.first[1:]] - sums[words.first[:-1]]) / np.maximum(counts, 1)[:, None]
        best, found = mean.argmax(axis=1), counts > 0
        for r in np.flatnonzero(found & ~words.plain):  # bytes above ASCII need not be letters
            found[r] = any(c.isalpha() for c in column[int(r)].as_py())
        score = np.where(found, np.clip(mean.max(axis=1), 0, 1), 0.0)
        return [self.languages[k] if ok else UNKNOWN for k, ok in zip(best, found, strict=True)], score, chance, words


def fit(column: pa.Array, languages: list[str], seed: int = 1) -> Crf:
    """Train on whole texts, each of one language, joined to code-switched sequences."""
    names = sorted(set(languages))
    crf = Crf(names, np.zeros((BUCKETS, len(names)), np.float32), np.zeros((BUCKETS, len(names)), np.float32), 1.0, np.zeros((len(names), len(names))))
    if not names:
        return crf
    random = np.random.default_rng(seed)
    words = Words(column)
    label = np.repeat(np.array([names.index(x) for x in languages], np.int64), np.diff(words.first))
    if not len(label):
        return Crf([], crf.weights, crf.lexicon, 1.0, crf.transitions)

    counts = np.zeros((BUCKETS, len(names)))
    np.add.at(counts, (words.buckets[:, 0], label), 1)
    share = np.log((counts + 0.5) / (counts.sum(axis=0) + 0.5 * BUCKETS))
    # words that one text has, and no other, tell the fit nothing about new texts
    crf.lexicon = ((share - share.mean(axis=1, keepdims=True)) * (counts.sum(axis=1, keepdims=True) > 2) / 4).astype(np.float32)

    # distinct words and the flat list of their features
    _, example, which = np.unique(words.hashes, return_index=True, return_inverse=True)
    width = words.buckets.shape[1]
    sizes = width + words.grams[example]
    ends = np.cumsum(sizes)
    flat = np.empty(int(ends[-1]), np.int32)
    for i, (w, end, size) in enumerate(zip(example.tolist(), ends.tolist(), sizes.tolist(), strict=True)):
        flat[end - size : end - size + width] = words.buckets[w]
        flat[end - size + width : end] = words.trigrams[words.starts[w] : words.starts[w] + words.grams[w]]

    sequences = _sequences(words.first, label, random)
    squares, step_squares, rate = np.full(crf.weights.shape, 0.1, np.float32), np.full(crf.transitions.shape, 1.0), 0.1
    for _ in range(EPOCHS):
        for rows in np.array_split(random.permutation(len(sequences)), max(1, len(sequences) // BATCH)):
            at = sequences[rows]
            distinct, index = np.unique(which[at], return_inverse=True)
            index = index.reshape(at.shape)
            bounds = np.concatenate([[0], np.cumsum(sizes[distinct])])
            features = flat[np.arange(bounds[-1]) - np.repeat(bounds[:-1] - (ends[distinct] - sizes[distinct]), sizes[distinct])]
            emit = np.add.reduceat(crf.weights[features], bounds[:-1], axis=0) + crf.trust * crf.lexicon[words.buckets[example[distinct], 0]]
            chance, pairs = _expectations(emit[index], crf.transitions)
            wanted = label[at]
            error = chance
            error[np.arange(len(at))[:, None], np.arange(at.shape[1])[None, :], wanted] -= 1
            by_word = np.zeros((len(distinct), len(names)))
            np.add.at(by_word, index.ravel(), error.reshape(-1, len(names)))
            touched, inverse = np.unique(features, return_inverse=True)
            grad = np.zeros((len(touched), len(names)), np.float32)
            np.add.at(grad, inverse, np.repeat(by_word, sizes[distinct], axis=0).astype(np.float32))
            squares[touched] += grad**2
            crf.weights[touched] -= rate * grad / np.sqrt(squares[touched])
            np.subtract.at(pairs, (wanted[:, :-1].ravel(), wanted[:, 1:].ravel()), 1)
            step_squares += pairs**2
            crf.transitions -= rate * pairs / np.sqrt(step_squares)
    return crf


def _sequences(first: np.ndarray, label: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Indexes of words, ``SEQUENCE`` in a row: stretches of the texts in random order, so that languages change."""
    cuts = np.flatnonzero(random.random(len(label)) < 1 / STRETCH)
    bounds = np.unique(np.concatenate([[0], cuts, first, [len(label)]]))
    parts = [np.arange(a, b) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    joined = np.concatenate([parts[i] for i in random.permutation(len(parts))])
    length = min(SEQUENCE, len(joined))
    return joined[: len(joined) // length * length].reshape(-1, length)


def _expectations(emit: np.ndarray, transitions: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities of the languages at each place of equally long sequences, and summed over neighbouring places."""
    step = np.exp(transitions - transitions.max())
    odds = np.exp(emit - emit.max(axis=2, keepdims=True))
    n, length, k = odds.shape
    forward, backward = np.empty((n, length, k)), np.ones((n, length, k))
    for t in range(length):
        now = odds[:, t] if t == 0 else (forward[:, t - 1] @ step) * odds[:, t]
        forward[:, t] = now / now.sum(axis=1, keepdims=True)
    pairs = np.zeros((k, k))
    for t in range(length - 2, -1, -1):
        ahead = backward[:, t + 1] * odds[:, t + 1]
        now = ahead @ step.T
        backward[:, t] = now / now.sum(axis=1, keepdims=True)
        joint = forward[:, t, :, None] * step[None] * ahead[:, None, :]
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    both = forward * backward
    return both / both.sum(axis=2, keepdims=True), pairs


def training_rows(docs: DataFrame, most: int = MAX_PER_LANGUAGE) -> DataFrame:
    """text, lang of rows outside the held-out fold, ``most`` of each language."""
    known = docs.filter("lang is not null and text is not null and doc_id is not null").filter(crc_mod("doc_id", FOLDS) != HELD_OUT)
    # ids first, texts for the chosen ones only
    ids = known.select("doc_id", "lang")
    ranked = ids.withColumn("rank", F.row_number().over(W.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")))
    chosen = ranked.filter(F.col("rank") <= most).select("doc_id").distinct()
    return known.select("doc_id", "text", "lang").join(F.broadcast(chosen), "doc_id").select("text", "lang")


def learn(docs: DataFrame, most: int = MAX_PER_LANGUAGE) -> Crf:
    rows = training_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang"), most).toArrow().to_pylist()
    rows.sort(key=lambda r: (r["lang"], r["text"]))
    return fit(pa.array([r["text"] for r in rows], pa.large_string()), [r["lang"] for r in rows])


def languages(docs: DataFrame, model: Crf | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(model or learn(docs))

    def make():
        def rows(part):
            names, score, _, _ = sent.value.texts(part.column("text"))
            return {"doc_id": part.column("doc_id"), "lang_pred": pa.array(names, pa.string()), "score": pa.array(score, pa.float64())}

        return rows

    told = map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, "doc_id long, lang_pred string, score double")
    return told.select("doc_id", F.coalesce(crc_mod("doc_id", FOLDS) == HELD_OUT, F.lit(False)).alias("held_out"), "lang_pred", "score")


def accepted(docs: DataFrame, model: Crf | None = None, least: float = LEAST_SCORE) -> DataFrame:
    """The rows of ``docs``, as they are, whose language is known with a score of ``least`` at least."""
    sent = docs.sparkSession.sparkContext.broadcast(model or learn(docs))

    def run(batches):
        for batch in batches:
            for part in chunks(batch, "text"):
                names, score, _, _ = sent.value.texts(part.column("text"))
                yield part.filter(pa.array([n != UNKNOWN and x >= least for n, x in zip(names, score, strict=True)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def stretches(docs: DataFrame, model: Crf) -> DataFrame:
    """doc_id, lang, first_word, n_words, score: runs of words of one language in each text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        def rows(part):
            names, _, chance, words = sent.value.texts(part.column("text"))
            out = {n: [] for n in ("row", "lang", "first_word", "n_words", "score")}
            for r, name in enumerate(names):
                a, b = words.first[r], words.first[r + 1]
                if name == UNKNOWN:
                    continue
                best = chance[a:b].argmax(axis=1)
                cuts = [0, *(np.flatnonzero(np.diff(best)) + 1).tolist(), b - a]
                for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                    for n, v in (("row", r), ("lang", sent.value.languages[best[i]]), ("first_word", i), ("n_words", j - i), ("score", float(chance[a + i : a + j, best[i]].mean()))):
                        out[n].append(v)
            ids = part.column("doc_id").take(pa.array(out["row"], pa.int64()))
            return {"doc_id": ids, "lang": pa.array(out["lang"], pa.string()), "first_word": pa.array(out["first_word"], pa.int64()), "n_words": pa.array(out["n_words"], pa.int64()), "score": pa.array(out["score"], pa.float64())}

        return rows

    return map_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), make, "doc_id long, lang string, first_word long, n_words long, score double")
