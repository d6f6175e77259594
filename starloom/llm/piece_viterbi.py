"""SentencePiece encoding and decoding by Viterbi search over a trie of words.

A text is marked as SentencePiece does it (a space before it, each space written as U+2581) and falls into words: marks
with what follows them.  No piece reaches over the end of a word, so a text's pieces are those of its words.  The
distinct words that a task has not met yet are sorted; walking them in this order is a depth-first walk of their trie,
and the forward states of a common prefix are those of the word before.

The state at a depth is the best way to cut the prefix.  With a unigram model that is the largest sum of scores.  With
a BPE model (as ``piece_bpe_32k.model``) scores are merge ranks, and sums of them mean nothing: there an arc from one
piece to the next is open only if merging the two texts gives these two pieces again.  A cut into pieces whose
neighbours all agree is the one that the merges make, so one path stays open at each depth, and it ends in the ids of
the sentencepiece library.  Characters without a piece become bytes.

Defined cases: null and empty texts have no pieces; repeated rows stay; extra columns are ignored; decoding gives the
text back, except that U+2581 in a text comes back as a space.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import cache
from os.path import commonprefix

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starloom.llm.runtime import map_texts

MODEL = public_tokenizers.path("piece_bpe_32k.model")
MARK = "▁"
#: Words and pairs of pieces that a Python worker keeps; beyond that it starts anew.
TABLE_ENTRIES = 600_000
PAIR_ENTRIES = 500_000
#: Names of pieces lie below this, and above its negative.
_NAMES = 1 << 21
_WORD = re.compile(f"{MARK}+[^{MARK}]*")


class Pieces:
    """Pieces of a model, and the search for the best cut of words."""

    def __init__(self, path: str, unigram: bool = False):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        ids = range(model.piece_size())
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_byte(i)}
        self.unigram = unigram
        self.texts = [model.id_to_piece(i) for i in ids]
        self.scores = [model.get_score(i) for i in ids]
        self.ids = {self.texts[i]: i for i in ids if i not in special}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        # pieces, and ends of pieces (-1): looking back from a place stops where no piece can end any more
        self.ends = {x[k:]: -1 for x in self.ids for k in range(1, len(x))} | self.ids
        self.unknown = min(self.scores[i] for i in self.ids.values()) - 10
        self.surface = [x.encode() for x in self.texts]
        for i in special:
            self.surface[i] = b""
        for b, i in enumerate(self.byte_ids):
            self.surface[i] = bytes([b])
        # ids as bytes, and the names of pieces while a word is cut: their ids, or less than -1 for a character without one
        self.raw = [i.to_bytes(4, "little") for i in ids]
        self.agree: dict[int, bool] = {}
        self.table: dict[str, bytes] = {}

    def merged(self, text: str) -> list[str]:
        """The parts that merging neighbours by rank leaves of a short text."""
        parts = list(text)
        while True:
            ranked = [(self.scores[self.ids[a + b]], -i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in self.ids]
            if not ranked:
                return parts
            i = -max(ranked)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _text(self, name: int) -> str:
        return self.texts[name] if name >= 0 else "" if name == -1 else chr(-2 - name)

    def open(self, before: int, piece: int) -> bool:
        """Whether ``piece`` may follow ``before`` (-1: the start of a word); kept in ``agree``."""
        if len(self.agree) > PAIR_ENTRIES:
            self.agree.clear()
        a, b = self._text(before), self._text(piece)
        known = self.agree[(before + _NAMES) * 2 * _NAMES + piece + _NAMES] = self.merged(a + b) == ([a, b] if a else [b])
        return known

    def step(self, word: str, states: list[tuple[float, int, bytes]]) -> tuple[float, int, bytes]:
        """State after one more character: score, name of the last piece, all ids; ``states`` has those before."""
        end = len(states)
        best = None
        for start in range(end - 1, -1, -1):
            name = self.ends.get(word[start:end])
            if name is None or name < 0:
                if start < end - 1:
                    if name is None:
                        break
                    continue
                name = -2 - ord(word[start])
            score, before, ids = states[start]
            if not self.unigram:
                known = self.agree.get((before + _NAMES) * 2 * _NAMES + name + _NAMES)
                if known or (known is None and self.open(before, name)):
                    best = score, name, ids
                    break  # the merges make one cut
                continue
            score += self.unknown if name < 0 else self.scores[name]
            if best is None or score >= best[0]:
                best = score, name, ids
        score, name, ids = best
        return score, name, ids + (self.raw[name] if name >= 0 else b"".join([self.raw[self.byte_ids[b]] for b in chr(-2 - name).encode()]))

    def learn(self, words: list[str]) -> None:
        """Add sorted words to the table."""
        states, last = [(0.0, -1, b"")], ""
        for word in words:
            shared = len(commonprefix((last, word)))
            del states[shared + 1 :]
            while len(states) <= len(word):
                states.append(self.step(word, states))
            self.table[word] = states[-1][2]
            last = word

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, 32 bits each."""
        if len(self.table) > TABLE_ENTRIES:
            self.table = {}
        words = [_WORD.findall(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        self.learn(sorted(set().union(*words) - self.table.keys()))
        return [b"".join(map(self.table.__getitem__, w)) for w in words]

    def decode(self, ids: bytes) -> str:
        raw = b"".join(map(self.surface.__getitem__, np.frombuffer(ids, "<u4").tolist()))
        return raw.decode(errors="replace").replace(MARK, " ")[1:]


@cache
def pieces(path: str, unigram: bool = False) -> Pieces:
    """One for each worker and model."""
    return Pieces(path, unigram)


def encode(docs: DataFrame, model: str = MODEL, unigram: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, ids (little-endian, 32 bits each) of each text."""

    def make():
        def rows(part):
            texts = part.column("text").fill_null("").to_pylist()
            return {"doc_id": part.column("doc_id"), "n_chars": pa.array([len(t) for t in texts], pa.int64()), "ids": pa.array(pieces(model, unigram).encode(texts), pa.binary())}

        return rows

    return map_texts(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), make, "doc_id long, n_chars long, ids binary")


def decode(encoded: DataFrame, model: str = MODEL, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """doc_id, text of each list of ids."""

    def make():
        return lambda part: {"doc_id": part.column("doc_id"), "text": pa.array([pieces(model).decode(x.as_py() or b"") for x in part.column("ids")], pa.string())}

    return map_texts(encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).alias("ids")), make, "doc_id long, text string", text="ids")


def round_trip(docs: DataFrame, model: str = MODEL, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_chars, n_pieces, ids_crc32, decoded_sha256, same (the decoded text is the text) of each document."""
    # the text goes along, so that a document is encoded, decoded and compared where it is read
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))

    def make():
        def rows(part):
            of = pieces(model)
            texts = part.column("text").fill_null("").to_pylist()
            ids = of.encode(texts)
            back = [of.decode(x) for x in ids]
            return {
                "doc_id": part.column("doc_id"),
                "n_chars": pa.array([len(t) for t in texts], pa.int64()),
                "n_pieces": pa.array([len(x) // 4 for x in ids], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(x) for x in ids], pa.int64()),
                "decoded_sha256": [hashlib.sha256(x.encode()).hexdigest() for x in back],
                "same": pa.array([a.replace(MARK, " ") == b for a, b in zip(texts, back, strict=True)], pa.bool_()),
            }

        return rows

    return map_texts(docs, make, "doc_id long, n_chars long, n_pieces long, ids_crc32 long, decoded_sha256 string, same boolean")
