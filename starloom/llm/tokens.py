"""Token ids of whole texts with a public tokenizer, each distinct piece of a batch tokenized once.

Both vocabularies split a text before a space that is followed by something other than white space, whatever stands
around it, and between an ASCII letter and a mark other than the apostrophe; a line break between other characters stands
alone.  So texts are cut there (by their bytes, for a whole batch at once), the distinct pieces of the batch are looked up in a bounded table, and new ones go through the
tokenizer, many at a time, as one text.  Pieces are found by their hashes and told apart by their bytes.  Texts with white space after a space go through the tokenizer whole.
"""

from __future__ import annotations

import json
import os
import re
from functools import cache

import numpy as np
import pyarrow as pa

from starloom.llm.kernels import distinct_spans, span_hashes, text_bytes

#: Pieces that a Python worker keeps; beyond that it starts anew.
TABLE_ENTRIES = 500_000
#: New pieces that go through the tokenizer as one text.
JOINED = 4000
#: Marks the piece that a text starts with.
START = b"\0"
_JOINED_SPACE = re.compile(r" \s")
_JOINED_WHITE = re.compile(r"\s\s")
#: Letters, then ASCII marks: one or two words' ends.  One capital, left out, turns into two characters.
_PLAIN = re.compile(r"([^\W\d_İ]+)([!-&(-/:-@\[-`{-~]*)")
#: First two bytes of the characters above ASCII that may be white space.
_WIDE = ((0xC2, 0xA0), (0xC2, 0x85), (0xE1, 0x9A), (0xE2, 0x80), (0xE2, 0x81), (0xE3, 0x80))
_ODD = np.zeros(256, bool)  # white space for Python or the tokenizer, and the mark
_ODD[[*range(0x09, 0x0E), 0x20, *range(0x1C, 0x20)]] = True
#: 1: ASCII letters, 2: the marks of ``_PLAIN``, 0: anything else.
_KIND = np.zeros(256, np.uint8)
_KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = 1
_KIND[[*range(0x21, 0x27), *range(0x28, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
#: Bytes that a white space character may begin with.
_MAYBE_SPACE = _ODD.copy()
_MAYBE_SPACE[sorted({a for a, _ in _WIDE})] = True


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.table: dict[bytes, bytes] = {}
        spec = json.loads(self.tokenizer.to_str())
        # what tells where a piece ends among the ids of several: bytes, or marks at the ends of words
        self.bytes_kept = spec["normalizer"] is None and spec["pre_tokenizer"]["type"] == "ByteLevel" and not spec["pre_tokenizer"]["add_prefix_space"]
        suffix = spec["model"].get("end_of_word_suffix")
        # capitals of ASCII make no difference to a vocabulary that lowers them
        self.lower = not self.bytes_kept and "Lowercase" in json.dumps(spec["normalizer"])
        self.extent = np.zeros(size, np.int64)
        added = {t["id"] for t in spec["added_tokens"]}
        for token, i in self.tokenizer.get_vocab(with_added_tokens=True).items():
            if self.bytes_kept:
                self.extent[i] = len(token.encode()) if i in added else len(token)
            elif suffix:
                self.extent[i] = token.endswith(suffix)

    def _ids(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.dtype).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _extent(self, piece: str) -> int:
        """Ends of words that the ids of a piece have; 0 if that is not known beforehand."""
        word = piece[1:]
        if piece[:1] not in (" ", "\n"):
            return 0
        found = _PLAIN.fullmatch(word)
        return 0 if found is None or not found[1].isalpha() else 1 + bool(found[2])

    def _learn(self, keys: list[bytes], extents: list[int]) -> None:
        """Ids of new pieces: of many as one text, where the ids tell which is whose."""
        alone = [k for k, x in zip(keys, extents, strict=True) if not x]
        self.table.update(zip(alone, self._ids([k.removeprefix(START).decode() for k in alone]), strict=True))
        many = [i for i, x in enumerate(extents) if x]
        groups = [many[i : i + JOINED] for i in range(0, len(many), JOINED)]
        texts = [b"".join([keys[i] for i in g]).decode() for g in groups]
        for group, made in zip(groups, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False), strict=True):
            own = [keys[i] for i in group]
            ids = np.array(made.ids, self.dtype)
            seen, wanted = np.cumsum(self.extent[ids]), np.cumsum([extents[i] for i in group])
            if len(ids) and seen[-1] == wanted[-1] and self.extent[ids[-1]]:
                ends = np.searchsorted(seen, wanted) + 1
                if (seen[ends - 1] == wanted).all():
                    cuts = [0, *(ends * self.dtype.itemsize).tolist()]
                    self.table.update(zip(own, map(ids.tobytes().__getitem__, map(slice, cuts[:-1], cuts[1:])), strict=True))
                    continue
            self.table.update(zip(own, self._ids([k.decode() for k in own]), strict=True))

    def _extents(self, body: np.ndarray, starts: np.ndarray, ends: np.ndarray, heads: np.ndarray, keys: list[bytes]) -> list[int]:
        """As _extent() for many pieces; 0 for those that a text starts with."""
        if not self.bytes_kept:
            # ASCII letters, then marks: one or two ends of words; what else there is is looked at piece by piece
            kind = _KIND[body]
            odd = kind == 0
            odd[:-1] |= (kind[:-1] == 2) & (kind[1:] == 1)
            many = np.zeros(len(body) + 1, np.int32)
            np.cumsum(odd, out=many[1:], dtype=np.int32)
            last = np.maximum(ends - 1, 0)
            plain = ~heads & ((body[starts] == 0x20) | (body[starts] == 0x0A)) & (ends - starts > 1) & (kind[np.minimum(starts + 1, len(body) - 1)] == 1)
            # the last byte may be a mark before the next piece's letter, but not odd itself
            plain &= (many[last] == many[np.minimum(starts + 1, last)]) & (kind[last] > 0)
            out = np.where(plain, 1 + (kind[last] == 2), 0).tolist()
            for i in np.flatnonzero(~plain & ~heads).tolist():
                out[i] = self._extent(keys[i].decode())
            return out
        plain = ~heads & ((body[starts] == 0x20) | (body[starts] == 0x0A)) & (ends - starts > 1)
        second = body[np.minimum(starts + 1, len(body) - 1)] if len(body) else body[starts]
        return np.where(plain & ~_MAYBE_SPACE[second], ends - starts, 0).tolist()

    def column(self, column: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a text column, and where each row begins in them; with ``end_id``, that id after each row."""
        body, offsets = text_bytes(column)
        # bytes before which a piece begins; a row's first piece has the mark instead
        whole, lines, special = self._odd_rows(body, offsets, column)
        if self.lower:
            body = _LOWER[body] if not special.any() else np.where(np.repeat(special, np.diff(offsets)), body, _LOWER[body])
        cut = body == 0x0A
        kind = _KIND[body]
        marks = np.zeros(len(body), bool)
        marks[1:] = (kind[1:] == 2) & (kind[:-1] == 1)
        if whole.any() or special.any() or not lines.all():
            size = np.diff(offsets)
            cut &= np.repeat(lines, size)
            cut |= marks & np.repeat(~special, size)
            cut |= body == 0x20
            cut &= ~np.repeat(whole, size)
        else:
            cut |= marks
            cut |= body == 0x20
        filled = np.diff(offsets) > 0
        first = np.zeros(len(body), bool)
        first[offsets[:-1][filled]] = True
        starts = np.flatnonzero(cut | first)
        ends = np.append(starts[1:], len(body))
        heads = first[starts]
        # a first piece is not the same as one inside, though its bytes are: it is cut one place earlier, at the mark
        hashes = span_hashes(body, starts, ends) ^ (heads.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        at, which = distinct_spans(body, starts, ends, hashes)
        raw = body.tobytes()
        keys = [raw[a:b] if not h else START + raw[a:b] for a, b, h in zip(starts[at].tolist(), ends[at].tolist(), heads[at].tolist(), strict=True)]
        if len(self.table) > TABLE_ENTRIES:
            self.table = {}
        found = list(map(self.table.get, keys))
        new = [i for i, x in enumerate(found) if x is None]
        fresh = at[new]
        self._learn([keys[i] for i in new], self._extents(body, starts[fresh], ends[fresh], heads[fresh], [keys[i] for i in new]))
        for i in new:
            found[i] = self.table[keys[i]]
        if end_id is not None:
            found.append(np.array([end_id], self.dtype).tobytes())
        sizes = np.array(list(map(len, found)), np.int64) // self.dtype.itemsize
        flat = np.frombuffer(b"".join(found), self.dtype)
        begins = np.cumsum(sizes) - sizes
        pieces_of = np.searchsorted(starts, offsets)
        if end_id is not None:
            which = np.insert(which, pieces_of[1:], len(found) - 1)
            pieces_of = pieces_of + np.arange(len(pieces_of))
        count = sizes[which]
        total = np.concatenate([[0], np.cumsum(count)])
        place = np.repeat((begins[which] - total[:-1]).astype(np.int32 if max(total[-1], len(flat)) < 1 << 31 else np.int64), count)
        place += np.arange(total[-1], dtype=place.dtype)
        ids = flat[place]
        return ids.astype(self.dtype, copy=False), total[pieces_of]

    def _odd_rows(self, body: np.ndarray, offsets: np.ndarray, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Rows that cannot be cut, rows that are also cut at line breaks, and rows that may hold special tokens."""
        rows = len(offsets) - 1
        whole, lines = np.zeros(rows, bool), np.ones(rows, bool)
        odd = _ODD[body]
        doubt = np.zeros(len(body), bool)
        doubt[:-1] = odd[:-1] & odd[1:]
        for a, b in _WIDE:
            doubt[:-1] |= (body[:-1] == a) & (body[1:] == b)
        for r in np.unique(np.searchsorted(offsets, np.flatnonzero(doubt), "right") - 1):
            text = column[int(r)].as_py()
            whole[r] = _JOINED_SPACE.search(text) is not None
            lines[r] = _JOINED_WHITE.search(text) is None
        marked = np.flatnonzero(body == 0)
        whole[np.searchsorted(offsets, marked, "right") - 1] = True
        special = np.zeros(rows, bool)
        special[np.searchsorted(offsets, np.flatnonzero((body[:-1] == 0x3C) & (body[1:] == 0x7C)), "right") - 1] = True
        return whole, lines, special

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, as bytes of ``dtype``."""
        ids, begins = self.column(pa.array(texts, pa.large_string()))
        raw, width = ids.tobytes(), self.dtype.itemsize
        return [raw[a * width : b * width] for a, b in zip(begins[:-1].tolist(), begins[1:].tolist(), strict=True)]


@cache
def encoder(path: str) -> Encoder:
    """One for each worker and vocabulary."""
    return Encoder(path)
