"""Vectorised work on the bytes of many texts at once: words, shingles, MinHash values."""

from __future__ import annotations

import hashlib
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64

#: Bytes between words: space and \t \n \v \f \r.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True

#: Odd numbers: seeds of the hashes of words, and factors where hashes are combined.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)

#: Bytes beyond which a word is hashed by BLAKE2 and compared as a whole.
LONG = 64


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offset of each row in them; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, at, data = column.buffers()
    if at is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(at, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    body = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return body[offsets[0] : offsets[-1]], offsets - offsets[0]


def word_spans(body: np.ndarray, offsets: np.ndarray, gap: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of each word, and the index of the first word of each row (and of the end)."""
    ink = ~gap[body]
    before = np.empty(len(ink) + 1, bool)
    before[0], before[1:] = False, ink
    edges = offsets[:-1][offsets[:-1] < len(ink)]
    open_ = ink & ~before[:-1]
    open_[edges] = ink[edges]
    starts = np.flatnonzero(open_)
    close = np.empty(len(ink) + 1, bool)
    close[:-1], close[-1] = ~ink, True
    close[offsets] = True
    ends = np.flatnonzero(close[1:] & ink) + 1
    return starts, ends, np.searchsorted(starts, offsets).astype(np.int64)


@cache
def _bytes_table(base: int) -> np.ndarray:
    return np.random.default_rng(base & 0xFFFFFFFF).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i up to n."""
    if base not in _POWERS or len(_POWERS[base][0]) <= n:
        size = max(n + 1, 1 << 16)
        if len(_POWERS) > 2 or size > 1 << 22:
            _POWERS.pop(base, None)
        up, down = np.full(size, base, U64), np.full(size, pow(base, -1, 1 << 64), U64)
        up[0] = down[0] = 1
        made = np.cumprod(up, dtype=U64), np.cumprod(down, dtype=U64)
        if size > 1 << 22:
            return made
        _POWERS[base] = made
    return _POWERS[base]


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U64(30))
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


class Spans:
    """Hash of any byte range of a buffer in constant time, for features of models.

    It is linear in the bytes: periodic ranges of some hundred bytes may collide.  ``span_hashes`` names things.
    """

    def __init__(self, body: np.ndarray, base: int = BASES[0]):
        up, self.down = _powers(base, len(body))
        self.sums = np.zeros(len(body) + 1, U64)
        np.cumsum(_bytes_table(base)[body] * up[: len(body)], dtype=U64, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])


#: Keeps so many low bytes of eight.
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(8)] + [0xFFFFFFFFFFFFFFFF], U64)


def _eights(body: np.ndarray) -> np.ndarray:
    """The eight bytes that begin at each place, zeros behind the end."""
    padded = np.zeros(len(body) + 8, np.uint8)
    padded[: len(body)] = body
    return np.ndarray((len(body) + 1,), "<u8", padded, strides=(1,))


def span_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = BASES[0]) -> np.ndarray:
    """Hash of each byte range: eight bytes at a time are mixed into a state that is not linear in them."""
    size = ends - starts
    eights = _eights(body)
    state = mix(size.astype(U64) * U64(seed) + U64(seed >> 7))
    state = mix(state ^ (eights[starts] & _KEEP[np.minimum(size, 8)]))
    live, done = np.flatnonzero((size > 8) & (size <= LONG)), 8
    while len(live):
        block = eights[starts[live] + done] & _KEEP[np.minimum(size[live] - done, 8)]
        state[live] = mix(state[live] * U64(BASES[1]) ^ block)
        done += 8
        live = live[size[live] > done]
    for i in np.flatnonzero(size > LONG).tolist():
        digest = hashlib.blake2b(body[starts[i] : ends[i]], digest_size=8, key=seed.to_bytes(8, "little")).digest()
        state[i] = int.from_bytes(digest, "little")
    return state


def spans_equal(body: np.ndarray, starts: np.ndarray, ends: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Whether each byte range has the bytes of the range with the index ``other``."""
    size = ends - starts
    same = size == size[other]
    eights = _eights(body)
    live, done = np.flatnonzero(same & (size <= LONG) & (other != np.arange(len(size)))), 0
    while len(live):
        gap = (eights[starts[live] + done] ^ eights[starts[other[live]] + done]) & _KEEP[np.minimum(size[live] - done, 8)]
        same[live[gap != 0]] = False
        done += 8
        live = live[(gap == 0) & (size[live] > done)]
    for i in np.flatnonzero(same & (size > LONG)).tolist():
        same[i] = other[i] == i or bool((body[starts[i] : ends[i]] == body[starts[other[i]] : ends[other[i]]]).all())
    return same


def distinct_spans(body: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index of the first range of each kind, kind of each range); kinds are told apart by bytes, not by hashes."""
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    odd = np.flatnonzero(~spans_equal(body, starts, ends, first[which]))
    if len(odd):
        kinds: dict[tuple, int] = {}
        more = []
        for i in odd.tolist():
            key = int(hashes[i]), body[starts[i] : ends[i]].tobytes()
            if key not in kinds:
                kinds[key] = len(first) + len(more)
                more.append(i)
            which[i] = kinds[key]
        first = np.concatenate([first, np.array(more, first.dtype)])
    return first, which


def word_hashes(body: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = BASES[0]) -> np.ndarray:
    return span_hashes(body, starts, ends, base)


def window_hashes(words: np.ndarray, k: int, base: int = BASES[0]) -> np.ndarray:
    """Hash of each k consecutive word hashes (rows are not told apart)."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, U64)
    total = np.zeros(n, U64)
    for j in range(k):
        total += words[j : j + n] * U64(pow(base, j + 1, 1 << 64))
    return mix(total)


def shingles(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of all rows, and the first one of each row; a shorter text is one shingle."""
    counts = np.diff(first)
    padded = np.concatenate([words, np.zeros(k, U64)])
    inside = window_hashes(padded, k)[: len(words)]
    row = np.repeat(np.arange(len(counts)), counts)
    ok = np.arange(len(words)) + k <= first[1:][row]
    for r in np.flatnonzero((counts > 0) & (counts < k)):
        a, b = first[r], first[r + 1]
        total = U64(0)
        for j, w in enumerate(words[a:b]):
            total = U64((int(total) + int(w) * pow(BASES[1], j + 1, 1 << 64)) & 0xFFFFFFFFFFFFFFFF)
        inside[a] = mix(np.array([total], U64))[0]
        ok[a] = True
    per_row = np.bincount(row[ok], minlength=len(counts)) if len(row) else np.zeros(len(counts), np.int64)
    return inside[ok], np.concatenate([[0], np.cumsum(per_row)]).astype(np.int64)


def shingle_rows(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """shingles() of a text column."""
    body, offsets = text_bytes(column)
    starts, ends, first = word_spans(body, offsets)
    return shingles(word_hashes(body, starts, ends), first, k)


def exact_shingles(column: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """As shingle_rows(), with numbers in place of hashes: two shingles have one number only if their words are the same."""
    body, offsets = text_bytes(column)
    starts, ends, first = word_spans(body, offsets)
    hashes = word_hashes(body, starts, ends)
    kind = distinct_spans(body, starts, ends, hashes)[1]
    values, at = shingles(hashes, first, k)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    place = first[row] + np.arange(len(values)) - at[row]
    size = np.minimum(np.diff(first), k)[row]
    _, index, which = np.unique(values, return_index=True, return_inverse=True)
    rep = index[which]
    same = size == size[rep]
    padded = np.concatenate([kind, np.full(k, -1, kind.dtype)])
    for j in range(k):
        same &= (padded[place + j] == padded[place[rep] + j]) | (j >= size)
    known: dict[tuple, int] = {}
    for i in np.flatnonzero(~same).tolist():
        which[i] = known.setdefault(tuple(padded[place[i] : place[i] + size[i]].tolist()), len(index) + len(known))
    return which, at


@cache
def permutations(n: int, seed: int = 7) -> tuple[np.ndarray, np.ndarray]:
    """n universal hash permutations x -> a * x + b of the 32-bit numbers (a odd)."""
    r = np.random.default_rng(seed)
    return r.integers(0, 1 << 31, n, dtype=np.uint32) * np.uint32(2) + np.uint32(1), r.integers(0, 1 << 32, n, dtype=np.uint32)


def minhash(values: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """Rows x n signature; a row without shingles has the largest number everywhere."""
    out = np.full((len(first) - 1, n), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(first) > 0)
    if len(full):
        x = (values >> U64(32)).astype(np.uint32)
        at = first[:-1][full]
        a, b = permutations(n)
        for p in range(n):
            out[full, p] = np.minimum.reduceat(x * a[p] + b[p], at)
    return out
