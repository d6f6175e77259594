"""Removal of repeated passages by recompression: equal passages get equal symbols, shared symbols reveal repeats.

A word is a run of bytes other than ASCII white space.  Two rounds of recompression run over the words of each text:
first maximal runs of one symbol, then neighbouring pairs (the symbol's bits say which symbols are left and which are
right halves) are replaced by new symbols.  A new symbol's name is a 64-bit hash of its parts, so equal runs and pairs
have the same name in every text and every task, without a dictionary to exchange.  Each symbol also knows the range
of words that its name and borders depend on; where a window of ``WINDOW`` words holds that range, every other
occurrence of the window holds the same symbol.  A window is filed under the smallest name of two such symbols side by
side, or of one; a window that holds none, as among long runs, under itself.

1. ``_pages``: texts are packed into pages of about a megabyte, compressed, with fixed page numbers.
2. Spark groups the symbols of all pages: which of them are in two documents or more?
3. Windows under shared symbols are verified: they are dealt to parts by one hash of all their words and compared by
   another of 64 bits, with the smallest doc_id of each page.  Parts do not grow with the data, their number does.
4. A window is a repeat if a smaller doc_id has it; the words under repeats go.

A page names each symbol and each window once, and the answers that come back are single bits, so a passage that a
third of all documents share costs one entry a page.  Pages should be made larger (``page_bytes``) as data grows.

Defined cases: null text has no words; documents below 13 words lose none; rows that share a doc_id never remove words
from each other; a null doc_id is larger than any other; repeated rows stay; extra columns are ignored.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starloom.llm.kernels import BASES, U64, mix, text_bytes, window_hashes, word_hashes, word_spans
from starloom.llm.runtime import chunks, map_runs, scratch_partitions, stage

WINDOW = 13
ROUNDS = 2
PAGE_BYTES = 1 << 20
#: Pages whose symbols, and whose windows, one task of the two groupings holds.
PAGES_OF_SYMBOLS = 64
PAGES_OF_WINDOWS = 24
NO_ID = np.iinfo(np.int64).max
NONE = np.iinfo(np.uint64).max
#: Level of the compression of pages.
PACKING = 3


class Page:
    """Words of a page, with their hashes and the document each belongs to."""

    def __init__(self, ids: bytes, offsets: bytes, blob: bytes):
        self.ids = np.frombuffer(ids, np.int64)
        self.offsets = np.frombuffer(offsets, np.int64)
        self.body = np.frombuffer(zstandard.decompress(blob, max_output_size=max(1, int(self.offsets[-1]))) if self.offsets[-1] else b"", np.uint8)
        self.starts, self.ends, self.first = word_spans(self.body, self.offsets)
        self.words = word_hashes(self.body, self.starts, self.ends)
        self.row = np.repeat(np.arange(len(self.ids)), np.diff(self.first))

    def windows(self, size: int) -> np.ndarray:
        """Index of the first word of each window that lies in one document."""
        at = np.arange(max(0, len(self.words) - size + 1))
        return at[at + size <= self.first[1:][self.row[at]]]

    def names(self, size: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
        """Windows, and the name that each is filed under: that of two neighbouring symbols, of one, or its own."""
        at = self.windows(size)
        if not len(at):
            return at, np.zeros(0, U64)
        filed = window_hashes(self.words, size)[at]
        name, left, right, doc = recompress(self.words, self.row, rounds)
        both = mix(name[:-1] * U64(BASES[1]) + name[1:] * U64(BASES[0]) + U64(1))
        same = doc[1:] == doc[:-1]
        for names, low, high in ((name, left, right), (both[same], np.minimum(left[:-1], left[1:])[same], np.maximum(right[:-1], right[1:])[same])):
            best = _smallest(names, np.maximum(high - size, 0), low, len(self.words))[at]
            filed = np.where(best == NONE, filed, best)
        return at, filed


def _smallest(names: np.ndarray, low: np.ndarray, high: np.ndarray, n: int) -> np.ndarray:
    """For each window the smallest name among those that it holds: those with low <= window <= high."""
    best = np.full(n, NONE, U64)
    for t in range(int((high - low).max(initial=-1)) + 1):
        use = low + t <= high
        np.minimum.at(best, low[use] + t, names[use])
    return best


def recompress(words: np.ndarray, row: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Names of the symbols after so many rounds, the range of words that each depends on, and its row."""
    n = len(words)
    name, doc = words.copy(), row
    left, right = np.arange(n), np.arange(1, n + 1)
    for r in range(rounds):
        # runs: a symbol differs from its neighbours, so it depends on what they depend on
        before, after = _neighbours(left, right, doc)
        new = np.ones(len(name), bool)
        new[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
        head = np.flatnonzero(new)
        tail = np.append(head[1:], len(name)) - 1
        length = tail - head + 1
        left, right, doc = np.minimum(left[head], before[head]), np.maximum(right[tail], after[tail]), doc[head]
        name = np.where(length > 1, mix(name[head] * U64(BASES[1]) + length.astype(U64)), name[head])
        # pairs: a left half takes a right half that follows; without one it depends on that neighbour
        before, after = _neighbours(left, right, doc)
        half = (mix(name + U64(r + 1)) & U64(1)).astype(bool)
        pair = np.zeros(len(name), bool)
        pair[:-1] = ~half[:-1] & half[1:] & (doc[1:] == doc[:-1])
        second = np.zeros(len(name), bool)
        second[1:] = pair[:-1]
        alone = ~pair & ~second
        left = np.where(alone & half, np.minimum(left, before), left)
        right = np.where(alone & ~half, np.maximum(right, after), right)
        where = np.flatnonzero(pair)
        name[where] = mix(name[where] * U64(BASES[0]) + name[where + 1] * U64(BASES[1]) + U64(r + 3))
        left[where], right[where] = np.minimum(left[where], left[where + 1]), np.maximum(right[where], right[where + 1])
        name, left, right, doc = name[~second], left[~second], right[~second], doc[~second]
    return name, left, right, doc


def _neighbours(left: np.ndarray, right: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far the dependence of each symbol's neighbours reaches; beyond the ends of a document, one word further."""
    before, after = left - 1, right + 1
    same = doc[1:] == doc[:-1]
    before[1:][same] = left[:-1][same]
    after[:-1][same] = right[1:][same]
    return before, after


def _pages(docs: DataFrame, page_bytes: int) -> DataFrame:
    """Rows (page, ids, offsets, blob, rest): the texts of a page, and its other columns as an Arrow stream."""
    others = [c for c in docs.columns if c not in ("_doc_id", "_text")]

    def pack(batches):
        part, count, held, size = TaskContext.get().partitionId(), 0, [], 0

        def page():
            nonlocal count
            ids = np.concatenate([h[0] for h in held])
            lengths = np.concatenate([np.diff(h[2]) for h in held])
            blob = zstandard.compress(b"".join(h[1].tobytes() for h in held), PACKING)
            count += 1
            offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
            rest = b""
            if others:
                rows = pa.Table.from_batches([h[3] for h in held]).combine_chunks()
                with pa.ipc.new_stream(sink := pa.BufferOutputStream(), rows.schema) as out:
                    out.write_table(rows)
                rest = zstandard.compress(sink.getvalue().to_pybytes(), PACKING)
            return pa.RecordBatch.from_arrays(
                [pa.array([(part << 32) + count - 1]), *(pa.array([x], pa.binary()) for x in (ids.tobytes(), offsets.tobytes(), blob, rest))],
                names=["page", "ids", "offsets", "blob", "rest"],
            )

        for batch in batches:
            for piece in chunks(batch, "_text", page_bytes):
                body, offsets = text_bytes(piece.column("_text"))
                held.append((piece.column("_doc_id").fill_null(NO_ID).to_numpy(), body, offsets, piece.select(others)))
                size += len(body)
                if size >= page_bytes:
                    yield page()
                    held, size = [], 0
        if held:
            yield page()

    return stage(docs.mapInArrow(pack, "page long, ids binary, offsets binary, blob binary, rest binary"), "dedup-pages", compression="uncompressed")


def _by_part(part: np.ndarray, keys: np.ndarray, count: int) -> tuple[np.ndarray, list[tuple[int, slice]]]:
    """Order of the keys by part and key, and the slice of each part."""
    part = (part % U64(count)).astype(np.int64)
    order = np.lexsort((keys, part))
    bounds = np.searchsorted(part[order], np.arange(count + 1))
    return order, [(p, slice(int(bounds[p]), int(bounds[p + 1]))) for p in range(count) if bounds[p] < bounds[p + 1]]


def _asked(page: Page, size: int, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Windows, index of each one's name, the page's names in order of value, and whether two documents have them."""
    at, name = page.names(size, rounds)
    names, which = np.unique(name, return_inverse=True)
    low, high = np.full(len(names), NO_ID, np.int64), np.full(len(names), np.iinfo(np.int64).min, np.int64)
    who = page.ids[page.row[at]]
    np.minimum.at(low, which, who)
    np.maximum.at(high, which, who)
    return at, which, names, low < high


def _short(names: np.ndarray) -> np.ndarray:
    """Names within a part; two that are taken for one only add candidates, and parts do not grow with the data."""
    return (names >> U64(32)).astype(np.uint32)


def _bits(answers: list[dict] | None, order: np.ndarray, parts: list[tuple[int, slice]]) -> np.ndarray:
    """Answers of all parts, put at the keys they belong to."""
    out = np.zeros(len(order), bool)
    given = {a["part"]: a["bits"] for a in answers or []}
    for p, where in parts:
        out[order[where]] = np.unpackbits(np.frombuffer(given[p], np.uint8), count=where.stop - where.start).astype(bool)
    return out


def _verify(page: Page, size: int, rounds: int, answers: list[dict] | None, count: int) -> dict[str, np.ndarray]:
    """Candidate windows of a page, their two keys, and for each distinct pair of keys the smallest doc_id here."""
    at, which, names, _ = _asked(page, size, rounds)
    shared = _bits(answers, *_by_part(names, _short(names), count))
    at = at[shared[which]]
    key = window_hashes(page.words, size)[at]
    other = window_hashes(word_hashes(page.body, page.starts, page.ends, BASES[1]), size, BASES[1])[at]
    order = np.lexsort((other, key))
    new = np.ones(len(at), bool)
    new[1:] = (key[order][1:] != key[order][:-1]) | (other[order][1:] != other[order][:-1])
    index = np.empty(len(at), np.int64)
    index[order] = np.cumsum(new) - 1
    who = page.ids[page.row[at]]
    low = np.full(int(new.sum()), NO_ID, np.int64)
    np.minimum.at(low, index, who)
    return {"at": at, "index": index, "key": key[order][new], "other": other[order][new], "low": low, "who": who}


def _narrow(values: np.ndarray) -> tuple[int, bytes, int]:
    """Numbers as differences from the smallest, in as few bytes as they need: base, bytes, width."""
    base = int(values.min())
    gap = (values - base).astype(np.uint64)
    width = next(w for w in (2, 4, 8) if w == 8 or int(gap.max()) < 1 << (8 * w))
    return base, gap.astype(f"<u{width}").tobytes(), width


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, rounds: int = ROUNDS, page_bytes: int = PAGE_BYTES, doc_id: str = "doc_id", text: str = "text", carry: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, n_words, n_removed, kept (text of the kept words, joined by one space).

    With ``carry``, also the columns of that name, and ``original``, the text as it was (null: empty).
    """
    pages = _pages(docs.select(F.col(doc_id).cast("long").alias("_doc_id"), F.col(text).alias("_text"), *carry), page_bytes)
    n_pages = pages.select("page").count()
    least = scratch_partitions(docs.sparkSession)
    n_names, n_windows = (max(least, -(-n_pages // each)) for each in (PAGES_OF_SYMBOLS, PAGES_OF_WINDOWS))

    def of(batch: pa.RecordBatch):
        for r in batch.to_pylist():
            yield r, Page(r["ids"], r["offsets"], r["blob"])

    def ask(batches):
        for batch in batches:
            for r, page in of(batch):
                _, _, names, multi = _asked(page, window, rounds)
                order, parts = _by_part(names, _short(names), n_names)
                short, multi = _short(names)[order], multi[order]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p for p, _ in parts], pa.int32()),
                        pa.array([r["page"]] * len(parts), pa.int64()),
                        pa.array([short[s].tobytes() for _, s in parts], pa.binary()),
                        pa.array([np.packbits(multi[s]).tobytes() for _, s in parts], pa.binary()),
                    ],
                    names=["part", "page", "names", "multi"],
                )

    def shared(key, group):
        sizes = [len(x) // 4 for x in group.column("names").to_pylist()]
        names = text_bytes(group.column("names"))[0].view(np.uint32)
        multi = np.concatenate([np.unpackbits(np.frombuffer(m, np.uint8), count=n) for m, n in zip(group.column("multi").to_pylist(), sizes, strict=True)])
        _, which, count = np.unique(names, return_inverse=True, return_counts=True)
        known = (count + np.bincount(which, multi, len(count)))[which] > 1
        return _answer(key, group, sizes, known)

    asked = pages.mapInArrow(ask, "part int, page long, names binary, multi binary")
    answers = map_runs(asked, ("part",), shared, "part int, page long, bits binary")
    first = _collected(stage(answers, "dedup-shared"), "first")
    candidates = pages.join(first, "page", "left")

    def verify(batches):
        for batch in batches:
            for r, page in of(batch):
                found = _verify(page, window, rounds, r["first"], n_names)
                order, parts = _by_part(found["other"], found["key"], n_windows)
                key, low = found["key"][order], found["low"][order]
                docs_ = [_narrow(low[s]) for _, s in parts]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([p for p, _ in parts], pa.int32()),
                        pa.array([r["page"]] * len(parts), pa.int64()),
                        pa.array([key[s].tobytes() for _, s in parts], pa.binary()),
                        pa.array([d[0] for d in docs_], pa.int64()),
                        pa.array([d[1] for d in docs_], pa.binary()),
                        pa.array([d[2] for d in docs_], pa.int32()),
                    ],
                    names=["part", "page", "keys", "base", "lows", "width"],
                )

    def repeated(key, group):
        sizes = [len(x) // 8 for x in group.column("keys").to_pylist()]
        low = np.concatenate(
            [np.frombuffer(x, f"<u{w}").astype(np.int64) + b for x, w, b in zip(*(group.column(c).to_pylist() for c in ("lows", "width", "base")), strict=True)]
        )
        keys, index = np.unique(text_bytes(group.column("keys"))[0].view(U64), return_inverse=True)
        least_ = np.full(len(keys), NO_ID, np.int64)
        np.minimum.at(least_, index, low)
        return _answer(key, group, sizes, least_[index] < low)

    sent = candidates.mapInArrow(verify, "part int, page long, keys binary, base long, lows binary, width int")
    answers = map_runs(sent, ("part",), repeated, "part int, page long, bits binary")
    second = _collected(stage(answers, "dedup-repeated"), "second")

    def cut(batches):
        for batch in batches:
            for r, page in of(batch):
                found = _verify(page, window, rounds, r["first"], n_names)
                bits = _bits(r["second"], *_by_part(found["other"], found["key"], n_windows))
                # the smallest document of this page goes by what other pages have
                gone = bits[found["index"]] | (found["low"][found["index"]] < found["who"])
                made = _cut(page, found["at"][gone], window)
                if carry:
                    rows = pa.ipc.open_stream(zstandard.decompress(r["rest"])).read_all().combine_chunks()
                    text_ = page.body.tobytes()
                    at = page.offsets.tolist()
                    original = pa.array([text_[a:b] for a, b in zip(at[:-1], at[1:], strict=True)], pa.binary()).cast(pa.string())
                    more = [original, *(rows.column(c).combine_chunks() for c in carry)]
                    made = pa.RecordBatch.from_arrays([*made.columns, *more], names=[*made.schema.names, "original", *carry])
                yield made

    fixed = "doc_id long, n_words long, n_removed long, kept string" + (", original string" if carry else "")
    schema = T.StructType([*T._parse_datatype_string(fixed).fields, *docs.select(*carry).schema.fields])
    return pages.join(first, "page", "left").join(second, "page", "left").mapInArrow(cut, schema)


def _answer(key: tuple, group: pa.Table, sizes: list[int], bits: np.ndarray) -> dict:
    ends = np.cumsum([0, *sizes])
    return {
        "part": pa.array([int(key[0])] * len(sizes), pa.int32()),
        "page": group.column("page"),
        "bits": pa.array([np.packbits(bits[a:b]).tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary()),
    }


def _collected(answers: DataFrame, name: str) -> DataFrame:
    """All answers of a page together: as many as there are parts at most, one bit for each entry of the page."""
    return answers.groupBy("page").agg(F.collect_list(F.struct("part", "bits")).alias(name))


def _cut(page: Page, gone: np.ndarray, window: int) -> pa.RecordBatch:
    change = np.zeros(len(page.words) + 1, np.int64)
    np.add.at(change, gone, 1)
    np.add.at(change, gone + window, -1)
    keep = np.cumsum(change)[:-1] == 0
    counts = np.diff(page.first)
    removed = counts - np.bincount(page.row[keep], minlength=len(counts))
    text, kept = page.body.tobytes(), []
    for i, (a, b) in enumerate(zip(page.first[:-1], page.first[1:], strict=True)):
        at = a + np.flatnonzero(keep[a:b])
        kept.append(b" ".join([text[s:e] for s, e in zip(page.starts[at].tolist(), page.ends[at].tolist(), strict=True)]))
    ids = pa.array(page.ids, pa.int64(), mask=page.ids == NO_ID)
    return pa.RecordBatch.from_arrays(
        [ids, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
        names=["doc_id", "n_words", "n_removed", "kept"],
    )


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) without repeated passages; texts that keep all words stay as they are.

    Rows of which nothing is left are gone.
    """
    # names of its own, so that no column of the table can clash; pages hold the text once
    names = {c: f"_{i}" for i, c in enumerate(c for c in docs.columns if c not in ("doc_id", "text"))}
    rows = docs.select("doc_id", "text", F.col("text").isNull().alias("_null"), *(F.col(c).alias(n) for c, n in names.items()))
    cut = remove_repeats(rows, window, carry=("_null", *names.values()))
    left = cut.filter("n_words = 0 or n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept")).when(~F.col("_null"), F.col("original"))
    made = {"doc_id": F.col("doc_id").cast(docs.schema["doc_id"].dataType), "text": text, **{c: F.col(n) for c, n in names.items()}}
    return left.select(*(made[c].alias(c) for c in docs.columns))
