"""Removal of repeats against all windows."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm.kernels import text_bytes, word_spans
from starloom.llm.substring_dedup import recompress, remove_repeats


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def brute(rows, k=13):
    low = {}
    for d, t in rows:
        w = words(t)
        for i in range(len(w) - k + 1):
            key = tuple(w[i : i + k])
            low[key] = min(low.get(key, d), d)
    out = []
    for d, t in rows:
        w = words(t)
        gone = {j for i in range(len(w) - k + 1) if low[tuple(w[i : i + k])] < d for j in range(i, i + k)}
        out.append((d, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)))
    return sorted(out)


def test_awkward_rows(awkward_docs, awkward):
    assert sorted(map(tuple, remove_repeats(awkward_docs).collect())) == brute(awkward)


def test_small_pages(awkward_docs, awkward):
    assert sorted(map(tuple, remove_repeats(awkward_docs, page_bytes=600).collect())) == brute(awkward)


def test_few_words(llm):
    r = np.random.default_rng(5)
    rows = [(int(i), " ".join("ab"[x] for x in r.integers(0, 2, r.integers(0, 60)))) for i in range(80)]
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(map(tuple, remove_repeats(docs, window=6, page_bytes=200).collect())) == brute(rows, 6)


def test_empty(no_docs):
    assert remove_repeats(no_docs).collect() == []


def test_null_id_is_largest(llm):
    text = " ".join(f"w{i}" for i in range(20))
    made = remove_repeats(llm.createDataFrame([(None, text), (3, text)], "doc_id long, text string")).collect()
    assert {(r.doc_id, r.n_removed) for r in made} == {(3, 0), (None, 20)}


@given(st.lists(st.sampled_from("abc"), min_size=20, max_size=60), st.lists(st.sampled_from("abc"), max_size=8), st.lists(st.sampled_from("abc"), max_size=8))
@settings(max_examples=200, deadline=None)
def test_symbols_depend_on_their_range_only(inside, before, after):
    """Symbols whose range lies in a passage are the same wherever the passage stands."""

    def symbols(tokens):
        names = np.array([hash(t) & 0xFFFFFFFF for t in tokens], np.uint64)
        return list(zip(*recompress(names, np.zeros(len(tokens), np.int64), 2)[:3], strict=True))

    alone = {(n, a, b) for n, a, b in symbols(inside) if a >= 0 and b <= len(inside)}
    k = len(before)
    framed = {(n, a - k, b - k) for n, a, b in symbols(before + inside + after) if a >= k and b <= k + len(inside)}
    assert alone <= framed
    assert {x for x in framed if x[1] > 0 and x[2] < len(inside)} <= alone | framed


def test_word_spans():
    body, offsets = text_bytes(pa.array(["a b", None, "", " c", "d ", "e"]))
    starts, ends, first = word_spans(body, offsets)
    assert [bytes(body[a:b]) for a, b in zip(starts, ends, strict=True)] == [b"a", b"b", b"c", b"d", b"e"]
    assert first.tolist() == [0, 2, 2, 2, 3, 4, 5]


def test_periodic_words(llm):
    """Passages that differ in one long periodic word are different passages."""
    rows = []
    for n in (512, 1024, 2048, 4096):
        bits = [bin(i).count("1") % 2 for i in range(n)]
        one, other = ("".join(s[b] for b in bits) for s in ("ab", "ba"))
        common = [f"w{i}" for i in range(6)]
        rows += [(2 * n, " ".join([*common, one, *common])), (2 * n + 1, " ".join([*common, other, *common])), (9000 + n, " ".join([*common, one, *common]))]
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, remove_repeats(docs).collect()))
    assert got == brute(rows) and [r[2] for r in got] == [0] * 8 + [13] * 4
