"""Hashes and names of words, where plain hashes would fail."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm import kernels
from starloom.llm.kernels import BASES, distinct_spans, exact_shingles, shingle_rows, span_hashes, text_bytes, word_spans
from starloom.llm.runtime import maybe_among


def thue_morse(n, symbols):
    return "".join(symbols[bin(i).count("1") % 2] for i in range(n))


def spans(words):
    body, offsets = text_bytes(pa.array([" ".join(words)]))
    return body, *word_spans(body, offsets)[:2]


@pytest.mark.parametrize("n", [8, 16, 64, 65, 512, 1024, 2048, 4096])
def test_periodic_words_have_hashes_of_their_own(n):
    words = [f(n) for s in ("ab", "ba", "xy", "yx") for f in (lambda k, s=s: thue_morse(k, s), lambda k, s=s: (s * k)[:k], lambda k, s=s: s[0] * k)]
    body, starts, ends = spans(words)
    for seed in BASES:
        made = span_hashes(body, starts, ends, seed)
        assert len(set(made.tolist())) == len(set(words))
        assert [int(x) for x in made] == [int(made[words.index(w)]) for w in words]


@given(st.lists(st.text("ab\x00é", min_size=1, max_size=90).filter(lambda w: not w.isspace()), min_size=1, max_size=30))
@settings(max_examples=80, deadline=None)
def test_kinds_are_those_of_bytes(words):
    body, starts, ends = spans(words)
    for hashes in (span_hashes(body, starts, ends), np.zeros(len(starts), np.uint64), (ends - starts).astype(np.uint64)):
        first, which = distinct_spans(body, starts, ends, hashes)
        assert [words[i] for i in first[which].tolist()] == words
        assert len(first) == len(set(words))


@given(st.lists(st.lists(st.sampled_from("abc"), max_size=9).map(" ".join), max_size=8), st.booleans())
@settings(max_examples=80, deadline=None)
def test_shingles_by_words(texts, collide):
    column = pa.array([*texts, None], pa.string())
    with pytest.MonkeyPatch.context() as m:
        if collide:  # all words have one hash, and so have all shingles
            m.setattr(kernels, "word_hashes", lambda body, starts, ends: np.zeros(len(starts), np.uint64))
        values, first = exact_shingles(column, 3)
    names = {}
    for t, a, b in zip([*texts, ""], first[:-1], first[1:], strict=True):
        w = t.split()
        want = [tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        assert len(want) == b - a
        for x, v in zip(want, values[a:b].tolist(), strict=True):
            assert names.setdefault(x, v) == v
    assert len(set(names.values())) == len(names)
    assert (first == shingle_rows(column, 3)[1]).all()


def test_filter_of_keys(llm, monkeypatch):
    """Never false for a key; with few bits true for all, and joins after it are right all the same."""
    table = llm.createDataFrame([(i, "x") for i in range(500)] + [(None, "x")], "id long, other string").repartition(3)
    keys = llm.createDataFrame([(i,) for i in range(0, 500, 7)], "k long")
    wide = {r.id: r._maybe for r in maybe_among(table, "id", keys).collect()}
    assert len(wide) == 501 and all(wide[i] for i in range(0, 500, 7)) and sum(wide.values()) < 90
    monkeypatch.setattr("starloom.llm.runtime.FILTER_BITS", 8)
    assert all(r._maybe for r in maybe_among(table, "id", keys).filter("id is not null").collect())
    assert not any(r._maybe for r in maybe_among(table, "id", keys.limit(0)).collect())
