"""Fingerprints against plain Python, and near pairs against all pairs."""

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm.fingerprints import edited_fingerprints, fingerprints, hex_rows, likeness, near_pairs, signatures

from test_ngram_jaccard import shingle_set


def test_edited_texts(awkward_docs, awkward):
    got = {}
    for r in edited_fingerprints(awkward_docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    rows = sorted(((d, t or "") for d, t in awkward), key=lambda x: (-x[0], x[1]))
    for (d, t), (_, after) in zip(rows, rows[1:] + rows[:1], strict=True):
        r = got[d].pop()
        k = len(t) // 3
        edited = t[: len(t) - k] + after[:k]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        own, changed, following = signatures(pa.array([t, edited, after]))
        assert [r.fingerprint, r.edited_fingerprint] == hex_rows(np.array([own, changed]))
        assert r.near_edited == pytest.approx(likeness(own[None], changed[None])[0])
        assert r.near_next == pytest.approx(likeness(own[None], following[None])[0])
    assert not any(got.values())


def test_equal_texts_have_equal_fingerprints(awkward_docs):
    of = {}
    for r in fingerprints(awkward_docs).collect():
        of.setdefault(r.doc_id, set()).add(r.fingerprint)
    assert of[1] == of[2] and of[8] == of[9] and of[5] == of[6] == of[7] and of[1] != of[4]


def test_one_document(llm):
    r = edited_fingerprints(llm.createDataFrame([(1, "abcdef")], "doc_id long, text string")).collect()
    assert [(x.doc_id, x.edited_sha256) for x in r] == [(1, hashlib.sha256(b"abcdab").hexdigest())]


def test_empty(no_docs):
    assert edited_fingerprints(no_docs).collect() == fingerprints(no_docs).collect() == []


def test_likeness_follows_jaccard():
    words = [f"w{i}" for i in range(400)]
    a, b = " ".join(words), " ".join(words[:300] + [f"x{i}" for i in range(100)])
    s = signatures(pa.array([a, b]))
    assert likeness(s[:1], s[1:])[0] == pytest.approx(296 / 496, abs=0.15)


def test_near_pairs(awkward_docs, awkward):
    pairs, members = near_pairs(awkward_docs)
    classes = {r.doc_id: r.class_id for r in members.collect()}
    sets = {d: shingle_set(t) for d, t in awkward}
    want = {}
    for a, b in combinations(sorted({classes[d] for d in sets if sets[d]}), 2):
        j = len(sets[a] & sets[b]) / len(sets[a] | sets[b])
        if j >= 0.8:
            want[a, b] = j
    assert {(r.a_id, r.b_id): pytest.approx(r.jaccard) for r in pairs.collect()} == want
    assert classes[2] == 1 and classes[9] == 8
