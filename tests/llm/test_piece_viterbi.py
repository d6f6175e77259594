"""Shared-prefix search against the library, all cuts, and round trips."""

import hashlib
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor

from starloom.llm.piece_viterbi import MODEL, Pieces, decode, encode, pieces, round_trip

LIBRARY = SentencePieceProcessor(model_file=MODEL)
ODD = st.lists(st.sampled_from(list("abehinrtst é ß1.,!\t\n▁́漢😀​") + ["  ", "the ", "ing", "tion", "ouou", "ererere", "    "]), max_size=60).map("".join)


@given(st.lists(ODD, max_size=5))
@settings(max_examples=300, deadline=None)
def test_ids_are_the_librarys(texts):
    of = pieces(MODEL)
    for t, ids in zip(texts, of.encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == LIBRARY.encode(t)
        assert of.decode(ids) == t.replace("▁", " ")


def test_documents_are_the_librarys(llm):
    for r in llm.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        assert np.frombuffer(pieces(MODEL).encode([r.text])[0], "<u4").tolist() == LIBRARY.encode(r.text)


def test_unigram_takes_the_best_sum():
    of = Pieces(MODEL, unigram=True)
    for word in ("▁inthe", "▁banana", "▁tionou"):
        best = max(
            sum(of.scores[of.ids[p]] if p in of.ids else (of.unknown if len(p) == 1 else -1e12) for p in parts)
            for k in range(len(word))
            for cuts in combinations(range(1, len(word)), k)
            for parts in [[word[a:b] for a, b in zip((0, *cuts), (*cuts, len(word)), strict=True)]]
        )
        of.learn([word])
        assert sum(of.scores[i] for i in np.frombuffer(of.table[word], "<u4")) == pytest.approx(best)


def test_tables_start_anew(monkeypatch):
    monkeypatch.setattr("starloom.llm.piece_viterbi.TABLE_ENTRIES", 2)
    monkeypatch.setattr("starloom.llm.piece_viterbi.PAIR_ENTRIES", 2)
    of = Pieces(MODEL)
    for t in ("one two three", "three two", "one"):
        assert np.frombuffer(of.encode([t])[0], "<u4").tolist() == LIBRARY.encode(t)


def test_tables(awkward_docs, awkward):
    want = sorted((d, len(t or ""), LIBRARY.encode(t or "")) for d, t in awkward)
    coded = encode(awkward_docs)
    assert sorted((r.doc_id, r.n_chars, np.frombuffer(r.ids, "<u4").tolist()) for r in coded.collect()) == want
    assert sorted(map(tuple, decode(coded).collect())) == sorted((d, t or "") for d, t in awkward)
    got = round_trip(awkward_docs).collect()
    assert all(r.same for r in got)
    assert sorted((r.doc_id, r.n_pieces, r.decoded_sha256) for r in got) == sorted((d, len(LIBRARY.encode(t or "")), hashlib.sha256((t or "").encode()).hexdigest()) for d, t in awkward)


def test_empty(no_docs):
    assert encode(no_docs).collect() == [] == round_trip(no_docs).collect()
