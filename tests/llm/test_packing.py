"""Packing against the whole stream, and the encoder against the tokenizer itself."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starloom.llm.packing import pieces, sequences
from starloom.llm.tokens import Encoder, encoder

BYTES, LOWER = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PLAIN = {p: Tokenizer.from_file(p) for p in (BYTES, LOWER)}
ODD = st.lists(st.sampled_from(list("\0ab'sé ß1.,!\t\n\r ́​漢ΣAİ<|>") + ["<|endoftext|>", "<|startoftext|>", "  ", " the"]), max_size=40).map("".join)


@pytest.mark.parametrize("path", [BYTES, LOWER])
@given(texts=st.lists(ODD, max_size=6))
@settings(max_examples=150, deadline=None)
def test_encoder_is_the_tokenizer(path, texts):
    coder = encoder(path)
    got = [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode(texts)]
    assert got == [PLAIN[path].encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("path", [BYTES, LOWER])
@pytest.mark.parametrize("n", [512, 1024, 4096])
def test_periodic_pieces(path, n):
    """Long pieces that a hash linear in the bytes cannot tell apart, in one batch and in a later one."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    made = ["".join(s[b] for b in bits) for s in ("ab", "ba", "xy", "yx")]
    coder = Encoder(path)
    for texts in ([f"{a} {b} end" for a in made[:2] for b in made], made[::-1]):
        got = [np.frombuffer(x, coder.dtype).tolist() for x in coder.encode(texts)]
        assert got == [PLAIN[path].encode(t, add_special_tokens=False).ids for t in texts]


def test_encoder_starts_anew(monkeypatch):
    monkeypatch.setattr("starloom.llm.tokens.TABLE_ENTRIES", 3)
    coder = Encoder(BYTES)
    for t in ("one two three four", "five six", "one two", ""):
        assert np.frombuffer(coder.encode([t])[0], "<u2").tolist() == PLAIN[BYTES].encode(t).ids


def test_pieces(awkward_docs, awkward):
    ids = {}
    for d, t in awkward:
        ids.setdefault(d, []).append([*PLAIN[BYTES].encode(t or "", add_special_tokens=False).ids, 0])
    rows = sorted(pieces(awkward_docs).collect(), key=lambda r: (r.sequence_id, r.offset))
    place = 0
    for r in rows:  # gapless, none over a border
        assert (r.sequence_id, r.offset) == divmod(place, 1024) and r.offset + r.length <= 1024
        own = ids[r.doc_id][0]
        assert r.doc_tokens == len(own)
        assert r.ids_crc32 == zlib.crc32(np.array(own[r.start : r.start + r.length], "<u4").tobytes())
        assert r.crosses == (r.length < r.doc_tokens)
        place += r.length
    assert place == sum(len(x) for own in ids.values() for x in own)
    cover = sorted((r.doc_id, r.start, r.length) for r in rows)
    assert sum(n for _, _, n in cover) == place


def test_sequences(awkward_docs):
    rows = sorted(pieces(awkward_docs, with_ids=True).collect(), key=lambda r: (r.sequence_id, r.offset))
    made = sorted(sequences(awkward_docs).collect())
    assert b"".join(bytes(r.ids) for r in made) == b"".join(bytes(r.ids) for r in rows)
    assert [r.n_tokens for r in made[:-1]] == [1024] * (len(made) - 1) and all(len(r.ids) == 4 * r.n_tokens for r in made)


def test_empty(no_docs):
    assert pieces(no_docs).collect() == [] == sequences(no_docs).collect()
