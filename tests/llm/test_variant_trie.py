"""The trie of letter-group counts against all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm.variant_trie import Letters, corpus_words, reach, spelling_variants, vectors, walk


def counted(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{doc}:{run}".encode())
            if doc is not None and h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(words):
    near = {w: [x for x in words if abs(len(x) - len(w)) < 2 and x != w and one_edit(w, x)] for w in words}
    best = {w: min(x, key=lambda v: (-words[v], v)) for w, x in near.items() if x}
    form = {w: x for w, x in best.items() if words[x] >= 2 * words[w]}

    def last(w):
        while w in form:
            w = form[w]
        return w

    return sorted(((w, form.get(w), last(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()), key=repr)


def found(df):
    return sorted(map(tuple, df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


@pytest.fixture(scope="module")
def words():
    r = random.Random(3)
    base = ["".join(r.choice("abcdeèÿ") for _ in range(r.randrange(5, 9))) for _ in range(60)]
    made = set(base)
    for w in base:
        for _ in range(6):
            k = r.randrange(len(w))
            made |= {w[:k] + r.choice("abcxéÀ") + w[k + 1 :], w[:k] + r.choice("aß") + w[k:], w[:k] + w[k + 1 :], "".join(r.sample(w, len(w)))}
    made |= {"w" * 5000, "w" * 4999, "w" * 2500 + "v" + "w" * 2499, "wvw" * 40, "wvw" * 40 + "x", "x" + "wvw" * 40, "z" * 64, "z" * 65, "z" * 63 + "y"}
    return {w: r.choice([3, 3, 4, 6, 7, 12, 25, 60, 130]) for w in made}


@pytest.mark.parametrize("options", [{}, {"shard": 40, "leaf": 2}, {"groups": 3, "shard": 1, "leaf": 0}, {"groups": 1}])
def test_all_pairs(llm, words, options):
    table = llm.createDataFrame(list(words.items()), "word string, n long").repartition(4)
    assert found(spelling_variants(table, **options)) == brute(words)


def test_awkward_texts(llm, awkward, awkward_docs):
    got = {r.word: r.n for r in corpus_words(awkward_docs).collect()}
    assert got == counted(awkward) and "w" * 5000 not in got
    assert found(spelling_variants(corpus_words(awkward_docs))) == brute(got)


def test_letters_of_the_pattern(llm):
    rows = [(i, "ÀÉÎÕÜ ÀÉÎÕÜ×÷ßÿ Naïveté naïveté NAïVETé œuvres İstanbul STRASSE straße abcde1abcde x") for i in range(40)] + [(None, "abcde")] * 3
    docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r.word: r.n for r in corpus_words(docs).collect()} == counted(rows)


def test_empty(no_docs):
    assert spelling_variants(corpus_words(no_docs)).collect() == []


@given(st.lists(st.text("abé", min_size=1, max_size=6), min_size=2, max_size=12, unique=True))
@settings(max_examples=60, deadline=None)
def test_edits(made):
    letters = Letters(made, widest=4)
    i, j = np.triu_indices(len(made), 1)
    assert letters.one_edit(i, j).tolist() == [one_edit(made[a], made[b]) for a, b in zip(i, j, strict=True)]


@given(st.integers(0, 10_000))
@settings(max_examples=30, deadline=None)
def test_walk_finds_what_budgets_allow(seed):
    r = np.random.default_rng(seed)
    inside, visitors = (r.integers(0, 3, (n, 4)).astype(np.int16) for n in (40, 30))
    inside = inside[np.lexsort(inside.T[::-1])]
    plus, minus = r.integers(-1, 2, 30), r.integers(-1, 2, 30)
    gap = visitors[:, None] - inside[None]
    want = (np.maximum(gap, 0).sum(2) <= plus[:, None]) & (np.maximum(-gap, 0).sum(2) <= minus[:, None])
    for leaf in (0, 3, 100):
        got = np.zeros_like(want)
        for i, j in walk(inside, visitors, plus, minus, leaf):
            assert not got[i, j].any()
            got[i, j] = True
        assert (got == want).all()


def test_reach():
    around = {tuple(x) for x in reach(np.array([0, 2, 1]))}
    assert (0, 2, 1) in around and (1, 1, 1) in around and (0, 3, 0) in around and (0, 1, 1) in around
    assert len(around) == 1 + 3 + 2 + 4 and min(map(min, around)) == 0


def test_vectors():
    assert vectors(["aab", "ÿ", "b" * 40_000], np.where(np.arange(256) == ord("b"), 1, 0), 2).tolist() == [[2, 1], [1, 0], [0, 32767]]
