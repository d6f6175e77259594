"""The similarity join against all pairs."""

import re
from itertools import combinations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from starloom.llm.fingerprints import PERMUTATIONS
from starloom.llm.ngram_jaccard import candidate_forest, exact_links, jaccard_links, needed_matches, one_of_each


def thue_morse(n):
    """A word of n letters over two symbols, and its complement."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def shingle_set(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows, threshold=0.8):
    sets = [shingle_set(t) for _, t in rows]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]):
            links[i] += 1
            links[j] += 1
            parent[root(i)] = root(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[root(i)] = min(low.get(root(i), d), d)
    return sorted((d, low[root(i)], links[i]) for i, (d, _) in enumerate(rows))


def found(df):
    return sorted((r.doc_id, r.class_id, r.n_links) for r in df.collect())


def test_awkward_rows(awkward_docs, awkward):
    assert found(jaccard_links(awkward_docs)) == brute(awkward)


def test_blocks_of_hot_groups(awkward_docs, awkward, monkeypatch):
    monkeypatch.setattr("starloom.llm.ngram_jaccard.SIGNATURE_BLOCK", 3)
    monkeypatch.setattr("starloom.llm.ngram_jaccard.SET_BLOCK", 2)
    assert found(jaccard_links(awkward_docs)) == brute(awkward)


def test_empty(no_docs):
    assert jaccard_links(no_docs).collect() == []


def test_null_ids(llm):
    docs = llm.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (4, "a b c d e f")], "doc_id long, text string")
    assert sorted(map(tuple, jaccard_links(docs).collect()), key=repr) == [(4, 4, 0), (None, None, 0), (None, None, 0)]


def test_texts_of_one_id(llm):
    """Two texts of one doc_id are two documents; links of neither are lost."""
    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    rows = [(1, a), (1, b), (2, a.replace("a59", "x")), (3, b.replace("b59", "x")), (4, b), (4, b), (5, "other words here"), (5, "other words here")]
    for n in (1, 3):
        docs = llm.createDataFrame(rows, "doc_id long, text string").repartition(n)
        assert found(jaccard_links(docs)) == brute(rows)
        assert sorted(map(tuple, one_of_each(docs).collect())) == [(1, a), (1, b), (5, "other words here")]


def test_periodic_words(llm):
    """Long words that a hash linear in the bytes cannot tell apart are different words."""
    rows = []
    for n in (512, 1024, 4096):
        one, other = thue_morse(n)
        common = " ".join(f"w{i}" for i in range(4))
        rows += [(2 * n, f"{common} {one} {common}"), (2 * n + 1, f"{common} {other} {common}")]
    docs = llm.createDataFrame(rows, "doc_id long, text string")
    assert found(jaccard_links(docs, 0.2)) == brute(rows, 0.2)
    assert found(jaccard_links(docs)) == brute(rows)


def test_pruning_keeps_what_may_link():
    needed = needed_matches()
    assert list(needed) == list(range(16, PERMUTATIONS + 1, 16))
    # 0.8 similar, 8 deviations below what is expected: gone; 5 below: kept
    assert 128 * 0.8 - 8.5 * 4.5 < needed[128] < 128 * 0.8 - 5 * 4.5


@given(st.integers(2, 30), st.integers(0, 10_000))
@settings(max_examples=30, deadline=None)
def test_forest_connects_all_survivors(n, seed):
    r = np.random.default_rng(seed)
    base = r.integers(0, 256, (3, PERMUTATIONS))
    signs = base[r.integers(0, 3, n)].astype(np.uint8)
    noise = r.random((n, PERMUTATIONS)) < r.random((n, 1)) * 0.5
    signs[noise] = r.integers(0, 256, noise.sum())
    needed = needed_matches()
    close = (signs[:, None] == signs[None]).sum(2) >= needed[128]
    for k in needed:
        close &= (signs[:, None, :k] == signs[None, :, :k]).sum(2) >= needed[k]

    def parts(pairs):
        p = list(range(n))
        for i, j in pairs:
            a, b = p[i], p[j]
            p = [a if x == b else x for x in p]
        return [p.index(x) for x in p]

    edges = candidate_forest(signs, needed)
    assert len(edges) < n
    assert parts(edges) == parts(np.argwhere(close))


def test_exact_links_in_column_blocks():
    r = np.random.default_rng(3)
    sets = [np.unique(r.integers(0, 40, 60).astype(np.uint64)) for _ in range(9)]
    want = [[len(np.intersect1d(a, b)) >= 0.6 * len(np.union1d(a, b)) for b in sets] for a in sets]
    assert (exact_links(sets, 0.6, columns=7) == np.array(want)).all()
