"""Word and text languages: held-out accuracy, code-switched text, exact forward-backward."""

import random
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from starloom.llm.language_crf import UNKNOWN, Crf, Words, _expectations, fit, languages, stretches

SYLLABLES = {"aa": "ka lo mi ratu sen".split(), "bb": "ber schi ung heit zwo".split(), "cc": "éa oui leux tré eau".split()}


def text(lang, n, r):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randrange(1, 4))) for _ in range(n))


def rows(n, seed=1):
    r = random.Random(seed)
    return [(i, text(x, r.randrange(1, 60), r), x) for i in range(n) for x in [r.choice("aa bb cc".split())]]


@pytest.fixture(scope="module")
def model():
    made = rows(150, 3)
    return fit(pa.array([t for _, t, _ in made], pa.large_string()), [x for *_, x in made])


def test_held_out_rows(llm):
    made = rows(300)
    docs = llm.createDataFrame([(i, t, x if i % 7 else None) for i, t, x in made], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in languages(docs).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, *_ in made)
    assert np.mean([got[i].lang_pred == x for i, _, x in made if got[i].held_out]) > 0.97
    # languages of held-out rows are not learned
    other = llm.createDataFrame([(i, t, "zz" if got[i].held_out else (x if i % 7 else None)) for i, t, x in made], "doc_id long, text string, lang string")
    assert {tuple(r) for r in languages(other).collect()} == {tuple(r) for r in got.values()}


def test_code_switching(llm, model):
    r = random.Random(9)
    docs = llm.createDataFrame([(1, text("aa", 30, r) + " " + text("bb", 40, r)), (2, None), (3, "123 !")], "doc_id long, text string")
    found = sorted(stretches(docs, model).collect(), key=lambda x: x.first_word)
    assert [x.lang for x in found] == ["aa", "bb"] and abs(found[1].first_word - 30) <= 1
    assert sum(x.n_words for x in found) == 70 and {x.doc_id for x in found} == {1}


def test_marginals_against_all_paths():
    r = np.random.default_rng(1)
    crf = Crf(["x", "y", "z"], None, None, 1.0, r.normal(size=(3, 3)))
    emit, first = r.normal(size=(9, 3)), np.array([0, 4, 4, 9])
    got = crf.marginals(emit, first)
    for a, b in ((0, 4), (4, 9)):
        want = np.zeros((b - a, 3))
        for path in product(range(3), repeat=b - a):
            weight = np.exp(sum(emit[a + i, k] for i, k in enumerate(path)) + sum(crf.transitions[i, j] for i, j in zip(path, path[1:], strict=False)))
            want[range(b - a), path] += weight
        assert np.allclose(got[a:b], want / want.sum(axis=1, keepdims=True))
        chance, pairs = _expectations(emit[None, a:b], crf.transitions)
        assert np.allclose(chance[0], got[a:b]) and pairs.sum() == pytest.approx(b - a - 1)


def test_emissions_are_sums_of_features(model):
    words = Words(pa.array(["Kalo été ÉTÉ, x", None, "ratu"]))
    emit = model.emissions(words)
    assert np.allclose(emit[1], emit[2])
    for w, (a, n) in enumerate(zip(words.starts, words.grams, strict=True)):
        want = model.lexicon[words.buckets[w, 0]] + model.weights[words.buckets[w]].sum(axis=0) + model.weights[words.trigrams[a : a + n]].sum(axis=0)
        assert np.allclose(emit[w], want, atol=1e-4)


def test_awkward_rows(llm, awkward_docs, awkward, no_docs):
    got = languages(awkward_docs).collect()
    assert sorted(r.doc_id for r in got) == sorted(d for d, _ in awkward)
    for r in got:
        assert (r.lang_pred == UNKNOWN and r.score == 0) if r.doc_id in (5, 6, 7) else (r.lang_pred in ("en", "de") and 0 < r.score <= 1)
    assert languages(no_docs).collect() == []
    none = languages(awkward_docs.withColumn("lang", awkward_docs.lang.substr(9, 0)).filter("doc_id is null or text is null")).collect()
    assert [(r.lang_pred, r.score) for r in none] == [(UNKNOWN, 0.0)]


def test_letters_above_ascii(model):
    names, score, *_ = model.texts(pa.array(["…—“”", "漢字", "12 ½", "", None, "é"]))
    assert [n == UNKNOWN for n in names] == [True, False, True, True, True, False]
    assert ((score == 0) == [n == UNKNOWN for n in names]).all()
