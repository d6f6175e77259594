"""The stages one by one and together, against plain Python."""

import re

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from conftest import CLASHES
from starloom.llm.language_crf import LEAST_SCORE, UNKNOWN, learn
from starloom.llm.secret_scan import base_matches, scan, train
from starloom.llm.tokens import encoder
from starloom.llm.packing import TOKENIZER
from test_ngram_jaccard import brute as classes
from test_substring_dedup import brute as cut

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SF = "/root/testdata/sf0.001"


def texts(df):
    return sorted((r.doc_id, r.text) for r in df.select("doc_id", "text").collect())


@pytest.fixture(scope="module")
def documents(llm):
    secret = "if(doc_id % 20 = 3, concat(text, ' token = ', sha1(text), ' AKIA', upper(left(sha1(text), 16))), text) text"
    return llm.read.parquet(f"{SF}/documents.parquet").selectExpr("doc_id", secret, "lang", "source", "n_chars")


def expected(docs, llm):
    """Texts after each stage, from plain rows."""
    rows = texts(docs)
    told, score, *_ = learn(docs).texts(pa.array([t for _, t in rows], pa.large_string()))
    rows = [r for r, n, s in zip(rows, told, score, strict=True) if n != UNKNOWN and s >= LEAST_SCORE]
    yield rows
    heads = {}
    for (d, c, _), (i, t) in zip(classes(rows), sorted(rows), strict=True):
        if d == c:
            heads[d] = t
    yield (rows := sorted(heads.items()))
    made = {d: (n, k, t) for d, n, k, t in cut(rows)}
    yield (rows := [(d, t if not made[d][1] else made[d][2]) for d, t in rows if not made[d][0] or made[d][1] < made[d][0]])
    df = llm.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: [(s.start, s.end) for s in r.spans] for r in scan(df, train(base_matches(df))).collect()}
    out = []
    for d, t in rows:
        hidden, at = "", 0
        for a, b in spans[d]:
            if a >= at:
                hidden += t[at:a] + "[secret]"
            at = max(at, b)
        out.append((d, hidden + t[at:]))
    yield out


def check(docs, llm, columns):
    want = expected(docs, llm)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(llm, docs, SF)
        assert docs.columns == columns
        docs = llm.createDataFrame(docs.toArrow()) if docs.count() else docs
        rows = next(want)
        assert texts(docs) == rows, name
    packed = corpus_pipeline.STAGES[-1][1](llm, docs, SF).collect()
    coder = encoder(TOKENIZER)
    sizes = {d: len(np.frombuffer(coder.encode([t])[0], coder.dtype)) + 1 for d, t in rows}
    assert {r.doc_id: r.doc_tokens for r in packed} == sizes
    assert sum(r.length for r in packed) == sum(sizes.values())
    return rows


def test_documents(llm, documents):
    rows = check(documents, llm, COLUMNS)
    assert 0.5 * documents.count() < len(rows) < documents.count()
    assert any("[secret]" in t for _, t in rows)
    assert not any(re.search(r"AKIA[A-Z0-9]{16}|[0-9a-f]{24}", t) for _, t in rows)


def test_awkward_rows(llm, awkward_docs):
    docs = awkward_docs.withColumn("lang", awkward_docs.doc_id.cast("string").substr(9, 1))
    docs = docs.selectExpr("doc_id", "text", "if(doc_id % 2 = 0, 'en', 'de') lang", "source", "n_chars", *CLASHES)
    assert check(docs, llm, docs.columns)


def test_empty(llm, documents):
    docs = documents.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(llm, docs, SF)
        assert out.collect() == []


def test_run(llm):
    got = corpus_pipeline.run(llm, SF)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(got.columns) and got.count() > 0
