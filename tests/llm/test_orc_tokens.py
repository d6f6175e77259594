"""Token files: a round trip, their order, and what a lookup reads."""

import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow.orc as orc
from tokenizers import Tokenizer

from starloom.llm.orc_tokens import checksums, lookup, read_tokens, write_tokens

PLAIN = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_round_trip(llm, awkward_docs, awkward, tmp_path):
    write_tokens(awkward_docs, path := str(tmp_path / "tokens"))
    got = sorted(map(tuple, checksums(read_tokens(llm, path)).collect()), key=lambda r: r[1])
    want, start = [], 0
    for d, t in sorted(((d, t or "") for d, t in awkward)):
        ids = [*PLAIN.encode(t, add_special_tokens=False).ids, 1]
        want.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert got == want


def test_files_are_in_order_and_indexed(llm, awkward_docs, tmp_path):
    write_tokens(awkward_docs, path := str(tmp_path / "tokens"))
    files = [orc.ORCFile(p) for p in sorted(Path(path).glob("*.orc"))]
    ids = [f.read(columns=["doc_id"]).column(0).to_pylist() for f in files if f.nrows]
    flat = [x for own in ids for x in own]
    assert flat == sorted(flat) and len(flat) == 34
    assert all(f.row_index_stride == 1000 for f in files)
    found = lookup(llm, path, [8, 9])
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString()
    assert sorted((r.doc_id, r.n_tokens) for r in found.collect()) == [(8, 3), (9, 3)]


def scanned(df):
    """Rows that the scan has given on."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return sum(plan.collectLeaves().apply(i).metrics().apply("numOutputRows").value() for i in range(plan.collectLeaves().size()))


def test_bloom_filters_skip_rows(llm, tmp_path):
    """An id within the range of a row group, but not in it, is skipped by the filter and only by it."""
    docs = llm.createDataFrame([(2 * i, "a") for i in range(3000)], "doc_id long, text string")
    write_tokens(docs, path := str(tmp_path / "tokens"))
    llm.read.orc(path).coalesce(1).sort("doc_id").write.option("orc.row.index.stride", "1000").orc(plain := str(tmp_path / "plain"))
    absent = [2 * i + 1 for i in (70, 900, 1700, 2950)]
    skipped, read = (sum(scanned(lookup(llm, p, [x])) for x in absent) for p in (path, plain))
    assert skipped < 0.2 * read
    # present ids cost their row group, not the table
    assert 0 < scanned(lookup(llm, path, [1400])) <= 1000 and lookup(llm, path, [1400]).count() == 1


def test_empty(llm, no_docs, tmp_path):
    write_tokens(no_docs, path := str(tmp_path / "tokens"))
    assert read_tokens(llm, path).collect() == []
