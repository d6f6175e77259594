"""Measurements, bits, policies and ablations against plain Python."""

import random
import re
from collections import Counter

import pytest

from starloom.llm.quality_ledger import BASE_RULES, POLICIES, RULES, ablations, ledger, mask, measurements, verdicts


def measured(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    count = Counter(windows)
    covered = {j for i, x in enumerate(windows) if count[x] > 1 for j in range(i, i + 3)}
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_capitals": len(re.findall("[A-Z]", text)),
        "n_exclamations": len(re.findall("[!?]", text)),
        "n_repeat_words": len(covered),
    }


def failed(m):
    return sum(1 << k for k, rule in enumerate(RULES.values()) if eval(rule, {}, m))


@pytest.fixture(scope="module")
def texts(awkward):
    r = random.Random(4)
    odd = ["".join(r.choice(["a", "b", " ", " ", "\n", "\t", "#", "|", "é", "!", "A", "漢", "\x0b", "a b c ", "\n\n"]) for _ in range(r.randrange(0, 120))) for _ in range(150)]
    return [t for _, t in awkward] + odd + ["LOUD WORDS! " * 60, "x y z\n" * 30, "w" * 3000 + " a" * 55, " ".join(f"v{i}" for i in range(60))]


@pytest.fixture(scope="module")
def docs(llm, texts):
    return llm.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, words string, failed string").repartition(3)


def test_measurements(docs, texts):
    got = {r.doc_id: r.asDict() for r in measurements(docs).collect()}
    assert [got[i] for i in range(len(texts))] == [{"doc_id": i, **measured(t)} for i, t in enumerate(texts)]


def test_bits_and_verdicts(docs, texts):
    got = {r.doc_id: r for r in verdicts(docs).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        bits = failed(measured(t))
        assert (got[i].failed, got[i].base_failed, got[i].kept) == (bits, bits & mask(*BASE_RULES) != 0, bits == 0)
    assert any(r.kept for r in got.values()) and {1 << k for k in range(len(RULES))} <= {r.failed & (1 << k) for r in got.values() for k in range(len(RULES))}


def test_ablations(docs, texts):
    bits = [failed(measured(t)) for t in texts]
    got = {(r.policy, r.rule): (r.n_failed, r.n_only, r.n_kept, r.n_kept_without) for r in ablations(ledger(docs)).collect()}
    want = {}
    for p in POLICIES:
        for k, rule in enumerate(RULES):
            if p.mask >> k & 1:
                counted = [b & p.mask for b in bits]
                want[p.version, rule] = (sum(b >> k & 1 for b in counted), sum(b == 1 << k for b in counted), counted.count(0), sum(b & ~(1 << k) == 0 for b in counted))
    assert got == want


def test_verdicts_hold_their_ablation(docs, texts):
    bits = [failed(measured(t)) for t in texts]
    for policy in POLICIES:
        counted = [b & policy.mask for b in bits]
        got = {r.doc_id: r for r in verdicts(docs, policy).collect()}
        assert len(got) == len(texts)
        for i, b in enumerate(bits):
            sole = [r for k, r in enumerate(RULES) if counted[i] == 1 << k]
            want = (sole[0], counted.count(counted[i]), counted.count(0) + counted.count(counted[i])) if sole else (None, None, None)
            assert (got[i].sole_rule, got[i].n_only, got[i].n_kept_without) == want
            assert got[i].kept_by == ",".join(p.version for p in POLICIES if b & p.mask == 0)
    assert any(r.sole_rule for r in got.values())


def test_empty_and_plan(docs, no_docs):
    assert verdicts(no_docs).collect() == []
    plan = ledger(docs.sparkSession.createDataFrame([(1, "a")], "doc_id long, text string"))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Python", "Arrow", "Pandas"))
    many = ledger(docs.limit(0).union(docs.limit(1)).union(docs.limit(1)))
    assert many.count() == 2
