"""Base patterns and their positions against Python's re; random and ordinary tokens."""

import hashlib
import random
import re
import string

import pytest

from starloom.llm.secret_scan import base_matches, listed, scan, train

LETTERS = {c: f"[{c}{c.upper()}]" for c in string.ascii_lowercase}
WORDS = ["password", "passwd", "secret", "token", "api_?key"]
ANY_CASE = "|".join("".join(LETTERS.get(c, c) for c in w) for w in WORDS)
ASSIGN = re.compile(rf"""({ANY_CASE})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS, HEX = re.compile(r"AKIA[A-Z0-9]+"), re.compile(r"[0-9a-f]+")


def base(text):
    text = text or ""
    return {
        "assign": [m.span() for m in ASSIGN.finditer(text) if len(m[2]) >= 6],
        "access": [m.span() for m in ACCESS.finditer(text) if len(m[0]) >= 20],
        "hex": [m.span() for m in HEX.finditer(text) if len(m[0]) >= 24],
    }


def joined(spans):
    order = ("assign", "access", "hex", "markov")
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted((a, order.index(k), b, k) for k, own in spans.items() for a, b in own))


@pytest.fixture(scope="module")
def texts(awkward):
    r = random.Random(8)
    parts = ["token", "TOKEN", "ToKen", "secret", "api_key", "apikey", "passwd", "password", "ſecret", "toKen", "=", ":", " = ", '": "', "'", " ", "\n", "abc", "abcdef", "AKIA", "AKIAAKIA", "ABCDEFGH12", "XY", "deadbeef", "0123456789abcdef", "é", "漢😀", "-", ".", "q"]
    odd = ["".join(r.choice(parts) for _ in range(r.randrange(1, 40))) for _ in range(300)]
    return [t for _, t in awkward] + odd + ["token=abcdefg " * 500, "token=token:abcdefg", 'x secret = "' + "f" * 40 + '" y', "é" * 9 + "a" * 23 + "g" + "b" * 24]


@pytest.fixture(scope="module")
def docs(llm, texts):
    return llm.createDataFrame([(i, t, "x", "y") for i, t in enumerate(texts)], "doc_id long, text string, spans string, hex string").repartition(3)


def test_base_spans(docs, texts):
    got = {r.doc_id: r for r in scan(docs).withColumn("listed", listed()).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        want = base(t)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(map(len, want.values())), t
        assert got[i].base_sha256 == hashlib.sha256(joined(want).encode()).hexdigest()
        # the method adds spans, those of the patterns stay
        more = [(s.start, s.end) for s in got[i].spans if s.kind == "markov"]
        assert got[i].n_markov == len(more)
        assert got[i].listed == joined({**want, "markov": more})
        assert not any(a < y and x < b for a, b in more for own in want.values() for x, y in own)


def test_random_and_ordinary_tokens(llm, awkward):
    r = random.Random(2)
    prose = " ".join(t for _, t in awkward if t and len(t) > 200)[:60_000]
    values = ["".join(r.choice(string.ascii_letters + string.digits) for _ in range(32)) for _ in range(40)]
    rows = [(i, prose[i * 800 : (i + 1) * 800]) for i in range(60)] + [(100 + i, f"x token = {v} y") for i, v in enumerate(values[:20])]
    rows += [(200 + i, f"see {v} there") for i, v in enumerate(values[20:])] + [(300, "4348649190265535123456"), (301, "the-river-of-light-and-stone and greenhillswatchbirds")]
    got = {x.doc_id: x for x in scan(llm.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert sum(got[200 + i].n_markov == 1 for i in range(20)) >= 19
    assert all((s.start, s.end) == (4, 36) for i in range(20) for s in got[200 + i].spans)
    assert all(got[i].n_markov == 0 for i in [*range(60), 300, 301])
    assert all(got[100 + i].n_assign == 1 and got[100 + i].n_markov == 0 for i in range(20))


def test_table(llm, no_docs):
    table = train(base_matches(no_docs))
    assert len(table) == 128 * 128 and set(table) == {0.0} or max(map(abs, table)) < 1e-9
    assert scan(no_docs).collect() == []


def test_native(docs):
    plan = scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
