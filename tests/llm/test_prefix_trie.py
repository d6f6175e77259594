"""The burst trie against a plain dictionary of prefixes."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starloom.llm.prefix_trie import PACKED, prefix_trie, shared_openings, trie_nodes, turn_lists

SCHEMA = "conv_id long, turn long, role string, text string, head string, seq string, low string, depth int, up int"


def conversations(rows):
    made = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            made[c].append((turn is not None, turn or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(t, key=lambda x: x[:2])] for c, t in made.items()}


def opened(made):
    out = {}
    for c, turns in made.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = made.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute(made):
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in members:
        if path:
            children[path[:-1]] += 1
    for path, who in members.items():
        for d in range(len(path) + 1):
            leaves[path[:d]] += path not in children
            saved[path[:d]] += (len(who) - 1) * len(path[-1][1]) if path else 0
    return sorted(
        (
            (min(who), len(p), min(members[p[:-1]]) if p else None, len(who), children.get(p, 0), leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
            for p, who in members.items()
        ),
        key=repr,
    )


def found(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    out = []
    for c in [*range(60), *range(100, 160), *range(205, 230), *range(1000, 1012)]:
        # few different turns, so that conversations share much
        out += [(c, k if k else None, r.choice(["user", None, ""]), r.choice(["a", "bé", None, "", "x" * 9])) for k in range(r.randrange(1, 9))]
    out += [(c, k, "user", f"same {k}") for c in range(300, 380) for k in range(4)]
    out += [(c, k, "user", f"long {k}") for c in (400, 401) for k in range(300 + c)]
    out += [(c, k, "user", f"nested {k}") for c in range(500, 520) for k in range(c - 499)]
    return [*out, (None, 1, "user", "nobody's"), (7, 99, "漢", "漢字 text")]


@pytest.fixture(scope="module")
def table(llm, rows):
    return llm.createDataFrame([(*x, "h", "s", "l", 1, 2) for x in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("options", [{}, {"container": 3}, {"container": 40}, {"container_bytes": 3000}])
def test_nodes(table, rows, options):
    assert found(prefix_trie(table, **options)) == brute(conversations(rows))


def test_shared_openings(table, rows):
    assert found(trie_nodes(shared_openings(turn_lists(table)), container=5)) == brute(opened(conversations(rows)))


def test_hot_conversation_in_packed_rows(llm):
    """More copies than a packed row holds, in several partitions: one digest of all their ids, in order."""
    n = 2 * PACKED + 100
    copies = llm.range(n).select(F.col("id").alias("conv_id"), F.lit(0).alias("turn"), F.lit("user").alias("role"), F.lit("hello").alias("text"))
    assert found(prefix_trie(copies)) == brute({c: [("user", "hello")] for c in range(n)})


def test_ties_and_repeated_rows(llm):
    """Equal turns have an order of their own, whatever the order of the rows."""
    rows = [(1, 0, "u", "a"), (1, 0, "u", "b"), (1, 0, "u", "a"), (2, 0, "u", "b"), (2, 0, "u", "a"), (2, 0, "u", "a")]
    made = llm.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(4)
    got = found(prefix_trie(made))
    assert [r[1:5] for r in got if r[1] == 3] == [(3, 1, 2, 0)] and len(got) == 4


def test_empty(table):
    assert prefix_trie(table.limit(0)).collect() == []
    only = prefix_trie(table.filter("conv_id = 1000").filter("turn is null")).collect()
    assert [r.depth for r in only] in ([0, 1], [1, 0])
