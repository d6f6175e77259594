"""The subspace join against all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from starloom.llm.queries import QUERIES
from starloom.llm.subspace_join import Subspaces, near_vectors, unit_vectors

SCHEMA = "vec_id long, embedding array<float>, label int, node string, block string, component string"


def brute(rows, threshold=0.9):
    good = [i for i, (v, x) in enumerate(rows) if v is not None and x and None not in x and np.isfinite(x).all() and any(x)]
    parent, links = list(range(len(rows))), [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    unit = {i: unit_vectors(np.array([rows[i][1]], np.float64))[0] for i in good}
    for a, i in enumerate(good):
        for j in good[a + 1 :]:
            if len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    low = {}
    for i in good:
        low[root(i)] = min(low.get(root(i), rows[i][0]), rows[i][0])
    comp = [low[root(i)] if i in unit else v for i, (v, _) in enumerate(rows)]
    return sorted(((v, n, c, v is not None and v == c) for (v, _), n, c in zip(rows, links, comp, strict=True)), key=repr)


def found(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    """Clusters around the threshold, copies, scaled copies, and everything that links with nothing."""
    r = np.random.default_rng(5)
    base = r.normal(size=(12, 40))
    near = [base[k % 12] + r.normal(size=40) * r.choice([0.05, 0.3, 0.42, 0.5]) for k in range(150)]
    vectors = [*near, near[3], near[3], near[4] * 7, near[5] * -1, near[6] * 1e-20, *r.normal(size=(60, 40))]
    made = [(1000 - i, np.array(x, np.float32).tolist()) for i, x in enumerate(vectors)]
    odd = [(1, None), (2, []), (3, [0.0] * 40), (4, [1.0, None, *[0.0] * 38]), (5, [float("nan")] * 40), (6, [float("inf")] * 40), (None, made[0][1])]
    short = [(7, made[0][1][:8]), (8, made[0][1][:8]), (8, made[1][1][:8]), (8, made[2][1]), (8, made[2][1])]
    return made + odd + short


@pytest.fixture(scope="module")
def table(llm, rows):
    return llm.createDataFrame([(v, x, 1, "a", "b", "c") for v, x in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize("options", [{}, {"tile": 7}, {"tile": 50, "block_dims": 4}, {"block_dims": 100}])
def test_awkward_rows(table, rows, options):
    assert found(near_vectors(table, **options)) == brute(rows)


def test_other_threshold(table, rows):
    assert found(near_vectors(table, threshold=0.97, tile=20)) == brute(rows, 0.97)


def test_double_components(llm):
    rows = [(1, [1e300, 1e300]), (2, [1e-300, 1e-300]), (3, [1.0, -1.0]), (4, [5e-324, 0.0])]
    made = llm.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert found(near_vectors(made)) == brute(rows)


def test_axis_aligned_differences(llm):
    """Vectors that differ in one axis only: blocks tie at zero, and each pair counts once all the same."""
    rows = [(i, np.eye(32)[i % 4].tolist()) for i in range(4)]
    rows += [(10 + i, (np.eye(32)[0] + 0.1 * np.eye(32)[4 + i]).tolist()) for i in range(20)]
    made = llm.createDataFrame(rows, "vec_id long, embedding array<float>")
    rows = [(v, np.array(x, np.float32).tolist()) for v, x in rows]
    assert found(near_vectors(made, tile=5, block_dims=4)) == brute(rows)


def test_empty(table):
    assert near_vectors(table.limit(0)).collect() == []
    assert found(near_vectors(table.filter("vec_id = 3"))) == [(3, 0, 3, True)]


def test_budgets_add_up():
    r = np.random.default_rng(1)
    x = unit_vectors(r.normal(size=(500, 40)) * np.linspace(3, 0.1, 40))
    spaces = Subspaces(x.T @ x, 0.9, 16)
    assert len(spaces) == 2 and abs(spaces.budget.sum() - 0.2) < 1e-12
    assert np.allclose(spaces.axes.T @ spaces.axes, np.eye(40))
    assert sorted(np.concatenate([np.arange(a, b) for a, b in zip(spaces.starts, spaces.ends, strict=True)])) == list(range(40))


def test_query_against_all_pairs(llm):
    sf = "/root/testdata/sf0.01"
    got = {r[0]: tuple(r)[1:] for r in QUERIES["op11_subspace_join"](llm, sf).collect()}
    rows = llm.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    want = brute([tuple(r) for r in rows])
    assert got == {w[0]: w[1:] for w in want}
    docs = llm.read.parquet(f"{sf}/embeddings.parquet")
    copies = docs.unionByName(docs.filter("vec_id < 20").withColumn("vec_id", F.col("vec_id") + 10_000))
    assert found(near_vectors(copies, tile=100)) == brute([tuple(r) for r in copies.select("vec_id", "embedding").collect()])
