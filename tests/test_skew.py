"""Hot keys: the plans split them, the results stay whole."""

import pytest
from pyspark.sql import functions as F

from starloom.operators.joins import join_step
from starloom.operators.lookups import split_duplicates, tag_orphans
from starloom.operators.windows import neighbour_value, with_even_buckets
from starloom.specs import DimRef, JoinStep

SMALL_LIMITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
}


@pytest.fixture
def no_broadcast(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL_LIMITS}
    for k, v in SMALL_LIMITS.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture
def hot(no_broadcast):
    """60,000 facts over many input tasks, a third of them on key 0, some without key."""
    key = F.expr("CASE WHEN id % 3 = 0 THEN 0 WHEN id % 50 = 1 THEN NULL ELSE id % 997 END")
    return no_broadcast.range(0, 60_000, 1, 16).select(key.alias("k"), F.col("id"), F.sha2(F.col("id").cast("string"), 256).alias("body"))


def executed_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_hot_key_of_left_join_is_split(hot, no_broadcast):
    dim = no_broadcast.range(0, 900).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = join_step(hot, dim, JoinStep("dim", "k", "k"))
    assert "skew=true" in executed_plan(out)
    assert out.count() == 60_000 and out.filter("v = 0").count() == hot.filter("k = 0").count() > 20_000


def test_hot_key_of_full_join_is_split(hot, no_broadcast):
    dim = no_broadcast.range(0, 1500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    out = join_step(hot, dim, JoinStep("dim", "k", "k", "full"))
    assert "skew=true" in executed_plan(out)
    assert out.count() == 60_000 + 503


def test_hot_orphan_key_is_split(hot, no_broadcast):
    dim = no_broadcast.range(1, 900).select(F.col("id").alias("k"))
    out = tag_orphans(hot, {"D": dim}, [DimRef("D", "k")])
    assert "skew=true" in executed_plan(out)
    assert out.filter(F.size("missing_refs") > 0).count() == hot.filter("k = 0 or k >= 900").count()


def test_copies_of_one_row(hot):
    """A third of the incoming rows are copies of one stored row."""
    stored = hot.filter("id < 30000")
    copies = hot.withColumns({"id": F.when(F.col("k") == 0, 0).otherwise(F.col("id"))}).withColumn(
        "body", F.sha2(F.col("id").cast("string"), 256)
    )
    out = split_duplicates(copies, stored, "k")
    assert out.bad.count() + out.good.count() == 60_000
    assert out.bad.filter("k = 0").count() == hot.filter("k = 0").count() > 20_000


def test_one_order_value_is_cut_by_the_next_column(no_broadcast):
    """All rows of one key share the first order value (or have none): the groups stay even, the neighbours right."""
    df = no_broadcast.range(0, 20_000, 1, 8).select(
        F.lit(1).alias("k"), F.expr("if(id % 5 = 4, null, if(id % 5 = 3, id, 7))").alias("day"), F.concat(F.lit("t"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("name"), F.col("id").alias("v")
    )
    cut = with_even_buckets(df, ["day", "name"], "b", 20)
    assert cut.columns == [*df.columns, "b"]
    sizes = [r["count"] for r in cut.groupBy("b").count().collect()]
    assert max(sizes) <= 2 * 20_000 / 20
    # the buckets follow the order
    edges = sorted((r.b, r.low, r.high) for r in cut.groupBy("b").agg(F.min(F.struct("day", "name")).alias("low"), F.max(F.struct("day", "name")).alias("high")).collect())
    key = lambda x: (x.day is not None, x.day or 0, x.name)
    assert all(key(a[2]) < key(b[1]) for a, b in zip(edges, edges[1:]))
    got = neighbour_value(df, ["k"], ["day", "name"], "v", "before")
    rows = sorted(got.collect(), key=key)
    assert [r.before for r in rows] == [None, *[r.v for r in rows[:-1]]]
