import random
from collections import Counter, defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.functions.rules import email_ok, in_range, one_of
from starloom.operators import finders
from starloom.operators.joins import Edge, cross_filter_all, cross_filter, join_chain, join_step, star_join
from starloom.operators.lookups import (
    split_duplicates,
    split_orphans,
    split_tagged_orphans,
    stored_candidates,
    tag_orphans_by_missing_keys,
)
from starloom.operators.measures import Dim, Measure, aggregate, measure_query
from starloom.operators.merge import (
    delete_by_id,
    delete_matching,
    merge_small_update,
    merge_upsert,
    scd2_counts,
    scd2_merge,
    soft_delete,
    soft_delete_customer,
    update_by_id,
)
from starloom.operators.metrics import batch_rollup, null_counts, quality_metrics, threshold_alerts, with_rates
from starloom.operators.quarantine import expire_orphans, numbered_copies, retry_orphans, to_orphans, to_rejected, unpack
from starloom.operators.shape import align_to, drop_repeated_names, filter_not_equal, hierarchy_slicer, keep_columns
from starloom.operators.validation import schema_errors, split_rows, validate
from starloom.operators.windows import latest_per_key, neighbour_value, reopened_by_transition, reopened_events, with_even_buckets
from starloom.sources.tables import BatchTable
from starloom.specs import DimRef, JoinStep, Rule, SourceSpec, columns

slow = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


# ---- validation: the corrupted customers


CUSTOMERS = SourceSpec(
    "customers",
    "customers.csv",
    columns("customer_id int, full_name string, phone bigint, segment_id int, gender string, is_current boolean"),
    required=("customer_id", "full_name"),
)


@pytest.fixture
def corrupted(spark):
    data = [
        (None, "Ann", "20100000001", "1", "f", "true"),
        ("2", "Bob", "20100000002", "bad_segment", "m", "true"),
        ("corrupted", "Cid", "20100000003", "1", "m", "true"),
        ("4", "Dee", "20100000004", "2", "f", "yes"),
        ("5", "Eve", "20100000005", "2", "f", "False"),
        (None, None, "x", "x", "x", "x"),
    ]
    return spark.createDataFrame(
        data, "customer_id string, full_name string, phone string, segment_id string, gender string, is_current string"
    )


def test_row_split_reasons(corrupted, rows):
    out = validate(corrupted, CUSTOMERS)
    assert rows(out.good) == [(5, "Eve", 20100000005, 2, "f", False)]
    reasons = {r.rejected_reason for r in out.bad.collect()}
    assert reasons == {
        "no value in customer_id",
        "no value in customer_id, full_name",
        "segment_id is not of type int",
        "customer_id is not of type int",
        "is_current is not of type bool",
    }
    assert tuple(out.metrics.first()) == (6, 1, 2, 3)


def test_schema_gate(spark, corrupted):
    assert schema_errors(corrupted, CUSTOMERS) == []
    assert schema_errors(corrupted.drop("full_name"), CUSTOMERS) == ["lacks the columns ['full_name']"]
    broken = corrupted.withColumn("segment_id", F.lit("none"))
    assert schema_errors(broken, CUSTOMERS) == ["no value of segment_id is of type int"]
    empty = corrupted.withColumn("segment_id", F.lit(None).cast("string"))
    assert schema_errors(empty, CUSTOMERS) == []


def test_rules_reject_rows(spark, rows):
    spec = SourceSpec(
        "t",
        "t.csv",
        columns("email string, rating double, status string"),
        rules=(
            Rule("email", "email", email_ok),
            Rule("rating", "rating", lambda c: in_range(c.try_cast("double"), 0, 5)),
            Rule("status", "status", lambda c: one_of(c, ("open", "closed"))),
        ),
    )
    df = spark.createDataFrame(
        [("a@b.c", "4", "open"), ("bad", "4", "open"), ("a@b.c", "6", "open"), ("a@b.c", "1", "odd"), (None, None, None)],
        "email string, rating string, status string",
    )
    out = split_rows(df, spec)
    assert out.good.count() == 2
    assert sorted(r.rejected_reason for r in out.bad.collect()) == [
        "Rule 'email' failed on 'email'",
        "Rule 'rating' failed on 'rating'",
        "Rule 'status' failed on 'status'",
    ]


# ---- joins


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (4, "d")], "k int, name string")
    right = spark.createDataFrame([(1, "A"), (1, "AA"), (3, "C"), (None, "N")], "k int, name string")
    return left, right


@pytest.mark.parametrize(
    "how, want",
    [
        ("left", [(1, "a", "A"), (1, "a", "AA"), (2, "b", None), (4, "d", None), (None, "c", None)]),
        ("inner", [(1, "a", "A"), (1, "a", "AA")]),
        ("right", [(1, "a", "A"), (1, "a", "AA"), (3, None, "C"), (None, None, "N")]),
        (
            "full",
            [(1, "a", "A"), (1, "a", "AA"), (2, "b", None), (3, None, "C"), (4, "d", None), (None, "c", None), (None, None, "N")],
        ),
    ],
)
def test_join_types_and_suffix(sides, rows, how, want):
    out = join_step(*sides, JoinStep("r", "k", "k", how))
    assert out.columns == ["k", "name", "name_r"]
    assert rows(out) == sorted(want, key=repr)


def test_join_null_safe(sides, rows):
    out = join_step(*sides, JoinStep("r", "k", "k", "full"), null_safe=True)
    assert (None, "c", "N") in rows(out) and len(rows(out)) == 6


def test_join_different_key_names_keeps_both(spark, rows):
    left = spark.createDataFrame([(1, 9)], "a int, b int")
    right = spark.createDataFrame([(1, 7)], "b int, c int")
    out = join_step(left, right, JoinStep("r", "a", "b"))
    assert out.columns == ["a", "b", "b_r", "c"] and rows(out) == [(1, 9, 1, 7)]


def test_join_errors(sides):
    left, right = sides
    with pytest.raises(ValueError, match="unsupported join type"):
        join_step(left, right, JoinStep("r", "k", "k", "cross"))
    with pytest.raises(ValueError, match="not found"):
        join_chain(left, {}, [JoinStep("r", "k", "k")])
    assert join_chain(left, {}, []) is left


def test_star_join_and_cross_filter(spark, rows):
    fact = spark.createDataFrame([(1, 10, 5.0), (2, 11, 6.0), (3, None, 7.0)], "id int, dim_id int, x double")
    dim = spark.createDataFrame([(10, "ten", 1.0), (12, "twelve", 2.0)], "dim_id int, name string, x double")
    out = star_join(fact, {"D": dim}, [DimRef("D", "dim_id"), DimRef("DateDim", ("a", "b"))])
    assert rows(out, "id", "name", "x", "x_D") == sorted([(1, "ten", 5.0, 1.0), (2, None, 6.0, None), (3, None, 7.0, None)], key=repr)
    assert rows(cross_filter(dim, fact, "dim_id", "dim_id"), "dim_id") == [(10,)]


# ---- orphans and duplicates


@pytest.fixture
def fact_and_dims(spark):
    fact = spark.createDataFrame(
        [("t1", 1, 10), ("t2", 2, 10), ("t3", 9, 99), ("t4", None, 10), ("t5", 9, None), ("t2", 2, 10)], "id string, c int, d int"
    )
    dims = {
        "C": spark.createDataFrame([("1",), ("2",), ("2",)], "c string"),
        "D": spark.createDataFrame([(10,), (11,)], "d int"),
    }
    return fact, dims, [DimRef("C", "c"), DimRef("D", "d"), DimRef("E", "absent"), DimRef("DateDim", ("x", "y"))]


@pytest.mark.parametrize("large", [False, True])
def test_orphan_split(fact_and_dims, rows, large):
    fact, dims, refs = fact_and_dims
    out = split_tagged_orphans(tag_orphans_by_missing_keys(fact, dims, refs)) if large else split_orphans(fact, dims, refs)
    assert rows(out.good, "id") == [("t1",), ("t2",), ("t2",), ("t4",)]
    bad = {r.id: (r.orphan_reason, [tuple(m) for m in r.missing_refs]) for r in out.bad.collect()}
    assert bad == {
        "t3": ("c is not in C; d is not in D; ", [("C", "c", "9"), ("D", "d", "99")]),
        "t5": ("c is not in C; ", [("C", "c", "9")]),
    }


def test_orphan_split_of_nothing(spark, fact_and_dims):
    fact, dims, refs = fact_and_dims
    out = split_orphans(fact.filter("false"), dims, refs)
    assert out.good.count() == 0 and out.bad.count() == 0


def test_duplicate_split_is_null_safe(spark, rows):
    stored = spark.createDataFrame([(1, None, "a", "h"), (2, 1.0, "b", "h"), (3, 1.0, "c", "h")], "k int, x double, s string, pii string")
    new = spark.createDataFrame(
        [(1, None, "a", "other"), (2, None, "b", "h"), (3, 1.0, "c", "h"), (3, 1.0, "c", "h"), (4, 1.0, "d", "h"), (None, 1.0, "c", "h")],
        "k int, x double, s string, pii string",
    )
    out = split_duplicates(new, stored, "k", ["pii"])
    assert rows(out.bad, "k", "pii") == [(1, "other"), (3, "h"), (3, "h")]
    assert rows(out.good, "k") == sorted([(2,), (4,), (None,)], key=repr)


def test_stored_candidates_read_only_the_hit_folders(spark, tmp_path, rows):
    store = BatchTable(spark, str(tmp_path / "t"), columns("k int, day int, v string"), partition_by=("day",))
    data = [(1, 20240101, "a"), (2, 20240102, "b"), (3, 20240103, "c"), (4, None, "d")]
    store.append(spark.createDataFrame(data, "k int, day int, v string"), "b1")
    new = spark.createDataFrame([(2, 20240109, "b"), (4, None, "d"), (9, 20240101, "x"), (None, None, "n")], "k int, day int, v string")
    found = stored_candidates(new, store.read(), "k", ["day"])
    assert rows(found) == sorted([(2, 20240102, "b"), (4, None, "d")], key=repr)
    only = stored_candidates(new.filter("k = 2"), store.read(), "k", ["day"])
    assert rows(only) == [(2, 20240102, "b")]
    assert "PartitionFilters: [isnotnull(day" in only._jdf.queryExecution().executedPlan().toString()
    assert stored_candidates(new.filter("k = 9"), store.read(), "k", ["day"]).count() == 0
    # the date is not compared, so a row moved to another day is still a duplicate
    out = split_duplicates(new, found, "k", ["day"])
    assert rows(out.bad, "k") == [(2,), (4,)]


@slow
@given(st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 2))), max_size=20), st.data())
def test_splits_keep_every_row(spark, data, more):
    stored = more.draw(st.lists(st.tuples(st.integers(0, 4), st.one_of(st.none(), st.integers(0, 2))), max_size=10))
    df = spark.createDataFrame(data, "k int, v int")
    dups = split_duplicates(df, spark.createDataFrame(stored, "k int, v int"), "k")
    both = Counter(map(tuple, dups.good.collect())) + Counter(map(tuple, dups.bad.collect()))
    assert both == Counter(data)
    assert Counter(map(tuple, dups.bad.collect())) == Counter(r for r in data if r in set(stored))
    orph = split_orphans(df, {"V": spark.createDataFrame([(0,), (1,)], "v int")}, [DimRef("V", "v")])
    assert Counter(map(tuple, orph.good.collect())) == Counter(r for r in data if r[1] in (None, 0, 1))
    assert orph.good.count() + orph.bad.count() == len(data)


# ---- table changes


@pytest.fixture
def agents(spark):
    return spark.createDataFrame(
        [(1, "Ann", 5, True), (2, "Bob", 5, True), (3, "Cid", 6, True)], "agent_id int, name string, team_id int, is_active boolean"
    )


def test_merge(spark, agents, rows):
    new = spark.createDataFrame([(2, None), (4, "Dee")], "agent_id int, name string")
    want = sorted([(1, "Ann", 5, True), (2, None, 5, True), (3, "Cid", 6, True), (4, "Dee", None, None)], key=repr)
    once = merge_upsert(agents, new, "agent_id")
    assert rows(once) == want
    assert rows(merge_upsert(once, new, "agent_id")) == want
    assert rows(merge_small_update(agents, new, "agent_id")) == want
    with pytest.raises(ValueError):
        merge_upsert(agents, new.withColumn("odd", F.lit(1)), "agent_id")


def test_update_delete(spark, agents, rows):
    assert rows(update_by_id(agents, "agent_id", 1, {"name": "Zoe"}), "name") == [("Bob",), ("Cid",), ("Zoe",)]
    assert rows(delete_by_id(agents, "agent_id", 1), "agent_id") == [(2,), (3,)]
    assert rows(soft_delete(agents, F.col("agent_id") == 2).filter("not is_active"), "agent_id") == [(2,)]
    assert rows(delete_matching(agents, {"team_id": 5, "name": "Bob"}), "agent_id") == [(1,), (3,)]
    with pytest.raises(ValueError):
        delete_matching(agents, {})
    customers = spark.createDataFrame([(1, True, 5.0)], "customer_id int, priority_support boolean, discount_pct double")
    assert rows(soft_delete_customer(customers, 1)) == [(1, False, 0.0)]


def test_scd2(spark, rows):
    empty = spark.createDataFrame(
        [], "id int, name string, surrogate_key string, valid_from date, valid_to date, is_current boolean"
    )
    day1 = spark.createDataFrame([(1, "a"), (2, "b")], "id int, name string")
    day2 = spark.createDataFrame([(1, "a"), (2, "B"), (3, "c")], "id int, name string")
    h1 = scd2_merge(empty, day1, "id", ["name"], F.expr("date '2024-01-01'"))
    assert tuple(scd2_counts(h1, day2, "id", ["name"]).first()) == (1, 1, 1)
    h2 = scd2_merge(h1, day2, "id", ["name"], F.expr("date '2024-01-02'"))
    out = [(r.id, r.name, str(r.valid_from), str(r.valid_to), r.is_current) for r in h2.collect()]
    assert sorted(out) == [
        (1, "a", "2024-01-01", "None", True),
        (2, "B", "2024-01-02", "None", True),
        (2, "b", "2024-01-01", "2024-01-02", False),
        (3, "c", "2024-01-02", "None", True),
    ]
    assert h2.select("surrogate_key").distinct().count() == 4
    again = scd2_merge(h2, day2, "id", ["name"], F.expr("date '2024-01-03'"))
    assert rows(again) == rows(h2)


# ---- windows


def test_latest_per_key(spark, rows):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "b"), (2, 2, "c")], "k int, t int, v string")
    assert rows(latest_per_key(df, ["k"], [F.col("t").desc()]), "v") == [("b",), ("c",)]


def test_latest_per_key_limits_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 as k", "id as t")
    plan = latest_per_key(df, ["k"], [F.col("t").desc()])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("even", [False, True])
@pytest.mark.parametrize("following", [False, True])
def test_neighbour_value_against_brute_force(spark, following, even):
    rng = random.Random(7)
    # one key holds most of the rows; some buckets are empty, some values null
    data = [
        (0 if rng.random() < 0.7 else rng.randrange(1, 5), rng.choice([None, *range(60)]), i, rng.choice(["x", "y", None]))
        for i in range(400)
    ]
    df = spark.createDataFrame(data, "k int, t int, i int, v string")
    bucket = None if even else F.coalesce(F.floor(F.col("t") / 10), F.lit(-1))
    got = neighbour_value(df, ["k"], ["t", "i"], "v", "n", bucket, following)
    by_key = defaultdict(list)
    for r in sorted(data, key=lambda r: (-1 if r[1] is None else r[1], r[2]), reverse=following):
        by_key[r[0]].append(r)
    want = {r[2]: (prev[3] if prev else None) for rs in by_key.values() for prev, r in zip([None, *rs], rs)}
    assert {r.i: r.n for r in got.collect()} == want


def test_neighbour_of_nothing(spark, rows):
    none = spark.createDataFrame([], "k int, t int, v string")
    assert neighbour_value(none, ["k"], ["t"], "v", "n").count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (1, None, "b")], "k int, t int, v string")
    assert rows(neighbour_value(blank, ["k"], ["t", "v"], "v", "n"), "v", "n") == [("a", None), ("b", "a")]


def test_even_buckets_bound_the_groups(spark):
    # one key has a third of all rows, all of them within one day
    df = spark.range(3000).selectExpr(
        "if(id % 3 = 0, 0, id) as k", "timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id / 100) as t"
    )
    cut = with_even_buckets(df, "t", "b", 30)
    sizes = [r["count"] for r in cut.groupBy("b").count().collect()]
    assert len(sizes) == 30 and max(sizes) <= 3000 / 30 * 1.5
    assert cut.groupBy("k", "b").count().agg(F.max("count")).first()[0] <= 3000 / 30 / 3 * 1.5


def test_reopened(spark, rows):
    data = [("t", 1, "open"), ("t", 2, "resolved"), ("t", 3, "open"), ("t", 4, "closed"), ("u", 1, "open")]
    df = spark.createDataFrame(data, "id string, at int, status string")
    out = reopened_events(df, "id", ["at"], "status", F.floor(F.col("at") / 2))
    assert rows(out.filter("is_reopened"), "id", "at") == [("t", 3)]
    events = spark.createDataFrame([("t", "resolved", "open"), ("t", None, "open"), ("u", "open", "closed")], "id string, old_status string, new_status string")
    assert rows(reopened_by_transition(events, "id")) == [("t", True), ("u", False)]


# ---- quarantine


def now():
    return F.expr("timestamp_ntz '2024-01-10 00:00:00'")


SCHEMA = columns("id string, c int, d int")


def test_retry_needs_every_reference(spark, fact_and_dims, rows):
    fact, dims, refs = fact_and_dims
    held = to_orphans(split_orphans(fact, dims, refs).bad, "Fact", now(), F.lit("f.csv"))
    assert rows(held, "source_table", "orphaned_fk_column", "orphaned_fk_value") == [("C", "c", "9"), ("C", "c", "9"), ("D", "d", "99")]
    # the customer arrives: t5 can be loaded, t3 still waits for its second reference
    some = {"C": (spark.createDataFrame([("9",)], "c string"), "c"), "D": (dims["D"], "d")}
    first = retry_orphans(held, some, "Fact", "id")
    assert rows(unpack(first.good, "record_payload", SCHEMA)) == [("t5", 9, None)]
    assert rows(first.bad, "source_table", "orphaned_fk_value") == [("D", "99")]
    # then the second dimension: t3 is loaded once although two references were missing
    rest = {**some, "D": (spark.createDataFrame([(99,)], "d int"), "d")}
    assert rows(unpack(retry_orphans(held, rest, "Fact", "id").good, "record_payload", SCHEMA)) == [("t3", 9, 99), ("t5", 9, None)]
    assert retry_orphans(first.bad, rest, "Fact", "id").good.count() == 1


def test_rejected_keeps_each_reason(spark, rows):
    df = spark.createDataFrame([(1, "r1"), (2, "r2")], "id int, rejected_reason string")
    out = to_rejected(df, "customers.csv", now())
    assert rows(out, "record_payload", "rejected_reason", "batch_source") == [('{"id":1}', "r1", "customers.csv"), ('{"id":2}', "r2", "customers.csv")]
    assert out.select("rejected_id").distinct().count() == 2


def test_cross_filter_directions(spark, rows):
    tables = {
        "region": spark.createDataFrame([(1,), (2,)], "r int"),
        "shop": spark.createDataFrame([(1, 1), (2, 2), (3, 1)], "s int, r int"),
        "sale": spark.createDataFrame([(1, 7), (2, 7), (3, 8), (None, 9)], "s int, g int"),
        "good": spark.createDataFrame([(7,), (8,), (9,)], "g int"),
    }
    edges = [Edge("shop", "r", "region", "r"), Edge("sale", "s", "shop", "s"), Edge("sale", "g", "good", "g", both=True)]
    left = cross_filter_all(tables, edges, {"region": F.col("r") == 1})
    assert {t: rows(d) for t, d in left.items()} == {"region": [(1,)], "shop": [(1, 1), (3, 1)], "sale": [(1, 7), (3, 8)], "good": [(7,), (8,)]}
    # a filter on goods reaches the sales, and not the shops, which do not listen
    left = cross_filter_all(tables, edges, {"good": F.col("g") == 8})
    assert rows(left["sale"]) == [(3, 8)] and left["shop"].count() == 3 and left["region"].count() == 2
    with pytest.raises(ValueError, match="circle"):
        cross_filter_all(tables, [*edges, Edge("good", "g", "region", "r")], {})


def test_numbered_copies(spark, rows, monkeypatch):
    monkeypatch.setattr("starloom.operators.quarantine._COPIES", 3)
    df = spark.createDataFrame([("a", 1)] * 8 + [("a", None)] * 3 + [("b", 1)], "s string, x int").repartition(3)
    want = [("a", 1, i) for i in range(1, 9)] + [("a", None, i) for i in range(1, 4)] + [("b", 1, 1)]
    assert rows(numbered_copies(df, "occurrence")) == sorted(want, key=repr)


def test_copies_of_few_rows_are_spread(spark):
    df = spark.range(50_000).select(F.lit("a").alias("x"))
    parts = numbered_copies(df, "occurrence").groupBy(F.spark_partition_id()).count().collect()
    assert sum(r["count"] for r in parts) == 50_000 and len(parts) > 4


def test_orphan_retention(spark, rows):
    df = spark.sql(
        "select * from values (1, timestamp_ntz'2024-01-01', false), (2, timestamp_ntz'2024-01-01', true), "
        "(3, timestamp_ntz'2024-01-09', false), (4, null, false), (5, timestamp_ntz'2024-01-08', false) as t(id, quarantined_at, resolved)"
    )
    assert rows(expire_orphans(df, now()), "id") == [(2,), (3,), (4,), (5,)]


# ---- metrics: the audit batch


def test_quality_metrics_and_rollup(spark, rows):
    outcomes = (
        [("orders", o) for o in ("passed", "passed", "passed", "orphan", "null")]
        + [("tickets", o) for o in ("passed", "passed", "orphan", "orphan")]
        + [("events", "passed")] * 3
    )
    tagged = spark.createDataFrame([("b1", *o) for o in outcomes], "batch_id string, file_name string, outcome string")
    m = quality_metrics(tagged, ["batch_id", "file_name"])
    assert rows(m, "file_name", "total_records", "passed_count", "orphan_count", "null_count", "quarantined_count") == [
        ("events", 3, 3, 0, 0, 0),
        ("orders", 5, 3, 1, 1, 2),
        ("tickets", 4, 2, 2, 0, 2),
    ]
    rates = {r.file_name: (r.orphan_rate, r.null_rate, r.referential_integrity_rate, r.bad_rows) for r in with_rates(m).collect()}
    assert rates == {"events": (0.0, 0.0, 100.0, 0), "orders": (20.0, 20.0, 75.0, 0), "tickets": (50.0, 0.0, 50.0, 0)}
    total = batch_rollup(m.withColumn("file_success", F.col("file_name") != "events")).first()
    assert (total.files_processed, total.files_failed, total.files_with_issues, total.total_records) == (3, 1, 2, 12)
    # exactly one half is not above the threshold
    assert threshold_alerts(m).count() == 0
    assert rows(threshold_alerts(m, 0.4), "file_name", "orphan_share") == [("tickets", 0.5)]


def test_null_counts(spark, rows):
    df = spark.createDataFrame([(1, None), (None, None)], "a int, b string")
    assert rows(null_counts(df)) == [("a", 1), ("b", 2)]


# ---- measures


def test_measures_match_direct_aggregation(spark, rows):
    rng = random.Random(3)
    # a third of the facts on one key, some keys without dimension row, some null
    data = [(i, 1 if i % 3 == 0 else rng.choice([2, 3, 9, None]), float(rng.randrange(100)), rng.random() < 0.5) for i in range(300)]
    fact = spark.createDataFrame(data, "ticket_id int, d int, resolution_time_min double, sla_resolution_breached boolean")
    dim = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "d int, name string")
    names = ["total_tickets", "sla_breach_rate", "avg_resolution_time"]
    got = measure_query(fact, ["name"], names, {"D": Dim(dim, "d", "d")})
    groups = defaultdict(list)
    label = {1: "a", 2: "b", 3: "b"}
    for r in data:
        groups[label.get(r[1])].append(r)
    want = [(k, len(v), sum(r[3] for r in v) / len(v), sum(r[2] for r in v) / len(v)) for k, v in groups.items()]
    assert [(a, b, round(c, 9), round(d, 9)) for a, b, c, d in rows(got)] == sorted(
        [(a, b, round(c, 9), round(d, 9)) for a, b, c, d in want], key=repr
    )
    inner = measure_query(fact, ["name"], ["total_tickets"], {"D": Dim(dim, "d", "d")}, inner=True)
    assert None not in {r.name for r in inner.collect()}


def test_measures_of_no_rows_are_blank(spark):
    fact = spark.createDataFrame([], "ticket_id int, sla_resolution_breached boolean, total_amount double, revenue_impact double")
    out = measure_query(fact, measures=["total_tickets", "sla_breach_rate", "net_profit"]).first()
    assert tuple(out) == (0, None, None)


def test_net_profit_with_one_blank(spark):
    fact = spark.createDataFrame([(None, 3.0)], "total_amount double, revenue_impact double")
    assert measure_query(fact, measures=["net_profit"]).first()[0] == -3.0


def test_unknown_group_column(spark):
    with pytest.raises(ValueError):
        measure_query(spark.range(1), ["nowhere"])
    one = {"n": Measure((("n_all", "count(*)"),), "n_all")}
    assert aggregate(spark.range(4), [], ["n"], one).first()[0] == 4


# ---- reads


def test_finders(spark, rows):
    agents = spark.createDataFrame(
        [(1, "Core", "senior", True), (2, "Core", "junior", False), (3, "Night", "junior", None)],
        "agent_id int, team_name string, skill_level string, is_active boolean",
    )
    assert rows(finders.by_team(agents, "Core"), "agent_id") == [(1,), (2,)]
    assert rows(finders.by_skill_level(agents, "junior"), "agent_id") == [(2,), (3,)]
    assert rows(finders.active(agents), "agent_id") == [(1,)]
    assert rows(finders.point_lookup(agents, "agent_id", 2), "team_name") == [("Core",)]
    assert finders.point_lookup(agents, "agent_id", 9).count() == 0
    keys = spark.createDataFrame([(1,), (1,), (7,)], "agent_id int")
    assert rows(finders.columns_by_keys(agents, ["team_name"], keys, "agent_id")) == [("Core",)]
    orphans = spark.createDataFrame([("CustomersDim",), ("AgentsDim",)], "source_table string")
    assert rows(finders.by_source_table(orphans, "customersdim")) == [("CustomersDim",)]


# ---- shape


def test_keep_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, junk int, b int")
    assert keep_columns(df, ["b", "a"]).columns == ["b", "a"]
    with pytest.raises(ValueError, match="missing columns"):
        keep_columns(df, ["a", "c"])


def test_shape_helpers(spark, rows):
    df = spark.createDataFrame([(1, "x"), (2, None)], "a int, b string")
    twice = df.crossJoin(df.limit(1))
    assert drop_repeated_names(twice).columns == ["a", "b"]
    assert rows(filter_not_equal(df, "b", "x"), "a") == [(2,)]
    text = spark.createDataFrame([("5", "y"), ("z", "q")], "a string, c string")
    assert rows(align_to(text, df)) == sorted([(5, "y"), (None, "q")], key=repr)
    assert rows(hierarchy_slicer(df, ("a", "b"), [(1, "x"), (2,)]), "a") == [(1,), (2,)]
    assert hierarchy_slicer(df, ("a", "b"), []) is df
