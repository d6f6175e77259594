"""The ticket warehouse end to end, on small raw files."""

import csv
import json
import os
import re
import shutil
from dataclasses import replace
from datetime import date

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from starloom.plans import runner
from starloom.plans.build import Model, build_table, table_schema
from starloom.plans.runner import Warehouse, apply_retention, batch_summary, load_calendar, run_batch, run_micro_batch
from starloom.plans.support_tickets import MODEL, documented_model
from starloom.queries import load_queries
from starloom.session import exclusive, spread
from starloom.sources.files import counted, list_files, logical_file, match_sources, read_source, scan, tables_with_files
from starloom.sources.tables import BatchTable
from starloom.specs import SourceSpec, columns
from starloom.streaming.micro_batch import Arrivals, fact_files, start_stream

SF_DIR = "/root/testdata/sf0.001"
STAMP = "2024-01-01 08:00:00"


def write_csv(path, records):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        out = csv.DictWriter(f, fieldnames=list(records[0]))
        out.writeheader()
        out.writerows(records)
    return path


def write_json(path, records):
    """One array of records, over several lines."""
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        json.dump(records, f, indent=1)
    return path


def dimension_files(folder, customers=(1, 2)):
    seen = dict(created_at=STAMP, updated_at=STAMP)
    files = {
        "agents.csv": [
            dict(agent_id=1, agent_name="Ann", agent_email="ann@x.org", agent_phone=201111111, team_id=1, skill_level="senior",
                 hire_date="2020-01-01", avg_handle_time_min=5, resolution_rate=0.9, csat_score=4.5, is_active=True, **seen),
            dict(agent_id=2, agent_name="", agent_email="bob@x.org", agent_phone=201111112, team_id=1, skill_level="junior",
                 hire_date="2020-01-01", avg_handle_time_min=5, resolution_rate=0.9, csat_score=4.5, is_active=True, **seen),
            dict(agent_id="three", agent_name="Cid", agent_email="c@x.org", agent_phone=201111113, team_id=1, skill_level="junior",
                 hire_date="2020-01-01", avg_handle_time_min=5, resolution_rate=0.9, csat_score=4.5, is_active=True, **seen),
        ],
        "teams.csv": [dict(team_id=1, team_name="Core")],
        "customers.csv": [
            dict(customer_id=c, full_name=f"Customer {c}", email=f"c{c}@x.org", phone=202222220 + c, region_id=1, segment_id=1,
                 signup_date="2023-05-05", gender="f", surrogate_key="", is_current=True, valid_from="", valid_to="", **seen)
            for c in customers
        ],
        "segments.csv": [dict(segment_id=1, segment_name="gold", discount_pct=10, priority_support=True)],
        "regions.csv": [dict(region_id=1, region_name="North", city_id=1, delivery_base_fee=2.5)],
        "categories.csv": [dict(category_id=1, category_name="Pizza")],
        "channels.csv": [dict(channel_id=1, channel_name="app")],
        "drivers.csv": [
            dict(driver_id=1, driver_name="Dan", driver_phone=203333331, national_id=29001011234567, region_id=1, shift="day",
                 vehicle_type="bike", hire_date="2021-01-01", rating_avg=4.0, on_time_rate=0.9, cancel_rate=0.1,
                 completed_deliveries=10, is_active=True, surrogate_key="", is_current=True, valid_from="", valid_to="", **seen)
        ],
        "priorities.csv": [
            dict(priority_id=1, priority_code="P1", priority_name="high", sla_first_response_min=10, sla_resolution_min=60)
        ],
        "reasons.csv": [dict(reason_id=1, reason_name="late", reason_category_id=1, severity_level=2, typical_refund_pct=0.1)],
        "reason_categories.csv": [dict(reason_category_id=1, category_name="delivery")],
        "cities.json": [dict(city_id=1, city_name="Cairo", country="Egypt", timezone="Africa/Cairo")],
        "restaurants.json": [
            dict(restaurant_id=1, restaurant_name="Roma", region_id=1, category_id=1, price_tier="mid", rating_avg=4.1,
                 prep_time_avg_min=15, is_active=True, surrogate_key=None, is_current=True, valid_from=None, valid_to=None, **seen)
        ],
    }
    return [(write_csv if n.endswith("csv") else write_json)(f"{folder}/{n}", r) for n, r in files.items()]


def ticket(i, customer, agent=1, created="2024-01-01 10:00:00"):
    return dict(
        ticket_id=f"t{i}", order_id=f"o{i}", customer_id=customer, driver_id=1, restaurant_id=1, agent_id=agent, reason_id=1,
        priority_id=1, channel_id=1, status="open", refund_amount=5.5, created_at=created,
        first_response_at="2024-01-01 10:07:30", resolved_at="2024-01-01 11:30:00",
        sla_first_due_at="2024-01-01 10:05:00", sla_resolve_due_at="2024-01-01 12:00:00",
    )


def fact_records(customers, first=1):
    ids = range(first, first + len(customers))
    tickets = [ticket(i, c) for i, c in zip(ids, customers)]
    orders = [
        dict(order_id=f"o{i}", customer_id=c, restaurant_id=1, driver_id=1, region_id=1, order_amount=20.0, delivery_fee=2.0,
             discount_amount=1, total_amount=21.0, order_status="delivered", payment_method="card",
             order_created_at=STAMP, delivered_at=STAMP)
        for i, c in zip(ids, customers)
    ]
    events = [
        dict(event_id=f"e{i}", ticket_id=f"t{i}", agent_id=1, event_ts=STAMP, old_status=None, new_status="open", notes=None) for i in ids
    ]
    return {"tickets.csv": tickets, "orders.json": orders, "ticket_events.json": events}


def fact_files_in(folder, customers, first=1, only=None):
    out = []
    for name, records in fact_records(customers, first).items():
        if only is None or name in only:
            out.append((write_csv if name.endswith("csv") else write_json)(f"{folder}/{name}", records))
    return out


def moment(text="2024-01-03 00:00:00"):
    return F.lit(text).cast("timestamp_ntz")


@pytest.fixture(scope="module")
def first_day(spark, tmp_path_factory):
    """The dimensions of one day, loaded once."""
    folder = tmp_path_factory.mktemp("day1")
    wh = Warehouse(spark, str(folder / "wh"), MODEL)
    return folder / "wh", run_batch(wh, dimension_files(str(folder / "batch/2024-01-01")), "day1", moment())


@pytest.fixture
def warehouse(spark, tmp_path, first_day):
    """A copy of that warehouse for each test."""
    root, report = first_day
    shutil.copytree(root, tmp_path / "wh")
    return Warehouse(spark, str(tmp_path / "wh"), MODEL), report, tmp_path


def test_batch_micro_batch_and_retry(warehouse, rows):
    wh, report, tmp_path = warehouse
    assert report.failed == {}
    assert report.loaded[-1] == "RegionsDim" and len(report.loaded) == 8

    agent = wh.table("AgentsDim").read().collect()
    assert [(a.agent_id, a.team_name) for a in agent] == [(1, "Core")]
    assert len(agent[0].agent_email) == 64 and len(agent[0].agent_phone) == 64
    assert rows(wh.table("ReasonsDim").read(), "reason_name", "reason_category_name") == [("late", "delivery")]
    assert rows(wh.table("CustomersDim").read(), "customer_id", "segment_name", "discount_pct") == [(1, "gold", 10), (2, "gold", 10)]
    reasons = rows(wh.rejected.read(), "batch_source", "rejected_reason")
    assert reasons == [
        ("agents.csv", "agent_id is not of type int"),
        ("agents.csv", "no value in agent_name"),
    ]
    log = {r.file_name: r for r in wh.run_log.read().collect()}
    assert (log["agents.csv"].total_records, log["agents.csv"].passed_count, log["agents.csv"].null_count) == (3, 1, 1)
    assert log["agents.csv"].null_rate == 33.33
    assert [log["CustomersDim"][f"scd_{k}_count"] for k in ("inserted", "updated", "expired")] == [2, 0, 0]
    summary = batch_summary(wh, "day1").first()
    assert summary.files_failed == 0 and summary.quarantined_count == 2

    # micro-batch: the third ticket's customer and the fourth's customer and agent are unknown
    hour = str(tmp_path / "stream/2024-01-01/10")
    paths = fact_files_in(hour, [1, 2, 9])
    fact_files_in(str(tmp_path / "x"), [9], first=4)
    first = run_micro_batch(wh, paths, "hour10", moment())
    assert first.failed == {} and first.loaded == ["FactTickets"]
    fact = wh.table("FactTickets").read()
    assert rows(fact, "ticket_id", "resolution_time_min", "first_response_time_min") == [("t1", 90, 8), ("t2", 90, 8)]
    one = fact.filter("ticket_id = 't1'").first()
    assert (one.sla_first_response_breached, one.sla_resolution_breached, one.revenue_impact) == (True, False, 6.5)
    assert (one.date_key_created, one.status, one.region_id) == (20240101, "open", 1)
    held = wh.orphans.read()
    assert rows(held, "source_table", "orphaned_fk_column", "orphaned_fk_value", "fact_table", "source_file") == [
        ("CustomersDim", "customer_id", "9", "FactTickets", "tickets.csv")
    ]
    assert wh.alerts.read().count() == 0

    # the same batch again replaces its rows; the same files under a new batch are duplicates
    run_micro_batch(wh, paths, "hour10", moment())
    assert wh.table("FactTickets").read().count() == 2 and wh.orphans.read().count() == 1
    run_micro_batch(wh, paths, "hour10-again", moment())
    assert wh.table("FactTickets").read().count() == 2
    again = wh.rejected.read_batches().filter("batch_id = 'hour10-again'")
    assert rows(again, "rejected_reason") == [
        ("FactTickets already holds this row of ticket_id t1",),
        ("FactTickets already holds this row of ticket_id t2",),
    ]
    assert wh.orphans.read().count() == 2

    # the missing customer arrives with the next snapshot: loaded once, quarantine emptied
    run_batch(wh, dimension_files(str(tmp_path / "batch/2024-01-02"), (1, 2, 9)), "day2", moment())
    assert rows(wh.table("FactTickets").read(), "ticket_id") == [("t1",), ("t2",), ("t3",)]
    assert wh.orphans.read().count() == 0
    assert wh.table("CustomersDim").read().count() == 3
    day2 = wh.run_log.read_batches().filter("batch_id = 'day2' and file_name = 'CustomersDim'").first()
    # the two customers sent again are duplicates
    assert (day2.scd_inserted_count, day2.scd_updated_count, day2.duplicate_count) == (1, 0, 2)


def test_alert_and_retention(warehouse, rows):
    wh, _, tmp_path = warehouse
    run_micro_batch(wh, fact_files_in(str(tmp_path / "h"), [1, 8, 9]), "bad", moment())
    alert = wh.alerts.read().first()
    assert (alert.file_name, alert.orphan_count, alert.total_records) == ("bad", 2, 3)
    s = batch_summary(wh, "bad").first()
    assert (s.total_records, s.table_records, s.passed_count, s.orphan_count, s.orphan_rate) == (9, 3, 1, 2, 66.67)
    apply_retention(wh, moment("2024-01-04 00:00:00"))
    assert wh.orphans.read().count() == 2
    apply_retention(wh, moment("2024-01-05 00:00:01"))
    assert wh.orphans.read().count() == 0
    assert wh.rejected.read().count() == 2
    apply_retention(wh, moment("2024-03-01 00:00:00"))
    assert wh.rejected.read().count() == 0


def test_bad_file_is_rejected_others_go_on(spark, tmp_path, rows):
    wh = Warehouse(spark, str(tmp_path / "wh"), MODEL)
    folder = str(tmp_path / "b")
    paths = dimension_files(folder)
    write_csv(f"{folder}/channels.csv", [dict(channel_id="a", channel_name="x"), dict(channel_id="b", channel_name="y")])
    write_csv(f"{folder}/drivers.csv", [dict(driver_id=1)])
    # without its segments the customer dimension cannot be joined
    paths = [p for p in paths if not p.endswith("/segments.csv")]
    report = run_batch(wh, paths, "day1", moment())
    assert set(report.failed) == {"channels.csv", "ChannelsDim", "drivers.csv", "DriversDim", "CustomersDim"}
    assert "AgentsDim" in report.loaded and "CustomersDim" not in report.loaded
    shared = wh.rejected.read().filter("batch_source = 'channels.csv'")
    assert rows(shared, "rejected_reason") == [("no value of channel_id is of type int",)] * 2
    assert wh.run_log.read().filter("not file_success and stage <> 'batch'").count() == 5
    assert report.errors == []


def test_fact_with_a_rejected_source_is_set_aside(warehouse, rows):
    wh, _, tmp_path = warehouse
    folder = str(tmp_path / "h")
    paths = fact_files_in(folder, [1, 2])
    write_json(f"{folder}/orders.json", [dict(r, order_amount="much") for r in fact_records([1, 2])["orders.json"]])
    report = run_micro_batch(wh, paths, "h", moment())
    assert set(report.failed) == {"orders.json", "FactTickets"} and report.errors == []
    bad = wh.rejected.read_batches().filter("batch_id = 'h'").groupBy("batch_source").count()
    assert rows(bad) == [("orders.json", 2), ("ticket_events.json", 2), ("tickets.csv", 2)]


def test_unreadable_files_stop_the_stream_before_anything_is_noted(warehouse, rows):
    wh, _, tmp_path = warehouse
    root, hour = str(tmp_path / "stream"), str(tmp_path / "stream/2024-01-01/10")
    fact_files_in(hour, [1, 2])
    # a second folder whose header does not fit the first one's
    other = f"{root}/2024-01-01/11"
    fact_files_in(other, [1], first=3, only={"orders.json", "ticket_events.json"})
    write_csv(f"{other}/tickets.csv", [dict(reversed(list(ticket(3, 1).items())))])

    def run():
        start_stream(wh, root, str(tmp_path / "cp"), "tickets", available_now=True, now=moment()).awaitTermination()

    with pytest.raises(StreamingQueryException, match="incomplete"):
        run()
    assert Arrivals(wh.spark, f"{wh.root}/stream_tickets", fact_files(wh)).loaded.read().count() == 0
    # repaired, the same trigger loads both folders
    write_csv(f"{other}/tickets.csv", [ticket(3, 1)])
    run()
    assert rows(wh.table("FactTickets").read(), "ticket_id") == [("t1",), ("t2",), ("t3",)]


def test_stream_of_hour_folders(warehouse, rows):
    wh, _, tmp_path = warehouse
    root, checkpoint = str(tmp_path / "stream"), str(tmp_path / "checkpoint")

    def run():
        start_stream(wh, root, checkpoint, "tickets", available_now=True, now=moment()).awaitTermination()
        return rows(wh.table("FactTickets").read(), "ticket_id")

    fact_files_in(f"{root}/2024-01-01/10", [1, 2])
    # hour 11 lacks its events: it has to wait
    fact_files_in(f"{root}/2024-01-01/11", [1], first=3, only={"tickets.csv", "orders.json"})
    assert run() == [("t1",), ("t2",)]
    arrivals = Arrivals(wh.spark, f"{wh.root}/stream_tickets", fact_files(wh))
    assert rows(arrivals.pending(), "file_hour", "file_name") == [("11", "orders.json"), ("11", "tickets.csv")]
    # restart from the checkpoint: nothing new, nothing twice
    assert run() == [("t1",), ("t2",)]
    # the missing file arrives, and a file comes late for hour 10
    fact_files_in(f"{root}/2024-01-01/11", [1], first=3, only={"ticket_events.json"})
    write_csv(f"{root}/2024-01-01/10/late/tickets.csv", [ticket(7, 1)])
    assert run() == [("t1",), ("t2",), ("t3",), ("t7",)]
    assert run() == [("t1",), ("t2",), ("t3",), ("t7",)]
    assert rows(Arrivals(wh.spark, f"{wh.root}/stream_tickets", fact_files(wh)).late.read(), "file_hour", "file_name") == [
        ("10", "tickets.csv")
    ]


def test_triggers_read_open_dates_only(spark, tmp_path, rows):
    """Whatever has been loaded before, a trigger reads the dates of its files and those that wait for files."""
    arrivals = Arrivals(spark, str(tmp_path / "state"), ["a.csv", "b.csv"])
    path = "/in/{}/{}/{}"

    def trigger(name, *files):
        arrivals.record(spark.createDataFrame([(path.format(*f),) for f in files], "path string"), name)
        ready = arrivals.ready(name)
        scans = re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", ready._jdf.queryExecution().executedPlan().toString())
        dates = [set(re.findall(r"\d{4}-\d\d-\d\d", x)) for x in scans]
        assert len(scans) >= 2 and all(d == dates[0] for d in dates)
        read = dates[0]
        arrivals.loaded.append(ready.select("file_date", "file_hour").distinct(), name)
        arrivals.note_dates(name)
        return sorted(r.path for r in ready.collect()), read

    for d in range(1, 6):
        day = f"2024-01-0{d}"
        got, read = trigger(f"s-{d}", (day, "10", "a.csv"), (day, "10", "b.csv"), *([(day, "11", "a.csv")] if d == 2 else []))
        assert got == [path.format(day, "10", f) for f in ("a.csv", "b.csv")]
        assert read == ({day} if d < 3 else {day, "2024-01-02"})
    # the folder that waited is completed; its date is closed from now on
    got, _ = trigger("s-6", ("2024-01-02", "11", "b.csv"))
    assert got == [path.format("2024-01-02", "11", f) for f in ("a.csv", "b.csv")]
    got, read = trigger("s-7", ("2024-01-07", "10", "a.csv"))
    assert got == [] and read == {"2024-01-07"}
    # a late file names the trigger that had loaded its folder, with all files of that trigger
    arrivals.record(spark.createDataFrame([("/in/2024-01-03/10/late/a.csv",)], "path string"), "s-8")
    assert rows(arrivals.reopened("s-8")) == [("s-3", f"/in/2024-01-03/10/{f}") for f in ("a.csv", "b.csv", "late/a.csv")]


def test_dimension_keys_are_checked_on_request(spark, tmp_path, rows):
    wh = Warehouse(spark, str(tmp_path / "wh"), MODEL)
    folder = str(tmp_path / "b")
    city = dict(city_id=1, city_name="Cairo", country="Egypt", timezone="Africa/Cairo")
    region = dict(region_name="R", delivery_base_fee=1.0)
    paths = [
        write_json(f"{folder}/cities.json", [city]),
        write_csv(f"{folder}/regions.csv", [dict(region, region_id=1, city_id=1), dict(region, region_id=2, city_id=5)]),
    ]
    run_batch(wh, paths, "day1", moment(), check_dimension_keys=True)
    assert rows(wh.table("RegionsDim").read(), "region_id") == [(1,)]
    assert rows(wh.orphans.read(), "fact_table", "source_table", "orphaned_fk_value") == [("RegionsDim", "CitiesDim", "5")]


def test_generated_dates(spark, tmp_path, rows):
    wh = Warehouse(spark, str(tmp_path / "wh"), MODEL)
    load_calendar(wh, "2024-01-01", "2024-12-31")
    days = wh.table("DateDim").read()
    assert days.count() == 366 and days.filter("is_weekend").count() == 104
    assert rows(days.filter("date_id = 20240229"), "day", "month", "quarter", "year") == [("Thursday", "February", "Q1", 2024)]


def test_documented_model(spark, tmp_path, rows):
    """Row rules, history of customers, reopened tickets."""
    wh = Warehouse(spark, str(tmp_path / "wh"), documented_model())
    days = [str(tmp_path / f"batch/2024-01-0{d}") for d in (1, 2)]
    assert run_batch(wh, dimension_files(days[0], (1, 2)), "day1", moment("2024-01-01 00:00:00")).failed == {}
    paths = dimension_files(days[1], (1, 2, 3))
    with open(f"{days[1]}/customers.csv") as f:
        changed = f.read().replace("Customer 2", "Customer Two").replace("c3@x.org", "c3-at-x")
    with open(f"{days[1]}/customers.csv", "w") as f:
        f.write(changed)
    run_batch(wh, paths, "day2", moment("2024-01-02 00:00:00"))
    versions = wh.table("CustomersDim").read()
    assert rows(versions, "customer_id", "full_name", "is_current") == [(1, "Customer 1", True), (2, "Customer 2", False), (2, "Customer Two", True)]
    assert rows(versions.filter("not is_current"), "valid_from", "valid_to") == [(date(2024, 1, 1), date(2024, 1, 2))]
    bad = wh.rejected.read().filter("batch_source = 'customers.csv'")
    assert rows(bad, "rejected_reason") == [("Rule 'email format' failed on 'email'",)]

    records = fact_records([1, 2, 1])
    records["tickets.csv"][2]["status"] = "lost"
    records["ticket_events.json"][1].update(old_status="closed", new_status="open")
    folder = str(tmp_path / "h")
    paths = [(write_csv if n.endswith("csv") else write_json)(f"{folder}/{n}", r) for n, r in records.items()]
    run_micro_batch(wh, paths, "h", moment())
    assert rows(wh.table("FactTickets").read(), "ticket_id", "is_reopened") == [("t1", False), ("t2", True)]
    assert rows(wh.rejected.read().filter("batch_source = 'tickets.csv'"), "rejected_reason") == [("Rule 'status values' failed on 'status'",)]


def test_history_of_tracked_columns(spark, tmp_path, rows):
    """A dimension with tracked columns keeps its versions."""
    table = replace(MODEL.tables["ChannelsDim"], tracked=("channel_name",))
    wh = Warehouse(spark, str(tmp_path / "wh"), Model(MODEL.sources, {"ChannelsDim": table}))

    def load(day, *names):
        records = [dict(channel_id=i + 1, channel_name=n) for i, n in enumerate(names)]
        run_batch(wh, [write_csv(f"{tmp_path}/{day}/channels.csv", records)], day, moment(f"{day} 00:00:00"))

    load("2024-01-01", "app", "phone")
    load("2024-01-02", "app", "call", "chat")
    load("2024-01-03", "app", "call", "chat")
    versions = [(r.channel_id, r.channel_name, str(r.valid_from), str(r.valid_to)) for r in wh.table("ChannelsDim").read().collect()]
    assert sorted(versions) == [
        (1, "app", "2024-01-01", "None"),
        (2, "call", "2024-01-02", "None"),
        (2, "phone", "2024-01-01", "2024-01-02"),
        (3, "chat", "2024-01-02", "None"),
    ]
    log = wh.run_log.read_batches().filter("file_name = 'ChannelsDim'")
    assert rows(log, "batch_id", "scd_inserted_count", "scd_updated_count", "scd_expired_count") == [
        ("2024-01-01", 2, 0, 0),
        ("2024-01-02", 1, 1, 1),
        ("2024-01-03", 0, 0, 0),
    ]


# ---- sources


def test_matching_is_by_exact_name():
    paths = ["/b/2024-01-01/reason_categories.csv", "/b/2024-01-01/categories.csv", "/b/x=orders.json/part-0001.json", "/b/unknown.csv"]
    found = match_sources(paths, MODEL.sources.values())
    assert found == {"reason_categories": [paths[0]], "categories": [paths[1]], "orders": [paths[2]]}
    assert logical_file("/a/tickets.csv") == "tickets.csv"
    names = {t.name for t in tables_with_files(MODEL.tables.values(), found)}
    assert names == {"ReasonsDim", "RestaurantsDim", "FactTickets"}


def test_csv_reading(spark, tmp_path, rows):
    spec = SourceSpec("t", "t.csv", columns("id int, name string"))
    path = str(tmp_path / "t.csv")
    with open(path, "w") as f:
        f.write('name,id,extra\n"said ""hi"", once",1,x\nN/A,2,\nnan,,y\n')
    df, seen = counted(read_source(spark, spec, [path]))
    assert rows(df) == sorted([('said "hi", once', "1", "x"), (None, "2", None), (None, None, "y")], key=repr)
    assert seen.get["total_in_records"] == 3
    with_file = read_source(spark, spec, [path], with_file=True)
    assert with_file.select("source_file").first()[0].endswith("/t.csv")


def test_csv_with_line_breaks_and_extra_fields(spark, tmp_path, rows):
    spec = SourceSpec("t", "t.csv", columns("id int, name string"), multiline=True)
    path = tmp_path / "t.csv"
    path.write_text('id,name\n1,"line one\nline two"\n2,"a, b"\n3\n4,x,EXTRA\n')
    df = read_source(spark, spec, [str(path)], with_corrupt=True)
    got = sorted((r.id, r.name, r.malformed_record is not None) for r in df.collect())
    assert got == [("1", "line one\nline two", False), ("2", "a, b", False), ("3", None, False), ("4", "x", True)]
    with pytest.raises(Exception, match="malformed record"):
        read_source(spark, spec, [str(path)]).collect()


@pytest.mark.parametrize("multiline", [False, True])
def test_empty_surplus_fields_make_a_record_malformed(spark, tmp_path, rows, multiline):
    spec = SourceSpec("s", "s.csv", columns("id int, name string, kind string"), multiline=multiline)
    long = ["1,a,b,,EXTRA", "2,a,b,", "3,a,b,,", "4,,,,", '5,a,b,""', '6,"a,1","b""2",,"x, y"', '7,a,b,"open', "8,a,b,,x,,"]
    short = ["11", "12,a", "13,", '14,"a, b"', '15,"a ""quoted"" word"', "16,xxxxxxxxxxxx"]
    whole = ["21,a,b", "22,,", '23,"a,,b",c']
    path = tmp_path / "s.csv"
    # an open quote takes in what follows where fields may have line breaks
    long = [x for x in long if not multiline or "open" not in x]
    path.write_text("\n".join(["id,name,kind", *whole[:1], *long, *short, *whole[1:], ""]))
    got = {r.id: r for r in read_source(spark, spec, [str(path)], with_corrupt=True).collect()}
    assert {i: r.malformed_record.rstrip("\r\n") for i, r in got.items() if r.malformed_record is not None} == {x.split(",")[0]: x for x in long}
    assert len(got) == len(long) + len(short) + len(whole)
    assert (got["14"].name, got["14"].kind, got["15"].name, got["23"].name) == ("a, b", None, 'a "quoted" word', "a,,b")
    path.write_text("id,name,kind\n1,a,b,,EXTRA\n")
    with pytest.raises(Exception, match="malformed record"):
        read_source(spark, spec, [str(path)]).collect()


def test_json_reading(spark, tmp_path, rows):
    array = write_json(str(tmp_path / "a.json"), [dict(id=1, ok=True, x=1.5), dict(id=2, ok=None, x="t")])
    spec = SourceSpec("a", "a.json", columns("id int, ok boolean, x double, gone string"))
    assert rows(read_source(spark, spec, [array])) == [("1", "true", "1.5", None), ("2", None, "t", None)]
    lines = str(tmp_path / "l.jsonl")
    with open(lines, "w") as f:
        f.write('{"id": 1}\n{"id": 2}\n')
    assert rows(read_source(spark, SourceSpec("l", "l.jsonl", columns("id int")), [lines])) == [("1",), ("2",)]


def test_scan_reports_instead_of_raising(spark, tmp_path):
    spec = SourceSpec("t", "t.csv", columns("id int"))
    assert scan(spark, spec, []).errors == ["no file for source 't'"]
    missing = scan(spark, spec, [str(tmp_path / "none.csv")])
    assert not missing.ok and "t" in missing.errors[0]
    assert not scan(spark, SourceSpec("x", "x.xml", columns("id int")), ["x.xml"]).ok


def test_list_files(spark, tmp_path, rows):
    write_csv(str(tmp_path / "2024-01-01/05/a.csv"), [dict(a=1)])
    assert [logical_file(r.path) for r in list_files(spark, str(tmp_path)).collect()] == ["a.csv"]


# ---- tables


def one_row(spark, i, v="x"):
    return spark.createDataFrame([(i, v)], "id int, v string")


def folders(path):
    return sorted(p.relative_to(path).as_posix() for p in path.rglob("*") if p.is_dir() and "=" in p.name)


def test_batches(spark, tmp_path, rows):
    store = BatchTable(spark, str(tmp_path / "t"), columns("id int, v string"), key="id")
    assert store.read().count() == 0 and store.read_batches().columns == ["id", "v", "batch_id"]
    store.append(one_row(spark, 1), "b1")
    store.append(one_row(spark, 1), "b1")
    store.append(one_row(spark, 2), "b2")
    assert rows(store.read_batches()) == [(1, "x", "b1"), (2, "x", "b2")]
    assert rows(store.read(["id"], without="b1")) == [(2,)]
    store.remove(store.read(["id"]).filter("id = 2"), "r1")
    assert rows(BatchTable(spark, store.path, store.schema, key="id").read()) == [(1, "x")]
    # written again after its removal
    store.append(one_row(spark, 2, "again"), "b3")
    assert rows(store.read()) == [(1, "x"), (2, "again")]
    with pytest.raises(ValueError):
        BatchTable(spark, store.path, store.schema).remove(one_row(spark, 1), "r")


def test_the_last_row_of_a_key_counts(spark, tmp_path, rows):
    path, schema = str(tmp_path / "t"), columns("id int, v string")
    one, two = (BatchTable(spark, path, schema, key="id", latest=True) for _ in range(2))
    one.append(one_row(spark, 1, "a").union(one_row(spark, 2, "a")), "b1")
    two.append(one_row(spark, 2, "b").union(one_row(spark, 3, None)), "b2")
    assert rows(one.read()) == rows(two.read()) == [(1, "a"), (2, "b"), (3, None)]
    assert rows(one.read_batches(["id"], without="b2")) == [(1, "b1"), (2, "b1")]
    one.remove(one_row(spark, 1).select("id"), "r1")
    two.append(one_row(spark, 2, "c"), "b3")
    assert rows(one.read()) == [(2, "c"), (3, None)]
    two.append(one_row(spark, 1, "back"), "b4")
    assert rows(one.read(["v", "id"])) == [("back", 1), ("c", 2), (None, 3)]


def test_compaction_leaves_what_others_append(spark, tmp_path, rows, monkeypatch):
    path, schema = str(tmp_path / "t"), columns("id int, v string")
    one, two = (BatchTable(spark, path, schema, key="id", latest=True) for _ in range(2))
    for k in range(4):
        one.append(one_row(spark, k % 2, f"v{k}").union(one_row(spark, 7, f"w{k}")), f"b{k}")
    one.remove(one_row(spark, 7).select("id"), "r")
    want = [(0, "v2"), (1, "v3")]
    write = BatchTable._write

    def meanwhile(self, df, batch_id):
        two._write(one_row(spark, 9, "late").withColumn("__written", F.lit(two._moment())), "other") if batch_id.startswith("compacted") else None
        write(self, df, batch_id)
        assert rows(two.read()) == [*want, (9, "late")]  # both the batches and what they were put together to are there

    with monkeypatch.context() as m:
        m.setattr(BatchTable, "_write", meanwhile)
        m.setattr(two, "_write", lambda df, b: write(two, df, b))
        assert set(one.compact()) == {"b0", "b1", "b2", "b3"}
    assert rows(one.read()) == [*want, (9, "late")]
    names = folders(tmp_path / "t")
    assert len(names) == 2 and "batches/batch_id=other" in names
    # rows written before the compaction do not win over it
    two.append(one_row(spark, 0, "newer"), "b9")
    one.compact()
    assert rows(two.read()) == [(0, "newer"), (1, "v3"), (9, "late")] and len(folders(tmp_path / "t")) == 1


def test_two_writers(spark, tmp_path, rows):
    """Appends of one writer survive removals and retention of another."""
    path, schema = str(tmp_path / "t"), columns("id int, v string")
    one, two = (BatchTable(spark, path, schema, key="id") for _ in range(2))
    one.append(one_row(spark, 1), "b1")
    seen = two.read()
    one.append(one_row(spark, 2), "b2")
    two.remove(seen.select("id"), "expired")
    one.append(one_row(spark, 3), "b3")
    assert rows(one.read(), "id") == rows(two.read(), "id") == [(2,), (3,)]


def test_expiry_deletes_days(spark, tmp_path, rows):
    made = "id int, at timestamp_ntz, open boolean"
    store = BatchTable(spark, str(tmp_path / "t"), columns("id int, at timestamp_ntz, open boolean"), key="id", day_of="at")
    days = spark.createDataFrame([(i, f"2024-01-0{1 + i // 4} 0{i % 4}:00:00", i != 1) for i in range(16)], "id int, at string, open boolean")
    days = days.withColumn("at", F.col("at").cast("timestamp_ntz"))
    assert days.schema.simpleString() == columns(made).simpleString()
    store.append(days.filter("id % 2 = 0"), "even")
    store.append(days.filter("id % 2 = 1"), "odd")
    store.append(spark.createDataFrame([(99, None, True)], made), "timeless")
    store.remove(days.filter("id = 13").select("id"), "resolved")
    size = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    old = (F.col("at") < F.lit("2024-01-03 01:00:00").cast("timestamp_ntz")) & F.col("open")
    gone = store.expire(old, "e1")
    # row 1 is not open: its day of its batch stays, without the others
    assert sorted(r.id for r in store.read().collect()) == [1, 9, 10, 11, 12, 14, 15, 99]
    assert sorted(g.split("batches/")[1] for g in gone) == [f"batch_id={b}/__day=2024-01-0{d}" for b, d in (("even", 1), ("even", 2), ("odd", 2))]
    assert all(not os.path.exists(g) for g in gone) and sum(f.stat().st_size for f in tmp_path.rglob("*.parquet")) < size
    assert "removed/batch_id=resolved" in folders(tmp_path / "t")
    assert store.expire(F.col("at") < F.lit("2024-02-01").cast("timestamp_ntz"), "e2")
    # the last rows, and with them the keys that were removed, are gone
    assert rows(store.read(), "id") == [(99,)]
    assert folders(tmp_path / "t") == ["batches/batch_id=even", "batches/batch_id=odd", "batches/batch_id=timeless", "batches/batch_id=timeless/__day=__HIVE_DEFAULT_PARTITION__"]
    assert store.expire(F.lit(True), "e3") and store.read().count() == 0


def test_retry_and_retention_keep_what_another_run_appends(warehouse, rows):
    wh, _, tmp_path = warehouse
    other = Warehouse(wh.spark, wh.root, MODEL)
    other.orphans.read(), other.rejected.read(), other.table("FactTickets").read()
    run_micro_batch(wh, fact_files_in(str(tmp_path / "a"), [1, 9]), "a", moment())
    held = other.orphans.read()
    run_micro_batch(wh, fact_files_in(str(tmp_path / "b"), [2, 8], first=3), "b", moment())
    assert held.count() == 1
    apply_retention(other, moment("2024-01-04 00:00:00"))
    run_batch(other, dimension_files(str(tmp_path / "batch/2024-01-02"), (1, 2, 9)), "day2", moment())
    run_micro_batch(wh, fact_files_in(str(tmp_path / "c"), [1], first=5), "c", moment())
    assert rows(wh.table("FactTickets").read(), "ticket_id") == [("t1",), ("t2",), ("t3",), ("t5",)]
    assert rows(wh.orphans.read(), "orphaned_fk_value") == [("8",)]


def test_equal_rows_are_loaded_as_often_as_they_came(warehouse, rows):
    """Late or in time, two equal tickets are two tickets; an hour that is sent again adds nothing."""
    wh, _, tmp_path = warehouse
    records = fact_records([1, 9])
    folder = str(tmp_path / "a")
    for again in ("a", "b"):
        paths = [write_csv(f"{folder}/tickets.csv", [t for t in records["tickets.csv"] for _ in range(2)])]
        paths += [write_json(f"{folder}/{n}", records[n]) for n in ("orders.json", "ticket_events.json")]
        run_micro_batch(wh, paths, again, moment())
    assert rows(wh.table("FactTickets").read(), "ticket_id") == [("t1",), ("t1",)]
    assert rows(wh.orphans.read(), "occurrence") == [(1,), (1,), (2,), (2,)]
    run_batch(wh, dimension_files(str(tmp_path / "batch/2024-01-02"), (1, 2, 9)), "day2", moment())
    assert rows(wh.table("FactTickets").read(), "ticket_id") == [("t1",), ("t1",), ("t2",), ("t2",)]
    assert wh.orphans.read().count() == 0


def test_interrupted_retry_is_finished_once(warehouse, rows, monkeypatch):
    wh, _, tmp_path = warehouse
    run_micro_batch(wh, fact_files_in(str(tmp_path / "a"), [1, 9]), "a", moment())
    broken = lambda self, keys, batch_id: (_ for _ in ()).throw(OSError("lost"))
    with monkeypatch.context() as m:
        m.setattr(BatchTable, "remove", broken)
        with pytest.raises(OSError):
            run_batch(wh, dimension_files(str(tmp_path / "batch/2024-01-02"), (1, 2, 9)), "day2", moment())
    assert wh.orphans.read().count() == 1
    run_batch(wh, dimension_files(str(tmp_path / "batch/2024-01-03"), (1, 2, 9)), "day3", moment())
    assert rows(wh.table("FactTickets").read(), "ticket_id") == [("t1",), ("t2",)]
    assert wh.orphans.read().count() == 0


def test_one_retry_at_a_time(warehouse, rows, monkeypatch):
    """A retry that begins while another one loads does nothing; what it leaves, the next one finds."""
    wh, _, tmp_path = warehouse
    run_micro_batch(wh, fact_files_in(str(tmp_path / "a"), [1, 9, 8]), "a", moment())
    apply, seen = runner._apply_retry, []

    def meanwhile(*args):
        if not seen:
            seen.append(None)
            later = run_batch(Warehouse(wh.spark, wh.root, MODEL), dimension_files(str(tmp_path / "batch/2024-01-03"), (1, 2, 8, 9)), "day3", moment())
            seen[0] = (later.loaded != [], later.retried)
        apply(*args)

    with monkeypatch.context() as m:
        m.setattr(runner, "_apply_retry", meanwhile)
        first = run_batch(wh, dimension_files(str(tmp_path / "batch/2024-01-02"), (1, 2, 9)), "day2", moment())
    assert first.retried and seen == [(True, False)]
    assert rows(wh.table("FactTickets").read(), "ticket_id") == [("t1",), ("t2",)]
    assert runner.retry_quarantine(wh)
    assert rows(wh.table("FactTickets").read(), "ticket_id") == [("t1",), ("t2",), ("t3",)]
    assert wh.orphans.read().count() == 0


def test_exclusive(spark, tmp_path):
    path = f"{tmp_path}/deep/running"
    with exclusive(spark, path, 60) as one:
        with exclusive(spark, path, 60) as two:
            assert (one, two) == (True, False)
        assert os.path.exists(path)
    assert not os.path.exists(path)
    with pytest.raises(KeyError), exclusive(spark, path, 60):
        raise KeyError
    assert not os.path.exists(path)
    # the mark of a dead run, and a run that outlives its lease
    with exclusive(spark, path, 60) as slow:
        os.utime(path, (0, 0))
        with exclusive(spark, path, 60) as taken:
            assert slow and taken and os.path.getmtime(path) > 0


def test_new_checkpoint_adds(warehouse, rows):
    wh, _, tmp_path = warehouse
    root = str(tmp_path / "stream")

    def run(checkpoint, **options):
        start_stream(wh, root, str(tmp_path / checkpoint), "tickets", available_now=True, now=moment(), **options).awaitTermination()
        return rows(wh.table("FactTickets").read(), "ticket_id")

    fact_files_in(f"{root}/2024-01-01/10", [1, 2])
    assert run("c1") == [("t1",), ("t2",)]
    fact_files_in(f"{root}/2024-01-01/11", [1], first=3)
    assert run("c2") == [("t1",), ("t2",), ("t3",)]
    arrivals = Arrivals(wh.spark, f"{wh.root}/stream_tickets", fact_files(wh))
    assert arrivals.files.read().count() == 6 and arrivals.late.read().count() == 0
    # Spark moves files that a later trigger no longer needs; the facts stay
    fact_files_in(f"{root}/2024-01-01/12", [2], first=4)
    archive = str(tmp_path / "archive")
    assert run("c3", archive_dir=archive, max_files=3) == [("t1",), ("t2",), ("t3",), ("t4",)]
    assert run("c4", archive_dir=archive) == [("t1",), ("t2",), ("t3",), ("t4",)]


def test_summary_of_several_triggers(spark, monkeypatch):
    """More files than a trigger takes, and a file whose parts come in two triggers."""
    seen = []

    def folders(events, root):
        for i, parts in enumerate((3, 1, 1)):
            hour = events.filter(F.col("event_id") % 3 == i).repartition(parts, "event_id")
            hour.write.option("timestampNTZFormat", load_queries.TIMESTAMP).json(f"{root}/dt=2024-01-01/hr=0{i}/file=events.json")

    def start(wh, *args, **options):
        seen.append(wh)
        return start_stream(wh, *args, max_files=2, **options)

    monkeypatch.setattr(load_queries, "_write_folders", folders)
    monkeypatch.setattr(load_queries, "start_stream", start)
    got = load_queries.batch_summary_query(spark, SF_DIR).collect()
    total = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    loads = seen[0].run_log.read_batches().filter("stage = 'table'")
    assert loads.filter("batch_id like 'first-%'").select("batch_id").distinct().count() > 1
    assert [(r.total_records, r.table_records, r.passed_count + r.orphan_count) for r in got] == [(total, total, total)]


def test_json_arrays_are_bounded(spark, tmp_path, rows, monkeypatch):
    events = spark.read.parquet(f"{SF_DIR}/events.parquet").limit(100).withColumn("ts", F.expr("timestamp_ntz '2024-01-05 01:02:03'"))
    events.write.parquet(str(tmp_path / "events.parquet"))
    events = spark.read.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(load_queries, "ARRAY_ROWS", 16, raising=False)
    monkeypatch.setattr(load_queries, "scratch_path", lambda spark, name: str(tmp_path / name))
    assert rows(load_queries.json_array_roundtrip(spark, str(tmp_path)), *events.columns) == rows(events)
    arrays = [json.loads(f.read_text()) for f in tmp_path.glob("json-arrays/dt=2024-01-05/part-*")]
    assert sum(map(len, arrays)) == 100 and max(map(len, arrays)) <= 16


def test_json_arrays_are_read_once(spark, tmp_path, rows):
    made = [{"a": i, "b": i / 7, "c": "é\n"} for i in range(2000)]
    file = tmp_path / "x.json"
    file.write_text(json.dumps(made, indent=1, ensure_ascii=False).replace('"a": 7,', '"a": 7.10,'))
    # not UTF-8: malformed, never other values
    (tmp_path / "y.json").write_bytes('[{"a": 7.10}]'.encode("utf-16"))
    spec = SourceSpec("x", "x.json", columns("a string, b string, c string"))

    def bytes_read():
        return sum(s.getBytesRead() for s in spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics())

    before = bytes_read()
    got = rows(read_source(spark, spec, [str(file)]))
    assert bytes_read() - before < 3 * file.stat().st_size
    assert got == sorted([("7.10" if r["a"] == 7 else str(r["a"]), repr(r["b"]), r["c"]) for r in made], key=repr)
    other = read_source(spark, spec, [str(tmp_path / "y.json")], with_corrupt=True).collect()
    assert other and all(r.malformed_record is not None for r in other)


def test_malformed_records_are_kept_as_text(spark, tmp_path, rows):
    wh = Warehouse(spark, str(tmp_path / "wh"), MODEL)
    folder = tmp_path / "b"
    folder.mkdir()
    (folder / "channels.csv").write_text("channel_id,channel_name\n1,app\n2,web,EXTRA\n3\n")
    (folder / "cities.json").write_text('[{"city_id": 1, "city_name": "Cairo", "country": "E", "timezone": "T"}, {"city_id": 2, "ci')
    run_batch(wh, [str(folder / "channels.csv"), str(folder / "cities.json")], "day1", moment())
    assert rows(wh.table("ChannelsDim").read()) == [(1, "app")]
    bad = {r.batch_source: (r.rejected_reason, r.record_payload) for r in wh.rejected.read().collect() if "parse" in r.rejected_reason}
    assert bad["channels.csv"][0] == "the record does not parse" and "2,web,EXTRA" in bad["channels.csv"][1]
    assert "Cairo" in bad["cities.json"][1]
    log = {r.file_name: r for r in wh.run_log.read().collect()}
    assert (log["channels.csv"].total_records, log["channels.csv"].passed_count, log["channels.csv"].quarantined_count) == (3, 1, 2)


def test_rejected_rows_hold_no_personal_data(warehouse):
    wh, *_ = warehouse
    text = " ".join(r.record_payload for r in wh.rejected.read().collect())
    assert "agent_email" in text and "@" not in text and "20111111" not in text


def test_older_rows_of_a_key_are_counted(spark, tmp_path, rows):
    wh = Warehouse(spark, str(tmp_path / "wh"), MODEL)
    records = [dict(channel_id=1, channel_name="a"), dict(channel_id=1, channel_name="b"), dict(channel_id=2, channel_name="c")]
    run_batch(wh, [write_csv(str(tmp_path / "channels.csv"), records)], "day1", moment())
    assert rows(wh.table("ChannelsDim").read()) == [(1, "b"), (2, "c")]
    assert rows(wh.rejected.read(), "rejected_reason") == [("a newer row of the same channel_id came with it",)]
    s = batch_summary(wh, "day1").first()
    assert (s.total_records, s.table_records, s.passed_count, s.duplicate_count) == (3, 3, 2, 1)
    assert s.batch_latency_ms > 0


def test_no_scratch_is_left(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("starloom.plans.runner.scratch_path", lambda _, name: str(tmp_path / "scratch" / name))
    wh = Warehouse(spark, str(tmp_path / "wh"), MODEL)
    run_batch(wh, [write_csv(str(tmp_path / "channels.csv"), [dict(channel_id=1, channel_name="a")])], "day1", moment())
    assert wh.table("ChannelsDim").read().count() == 1 and not any((tmp_path / "scratch").iterdir())


def test_table_schema(spark):
    schema = table_schema(spark, MODEL.tables["AgentsDim"], MODEL.sources)
    assert schema["agent_phone"].dataType.simpleString() == "string"
    assert schema["hire_date"].dataType.simpleString() == "date"
    fact = table_schema(spark, MODEL.tables["FactTickets"], MODEL.sources)
    assert fact.fieldNames() == list(MODEL.tables["FactTickets"].keep)


def test_build_needs_its_sources(spark):
    with pytest.raises(ValueError, match="base table"):
        build_table({}, MODEL.tables["AgentsDim"])


def test_an_absent_table_is_empty_to_the_planner(spark, tmp_path):
    store = BatchTable(spark, str(tmp_path / "none"), columns("id bigint, v string"))
    joined = spark.range(5).join(store.read(), "id", "left_semi")
    assert "Join" not in joined._jdf.queryExecution().optimizedPlan().toString()
    assert store.read().schema == store.schema and joined.count() == 0


def test_references_are_checked_by_the_keys_alone(warehouse):
    wh, *_ = warehouse
    fact = next(t for t in wh.model.tables.values() if t.kind == runner.FACT)
    dims = wh.dims_of(fact)
    assert dims and all(set(d.columns) <= {r.pk or r.fk for r in fact.dims} for d in dims.values())


def test_small_files_are_spread_over_tasks(spark, tmp_path):
    big, small = str(tmp_path / "big"), str(tmp_path / "small")
    spark.range(400_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("v")).coalesce(1).write.parquet(big)
    spark.range(10).coalesce(1).write.parquet(small)
    made = spread(spark.read.parquet(big).coalesce(1))
    assert made.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism > 1 and made.count() == 400_000
    assert spread(spark.read.parquet(small)).rdd.getNumPartitions() == 1


def test_a_fact_of_one_source_is_staged_once(spark, tmp_path, monkeypatch):
    names, kept = [], runner.stage
    monkeypatch.setattr(runner, "stage", lambda df, name, scratch=None: names.append(name) or kept(df, name, scratch))
    wh = Warehouse(spark, str(tmp_path / "wh"), load_queries._EVENT_MODEL)
    load_queries._stored_dims(spark, SF_DIR, wh)
    path = f"{tmp_path}/events.json"
    spark.read.parquet(f"{SF_DIR}/events.parquet").write.option("timestampNTZFormat", load_queries.TIMESTAMP).json(path)
    assert not run_micro_batch(wh, [path], "a").failed
    assert sorted(names) == ["FactEvents-tagged", "events"]
