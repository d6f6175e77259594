"""Models from mappings: the same specs as in Python, and all faults in one error."""

import copy
import json

import pytest

from starloom.functions.rules import email_ok
from starloom.plans.build import build_table
from starloom.plans.mapping import model_from_mapping
from starloom.plans.support_tickets import MODEL
from starloom.specs import Arithmetic, Compare, DateDiff, Expr, Rule, Term


def action(step):
    if isinstance(step, DateDiff):
        return {"type": "date_diff", "params": {"end": step.end, "start": step.start, "unit": step.unit}}
    if isinstance(step, Compare):
        return {"type": "comparison", "params": {"left": step.left, "op": step.op, "right": step.right}}
    if isinstance(step, Arithmetic):
        return {"type": "arithmetic", "params": [{"column": t.column, "op": t.op, "factor": t.factor} for t in step.terms]}
    return {"type": "date_to_key", "params": {"column": step.column}}


def as_mapping(model):
    files = {
        s.name: {"file_name": s.file, "file_type": "dynamic" if s.dynamic else "static", "model_class": s.name.title(),
                 "required_fields": list(s.required), "pii_fields": list(s.pii), "validate": s.validate}
        for s in model.sources.values()
    }
    tables = {}
    for t in model.tables.values():
        joins = {"left": t.sources[0], "right": [j.right for j in t.joins], "left_keys": [j.left_key for j in t.joins],
                 "right_keys": [j.right_key for j in t.joins], "type": "left"} if t.joins else None
        tables[t.name] = {
            "source": list(t.sources), "table_type": t.kind, "primary_key": t.key.upper(), "joins": [joins] if joins else [],
            "renamed_columns": t.renamed, "keep_columns": [c.upper() for c in t.keep], "required_fields": list(t.required),
            "date_columns": list(t.date_columns), "partition_by": list(t.partition_by),
            "dimension_sources": [{"dim": r.dim, "fk": r.fk if isinstance(r.fk, str) else list(r.fk), "type": "left"} for r in t.dims],
            "aggregated_columns": [{"component": "derive", "actions": [{"name": d.name, **action(d)} for d in t.derived]}],
        }
    # as a file would hold it
    return json.loads(json.dumps({"files": files, "tables": tables}))


@pytest.fixture
def mapping():
    return as_mapping(MODEL)


SCHEMAS = {s.name.title(): s.schema for s in MODEL.sources.values()}


def test_the_whole_model(mapping):
    made = model_from_mapping(mapping, SCHEMAS)
    assert made.sources == MODEL.sources
    assert made.tables == MODEL.tables
    assert [[t.name for t in w] for w in made.load_waves()] == [[t.name for t in w] for w in MODEL.load_waves()]


def test_more_of_a_mapping():
    rule = Rule("email format", "email", email_ok)
    made = model_from_mapping(
        {
            "files": {"People": {"file_name": "people.csv", "model_class": "P", "required_fields": "id", "multiline": True}, "cities": {"file_name": "c.csv", "file_type": "static", "model_class": "C"}},
            "tables": {
                "CitiesDim": {"source": "cities", "table_type": "static_dimension", "primary_key": "city_id", "keep_columns": ["city_id"]},
                "PeopleDim": {
                    "source": "people", "table_type": "dynamic_dimension", "primary_key": "id", "tracked_columns": ["email"], "partition_by": "home",
                    "renamed_columns": {"City": "Home"}, "foreign_keys": {"City": "CitiesDim.city_id"},
                    "aggregated_columns": [{"actions": [
                        {"name": "Double", "type": "arithmetic", "params": [{"column": "AGE"}, {"column": "age", "op": "*", "right_column": "id", "factor": 2}]},
                        {"name": "adult", "type": "sql", "params": {"text": "age >= 18"}},
                    ]}],
                },
                "OrphanRecords": {"table_type": "quarantine_zone"},
            },
        },
        {"P": "id int, email string, city int, age int", "C": "city_id int, name string"},
        {"People": [rule]},
    )
    people, table = made.sources["people"], made.tables["PeopleDim"]
    assert (people.required, people.multiline, people.rules, made.sources["cities"].dynamic) == (("id",), True, (rule,), False)
    assert table.derived == (Arithmetic("double", (Term("age"), Term("age", "*", 2, "id"))), Expr("adult", "age >= 18"))
    assert (table.renamed, table.tracked, table.partition_by) == ({"city": "home"}, ("email",), ("home",))
    assert [(r.dim, r.fk, r.pk) for r in table.dims] == [("CitiesDim", "home", "city_id")]
    assert set(made.tables) == {"CitiesDim", "PeopleDim"}


def test_a_renamed_column_takes_the_place_of_another(spark, rows):
    config = {
        "files": {"tickets": {"file_name": "t.csv", "model_class": "T"}},
        "tables": {"Fact": {"source": "tickets", "table_type": "fact", "primary_key": "id", "renamed_columns": {"new_status": "Status"}, "keep_columns": ["id", "Status"]}},
    }
    table = model_from_mapping(config, {"T": "id int, status string, new_status string"}).tables["Fact"]
    built = build_table({"tickets": spark.createDataFrame([(1, "old", "new")], "id int, status string, new_status string")}, table)
    assert built.columns == ["id", "status"] and rows(built) == [(1, "new")]


def test_all_faults_are_named(mapping):
    faulty = copy.deepcopy(mapping)
    del faulty["files"]["teams"]["file_name"]
    faulty["files"]["agents"]["model_class"] = "Nobody"
    faulty["files"]["orders"]["file_type"] = "weekly"
    faulty["files"]["tickets"]["pii_fields"] = ["email"]
    fact = faulty["tables"]["FactTickets"]
    fact["joins"][0] |= {"left_keys": ["order_id"], "type": "cross"}
    fact["aggregated_columns"][0]["actions"] += [
        {"name": "a", "type": "guess"},
        {"name": "b", "type": "date_diff", "params": {"end": "x", "start": "y", "unit": "weeks"}},
        {"name": "c", "type": "comparison", "params": {"left": "x", "op": "~", "right": "y"}},
        {"name": "d", "type": "arithmetic", "params": [{"column": "x", "op": "^"}]},
        {"name": "e", "type": "arithmetic", "params": []},
        {"name": "f", "type": "date_to_key", "params": {}},
    ]
    with pytest.raises(ValueError) as e:
        model_from_mapping(faulty, SCHEMAS, {"nothing": []})
    text = str(e.value)
    for fault in (
        "file teams: no file_name", "file agents: no schema of 'Nobody'", "file orders: unknown file type 'weekly'",
        "file tickets: pii_fields: email is not in its schema", "table AgentsDim: unknown source teams", "table FactTickets: column f: no column",
        "1 left and 2 right keys", "unknown type 'cross'", "column a: unknown type 'guess'", "column b: unknown unit 'weeks'",
        "column c: unknown comparison '~'", "column d: unknown operator '^'", "column e: no terms", "rules of an unknown file nothing",
    ):
        assert fault in text, fault


@pytest.mark.parametrize("key", ["table_type", "primary_key"])
def test_a_table_needs(mapping, key):
    del mapping["tables"]["CitiesDim"][key]
    with pytest.raises(ValueError, match=f"table CitiesDim: no {key}.*RegionsDim: refers|table CitiesDim: no {key}"):
        model_from_mapping(mapping, SCHEMAS)


def test_unknown_and_circular_references(mapping):
    mapping["tables"]["CitiesDim"]["foreign_keys"] = {"city_id": "RegionsDim"}
    with pytest.raises(ValueError, match="circle"):
        model_from_mapping(mapping, SCHEMAS)
    mapping["tables"]["CitiesDim"]["foreign_keys"] = {"city_id": {"dim_table": "Nowhere"}}
    with pytest.raises(ValueError, match="table CitiesDim: refers to the unknown table Nowhere"):
        model_from_mapping(mapping, SCHEMAS)
