"""Descriptions of rows against a walk in plain Python, and audits of records at any depth."""

import json
import random

import pytest
from pyspark.sql import functions as F

from tablecontract import audit, describe, observe_entries
from tablecontract.operators import audit as module
from tablecontract.types import TableColumn as Col


def rec(name, *fields, repeated=False, required=False):
    return Col(name, "RECORD", fields=fields, repeated=repeated, required=required)


def observed(spark, rows):
    """Rows of (table, JSON text of a record), each value of it a variant."""
    frame = spark.createDataFrame(rows, "t string, doc string")
    return observe_entries(frame.withColumn("e", F.expr("cast(parse_json(doc) as map<string,variant>)")), "t", "e")


def kind_of(value):
    """Contract type of a value that is no list; none for null."""
    if isinstance(value, bool):
        return "BOOL"
    if isinstance(value, dict):
        return "RECORD"
    return {int: "INTEGER", float: "NUMERIC", str: "STRING"}.get(type(value))


def walk(rows):
    """Type, mode and number of rows of each table and path."""
    cells, objects = {}, {}

    def visit(table, path, record):
        objects[table, path] = objects.get((table, path), 0) + 1
        for key, value in record.items():
            at = (*path, key)
            if isinstance(value, list):
                there = [v for v in value if v is not None]
                kinds = {kind_of(v) if not isinstance(v, list) else "ARRAY" for v in there}
                kind = kinds.pop() if len(kinds) == 1 else None if not there else "VARIANT"
                repeated = True
            elif value is None:
                continue
            else:
                there, kind, repeated = [value], kind_of(value), False
            cells.setdefault((table, at), {}).setdefault((kind, repeated), 0)
            cells[table, at][kind, repeated] += 1
            for v in there:
                if isinstance(v, dict):
                    visit(table, at, v)

    for table, doc in rows:
        visit(table, (), json.loads(doc))
    out = set()
    for (table, path), kinds in cells.items():
        typed = any(k is not None and r for k, r in kinds)
        for (kind, repeated), n in kinds.items():
            if kind is None and typed:
                continue
            spare = kinds.get((None, True), 0) if typed and repeated else 0
            out.add((table, path, kind, repeated, not repeated and n == objects[table, path[:-1]], n + spare))
    return out


def some(r, depth):
    if depth == 0 or r.random() < 0.4:
        return r.choice([1, True, "x", None, 7])
    if r.random() < 0.35:
        return [some(r, depth - 1) for _ in range(r.choice([0, 1, 2]))]
    return {k: some(r, depth - 1) for k in r.sample(["a", "b, c", "d: e", "f<g>", "", "h.i", "`j`", "OBJECT<k", 'l"'], r.choice([0, 1, 2, 3]))}


@pytest.mark.parametrize("levels", [1, 3])
def test_descriptions_are_those_of_a_walk(spark, monkeypatch, levels):
    monkeypatch.setattr(module, "LEVELS", levels)
    r = random.Random(levels)
    rows = [(r.choice("tu"), json.dumps({k: some(r, 6) for k in r.sample(["a", "b, c", "m", "n"], 3)})) for _ in range(150)]
    rows += [("v", "{}"), ("v", '{"only": {"one": {"two": {"three": {"four": {"five": {"six": [{"seven": [1]}]}}}}}}}')]
    out = observed(spark, rows)
    assert {(x["table"], tuple(x.path), x.type, x.repeated, x.required, x.rows) for x in out.collect()} == walk(rows) and out.where("not seen").isEmpty()


def changes(spark, want, rows):
    return {(x["table"], x.path): (x.change, list(x.inside)) for x in audit(describe(spark, want), observed(spark, rows)).collect()}


def test_records_as_declared_are_the_same(spark):
    deep = rec("r", rec("s", Col("a", "INTEGER"), Col("tags", "STRING", repeated=True)), rec("list", Col("n", "INTEGER"), repeated=True), Col("always", "STRING", required=True))
    doc = '{"r": {"s": {"a": 1, "tags": ["x"]}, "list": [{"n": 1}, {"n": 2}], "always": "y"}}'
    got = changes(spark, {"t": [deep]}, [("t", doc), ("t", '{"r": {"s": {"tags": []}, "list": [], "always": "z"}}'), ("t", "{}")])
    assert got == {("t", "r"): ("same", [])}


def test_what_differs_inside_is_named(spark):
    want = {"t": [rec("r", rec("s", Col("a", "INTEGER"), Col("gone", "STRING")), Col("x, y", "STRING"), Col("must", "STRING", required=True))]}
    rows = [("t", '{"r": {"s": {"a": "text"}, "x, y": "z", "new": 1, "must": "m"}}'), ("t", '{"r": {"s": {"a": "b"}, "x, y": "z"}}')]
    assert changes(spark, want, rows) == {("t", "r"): ("conflict: nested", ["r.must", "r.new", "r.s.a", "r.s.gone"])}


def test_keys_of_any_text(spark):
    doc = json.dumps({"a, b": {"c: d": 1, "OBJECT<": {"e>": [True]}}, "`q`": 2})
    want = {"t": [rec("a, b", Col("c: d", "INTEGER"), rec("OBJECT<", Col("e>", "BOOL", repeated=True))), Col("`q`", "INTEGER", required=True)]}
    got = changes(spark, {"t": [rec("a, b", *want["t"][0].fields, required=True), want["t"][1]]}, [("t", doc)])
    assert {k: v[0] for k, v in got.items()} == {("t", "a, b"): "same", ("t", "`q`"): "same"}


def test_other_types_have_no_inside(spark):
    want = {"t": [rec("r", Col("a", "STRING")), Col("p", "STRING"), rec("q", Col("a", "STRING"))]}
    rows = [("t", '{"r": 1, "p": {"a": 1}, "new": {"b": {"c": 1}}}')]
    assert changes(spark, want, rows) == {
        ("t", "r"): ("conflict: type", []), ("t", "p"): ("conflict: type", []), ("t", "q"): ("added", []), ("t", "new"): ("removed", [])}


def test_lists_of_records_and_of_records_with_other_things(spark):
    want = {"t": [rec("r", Col("a", "INTEGER"), repeated=True)], "u": [rec("r", Col("a", "INTEGER"), repeated=True)]}
    rows = [("t", '{"r": [{"a": 1}, {"a": 2}]}'), ("u", '{"r": [{"a": 1}, "x"]}')]
    assert changes(spark, want, rows) == {("t", "r"): ("same", []), ("u", "r"): ("conflict: type", [])}


def test_no_rows(spark):
    empty = spark.createDataFrame([], "t string, e map<string,variant>")
    assert observe_entries(empty, "t", "e").count() == 0
    assert [x.change for x in audit(describe(spark, {"t": [rec("r", Col("a", "STRING"))]}), observe_entries(empty, "t", "e")).collect()] == ["added"]
