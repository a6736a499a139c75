"""Differences between schemas and what the strategies make of them."""

import logging

import pytest
from hypothesis import given, settings, strategies as st

from tablecontract import (
    AddColumns, ContractError, LeaveAlone, Relation, SchemaChange, SchemaConflictError, SchemaDiff, Synchronise, TableColumn as Col,
    TableState, audit, describe, diff_columns, merge_columns,
)
from tablecontract.plans.strategy import strategy_of

LOG = logging.getLogger("test")


def rec(name, *fields):
    return Col(name, "RECORD", fields=fields)


A, B = Col("a", "STRING"), Col("b", "INTEGER")
A_REQUIRED = Col("a", "STRING", required=True)


def summary(diff):
    return (
        [c.name for c in diff.added], list(diff.removed), list(diff.relaxed), [(c.name, c.reason) for c in diff.conflicts]
    )


@pytest.mark.parametrize(
    "want, got, expected",
    [
        ([A, B], [A, B], ([], [], [], [])),
        ([A, B], [B, A], ([], [], [], [])),
        ([A, B], [A], (["b"], [], [], [])),
        ([A], [A, B], ([], ["b"], [], [])),
        ([A], [A_REQUIRED], ([], [], ["a"], [])),
        ([A_REQUIRED], [A], ([], [], [], [("a", "required")])),
        ([Col("a", "INTEGER")], [A], ([], [], [], [("a", "type")])),
        ([Col("a", "STRING", repeated=True)], [A], ([], [], [], [("a", "repeated")])),
        ([Col("a", "INTEGER", required=True)], [A], ([], [], [], [("a", "type")])),
        ([A, B, Col("c", "BOOL")], [A_REQUIRED, Col("b", "STRING"), Col("d", "BOOL")], (["c"], ["d"], ["a"], [("b", "type")])),
        ([A, B], [], (["a", "b"], [], [], [])),
        ([rec("r", A, B)], [rec("r", B, A)], ([], [], [], [])),
        ([rec("r", A, B)], [rec("r", A)], ([], [], [], [("r", "nested")])),
        ([rec("r", A)], [rec("r", A_REQUIRED)], ([], [], [], [("r", "nested")])),
        ([rec("r", rec("s", A))], [rec("r", rec("s", B))], ([], [], [], [("r", "nested")])),
        ([rec("r", rec("s", A, B))], [rec("r", rec("s", B, A))], ([], [], [], [])),
        ([Col("n", "NUMERIC", scale=2, description="x")], [Col("n", "NUMERIC")], ([], [], [], [])),
    ],
)
def test_diff(want, got, expected):
    assert summary(diff_columns(want, got)) == expected


def test_without_and_mentions():
    diff = diff_columns([A, B, Col("c", "BOOL")], [A_REQUIRED, Col("b", "STRING"), Col("d", "BOOL")])
    assert summary(diff.without(["b", "d"])) == (["c"], [], ["a"], [])
    assert diff.mentions(["d", "b", "x"]) == ["d", "b"]
    assert diff.without([]) == diff and SchemaDiff().is_empty


def test_conflicts_come_as_one_error():
    diff = diff_columns([Col("a", "INTEGER"), Col("b", "INTEGER", repeated=True), rec("r", A)], [A, B, rec("r", B)])
    with pytest.raises(SchemaConflictError) as err:
        diff.raise_conflicts()
    text = str(err.value)
    assert "a: no migration leads from NULLABLE STRING to NULLABLE INTEGER (type)" in text
    assert "b: no migration leads from" in text and "(repeated)" in text
    assert "RECORD of b to NULLABLE RECORD of a (nested)" in text
    assert len(err.value.conflicts) == 3


# -- strategies -------------------------------------------------------------------------

DIFFERENT = TableState(True, diff_columns([Col("keep", "STRING"), Col("new", "STRING")], [Col("keep", "STRING", required=True), Col("legacy", "STRING")]))
CONFLICT = TableState(True, diff_columns([Col("a", "INTEGER")], [A]))
NEW = Col("new", "STRING")


@pytest.mark.parametrize(
    "strategy, change",
    [
        (LeaveAlone(), SchemaChange()),
        (AddColumns(), SchemaChange(add=(NEW,), relax=("keep",))),
        (Synchronise(), SchemaChange(add=(NEW,), relax=("keep",), drop=("legacy",))),
        (Synchronise(ignore=["legacy"]), SchemaChange(add=(NEW,), relax=("keep",))),
        (Synchronise(ignore=["keep", "new", "legacy"]), SchemaChange()),
    ],
)
def test_what_they_ask_for(strategy, change):
    assert strategy(DIFFERENT, LOG) == change


@pytest.mark.parametrize("strategy", [LeaveAlone(), AddColumns(), Synchronise()])
def test_conflicts_block_everything(strategy):
    with pytest.raises(SchemaConflictError):
        strategy(CONFLICT, LOG)


def test_ignored_columns_suppress_conflicts():
    assert Synchronise(ignore=["a"])(CONFLICT, LOG).is_empty
    with pytest.raises(ContractError):
        Synchronise(ignore=[""])


def test_only_ignored_columns_that_differ_are_reported(caplog):
    agrees = TableState(True, diff_columns([A, B], [A, Col("b", "STRING")]))
    with caplog.at_level(logging.WARNING):
        Synchronise(ignore=["a", "b"])(agrees, LOG)
    assert "['b']" in caplog.text


@pytest.mark.parametrize("kind", [LeaveAlone, AddColumns, Synchronise])
def test_creation_has_to_be_asked_for(kind):
    assert kind(create=True)(TableState(False), LOG).create
    assert not kind(create=False)(TableState(False), LOG).create


def test_named_strategies():
    assert strategy_of("append") == AddColumns(create=True)
    assert strategy_of("none") == LeaveAlone(create=False)
    assert strategy_of("sync", ["x"], True) == Synchronise(("x",), True)
    custom = lambda state, log: SchemaChange()
    assert strategy_of(custom) is custom
    for bad in (("merge",), ("append", ["x"])):
        with pytest.raises(ContractError):
            strategy_of(*bad)


# -- merging ----------------------------------------------------------------------------


def test_merge_keeps_the_tables_order():
    table = (A_REQUIRED, Col("legacy", "STRING"))
    merged = merge_columns(table, [B], ["a"])
    assert [(c.name, c.required) for c in merged] == [("a", False), ("legacy", False), ("b", False)]
    assert table[0].required


columns = st.lists(
    st.builds(Col, st.sampled_from("abcdef"), st.sampled_from(["STRING", "INTEGER"]), st.booleans()), max_size=6, unique_by=lambda c: c.name
)


@settings(max_examples=200, deadline=None)
@given(columns, columns)
def test_nothing_is_left_to_add_or_relax_after_a_merge(want, got):
    diff = diff_columns(want, got)
    again = diff_columns(want, merge_columns(got, diff.added, diff.relaxed))
    assert not again.added and not again.relaxed
    assert again.removed == diff.removed and [c.name for c in again.conflicts] == [c.name for c in diff.conflicts]


# -- addresses and audits ---------------------------------------------------------------


def test_relations():
    assert Relation.parse("p.d.t") == Relation("d", "t", "p")
    assert str(Relation.parse("d.t")) == "d.t"
    assert Relation.parse("p.d.t").location("/w/") == "/w/p/d/t"
    for bad in ("t", "", "a.b.c.d", "d.", ".t", "p..t"):
        with pytest.raises(ContractError):
            Relation.parse(bad)


def test_an_audit_agrees_with_the_diff(spark):
    want = {"t": [A, B, Col("c", "BOOL"), rec("r", A, B), rec("s", A)], "u": [A]}
    got = {"t": [A_REQUIRED, Col("b", "STRING"), Col("d", "BOOL"), rec("r", B, A), rec("s", B)], "v": [A]}
    found = {(r["table"], r["path"]): r["change"] for r in audit(describe(spark, want), describe(spark, got)).collect()}
    assert found == {
        ("t", "a"): "relaxed", ("t", "b"): "conflict: type", ("t", "c"): "added", ("t", "d"): "removed",
        ("t", "r"): "same", ("t", "s"): "conflict: nested", ("u", "a"): "added", ("v", "a"): "removed",
    }
