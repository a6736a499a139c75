"""Which fields of embedded structs become columns."""

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import types as T

from tablecontract import Contract, column
from tablecontract.operators.promote import promoted_fields

S = T.StringType()


def struct(*fields):
    return T.StructType(list(fields))


ID_KIND = struct(column("id", S), column("kind", S))


@pytest.mark.parametrize(
    "fields, expected",
    [
        ([column("e", ID_KIND, embed=True), column("name", S)], ["id", "kind", "name"]),
        ([column("e", ID_KIND, embed=True, name="base"), column("name", S)], ["base", "name"]),
        ([column("e", ID_KIND, embed=True, skip=True), column("name", S)], ["name"]),
        ([column("e", ID_KIND, embed=True), column("id", S), column("name", S)], ["kind", "id", "name"]),
        (
            [column("e", ID_KIND, embed=True), column("f", struct(column("id", S)), embed=True), column("name", S)],
            ["kind", "name"],
        ),
        (
            [
                column("e", struct(column("Value", S)), embed=True),
                column("f", struct(column("v", S, name="Value")), embed=True),
                column("name", S),
            ],
            ["Value", "name"],
        ),
        (
            [column("m", struct(column("e", ID_KIND, embed=True), column("middle", S)), embed=True), column("name", S)],
            ["id", "kind", "middle", "name"],
        ),
    ],
)
def test_promotion(fields, expected):
    assert [c.name for c in Contract.of(struct(*fields)).columns] == expected


def test_a_named_embed_is_json_or_a_record():
    for options, kind in (({}, "JSON"), ({"record": True}, "RECORD")):
        contract = Contract.of(struct(column("e", ID_KIND, embed=True, name="base", **options)))
        assert [c.type for c in contract.columns] == [kind]


def test_a_tie_named_on_both_sides_stays_unresolved():
    fields = [column("e", struct(column("a", S, name="v")), embed=True), column("f", struct(column("b", S, name="v")), embed=True)]
    assert promoted_fields(struct(*fields)) == []


def nested(depth):
    leaf = st.sampled_from("abc").map(lambda n: column(n, S))
    if depth == 0:
        return st.lists(leaf, min_size=1, max_size=3, unique_by=lambda f: f.name).map(lambda fs: struct(*fs))
    inner = nested(depth - 1).map(lambda s: column("e", s, embed=True))
    return st.lists(st.one_of(leaf, inner), min_size=1, max_size=4, unique_by=lambda f: f.name).map(lambda fs: struct(*fs))


@settings(max_examples=60, deadline=None)
@given(nested(2))
def test_promoted_names_are_distinct_and_in_declaration_order(schema):
    found = promoted_fields(schema)
    assert len({c.name for c in found}) == len(found)
    assert [c.position for c in found] == sorted(c.position for c in found)
    for field in schema.fields:
        if "contract.embed" not in field.metadata:
            assert any(c.name == field.name and c.depth == 1 for c in found)
