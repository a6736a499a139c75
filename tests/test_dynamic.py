"""Rows whose columns are settled at run time."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F, types as T

from tablecontract import Contract, ContractError, Override, TableColumn as Col, conform_dynamic
from tablecontract.operators.gates import REASONS


def variants(spark, **values):
    """One row holding a map of variants, from SQL expressions."""
    entries = ", ".join(f"'{k}', cast({v} as variant)" for k, v in values.items())
    return spark.sql(f"select map({entries}) as row" if entries else "select cast(map() as map<string,variant>) as row")


def reasons(df, contract, **options):
    return conform_dynamic(df, contract, "row", mode="reasons", **options).first()[REASONS]


def one(kind, **options):
    return Contract.dynamic([Col("v", kind, **options)])


# Kept together: what each column type takes, as (SQL value, what is read back).
ACCEPTED = [
    ("STRING", "'x'", "x"), ("GEOGRAPHY", "'POINT(1 2)'", "POINT(1 2)"), ("BOOL", "true", True),
    ("INTEGER", "7L", 7), ("INTEGER", "7S", 7), ("INTEGER", "7.0D", 7), ("INTEGER", "9223372036854775807L", 2**63 - 1),
    ("INTEGER", "cast(5 as decimal(20,0))", 5), ("INTEGER", "-9223372036854775808D", -(2**63)),
    ("FLOAT", "1.5D", 1.5), ("FLOAT", "cast(1.5 as float)", 1.5),
    ("NUMERIC", "cast(12.5 as decimal(5,1))", Decimal("12.5")),
    ("BYTES", "X'6279'", bytearray(b"by")), ("DATE", "date'2019-03-14'", dt.date(2019, 3, 14)),
    ("DATETIME", "timestamp_ntz'2019-03-14 05:20:00'", dt.datetime(2019, 3, 14, 5, 20)),
    ("TIME", "'12:30:00.5'", "12:30:00.5"), ("JSON", "'{\"a\": 1.50}'", '{"a": 1.50}'), ("JSON", "X'7b7d'", "{}"), ("JSON", "''", None),
]


@pytest.mark.parametrize("kind, sql, expected", ACCEPTED)
def test_accepted(spark, kind, sql, expected):
    df = variants(spark, v=sql)
    assert reasons(df, one(kind)) == []
    assert conform_dynamic(df, one(kind), "row").first().v == expected


def test_timestamps(spark):
    out = conform_dynamic(variants(spark, v="timestamp'2019-03-14T05:20:00Z'"), one("TIMESTAMP"), "row")
    assert out.select(F.unix_micros("v")).first()[0] == 1552540800000000


@pytest.mark.parametrize(
    "kind, sql",
    [
        ("STRING", "1"), ("INTEGER", "'1'"), ("INTEGER", "true"), ("INTEGER", "1.5D"), ("INTEGER", "double('NaN')"),
        ("INTEGER", "double('Infinity')"), ("INTEGER", "1e30D"), ("INTEGER", "-1e30D"), ("INTEGER", "9223372036854775807D"),
        ("INTEGER", "cast('18446744073709551615' as decimal(20,0))"), ("INTEGER", "cast(1.5 as decimal(5,1))"),
        ("FLOAT", "1"), ("FLOAT", "cast(1.5 as decimal(5,1))"), ("NUMERIC", "1.5D"), ("NUMERIC", "1"), ("BOOL", "'true'"),
        ("TIMESTAMP", "'2019-03-14T05:20:00Z'"), ("TIMESTAMP", "timestamp_ntz'2019-03-14 05:20:00'"), ("DATE", "'2019-03-14'"),
        ("DATETIME", "'2019-03-14T05:20:00'"), ("TIME", "'noon'"), ("TIME", "'24:00:00'"), ("TIME", "1"), ("BYTES", "'text'"),
        ("JSON", "1"), ("JSON", "array(1)"), ("GEOGRAPHY", "1"),
    ],
)
def test_refused(spark, kind, sql):
    df = variants(spark, v=sql)
    found = reasons(df, one(kind))
    assert len(found) == 1 and found[0].startswith("column v")
    with pytest.raises(Exception, match="column v"):
        conform_dynamic(df, one(kind), "row").collect()


def test_keys(spark):
    contract = Contract.dynamic([Col("a", "STRING"), Col("req", "STRING", required=True)])
    assert reasons(variants(spark, a="'x'", req="'y'"), contract) == []
    assert conform_dynamic(variants(spark, req="'y'"), contract, "row").first().a is None
    assert reasons(variants(spark, req="'y'", b="1", c="2"), contract) == ["undeclared column b, c"]
    assert reasons(variants(spark, a="'x'"), contract) == ["column req: a REQUIRED column cannot be NULL"]
    assert reasons(variants(spark, req="parse_json('null')"), contract) == ["column req: a REQUIRED column cannot be NULL"]
    assert reasons(variants(spark, REQ="'y'", req="'y'"), contract) == ["undeclared column REQ"]


def test_null_rows(spark):
    contract = one("STRING")
    df = spark.sql("select cast(null as map<string,variant>) as row")
    assert reasons(df, contract) == ["the row is NULL"]
    with pytest.raises(Exception, match="the row is NULL"):
        conform_dynamic(df, contract, "row").collect()


RECORD = [Col("A", "STRING", required=True), Col("B", "INTEGER")]
NESTED = Contract.dynamic(
    [
        Col("inner", "RECORD", fields=RECORD),
        Col("items", "RECORD", repeated=True, fields=RECORD),
        Col("tags", "STRING", repeated=True),
        Col("deep", "RECORD", fields=[Col("r", "RECORD", fields=[Col("l", "INTEGER", repeated=True)])]),
    ]
)


def json_rows(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "row string")


def test_records_and_lists(spark):
    text = '{"inner": {"A": "a", "B": 1}, "items": [{"A": "x"}, {"A": "y", "B": 2}], "tags": ["p", "q"], "deep": {"r": {"l": [1, 2]}}}'
    got = conform_dynamic(json_rows(spark, text), NESTED, "row", source="json").first()
    assert got.inner.asDict() == {"A": "a", "B": 1}
    assert [r.asDict() for r in got["items"]] == [{"A": "x", "B": None}, {"A": "y", "B": 2}]
    assert (got.tags, got.deep.r.l) == (["p", "q"], [1, 2])
    assert conform_dynamic(json_rows(spark, "{}"), NESTED, "row", source="json").first() == (None, None, None, None)


@pytest.mark.parametrize(
    "text, expected",
    [
        ('{"inner": "text"}', "column inner: RECORD does not take STRING"),
        ('{"inner": {"B": 1}}', "column inner.A: a REQUIRED column cannot be NULL"),
        ('{"inner": {"A": "a", "C": 1}}', "undeclared column inner.C"),
        ('{"items": {"A": "x"}}', "column items: a REPEATED column needs a list"),
        ('{"items": [{"B": 1}]}', "column items[].A: a REQUIRED column cannot be NULL"),
        ('{"items": [{"A": "x", "Z": 1}]}', "undeclared column items[].Z"),
        ('{"items": [null]}', "column items: a repeated column cannot hold a NULL element"),
        ('{"tags": ["x", null]}', "column tags: a repeated column cannot hold a NULL element"),
        ('{"tags": ["x", 1]}', "column tags[]: STRING does not take BIGINT"),
        ('{"deep": {"r": {"l": [1, 1.5]}}}', "INTEGER takes whole numbers of 64 bits only"),
        ('{"deep": {"r": {"x": 1}}}', "undeclared column deep.r.x"),
        ("not json", "the row is not a JSON object"),
        ("[1]", "the row is not a JSON object"),
    ],
)
def test_nested_refusals(spark, text, expected):
    found = reasons(json_rows(spark, text), NESTED, source="json")
    assert len(found) == 1 and found[0].endswith(expected)


def test_json_numbers_have_no_type_of_their_own(spark):
    contract = Contract.dynamic([Col("i", "INTEGER"), Col("f", "FLOAT"), Col("n", "NUMERIC")])
    got = conform_dynamic(json_rows(spark, '{"i": 7.0, "f": 7, "n": 1.25}'), contract, "row", source="json").first()
    assert (got.i, got.f, got.n) == (7, 7.0, Decimal("1.25"))
    assert reasons(json_rows(spark, '{"i": 18446744073709551615}'), contract, source="json") == ["column i: INTEGER takes whole numbers of 64 bits only"]
    assert reasons(json_rows(spark, '{"n": 1e35}'), contract, source="json") == ["column n: a number does not fit in NUMERIC"]


# -- t_dynamic_override -----------------------------------------------------------------


def test_overrides_go_by_the_values_type(spark):
    shout = Override(T.StringType(), "STRING", F.upper)
    contract = Contract.dynamic([Col("v", "STRING"), Col("l", "STRING", repeated=True)], overrides=[shout])
    got = conform_dynamic(variants(spark, v="'x'", l="array('a')"), contract, "row").first()
    assert (got.v, got.l) == ("X", ["A"])
    opens = Override(T.LongType(), "STRING", lambda c: F.concat(F.lit("#"), c))
    contract = Contract.dynamic([Col("v", "STRING")], overrides=[opens])
    assert conform_dynamic(variants(spark, v="7L"), contract, "row").first().v == "#7"
    assert conform_dynamic(variants(spark, v="'x'"), contract, "row").first().v == "x"


def test_an_override_of_another_column_type_is_refused(spark):
    contract = Contract.dynamic([Col("v", "INTEGER")], overrides=[Override(T.StringType(), "STRING", F.upper)])
    found = reasons(variants(spark, v="'x'"), contract)
    assert found == ["column v: the override of string declares STRING, but the column is INTEGER"]


def test_modes_and_sources(spark):
    contract = one("STRING")
    for options in ({"source": "xml"}, {"mode": "drop"}):
        with pytest.raises(ContractError):
            conform_dynamic(variants(spark, v="'x'"), contract, "row", **options)
    bad = conform_dynamic(variants(spark, v="1"), contract, "row", mode="values").first()
    assert bad.asDict() == {"v": "1"}


def test_a_row_is_parsed_once(spark):
    rows = json_rows(spark, '{"tags": ["x"]}')
    for mode in ("fail", "reasons"):
        out = conform_dynamic(rows, NESTED, "row", source="json", mode=mode)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("parseJson") == 1 and "Exchange" not in plan
