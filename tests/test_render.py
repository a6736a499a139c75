"""Rows as JSON text in both dialects."""

import json

import pytest
from pyspark.sql import functions as F

from tablecontract import APPEND, LOAD, ContractError, TableColumn as Col, render, write_ndjson

INNER = [Col("B", "INTEGER"), Col("A", "STRING")]
AT = "timestamp'2024-02-29T23:05:09Z'"


def text(spark, columns, dialect=LOAD, **values):
    df = spark.range(1).select(*[F.expr(v).alias(k) for k, v in values.items()])
    return render(df, columns, dialect=dialect).first().json


# Kept together: expected texts of the load dialect.
LOAD_TEXTS = [
    ([Col("at", "TIMESTAMP")], {"at": AT}, '{"at":"2024-02-29T23:05:09Z"}'),
    ([Col("at", "TIMESTAMP")], {"at": "timestamp'2024-02-29T23:05:09.120Z'"}, '{"at":"2024-02-29T23:05:09.12Z"}'),
    (
        [Col("t", "TIME"), Col("d", "DATE"), Col("dt", "DATETIME")],
        {"t": "'23:05:09'", "d": "date'2024-02-29'", "dt": "timestamp_ntz'2024-02-29 23:05:09'"},
        '{"d":"2024-02-29","dt":"2024-02-29T23:05:09","t":"23:05:09"}',
    ),
    (
        [Col("t", "TIME"), Col("dt", "DATETIME")],
        {"t": "'23:05:09.5'", "dt": "timestamp_ntz'2024-02-29 23:05:09.000001'"},
        '{"dt":"2024-02-29T23:05:09.000001000","t":"23:05:09.500000000"}',
    ),
    ([Col("n", "NUMERIC")], {"n": "cast(12.5 as decimal(38,9))"}, '{"n":"12.500000000"}'),
    ([Col("n", "NUMERIC")], {"n": "cast('18446744073709551615' as decimal(38,9))"}, '{"n":"18446744073709551615"}'),
    ([Col("n", "NUMERIC", scale=2)], {"n": "cast(0.33 as decimal(38,2))"}, '{"n":"0.33"}'),
    ([Col("n", "NUMERIC", scale=2)], {"n": "cast('-505.97' as decimal(38,2))"}, '{"n":"-505.97"}'),
    ([Col("n", "NUMERIC")], {"n": "cast(-3 as decimal(38,9))"}, '{"n":"-3"}'),
    ([Col("b", "BYTES")], {"b": "cast('bytes' as binary)"}, '{"b":"Ynl0ZXM="}'),
    ([Col("a", "STRING")], {"a": "cast(null as string)"}, '{"a":null}'),
    ([Col("tags", "STRING", repeated=True)], {"tags": "array('x','y')"}, '{"tags":["x","y"]}'),
    ([Col("inner", "RECORD", fields=INNER)], {"inner": "named_struct('B',1L,'A','a')"}, '{"inner":{"A":"a","B":1}}'),
    (
        [Col("items", "RECORD", repeated=True, fields=INNER)],
        {"items": "array(named_struct('B',1L,'A','a'), named_struct('B',2L,'A','b'))"},
        '{"items":[{"A":"a","B":1},{"A":"b","B":2}]}',
    ),
    ([Col("j", "JSON")], {"j": "'{\"k\": \"v\"}'"}, '{"j":{"k":"v"}}'),
    ([Col("j", "JSON")], {"j": "'[1, 2.50]'"}, '{"j":[1,2.50]}'),
    ([Col("j", "JSON"), Col("a", "INTEGER"), Col("z", "INTEGER")], {"j": "''", "a": "1L", "z": "2L"}, '{"a":1,"j":null,"z":2}'),
    ([Col("a", "STRING")], {"a": "'http://h/p?q=<1>&r'"}, '{"a":"http://h/p?q=<1>&r"}'),
]


@pytest.mark.parametrize("columns, values, expected", LOAD_TEXTS)
def test_load_texts(spark, columns, values, expected):
    assert text(spark, columns, **values) == expected


def test_the_append_dialect_differs_in_two_types(spark):
    assert text(spark, [Col("at", "TIMESTAMP")], APPEND, at=AT) == '{"at":1709247909000000}'
    assert text(spark, [Col("doc", "JSON")], APPEND, doc="'{\"k\":\"v\"}'") == '{"doc":"{\\"k\\":\\"v\\"}"}'
    assert text(spark, [Col("doc", "JSON")], APPEND, doc="''") == '{"doc":null}'
    same = [c for c in LOAD_TEXTS if not any(f.type in ("TIMESTAMP", "JSON") for f in c[0])]
    for columns, values, expected in same:
        assert text(spark, columns, APPEND, **values) == expected


def test_json_inside_records_and_lists(spark):
    columns = [
        Col("r", "RECORD", fields=[Col("j", "JSON"), Col("at", "TIMESTAMP"), Col("a", "INTEGER")]),
        Col("rs", "RECORD", repeated=True, fields=[Col("j", "JSON")]),
        Col("js", "JSON", repeated=True),
        Col("none", "RECORD", fields=[Col("j", "JSON")]),
        Col("nones", "JSON", repeated=True),
    ]
    values = {
        "r": f"named_struct('j','{{\"k\": 1}}','at',{AT},'a',1L)",
        "rs": "array(named_struct('j','[1]'), named_struct('j',cast(null as string)))",
        "js": "array('1', '\"x y\"')",
        "none": "cast(null as struct<j:string>)",
        "nones": "cast(null as array<string>)",
    }
    expected = (
        '{"js":[1,"x y"],"none":null,"nones":null,"r":{"a":1,"at":"2024-02-29T23:05:09Z","j":{"k":1}},'
        '"rs":[{"j":[1]},{"j":null}]}'
    )
    assert text(spark, columns, **values) == expected
    quoted = json.loads(text(spark, columns, APPEND, **values))
    assert quoted["r"] == {"a": 1, "at": 1709247909000000, "j": '{"k": 1}'}
    assert quoted["js"] == ["1", '"x y"']


def test_gates(spark):
    required = [Col("req", "STRING", required=True)]
    for dialect in (LOAD, APPEND):
        with pytest.raises(Exception, match="REQUIRED"):
            text(spark, required, dialect, req="cast(null as string)")
        with pytest.raises(Exception, match="NaN"):
            text(spark, [Col("f", "FLOAT")], dialect, f="double('NaN')")
    with pytest.raises(Exception, match="not valid JSON"):
        text(spark, [Col("j", "JSON")], j="'{'")
    assert text(spark, [Col("j", "JSON")], APPEND, j="'{'") == '{"j":"{"}'


def test_unknown_columns_and_dialects(spark):
    with pytest.raises(ContractError, match="no column x"):
        text(spark, [Col("a", "STRING")], a="'1'", x="'2'")
    with pytest.raises(ContractError, match="dialect"):
        text(spark, [Col("a", "STRING")], "csv", a="'1'")


def test_ndjson_files(spark, place):
    df = spark.range(3).select("id", F.lit('{"a": 1}').alias("j"))
    write_ndjson(df, [Col("id", "INTEGER"), Col("j", "JSON")], place)
    lines = sorted(r.value for r in spark.read.text(place).collect())
    assert lines == [f'{{"id":{i},"j":{{"a":1}}}}' for i in range(3)]
