"""Rows as interchange JSON."""

from pyspark.sql import functions as F, types as T

from ..functions.temporal import to_time
from ..operators.render import APPEND, LOAD, render, write_ndjson
from ..sources.files import shared_folder
from ..types import TableColumn as Col
from .registry import query

# A timestamp with its fraction's trailing zeros dropped, as RFC 3339 text.
_RFC3339 = "replace(CAST(ts AS VARCHAR), ' ', 'T') || 'Z'"

_EVENT = [
    Col("user_id", "INTEGER"),
    Col("event_id", "INTEGER", required=True),
    Col("ts", "TIMESTAMP"),
    Col("event_type", "STRING"),
    Col("value", "FLOAT"),
    Col("props", "JSON"),
    Col("note", "STRING"),
    Col("tags", "STRING", repeated=True),
    Col("inner", "RECORD", fields=[Col("b", "INTEGER"), Col("a", "STRING"), Col("doc", "JSON")]),
]


def _events(t):
    return t.instants.select(
        "event_id",
        "ts",
        F.when(F.col("event_id") % 9 != 0, F.col("user_id")).alias("user_id"),
        F.concat(F.col("event_type"), F.lit("&<x>")).alias("event_type"),
        "value",
        "props",
        F.lit(None).cast("string").alias("note"),
        F.array("event_type", F.lit('q"')).alias("tags"),
        F.when(
            F.col("event_id") % 4 != 0,
            F.struct(F.col("user_id").alias("b"), F.col("event_type").alias("a"), F.col("props").alias("doc")),
        ).alias("inner"),
    )


def _event_json(props, inner_doc, ts):
    return f"""SELECT event_id, to_json({{'event_id': event_id, 'event_type': event_type || '&<x>',
                 'inner': CASE WHEN event_id % 4 <> 0 THEN {{'a': event_type, 'b': user_id, 'doc': {inner_doc}}} END,
                 'note': NULL, 'props': {props}, 'tags': [event_type, 'q"'], 'ts': {ts},
                 'user_id': CASE WHEN event_id % 9 <> 0 THEN user_id END, 'value': value}})::VARCHAR AS json FROM events"""


@query(_event_json("props::JSON", "props::JSON", _RFC3339))
def q_ndjson_load(t):
    events = _events(t).withColumn("key", F.col("event_id"))
    return render(events, _EVENT, dialect=LOAD, keep=["key"]).withColumnRenamed("key", "event_id")


@query(_event_json("props", "props", "epoch_us(ts)"))
def q_ndjson_append(t):
    events = _events(t).withColumn("key", F.col("event_id"))
    return render(events, _EVENT, dialect=APPEND, keep=["key"]).withColumnRenamed("key", "event_id")


def _frac(ts):
    return f"CASE WHEN strftime({ts}, '%f') = '000000' THEN '' ELSE '.' || strftime({ts}, '%f') || '000' END"


@query(
    f"""SELECT event_id, to_json({{'d': CAST(CAST(ts AS DATE) AS VARCHAR),
               'dt': strftime(ts, '%Y-%m-%dT%H:%M:%S') || {_frac('ts')},
               't': strftime(ts, '%H:%M:%S') || {_frac('ts')}}})::VARCHAR AS json FROM events"""
)
def q_civil_text(t):
    """Dates and times without a zone; a fraction has nine digits."""
    rows = t.instants.select(
        F.col("event_id").alias("key"),
        F.col("ts").cast("timestamp_ntz").alias("dt"),
        F.col("ts").cast("date").alias("d"),
        to_time(F.col("ts"), "UTC").alias("t"),
    )
    columns = [Col("d", "DATE"), Col("t", "TIME"), Col("dt", "DATETIME")]
    return render(rows, columns, keep=["key"]).withColumnRenamed("key", "event_id")


@query(
    """SELECT c_custkey, to_json({'n': CASE WHEN n = floor(n) THEN CAST(CAST(n AS DECIMAL(38,0)) AS VARCHAR) ELSE CAST(n AS VARCHAR) END,
                                  's': CASE WHEN s = floor(s) THEN CAST(CAST(s AS DECIMAL(38,0)) AS VARCHAR) ELSE CAST(s AS VARCHAR) END})::VARCHAR AS json
       FROM (SELECT c_custkey, CAST(CASE WHEN c_custkey % 2 = 0 THEN floor(c_acctbal) ELSE c_acctbal END AS DECIMAL(38,9)) AS n,
                    CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS DECIMAL(38,2)) AS s FROM customer)"""
)
def q_decimal_text(t):
    balance = F.col("c_acctbal")
    rows = t.customer.select(
        F.col("c_custkey").alias("key"),
        F.when(F.col("c_custkey") % 2 == 0, F.floor(balance).cast("double")).otherwise(balance).cast("decimal(38,9)").alias("n"),
        balance.cast("decimal(18,2)").cast("decimal(38,2)").alias("s"),
    )
    columns = [Col("n", "NUMERIC"), Col("s", "NUMERIC", scale=2)]
    return render(rows, columns, keep=["key"]).withColumnRenamed("key", "c_custkey")


def _documents(t):
    doc = F.when(F.col("event_id") % 8 != 0, F.concat(F.lit('{ "p" : '), F.col("props"), F.lit(', "l": [ 1, "a b" ] }'))).otherwise("")
    return t.events.select(F.col("event_id").alias("key"), doc.alias("j"), F.array("props", doc).alias("js"))


_DOC = """CASE WHEN event_id % 8 <> 0 THEN '{ "p" : ' || props || ', "l": [ 1, "a b" ] }' END"""
_JSON_COLUMNS = [Col("j", "JSON"), Col("js", "JSON", repeated=True)]


@query(
    f"""SELECT event_id, to_json({{'j': ({_DOC})::JSON, 'js': [props::JSON, ({_DOC})::JSON]}})::VARCHAR AS json FROM events"""
)
def q_json_embed(t):
    """The load dialect embeds the value, white space aside; empty text is null."""
    return render(_documents(t), _JSON_COLUMNS, keep=["key"]).withColumnRenamed("key", "event_id")


@query(f"""SELECT event_id, to_json({{'j': {_DOC}, 'js': [props, {_DOC}]}})::VARCHAR AS json FROM events""")
def q_json_quoted(t):
    """The append dialect quotes the text as it is."""
    return render(_documents(t), _JSON_COLUMNS, dialect=APPEND, keep=["key"]).withColumnRenamed("key", "event_id")


@query(
    """SELECT to_json({'balance': CASE WHEN c_acctbal = floor(c_acctbal) THEN CAST(CAST(c_acctbal AS BIGINT) AS VARCHAR)
                                       ELSE CAST(CAST(c_acctbal AS DECIMAL(18,2)) AS VARCHAR) END,
                       'id': c_custkey, 'name': c_name})::VARCHAR AS line FROM customer"""
)
def q_ndjson_export(t):
    """Files of one JSON object per line, read back as text."""
    rows = t.customer.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").cast("decimal(38,2)").alias("balance")
    )
    path = shared_folder(t.spark, "ndjson") + "/lines"
    write_ndjson(rows, [Col("id", "INTEGER"), Col("name", "STRING"), Col("balance", "NUMERIC", scale=2)], path)
    return t.spark.read.text(path).withColumnRenamed("value", "line")


@query(
    """SELECT doc_id, to_json({'b': to_base64(encode(text)), 'bs': [to_base64(encode(lang)), to_base64(encode(source))]})::VARCHAR AS json
       FROM documents"""
)
def q_base64(t):
    rows = t.documents.select(
        F.col("doc_id").alias("key"),
        F.col("text").cast(T.BinaryType()).alias("b"),
        F.array(F.col("lang").cast(T.BinaryType()), F.col("source").cast(T.BinaryType())).alias("bs"),
    )
    columns = [Col("b", "BYTES"), Col("bs", "BYTES", repeated=True)]
    return render(rows, columns, keep=["key"]).withColumnRenamed("key", "doc_id")
