"""Rows that break their contract, found and named."""

from pyspark.sql import functions as F

from ..functions.jsontext import is_json
from ..functions.numbers import whole_float_to_integer
from ..operators.gates import REASONS, split, violation_report, with_reasons
from ..types import TableColumn as Col
from .registry import query

_COLUMNS = [
    Col("event_id", "INTEGER", required=True),
    Col("event_type", "STRING", required=True),
    Col("props", "JSON"),
    Col("inner", "RECORD", fields=[Col("user", "INTEGER", required=True)]),
]


def _broken_events(t):
    """NULLs and bad texts at places the SQL can repeat."""
    key = F.col("event_id")
    return t.events.select(
        "event_id",
        F.when(key % 10 != 0, F.col("event_type")).alias("event_type"),
        F.when(key % 15 == 0, F.concat(F.col("props"), F.lit("x"))).otherwise(F.col("props")).alias("props"),
        F.when(key % 7 != 3, F.struct(F.when(key % 12 != 0, F.col("user_id")).alias("user"))).alias("inner"),
    )


_REASONS = """SELECT event_id, unnest(list_filter([
        CASE WHEN event_id % 10 = 0 THEN 'column event_type: a REQUIRED column cannot be NULL' END,
        CASE WHEN event_id % 15 = 0 THEN 'column props: not valid JSON' END,
        CASE WHEN event_id % 7 <> 3 AND event_id % 12 = 0 THEN 'column inner.user: a REQUIRED column cannot be NULL' END],
        lambda x: x IS NOT NULL)) AS reason FROM events"""


@query(f"SELECT event_id, string_agg(reason, '; ' ORDER BY reason) AS reasons FROM ({_REASONS}) GROUP BY event_id")
def q_required_violations(t):
    """The rejected rows with all their reasons."""
    _, rejected = split(with_reasons(_broken_events(t), _COLUMNS))
    return rejected.select("event_id", F.array_join(F.array_sort(REASONS), "; ").alias("reasons"))


@query(f"SELECT reason, count(*) AS rows FROM ({_REASONS}) GROUP BY reason")
def q_violation_report(t):
    return violation_report(with_reasons(_broken_events(t), _COLUMNS))


@query(
    """SELECT event_id, CASE WHEN event_id % 11 = 0
              THEN 'column tags: a repeated column cannot hold a NULL element' ELSE '' END AS reasons FROM events"""
)
def q_null_elements(t):
    tags = F.array("event_type", F.when(F.col("event_id") % 11 != 0, F.col("props")))
    rows = t.events.select("event_id", tags.alias("tags"))
    out = with_reasons(rows, [Col("event_id", "INTEGER"), Col("tags", "STRING", repeated=True)])
    return out.select("event_id", F.array_join(REASONS, "; ").alias("reasons"))


@query(
    """SELECT event_id, json_valid(CASE event_id % 6 WHEN 0 THEN props || 'x' WHEN 1 THEN props || ' 2' WHEN 2 THEN '[' || props
              WHEN 3 THEN '1,' || props WHEN 4 THEN props || ' ' ELSE props END) AS valid FROM events"""
)
def q_json_valid(t):
    props = F.col("props")
    branch = F.col("event_id") % 6
    text = (
        F.when(branch == 0, F.concat(props, F.lit("x")))
        .when(branch == 1, F.concat(props, F.lit(" 2")))
        .when(branch == 2, F.concat(F.lit("["), props))
        .when(branch == 3, F.concat(F.lit("1,"), props))
        .when(branch == 4, F.concat(props, F.lit(" ")))
        .otherwise(props)
    )
    return t.events.select("event_id", is_json(text).alias("valid"))


@query("SELECT event_id, event_id % 3 <> 0 AS nested, event_id % 2 = 0 AS number FROM events")
def q_json_unlimited(t):
    """Texts around the reader's usual limits of 1,000 levels and 1,000 digits: every third lacks a bracket, every second has a bare point at its end."""
    levels, digits = (F.lit(990) + F.col("event_id") % 20).cast("int"), (F.lit(990) + F.col("event_id") % 20).cast("int")
    nested = F.concat(F.repeat(F.lit("["), levels), F.col("props"), F.repeat(F.lit("]"), levels - F.when(F.col("event_id") % 3 == 0, 1).otherwise(0)))
    number = F.concat(F.lit("1"), F.repeat(F.lit("7"), digits), F.when(F.col("event_id") % 2 == 0, "").otherwise("."))
    return t.events.select("event_id", is_json(nested).alias("nested"), is_json(number).alias("number"))


_MIXED = """CASE event_id % 5 WHEN 0 THEN round(value) WHEN 1 THEN value * 1e30 WHEN 2 THEN 9223372036854775808.0::DOUBLE
            WHEN 3 THEN -9223372036854775808.0::DOUBLE ELSE value END"""


@query(
    f"""SELECT event_id, CASE WHEN x % 1 = 0 AND x < 9223372036854775808.0::DOUBLE AND x >= -9223372036854775808.0::DOUBLE
                              THEN CAST(x AS BIGINT) END AS whole
        FROM (SELECT event_id, {_MIXED} AS x FROM events)"""
)
def q_integer_coerce(t):
    """Whole floats become INTEGER; fractions and what does not fit do not."""
    branch, value = F.col("event_id") % 5, F.col("value")
    x = (
        F.when(branch == 0, F.round(value))
        .when(branch == 1, value * 1e30)
        .when(branch == 2, 9223372036854775808.0)
        .when(branch == 3, -9223372036854775808.0)
        .otherwise(value)
    )
    return t.events.select("event_id", whole_float_to_integer(x).alias("whole"))
