"""Rows whose columns are settled at run time."""

from pyspark.sql import functions as F, types as T

from ..contract import ROW_ID, Contract
from ..mapping import Override
from ..operators.dynamic import conform_dynamic
from ..operators.gates import REASONS
from ..sources.files import shared_folder
from ..sources.table import GovernedTable
from ..types import TableColumn as Col
from .registry import query



def _entry(value):
    """One value as a variant."""
    return value.cast("variant")


_PAYLOAD = Contract.dynamic(
    [
        Col("k", "INTEGER"),
        Col("kind", "STRING", required=True),
        Col("amount", "FLOAT"),
        Col("at", "TIMESTAMP"),
        Col("absent", "STRING"),
    ]
)


@query(
    """SELECT event_id, CASE WHEN event_id % 3 <> 0 THEN user_id END AS k, event_type AS kind, value AS amount,
              CAST(ts AS VARCHAR) AS at, CAST(NULL AS VARCHAR) AS absent FROM events"""
)
def q_dynamic_columns(t):
    """Typed values in a map of variants; a missing key is NULL."""
    row = F.map_filter(
        F.create_map(
            F.lit("k"), _entry(F.col("user_id").cast("double")),
            F.lit("kind"), _entry(F.col("event_type")),
            F.lit("amount"), _entry(F.col("value")),
            F.lit("at"), _entry(F.col("ts")),
        ),
        lambda key, _: ~((F.col("event_id") % 3 == 0) & (key == "k")),
    )
    return conform_dynamic(t.instants.select("event_id", row.alias("row")), _PAYLOAD, "row", keep=["event_id"])


_JSON_TEXT = """'{"id": ' || event_id || ', "props": ' || props || ', "user": {"id": ' || user_id || ', "kind": "' || event_type
                || '"}, "tags": ["' || event_type || '", "t"], "items": [{"n": 1}, {"n": ' || user_id || '}]}'"""


def _json_rows(t):
    text = F.concat(
        F.lit('{"id": '), F.col("event_id"), F.lit(', "props": '), F.col("props"), F.lit(', "user": {"id": '), F.col("user_id"),
        F.lit(', "kind": "'), F.col("event_type"), F.lit('"}, "tags": ["'), F.col("event_type"),
        F.lit('", "t"], "items": [{"n": 1}, {"n": '), F.col("user_id"), F.lit("}]}"),
    )
    return t.events.select("event_id", text.alias("row"))


_NESTED = Contract.dynamic(
    [
        Col("id", "INTEGER", required=True),
        Col("props", "RECORD", fields=[Col("k", "INTEGER")]),
        Col("user", "RECORD", fields=[Col("id", "INTEGER", required=True), Col("kind", "STRING")]),
        Col("tags", "STRING", repeated=True),
        Col("items", "RECORD", repeated=True, fields=[Col("n", "INTEGER", required=True)]),
    ]
)


@query(
    f"""SELECT CAST(j->>'$.id' AS BIGINT) AS id, CAST(j->>'$.props.k' AS BIGINT) AS k, CAST(j->>'$.user.id' AS BIGINT) AS user_id,
               j->>'$.user.kind' AS kind FROM (SELECT ({_JSON_TEXT})::JSON AS j FROM events)"""
)
def q_dynamic_record(t):
    out = conform_dynamic(_json_rows(t), _NESTED, "row", source="json")
    return out.select(
        "id", F.col("props.k").alias("k"), F.col("user.id").alias("user_id"), F.col("user.kind").alias("kind")
    )


@query(
    f"""SELECT CAST(j->>'$.id' AS BIGINT) AS id, CAST(j->'$.tags' AS VARCHAR) AS tags, CAST(j->'$.items' AS VARCHAR) AS items
        FROM (SELECT ({_JSON_TEXT})::JSON AS j FROM events)"""
)
def q_dynamic_repeated(t):
    return conform_dynamic(_json_rows(t), _NESTED, "row", source="json").select("id", "tags", "items")


@query(
    """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'undeclared column extra' WHEN 1 THEN 'undeclared column inner.z'
              WHEN 2 THEN 'undeclared column a, b' ELSE '' END AS reasons FROM events"""
)
def q_undeclared_keys(t):
    """Keys nobody declared, at the top and inside records."""
    branch = F.col("event_id") % 4
    more = (
        F.when(branch == 0, ', "extra": 1, "inner": {"y": 1}')
        .when(branch == 1, ', "inner": {"y": 1, "z": 2}')
        .when(branch == 2, ', "b": 1, "a": null')
        .otherwise("")
    )
    text = F.concat(F.lit('{"id": '), F.col("event_id"), more, F.lit("}"))
    contract = Contract.dynamic([Col("id", "INTEGER"), Col("inner", "RECORD", fields=[Col("y", "INTEGER")])])
    out = conform_dynamic(
        t.events.select("event_id", text.alias("row")), contract, "row", source="json", keep=["event_id"], mode="reasons"
    )
    return out.select("event_id", F.array_join(REASONS, "; ").alias("reasons"))


@query(
    """SELECT CASE event_id % 7 WHEN 0 THEN 'column s: STRING does not take BIGINT' WHEN 1 THEN 'column i: INTEGER does not take STRING'
                WHEN 2 THEN 'column i: INTEGER takes whole numbers of 64 bits only'
                WHEN 3 THEN 'column b: BOOL does not take STRING' WHEN 4 THEN 'column r: RECORD does not take STRING'
                WHEN 5 THEN 'column l: a REPEATED column needs a list' ELSE 'column l: a repeated column cannot hold a NULL element' END AS reason,
              count(*) AS rows FROM events GROUP BY 1"""
)
def q_type_mismatch(t):
    """What the acceptance table refuses."""
    bad = [
        F.concat(F.lit('"s": '), F.col("event_id")),
        F.concat(F.lit('"i": "'), F.col("event_id"), F.lit('"')),
        F.concat(F.lit('"i": '), F.col("event_id"), F.lit(".5")),
        F.lit('"b": "true"'),
        F.concat(F.lit('"r": "'), F.col("event_type"), F.lit('"')),
        F.lit('"l": "x"'),
        F.lit('"l": ["x", null]'),
    ]
    body = F.element_at(F.array(*bad), (F.col("event_id") % 7 + 1).cast("int"))
    text = F.concat(F.lit("{"), body, F.lit(', "day": null}'))
    contract = Contract.dynamic(
        [
            Col("s", "STRING"),
            Col("i", "INTEGER"),
            Col("b", "BOOL"),
            Col("day", "DATE"),
            Col("r", "RECORD", fields=[Col("a", "STRING")]),
            Col("l", "STRING", repeated=True),
        ]
    )
    out = conform_dynamic(t.events.select(text.alias("row")), contract, "row", source="json", mode="reasons")
    return out.select(F.explode(REASONS).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


@query("""SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'the row is NULL' WHEN 1 THEN 'the row is not a JSON object' ELSE '' END AS reasons,
                 CASE WHEN event_id % 4 > 1 THEN user_id END AS k FROM events""")
def q_null_row(t):
    """Rows that are NULL or no object, beside others."""
    branch = F.col("event_id") % 4
    text = F.when(branch == 1, F.concat(F.lit("["), F.col("user_id"), F.lit("]"))).when(branch > 1, F.concat(F.lit('{"k": '), F.col("user_id"), F.lit("}")))
    contract = Contract.dynamic([Col("k", "INTEGER")])
    out = conform_dynamic(t.events.select("event_id", text.alias("row")), contract, "row", source="json", keep=["event_id"], mode="reasons")
    return out.select("event_id", F.array_join(REASONS, "; ").alias("reasons"), "k")


@query("""SELECT event_id, CASE WHEN event_id % 2 = 0 THEN upper(event_type) ELSE '#' || user_id END AS v, to_json([upper(event_type), upper(props)])::VARCHAR AS l, user_id AS n FROM events""")
def q_dynamic_override(t):
    """Overrides go by the type of each value, also inside a list; a column of another type is left alone."""
    overrides = [Override(T.StringType(), "STRING", F.upper), Override(T.LongType(), "STRING", lambda c: F.concat(F.lit("#"), c))]
    contract = Contract.dynamic([Col("v", "STRING"), Col("l", "STRING", repeated=True), Col("n", "FLOAT")], overrides=overrides)
    value = F.when(F.col("event_id") % 2 == 0, _entry(F.col("event_type"))).otherwise(_entry(F.col("user_id")))
    row = F.create_map(F.lit("v"), value, F.lit("l"), _entry(F.array("event_type", "props")), F.lit("n"), _entry(F.col("user_id").cast("double")))
    out = conform_dynamic(t.events.select("event_id", row.alias("row")), contract, "row", keep=["event_id"])
    return out.withColumn("n", F.col("n").cast("long"))


@query("SELECT event_id, user_id AS k, true AS named FROM events")
def q_dynamic_row_id(t):
    """Dynamic rows get an id that is the same on every try, and no ingestion columns are filled in."""
    contract = Contract.dynamic([Col("event_id", "INTEGER"), Col("k", "INTEGER")])
    rows = t.events.select("event_id", F.concat(F.lit('{"event_id": '), F.col("event_id"), F.lit(', "k": '), F.col("user_id"), F.lit("}")).alias("row"))
    table = GovernedTable(t.spark, shared_folder(t.spark, "table"), contract, key="event_id", source="json")
    tries = [rows.withColumns(table.columns(table.info("batch", 1_767_312_000_000))[0]).select("event_id", F.col(ROW_ID).alias(name)) for name in ("a", "b")]
    table.append(rows)
    same = tries[0].join(tries[1], "event_id").where("a = b").dropDuplicates(["a"])
    return table.read().join(same, "event_id").select("event_id", "k", F.col("a").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$").alias("named"))
