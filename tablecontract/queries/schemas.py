"""Schema differences between what contracts declare and what rows hold."""

from pyspark.sql import functions as F

from ..operators.audit import audit, describe, observe_entries
from ..types import TableColumn as Col
from .registry import query


def _payloads(t):
    """Rows of maps of variants per kind of event, with drift the SQL can repeat."""
    kind = F.col("event_type")
    entries = F.map_filter(
        F.create_map(
            F.lit("id"), F.col("event_id").cast("variant"),
            F.lit("value"), F.when(kind == "click", F.col("value").cast("string").cast("variant")).otherwise(F.col("value").cast("variant")),
            F.lit("user"), F.col("user_id").cast("variant"),
            F.lit("code"), F.col("props").cast("variant"),
            F.lit("tags"), F.array("event_type").cast("variant"),
            F.lit("note"), kind.cast("variant"),
            F.lit("meta"), F.when(kind == "purchase", F.to_variant_object(F.struct(
                F.col("props").alias("n"), kind.alias("tag"), F.struct(kind.alias("a, b"), F.array("event_id").alias("list")).alias("place"))))
            .otherwise(F.to_variant_object(F.struct(
                F.col("event_id").alias("n"), kind.alias("tag"), F.struct(F.col("user_id").alias("a, b"), F.array("event_type").alias("list")).alias("place")))),
        ),
        lambda key, _: ~((kind == "error") & (key == "user")) & ((kind == "error") | (key != "code")) & ((key != "note") | (F.col("event_id") % 2 == 0)),
    )
    return t.events.select("event_type", entries.alias("entries"))


def _declared(t):
    columns = [
        Col("id", "INTEGER", required=True),
        Col("value", "FLOAT"),
        Col("user", "INTEGER"),
        Col("tags", "STRING"),
        Col("seen", "TIMESTAMP"),
        Col("note", "STRING", required=True),
        Col("meta", "RECORD", fields=(
            Col("tag", "STRING"), Col("n", "INTEGER"),
            Col("place", "RECORD", fields=(Col("list", "STRING", repeated=True), Col("a, b", "INTEGER"))))),
    ]
    kinds = ["click", "error", "purchase", "signup", "view"]
    return describe(t.spark, {kind: columns for kind in kinds})


_AUDIT = """WITH declared(path, type, repeated, required) AS (VALUES ('id', 'INTEGER', false, true), ('value', 'FLOAT', false, false),
              ('user', 'INTEGER', false, false), ('tags', 'STRING', false, false), ('seen', 'TIMESTAMP', false, false),
              ('note', 'STRING', false, true), ('meta', 'RECORD', false, false)),
            kinds(kind) AS (VALUES ('click'), ('error'), ('purchase'), ('signup'), ('view')),
            want AS (SELECT kind, path, type, repeated, required FROM declared, kinds),
            cells AS (SELECT event_type AS kind, unnest([
                {'path': 'id', 'type': 'INTEGER', 'repeated': false},
                {'path': 'value', 'type': CASE WHEN event_type = 'click' THEN 'STRING' ELSE 'FLOAT' END, 'repeated': false},
                {'path': CASE WHEN event_type = 'error' THEN 'code' ELSE 'user' END,
                 'type': CASE WHEN event_type = 'error' THEN 'STRING' ELSE 'INTEGER' END, 'repeated': false},
                {'path': 'meta', 'type': 'RECORD', 'repeated': false},
                {'path': CASE WHEN event_id % 2 = 0 THEN 'note' END, 'type': 'STRING', 'repeated': false},
                {'path': 'tags', 'type': 'STRING', 'repeated': true}]) AS c FROM events),
            total AS (SELECT event_type AS kind, count(*) AS total FROM events GROUP BY 1),
            got AS (SELECT kind, c.path AS path, c.type AS type, c.repeated AS repeated, NOT c.repeated AND count(*) = any_value(total) AS required
                    FROM cells JOIN total USING (kind) WHERE c.path IS NOT NULL GROUP BY kind, c.path, c.type, c.repeated),
            out AS (SELECT coalesce(want.kind, got.kind) AS "table", coalesce(want.path, got.path) AS path,
                      want.type AS declared, got.type AS found,
                      CASE WHEN got.path IS NULL THEN 'added' WHEN want.path IS NULL THEN 'removed'
                           WHEN want.type <> got.type THEN 'conflict: type'
                           WHEN want.repeated <> got.repeated THEN 'conflict: repeated'
                           WHEN want.required AND NOT got.required THEN 'conflict: required'
                           WHEN want.path = 'meta' AND want.kind = 'purchase' THEN 'conflict: nested'
                           WHEN NOT want.required AND got.required THEN 'relaxed' ELSE 'same' END AS change,
                      CASE WHEN want.path = 'meta' AND want.kind = 'purchase' THEN '["meta.n","meta.place.a, b","meta.place.list"]' ELSE '[]' END AS inside
                    FROM want FULL OUTER JOIN got ON want.kind = got.kind AND want.path = got.path)"""


@query(f'{_AUDIT} SELECT "table", path, declared, found, change, inside FROM out')
def q_schema_audit(t):
    """Every kind of event against the same contract, from the values its rows hold."""
    return audit(_declared(t), observe_entries(_payloads(t), "event_type", "entries"))


@query(f"{_AUDIT} SELECT path, change, count(*) AS tables FROM out WHERE change <> 'same' GROUP BY path, change")
def q_schema_diff(t):
    """What differs, and in how many tables."""
    found = audit(_declared(t), observe_entries(_payloads(t), "event_type", "entries"))
    return found.filter("change <> 'same'").groupBy("path", "change").agg(F.count(F.lit(1)).alias("tables"))
