"""Ingestion metadata and what it is for."""

from datetime import datetime, timezone

from pyspark.sql import functions as F

from ..contract import INGESTION_AT, ROW_ID
from ..operators.dedup import deduplicate, duplicate_report
from ..operators.enrich import AppendInfo, instant, with_ingestion
from .registry import query

_TIME = datetime(2019, 3, 14, 5, 20, tzinfo=timezone.utc)
_MILLIS = int(_TIME.timestamp() * 1000)
_SINK = "018f0000-0000-7000-8000-000000000000"
_INFO = AppendInfo("events", _SINK, _TIME, "batch", _TIME, _MILLIS)

# The id of a row from its key: time, version 7, and digits of a hash.
_ID = f"""substr('{_MILLIS:012x}', 1, 8) || '-' || substr('{_MILLIS:012x}', 9, 4) || '-7' || substr(d, 1, 3) || '-'
          || substr('89ab', 1 + CAST('0x' || substr(d, 4, 1) AS INTEGER) % 4, 1) || substr(d, 5, 3) || '-' || substr(d, 8, 12)"""


@query(
    f"""SELECT '2019-03-14 05:20:00' AS _ingestion_at, '{_SINK}' AS _ingestion_id, {_ID} AS _ingestion_row_id,
               event_id, user_id, event_type, value, props
        FROM (SELECT *, sha256('{_SINK}|' || event_id) AS d FROM events)"""
)
def q_ingestion_columns(t):
    return with_ingestion(t.events.drop("ts"), _INFO, ["event_id"])


@query(
    f"""SELECT count(*) AS rows, count(DISTINCT id) AS ids, count(*) FILTER (WHERE substr(id, 15, 1) = '7') AS version_7,
               min(id) AS first, max(id) AS last
        FROM (SELECT {_ID} AS id FROM (SELECT sha256('{_SINK}|' || l_orderkey || '/' || l_linenumber || '/' || l_partkey || '/' || l_suppkey) AS d
              FROM lineitem))"""
)
def q_row_id(t):
    """Ids of a whole table: they differ wherever keys do."""
    key = F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    out = with_ingestion(t.lineitem.select(key.alias("key")), _INFO, ["key"])
    ids = out.groupBy(ROW_ID).agg(F.count(F.lit(1)).alias("n"))
    return ids.agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("ids"),
        F.sum(F.when(F.substring(ROW_ID, 15, 1) == "7", F.col("n")).otherwise(0)).alias("version_7"),
        F.min(ROW_ID).alias("first"),
        F.max(ROW_ID).alias("last"),
    )


def _delivered(t):
    """Every third event came twice, the second time a minute later."""
    base = t.events.select(F.col("event_id").cast("string").alias(ROW_ID), "event_type", "value", "props")
    first = base.withColumn(INGESTION_AT, instant(_TIME))
    again = base.filter(F.col(ROW_ID).cast("bigint") % 3 == 0).withColumn(
        INGESTION_AT, instant(_TIME.replace(minute=31))
    )
    return first.unionByName(again)


_DELIVERED = """(SELECT CAST(event_id AS VARCHAR) AS id, event_type, value, props, TIMESTAMP '2019-03-14 05:20:00' AS at_ FROM events
                 UNION ALL SELECT CAST(event_id AS VARCHAR), event_type, value, props, TIMESTAMP '2019-03-14 12:31:00' FROM events
                 WHERE event_id % 3 = 0)"""


@query(
    f"""SELECT id AS _ingestion_row_id, event_type, value, props, CAST(at_ AS VARCHAR) AS _ingestion_at FROM
        (SELECT *, row_number() OVER (PARTITION BY id ORDER BY at_) AS rank FROM {_DELIVERED}) WHERE rank = 1"""
)
def q_dedup(t):
    return deduplicate(_delivered(t))


@query(f"SELECT id AS _ingestion_row_id, count(*) AS copies FROM {_DELIVERED} GROUP BY id HAVING count(*) > 1")
def q_duplicate_report(t):
    return duplicate_report(_delivered(t))


@query(
    """SELECT text, lang, source, n_chars FROM
       (SELECT *, row_number() OVER (PARTITION BY text, lang, source, n_chars ORDER BY doc_id) AS rank FROM documents) WHERE rank = 1"""
)
def q_dedup_by_content(t):
    """Rows without an id, told apart by all they hold."""
    content = ["text", "lang", "source", "n_chars"]
    return deduplicate(t.documents, content, ["doc_id"]).drop("doc_id")
