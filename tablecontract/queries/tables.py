"""Tables written under a contract and read back. Each query writes its own new table."""

import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timezone

from pyspark.sql import functions as F, types as T

from ..contract import INGESTION_ID, ROW_ID, Contract
from ..errors import ChangedRowsError, ShortWriteError
from ..layout import BATCH_COLUMN
from ..options import column
from ..sources.files import shared_folder
from ..sources.table import GovernedTable
from ..streaming.sink import TableSink
from .registry import query

LONG, TEXT, DOUBLE, INSTANT = T.LongType(), T.StringType(), T.DoubleType(), T.TimestampType()
_BASE = [column("event_id", LONG, required=True), column("value", DOUBLE)]


def _contract(*more, **options):
    return Contract.of(T.StructType(_BASE + list(more)), **options)


def _extra():
    return column("event_type", TEXT, name="extra")


def _table(t, contract, path=None, **options):
    return GovernedTable(t.spark, path or shared_folder(t.spark, "table"), contract, **options)


_PAIR = T.StructType([column("visitor", LONG), column("label", TEXT)])
# A column of each type and mode: its declaration, what the rows hold, and what is read back in the other engine's SQL.
_EVERY_KIND = [
    (column("label", TEXT), "event_type", "event_type"),
    (column("purchase", T.BooleanType()), "event_type = 'purchase'", "event_type = 'purchase'"),
    (column("visitor", LONG, required=True), "user_id", "user_id"),
    (column("score", DOUBLE), "value", "value"),
    (column("amount", T.DecimalType(38, 9)), "cast(value as decimal(38,9))", "CAST(CAST(value AS DECIMAL(38,9)) AS VARCHAR)"),
    (column("raw", T.BinaryType()), "cast(props as binary)", "to_base64(encode(props))"),
    (column("seen", INSTANT), "ts", "CAST(ts AS VARCHAR)"),
    (column("tokyo_day", INSTANT, as_time="date", zone="Asia/Tokyo"), "ts", "CAST(CAST(ts + INTERVAL 9 HOUR AS DATE) AS VARCHAR)"),
    (column("tokyo_clock", INSTANT, as_time="datetime", zone="Asia/Tokyo"), "ts", "CAST(ts + INTERVAL 9 HOUR AS VARCHAR)"),
    (column("minute", INSTANT, as_time="time"), "date_trunc('minute', ts)", "strftime(ts, '%H:%M:00')"),
    (column("payload", TEXT, type="JSON"), "props", "props"),
    (column("pair", _PAIR, record=True), "named_struct('visitor', user_id, 'label', event_type)", "to_json({'visitor': user_id, 'label': event_type})::VARCHAR"),
    (column("visitors", T.ArrayType(LONG)), "array(user_id, event_id)", "to_json([user_id, event_id])::VARCHAR"),
    (column("never", TEXT), "cast(null as string)", "CAST(NULL AS VARCHAR)"),
]


@query(f"SELECT {', '.join(f'{sql} AS {field.name}' for field, _, sql in _EVERY_KIND)} FROM events")
def q_read_back(t):
    """A column of every type, written and read under its contract."""
    table = _table(t, Contract.of(T.StructType([field for field, _, _ in _EVERY_KIND])))
    table.append(t.instants.select(*[F.expr(value).alias(field.name) for field, value, _ in _EVERY_KIND]))
    return table.read()


@query(
    """SELECT event_id, value, CAST(NULL AS VARCHAR) AS extra FROM events UNION ALL
       SELECT event_id, value, event_type FROM events"""
)
def q_added_column(t):
    """A contract gains a column: rows written before read NULL."""
    old = _table(t, _contract())
    old.append(t.events)
    new = _table(t, _contract(_extra()), old.location)
    new.append(t.events)
    return new.read()


@query("SELECT event_id, value FROM events, range(3)")
def q_dropped_column(t):
    """A contract loses a column, and the bytes go with it; what is appended afterwards is read, and a batch is not taken twice."""
    wide = _table(t, _contract(_extra()))
    wide.append(t.events)
    narrow = _table(t, _contract(), wide.location, strategy="sync")
    narrow.append(t.events, batch_id="again")
    narrow.purge_dropped()
    narrow.append(t.events, batch_id="again")
    narrow.append(t.events)
    return narrow.read()


@query(
    """SELECT event_id, value, CAST(NULL AS VARCHAR) AS extra FROM events UNION ALL
       SELECT event_id, value, event_type FROM events"""
)
def q_drop_then_readd(t):
    """A name that comes back does not bring its old values back."""
    wide = _table(t, _contract(_extra()))
    wide.append(t.events)
    _table(t, _contract(), wide.location, strategy="sync").start()
    again = _table(t, _contract(_extra()), wide.location)
    again.append(t.events)
    return again.read()


@query(
    """SELECT event_id, value, event_type AS extra FROM events UNION ALL
       SELECT event_id, value, NULL FROM events"""
)
def q_narrow_write(t):
    """Rows narrower than their table leave the rest NULL."""
    wide = _table(t, _contract(_extra()))
    wide.append(t.events)
    narrow = _table(t, _contract(), wide.location)
    narrow.append(t.events)
    return narrow.read()


@query("SELECT event_id, value, event_type AS extra FROM events")
def q_staged_append(t):
    table = _table(t, _contract(_extra()))
    table.append(t.events, staged=True)
    return table.read()


def _partitioned(unit, *more):
    fields = [column("o_orderkey", LONG), column("o_custkey", LONG), column("at", INSTANT, partition=unit), *more]
    return Contract.of(T.StructType(fields))


def _orders(t):
    return t.orders.withColumn("at", F.col("o_orderdate").cast("timestamp"))


@query("SELECT CAST(date_trunc('month', o_orderdate)::DATE AS VARCHAR) AS _p, count(*) AS rows FROM orders GROUP BY 1")
def q_partition_counts(t):
    table = _table(t, _partitioned("month"))
    table.append(_orders(t))
    return table.partition_counts()


@query(
    """SELECT o_orderkey, o_custkey, CAST(o_orderdate AS VARCHAR) AS at FROM orders
       WHERE o_orderdate >= TIMESTAMP '1996-02-10' AND o_orderdate < TIMESTAMP '1997-05-20'"""
)
def q_partition_range(t):
    """A read bounded in time opens only the partitions it needs."""
    table = _table(t, _partitioned("month,require"))
    table.append(_orders(t))
    return table.read(start="1996-02-10T00:00:00Z", end="1997-05-20T00:00:00Z")


@query("SELECT o_orderkey, o_custkey, CAST(o_orderdate AS VARCHAR) AS at, o_orderstatus AS status FROM orders")
def q_clustered_write(t):
    table = _table(t, _partitioned("year", column("o_orderstatus", TEXT, name="status", cluster=1)))
    table.append(_orders(t))
    return table.read()


@query(
    """SELECT event_type, count(*) AS rows, count(*) AS ids, CAST(1 AS BIGINT) AS sinks FROM events GROUP BY event_type"""
)
def q_keyless_row_ids(t):
    """Rows without a key get ids from their place in staged files."""
    table = _table(t, _contract(column("event_type", TEXT), ingestion=True))
    table.append(t.events.repartition(64))
    once = table.read().groupBy("event_type", ROW_ID).agg(F.count(F.lit(1)).alias("n"), F.max(INGESTION_ID).alias("sink"))
    return once.groupBy("event_type").agg(
        F.sum("n").alias("rows"),
        F.count(F.lit(1)).alias("ids"),
        F.when(F.min("sink") == F.max("sink"), 1).otherwise(2).cast("bigint").alias("sinks"),
    )


@query("SELECT event_id, value, event_type AS extra FROM events")
def q_sync_ignoring(t):
    """A column another system owns is neither dropped nor touched."""
    wide = _table(t, _contract(_extra()))
    wide.append(t.events)
    _table(t, _contract(), wide.location, strategy="sync", ignore=["extra"]).start()
    return wide.read()


@query("SELECT event_id, true AS same FROM events")
def q_retry_same_id(t):
    """A batch without keys that is appended again, by another process, gets the same row ids."""
    contract, at = _contract(ingestion=True), datetime(2026, 1, 2, tzinfo=timezone.utc)
    ids = []
    for name in ("a", "b"):
        table = _table(t, contract, ingestion_id="01900000-0000-7000-8000-000000000000", created_at=at)
        table.append(t.events, batch_id="batch-1", id_millis=1_767_312_000_000)
        ids.append(table.read().select("event_id", F.col(ROW_ID).alias(name)))
    return ids[0].join(ids[1], "event_id").select("event_id", (F.col("a") == F.col("b")).alias("same"))


@query("SELECT event_id, value, upper(event_type) AS extra FROM events")
def q_custom_fill(t):
    """A fill of one's own adds a column; it runs once for the batch."""
    calls = []

    def fill(info):
        calls.append(info)
        return {"event_type": F.upper("event_type")}

    table = _table(t, _contract(_extra()), key="event_id", fill=fill)
    table.append(t.events, staged=True)
    return table.read().where(F.lit(len(calls) == 1))


@query("SELECT event_id, value FROM events")
def q_all_or_nothing(t):
    """One row without a REQUIRED value, and nothing of its batch is in the table."""
    table = _table(t, _contract())
    table.start()
    try:
        table.append(t.events.withColumn("event_id", F.when(F.col("event_id") > 0, F.col("event_id"))))
    except Exception as err:
        if "event_id" not in str(err):
            raise
    table.append(t.events)
    return table.read()


@query(
    """SELECT * FROM (SELECT count(*) AS rows FROM events), (VALUES ('all', 'delivered'), ('one less', 'short'), ('one twice', 'changed'), ('one rounded', 'changed'),
       ('a null moved', 'changed')) AS w(writer, outcome)"""
)
def q_delivered_rows(t):
    """Writers of one's own that give back what is there now: one delivers all rows, the others lose, replace or change some."""
    last = t.events.agg(F.max("event_id")).first()[0]
    writers = {
        "all": lambda df: df,
        "one less": lambda df: df.where(F.col("event_id") != last),
        "one twice": lambda df: df.where(F.col("event_id") != last).unionByName(df.where(F.col("event_id") == last - 1)),
        "one rounded": lambda df: df.withColumn("value", F.when(F.col("event_id") == last, F.floor("value") - 1).otherwise(F.col("value"))),
        "a null moved": lambda df: df.withColumns({"extra": F.when(F.col("event_id") != last, F.col("extra")), "more": F.when(F.col("event_id") != last, F.col("more")).otherwise(F.col("extra"))}),
    }
    contract = _contract(_extra(), column("absent", TEXT, name="more"))
    rows, found = t.events.withColumn("absent", F.lit(None).cast("string")), []
    for name, delivers in writers.items():

        def write(df, info, name=name, delivers=delivers):
            folder = shared_folder(t.spark, "delivered")
            delivers(df).write.mode("overwrite").parquet(folder)
            return t.spark.read.schema(df.schema).parquet(folder)

        try:
            result = _table(t, contract, key="event_id", writer=write).append(rows)
            found.append((name, "delivered", result.rows))
        except ChangedRowsError as err:
            found.append((name, "changed", err.delivered))
        except ShortWriteError as err:
            found.append((name, "short", err.delivered + 1))
    return t.spark.createDataFrame(found, "writer string, outcome string, rows long")


@query("""SELECT event_id, value, event_type AS first, NULL AS second FROM events WHERE event_id % 2 = 0 UNION ALL
          SELECT event_id, value, NULL, event_type FROM events WHERE event_id % 2 = 1""")
def q_concurrent_change(t):
    """Two writers widen one table at the same time, each by a column of its own: whoever comes second looks again."""
    base = _table(t, _contract())
    base.start()
    writers = [_table(t, _contract(column("event_type", TEXT, name=name)), base.location) for name in ("first", "second")]
    # Both have read the table's contract before either publishes; the second publication is refused and planned anew.
    meet = threading.Barrier(2)
    for writer in writers:
        look, waits = writer.store.latest, iter([True])

        def latest(look=look, waits=waits):
            found = look()
            if next(waits, False):
                meet.wait(60)
            return found

        writer.store.latest = latest
    with ThreadPoolExecutor(2) as pool:
        parts = [t.events.where(F.col("event_id") % 2 == k) for k in range(2)]
        list(pool.map(lambda w, part: w.append(part), writers, parts))
    return _table(t, _contract(), base.location, strategy="none").read()


@query("SELECT event_id, value FROM events, range(2)")
def q_append_all(t):
    """Several DataFrames of one type as one batch."""
    table = _table(t, _contract())
    table.append_all([t.events.select("event_id", "value")] * 2)
    return table.read()


@query(
    """SELECT event_id, value, event_type AS extra FROM events UNION ALL
       SELECT event_id, value, NULL FROM events"""
)
def q_strategy_none(t):
    """A table that somebody else looks after: the contract has to fit, and nothing is changed."""
    wide = _table(t, _contract(_extra()))
    wide.append(t.events)
    narrow = _table(t, _contract(), wide.location, strategy="none")
    narrow.append(t.events)
    return narrow.read()


@query(
    """WITH s AS (SELECT event_id % 5 AS k, count(*) AS n FROM events GROUP BY 1)
       SELECT CAST(sum(n) AS BIGINT) AS rows FROM s GROUP BY k // 2"""
)
def q_threshold_flush(t):
    """Five calls, held until two fifths of the rows are there; the last goes when the sink is closed."""
    table = _table(t, _contract(), key="event_id")
    sink = TableSink(table, flush_rows=2 * t.events.count() // 5)
    for k in range(5):
        sink.write(t.events.where(F.col("event_id") % 5 == k))
    sink.close()
    landed = t.spark.read.parquet(table.data_path(table.store.latest()))
    return landed.groupBy(BATCH_COLUMN).agg(F.count(F.lit(1)).alias("rows")).select("rows")
