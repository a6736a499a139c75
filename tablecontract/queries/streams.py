"""Streams over the given files, run to their end."""

from pyspark.sql import functions as F, types as T

from ..contract import INGESTION_AT, ROW_ID, Contract
from ..options import column
from ..sources.files import shared_folder
from ..sources.table import GovernedTable
from ..streaming.dedup import deduplicate_stream
from ..streaming.sink import open_stream
from .registry import query

_FIELDS = [column("event_id", T.LongType(), required=True), column("value", T.DoubleType())]


def _stream(t):
    source = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1)
    return source.parquet(f"{t.sf_dir}/events.parque[t]")


def _run(t, stream, contract, **options):
    path = shared_folder(t.spark, "stream")

    def make(ingestion_id, created_at):
        return GovernedTable(
            t.spark, f"{path}/table", contract, key="event_id", ingestion_id=ingestion_id, created_at=created_at
        )

    sink, query_ = open_stream(stream, make, f"{path}/checkpoint", **options)
    query_.awaitTermination()
    sink.close()
    return sink.table.read()


@query("SELECT event_id, value FROM events")
def q_stream_append(t):
    return _run(t, _stream(t), Contract.of(T.StructType(_FIELDS)))


@query("SELECT event_id, value FROM events")
def q_stream_flush(t):
    """Five files, a micro-batch each, are held until two fifths of the rows are there; the rest until the sink is closed."""
    path = f"{shared_folder(t.spark, 'events')}/files"
    t.events.repartition(5).write.parquet(path)
    stream = t.spark.readStream.schema(t.events.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return _run(t, stream, Contract.of(T.StructType(_FIELDS)), flush_rows=2 * t.events.count() // 5)


@query("SELECT CAST(event_id AS VARCHAR) AS _ingestion_row_id, value FROM events")
def q_stream_dedup(t):
    """Every row arrives twice within the time allowed."""
    twice = _stream(t).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    rows = twice.select(
        F.col("event_id").cast("string").alias(ROW_ID), F.col("ts").cast("timestamp").alias(INGESTION_AT), "event_id", "value"
    )
    once = deduplicate_stream(rows, "1 hour")
    fields = [column(ROW_ID, T.StringType()), *_FIELDS]
    return _run(t, once.select(ROW_ID, "event_id", "value"), Contract.of(T.StructType(fields))).select(ROW_ID, "value")
