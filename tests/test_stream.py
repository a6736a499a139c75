"""Streams and threshold flushes."""

import pytest
from pyspark.sql import functions as F, types as T

from tablecontract import INGESTION_AT, ROW_ID, ClosedError, Contract, ContractError, GovernedTable, TableSink, column, deduplicate_stream, open_stream

CONTRACT = Contract.of(T.StructType([column("id", T.LongType(), required=True)]), ingestion=True)


@pytest.fixture
def table(spark, place):
    return GovernedTable(spark, place, CONTRACT, key="id")


def rows(spark, start, n):
    return spark.range(start, start + n)


# -- t_flush_threshold, t_flush_close, t_close_twice ------------------------------------


def jobs(table, monkeypatch):
    """How many rows each append carried."""
    sizes = []
    for way in ("_write", "promote"):
        real = getattr(table, way)
        monkeypatch.setattr(table, way, lambda *a, real=real, **k: sizes.append(real(*a, **k)) or sizes[-1])
    return sizes


@pytest.mark.parametrize(
    "threshold, calls, expected, left",
    [(4, [2, 2], [4], 0), (100, [3, 3], [], 6), (3, [1, 1, 1, 1], [3], 1), (3, [2, 5], [7], 0), (0, [2, 1], [2, 1], 0)],
)
def test_thresholds(spark, table, monkeypatch, threshold, calls, expected, left):
    sizes, sink, at = jobs(table, monkeypatch), TableSink(table, flush_rows=threshold), 0
    for n in calls:
        assert sink.write(rows(spark, at, n)).rows == n
        at += n
    assert (sizes, sink.held) == (expected, left)
    assert sink.close().rows == left
    assert table.read().count() == at and table.read().select(ROW_ID).distinct().count() == at


@pytest.mark.parametrize("fails_at", range(8))
def test_a_flush_that_moves_files_goes_on_after_a_crash(spark, place, monkeypatch, fails_at):
    """However many steps were done, the next sink ends with each row once."""
    contract = Contract.of(T.StructType([column("id", T.LongType(), required=True)]))
    make = lambda: GovernedTable(spark, place, contract, key="id", ingestion_id="01900000-0000-7000-8000-000000000000")
    sink = TableSink(make(), flush_rows=100)
    for k in range(3):
        sink.write(rows(spark, 10 * k, 10).repartition(2), k)
    files, steps = type(sink._files), []

    def stopping(real):
        def step(self, *a):
            steps.append(real)
            if len(steps) == fails_at + 1:
                raise KeyboardInterrupt
            return real(self, *a)
        return step

    for name in ("move_folder", "delete"):
        monkeypatch.setattr(files, name, stopping(getattr(files, name)))
    try:
        sink.flush()
    except KeyboardInterrupt:
        pass
    monkeypatch.undo()
    again = TableSink(make(), flush_rows=100)
    again.write(rows(spark, 20, 10).repartition(2), 2)  # the stream runs its last micro-batch again
    again.close()
    read = make().read()
    assert read.count() == 30 and read.distinct().count() == 30
    assert again._files.names(again._pending) == []


def test_only_a_table_without_an_order_takes_files_as_they_are(spark, place):
    plain = [column("id", T.LongType(), required=True)]
    for fields, takes in ((plain, True), ([column("id", T.LongType(), cluster=1)], False)):
        table = GovernedTable(spark, f"{place}-{takes}", Contract.of(T.StructType(fields)), key="id")
        assert table.takes_files(table.start()) is takes
    renamed = GovernedTable(spark, place, Contract.of(T.StructType([*plain, column("a", T.StringType())])), key="id")
    renamed.append(rows(spark, 0, 1).withColumn("a", F.lit("x")))
    GovernedTable(spark, place, Contract.of(T.StructType(plain)), key="id", strategy="sync").start()
    back = GovernedTable(spark, place, Contract.of(T.StructType([*plain, column("a", T.StringType())])), key="id")
    # The dropped name is stored under another one from now on.
    assert not back.takes_files(back.start())


def test_flush_and_close(spark, table):
    sink = TableSink(table, flush_rows=100)
    sink.write(rows(spark, 0, 3))
    assert (sink.flush().rows, sink.flush().rows, table.read().count()) == (3, 0, 3)
    sink.write(rows(spark, 3, 2))
    assert (sink.close().rows, sink.close().rows, table.read().count()) == (2, 0, 5)
    for call in (sink.flush, lambda: sink.write(rows(spark, 0, 1))):
        with pytest.raises(ClosedError):
            call()


def test_a_negative_threshold(table):
    with pytest.raises(ContractError):
        TableSink(table, flush_rows=-1)


def test_failures_are_told_once_and_nothing_is_lost(spark, table, monkeypatch):
    sink, load, promote = TableSink(table, flush_rows=2), table.load, table.promote
    sink.write(rows(spark, 0, 1))

    def broken(*a, **k):
        raise OSError("quota")

    monkeypatch.setattr(table, "load", broken), monkeypatch.setattr(table, "promote", broken)
    assert sink.write(rows(spark, 1, 1)).rows == 1
    monkeypatch.setattr(table, "load", load), monkeypatch.setattr(table, "promote", promote)
    with pytest.raises(OSError, match="quota"):
        sink.flush()
    assert sink.flush().rows == 0
    assert table.read().count() == 2 and sink.close().rows == 0


def test_an_empty_call_holds_nothing(spark, table, place):
    sink = TableSink(table, flush_rows=5)
    assert sink.write(rows(spark, 0, 0)).rows == 0
    assert not table.store.files.exists(place)


def test_a_bad_row_is_refused_when_it_is_handed_over(spark, table):
    sink = TableSink(table, flush_rows=100)
    sink.write(rows(spark, 0, 2))
    with pytest.raises(Exception):
        sink.write(rows(spark, 2, 2).select(F.expr("nullif(id, 3)").alias("id")))
    assert sink.close().rows == 2


def test_held_rows_survive_a_restart(spark, table, place):
    TableSink(table, flush_rows=100).write(rows(spark, 0, 3), 0)
    ids = table.ingestion_id
    again = GovernedTable(spark, place, CONTRACT, key="id", ingestion_id=ids, created_at=table.created_at)
    sink = TableSink(again, flush_rows=100)
    assert sink.held == 3
    sink.write(rows(spark, 0, 3), 0)
    assert sink.held == 3, "a repeated micro-batch replaces its own rows"
    assert sink.close().rows == 3


@pytest.mark.parametrize("key", ["id", ()])
def test_a_micro_batch_run_again_after_its_append_is_not_held_again(spark, place, key):
    def opened(known=None):
        given = {"ingestion_id": known.ingestion_id, "created_at": known.created_at} if known else {}
        return TableSink(GovernedTable(spark, place, CONTRACT, key=key, **given), flush_rows=3)

    sink = opened()
    sink.write(rows(spark, 0, 2), 0)
    sink.write(rows(spark, 2, 2), 1)
    assert sink.held == 0
    for again in (sink, opened(sink.table)):
        assert again.write(rows(spark, 2, 2), 1).rows == 2 and again.held == 0
    assert sink.write(rows(spark, 4, 1), 2).rows == 1 and sink.held == 1
    assert sink.close().rows == 1 and sink.table.read().count() == 5


def test_held_rows_without_a_key(spark, place):
    table = GovernedTable(spark, place, CONTRACT)
    sink = TableSink(table, flush_rows=4)
    for i in range(2):
        sink.write(spark.range(2).select(F.lit(7).cast("bigint").alias("id")), i)
    assert table.read().select(ROW_ID).distinct().count() == 4


# -- streams ----------------------------------------------------------------------------


def source(spark, place, batches):
    path = place + "-in"
    for i, (start, n) in enumerate(batches):
        rows(spark, start, n).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema("id long").option("maxFilesPerTrigger", 1).parquet(path)


def opener(spark, place, **options):
    return lambda ingestion_id, created_at: GovernedTable(spark, place, CONTRACT, key="id", ingestion_id=ingestion_id, created_at=created_at, **options)


def run(stream, make, checkpoint, **options):
    sink, query = open_stream(stream, make, checkpoint, **options)
    query.awaitTermination()
    return sink


def test_stream_append(spark, place):
    stream = source(spark, place, [(0, 5), (5, 5)])
    sink = run(stream, opener(spark, place), place + "-cp")
    assert sink.table.read().count() == 10
    rows(spark, 10, 5).coalesce(1).write.mode("append").parquet(place + "-in")
    again = run(stream, opener(spark, place), place + "-cp")
    assert again.table.ingestion_id == sink.table.ingestion_id
    assert again.table.read().count() == 15 and again.table.read().select(ROW_ID).distinct().count() == 15


def test_stream_threshold(spark, place):
    sink = run(source(spark, place, [(i * 100, 100) for i in range(10)]), opener(spark, place), place + "-cp", flush_rows=300)
    assert sink.table.read().count() == 900 and sink.held == 100
    assert sink.close().rows == 100


def test_a_micro_batch_run_again_lands_once(spark, place):
    sink = run(source(spark, place, [(0, 5)]), opener(spark, place), place + "-cp")
    assert sink.write(rows(spark, 0, 5), 0).rows == 5
    assert sink.table.read().count() == 5


def test_an_append_cut_short_is_finished_after_a_restart(spark, table, place, monkeypatch):
    sink = TableSink(table, flush_rows=100)
    sink.write(rows(spark, 0, 3), 0)
    monkeypatch.setattr(sink, "_finish_append", lambda: (_ for _ in ()).throw(KeyboardInterrupt()))
    with pytest.raises(KeyboardInterrupt):
        sink.flush()
    monkeypatch.undo()
    for landed_before in (False, True):
        again = GovernedTable(spark, place, CONTRACT, key="id", ingestion_id=table.ingestion_id, created_at=table.created_at)
        restarted = TableSink(again, flush_rows=100)
        if landed_before:
            # The append landed, but the process ended before it let go of the rows.
            restarted.write(rows(spark, 3, 2), 1)
            held, delete = again.store.files, type(again.store.files).delete
            monkeypatch.setattr(again, "remove", lambda path: None)
            monkeypatch.setattr(type(held), "delete", lambda self, path: path.endswith(".json") or delete(self, path))
            restarted.flush()
            monkeypatch.undo()
            restarted = TableSink(again, flush_rows=100)
        assert restarted.held == 0
        assert again.read().count() == (5 if landed_before else 3)


def test_a_checkpoint_belongs_to_its_table(spark, place):
    stream = source(spark, place, [(0, 5)])
    run(stream, opener(spark, place), place + "-cp")
    with pytest.raises(ContractError, match="belongs to"):
        open_stream(stream, opener(spark, place + "-other"), place + "-cp")


def test_stream_dedup(spark, place):
    path = place + "-in"
    for start in (0, 3):
        made = spark.range(start, start + 5).select(F.col("id").cast("string").alias(ROW_ID), F.timestamp_micros(F.lit(10**15) + F.col("id")).alias(INGESTION_AT))
        made.coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)
    query = deduplicate_stream(stream, "10 minutes").writeStream.format("parquet").option("checkpointLocation", place + "-cp").option("path", place).trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.read.parquet(place).count() == 8


def test_a_hot_id_leaves_a_task_once(spark):
    from tablecontract.streaming.dedup import one_a_task

    rows = spark.range(100_000, numPartitions=4).select(
        F.when(F.col("id") % 10 < 7, "hot").otherwise(F.concat(F.lit("r"), F.col("id"))).alias(ROW_ID), F.timestamp_micros(F.col("id")).alias(INGESTION_AT), "id")
    out = one_a_task(rows, [ROW_ID], INGESTION_AT)
    assert out.where(F.col(ROW_ID) == "hot").count() == 4 and out.count() == 30_004
    # The latest of each task stays, whole.
    assert out.where(F.unix_micros(INGESTION_AT) != F.col("id")).isEmpty()
    assert {r.id for r in out.where(F.col(ROW_ID) == "hot").collect()} == {24_996, 49_996, 74_996, 99_996}


def test_a_task_holds_so_many_ids_and_keeps_all(spark, monkeypatch):
    from tablecontract.streaming import dedup

    monkeypatch.setattr(dedup, "HELD_ROWS", 1000)
    rows = spark.range(60_000, numPartitions=2).select((F.col("id") % 25_000).alias("a"), F.when(F.col("id") % 2 == 0, "x").alias("b"), F.timestamp_micros(F.col("id")).alias("at"))
    out = dedup.one_a_task(rows, ["a", "b"], "at")
    assert out.select("a", "b").distinct().count() == rows.select("a", "b").distinct().count() == 25_000
    odd = spark.createDataFrame([(1, None), (1, 5), (None, 7), (None, None), (2, None)], "k int, t long").select("k", F.timestamp_micros("t").alias("t")).coalesce(1)
    assert sorted(((r.k or 0, r.t is not None) for r in dedup.one_a_task(odd, ["k"], "t").collect())) == [(0, True), (1, True), (2, False)]
    assert dedup.one_a_task(odd.limit(0), ["k"], "t").count() == 0


def test_a_late_copy_does_not_hide_one_in_time(spark, place):
    path, minute = place + "-in", 60 * 10**6

    def arrive(*rows):
        made = spark.createDataFrame(list(rows), "id string, micros long").select(F.col("id").alias(ROW_ID), F.timestamp_micros("micros").alias(INGESTION_AT))
        made.coalesce(1).write.mode("append").parquet(path)

    def run():
        stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", 1).parquet(path)
        query = deduplicate_stream(stream, "10 minutes").writeStream.format("parquet").option("checkpointLocation", place + "-cp").option("path", place).trigger(availableNow=True).start()
        query.awaitTermination()

    arrive(("a", 100 * minute))
    run()
    arrive(("b", 10 * minute), ("b", 101 * minute), ("c", 11 * minute), ("a", 99 * minute), ("a", 102 * minute))
    run()
    assert sorted(r[0] for r in spark.read.parquet(place).select(ROW_ID).collect()) == ["a", "b"]


def test_the_stream_query_flushes_before_it_closes(spark, monkeypatch):
    from conftest import SF

    from tablecontract.queries import QUERIES

    sizes = jobs(GovernedTable, monkeypatch)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        n = QUERIES["q_stream_flush"](spark, SF).count()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sum(sizes) == n and len(sizes) > 1 and all(2 * n // 5 <= rows < n for rows in sizes[:-1])
