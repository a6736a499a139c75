"""Ingestion metadata, row ids and de-duplication."""

import uuid
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F, types as T

from tablecontract import INGESTION_AT, INGESTION_ID, ROW_ID, AppendInfo, Contract, GovernedTable, TableColumn, column, deduplicate, duplicate_report, with_ingestion
from tablecontract.functions import ids
from tablecontract.operators.enrich import PLACE, instant, with_place

WHEN = datetime(2019, 3, 14, 5, 20, tzinfo=timezone.utc)
INFO = AppendInfo("t", ids.new_uuid7(), WHEN, "batch", WHEN, int(WHEN.timestamp() * 1000))


def test_minted_ids_are_version_7_and_sort_by_time():
    minted = [ids.new_uuid7(m) for m in (1, 2, 2**40)]
    assert minted == sorted(minted)
    assert all(uuid.UUID(i).version == 7 and uuid.UUID(i).variant == uuid.RFC_4122 for i in minted)


def test_ingestion_columns_come_first(spark):
    out = with_ingestion(spark.range(3).withColumnRenamed("id", "user_id"), INFO, ["user_id"])
    assert out.columns == [INGESTION_AT, INGESTION_ID, ROW_ID, "user_id"]
    rows = out.withColumn("at", F.unix_millis(INGESTION_AT)).collect()
    assert {r.at for r in rows} == {INFO.id_millis} and {r[INGESTION_ID] for r in rows} == {INFO.ingestion_id}
    assert len({r[ROW_ID] for r in rows}) == 3
    for r in rows:
        parsed = uuid.UUID(r[ROW_ID])
        assert (parsed.version, parsed.variant, parsed.int >> 80) == (7, uuid.RFC_4122, INFO.id_millis)


def test_a_retry_on_reordered_rows_gives_the_same_ids(spark):
    rows = spark.range(1000).withColumnRenamed("id", "k")
    first = {r.k: r[ROW_ID] for r in with_ingestion(rows, INFO, ["k"]).collect()}
    again = {r.k: r[ROW_ID] for r in with_ingestion(rows.orderBy(F.rand(1)).repartition(7), INFO, ["k"]).collect()}
    assert first == again and len(set(first.values())) == 1000


def test_several_keys_do_not_run_together(spark):
    rows = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), ("a", None)], "x string, y string")
    assert len({r[ROW_ID] for r in with_ingestion(rows, INFO, ["x", "y"]).collect()}) == 3
    with pytest.raises(Exception, match="key is NULL"):
        with_ingestion(rows, INFO, ["y"]).collect()


def test_ids_from_places_are_distinct_and_in_order(spark):
    rows = spark.range(0, 40).select(
        (F.col("id") % 4 * 1_048_575).alias("task"), (F.col("id") * 100_000_000).alias("row")
    )
    made = rows.select("*", ids.uuid7_from_position(5, "b", F.col("task"), F.col("row")).alias("u")).collect()
    in_order = sorted(made, key=lambda r: (r.task, r.row))
    assert [r.u for r in in_order] == sorted(r.u for r in made)
    assert len({r.u for r in made}) == 40
    for r in made:
        assert (uuid.UUID(r.u).version, uuid.UUID(r.u).variant, uuid.UUID(r.u).int >> 80) == (7, uuid.RFC_4122, 5)
    with pytest.raises(Exception, match="past what a row id"):
        spark.range(1).select(ids.uuid7_from_position(5, "b", F.lit(1 << 22), F.lit(0))).collect()


def test_a_place_is_read_from_the_start_of_a_file_name(spark, tmp_path):
    """The random part of a name may look like anything."""
    out = tmp_path / "staged"
    spark.range(40).repartition(4).write.option("maxRecordsPerFile", 0).parquet(str(out))
    for i, file in enumerate(sorted(out.glob("part-*"))):
        (out / f".{file.name}.crc").unlink(missing_ok=True)
        file.rename(out / f"part-{i:05}-6a3c9d10-c1{i}7-c000-c999-0123456789ab-c000.snappy.parquet")
    placed = with_place(spark.read.parquet(str(out))).collect()
    places = {(r[PLACE].task, r[PLACE].row) for r in placed}
    assert len(places) == 40 and {t for t, _ in places} == set(range(4))


def test_instants_do_not_depend_on_the_session(spark):
    assert spark.range(1).select(F.unix_micros(instant(WHEN))).first()[0] == int(WHEN.timestamp()) * 1_000_000


# -- t_retry_same_id, t_ingestion_id, t_custom_fill, t_dynamic_rowid -----------------------

CONTRACT = Contract.of(T.StructType([column("user_id", T.LongType(), required=True)]), ingestion=True)


def users(spark, n=5):
    return spark.range(n).withColumnRenamed("id", "user_id")


def test_one_ingestion_id_for_a_tables_life(spark, place):
    table = GovernedTable(spark, place, CONTRACT, key="user_id")
    for _ in range(2):
        table.append(users(spark))
    rows = table.read().collect()
    assert {r[INGESTION_ID] for r in rows} == {table.ingestion_id}
    assert len({r[ROW_ID] for r in rows}) == 10


def test_rows_without_a_key_get_distinct_ids_in_the_order_of_the_batch(spark, place):
    table = GovernedTable(spark, place, CONTRACT)
    same = spark.range(1000).select(F.lit(7).cast("bigint").alias("user_id"))
    assert table.append(same).rows == 1000
    assert table.read().select(ROW_ID).distinct().count() == 1000
    assert not table.store.files.names(f"{place}/_staging")


def test_a_retried_batch_is_the_same_to_the_byte(spark, place):
    now = lambda: WHEN
    tables = [GovernedTable(spark, place + x, CONTRACT, ingestion_id=INFO.ingestion_id, clock=now) for x in "ab"]
    for table in tables:
        table.append(users(spark), batch_id="b1", id_millis=INFO.id_millis)
    first, again = [sorted(t.read().collect()) for t in tables]
    assert first == again


def test_custom_fill(spark, place):
    seen = []

    def fill(info):
        seen.append(info)
        return {"at": instant(info.time), "run": F.lit("run-1"), "row": info.row_id}

    row_type = T.StructType([column("at", T.TimestampType()), column("run", T.StringType()), column("row", T.StringType()), column("user_id", T.LongType())])
    table = GovernedTable(spark, place, Contract.of(row_type), fill=fill, key="user_id")
    batch = users(spark)
    table.append(batch)
    rows = table.read().collect()
    assert batch.columns == ["user_id"]
    assert {r.run for r in rows} == {"run-1"} and len({r.row for r in rows}) == 5
    assert (seen[-1].table, seen[-1].ingestion_id, seen[-1].created_at) == (table.name, table.ingestion_id, table.created_at)


def test_a_failing_fill_stops_the_batch(spark, place):
    def fill(info):
        raise RuntimeError("no run id")

    table = GovernedTable(spark, place, Contract.of(T.StructType([column("user_id", T.LongType())])), fill=fill, key="user_id")
    with pytest.raises(RuntimeError, match="no run id"):
        table.append(users(spark))
    assert table.store.latest() is None


def test_dynamic_rows_are_named_by_id_but_not_filled(spark, place):
    contract = Contract.dynamic(Contract.of(T.StructType([column("a", T.LongType(), required=True)])).columns)
    table = GovernedTable(spark, place, contract, key="k", source="json")
    rows = spark.createDataFrame([(1, '{"a": 1}')], "k long, row string")
    table.append(rows)
    assert table.read().columns == ["a"]
    with pytest.raises(Exception, match=r"row [0-9a-f-]{36}: column a"):
        table.append(spark.createDataFrame([(1, "{}")], "k long, row string"))
    assert table.read().count() == 1


# -- de-duplication ---------------------------------------------------------------------


def delivered(spark):
    """Half of all rows are copies of one id."""
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias(ROW_ID),
        F.timestamp_micros("id").alias(INGESTION_AT),
        F.col("id").alias("n"),
    )
    return rows.unionByName(rows.filter("n % 10 = 1").withColumn("n", F.lit(-1).cast("bigint")).withColumn(INGESTION_AT, F.timestamp_micros(F.lit(10**12))))


def test_the_first_of_each_id_stays(spark):
    out = deduplicate(delivered(spark))
    assert out.count() == 10_001 and out.filter("n = -1").count() == 0
    assert out.filter(F.col(ROW_ID) == "hot").first().n == 0


def test_a_hot_id_is_cut_down_before_the_shuffle(spark):
    lines = deduplicate(delivered(spark))._jdf.queryExecution().executedPlan().toString().split("\n")
    limits = [i for i, line in enumerate(lines) if "WindowGroupLimit" in line]
    exchange = next(i for i, line in enumerate(lines) if "Exchange" in line)
    assert len(limits) == 2 and limits[0] < exchange < limits[1]


def test_duplicate_report(spark):
    report = {r[ROW_ID]: r.copies for r in duplicate_report(delivered(spark)).collect()}
    assert report.pop("hot") == 10_000
    assert len(report) == 2000 and set(report.values()) == {2}


def test_a_writer_of_ones_own_gets_ids_without_a_key(spark, place):
    """Rows are staged first, so every row has an id before the writer sees it."""
    seen = []

    def write(df, info):
        seen.extend(r[ROW_ID] for r in df.collect())
        return len(seen)

    contract = Contract.of(T.StructType([column("id", T.LongType())]), ingestion=True)
    table = GovernedTable(spark, place, contract, writer=write)
    assert table.append(spark.range(30).repartition(3)).rows == 30 and len(set(seen)) == 30
    assert not table.store.files.names(table.staging)


def test_a_fill_runs_once_for_a_batch(spark, place):
    for key, staged in (("id", False), ("id", True), ((), True)):
        calls = []
        fill = lambda info, calls=calls: calls.append(info) or {"by": info.row_id}
        contract = Contract.of(T.StructType([column("id", T.LongType()), column("by", T.StringType())]))
        table = GovernedTable(spark, f"{place}-{key or 'none'}-{staged}", contract, fill=fill, key=key)
        table.append(spark.range(9).repartition(3), staged=staged)
        assert len(calls) == 1 and table.read().select("by").distinct().count() == 9


def test_dynamic_rows_without_a_key_are_named_when_refused(spark, place):
    contract = Contract.dynamic([TableColumn("n", "INTEGER")])
    table = GovernedTable(spark, place, contract, source="json")
    with pytest.raises(Exception, match=r"[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-"):
        table.append(spark.createDataFrame([('{"n": 1}',), ('{"n": 1.5}',)], "row string"))
    table.append(spark.createDataFrame([('{"n": 1}',)], "row string"))
    assert [r.n for r in table.read().collect()] == [1]
