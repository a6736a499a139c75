"""Tables created, migrated, appended to and read back."""

import logging
import threading

import pytest
from pyspark.sql import functions as F, types as T

from tablecontract import (
    BatchTypeError, ConcurrentChangeError, Contract, ContractError, GovernedTable, SchemaChange, SchemaConflictError, ShortWriteError, ChangedRowsError,
    TableMissingError, column, stored_contract,
)
from tablecontract.layout import BATCH_COLUMN
from tablecontract.functions.fingerprint import Tally, fingerprint

LONG, TEXT, TS = T.LongType(), T.StringType(), T.TimestampType()
ID, COUNT, EXTRA = column("id", LONG, required=True), column("count", LONG), column("extra", TEXT)


def contract(*fields, **options):
    return Contract.of(T.StructType(list(fields or (ID, COUNT))), **options)


NARROW, WIDE = contract(), contract(ID, COUNT, EXTRA)


def rows(spark, start=0, n=10):
    return spark.range(start, start + n).select("id", (F.col("id") * 2).alias("count"), F.concat(F.lit("x"), F.col("id")).alias("extra"))


@pytest.fixture
def make(spark, place):
    return lambda c=NARROW, **options: GovernedTable(spark, place, c, **options)


def files(table):
    return table.spark.read.parquet(table.data_path(table.store.latest())).inputFiles()


# -- appending --------------------------------------------------------------------------


def test_append(spark, make):
    table = make()
    assert table.append(rows(spark)).rows == 10
    assert table.append(rows(spark, 10)).rows == 10
    assert {tuple(r) for r in table.read().collect()} == {(i, 2 * i) for i in range(20)}


def test_all_or_nothing(spark, make):
    table = make()
    table.append(rows(spark))
    before = files(table)
    bad = rows(spark, 10, 1000).repartition(8).withColumn("id", F.expr("nullif(id, 900)"))
    with pytest.raises(Exception, match="column id: a REQUIRED column cannot be NULL"):
        table.append(bad)
    with pytest.raises(Exception, match="REQUIRED"):
        table.append(bad, staged=True)
    assert files(table) == before and table.read().count() == 10


def test_a_batch_lands_once(spark, make, place):
    table = make()
    assert [table.append(rows(spark), batch_id="b-1").rows for _ in range(2)] == [10, 10]
    assert table.read().count() == 10 and table.store.files.names(f"{place}/data/g0001") == ["_b=b-1"]
    with pytest.raises(ContractError, match="batch id"):
        table.append(rows(spark), batch_id="../b")


def test_an_empty_batch_touches_nothing(spark, make, place):
    table = make()
    assert table.append(rows(spark).filter("id < 0")).rows == 0
    assert table.append_all([]).rows == 0
    assert not table.store.files.exists(place)
    table.append(rows(spark))
    assert table.append(rows(spark).filter("id < 0")).rows == 0
    assert table.read().count() == 10


def test_batches_are_of_one_type(spark, make):
    table = make()
    assert table.append_all([rows(spark), rows(spark, 10)]).rows == 20
    with pytest.raises(BatchTypeError, match="batch 1"):
        table.append_all([rows(spark), rows(spark).withColumn("count", F.lit("x"))])
    with pytest.raises(BatchTypeError):
        table.append(spark.range(1).select(F.lit("a").alias("id"), F.lit("b").alias("count")))
    assert table.read().count() == 20


@pytest.mark.parametrize("keep", [False, True])
def test_staged_append(spark, make, place, keep):
    table = make()
    result = table.append(rows(spark), staged=True, keep=keep)
    assert (result.rows, table.read().count()) == (10, 10)
    assert table.store.files.names(f"{place}/_staging") == ([result.batch_id] if keep else [])


def test_a_failing_cleanup_does_not_fail_a_landed_batch(spark, make, monkeypatch, caplog):
    table = make()
    table.start()
    monkeypatch.setattr(table.store.files, "delete", lambda path: (_ for _ in ()).throw(OSError("denied")))
    with caplog.at_level(logging.WARNING):
        assert table.append(rows(spark), staged=True).rows == 10
    assert "could not remove" in caplog.text and table.name in caplog.text


def test_a_users_own_writer_is_held_to_its_word(spark, make, place):
    got = []

    def write(df, info):
        got.append(df.count())
        return got[-1]

    assert make(writer=write).append(rows(spark)).rows == 10
    with pytest.raises(ShortWriteError, match="9 of 10") as err:
        make(writer=lambda df, info: df.count() - 1).append(rows(spark))
    assert err.value.delivered == 9
    with pytest.raises(ShortWriteError, match="neither"):
        make(writer=lambda df, info: None).append(rows(spark))


def test_narrow_rows_in_a_wide_table(spark, make):
    make(WIDE).append(rows(spark))
    table = make(NARROW)
    table.append(rows(spark, 10))
    assert table.read().filter("extra is null").count() == 10
    need = contract(ID, COUNT, column("must", LONG, required=True))
    other = GovernedTable(spark, make().location + "-b", need)
    other.append(rows(spark).withColumn("must", F.col("id")))
    with pytest.raises(SchemaConflictError, match="do not write the REQUIRED columns must"):
        GovernedTable(spark, other.location, NARROW).append(rows(spark))


# -- starting ---------------------------------------------------------------------------


def test_addresses_live_in_the_warehouse(spark):
    table = GovernedTable(spark, "lake.logs.access", NARROW)
    assert table.name == "lake.logs.access" and table.location.endswith("/warehouse/lake/logs/access")
    table.append(rows(spark))
    assert GovernedTable(spark, "lake.logs.access", NARROW).read().count() == 10


def test_missing_tables(spark, make):
    for strategy in ("none", "append", "sync"):
        with pytest.raises(TableMissingError):
            make(strategy=strategy, create=False).append(rows(spark))
    with pytest.raises(LookupError):
        make().read()


def test_creation_stores_the_contract(spark, make):
    table = make(contract(ID, COUNT, description="d", labels={"team": "data"}), create=True)
    version = table.start()
    assert (version.version, version.description, version.labels) == (1, "d", {"team": "data"})
    assert table.store.latest() == version
    assert table.read().count() == 0


def test_descriptions_are_read_back_as_comments(spark, make):
    table = make(contract(ID, column("count", LONG, description="how many")))
    table.append(rows(spark))
    assert table.read().schema["count"].metadata == {"comment": "how many"}


def test_the_outcome_of_starting_is_final(spark, make, monkeypatch):
    table = make(create=False)
    with pytest.raises(TableMissingError):
        table.append(rows(spark))
    make().append(rows(spark))
    with pytest.raises(TableMissingError):
        table.append(rows(spark))
    good, calls = make(), []
    monkeypatch.setattr(good, "_reconcile", lambda real=good._reconcile: calls.append(1) or real())
    good.append(rows(spark)), good.append(rows(spark)), good.start()
    assert len(calls) == 1


def test_unmanaged_targets_are_left_alone(spark, place, caplog):
    rows(spark).write.parquet(place)
    for options in ({}, {"strategy": "sync"}, {"strategy": "none", "create": True}):
        with pytest.raises(ContractError, match="no contract of its own"):
            GovernedTable(spark, place, WIDE, managed=False, **options)
    with caplog.at_level(logging.WARNING):
        table = GovernedTable(spark, place, WIDE, managed=False, strategy="none")
    assert "never checked" in caplog.text
    table.append(rows(spark, 10))
    assert table.read().count() == 20 and spark.read.parquet(place).count() == 20


# -- migrating --------------------------------------------------------------------------


def test_added_columns_read_null_before(spark, make):
    make().append(rows(spark))
    table = make(WIDE)
    table.append(rows(spark, 10))
    assert table.store.latest().version == 2
    assert table.read().filter("extra is null").count() == 10


def test_dynamic_rows_under_a_tables_own_contract(spark, make, place):
    make(WIDE).append(rows(spark))
    stored = stored_contract(spark, place)
    assert stored.is_dynamic and stored.columns == WIDE.columns
    table = make(stored, source="json")
    table.append(spark.createDataFrame([('{"id": 99, "extra": "json"}',)], "row string"))
    assert table.read().filter("id = 99").collect() == [(99, None, "json")]
    with pytest.raises(TableMissingError):
        stored_contract(spark, place + "-none")


def test_relaxing(spark, make):
    make().append(rows(spark))
    relaxed = contract(column("id", LONG), COUNT)
    table = make(relaxed)
    table.append(rows(spark).withColumn("id", F.lit(None).cast("bigint")))
    assert not table.store.latest().columns[0].required and table.read().filter("id is null").count() == 10


def test_required_columns_cannot_be_added(spark, make):
    make().append(rows(spark))
    strict = contract(ID, COUNT, column("extra", TEXT, required=True))
    for strategy in ("append", "sync"):
        with pytest.raises(SchemaConflictError, match="cannot add REQUIRED"):
            make(strict, strategy=strategy).append(rows(spark))
    assert make().store.latest().version == 1


def test_conflicts_block_even_under_none(spark, make):
    make().append(rows(spark))
    other = contract(ID, column("count", TEXT), EXTRA)
    for strategy in ("none", "append", "sync"):
        with pytest.raises(SchemaConflictError, match="count: no migration leads from NULLABLE INTEGER to NULLABLE STRING"):
            make(other, strategy=strategy).append(rows(spark).withColumn("count", F.lit("x")))
    assert make().store.latest().version == 1


def test_none_does_not_add(spark, make):
    make().append(rows(spark))
    with pytest.raises(SchemaConflictError, match="no column extra"):
        make(WIDE, strategy="none").append(rows(spark))


def test_dropping_then_adding_again(spark, make):
    make(WIDE).append(rows(spark))
    narrow = make(strategy="sync")
    narrow.append(rows(spark, 10))
    assert narrow.read().columns == ["id", "count"]
    again = make(WIDE)
    again.append(rows(spark, 20))
    assert {r.id for r in again.read().filter("extra is not null").collect()} == set(range(20, 30))
    once_more = make(strategy="sync")
    once_more.append(rows(spark, 30))
    third = make(WIDE)
    assert third.append(rows(spark, 40)).rows == 10
    assert {r.id for r in third.read().filter("extra is not null").collect()} == set(range(40, 50))
    assert len({c.stored_as for c in third.store.latest().columns} | set(third.store.latest().retired)) == 5


def test_purging_removes_the_bytes(spark, make, place):
    make(WIDE).append(rows(spark))
    table = make(strategy="sync")
    table.append(rows(spark, 10))
    version = table.purge_dropped()
    assert version.generation == 2 and table.store.files.names(f"{place}/data") == ["g0002"]
    assert spark.read.parquet(f"{place}/data/g0002").columns == ["id", "count", "_b"]
    assert make().read().count() == 20
    make().append(rows(spark, 20))
    assert make().read().count() == 30


def test_rows_that_arrive_during_a_purge_are_kept(spark, make, monkeypatch):
    make(WIDE).append(rows(spark))
    table, late = make(strategy="sync"), make(strategy="sync")
    table.start(), late.start()
    publish, remove = table.store.publish, table.remove
    monkeypatch.setattr(table.store, "publish", lambda *v: late.append(rows(spark, 50), batch_id="before") and publish(*v))
    monkeypatch.setattr(table, "remove", lambda path: late.append(rows(spark, 70), batch_id="after") and remove(path))
    assert table.purge_dropped().generation == 2 and late.read().count() == 30
    assert table.store.files.names(f"{table.location}/data") == ["g0002"]
    for sink in (table, late, make(strategy="sync")):
        for name in ("before", "after"):
            assert sink.append(rows(spark, 50), batch_id=name).rows == 10
    late.append(rows(spark, 90))
    assert make().read().count() == 40


def test_a_batch_that_lands_while_a_generation_is_published_moves_on(spark, make, monkeypatch):
    make(WIDE).append(rows(spark))
    table, late = make(strategy="sync"), make(strategy="sync")
    table.start(), late.start()
    files = late.store.files
    move = files.move_folder

    def slow(source, target):
        move(source, target)
        monkeypatch.setattr(files, "move_folder", move)
        table.purge_dropped()

    monkeypatch.setattr(files, "move_folder", slow)
    late.append(rows(spark, 50))
    assert make().read().count() == 20


def test_a_purge_that_fails_goes_on_where_it_stopped(spark, make, monkeypatch):
    from tablecontract.sources import table as module

    monkeypatch.setattr(module, "PURGE_BYTES", 1)
    wide = make(WIDE)
    for k in range(4):
        wide.append(rows(spark, 10 * k))
    table = make(NARROW, strategy="sync")
    table.append(rows(spark, 40))
    done, real = [], table._purge_group

    def failing(version, old, names, work):
        if len(done) == 2:
            done.append("stopped")
            raise OSError("the cluster went away")
        real(version, old, names, work)
        done.extend(names)

    monkeypatch.setattr(table, "_purge_group", failing)
    with pytest.raises(OSError, match="went away"):
        table.purge_dropped()
    assert table.store.latest().generation == 1 and table.read().count() == 50
    version = table.purge_dropped()
    assert version.generation == 2 and version.retired == ()
    names = [d for d in done if d != "stopped"]
    assert len(names) == len(set(names)) == 5
    assert table.read().count() == 50 and table.read().agg(F.sum("id")).first()[0] == sum(range(50))
    stored = spark.read.parquet(table.data_path(version))
    assert "extra" not in stored.columns
    assert [n for n in table.store.files.names(table.staging) if n.startswith("purg")] == []


def test_a_purge_does_not_use_what_another_contract_left(spark, make, monkeypatch):
    from tablecontract.sources import table as module

    monkeypatch.setattr(module, "PURGE_BYTES", 1)
    wide = make(WIDE)
    wide.append(rows(spark)), wide.append(rows(spark, 10))
    middle = make(contract(ID, EXTRA), strategy="sync")
    middle.append(rows(spark, 20))
    monkeypatch.setattr(middle.store, "publish", lambda *a: (_ for _ in ()).throw(OSError("no")))
    with pytest.raises(OSError):
        middle.purge_dropped()
    least = make(contract(ID), strategy="sync")
    least.append(rows(spark, 30))
    assert least.purge_dropped().retired == () and least.read().columns == ["id"] and least.read().count() == 40
    assert set(spark.read.parquet(least.data_path(least.store.latest())).columns) <= {"id", BATCH_COLUMN}


def test_a_purge_without_dropped_columns_does_nothing(spark, make):
    table = make(WIDE)
    table.append(rows(spark))
    assert table.purge_dropped().generation == 1
    narrow = make(strategy="sync")
    narrow.append(rows(spark, 10), batch_id="kept")
    assert narrow.purge_dropped().retired == () and narrow.purge_dropped().generation == 2
    assert narrow.append(rows(spark, 10), batch_id="kept").rows == 10 and narrow.read().count() == 20


def test_what_an_earlier_try_staged_is_used_or_written_again(spark, make):
    table = make(staging=None)
    for name, finished in (("whole", True), ("half", False)):
        left = f"{table.staging}/{name}"
        rows(spark).write.parquet(left)
        if not finished:
            table.store.files.delete(f"{left}/_SUCCESS")
        assert table.append(rows(spark), staged=True, batch_id=name).rows == 10
    assert table.read().count() == 20


def test_a_staging_folder_of_ones_own(spark, make, place):
    table = make(staging=f"{place}-aside/")
    table.append(rows(spark), staged=True, keep=True, batch_id="b")
    assert table.store.files.names(f"{place}-aside") == ["b"] and table.read().count() == 10


def test_drop_names_are_checked(spark, make):
    odd = contract(ID, COUNT, column("odd name", TEXT))
    make(odd).append(rows(spark).withColumn("odd name", F.lit("x")))
    with pytest.raises(ContractError, match="refusing to drop"):
        make(strategy="sync").append(rows(spark))
    assert "odd name" in make().read().columns


def test_adds_are_published_before_drops(spark, make):
    make(contract(ID, COUNT, column("odd name", TEXT))).append(rows(spark).withColumn("odd name", F.lit("x")))
    with pytest.raises(ContractError):
        make(WIDE, strategy="sync").append(rows(spark))
    assert [c.name for c in make().store.latest().columns] == ["id", "count", "odd name", "extra"]


def test_columns_of_the_layout_are_not_dropped(spark, make):
    clustered = contract(ID, COUNT, column("extra", TEXT, cluster=1))
    make(clustered).append(rows(spark))
    with pytest.raises(SchemaConflictError, match="layout uses it"):
        make(strategy="sync").append(rows(spark))


def test_a_strategy_of_ones_own(spark, make):
    make().append(rows(spark))
    only_add = lambda state, log: SchemaChange(add=state.diff.added)
    table = make(WIDE, strategy=only_add)
    assert table.append(rows(spark, 10)).rows == 10


# -- concurrency ------------------------------------------------------------------------


def test_the_loser_looks_again(spark, make, monkeypatch, caplog):
    make().append(rows(spark))
    table, other = make(WIDE), make(contract(ID, COUNT, column("other", TEXT)))
    publish = table.store.publish

    def late(change, seen):
        monkeypatch.setattr(table.store, "publish", publish)
        other.start()
        return publish(change, seen)

    monkeypatch.setattr(table.store, "publish", late)
    monkeypatch.setattr("tablecontract.plans.migrate.FIRST_WAIT", 0)
    with caplog.at_level(logging.WARNING):
        table.start()
    assert [c.name for c in table.store.latest().columns] == ["id", "count", "other", "extra"]
    assert "retrying the migration" in caplog.text


def test_four_retries_at_most(make, monkeypatch):
    table, tries = make(), []
    monkeypatch.setattr("tablecontract.plans.migrate.FIRST_WAIT", 0)

    def busy(change, seen):
        tries.append(1)
        raise ConcurrentChangeError("busy")

    monkeypatch.setattr(table.store, "publish", busy)
    with pytest.raises(ConcurrentChangeError):
        table.start()
    assert len(tries) == 5


def test_one_creator_wins(spark, make):
    tables = [make() for _ in range(6)]
    results = []
    threads = [threading.Thread(target=lambda t=t: results.append(t.append(rows(spark)).rows)) for t in tables]
    [t.start() for t in threads], [t.join() for t in threads]
    assert results == [10] * 6 and make().read().count() == 60
    assert make().store.files.names(f"{make().location}/_contract") == ["v000001.json"]


# -- layout -----------------------------------------------------------------------------


def timed(spark, n=1000):
    return spark.range(n).select("id", F.timestamp_micros(F.col("id") * 3_600_000_000 + 1_704_067_200_000_000).alias("at"), (F.col("id") % 3).cast("string").alias("who"))


@pytest.mark.parametrize("unit, parts", [("hour", 1000), ("day", 42), ("month", 2), ("year", 1)])
def test_partitions(spark, make, unit, parts):
    table = make(contract(ID, column("at", TS, partition=unit)))
    table.append(timed(spark))
    counts = table.partition_counts()
    assert counts.count() == parts and counts.agg(F.sum("rows")).first()[0] == 1000
    some = table.read(start="2024-01-05T06:00:00Z", end="2024-01-07T12:00:00Z")
    assert some.count() == 54
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_p" in plan and "PushedFilters: [IsNotNull(at)" in plan


def test_partitions_of_rows_without_the_value(spark, make):
    table = make(contract(ID, column("at", TS, partition="day")))
    table.append(timed(spark, 24).withColumn("at", F.expr("if(id % 2 = 0, at, null)")))
    assert table.read().count() == 24 and table.read(start="2024-01-01T00:00:00Z").count() == 12


def test_a_required_filter(spark, make):
    table = make(contract(ID, column("on", TS, as_time="date", zone="Asia/Tokyo", partition="month,require")))
    table.append(timed(spark).withColumnRenamed("at", "on"))
    with pytest.raises(ContractError, match="range of on"):
        table.read(where="id > 1")
    assert table.read(start="2024-01-01", end="2024-02-01").count() == 735


def test_layouts_of_existing_tables_are_not_changed(spark, make):
    make(contract(ID, column("at", TS))).append(timed(spark))
    table = make(contract(ID, column("at", TS, partition="day")))
    table.append(timed(spark))
    assert table.store.latest().layout.partition_by == "" and table.read().count() == 2000


def test_clustered_writes_cut_a_hot_value_apart(spark, make, monkeypatch):
    monkeypatch.setattr("tablecontract.sources.table.CLUSTER_TASK_BYTES", 20_000)
    table = make(contract(ID, column("at", TS, partition="year"), column("who", TEXT, cluster=1)))
    hot = timed(spark, 20_000).withColumn("who", F.when(F.col("id") % 10 != 0, "hot").otherwise(F.col("who")))
    assert table.append(hot).rows == 20_000
    data = table.spark.read.parquet(table.data_path(table.store.latest()))
    holders = data.filter("who = 'hot'").groupBy(F.input_file_name()).count().collect()
    assert len(holders) >= 4 and max(r["count"] for r in holders) < 18_000 / 2
    runs = data.select(F.input_file_name().alias("f"), "who", F.col("_metadata.row_index").alias("i"))
    sorted_files = runs.groupBy("f").agg(F.array_sort(F.collect_list(F.struct("i", "who"))).alias("x")).selectExpr(
        "transform(x, y -> y.who) = array_sort(transform(x, y -> y.who)) as ok"
    )
    assert {r.ok for r in sorted_files.collect()} == {True}


def test_partitioned_writes_make_few_files(spark, make):
    table = make(contract(ID, column("at", TS, partition="month")))
    table.append(timed(spark).repartition(16))
    assert len(files(table)) <= 4


def test_logged_levels(spark, make, caplog):
    with caplog.at_level(logging.DEBUG, logger="tablecontract"):
        make().append(rows(spark))
        make(WIDE, strategy="sync").append(rows(spark))
        make(strategy="sync").append(rows(spark))
    levels = {(r.levelname, r.getMessage().split(": ", 1)[1].split(" ")[0]) for r in caplog.records}
    assert {("INFO", "created"), ("INFO", "added"), ("INFO", "appended"), ("WARNING", "dropped"), ("DEBUG", "compared:")} <= levels
    assert all(make().name in r.getMessage() for r in caplog.records)
    assert "ERROR" not in {level for level, _ in levels}


def test_a_partition_that_holds_most_rows_is_cut_apart(spark, make):
    """Adaptive execution cuts a large partition along its map tasks."""
    table = make(contract(ID, column("at", TS, partition="month"), column("text", TEXT)))
    hot = spark.range(0, 200_000, 1, 16).select(
        "id", F.timestamp_micros(F.lit(1_704_067_200_000_000)).alias("at"), F.sha2(F.col("id").cast("string"), 512).alias("text")
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "2m")
    try:
        assert table.append(hot).rows == 200_000
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    data = spark.read.parquet(table.data_path(table.store.latest()))
    sizes = [r["count"] for r in data.groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) >= 4 and max(sizes) < 100_000


# -- rows that landed are rows that were given --------------------------------------------


def many(spark):
    return spark.range(200).selectExpr("id", "if(id % 3 = 0, null, cast(id as string)) as a", "if(id % 3 = 0, cast(id as string), null) as b", "map('k', id) as m")


def test_fingerprints_see_values_and_not_order(spark):
    base, columns = many(spark), ["id", "a", "b", "m"]
    want = fingerprint(base, columns)
    assert want[0] == 200 and fingerprint(base.repartition(7).orderBy("id", ascending=False), columns) == want
    tally = Tally()
    assert tally.over(base.repartition(5), columns).count() == 200 and tally.mark == want
    others = [
        base.where("id < 199"), base.where("id < 199").unionByName(base.where("id = 3")), base.withColumn("m", F.expr("map('k', if(id = 7, 8, id))")),
        base.withColumns({"a": F.coalesce("a", "b"), "b": F.when(F.col("a").isNotNull() & F.col("b").isNotNull(), F.col("b"))}),
    ]
    assert len({fingerprint(o, columns) for o in others} | {want}) == 5
    assert fingerprint(base.limit(0), columns) == (0,) * 7


@pytest.mark.parametrize("key", ["id", ()])
@pytest.mark.parametrize("clustered", [True, False])
def test_verified_appends_land(spark, place, key, clustered):
    contract = Contract.of(T.StructType([column("id", T.LongType()), column("a", T.StringType(), **({"cluster": 1} if clustered else {})), column("b", T.StringType())]), ingestion=True)
    table = GovernedTable(spark, place, contract, key=key)
    assert table.append(many(spark).drop("m"), verify=True, staged=True).rows == 200
    assert table.append(many(spark).drop("m").where("id < 0"), verify=True).rows == 0
    assert table.read().count() == 200


def test_files_that_hold_other_rows_do_not_land(spark, place, monkeypatch):
    contract = Contract.of(T.StructType([column("id", T.LongType()), column("a", T.StringType())]))
    table = GovernedTable(spark, place, contract)
    real = table._writer

    class Swapping:
        def __init__(self, df):
            self.df = df

        def parquet(self, path):
            real(self.df.withColumn("a", F.when(F.col("id") == 5, "other").otherwise(F.col("a"))), table.start(), "overwrite").parquet(path)

    monkeypatch.setattr(table, "_writer", lambda df, version, mode, by=(): Swapping(df))
    with pytest.raises(ChangedRowsError, match="are in the files"):
        table.append(many(spark).select("id", "a"), verify=True)
    assert table.read().count() == 0


def test_staged_rows_that_change_do_not_land(spark, place, monkeypatch):
    contract = Contract.of(T.StructType([column("id", T.LongType()), column("a", T.StringType())]))
    table = GovernedTable(spark, place, contract)
    load = table.load
    monkeypatch.setattr(table, "load", lambda staged, *a, **k: load(staged.withColumn("a", F.lit("x")), *a, **k))
    with pytest.raises(ChangedRowsError, match="were written"):
        table.append(many(spark).select("id", "a"), staged=True)
    assert table.read().count() == 0


def test_a_writer_that_swaps_a_row_is_refused(spark, place):
    contract = Contract.of(T.StructType([column("id", T.LongType()), column("a", T.StringType())]))
    batch = many(spark).select("id", "a")
    assert GovernedTable(spark, place, contract, writer=lambda df, info: spark.createDataFrame(df.collect(), df.schema)).append(batch).rows == 200
    swap = lambda df, info: spark.createDataFrame([r if r.id != 9 else (9, "swapped") for r in df.collect()], df.schema)
    with pytest.raises(ChangedRowsError, match="were delivered"):
        GovernedTable(spark, place, contract, writer=swap).append(batch)
    with pytest.raises(ShortWriteError, match="199 of 200"):
        GovernedTable(spark, place, contract, writer=lambda df, info: spark.createDataFrame(df.collect()[1:], df.schema)).append(batch)
