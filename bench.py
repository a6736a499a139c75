"""Times the headline operators; prints one JSON line.

Every query writes its whole result to Spark's ``noop`` sink or to a table, and
counts as the median of the measured runs after one to warm up.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession, functions as F, types as T  # noqa: E402

from tablecontract import (  # noqa: E402
    Contract, GovernedTable, TableSink, column, conform, conform_dynamic, deduplicate, render, with_reasons,
)
from tablecontract.contract import INGESTION_AT, ROW_ID  # noqa: E402
from tablecontract.queries import QUERIES  # noqa: E402
from tablecontract.queries.dynamic import _NESTED, _json_rows  # noqa: E402
from tablecontract.queries.registry import Tables  # noqa: E402
from tablecontract.sources.files import shared_folder  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

LINE = [
    column("l_orderkey", T.LongType(), name="order_id", required=True),
    column("l_linenumber", T.IntegerType(), name="line", required=True),
    column("l_quantity", T.DoubleType(), name="quantity"),
    column("l_extendedprice", T.DecimalType(18, 2), name="price"),
    column("l_discount", T.DoubleType(), name="discount", nullifzero=True),
    column("l_returnflag", T.StringType(), name="flag"),
    column("shipped_at", T.TimestampType(), name="shipped"),
    column("l_shipdate", T.TimestampType(), name="ship_day", as_time="date", zone="Asia/Tokyo"),
]


def session():
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        # The given tables are one small file each; let their row groups spread.
        .config("spark.sql.files.maxPartitionBytes", str(4 * 1024 * 1024))
        .config("spark.sql.files.openCostInBytes", str(256 * 1024))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def noop(df):
    df.write.format("noop").mode("overwrite").save()


def main():
    spark = session()
    tables = Tables(spark, SF_DIR)
    instants = tables.lineitem.select(
        "l_orderkey", "l_linenumber", "l_quantity", F.col("l_extendedprice").cast("decimal(18,2)"), "l_discount", "l_returnflag",
        F.col("l_shipdate").cast("timestamp").alias("shipped_at"), F.col("l_shipdate").cast("timestamp").alias("l_shipdate"),
    )
    # Spread once, as files of a large table would be; not part of any timing.
    spread = shared_folder(spark, "bench") + "/lineitem"
    instants.repartition(int(CPUS)).write.parquet(spread)
    lines = spark.read.parquet(spread)
    events = shared_folder(spark, "bench") + "/events"
    _json_rows(tables).repartition(int(CPUS)).write.parquet(events)
    json_rows = spark.read.parquet(events)

    plain = Contract.of(T.StructType(LINE))
    daily = Contract.of(T.StructType([*LINE[:6], column("shipped_at", T.TimestampType(), name="shipped", partition="month")]))
    clustered = Contract.of(
        T.StructType([*LINE[:5], column("l_returnflag", T.StringType(), name="flag", cluster=1),
                      column("shipped_at", T.TimestampType(), name="shipped", partition="year")])
    )
    def table(contract, **options):
        return GovernedTable(spark, shared_folder(spark, "bench"), contract, **options)

    def append(contract, staged=False, **options):
        table(contract, **options).append(lines, staged=staged)

    # A table is rewritten once, so each run gets one of its own; filling them is no part of the timing.
    wide = [table(plain) for _ in range(RUNS + 1)]
    for one in wide:
        one.append(lines)

    def dropped():
        narrow = GovernedTable(spark, wide.pop().location, Contract.of(T.StructType(LINE[:-1])), strategy="sync")
        narrow.start()
        narrow.purge_dropped()

    def threshold():
        sink = TableSink(table(Contract.of(T.StructType(LINE))), flush_rows=lines_count // 2)
        for i in range(4):
            sink.write(lines.filter(F.col("l_orderkey") % 4 == i), i)
        sink.close()

    def dedup():
        ids = lines.withColumn(ROW_ID, F.concat_ws("/", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"))
        first = ids.withColumn(INGESTION_AT, F.timestamp_micros(F.lit(0)))
        noop(deduplicate(first.unionByName(ids.withColumn(INGESTION_AT, F.timestamp_micros(F.lit(1))))))

    lines_count = lines.count()
    jobs = {
        "conform": lambda: noop(conform(lines, plain)),
        "conform_render_load": lambda: noop(render(conform(lines, plain), plain.columns)),
        "dynamic_split": lambda: noop(with_reasons_of(json_rows)),
        "gates_split": lambda: noop(with_reasons(conform(lines, plain, gated=False), plain.columns)),
        "append": lambda: append(plain),
        "append_partitioned": lambda: append(daily),
        "append_staged": lambda: append(plain, staged=True),
        "append_clustered": lambda: append(clustered),
        "drop_column_rewrite": dropped,
        "threshold_flush": threshold,
        "dedup": dedup,
    }
    for name in ("q_conform", "q_ndjson_load", "q_nullifzero", "q_dynamic_columns", "q_violation_report", "q_schema_audit", "q_dedup"):
        jobs[name] = lambda name=name: noop(QUERIES[name](spark, SF_DIR))

    seconds = {}
    for name, job in jobs.items():
        job()
        times = []
        for _ in range(RUNS):
            started = time.perf_counter()
            job()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    spark.stop()
    print(json.dumps({
        "metric": "sum of the median seconds of all headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1], "rows": {"lineitem": lines_count},
    }))


def with_reasons_of(json_rows):
    return conform_dynamic(json_rows, _NESTED, "row", source="json", mode="reasons")


if __name__ == "__main__":
    main()
