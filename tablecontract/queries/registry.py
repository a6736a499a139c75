from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.temporal import utc_wall_clock

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a query under its function's name, with its SQL where there is one."""

    def register(function):
        @functools.wraps(function)
        def run(spark, sf_dir):
            # Timestamps without a zone in the given tables are UTC.
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return plain(function(Tables(spark, sf_dir)))

        QUERIES[function.__name__] = run
        if oracle:
            ORACLES[function.__name__] = oracle
        return function

    return register


class Tables:
    """The given tables, with instants where the contract wants instants."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @property
    def instants(self) -> DataFrame:
        """``events`` with ``ts`` as an instant."""
        return self.events.withColumn("ts", F.col("ts").cast("timestamp"))


def plain(df: DataFrame) -> DataFrame:
    """Values other engines spell differently, as text: dates, times, decimals, bytes, lists, records."""
    return df.select(*[_plain(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema.fields])


def _plain(value, dtype):
    if isinstance(dtype, T.TimestampType):
        return utc_wall_clock(value).cast("string")
    if isinstance(dtype, T.BinaryType):
        return F.base64(value)
    if isinstance(dtype, (T.ArrayType, T.StructType)):
        return F.to_json(value, {"ignoreNullFields": "false"})
    if isinstance(dtype, (T.DateType, T.TimestampNTZType, T.DecimalType)):
        return value.cast("string")
    return value
