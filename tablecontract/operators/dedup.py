"""What at-least-once delivery makes necessary: finding and removing rows written twice."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..contract import INGESTION_AT, ROW_ID
from ..functions.fingerprint import hashable


def deduplicate(df: DataFrame, keys=(ROW_ID,), order_by=(INGESTION_AT,)) -> DataFrame:
    """Keep the first row of each id; of rows that came first together, the one with the smallest hash.

    Spark turns ``row_number() = 1`` into a group limit that runs before the
    shuffle as well, so an id with very many copies sends one row per task. Several keys are sorted by a digest of
    them; they are compared themselves where digests agree.
    """
    tie = F.xxhash64(*[hashable(F.col(f"`{f.name}`"), f.dataType) for f in df.schema.fields])
    keys = list(keys)
    types = dict((f.name, f.dataType) for f in df.schema.fields)
    wide = len(keys) > 1 and all(k in types for k in keys)
    if wide:
        df = df.withColumn("_digest", F.xxhash64(*[hashable(F.col(f"`{k}`"), types[k]) for k in keys]))
    first = Window.partitionBy(*(["_digest"] if wide else []), *keys).orderBy(*order_by, tie)
    return df.withColumn("_rank", F.row_number().over(first)).filter("_rank = 1").drop("_rank", "_digest")


def duplicate_report(df: DataFrame, keys=(ROW_ID,)) -> DataFrame:
    """Ids written more than once and how often; only ids are read and shuffled."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter("copies > 1")
