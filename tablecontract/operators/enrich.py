"""Ingestion metadata: who wrote a row, when, and under which id."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, functions as F

from ..contract import INGESTION_AT, INGESTION_ID, ROW_ID
from ..errors import ContractError
from ..functions import ids

PLACE = "_place"


@dataclass(frozen=True)
class AppendInfo:
    """What a batch cannot know about itself; one per batch, ``row_id`` a column."""

    table: str
    ingestion_id: str
    created_at: datetime
    batch_id: str
    time: datetime
    id_millis: int
    row_id: Column | None = field(default=None, compare=False)


# Columns to add or replace, by name. Expressions cannot change how many rows
# there are, and a DataFrame is never changed in place.
Fill = Callable[[AppendInfo], dict[str, Column]]


def instant(moment: datetime) -> Column:
    """A literal timestamp that does not depend on the session's or the driver's zone."""
    micros = round((moment - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds() * 1_000_000)
    return F.timestamp_micros(F.lit(micros))


def row_id_from_key(info: AppendInfo, keys) -> Column:
    """The same key of the same sink and batch gives the same id however often the task runs."""
    columns = [F.col(f"`{k}`") if isinstance(k, str) else k for k in keys]
    return ids.uuid7_from_hash(info.id_millis, ids.key_digest(info.ingestion_id, columns))


def row_id_from_place(info: AppendInfo, place: str = PLACE) -> Column:
    """For rows without a key: their place in a staged file, which no retry changes."""
    at = F.col(place)
    return ids.uuid7_from_position(info.id_millis, info.batch_id, at["task"], at["row"])


def with_place(df: DataFrame) -> DataFrame:
    """Add each row's place to a DataFrame read from files Spark wrote, one a task.

    Only the number at the start of a file's name is read; what follows is random.
    """
    task = F.regexp_extract(F.col("_metadata.file_name"), r"^part-(\d+)-", 1)
    place = F.struct(F.nullif(task, F.lit("")).cast("bigint").alias("task"), F.col("_metadata.row_index").alias("row"))
    return df.select("*", place.alias(PLACE))


def fill_ingestion(info: AppendInfo) -> dict[str, Column]:
    """The three ingestion columns."""
    return {INGESTION_AT: instant(info.time), INGESTION_ID: F.lit(info.ingestion_id), ROW_ID: info.row_id}


def fill_columns(info: AppendInfo, fill: Fill) -> dict[str, Column]:
    """What a fill adds to a batch; it is run once for it, before conversion and before any retry."""
    columns = fill(info)
    if not isinstance(columns, dict):
        raise ContractError("a fill returns a dictionary of columns by name")
    return columns


def apply_fill(df: DataFrame, info: AppendInfo, fill: Fill | None) -> DataFrame:
    return df if fill is None else df.withColumns(fill_columns(info, fill))


def with_ingestion(df: DataFrame, info: AppendInfo, keys) -> DataFrame:
    """Prepend the ingestion columns to rows that have a key; no shuffle."""
    row_id = row_id_from_key(info, keys)
    columns = fill_ingestion(AppendInfo(**{**vars(info), "row_id": row_id}))
    return df.select(*[c.alias(n) for n, c in columns.items()], *[F.col(f"`{c}`") for c in df.columns])
