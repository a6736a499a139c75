"""Version 7 UUIDs: one minted on the driver per sink, one per row as a Spark expression.

A row id must come out the same when a task is run again, so it is a function of
the sink, the batch time and either a key of the row or the row's place in a
staged file. Nothing here is random inside a task.
"""

from __future__ import annotations

import os
import time
import uuid

from pyspark.sql import Column, functions as F

# Bits of a staged row's place: the task that wrote it, and its row there. A task
# writes one file. With them ids are distinct without relying on a hash, which
# 74 bits would not promise beyond some billions of rows in one millisecond.
TASK_BITS, ROW_BITS = 22, 32


def new_uuid7(millis: int | None = None) -> str:
    millis = time.time_ns() // 1_000_000 if millis is None else millis
    value = (millis << 80) | int.from_bytes(os.urandom(10), "big")
    value &= ~(0xF << 76) & ~(0x3 << 62)
    return str(uuid.UUID(int=value | (0x7 << 76) | (0x2 << 62)))


def uuid7_from_hash(millis: int | Column, digest: Column) -> Column:
    """``digest`` is hexadecimal text of at least 20 digits."""
    stamp = _stamp(millis)
    variant = F.translate(F.substr(digest, F.lit(4), F.lit(1)), "0123456789abcdef", "89ab" * 4)
    return F.concat_ws(
        "-",
        F.substr(stamp, F.lit(1), F.lit(8)),
        F.substr(stamp, F.lit(9), F.lit(4)),
        F.concat(F.lit("7"), F.substr(digest, F.lit(1), F.lit(3))),
        F.concat(variant, F.substr(digest, F.lit(5), F.lit(3))),
        F.substr(digest, F.lit(8), F.lit(12)),
    )


def key_digest(ingestion_id: str | Column, keys: list[Column]) -> Column:
    """The same key under the same sink always gives the same digest."""
    sink = F.lit(ingestion_id) if isinstance(ingestion_id, str) else ingestion_id
    text = keys[0].cast("string") if len(keys) == 1 else F.to_json(F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)]))
    refuse = F.raise_error(F.lit("a row's key is NULL, so it cannot have a stable id")).cast("string")
    return F.sha2(F.concat(sink, F.lit("|"), F.coalesce(text, refuse)), 256)


def uuid7_from_position(millis: int, batch: str, task: Column, row: Column) -> Column:
    """An id that sorts by the row's place: 12 + 42 bits of place, 20 bits of the batch.

    A batch of over four million tasks, or four billion rows in one of them, is refused.
    """
    known = (task < (1 << TASK_BITS)) & (row < (1 << ROW_BITS))
    place = F.shiftleft(task.cast("bigint"), ROW_BITS).bitwiseOR(row.cast("bigint"))
    refuse = F.raise_error(F.lit("a row's place in its staged file is unknown, or past what a row id can number")).cast("bigint")
    place = F.when(known, place).otherwise(refuse)
    low_bits = TASK_BITS + ROW_BITS - 12
    rest = F.shiftleft(place.bitwiseAND((1 << low_bits) - 1), 62 - low_bits).bitwiseOR(
        F.conv(F.substring(F.sha2(F.lit(batch), 256), 1, 5), 16, 10).cast("bigint")
    )
    high = _hex(F.shiftright(place, low_bits), 3)
    # Two leading bits 10 mark the variant.
    low = _hex(rest.bitwiseOR(F.lit(-(1 << 63)).cast("bigint")), 16)
    stamp = _stamp(millis)
    return F.concat_ws(
        "-",
        F.substr(stamp, F.lit(1), F.lit(8)),
        F.substr(stamp, F.lit(9), F.lit(4)),
        F.concat(F.lit("7"), high),
        F.substr(low, F.lit(1), F.lit(4)),
        F.substr(low, F.lit(5), F.lit(12)),
    )


def _stamp(millis: int | Column) -> Column:
    return _hex(F.lit(millis).cast("bigint") if isinstance(millis, int) else millis, 12)


def _hex(value: Column, digits: int) -> Column:
    return F.lpad(F.lower(F.hex(value)), digits, "0")
