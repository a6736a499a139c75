"""De-duplication with bounded state."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from ..contract import INGESTION_AT, ROW_ID

#: Rows with different ids that a task holds before it lets them go.
HELD_ROWS = 200_000


def deduplicate_stream(df: DataFrame, within: str, keys=(ROW_ID,), event_time: str = INGESTION_AT) -> DataFrame:
    """Drop a repeated id that arrives within the given time of the first; state older than that is let go.

    Copies of an id in one micro-batch are reduced in the tasks that read them, so that a hot id sends a row from each
    and no more to the task that keeps its state.
    """
    marked = df.withWatermark(event_time, within)
    return one_a_task(marked, keys, event_time).dropDuplicatesWithinWatermark(list(keys))


def one_a_task(df: DataFrame, keys, event_time: str) -> DataFrame:
    """Of rows with one id in a task, the latest: if any of them is not too late for the watermark, it is not.

    A task holds the rows of up to ``HELD_ROWS`` ids; with more, it lets them go and begins anew, and an id may be sent once more.
    """
    keys = list(keys)
    if any(kind in df.schema.simpleString() for kind in ("variant", "interval")):
        return df  # Arrow does not carry them

    def reduced(table: pa.Table) -> pa.Table:
        names = [f"k{i}" for i in range(len(keys))]
        rows = table.select([*keys, event_time]).rename_columns([*names, "at"]).append_column("place", pa.array(range(len(table)), pa.int64()))
        # A row without a time is never the latest; of equally late ones the first stays.
        rows = rows.take(pc.sort_indices(rows, [("at", "ascending"), ("place", "descending")], null_placement="at_start"))
        last = rows.group_by(names, use_threads=False).aggregate([("place", "last")])
        return table.take(last.column("place_last").combine_chunks().sort())

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            held.append(reduced(pa.Table.from_batches([batch])))
            size += len(held[-1])
            if size > HELD_ROWS:
                held = [reduced(pa.concat_tables(held))]
                size = len(held[0])
                if size > HELD_ROWS // 2:
                    yield from held[0].to_batches(max_chunksize=10_000)
                    held, size = [], 0
        if held:
            yield from reduced(pa.concat_tables(held)).to_batches(max_chunksize=10_000)

    return df.mapInArrow(reduce, df.schema)
