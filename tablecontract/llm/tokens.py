"""Token ids of documents in binary files, and documents read back from them."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .common import name_in
from .packing import Encoder
from .rans import SEGMENT, Segment, crc_joined, encode

#: Bytes of text that become one file, about.
FILE_BYTES = 32 << 20


def write(docs: DataFrame, tokenizer: str, path: str, *, id: str = "doc_id", text: str = "text", end: int = 2, file_bytes: int = FILE_BYTES) -> None:
    """Write the ids of every document, each closed by ``end``, in ascending order of ``id``.

    The folder holds parquet files, one for each range of ids; a row is one segment of
    ``rans`` with the documents in it: ``part, segment, start`` (ids of the part before it),
    ``first`` (number of its first document in the part), ``doc_ids, counts`` (ids of each in this segment), ``cut`` (1 if the
    first document began before, 2 if the last one goes on, 3 for both), ``n_tokens, payload``. A
    frequency table is shared by the blocks of a segment and made from its own ids, so texts are
    tokenized once and a file can be read without any other. Only a document longer than a segment is cut. Spark's committer writes the files: a lost
    executor costs its tasks, and what they left is not read.

    Documents are dealt in ranges of ``id`` and of their place in the input, so that any number of equal or null
    ids is cut over many files; null ids come first, and equal ids stand in the order
    of the input. Null text is the lone ``end``. A task holds one document's ids and one segment. No
    documents give no segments; other columns are not carried.
    """
    volume = docs.agg(F.sum(F.coalesce(F.octet_length(name_in(docs, text)), F.lit(0)) + 64)).first()[0] or 0
    rows = docs.select(name_in(docs, id).alias("doc_id"), F.coalesce(name_in(docs, text).cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("place"))
    dealt = rows.repartitionByRange(max(1, -(-volume // file_bytes)), F.col("doc_id").asc_nulls_first(), "place")
    kind = rows.schema["doc_id"].dataType
    schema = T.StructType.fromDDL("part int, segment int, start long, first long, doc_ids array<int>, counts array<long>, cut int, n_tokens long, payload binary")
    schema["doc_ids"].dataType = T.ArrayType(kind)

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, encode_text, last = TaskContext.get().partitionId(), Encoder(tokenizer), np.array([end], "<u4").tobytes()
        waiting: list[bytes] = []
        names: list[pa.Scalar] = []
        counts: list[int] = []
        size = start = first = number = 0
        began = False

        def closed(goes_on: bool = False) -> pa.RecordBatch:
            """The segment of what has gathered; a document that goes on keeps its number."""
            nonlocal size, start, first, number, began
            ids = np.frombuffer(b"".join(waiting), "<u4")
            out = pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([number], pa.int32()), pa.array([start], pa.int64()), pa.array([first], pa.int64()),
                 pa.ListArray.from_arrays(pa.array([0, len(names)], pa.int32()), pa.array([x.as_py() for x in names], names[0].type)),
                 pa.array([counts], pa.list_(pa.int64())), pa.array([began + 2 * goes_on], pa.int32()), pa.array([len(ids)], pa.int64()),
                 pa.array([encode(ids)], pa.binary())],
                names=schema.names)
            first, start, number, size, began = first + len(names) - goes_on, start + size, number + 1, 0, goes_on
            waiting.clear(), names.clear(), counts.clear()
            return out

        for batch in batches:
            for name, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                ids = encode_text(text.as_py()) + last
                if size and size + len(ids) // 4 > SEGMENT:
                    yield closed()
                while ids:
                    taken, ids = ids[: 4 * (SEGMENT - size)], ids[4 * (SEGMENT - size) :]
                    waiting.append(taken), names.append(name), counts.append(len(taken) // 4)
                    size += len(taken) // 4
                    if size == SEGMENT:
                        yield closed(bool(ids))
        if names:
            yield closed()

    ordered = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "place").select("doc_id", "text")
    # The bytes are coded already.
    ordered.mapInArrow(segments, schema).write.mode("overwrite").option("compression", "uncompressed").parquet(path)


def pieces(spark: SparkSession, path: str, *, ids: bool = False, where: str = "true") -> DataFrame:
    """What each segment holds of each document: ``part, number`` (of the document in its part), ``doc_id, at`` (the ids of the part before it), ``n_tokens, ids_crc32, whole`` and, if asked for, ``ids`` (little-endian, unsigned 32 bits).

    ``where`` chooses segments by their columns. Segments decode independently; one that fails a checksum is an error. A document longer than a segment has several pieces.
    """
    stored = spark.read.parquet(path)
    kind = stored.schema["doc_ids"].dataType.elementType.simpleString()
    schema = f"part int, number long, doc_id {kind}, at long, n_tokens long, ids_crc32 long, whole boolean" + ", ids binary" * ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(len(batch)):
                row = {n: batch.column(n)[i] for n in ("part", "start", "first", "counts", "payload", "cut")}
                raw = Segment(row["payload"].as_py()).ids().astype("<u4").tobytes()
                counts = np.array(row["counts"].as_py(), np.int64)
                stops = np.cumsum(counts)
                each = [raw[4 * (b - n) : 4 * b] for b, n in zip(stops.tolist(), counts.tolist(), strict=True)]
                whole = np.ones(len(counts), bool)
                whole[0] = not row["cut"].as_py() & 1
                whole[-1] &= not row["cut"].as_py() & 2
                columns = [
                    pa.array(np.full(len(counts), row["part"].as_py(), np.int32)), pa.array(row["first"].as_py() + np.arange(len(counts))),
                    batch.column("doc_ids")[i].values, pa.array(row["start"].as_py() + stops - counts), pa.array(counts),
                    pa.array([zlib.crc32(c) for c in each], pa.int64()), pa.array(whole)]
                yield pa.RecordBatch.from_arrays(
                    columns + ([pa.array(each, pa.binary())] if ids else []),
                    names=["part", "number", "doc_id", "at", "n_tokens", "ids_crc32", "whole"] + ["ids"] * ids)

    return stored.where(where).select("part", "start", "first", "doc_ids", "counts", "cut", "payload").mapInArrow(read, schema)


def documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document in the files: ``doc_id, start`` (ids of all documents before it), ``n_tokens, ids_crc32``."""
    found = pieces(spark, path)
    kind = found.schema["doc_id"].dataType.simpleString()

    def joined(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("at")
        crc = 0
        for one, n in zip(rows["ids_crc32"], rows["n_tokens"], strict=True):
            crc = crc_joined(crc, int(one), 4 * int(n))
        return rows.head(1)[["part", "doc_id", "at"]].assign(n_tokens=rows["n_tokens"].sum(), ids_crc32=crc)

    short = found.where("whole").select("part", "doc_id", "at", "n_tokens", "ids_crc32")
    # Segments without such a document are not read again.
    long = pieces(spark, path, where="cut <> 0").where("not whole").groupBy("part", "number").applyInPandas(joined, f"part int, doc_id {kind}, at long, n_tokens long, ids_crc32 long")
    # One row a file.
    size = spark.read.parquet(path).groupBy("part").agg(F.sum("n_tokens").alias("size"))
    offset = size.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("offset"))
    return short.unionByName(long).join(offset, "part").select("doc_id", (F.col("offset") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
