"""Embedding whitening: blockwise QR of centred rows, then singular values and vectors of the last triangle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .bidiagonal import EPS, right_singular
from .common import name_in, receive, saved, send

#: Triangles that one task joins at once.
FAN = 16
#: What is added to 64 times an entry.
BASE = 1_000_000
_MOST = 1 << 52


def _clean(vector: Column) -> Column:
    """No null or non-finite entry, and none so large that 64 times it is no exact whole number."""
    return F.coalesce((F.size(vector) > 0) & F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) < _MOST / 64)), F.lit(False))


def _rows(batch: pa.RecordBatch, width: int) -> np.ndarray:
    """Whole numbers of a batch's vectors, without the base."""
    flat = batch.column("vector").flatten().to_numpy(zero_copy_only=False)
    return np.floor(64 * flat.astype(np.float64)).astype(np.int64).reshape(len(batch), width)


def whiten(vectors: DataFrame, *, id: str = "vec_id", vector: str = "embedding", components: int = 32) -> DataFrame:
    """Vectors in the coordinates in which their covariance is the identity, one row per vector and component.

    An entry ``c`` is taken as the whole number ``x = floor(64 * c) + 1000000``. Returns ``vec_id,
    component`` (from 1, by falling eigenvalue of the covariance V), ``n`` (vectors), ``deviation`` (sum over dimensions
    of ``(n * x - sum)**2``, exact, a decimal), ``whitened``, ``explained`` (eigenvalue over trace) and
    ``identity_error``, the largest entry of the whitened covariance less the identity.

    Four narrow passes over the vectors alone: sums of each dimension; blockwise QR, in which a task keeps
    one triangle of its centred rows; products of the whitened rows; the rows themselves. Triangles of tasks are
    joined sixteen at a time by further QR, so no task sees more than that, and the last one, whose size is the number of dimensions squared and nothing else,
    goes to the driver: Householder reflections make it bidiagonal, dqds finds its singular values, twisted factorisations its directions.

    Vectors that are null, empty, or hold a null, a non-finite entry or one of 2**46 or more are left out, and so are those
    whose length is not the most frequent one (the longer of equally frequent ones). Null ids and repeated rows are vectors like others. A component without variance
    has ``explained`` 0 and a null ``whitened``, and ``identity_error`` does not cover it. Of a repeated
    eigenvalue any orthonormal directions are taken, the same for all rows. No vectors give no rows; other columns are not carried.
    """
    spark = vectors.sparkSession
    rows = vectors.select(name_in(vectors, id).alias("vec_id"), name_in(vectors, vector).alias("vector"))
    rows = rows.where(_clean(F.col("vector")))
    kind = rows.schema["vec_id"].dataType.simpleString()
    schema = T.StructType.fromDDL(f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    usual = rows.groupBy(F.size("vector").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if usual is None:
        return spark.createDataFrame([], schema)
    width, n = usual["width"], usual["count"]
    rows = rows.where(F.size("vector") == width)
    entries = rows.select("vector")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * width
        for batch in batches:
            x = _rows(batch, width)
            # In halves, so that no sum of a batch leaves 64 bits.
            high, low = (x >> 26).sum(axis=0).tolist(), (x & ((1 << 26) - 1)).sum(axis=0).tolist()
            total = [t + (h << 26) + k for t, h, k in zip(total, high, low, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(total, pa.decimal128(38, 0))], names=["place", "total"])

    sums = entries.mapInArrow(add, "place int, total decimal(38,0)").groupBy("place").agg(F.sum("total").alias("total"))
    sums = [int(r["total"]) for r in sums.orderBy("place").collect()]
    # The mean as a whole number and a rest, so that centring rounds once.
    whole = np.array([s // n for s in sums], np.int64)
    rest = np.array([(s % n) / n for s in sums])
    triangle = _triangle(entries, width, whole, rest)
    squares, directions = right_singular(triangle)
    values, trace = squares / n, float(np.sum(triangle**2)) / n
    values = np.where(values <= trace * (EPS * width) ** 2, 0.0, values)[:components]
    live = int(np.count_nonzero(values))
    matrix = directions[:, :live] / np.sqrt(values[:live])
    sent = send(spark, matrix)

    def project(x: np.ndarray) -> np.ndarray:
        return ((x - whole).astype(np.float64) - rest) @ receive(sent)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        product = np.zeros((live + 1, live))
        for batch in batches:
            w = project(_rows(batch, width))
            product[:live] += w.T @ w
            product[live] += w.sum(axis=0)
        i, j = np.indices(product.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel().astype(np.int32)), pa.array(j.ravel().astype(np.int32)), pa.array(product.ravel())], names=["i", "j", "v"])

    error = 0.0
    if live:
        cells = entries.mapInArrow(multiply, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
        product = np.zeros((live + 1, live))
        for c in cells:
            product[c["i"], c["j"]] = c["v"] / n
        error = float(np.abs(product[:live] - np.outer(product[live], product[live]) - np.eye(live)).max())
    explained = values / trace if trace else values
    count = len(values)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, len(whole_batch), 1024):
                batch = whole_batch.slice(at, 1024)
                x, m = _rows(batch, width), len(batch)
                w = np.full((m, count), np.nan)
                w[:, :live] = project(x)
                again = np.repeat(np.arange(m), count)
                deviation = pa.array(_deviation(x, n, sums), pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id").take(pa.array(again)), pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * count, n, np.int64)), deviation.take(pa.array(again)), pa.array(w.ravel(), mask=np.isnan(w.ravel())),
                     pa.array(np.tile(explained, m)), pa.array(np.full(m * count, error))],
                    names=schema.names)

    return rows.mapInArrow(place, schema)


def _deviation(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sums of squares; in 64 bits where they cannot overflow, else in whole numbers of any size."""
    most = max(int(np.abs(x).max()) * n, max(abs(s) for s in sums)) * 2
    if most and x.shape[1] * most * most >= 1 << 62:
        far = x.astype(object) * n - np.array(sums, object)
        return (far * far).sum(axis=1).tolist()
    far = x * n - np.array(sums, np.int64)
    return (far * far).sum(axis=1).tolist()


def _triangle(entries: DataFrame, width: int, whole: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """R of the QR factorisation of all centred rows."""

    def factor(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = np.zeros((0, width))
        for batch in batches:
            for at in range(0, len(batch), max(4 * width, 1024)):
                x = _rows(batch.slice(at, max(4 * width, 1024)), width)
                r = np.linalg.qr(np.concatenate((r, (x - whole).astype(np.float64) - rest)), mode="r")
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([r.tobytes()], pa.binary())], names=["task", "r"])

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("task")
        stacked = np.concatenate([np.frombuffer(r.as_py(), np.float64).reshape(-1, width) for r in table.column("r")])
        return pa.table({"task": [table.column("task")[0].as_py() // FAN], "r": pa.array([np.linalg.qr(stacked, mode="r").tobytes()], pa.binary())})

    schema = "task long, r binary"
    left = saved(entries.mapInArrow(factor, schema), "triangles")
    while left.count() > 1:
        left = saved(left.groupBy(F.floor(F.col("task") / FAN)).applyInArrow(join, schema), "triangles")
    last = left.first()
    r = np.frombuffer(last["r"], np.float64).reshape(-1, width)
    return np.concatenate((r, np.zeros((width - len(r), width)))) if len(r) < width else r
