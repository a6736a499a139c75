"""Fingerprints of many rows that do not depend on their order or on how they are dealt."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

_HASHES = ("_hash_a", "_hash_b")
# A 64-bit hash is summed in three parts, so that no sum of up to 2**41 rows leaves 64 bits.
_PARTS = ((0, 22), (22, 21), (43, 21))


def hashable(value: Column, dtype: T.DataType) -> Column:
    """Spark hashes neither maps nor variants; their JSON it does."""
    unhashable = "map<" in dtype.simpleString() or "variant" in dtype.simpleString()
    return F.to_json(F.struct(value.alias("v"))) if unhashable else value


def _hashed(df: DataFrame, columns: list[str]) -> DataFrame:
    types = {f.name: f.dataType for f in df.schema.fields}
    values = [hashable(F.col(f"`{c}`"), types[c]) for c in columns]
    # A null is no input to a hash: which columns are null is one of its own.
    nulls = F.concat_ws("", *[F.when(v.isNull(), "0").otherwise("1") for v in values])
    return df.withColumns({name: F.xxhash64(F.lit(i), nulls, *values) for i, name in enumerate(_HASHES)})


def _sums() -> list[Column]:
    parts = [
        F.coalesce(F.sum(F.shiftrightunsigned(name, low).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))), F.lit(0)).alias(f"{name}_{low}")
        for name in _HASHES for low, bits in _PARTS
    ]
    return [F.count(F.lit(1)).alias("rows"), *parts]


class Tally:
    """Number and fingerprint of the rows that an action sees, taken while it runs."""

    def __init__(self):
        self._seen = Observation()

    def over(self, df: DataFrame, columns: list[str]) -> DataFrame:
        """``df``, watched. The values of ``columns`` count in their order, their names do not."""
        return _hashed(df, columns).observe(self._seen, *_sums()).drop(*_HASHES)

    @property
    def rows(self) -> int:
        return self._seen.get["rows"]

    @property
    def mark(self) -> tuple[int, ...]:
        return _tuple(self._seen.get)


def fingerprint(df: DataFrame, columns: list[str]) -> tuple[int, ...]:
    """Number of rows and sums of two hashes of each, by a job of its own."""
    return _tuple(_hashed(df, columns).agg(*_sums()).first().asDict())


def _tuple(values: dict) -> tuple[int, ...]:
    return values["rows"], *(values[f"{name}_{low}"] for name in _HASHES for low, _ in _PARTS)
