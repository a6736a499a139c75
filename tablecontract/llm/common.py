"""Small helpers shared by the operators: columns, words, folders."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.files import shared_folder

#: Lower-cases A-Z, keeps 0-9, a-z and every byte of a non-ASCII character, and turns the rest into spaces.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def fold(text: bytes) -> bytes:
    """UTF-8 text with A-Z lower-cased and every character that is no part of a word turned into a space.

    A word is a run of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing. No byte
    moves, so a place in the result is a place in the text.
    """
    return text.translate(_FOLD)


def words(text: bytes | None) -> list[bytes]:
    """The words of a text, see ``fold``; none for null."""
    return fold(text).split() if text else []


def name_in(df: DataFrame, name: str) -> Column:
    """A column by its exact name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """``df`` without the columns a result is about to bring, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select(*[name_in(df, c) for c in df.columns if c.lower() not in taken])


def send(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast of anything, its code included; ``receive`` gives it back in a task."""
    return spark.sparkContext.broadcast(cloudpickle.dumps(value))


def receive(sent: Broadcast) -> object:
    return cloudpickle.loads(sent.value)


def refuse(column: str, results: Iterable[str]) -> None:
    """Raises where a column to be read has the name of a result, whatever its case."""
    if column.lower() in results:
        raise ValueError(f"a column to be read has the name of a result: {column}")


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: its lineage ends there.

    Every executor reaches the folder, so a lost one costs its tasks and not the rows.
    """
    spark = df.sparkSession
    path = shared_folder(spark, purpose)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
