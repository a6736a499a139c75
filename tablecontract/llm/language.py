"""Language identification by hyperdimensional profiles of letter trigrams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import name_in, refuse, without

DIMENSIONS = 512
#: Languages a model may have; what bounds the prototypes that are collected and broadcast.
MOST_LANGUAGES = 2_000
UNKNOWN = "und"
#: Standard deviations of a random cosine, 1 / sqrt(dimensions), above which a cosine is no chance.
CHANCE = 4.5
#: Texts are measured by their first 8, 16, ... 256 letters; longer ones count as the longest of these.
LENGTHS = range(3, 9)
#: A text may score this part of what three quarters of the learned texts of its length reach.
PART = 1 / 3
_BINS = 1000  # of cosines from 0 to 1
_CHARS = 1 << 20  # of a text counted at once
_HELD = 1 << 20  # trigrams of texts that a task holds before it bundles them


def letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or 0 for what is no letter."""
    table = np.zeros(0x110000, np.uint32)
    for c in range(0x40000):  # no letters are assigned above
        if (ch := chr(c)).isalpha():
            low = ch.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def trigrams(text: str | None, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct letter trigrams of a whole text and their counts; words are bounded by a blank, other signs are dropped."""
    found: list[tuple[np.ndarray, np.ndarray]] = []
    carry = np.zeros(1, np.uint32)
    for at in range(0, len(text or ""), _CHARS):
        part = letters[np.frombuffer(text[at : at + _CHARS].encode("utf-32-le", "surrogatepass"), "<u4")]
        run = np.concatenate((carry, part, np.zeros(1, np.uint32) if at + _CHARS >= len(text) else part[:0]))
        run = run[np.concatenate(([True], (run[1:] != 0) | (run[:-1] != 0)))]
        if len(run) > 2:
            found.append(_count(run))
        carry = run[-2:].astype(np.uint32)
    if len(found) == 1:
        return found[0]
    return _merge(found)


def _count(run: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams around letters, 21 bits for each letter; where 10 bits do, half as wide numbers are sorted."""
    middle = run[1:-1] != 0
    if run.max() < 1024:
        codes, counts = np.unique((run[:-2] << 20 | run[1:-1] << 10 | run[2:])[middle], return_counts=True)
        codes = codes.astype(np.uint64)
        return codes >> 20 << 42 | (codes >> 10 & 1023) << 21 | codes & 1023, counts
    run = run.astype(np.uint64)
    return np.unique((run[:-2] << 42 | run[1:-1] << 21 | run[2:])[middle], return_counts=True)


def _merge(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    if not found:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    codes, at = np.unique(np.concatenate([c for c, _ in found]), return_inverse=True)
    return codes, np.bincount(at, np.concatenate([n for _, n in found])).astype(np.int64)


class Space:
    """Random letter vectors of +1 and -1; a trigram binds its letters, each permuted by its place.

    Any letter of any script has a vector, drawn from its code point, so nothing is
    learned here and all tasks agree.
    """

    def __init__(self, dimensions: int, seed: int):
        self._dimensions, self._seed = dimensions, seed
        self._row = np.full(1 << 21, -1, np.int32)  # by code point
        self._table = np.zeros((3, 0, dimensions), np.int8)

    def _rows(self, letters: np.ndarray) -> np.ndarray:
        rows = self._row[letters]
        if len(rows) and rows.min() < 0:
            if self._table.shape[1] > 20_000:
                self._row[:], self._table = -1, self._table[:, :0]
                rows = self._row[letters]
            new = np.unique(letters[rows < 0])
            vectors = [np.random.default_rng((self._seed, int(c))).integers(0, 2, self._dimensions, np.int8) * 2 - 1 for c in new]
            made = np.array(vectors, np.int8)
            self._row[new] = np.arange(len(new)) + self._table.shape[1]
            self._table = np.concatenate((self._table, np.stack([np.roll(made, 2 - k, axis=1) for k in range(3)])), axis=1)
            rows = self._row[letters]
        return rows

    def bundle(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of trigram vectors, each as often as it was counted."""
        total = np.zeros(self._dimensions)
        for at in range(0, len(codes), 2048):
            some = codes[at : at + 2048]
            a, b, c = np.split(self._rows(np.concatenate((some >> 42, some >> 21 & 0x1FFFFF, some & 0x1FFFFF)).astype(np.int64)), 3)
            bound = self._table[0][a] * self._table[1][b] * self._table[2][c]
            total += counts[at : at + 2048].astype(np.float32) @ bound.astype(np.float32)
        return total


def train(docs: DataFrame, *, text: str = "text", lang: str = "lang", dimensions: int = DIMENSIONS, seed: int = 7) -> dict[str, np.ndarray]:
    """A prototype per language: the bundle of all trigrams of all its texts.

    Each task counts trigrams and bundles them once per language; the partial sums
    are added by language and dimension, so a language with most of the rows is no
    hot key. The result has languages times ``dimensions`` numbers, at most
    ``MOST_LANGUAGES`` languages. Rows with null text or language teach nothing.
    """
    rows = docs.select(name_in(docs, text).cast("string").alias("text"), name_in(docs, lang).cast("string").alias("lang"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, letters, total = Space(dimensions, seed), letter_table(), {}

        def add(found: dict[str, list]) -> None:
            for name, parts in found.items():
                total[name] = total.get(name, 0) + space.bundle(*_merge(parts))
            found.clear()

        for batch in batches:
            found: dict[str, list] = {}
            held = 0
            for t, name in zip(batch.column("text"), batch.column("lang").to_pylist(), strict=True):
                found.setdefault(name, []).append(trigrams(t.as_py(), letters))
                held += len(found[name][-1][0])
                if held > _HELD:
                    add(found)
                    held = 0
            add(found)
        if total:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))],
                names=["lang", "vector"])

    sums = (
        rows.where("text is not null and lang is not null").mapInArrow(count, "lang string, vector array<double>")
        .select("lang", F.posexplode("vector").alias("i", "v")).groupBy("lang", "i").agg(F.sum("v").alias("v"))
    )
    found: dict[str, np.ndarray] = {}
    for name, i, v in sums.toLocalIterator():
        if name not in found and len(found) == MOST_LANGUAGES:
            raise ValueError(f"more than {MOST_LANGUAGES} languages")
        found.setdefault(name, np.zeros(dimensions))[i] = v
    return {name: v for name, v in sorted(found.items()) if v.any()}


def calibrate(docs: DataFrame, prototypes: dict[str, np.ndarray], *, text: str = "text", seed: int = 7) -> dict[int, float]:
    """The least cosine of a text in one of the languages, by the power of two its number of trigrams reaches.

    Short texts score lower than long ones, so the beginnings of all texts are measured at
    each of ``LENGTHS``. The least cosine is ``PART`` of their lower quartile, and never above ``CHANCE``
    standard deviations of a random cosine: so it is that noise bound where texts
    are long enough to be told from noise, and lower where they are not. A quarter of ``docs`` may be in no
    language. Cosines are counted in ``_BINS`` bins, and only the counts reach the driver.
    """
    if not prototypes:
        return {}
    matrix = np.array([v / np.linalg.norm(v) for v in prototypes.values()])
    dimensions = matrix.shape[1]
    shared = docs.sparkSession.sparkContext.broadcast(matrix)
    longest = 1 << LENGTHS[-1]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, letters, seen = Space(dimensions, seed), letter_table(), np.zeros((len(LENGTHS), _BINS + 1), np.int64)
        for batch in batches:
            for t in batch.column("text"):
                start = beginning(t.as_py(), letters, longest)
                for i, k in enumerate(LENGTHS):
                    if len(start) < 1 << k:
                        break
                    vector = space.bundle(*np.unique(start[: 1 << k], return_counts=True))
                    cosine = (shared.value @ vector).max() / max(np.linalg.norm(vector), 1e-9)
                    seen[i, int(min(1.0, max(0.0, cosine)) * _BINS)] += 1
        i, bin_ = np.nonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(i + LENGTHS[0]), pa.array(bin_), pa.array(seen[i, bin_])], names=["k", "bin", "n"])

    rows = docs.select(name_in(docs, text).cast("string").alias("text")).where("text is not null")
    counts: dict[int, np.ndarray] = {}
    for k, b, n in rows.mapInArrow(count, "k long, bin long, n long").groupBy("k", "bin").agg(F.sum("n")).collect():
        counts.setdefault(k, np.zeros(_BINS + 1, np.int64))[b] = n
    bound, least = CHANCE / dimensions**0.5, {}
    for k, n in sorted(counts.items()):
        quartile = int(np.searchsorted(np.cumsum(n), n.sum() / 4)) / _BINS
        least[k] = min(bound, PART * quartile)
    return least


def beginning(text: str | None, letters: np.ndarray, most: int) -> np.ndarray:
    """The first trigrams of a text in their order, ``most`` at most."""
    found, at, carry = np.zeros(0, np.uint64), 0, np.zeros(1, np.uint32)
    while len(found) < most and at < len(text or ""):
        size = min(4 * most, _CHARS)
        part = letters[np.frombuffer(text[at : at + size].encode("utf-32-le", "surrogatepass"), "<u4")]
        run = np.concatenate((carry, part, np.zeros(1, np.uint32) if at + size >= len(text) else part[:0]))
        run = run[np.concatenate(([True], (run[1:] != 0) | (run[:-1] != 0)))].astype(np.uint64)
        found = np.concatenate((found, (run[:-2] << 42 | run[1:-1] << 21 | run[2:])[run[1:-1] != 0]))
        carry, at = run[-2:].astype(np.uint32), at + size
    return found[:most]


def predict(
    docs: DataFrame, prototypes: dict[str, np.ndarray], *, text: str = "text", seed: int = 7, least: dict[int, float] | None = None
) -> DataFrame:
    """Documents with ``lang_pred``, the language of the nearest prototype, and ``score``, that cosine from 0 to 1.

    ``und`` and 0 where text is null or has no letter, or where there are no
    prototypes. Of equal cosines the first language by name wins. Narrow: the
    prototypes are broadcast. Input columns named like results are replaced; a text column named like one is refused.

    With ``least`` (from ``calibrate``) a text that scores below the least cosine of its length is ``und``
    and keeps its score. A text shorter than all that was measured cannot be told from noise and keeps its language.
    """
    refuse(text, ("lang_pred", "score"))
    rows = without(docs, ["lang_pred", "score"])
    bounds = sorted((least or {}).items())
    names = list(prototypes)
    matrix = np.array([v / np.linalg.norm(v) for v in prototypes.values()])
    dimensions = matrix.shape[1] if names else DIMENSIONS
    shared = docs.sparkSession.sparkContext.broadcast((names, matrix))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        space, letters = Space(dimensions, seed), letter_table()
        names, matrix = shared.value
        for batch in batches:
            pred, score = [], []
            for t in batch.column(text):
                codes, counts = trigrams(t.as_py(), letters)
                vector = space.bundle(codes, counts)
                norm = np.linalg.norm(vector)
                if not len(codes) or not norm or not names:
                    pred.append(UNKNOWN), score.append(0.0)
                    continue
                cosines = matrix @ vector / norm
                best = int(np.argmax(cosines))
                size = int(counts.sum())
                under = next((bound for k, bound in reversed(bounds) if size >= 1 << k), -1.0)
                pred.append(names[best] if cosines[best] >= under else UNKNOWN), score.append(float(min(1.0, max(0.0, cosines[best]))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    typed = rows.withColumns({"lang_pred": F.lit("").cast("string"), "score": F.lit(0.0)}).schema
    return rows.mapInArrow(compare, typed)


def held_out(docs: DataFrame, id: str = "doc_id") -> Column:
    """True for the fifth of the documents that no model learns from, by a checksum of the id; a null id is one of them."""
    return F.coalesce(F.crc32(name_in(docs, id).cast("string").cast("binary")) % 5 == 0, F.lit(True))
