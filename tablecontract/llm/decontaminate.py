"""Benchmark decontamination by a generalised suffix automaton over the words of test items."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext, cloudpickle
from pyspark.sql import DataFrame, functions as F, types as T

from .common import name_in, receive, saved, send, without, words

#: Words of test items in one automaton, at most. More items make more automata, and each adds a pass over the documents.
BLOCK_WORDS = 1_000_000
_RUN_SCHEMA = pa.schema([("part", pa.int32()), ("before", pa.int64()), ("n_words", pa.int64()), ("name", pa.string()), ("need", pa.int32()), ("words", pa.binary())])
_RUNS = "part int, before long, n_words long, name string, need int, words binary"

RESULTS = ("n_words", "n_hit", "hit_items", "hit_spans", "clean_text")
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


class SuffixAutomaton:
    """All substrings of all items in one automaton; walking a text gives the longest match that ends at each word.

    An item is due once its own limit of consecutive words has matched: ``length``
    words, or fewer where ``coverage`` of the item is fewer. Each state keeps what
    falls due in its class of substrings and a link to the next state upwards that
    keeps anything, so the automaton stays linear in the words of the items. ``needs``
    gives the limit of each item where it is a part of a longer one.
    """

    def __init__(self, items: list[tuple[str | None, list[bytes]]], length: int, coverage: float, needs: list[int] | None = None):
        self.vocabulary: dict[bytes, int] = {}
        self._next: list[dict[int, int]] = [{}]
        self._link, self._length = [-1], [0]
        needs = needs or [_need(len(ws), length, coverage) for _, ws in items]
        coded = [(name, need, [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in ws]) for (name, ws), need in zip(items, needs, strict=True) if ws]
        for _, _, ids in coded:
            last = 0
            for w in ids:
                last = self._extend(last, w)
        due: list[list[tuple[int, str | None]]] = [[] for _ in self._next]
        self.shortest = 0
        for name, need, ids in coded:
            self.shortest = min(self.shortest or need, need)
            state, matched, seen = 0, 0, set()
            for w in ids:
                state, matched = self._next[state][w], matched + 1
                at = state
                while self._length[self._link[at]] >= need:
                    at = self._link[at]
                if matched >= need and at not in seen:
                    seen.add(at)
                    due[at].append((need, name))
        self._due = [tuple(sorted(set(x), key=str)) for x in due]
        self._up = [-1] * len(due)
        for state in sorted(range(1, len(due)), key=self._length.__getitem__):
            link = self._link[state]
            self._up[state] = link if self._due[link] else self._up[link]

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self._next, self._link, self._length
        there = nxt[last].get(w)
        if there is not None:
            return there if length[there] == length[last] + 1 else self._split(last, there, w)
        new = self._state({}, 0, length[last] + 1)
        while last != -1 and w not in nxt[last]:
            nxt[last][w] = new
            last = link[last]
        if last != -1:
            there = nxt[last][w]
            link[new] = there if length[there] == length[last] + 1 else self._split(last, there, w)
        return new

    def _split(self, last: int, there: int, w: int) -> int:
        part = self._state(dict(self._next[there]), self._link[there], self._length[last] + 1)
        self._link[there] = part
        while last != -1 and self._next[last].get(w) == there:
            self._next[last][w] = part
            last = self._link[last]
        return part

    def _state(self, to: dict[int, int], link: int, length: int) -> int:
        self._next.append(to)
        self._link.append(link)
        self._length.append(length)
        return len(self._next) - 1

    def scan(self, text: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Word ranges ``[start, stop)`` that items cover, merged and in order, and the items.

        A word outside the vocabulary puts the automaton back at its root, so only
        runs of known words that are long enough for the shortest limit are walked.
        """
        if not self.shortest or len(text) < self.shortest:
            return [], set()
        get = self.vocabulary.get
        ids = np.fromiter((get(w, -1) for w in text), np.int64, len(text))
        edges = np.flatnonzero(np.diff(np.concatenate(([0], (ids >= 0).view(np.int8), [0]))))
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        for begin, end in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True):
            if end - begin >= self.shortest:
                self._walk(ids[begin:end].tolist(), begin, spans, found)
        return spans, found

    def _walk(self, ids: list[int], begin: int, spans: list, found: set) -> None:
        nxt, link, length, due, up = self._next, self._link, self._length, self._due, self._up
        state = matched = 0
        for i, w in enumerate(ids, begin):
            while state and w not in nxt[state]:
                state = link[state]
                matched = length[state]
            state = nxt[state][w]
            matched += 1
            at, most = state if due[state] else up[state], 0
            while at > 0:
                for need, name in due[at]:
                    if need <= matched:
                        most = max(most, need)
                        if name is not None:
                            found.add(name)
                at = up[at]
            if most:
                _add(spans, i + 1 - most, i + 1)


def _need(n: int, length: int, coverage: float) -> int:
    """Consecutive words of an item of ``n`` that make a span."""
    return min(length, max(1, math.ceil(coverage * n)))


def _add(spans: list[tuple[int, int]], start: int, stop: int) -> None:
    """Append a range whose stop is past all others, merged with those it meets."""
    while spans and spans[-1][1] >= start:
        start = min(start, spans.pop()[0])
    spans.append((start, stop))


def decontaminate(
    docs: DataFrame, items: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    length: int = 10, coverage: float = 1.0, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """Documents with what they share with test items, and their text without it.

    A span is contaminated where ``length`` consecutive words of an item match, or
    ``coverage`` of the words of an item for which that is fewer. Adds ``n_words``,
    ``n_hit`` (words in such spans), ``hit_items`` (their ids as text, sorted),
    ``hit_spans`` (word ranges) and ``clean_text`` (the text with the spans cut out,
    the text itself if there are none).

    Documents are not shuffled. The items are the query set: tasks cut them into runs
    (a long item into several, which overlap by ``length - 1`` words) and deal those
    into blocks of at most ``block_words`` words (or four times ``length``, if that is
    more); one task builds the automaton of one block. The driver passes on one
    automaton at a time, and a pass over the documents is written before the next one
    begins. So neither the driver nor a task ever holds more than one block, however
    many items there are.

    Null text has no words and null ``clean_text``; an item with null or wordless text
    never matches; an item with null id is cut out but not named; equal ids count
    once; no items or no documents give no hits. Input columns named like results are replaced.
    """
    if text.lower() in RESULTS:
        raise ValueError(f"the text column may not be called {text}, a result is")
    rows, spark = without(docs, RESULTS), docs.sparkSession
    rows = rows.select(
        "*", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
        F.array().cast("array<string>").alias("hit_items"),
        F.array().cast("array<struct<start:int,stop:int>>").alias("hit_spans"))
    chosen = items.select(name_in(items, item_id).cast("string").alias("name"), name_in(items, item_text).cast("string").alias("text"))
    automata, blocks = _automata(chosen, length, coverage, block_words)
    cut = _cutter(text)
    for k in range(blocks - 1):
        shared = _fetched(automata, k)
        rows = saved(rows.mapInArrow(_scanner(shared, text), rows.schema), "decontaminated")
        shared.destroy()
    scan = _scanner(_fetched(automata, blocks - 1) if blocks else send(spark, SuffixAutomaton([], length, coverage)), text)
    # The last pass cuts as well, so a task with one block of items has one worker.
    return rows.mapInArrow(lambda batches: cut(scan(batches)), T.StructType([*rows.schema.fields, T.StructField("clean_text", T.StringType())]))


def _automata(items: DataFrame, length: int, coverage: float, most: int) -> tuple[DataFrame, int]:
    """``block, automaton``, each built in a task, and the number of blocks.

    A run has at most half a block's words and goes to the block in which it begins, counted
    over the runs in order, so no block has more than its words and none is empty.
    """
    half = max(most // 2, 2 * length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            found = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
                ws = words(text.as_py())
                need = _need(len(ws), length, coverage)
                for start in range(0, max(1, len(ws) - length + 1) if len(ws) > half else min(1, len(ws)), half - length + 1):
                    run = ws[start : start + half]
                    found.append({"part": part, "before": before, "n_words": len(run), "name": name, "need": need, "words": b" ".join(run)})
                    before += len(run)
            yield pa.RecordBatch.from_pylist(found, schema=_RUN_SCHEMA)

    runs = saved(items.mapInArrow(cut, _RUNS), "items")
    offsets, total = [], 0
    for part, n in runs.groupBy("part").agg(F.sum("n_words")).orderBy("part").collect():  # one row a task
        offsets.append((part, total))
        total += n
    if not offsets:
        return runs, 0
    dealt = runs.join(F.broadcast(items.sparkSession.createDataFrame(offsets, "part int, first long")), "part").select(
        F.floor((F.col("first") + F.col("before")) / half).cast("int").alias("block"), "name", "need", "words")

    def build(key: tuple, some: pd.DataFrame) -> pd.DataFrame:
        named = [(None if pd.isna(name) else name, bytes(ws).split()) for name, ws in zip(some["name"], some["words"], strict=True)]
        automaton = SuffixAutomaton(named, length, coverage, some["need"].tolist())
        return pd.DataFrame({"block": [key[0]], "automaton": [cloudpickle.dumps(automaton)]})

    built = saved(dealt.groupBy("block").applyInPandas(build, "block int, automaton binary"), "automata")
    return built, built.agg(F.max("block")).first()[0] + 1


def _fetched(automata: DataFrame, block: int) -> Broadcast:
    """One automaton, sent to the executors as ``receive`` reads it."""
    found = automata.where(F.col("block") == block).select("automaton").first()
    return automata.sparkSession.sparkContext.broadcast(bytes(found["automaton"]))


def _scanner(shared, text: str):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = receive(shared)
        for batch in batches:
            n_words, n_hit, items, spans = [], [], [], []
            texts = batch.column(text).cast(pa.binary())
            for i in range(len(batch)):
                ws = words(texts[i].as_py())
                ranges, found = automaton.scan(ws)
                n_words.append(len(ws))
                if found or ranges:
                    old = [(x["start"], x["stop"]) for x in batch.column("hit_spans")[i].as_py()]
                    merged: list[tuple[int, int]] = []
                    for a, b in sorted(old + ranges, key=lambda x: (x[1], x[0])):
                        _add(merged, a, b)
                    ranges, found = merged, found.union(batch.column("hit_items")[i].as_py())
                else:
                    ranges = [(x["start"], x["stop"]) for x in batch.column("hit_spans")[i].as_py()]
                    found = batch.column("hit_items")[i].as_py()
                n_hit.append(sum(b - a for a, b in ranges))
                items.append(sorted(found))
                spans.append([{"start": a, "stop": b} for a, b in ranges])
            new = {"n_words": n_words, "n_hit": n_hit, "hit_items": items, "hit_spans": spans}
            yield _with(batch, new)

    return scan


def _with(batch: pa.RecordBatch, new: dict[str, list]) -> pa.RecordBatch:
    columns = [
        pa.array(new[f.name], f.type) if f.name in new else batch.column(i) for i, f in enumerate(batch.schema)
    ]
    return pa.RecordBatch.from_arrays(columns, schema=batch.schema)


def _cutter(text: str):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            source, hits = batch.column(text), batch.column("n_hit").to_pylist()
            if any(hits):
                cleaned = [
                    _cut(source[i].as_py(), batch.column("hit_spans")[i].as_py()) if hits[i] else source[i].as_py()
                    for i in range(len(batch))
                ]
                clean = pa.array(cleaned, pa.string())
            else:
                clean = source.cast(pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, clean], names=[*batch.schema.names, "clean_text"])

    return cut


def _cut(text: str, spans: list[dict]) -> str:
    raw = text.encode()
    places = [m.span() for m in _WORD.finditer(raw)]
    kept, at = [], 0
    for x in spans:
        kept.append(raw[at : places[x["start"]][0]])
        at = places[x["stop"] - 1][1]
    return b"".join([*kept, raw[at:]]).decode()
