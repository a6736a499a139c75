"""Best-fit packing of token sequences by the sum-of-squares rule."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import name_in, saved

#: Pieces that one task packs at once, about; what bounds its memory.
SHARD_PIECES = 4_000

PIECES = "doc_id {id}, piece int, start long, length long, ids_crc32 long"


class Encoder:
    """Token ids of whole texts, by a byte-level BPE file of ``tokenizers``, as little-endian unsigned 32-bit bytes.

    The merges are done by ``tiktoken`` with the file's own vocabulary, whose ids are
    the ranks of its merges: the ids are the same, at a sixth of the time. Texts
    that hold a special token's string go to ``tokenizers`` itself.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        self._whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            config = json.load(file)
        before = config["pre_tokenizer"]
        if config["model"]["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or config["normalizer"]:
            raise ValueError(f"{path} is no byte-level BPE without normalizer and prefix space")
        self._special = [t["content"] for t in config["added_tokens"]]
        ranks = {_spelled(t): i for t, i in config["model"]["vocab"].items() if t not in self._special}
        self._merge = tiktoken.Encoding("file", pat_str=_WORDS, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def __call__(self, text: str) -> bytes:
        if any(t in text for t in self._special):
            return np.array(self._whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(self._merge(text), "<u4").tobytes()


#: How a byte-level BPE of this kind splits a text; a fixed value of the format.
_WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _spelled(token: str) -> bytes:
    """The bytes of a token of the vocabulary, which writes bytes that are no printable Latin-1 as characters from 256 on."""
    return bytes(_BYTES[c] for c in token)


_PLAIN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
_BYTES = {chr(b): b for b in _PLAIN} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}


def pieces(docs: DataFrame, tokenizer: str, *, id: str = "doc_id", text: str = "text", capacity: int = 2048, end: int = 0) -> DataFrame:
    """One row per piece of a document: its ids and then ``end``, cut into pieces of ``capacity`` from the back.

    Only the first piece of a longer document may be shorter. Null text counts as empty.
    """
    rows = docs.select(name_in(docs, id).alias("doc_id"), name_in(docs, text).cast("string").alias("text"))
    last = np.array([end], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer)
        for batch in batches:
            row, number, start, length, crc = [], [], [], [], []
            for i, text in enumerate(batch.column("text")):
                ids = encode(text.as_py() or "") + last
                n = len(ids) // 4
                a, b, k = 0, (n - 1) % capacity + 1, 0
                while a < n:
                    row.append(i), number.append(k), start.append(a), length.append(b - a)
                    crc.append(zlib.crc32(ids[4 * a : 4 * b]))
                    a, b, k = b, b + capacity, k + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(row, pa.int64())), pa.array(number, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return rows.mapInArrow(cut, PIECES.format(id=rows.schema["doc_id"].dataType.simpleString()))


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Bin and offset of each item, and the number of bins.

    Items are placed one by one, the longest first. With N(g) open bins of residual
    gap g, an item goes where the sum of N(g)**2 becomes smallest: into an open bin,
    or into a new one where no bin has room. Of equal choices it takes the smallest
    gap. Opening no bin while one has room is what keeps the number of bins low once
    the long items are placed.
    """
    order = np.argsort(-lengths, kind="stable")
    bins, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    count = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    used = 0
    for i in order.tolist():
        size = int(lengths[i])
        # N(g) falls by one and N(g - size) rises by one; a full bin is no open bin.
        change = 2 * (1 - count[size:])
        change[1:] += 2 * count[1 : capacity + 1 - size]
        change[0] -= 1
        change[count[size:] == 0] = np.iinfo(np.int64).max
        gap = size + int(np.argmin(change)) if count[size:].any() else capacity
        if gap < capacity:
            place = open_bins[gap].pop()
            count[gap] -= 1
        else:
            place, used = used, used + 1
        bins[i], offsets[i] = place, capacity - gap
        if gap > size:
            open_bins[gap - size].append(place)
            count[gap - size] += 1
    return bins, offsets, used


def pack(docs: DataFrame, tokenizer: str, *, id: str = "doc_id", text: str = "text", capacity: int = 2048, end: int = 0, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """All documents in as few sequences of at most ``capacity`` tokens as the rule finds.

    Returns a row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``. Pieces are dealt by a hash of their content and place into shards of about
    ``shard_pieces``, with a number of their own that is written once, so that equal
    rows are dealt like others, and each shard is packed on its own: whatever the size of the
    corpus, a task holds one shard, no key is hot, and what a shard leaves open at
    its end is a bin or two. Only lengths and checksums are shuffled.

    Null text is the lone ``end``; null ids and repeated rows are packed like others;
    no documents give no rows; extra columns are not carried.
    """
    size = docs.agg(F.count(F.lit(1)), F.sum(F.octet_length(name_in(docs, text)))).first()
    shards = max(1, -(-(size[0] + (size[1] or 0) // (2 * capacity)) // shard_pieces))
    cut = pieces(docs, tokenizer, id=id, text=text, capacity=capacity, end=end)
    cut = saved(cut.withColumn("shard", F.monotonically_increasing_id()), "pieces")
    cut = cut.withColumn("shard", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", "shard"), F.lit(shards)))
    schema = cut.drop("shard").schema.add("sequence_id", "long").add("offset", "long")

    def place(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "ids_crc32", "piece", "start"], kind="stable")
        bins, offsets, _ = sum_of_squares(rows["length"].to_numpy(np.int64), capacity)
        return rows.drop(columns="shard").assign(sequence_id=bins + (int(key[0]) << 32), offset=offsets)

    return cut.groupBy("shard").applyInPandas(place, schema)
