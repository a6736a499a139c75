"""Ids against the tokenizer itself, and sequences that hold together."""

import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tablecontract.llm.packing import Encoder, pack, sum_of_squares

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE, ENCODE = Tokenizer.from_file(PATH), Encoder(PATH)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é\n\t.'s1<|endoftext>　 漢", max_size=40))
def test_ids_are_those_of_the_tokenizer(text):
    text += random.Random(len(text)).choice(["", "<|endoftext|>", " <|endoftext|> x"])
    assert np.frombuffer(ENCODE(text), "<u4").tolist() == WHOLE.encode(text, add_special_tokens=False).ids


def test_pieces_and_sequences(spark):
    r = random.Random(3)
    texts = [" ".join(r.choice(["tree", "über", "a", "running"]) for _ in range(r.choice([1, 5, 300, 2500, 6000]))) for _ in range(60)]
    rows = list(enumerate(texts)) + [(100, None), (101, ""), (None, "no id"), (5, texts[5])]
    out = pack(spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, piece int"), PATH, shard_pieces=40).collect()
    for i, t in enumerate(texts):
        ids = np.array(WHOLE.encode(t, add_special_tokens=False).ids + [0], "<u4")
        got = sorted((x for x in out if x.doc_id == i), key=lambda x: x.piece)[:: 2 if i == 5 else 1]
        assert sum(x.length for x in got) == len(ids) and all(x.length == 2048 for x in got[1:])
        at = 0
        for k, x in enumerate(got):
            assert (x.piece, x.start) == (k, at) and x.ids_crc32 == zlib.crc32(ids[at : at + x.length].tobytes())
            at += x.length
    assert [x.length for x in out if x.doc_id in (100, 101)] == [1, 1]
    sequences = {}
    for x in out:
        sequences.setdefault(x.sequence_id, []).append((x.offset, x.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048


def test_no_documents(spark):
    assert pack(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


def test_each_choice_is_the_one_of_least_squares():
    lengths, capacity = np.random.default_rng(5).integers(1, 21, 400), 20
    bins, offsets, used = sum_of_squares(lengths, capacity)
    gaps, count = {}, np.zeros(capacity + 1, int)
    for i in np.argsort(-lengths, kind="stable"):
        size = lengths[i]

        def squares(gap):
            after = count.copy()
            after[gap] -= 1
            after[gap - size] += gap > size
            return int((after**2)[1:].sum())

        if room := [g for g in range(size, capacity + 1) if count[g]]:
            gap = min(room, key=lambda g: (squares(g), g))
            assert gaps[bins[i]] == gap and offsets[i] == capacity - gap
            count[gap] -= 1
        else:
            gap = capacity
            assert bins[i] not in gaps and offsets[i] == 0
        gaps[bins[i]] = gap - size
        count[gap - size] += gap > size
    assert used == len(gaps) and used <= 1.05 * lengths.sum() / capacity


def test_equal_rows_are_dealt_over_shards(spark):
    rows = spark.createDataFrame([(None, "the same text")] * 400, "doc_id long, text string").repartition(4)
    out = pack(rows, PATH, shard_pieces=50).collect()
    shards = [r.sequence_id >> 32 for r in out]
    assert len(out) == 400 and max(shards.count(s) for s in set(shards)) < 120
    assert len({(r.sequence_id, r.offset) for r in out}) == 400
