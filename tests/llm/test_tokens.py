"""Coded ids against the ids themselves, and files read back against the tokenizer."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from conftest import SF
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tablecontract.llm import rans, tokens
from tablecontract.llm.rans import CorruptSegment, Segment, crc_joined, encode, shared_table

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 6000), st.sampled_from([1, 2, 300, 50_000, 2**32 - 1]), st.integers(0, 2**32))
def test_round_trip(n, most, seed):
    r = np.random.default_rng(seed)
    ids = np.minimum(r.zipf(1.4, n), most).astype("<u4")
    segment = Segment(encode(ids))
    assert (segment.ids() == ids).all()
    start, count = int(r.integers(0, n)), int(r.integers(0, n + 5))
    assert (segment.some(start, count) == ids[start : start + count]).all()


def test_blocks_and_checkpoints_decode_on_their_own():
    ids = (np.random.default_rng(2).zipf(1.2, rans.SEGMENT) % 50_257).astype("<u4")
    data = encode(ids)
    segment = Segment(data)
    assert len(segment.blocks) == rans.BLOCKS and segment.steps > 2 * rans.EVERY
    per = segment.steps * rans.LANES
    assert (segment.decode([3])[0] == ids[3 * per : 4 * per]).all()
    late = segment.decode([5], mark=2, marks=1)[0]
    begin = 5 * per + 2 * rans.EVERY * rans.LANES
    assert (late == ids[begin : begin + rans.EVERY * rans.LANES]).all()
    share = np.bincount(ids) / len(ids)
    bits = -(share[share > 0] * np.log2(share[share > 0])).sum() * len(ids)
    assert len(data) * 8 < 1.07 * bits


def test_frequencies_fill_the_table():
    for ids in (np.zeros(5, np.uint32), np.arange(70_000, dtype=np.uint32), np.repeat(np.uint32([1, 9]), [10**6, 1])):
        symbols, freq, bits = shared_table(ids)
        assert freq.sum() == 1 << bits and freq.min() >= 1 and len(symbols) == len(set(ids.tolist()))


@pytest.mark.parametrize("place", [0, 20, 60, 4000, -1])
def test_changed_bytes_are_found(place):
    data = bytearray(encode((np.random.default_rng(3).integers(0, 900, 5000)).astype("<u4")))
    data[place] ^= 4
    with pytest.raises(CorruptSegment):
        Segment(bytes(data)).ids()
    with pytest.raises(CorruptSegment):
        Segment(bytes(data[:-3])).ids()


@given(st.binary(max_size=300), st.binary(max_size=300))
def test_joined_checksums(a, b):
    assert crc_joined(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def expected(rows):
    start, out = 0, []
    for name, text in rows:
        ids = np.array([*WHOLE.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((name, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def read(spark, path):
    return sorted((tuple(r) for r in tokens.documents(spark, path).collect()), key=lambda r: r[1])


@pytest.mark.parametrize("segment", [rans.SEGMENT, 50])
def test_documents_are_read_back(spark, place, monkeypatch, segment):
    monkeypatch.setattr(tokens, "SEGMENT", segment)
    long = "# one ## two, über <|endoftext|> " * 40
    rows = [(None, "no id"), (-5, ""), (1, None), (2, long), (3, "x"), (7, "tie"), (7, "tie"), (7, "tie"), (9, long * 3), (2**60, "end")]
    frame = spark.createDataFrame([(n, t, "x", 0) for n, t in rows[::-1]], "doc_id long, text string, PART string, start int").repartition(3, "text")
    tokens.write(frame, PATH, place, file_bytes=2000)
    got, want = read(spark, place), expected(rows)
    assert got == want
    stored = spark.read.parquet(place)
    assert stored.select("part").distinct().count() > 1 and (segment > 50 or stored.where("cut = 3").count() > 1)


def test_many_equal_ids_lie_in_many_files(spark, place):
    frame = spark.range(3000).selectExpr("cast(null as long) as doc_id", "concat('text ', id % 7) as text")
    tokens.write(frame, PATH, place, file_bytes=50_000)
    per = [r[0] for r in spark.read.parquet(place).groupBy("part").agg({"*": "count"}).collect()]
    assert len(per) >= 4 and tokens.documents(spark, place).count() == 3000


def test_no_documents_and_given_ones(spark, place):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    tokens.write(docs.limit(0), PATH, f"{place}/none")
    assert read(spark, f"{place}/none") == []
    tokens.write(docs, PATH, f"{place}/all", file_bytes=100_000)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    assert read(spark, f"{place}/all") == expected(rows)
    whole = tokens.pieces(spark, f"{place}/all", ids=True).where("doc_id = 3").first()
    assert np.frombuffer(whole.ids, "<u4").tolist() == [*WHOLE.encode(dict(rows)[3], add_special_tokens=False).ids, 2]
