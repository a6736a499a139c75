"""Trigrams against a plain count, prototypes against one bundle, held-out accuracy."""

import re

import numpy as np
import pytest
from conftest import SF
from pyspark.sql import functions as F

from tablecontract.llm import language
from tablecontract.llm.language import Space, held_out, letter_table, predict, train, trigrams

LETTERS = letter_table()


def plain(text):
    run = " " + " ".join(re.findall(r"[^\W\d_]+", text or "")) + " "
    out = {}
    for i in range(len(run) - 2):
        if run[i + 1] != " ":
            key = tuple(0 if c == " " else ord(c.lower()) for c in run[i : i + 3])
            out[key] = out.get(key, 0) + 1
    return out


@pytest.mark.parametrize("text", ["", None, "12 !", "a", "Straße über 7 Bäume", "жизнь and 漢字", "x y z " * 50, "ab"])
@pytest.mark.parametrize("chunk", [1 << 20, 3])
def test_trigrams(monkeypatch, text, chunk):
    monkeypatch.setattr(language, "_CHARS", chunk)
    codes, counts = trigrams(text, LETTERS)
    got = {(int(c) >> 42, int(c) >> 21 & 0x1FFFFF, int(c) & 0x1FFFFF): int(n) for c, n in zip(codes, counts, strict=True)}
    assert got == plain(text)


def test_prototypes_add_up_over_tasks(spark):
    texts = ["one two three", "über alle Berge", "two more words", "und noch mehr"] * 5
    rows = [(i, t, "en" if i % 2 == 0 else "de") for i, t in enumerate(texts)] + [(90, None, "en"), (91, "x y", None), (92, "1 2", "none")]
    made = train(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7))
    assert list(made) == ["de", "en"]
    for name, vector in made.items():
        space, want = Space(language.DIMENSIONS, 7), 0
        for _, t, x in rows:
            want = want + space.bundle(*trigrams(t, LETTERS)) if x == name else want
        assert np.array_equal(vector, want)


def test_odd_texts(spark):
    model = train(spark.createDataFrame([(1, "this and that", "en"), (2, "dies und das", "de")], "doc_id long, text string, lang string"))
    rows = [(1, None), (2, ""), (3, "12 %"), (4, "that"), (5, "und " * 400_000), (4, "that"), (None, "das")]
    frame = spark.createDataFrame([(i, t, 1.5) for i, t in rows], "doc_id long, text string, SCORE double")
    out = predict(frame, model).collect()
    assert [r.lang_pred for r in out] == ["und", "und", "und", "en", "de", "en", "de"] and all(0 <= r.score <= 1 for r in out)
    assert {r.lang_pred for r in predict(frame, {}).collect()} == {"und"} and predict(frame.limit(0), model).count() == 0
    assert train(frame.limit(0).withColumn("lang", F.lit("x"))) == {}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    found = predict(docs, train(docs.where(~held_out(docs))))
    right, n = found.where(held_out(found)).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 20 and right > 0.95


@pytest.mark.parametrize("chunk", [1 << 20, 3])
def test_beginning(monkeypatch, chunk):
    monkeypatch.setattr(language, "_CHARS", chunk)
    text = "Straße, über 7 Bäume.  a b"
    whole = language.beginning(text, LETTERS, 1000)
    codes, counts = np.unique(whole, return_counts=True)
    want = trigrams(text, LETTERS)
    assert np.array_equal(codes, want[0]) and np.array_equal(counts, want[1])
    assert np.array_equal(language.beginning(text, LETTERS, 5), whole[:5]) and len(language.beginning(None, LETTERS, 5)) == 0


def test_least_cosines_follow_length_and_stay_above_chance(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = train(docs)
    least = language.calibrate(docs, model)
    assert list(least) == list(language.LENGTHS) and least[8] == language.CHANCE / language.DIMENSIONS**0.5
    assert 0 < least[3] < least[8] and language.calibrate(docs, {}) == {}
