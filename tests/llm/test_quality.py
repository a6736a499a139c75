"""Measures against plain Python, expectation-maximisation against its formulas, and labels."""

import math
import random
import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from tablecontract.llm.quality import BASE, RULES, estimate, judge, measure, votes


def plain(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if x.strip("\x20\x09\x0a\x0b\x0c\x0d")]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(repeated)


def texts():
    r = random.Random(2)
    made = ["".join(r.choice(["a", "b", "c", " ", " ", "\n", "\t", "#", ".", "é"]) for _ in range(r.randint(0, 150))) for _ in range(80)]
    return [*made, None, "", " \n ", "x", "a b c d e", "a b c d e a b c d e", "a " * 40, "a b c d e f\n" * 3, "\u00a0 \u2003x", "漢字 " * 6]


def test_measures(spark):
    rows = list(enumerate(texts()))
    frame = spark.createDataFrame([(i, t, 9) for i, t in rows] + [(0, rows[0][1], 9)], "doc_id long, text string, N_WORDS int")
    out = measure(frame, carry=["doc_id"]).collect()
    assert len(out) == len(rows) + 1
    for r in out:
        assert tuple(r[c] for c in BASE) == plain(rows[r.doc_id][1]), rows[r.doc_id]


def test_long_texts(spark):
    long = " ".join(f"w{i}" for i in range(200_000))
    frame = spark.createDataFrame([(1, long), (2, "one two three " * 60_000)], "doc_id long, text string")
    one, two = sorted(measure(frame, carry=["doc_id"]).collect())
    assert (one.n_words, one.n_repeat_words) == (200_000, 0) and (two.n_words, two.n_repeat_words) == (180_000, 180_000)


def test_expectation_maximisation(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    measured = measure(docs, carry=["doc_id"])
    rows = [tuple(r) for r in measured.select(*votes(measured)).collect()]
    model = estimate(measured, rounds=3)
    believed = (0.005, 0.195, 0.8), (0.4, 0.3, 0.3)
    prior, tables = 0.8, [[list(b) for _ in RULES] for b in believed]
    for _ in range(3):
        p = []
        for r in rows:
            odds = math.log(prior / (1 - prior)) + sum(math.log(tables[0][j][v + 1] / tables[1][j][v + 1]) for j, v in enumerate(r))
            p.append(1 / (1 + math.exp(-odds)))
        weight = len(rows) / 50
        new = []
        for k, q in enumerate((p, [1 - x for x in p])):
            new.append([[(sum(x for x, r in zip(q, rows, strict=True) if r[j] == v) + weight * believed[k][v + 1]) / (sum(q) + weight) for v in (-1, 0, 1)] for j in range(len(RULES))])
        prior, tables = (sum(p) + 0.8 * weight) / (len(rows) + weight), new
    assert model.prior == pytest.approx(prior)
    for got, want in zip((model.good, model.bad), tables, strict=True):
        assert [x for t in got for x in t] == pytest.approx([x for t in want for x in t])


def test_verdicts_follow_labels(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = judge(docs)
    assert set(out.columns) == {*docs.columns, *BASE, "base_failed", "quality", "kept"} and out.count() == docs.count()
    assert out.where("base_failed and kept").isEmpty()
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    seen = out.where("not base_failed").drop("quality").join(labels, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {r.quality: r.kept for r in seen.collect()}
    assert kept[1] > 0.97 and kept.get(0, 0) < 0.2


def test_odd_tables(spark):
    frame = spark.createDataFrame([(1, None, 3), (1, None, 3), (None, "", 3)], "doc_id long, text string, KEPT int")
    assert [r.kept for r in judge(frame).collect()] == [False] * 3
    assert judge(frame.limit(0)).count() == 0
