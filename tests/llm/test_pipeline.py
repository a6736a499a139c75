"""The pipeline, stage by stage, and every query registered."""

import random

import duckdb
import pytest
from conftest import SF
from pyspark.sql import functions as F

import corpus_pipeline
from tablecontract.llm.queries import ORACLES, QUERIES, table


def test_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {*QUERIES, "pipeline"} <= set(names) and len({n.split("_")[0] for n in QUERIES}) == 13
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "language_id", "near_duplicates", "decontamination", "packing"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_and_its_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "benchmark", "conversations"):
        duck.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = sorted(repr([r[columns.index(c)] for c in df.columns]) for r in result.fetchall())
    assert sorted(repr(list(r)) for r in df.collect()) == want


def test_stages(spark):
    docs = table(spark, SF, "documents")
    clean = spark.createDataFrame([(10_000, "A long and clean sentence stands here, which nobody else has written down before. It has enough words for all rules.", "en", "x", 118)], docs.schema)
    odd = spark.createDataFrame([(10_001, None, None, None, None), (None, "", "en", "x", 0)], docs.schema)
    now = docs.unionByName(clean).unionByName(odd).withColumn("quality", F.lit(1)).withColumn("n_hit", F.lit("y"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in now.select("doc_id").collect()}
        now = stage(spark, now, SF).cache()
        assert now.columns == [*docs.columns, "quality", "n_hit"], name
        after = {r.doc_id for r in now.select("doc_id").collect()}
        assert 10_000 in after <= before and 10_001 not in after
    bench = table(spark, SF, "benchmark")
    from tablecontract.llm.decontaminate import decontaminate

    left = decontaminate(now.select("doc_id", "text"), bench).where("n_hit > 0")
    assert left.isEmpty()
    packed = corpus_pipeline.packed(spark, now, SF)
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in now.select("doc_id").collect()}


def test_empty_documents(spark):
    docs = table(spark, SF, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
    assert corpus_pipeline.packed(spark, docs, SF).count() == 0


def test_texts_in_no_learned_language_go(spark):
    docs, rnd = table(spark, SF, "documents"), random.Random(5)
    scripts = {"latin": "abcdefghijklmnopqrstuvwxyz", "cyrillic": "абвгдежзийклмнопрстуфхцчшщъыьэюя", "greek": "αβγδεζηθικλμνξοπρστυφχψω",
               "hangul": "".join(map(chr, range(0xAC00, 0xAC00 + 400)))}
    made = [" ".join("".join(rnd.choice(s) for _ in range(rnd.randint(2, 9))) for _ in range(n)) for s in scripts.values() for n in (30, 300) for _ in range(25)]
    made.append("Wszystkie dzieci poszły wczoraj do lasu, żeby zbierać grzyby i jagody, a potem wróciły do domu przed zmrokiem.")
    odd = spark.createDataFrame([(20_000 + i, t, "en" if i % 8 == 0 else None, "x", len(t)) for i, t in enumerate(made)], docs.schema)
    left = corpus_pipeline.language_id(spark, docs.unionByName(odd), SF)
    assert left.where("doc_id >= 20000").count() <= len(made) // 100
    clean = docs.where("lang = 'en' and n_chars > 200 and doc_id is not null").select(F.col("doc_id"), F.expr("concat_ws(' ', slice(split(text, ' '), 3, 4))").alias("text"))
    short = spark.createDataFrame([(30_000 + i, r.text, "en", "x", len(r.text)) for i, r in enumerate(clean.where("text rlike '[a-z]'").collect())], docs.schema)
    left = corpus_pipeline.language_id(spark, docs.unionByName(short), SF)
    assert left.where("doc_id >= 30000").count() >= 0.97 * short.count() > 20
    letters = docs.where("text rlike '[a-zA-Z]{3}'")
    assert left.where("doc_id < 20000").count() >= 0.99 * letters.where("doc_id is not null").count()


def test_documents_stay_where_no_language_can_be_learned(spark):
    docs = table(spark, SF, "documents")
    rows = [(1, "a clean text", None, "x", 12), (None, "жизнь", "ru", "x", 5), (3, "漢字", None, "x", 2), (4, "12 %", None, "x", 4), (5, None, None, "x", 0), (6, "12 %", "en", "x", 4)]
    left = corpus_pipeline.language_id(spark, spark.createDataFrame(rows, docs.schema), SF)
    assert left.columns == docs.columns and sorted(r.text for r in left.collect()) == ["a clean text", "жизнь", "漢字"]
