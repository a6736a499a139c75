"""Documents to packed training sequences: five stages, each written and read again before the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablecontract.llm import decontaminate, language, neardup, packing, quality
from tablecontract.llm.common import saved
from tablecontract.llm.queries import table, tokenizer

#: Of a document's words, the share in test items from which it goes as a whole.
MOST_HIT = 0.5


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weighed rules keep."""
    return quality.judge(docs).where("kept").select(*docs.columns)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages of the corpus: as near to a prototype as ``language.calibrate`` finds for their length.

    Where no row has both a language to learn and a text with letters, there is nothing to compare with: every document with a letter stays.
    """
    learned = docs.where(~language.held_out(docs) & F.col("lang").isNotNull())
    prototypes = language.train(learned)
    if not prototypes:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = language.predict(docs, prototypes, least=language.calibrate(learned, prototypes))
    return found.where(F.col("lang_pred") != language.UNKNOWN).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group."""
    return neardup.deduplicated(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of test items; a text that is mostly such passages goes."""
    found = decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    left = found.where(F.col("n_hit") <= MOST_HIT * F.col("n_words"))
    changed = {"text": F.col("clean_text"), "n_chars": F.when(F.col("n_hit") > 0, F.char_length("clean_text").cast("long")).otherwise(F.col("n_chars"))}
    return left.withColumns(changed).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All that is left, as training sequences."""
    return packing.pack(docs, tokenizer())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packed),
]
#: SQL cannot express the learned stages; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
