"""The corpus pipeline: language, toxicity, near-duplicates, decontamination, tokens.

Each stage takes ``(spark, docs, sf_dir)``; all but the last return the columns of ``docs``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlog.llm import langid, minhash, suffixes, toxicity
from ledgerlog.llm.queries import SHINGLE_WORDS, encoded, language_model, toxicity_model
from ledgerlog.llm.shared import scratch, shipped, table, written


def without(docs: DataFrame, found: DataFrame, name: str) -> DataFrame:
    """The documents whose ids are not in ``found``; rows without an id stay.

    The ids are written first: where their measured size allows it Spark broadcasts them and no
    text moves, beyond that it joins by a shuffle.
    """
    spark = docs.sparkSession
    gone = written(found.select("doc_id").distinct(), scratch(spark, name))
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def passing(docs: DataFrame, judge: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The rows ``judge`` lets through, with the columns of ``docs``.

    It sees all columns under names that no result has, and the name of the text.
    """
    hidden = docs.toDF(*(f"kept_{i}" for i in range(len(docs.columns))))
    text = hidden.columns[docs.columns.index("text")]
    return judge(hidden, text).select(hidden.columns).toDF(*docs.columns)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language stay; those without letters go."""
    shipped(spark)
    model = language_model(docs)
    return passing(docs, lambda rows, text: langid.identify(rows, model, text, tuple(rows.columns))
                   .where(F.col("lang_pred") != langid.UNDETERMINED))


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted toxic go."""
    shipped(spark)
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return passing(docs, lambda rows, text: toxicity.score(rows, model, text, tuple(rows.columns)).where("predicted = 0"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id stays."""
    shipped(spark)
    found = minhash.near_duplicates(docs, words=SHINGLE_WORDS)
    return without(docs, found.where("NOT kept"), "near_duplicates_gone")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that overlap the benchmark go."""
    shipped(spark)
    found = suffixes.overlaps(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, found.where("contaminated"), "decontamination_gone")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of each document that is left."""
    shipped(spark)
    return encoded(docs)


STAGES = [
    ("language_id", language),
    ("toxicity", toxic),
    ("minhash_near_dedup", near_duplicates),
    ("decontamination", decontamination),
    ("byte_bpe", tokens),
]
#: The learned classifiers and the token ids have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch(spark, "pipeline")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"{folder}/{name}")
    return docs
