"""From raw documents to packed training sequences, one written table per stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewatch.llm import cdc, minhash, packing, quality, rules
from tidewatch.llm.common import ready, stored, table
from tidewatch.llm.queries import vocabulary


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts."""
    ready(spark)
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    rows = quality.scored(docs.select(F.struct(*docs.columns).alias("_doc")), model, text="_doc.text", into="_score")
    return rows.where(F.col("_score") >= quality.THRESHOLD).select("_doc.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base limits and the learned rules.

    The rules are learned from the labelled raw documents: few bad ones are left among ``docs``.
    """
    ready(spark)
    learned = rules.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    rows = docs.select(F.struct(*docs.columns).alias("_doc"), "text")
    return rules.judge(rows, learned, keep=("_doc",)).where("kept").select("_doc.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    ready(spark)
    return minhash.one_of_each(docs)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one has; those left without a word go."""
    ready(spark)
    rows = cdc.remove_passages(docs).select(*docs.columns)
    return rows.where(F.col("text").rlike(rules.WORD)).withColumn("n_chars", F.length("text").cast("long"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, placed in sequences."""
    return packing.pack(docs, vocabulary(packing.VOCABULARY))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("repeated passages", repeated_passages),
    ("packing", packed),
]

# Learned scores, hashed signatures and token ids have no SQL twin; the tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table."""
    docs = table(ready(spark), sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
