"""Documents to packed training sequences, in stages that are each written and read again.

Language identification and toxicity drop documents, line de-duplication rewrites texts, SimHash keeps one document of
each near-duplicate group, packing turns what is left into sequences.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourline.llm import language, packing, simhash, site_lines, toxicity
from hourline.llm.common import table, unused
from hourline.session import stage

#: None: models, fingerprints and packing have no SQL form; tests compare the stages with brute force.
ORACLE_SQL = None


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters whose language is certain; learned from the labelled documents of the table."""
    model = language.train(language.training_rows(table(spark, sf_dir, "documents")))
    return language.keep_identified(docs, model)


def by_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below 0.5; learned from the labels and the texts of the table."""
    labels = toxicity.training_labels(table(spark, sf_dir, "labels"))
    model = toxicity.train(table(spark, sf_dir, "documents").select("doc_id", "text"), labels)
    return toxicity.keep_clean(docs, model)


def without_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the boilerplate lines of its source; n_chars follows where the text has changed."""
    given = unused(docs, "_given")
    clean = site_lines.drop_boilerplate(docs.withColumn(given, F.length("text")))
    changed = F.length("text") != F.col(given)
    return clean.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near-duplicates."""
    return simhash.keep_one(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 1024 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)


STAGES = [
    ("language", by_language),
    ("toxicity", by_toxicity),
    ("line_dedup", without_boilerplate),
    ("simhash", one_of_each_group),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
