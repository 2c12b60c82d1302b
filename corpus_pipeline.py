"""The corpus pipeline: documents that pass every stage, tokenised at the end.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet below the shared checkpoint folder and reads it again as
the next stage's ``docs``, so a lost executor never sends the work back before
the last finished stage. All stages but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import bpe, decontaminate, language_id, ngram_jaccard, quality_rules
from strata.llm.common import read_table
from strata.llm.queries import TOKENIZER
from strata.session import scratch_dir


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no known language, or of none in the main, go; languages, and how texts fit them, are learned from ``docs``."""
    return language_id.keep(docs, language_id.with_limits(docs, language_id.train(docs)))


def apply_quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality_rules.keep(docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of copies and near copies the document with the smallest id stays."""
    return ngram_jaccard.keep_one(docs)


def remove_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated with benchmark windows go."""
    return decontaminate.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document left."""
    return bpe.encode(docs, TOKENIZER)


STAGES = [
    ("language_id", identify_language),
    ("quality_rules", apply_quality_rules),
    ("ngram_jaccard", keep_one_of_each_group),
    ("decontaminate", remove_contaminated),
    ("bpe", tokenise),
]

# Language ID is a trained model, which SQL can't state; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    root = scratch_dir(spark, "corpus-pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{root}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
