"""The text operators as ``(spark, sf_dir) -> DataFrame`` queries over their whole tables."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from strata.llm import (bpe, decontaminate, language_id, licenses, ngram_jaccard, periodic_runs, quality_rda, quality_rules,
                        sharding, spelling, token_file, url_rules, warc_revisit)
from strata.llm.common import read_table
from strata.session import scratch_dir

# Tokenizer files are never part of this repository; the path is a parameter.
TOKENIZER = os.environ.get("STRATA_TOKENIZER") or public_tokenizers.path("byte_bpe_50k.json")


def op1_warc_revisit(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc_revisit.captures_of(read_table(spark, sf_dir, "pages"))
    return warc_revisit.digest(warc_revisit.resolve(captures))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode(read_table(spark, sf_dir, "documents"), TOKENIZER)


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard.components(read_table(spark, sf_dir, "documents"))


def op4_quality_rda(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rda.classify(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(read_table(spark, sf_dir, "pages"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(read_table(spark, sf_dir, "documents"))


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.judge(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(read_table(spark, sf_dir, "documents"))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(read_table(spark, sf_dir, "documents"))


def op11_token_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_file.digest(token_file.write(read_table(spark, sf_dir, "documents"), TOKENIZER, scratch_dir(spark, "token-file")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.detect(read_table(spark, sf_dir, "documents"), rewrite=True)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group(read_table(spark, sf_dir, "documents"), drop_one_in=spelling.DROP_ONE_IN)


QUERIES = {f.__name__: f for f in (
    op1_warc_revisit, op2_bpe, op3_ngram_jaccard, op4_quality_rda, op5_url_rules, op6_language_id, op7_sharding,
    op8_decontaminate, op9_licenses, op10_quality_rules, op11_token_file, op12_periodic_runs, op13_spelling)}
# The others are beyond SQL (tokenizer, trained models, crc32); the tests hold them against brute force.
ORACLE_SQL = {
    "op1_warc_revisit": warc_revisit.ORACLE_SQL, "op3_ngram_jaccard": ngram_jaccard.ORACLE_SQL,
    "op5_url_rules": url_rules.ORACLE_SQL, "op8_decontaminate": decontaminate.ORACLE_SQL,
    "op9_licenses": licenses.ORACLE_SQL, "op10_quality_rules": quality_rules.ORACLE_SQL}
