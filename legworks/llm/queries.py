"""The registered queries of the training-data operators, with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legworks.llm import oracle
from legworks.llm.common import table
from legworks.llm.decontaminate import decontaminate
from legworks.llm.embedding_dedup import embedding_dedup
from legworks.llm.hard_negatives import hard_negatives
from legworks.llm.host_rules import quality_rules
from legworks.llm.html_density import main_text
from legworks.llm.line_dedup import line_dedup
from legworks.llm.mixing import mix_plan
from legworks.llm.ngram_join import ngram_join
from legworks.llm.pii import pii
from legworks.llm.sharding import shard
from legworks.llm.spelling import spelling_variants
from legworks.llm.toxicity import toxicity
from legworks.llm.warc import archive

Query = Callable[[SparkSession, str], DataFrame]


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


def op2_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_plan(table(spark, sf_dir, "documents"))


def op5_html_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii(table(spark, sf_dir, "documents"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive(table(spark, sf_dir, "pages"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"), shards=8)


def op11_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup(table(spark, sf_dir, "embeddings"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").withColumn("label", F.when(
        F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(rows, anchor=F.col("vec_id") % 100 == 0)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f for f in (
        op1_ngram_join, op2_host_rules, op3_toxicity, op4_source_mix, op5_html_density, op6_decontamination,
        op7_pii, op8_warc, op9_line_dedup, op10_sharding,
        op11_embedding_dedup, op12_hard_negatives, op13_spelling_variants)}
ORACLE: dict[str, str] = oracle.ORACLE
