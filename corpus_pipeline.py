"""A training corpus in five stages: documents in, shards out.

Each stage takes what its predecessor kept, as the table that was written and read
back, and its decisions take effect: toxic documents go, one document of each class of near
duplicates stays, contaminated documents go, the rest is mixed to target weights (a document that
the mix takes twice is there twice), and the last stage returns the place of each in a shard.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from legworks.llm.common import staged, table
from legworks.llm.decontaminate import drop_contaminated
from legworks.llm.mixing import mix
from legworks.llm.ngram_join import first_of_class
from legworks.llm.sharding import shard
from legworks.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return first_of_class(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return shard(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates),
          ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]

# The toxicity model and the paths of the near-duplicate join have no SQL; tests/llm hold the
# stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
