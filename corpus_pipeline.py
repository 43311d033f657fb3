"""A training corpus from ``documents``: five stages, each reading what its predecessor wrote as Parquet.

Bad texts go (6), one document of each near-duplicate group stays (10), documents with benchmark passages go
(8), sources are brought to their target weights by repeating and leaving out documents (4), and the rest is
dealt to shards (1). Near-duplicates are texts whose sets of five-word shingles have a similarity of NEAR_PERCENT or more.

Cases: an empty or null text is scored by the classifier like others (its shares are 0), is no near-duplicate, holds no benchmark item
and stays once in the mix; of rows with one doc_id all go or all stay in stages 2 and 3; a null doc_id goes only where
the classifier rejects its text; an empty table gives no rows; further columns, whatever their names, are handed on up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfmark.llm import decontam, mixing, near_dup, quality_rank, sharding
from shelfmark.llm.staging import staged
from shelfmark.session import ship


NEAR_PERCENT = 80


def _quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rank.keep_good(docs, ship(spark).read.parquet(f"{sf_dir}/labels.parquet"))


def _near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return near_dup.drop_near_duplicates(docs, NEAR_PERCENT)


def _decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminate(docs, ship(spark).read.parquet(f"{sf_dir}/benchmark.parquet"))


def _mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def _sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(docs)


STAGES = [
    ("quality_classifier", _quality),
    ("near_duplicates", _near_duplicates),
    ("decontamination", _decontamination),
    ("mixing", _mixing),
    ("sharding", _sharding),
]

#: Classifier, MinHash and tiling aren't SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written in the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
