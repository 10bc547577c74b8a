"""Corpus pipeline: five stages over ``documents``, each written and read again.

language ID (documents without a language go) -> near duplicates (one of each
class stays) -> benchmark decontamination (contaminated documents go) ->
mixing (documents drawn to the sources' target weights, a document drawn twice
is two rows) -> sharding (the mix put into shards).

Every stage but the last returns the columns of ``documents``. SQL cannot
express the first two stages, so ``ORACLE_SQL`` is None and the tests hold
``run`` against a brute-force version.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from riskforge.llm import decontamination, language_id, mixing, near_dedup, sharding
from riskforge.llm.common import table
from riskforge.session import ensure_checkpoint_dir

ORACLE_SQL = None


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dedup.deduplicate(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_rows(docs).select(docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sharding.digest(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; every stage's rows are Parquet in the shared checkpoint folder."""
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = f"{base}/{k}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
