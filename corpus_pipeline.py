"""The corpus pipeline: quality, near duplicates, benchmark leaks, mix, shards.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a DataFrame that
is written and read again as the next stage's ``docs``. All but the last return the columns of
``documents``. Null, empty and repeated rows are handled as the operators state.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from sparkcurate.llm import decontaminate, mixing, ngram_join, quality_mil, sharding
from sparkcurate.llm.common import table
from sparkcurate.session import ensure_checkpoint_dir

# Near duplicates: five words, similarity of 0.8 or more.
SHINGLE_WORDS, PERCENT = 5, 80


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality_mil.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group of linked documents."""
    return ngram_join.keep_one(docs, SHINGLE_WORDS, PERCENT)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a region that matches a benchmark item."""
    return decontaminate.drop_leaking(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix uses them."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, size, text_crc32, old_shard, shard, slot) of every use of a document, read from the rewritten shards."""
    place = sharding.key_shard(F.col("doc_id"), sharding.OLD_SHARDS)
    return sharding.resharded(docs, place, sharding.OLD_SHARDS, sharding.NEW_SHARDS)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("mix", mix),
    ("shards", shards),
]

# The classifier and the alignment of leaks have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is a table in the shared folder of the session."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
