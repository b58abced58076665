"""Parquet batches and CSV inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..registry import GRAPH, conform


def read_batches(spark: SparkSession, path: str, registry: dict[str, str] = GRAPH) -> DataFrame:
    """A directory of batches as one table. Order columns: ``batch_file, row_index``.

    Batches written by this package carry the order; for foreign files it comes from the
    file name and the scan position inside the file.
    """
    df = spark.read.option("mergeSchema", "true").parquet(path)
    if "row_index" not in df.columns:
        df = df.withColumn("row_index", F.col("_metadata.row_index"))
    if "batch_file" not in df.columns:
        df = df.withColumn("batch_file", F.col("_metadata.file_name"))
    return conform(df, registry)


def read_csv(spark: SparkSession, path: str, columns: dict[str, str]) -> DataFrame:
    """Headed CSV with the named columns typed; other columns are kept as text.

    Columns are matched by header name: everything is read as text and cast, since a
    schema given to the reader would be matched by position.
    """
    raw = spark.read.option("header", "true").csv(path)
    return raw.withColumns({c: F.col(f"`{c}`").try_cast(t) for c, t in columns.items() if c in raw.columns})
