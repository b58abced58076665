"""Mirror-image pairs by hashing, and connected records by their flat key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..session import lookup_join


def mirror_buckets(df: DataFrame, flat: str, key: str, inverse: str, order: str) -> DataFrame:
    """Buckets of distinct keys that are each other's mirror image inside a flat group.

    Rows collapse to distinct keys first, so a bucket holds at most a key and its inverse
    whatever the number of rows. A key equal to its inverse is achiral and left out.
    Columns: flat, bucket, n_keys, n_rows, first_key, is_pair.
    """
    distinct = (
        df.where(F.col(key) != F.col(inverse))
        .groupBy(flat, key, inverse)
        .agg(F.min(order).alias("o"), F.count(F.lit(1)).alias("r"))
    )
    return (
        distinct.groupBy(flat, F.least(key, inverse).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n_keys"), F.sum("r").alias("n_rows"), F.min(F.struct("o", key))[key].alias("first_key"))
        .withColumn("is_pair", F.col("n_keys") >= 2)
    )


def stereo_labels(
    df: DataFrame, flat: str, key: str, inverse: str, order: str, multi: Column | None = None,
    remove: bool = False, status: str = "stereo_status",
) -> DataFrame:
    """Status per row: skipped_no_smiles, complex (more than one fragment), removed_enantiomer, kept.

    With ``remove`` the first-seen key of a pair stays with all its rows and the other key
    loses all of its rows; without it pairs are only counted.
    """
    many = F.coalesce(multi, F.lit(False)) if multi is not None else F.lit(False)
    named = F.col(key).isNotNull()
    pairs = mirror_buckets(df.where(named & ~many), flat, key, inverse, order).where("is_pair")
    tagged = lookup_join(
        df.withColumn("bucket", F.least(F.col(key), F.col(inverse))),
        pairs.select(flat, "bucket", "first_key"), [flat, "bucket"], "left",
    )
    loses = F.col("first_key").isNotNull() & (F.col("first_key") != F.col(key)) & F.lit(remove)
    return (
        tagged.withColumn("in_pair", F.col("first_key").isNotNull() & named & ~many)
        .withColumn(
            status,
            F.when(~named, "skipped_no_smiles").when(many, "complex").when(loses, "removed_enantiomer").otherwise("kept"),
        )
        .drop("bucket", "first_key")
    )
