"""Exact running sums and numbers inside large groups, without one task per group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def block_sums(df: DataFrame, group: list[str], block: Column, order: list[Column], sums: dict[str, Column]) -> DataFrame:
    """``df`` with ``_block`` and, per entry of ``sums``, the sum over the rows before in the group.

    A group is cut into the blocks of ``block``; the order is by block, then by ``order``. Only
    the rows of one block meet in a task; the blocks' totals, one row per group and block, give
    the offsets. ``order`` decides inside a block: rows equal in it must be interchangeable.
    Null group values are a group of their own.
    """
    placed = df.withColumn("_block", block)
    for name, value in sums.items():
        placed = placed.withColumn(f"_v_{name}", value)
    inside = Window.partitionBy(*group, "_block").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*[f"_g{i}" for i in range(len(group))]).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = placed.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)], F.col("_block").alias("_b")).agg(
        *[F.sum(f"_v_{name}").alias(f"_t_{name}") for name in sums])
    offsets = totals.select(
        *[f"_g{i}" for i in range(len(group))], "_b",
        *[F.coalesce(F.sum(f"_t_{name}").over(before), F.lit(0)).alias(f"_o_{name}") for name in sums])
    local = placed.select("*", *[F.coalesce(F.sum(f"_v_{name}").over(inside), F.lit(0)).alias(f"_l_{name}") for name in sums])
    on = F.col("_block") == F.col("_b")
    for i, g in enumerate(group):
        on = on & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    joined = local.join(offsets, on)
    for name in sums:
        joined = joined.withColumn(name, F.col(f"_o_{name}") + F.col(f"_l_{name}"))
    drop = [f"_{k}_{name}" for name in sums for k in "vol"] + [f"_g{i}" for i in range(len(group))] + ["_b"]
    return joined.drop(*drop)
