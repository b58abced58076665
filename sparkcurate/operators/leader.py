"""Keep-first near-duplicate clustering inside groups.

In source order a row is kept when no earlier kept row of its group is closer than the
threshold; otherwise it joins the nearest earlier kept row. A group of at most ``LIGHT``
rows is one bounded Arrow task. A larger group is cut into cells by a feature that never
differs by more than the distance, so only neighbouring cells can hold near-duplicates,
and is resolved in rounds:

1. every cell offers its first undecided rows (at most ``OFFER``);
2. a task sees the offers of a cell and its two neighbours and decides the rows of its own
   cell that no unseen or undecided earlier row can change;
3. all other rows of the group are compared with the new kept rows only, in salted blocks.

A block of near copies is gone after one kept row, no pair list is ever written, and every
task stays bounded whatever the size of the group.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.geometry import Metric
from ..session import checkpointed, lookup_join, spread
from .ordering import number_clusters, number_rows

LIGHT = 2000
OFFER = 256
BLOCK = 1024
# Rows of a small group that are compared with its kept rows at once.
PART = 256
RESULT = "row bigint, rep bigint, d double"


def _light_kernel(metric: Metric, cut: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row").reset_index(drop=True)
        rows, items = pdf["row"].to_numpy(), pdf["payload"].tolist()
        made, features = metric.prepare(items), metric.feature(items)
        kept: list[int] = []
        rep = rows.copy()
        gap = np.full(len(rows), np.nan)
        for lo in range(0, len(rows), PART):
            part = slice(lo, lo + PART)
            # What was kept before is compared with many rows at once, only what the part itself keeps row by row.
            before = metric.within(items[part], [items[k] for k in kept], cut)
            old = len(kept)
            for i in range(lo, min(lo + PART, len(rows))):
                near = before[i - lo]
                if len(kept) > old:
                    near = np.concatenate([near, metric.near(made, features, i, np.array(kept[old:]), cut)])
                if len(near) and near.min() < cut:
                    best = int(near.argmin())
                    rep[i], gap[i] = rows[kept[best]], near[best]
                else:
                    kept.append(i)
        return pd.DataFrame({"row": rows, "rep": rep, "d": gap})

    return run


def _decide_kernel(metric: Metric, cut: float):
    """Kept rows of the home cell that are certain from the visible offers."""

    def run(key, pdf: pd.DataFrame) -> pd.DataFrame:
        home = key[1]
        horizon = pdf["horizon"].min()
        pdf = pdf[pdf["row"] <= horizon].sort_values("row").reset_index(drop=True)
        items, own = pdf["payload"].tolist(), (pdf["home"] == home).to_numpy()
        made, features = metric.prepare(items), metric.feature(items)
        sure: list[int] = []
        open_: list[int] = []

        def near(i: int, others: list[int]) -> bool:
            return bool(others) and bool(np.isfinite(metric.near(made, features, i, np.array(others), cut)).any())

        for i in range(len(pdf)):
            if near(i, sure):
                continue
            if own[i] and not near(i, open_):
                sure.append(i)
            else:
                open_.append(i)
        out = pdf.iloc[sure]
        return pd.DataFrame({"grp": out["grp"], "home": out["home"], "row": out["row"], "payload": out["payload"]})

    return run


def _compare_kernel(metric: Metric, cut: float):
    """Bring the rows of one salted block up to date with the new kept rows of their cells."""

    def run(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return left.drop(columns=["salt"])
        left = left.drop(columns=["salt"]).copy()
        if len(right):
            right = right.sort_values("row")
            at = right["row"].to_numpy()
            known = right["payload"].tolist()
            rows = left["row"].to_numpy()
            d, rep = left["d"].to_numpy(dtype=float).copy(), left["rep"].to_numpy().copy()
            for lo in range(0, len(rows), 1024):
                part = slice(lo, lo + 1024)
                m = metric.within(left["payload"].iloc[part].tolist(), known, cut)
                m = np.where(at[None, :] < rows[part][:, None], m, np.inf)
                best = m.argmin(axis=1)
                val = m[np.arange(len(m)), best]
                better = (val < d[part]) | ((val == d[part]) & np.isfinite(val) & (at[best] < rep[part]))
                d[part] = np.where(better, val, d[part])
                rep[part] = np.where(better, at[best], rep[part])
            left["d"], left["rep"] = d, rep
        return left

    return run


def _cell_column(metric: Metric, width: float):
    @F.pandas_udf("bigint")
    def cell(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for payload in it:
            yield pd.Series(np.floor(metric.feature(payload.tolist()) / width).astype("int64"))

    return cell("payload")


def _hot_rounds(pool: DataFrame, metric: Metric, cut: float, offer: int, block: int) -> DataFrame:
    """Resolve large groups; ``pool`` has grp, row, payload. Returns RESULT rows."""
    width = max(metric.reach(cut) * (1 + 1e-9), 1e-12)
    ptype = dict(pool.dtypes)["payload"]
    state = pool.withColumns({
        "home": _cell_column(metric, width), "d": F.lit(float("inf")), "rep": F.lit(-1).cast("bigint"),
    })
    state = checkpointed(state)
    schema = f"grp bigint, row bigint, payload {ptype}, home bigint, d double, rep bigint"
    sizes = state.groupBy("grp", "home").agg(F.count(F.lit(1)).alias("n"))
    blocks = checkpointed(sizes.select(
        "grp", "home", F.ceil(F.col("n") / block).cast("int").alias("blocks")
    ))
    kept = None
    while True:
        undecided = state.where("rep = -1")
        w = Window.partitionBy("grp", "home").orderBy("row")
        firsts = (
            undecided.select("grp", "home", "row", "payload")
            .withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= offer + 1)
        )
        # Rows beyond the last offer of a cell are unseen; decisions stop before them.
        horizon = firsts.groupBy("grp", "home").agg(
            F.max(F.when(F.col("_n") == offer + 1, F.col("row") - 1)).alias("horizon")
        ).select("grp", "home", F.coalesce("horizon", F.lit(2**62)).alias("horizon"))
        offers = firsts.where(F.col("_n") <= offer).drop("_n").join(horizon, ["grp", "home"])
        seen = offers.withColumn("cell", F.explode(F.array(F.col("home") - 1, F.col("home"), F.col("home") + 1)))
        new = spread(seen, "grp", "cell").groupBy("grp", "cell").applyInPandas(
            _decide_kernel(metric, cut), f"grp bigint, home bigint, row bigint, payload {ptype}"
        )
        new = checkpointed(new)
        if new.isEmpty():
            break
        known = (
            new.withColumn("cell", F.explode(F.array(F.col("home") - 1, F.col("home"), F.col("home") + 1)))
            .join(blocks.withColumnRenamed("home", "cell"), ["grp", "cell"])
            .withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("grp", F.col("cell").alias("home"), "salt", "row", "payload")
        )
        # The kept rows leave the state: they are the few rows of `new`.
        others = lookup_join(state, new.select("grp", "row", F.lit(1).alias("_k")), ["grp", "row"]).where("_k is null").drop("_k")
        salted = lookup_join(others, blocks, ["grp", "home"], "inner").withColumn(
            "salt", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int")
        ).drop("blocks").select("grp", "home", "salt", "row", "payload", "d", "rep")
        state = checkpointed(
            spread(salted, "grp", "home", "salt").groupBy("grp", "home", "salt")
            .cogroup(spread(known, "grp", "home", "salt").groupBy("grp", "home", "salt"))
            .applyInPandas(_compare_kernel(metric, cut), schema)
        )
        found = new.select("row", F.col("row").alias("rep"), F.lit(None).cast("double").alias("d"))
        kept = found if kept is None else kept.unionByName(found)
    rest = state.select("row", "rep", "d")
    return rest if kept is None else kept.unionByName(rest)


def leader_clusters(
    df: DataFrame, group: list[str], row: str, payload: str, metric: Metric, cut: float,
    light: int = LIGHT, offer: int = OFFER, block: int = BLOCK,
) -> DataFrame:
    """``row, rep, d``: the kept row each row belongs to (itself when kept, then d is null)."""
    base = df.select(*group, F.col(row).cast("bigint").alias("row"), F.col(payload).alias("payload"))
    counts = base.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    hot = checkpointed(counts.where(F.col("n") > light).drop("n"))
    any_hot = not hot.isEmpty()
    rest = base
    if any_hot:
        tagged = lookup_join(base, number_rows(hot, group, "grp"), group, "left")
        rest = tagged.where("grp is null").drop("grp")
    small = spread(rest, *group).groupBy(*group).applyInPandas(_light_kernel(metric, cut), RESULT)
    if not any_hot:
        return small
    pool = tagged.where("grp is not null").select("grp", "row", "payload")
    return small.unionByName(_hot_rounds(pool, metric, cut, offer, block))


def near_dedup(
    df: DataFrame, group: list[str], row: str, payload: str, metric: Metric, cut: float,
    status: str = "dedup_status", **sizes: int,
) -> DataFrame:
    """Add ``dedup_status`` (kept/near_dup), ``cluster_id`` (numbered over all groups by the
    first row of each group, then by row), ``rep_row`` and ``rep_distance``."""
    found = leader_clusters(df, group, row, payload, metric, cut, **sizes)
    found = checkpointed(found)
    joined = df.join(found.withColumnsRenamed({"row": row, "rep": "rep_row", "d": "rep_distance"}), row)
    reps = joined.where(F.col("rep_row") == F.col(row)).select(*group, row)
    numbers = number_clusters(reps, group, row).select(F.col(row).alias("rep_row"), "cluster_id")
    return joined.join(numbers, "rep_row").withColumn(
        status, F.when(F.col("rep_row") == F.col(row), "kept").otherwise("near_dup")
    )
