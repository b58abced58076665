"""Farthest-first (MaxMin) selection inside groups, for small and for very large groups.

A group of at most ``LIGHT`` rows (``LIGHT_RIGID`` for RMSD) is one bounded Arrow task. Larger groups go through the
shared pick rounds of :mod:`greedy`, where the rows of a group stay spread over all tasks.
Both ways make the same picks.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.geometry import Metric
from ..session import checkpointed, lookup_join, spread, stored
from . import greedy
from .greedy import FOLD_AT, START, WINDOW, Pending, Rule, pick_from, pick_rounds
from .ordering import number_rows

LIGHT = 4000
# The same for RMSD, whose bounded search needs a thirtieth of the time per pick and holds no matrix of rows and picks.
LIGHT_RIGID = 16_000
# Picks that reach the driver and every task at once where rows are compared with many.
SLICE_PICKS = 32_768
# Fixed value: share of a group that must lie near a pick in coverage mode.
COVERED_SHARE = 0.95
NO_BUDGET = 2**62
RESULT = "row bigint, number int, near bigint, d double"


def _light_kernel(metric: Metric, cut: float | None, covered: float | None):
    rule = Rule("farthest", metric, cut)

    def answer(pdf: pd.DataFrame, picks: list[dict], near: np.ndarray, d: np.ndarray) -> pd.DataFrame:
        number = {p["row"]: i for i, p in enumerate(picks, 1)}
        score = {p["row"]: p["d"] for p in picks}
        mine = pdf["row"].map(number)
        return pd.DataFrame({
            "row": pdf["row"], "number": mine.astype("Int32"),
            "near": np.where(mine.notna(), mine.fillna(0), near).astype("int64"),
            "d": [score.get(r, v) for r, v in zip(pdf["row"], d)],
        })

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row").reset_index(drop=True)
        found: dict = {}
        picks = pick_from(pdf, rule, None, int(pdf["k"].iloc[0]), {}, found)
        if covered is None and metric.against is not None:
            # Picks of another shape are infinitely far; the first one stands for all of them.
            near = np.maximum(found["near"], 1)
            return answer(pdf, picks, near, np.where(found["near"] > 0, found["d"], np.inf))
        dist = metric.pairwise(pdf["payload"].tolist(), [p["payload"] for p in picks])
        if covered is not None:
            reach = np.minimum.accumulate(dist, axis=1) < cut
            order = {p["row"]: i for i, p in enumerate(picks)}
            own = np.array([order.get(r, len(picks)) for r in pdf["row"]])
            reach |= own[:, None] <= np.arange(len(picks))[None, :]
            enough = np.flatnonzero(reach.mean(axis=0) >= covered)
            if len(enough):
                picks, dist = picks[: enough[0] + 1], dist[:, : enough[0] + 1]
        best = dist.argmin(axis=1)
        return answer(pdf, picks, best + 1, dist[np.arange(len(pdf)), best])

    return run


def _near_column(metric: Metric, cut: float | None, pending: dict[int, Pending]):
    """Distance and number of the nearest pick, and the first pick closer than ``cut``."""

    @F.pandas_udf("d double, near bigint, first bigint")
    def near(it: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for grp, row, payload, d, n, first in it:
            g = grp.to_numpy()
            d, n, first = d.to_numpy().copy(), n.to_numpy().copy(), first.to_numpy().copy()
            for key, p in pending.items():
                idx = np.flatnonzero(g == key)
                # A bounded table of rows and picks at a time, picks in order: ties go to the earlier one.
                for lo, at in itertools.product(range(0, len(idx), 1024), range(0, len(p.payloads), FOLD_AT)):
                    part = idx[lo : lo + 1024]
                    rows, picks = [payload.iloc[i] for i in part], p.payloads[at : at + FOLD_AT]
                    nums = np.asarray(p.numbers[at : at + FOLD_AT])
                    if cut is None:
                        val, best = metric.nearest(rows, picks, d[part])
                    else:
                        m = metric.pairwise(rows, picks)
                        best = m.argmin(axis=1)
                        val = m[np.arange(len(part)), best]
                    closer = val < d[part]
                    d[part] = np.where(closer, val, d[part])
                    n[part] = np.where(closer, nums[best], n[part])
                    if cut is not None:
                        hit = np.where(m < cut, nums[None, :], NO_BUDGET).min(axis=1)
                        first[part] = np.minimum(first[part], hit)
            yield pd.DataFrame({"d": d, "near": n, "first": first})

    return near("grp", "row", "payload", "d", "near", "first")


def assign_nearest(rows: DataFrame, picks: DataFrame, metric: Metric, cut: float | None = None, slice_at: int | None = None) -> DataFrame:
    """Add ``d``, ``near`` and ``first`` of the picks of the same group.

    Picks (grp, row, number, payload) come in by slices of at most ``slice_at``, in order. More than ``FOLD_AT`` of them
    are long work for every row: the rows are dealt evenly first, once, and are stored after each slice.
    """
    slice_at = SLICE_PICKS if slice_at is None else slice_at
    out = rows.withColumns({
        "d": F.lit(float("inf")), "near": F.lit(-1).cast("bigint"), "first": F.lit(NO_BUDGET).cast("bigint"),
    })

    def apply(frame: DataFrame, part: pd.DataFrame) -> DataFrame:
        pending = {int(g): Pending(p["payload"].tolist(), p["number"].tolist()) for g, p in part.groupby("grp")}
        frame = frame.withColumn("_s", _near_column(metric, cut, pending))
        return frame.withColumns({"d": F.col("_s.d"), "near": F.col("_s.near"), "first": F.col("_s.first")}).drop("_s")

    few = picks.select("grp", "number", "payload").limit(FOLD_AT + 1).toPandas()
    if len(few) <= FOLD_AT:
        return apply(out, few.sort_values(["grp", "number"])) if len(few) else out
    order = stored(number_rows(picks.select("grp", "number", "payload"), ["grp", "number"], "_no"))
    out = stored(spread(out, "row"))
    for at in range(0, order.count(), slice_at):
        part = order.where(F.col("_no").between(at + 1, at + slice_at)).orderBy("_no").toPandas()
        out = stored(apply(out, part))
    return out


def farthest_first(
    df: DataFrame, group: list[str], row: str, payload: str, metric: Metric, cut: float | None = None,
    budget: Column | int | None = None, seed: Column | None = None, covered: float | None = None,
    light: int = LIGHT, window: int = WINDOW,
) -> DataFrame:
    """MaxMin picks of every group.

    ``row`` is a unique BIGINT and gives the order: the group's first row is the seed (or
    the row where ``seed`` is true) and ties go to the earlier row. Picking stops when the
    farthest row is nearer than ``cut``, at ``budget`` picks, or (``covered``) when that
    share of the group lies within ``cut`` of a pick.

    Returns ``row, number`` (1.. for picks, else null), ``near`` (the number of the nearest
    pick) and ``d`` (its distance; for a pick, its distance when it was picked).
    """
    key = F.struct(*group)
    k = F.lit(NO_BUDGET) if budget is None else budget if isinstance(budget, Column) else F.lit(budget)
    first = F.coalesce(seed, F.lit(False)) if seed is not None else F.lit(False)
    base = df.select(
        *group, F.col(row).cast("bigint").alias("row"), F.col(payload).alias("payload"),
        k.cast("bigint").alias("k"), F.when(first, F.lit(START * 10)).otherwise(F.lit(START)).alias("d"),
    )
    counts = base.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("k"))
    hot = counts.where(F.col("n") > light).collect()  # at most rows/light groups
    rest = base
    if hot:
        spark = df.sparkSession
        schema = spark.createDataFrame([], df.select(*group).schema).schema
        ids = spark.createDataFrame([tuple(h[g] for g in group) + (i,) for i, h in enumerate(hot)],
                                    schema.add("grp", "long"))
        tagged = lookup_join(base, ids, group, "left")
        rest = tagged.where("grp is null").drop("grp")
    small = spread(rest, *group).groupBy(*group).applyInPandas(_light_kernel(metric, cut, covered), RESULT)
    if not hot:
        return small
    pool = tagged.where("grp is not null").select("grp", "row", "payload", "d", F.lit(-1).cast("bigint").alias("near"))
    pool = checkpointed(spread(pool, "row"))
    rule = Rule("farthest", metric, cut)
    picks, left, pending = pick_rounds(
        pool, rule, {i: h["k"] for i, h in enumerate(hot)}, list(range(len(hot))), window
    )
    picks = checkpointed(picks.select("grp", "row", "number", F.col("d").alias("pd")))
    if covered is not None:
        picks = _truncate(pool, picks, metric, cut, covered)
    loaded = lookup_join(pool.select("grp", "row", "payload"), picks, ["grp", "row"], "inner")
    near = assign_nearest(pool.select("grp", "row", "payload"), loaded, metric)
    big = lookup_join(near, picks, ["grp", "row"], "left").select(
        "row", F.col("number").cast("int").alias("number"),
        F.coalesce(F.col("number").cast("bigint"), F.col("near")).alias("near"),
        F.coalesce("pd", "d").alias("d"),
    )
    return small.unionByName(big)


def _truncate(pool, picks, metric, cut, covered) -> DataFrame:
    """Keep the shortest run of picks that covers enough of its group.

    The picks themselves do not depend on when to stop, so the stop is found afterwards
    from the number of the first pick that reaches each row.
    """
    from pyspark.sql import Window

    loaded = lookup_join(pool.select("grp", "row", "payload"), picks, ["grp", "row"], "inner")
    reached = assign_nearest(pool.select("grp", "row", "payload"), loaded, metric, cut)
    reached = lookup_join(reached, picks.select("grp", "row", "number"), ["grp", "row"], "left")
    at = F.least(F.coalesce(F.col("number").cast("bigint"), F.lit(NO_BUDGET)), F.col("first"))
    per = reached.groupBy("grp", at.alias("at")).agg(F.count(F.lit(1)).alias("n"))
    total = per.groupBy("grp").agg(F.sum("n").alias("total"))
    run = F.sum("n").over(Window.partitionBy("grp").orderBy("at"))
    stop = (
        per.withColumn("c", run).join(total, "grp").where(F.col("c") >= covered * F.col("total"))
        .groupBy("grp").agg(F.min("at").alias("stop"))
    )
    return lookup_join(picks, stop, "grp", "inner").where(F.col("number") <= F.col("stop")).drop("stop")


def conformer_filter(
    df: DataFrame, key: str, row: str, coords: str, energy: str | None = "Energy_Ha", threshold: float | None = None,
    mode: str = "raw", coverage_guarantee: bool = False, legacy_rotation: bool = False, light: int | None = None,
) -> DataFrame:
    """Add ``conformer_status`` and ``cluster_id``: MaxMin over heavy-atom RMSD per compound.

    Rows rank by energy (lowest first, missing last), then source order. Rows without
    coordinates are ``mol_corrupt``, rows without a key ``no_compound_id``.
    """
    from ..functions.geometry import ordered_rmsd
    from .gates import guard_threshold

    limits = {"raw": (1.0, 0.1, 5.0), "normalized": (0.15, 0.05, 0.50)}
    if mode not in limits:
        raise ValueError(f"unknown RMSD mode {mode!r}")
    default, low, high = limits[mode]
    cut = guard_threshold(default if threshold is None else threshold, low, high, "RMSD")
    usable = F.col(key).isNotNull() & F.col(coords).isNotNull()
    rank = [F.col(energy).asc_nulls_last(), F.col(row)] if energy else [F.col(row)]
    work = df.where(usable).select(key, row, coords, *([energy] if energy else []))
    if energy:
        work = work.withColumn("_e", F.coalesce(F.col(energy).cast("double"), F.lit(float("inf"))))
        work = number_rows(work, ["_e", row], "_r")
    else:
        work = work.withColumn("_r", F.col(row))
    metric = ordered_rmsd(mode == "normalized", legacy_rotation)
    if light is None:
        light = LIGHT if coverage_guarantee or legacy_rotation else LIGHT_RIGID
    res = farthest_first(
        work, [key], "_r", coords, metric, cut, covered=COVERED_SHARE if coverage_guarantee else None, light=light
    )
    places = work.select(F.col(row).alias("_at"), "_r")
    found = places.join(res.withColumnRenamed("row", "_r"), "_r").withColumnRenamed("_at", row)
    return (
        df.join(found, row, "left")
        .withColumn(
            "conformer_status",
            F.when(F.col(key).isNull(), "no_compound_id").when(F.col(coords).isNull(), "mol_corrupt")
            .when(F.col("number").isNotNull(), "kept").otherwise("removed_conformer"),
        )
        .withColumn("cluster_id", F.col("near").cast("int"))
        .drop("_r", "number", "near", "d")
    )
