"""Greedy set cover and greedy picks by coverage gain, without a scan of the records per pick.

Records are an inverted table of pairs (row, rank, n): the record carries n instances of the
environment with that rank. A pick closes environments; only the records that carry a closed environment
change, and only these get a delta.

``greedy_cover`` needs no order of picks at all: many picks are decided in one round.
``lazy_rounds`` serves rules that also look at the distance to the picks. Ranks only get worse
while picks are made, so a stored key is a bound: a few best rows by bound are fetched and scored
exactly, and picked as long as none outside can be better.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from ..session import fits_broadcast, lookup_join, stored
from .greedy import FOLD_AT, WINDOW, Pending, PickLog, Rule, _distances, _pend, pick_from

# Pairs that one task may finish: some 100 MB of arrays.
SMALL_PAIRS = 2_000_000
PICKED = "row bigint, gain bigint, closed bigint"


def _finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """All picks of a small table of pairs: a heap of gains, lowered when environments close."""
    parts = [f for f in frames if len(f)]
    if not parts:
        return
    pairs = pd.concat(parts)
    rows, at = np.unique(pairs["row"].to_numpy(), return_inverse=True)
    ranks, env = np.unique(pairs["rank"].to_numpy(), return_inverse=True)
    n = pairs["n"].to_numpy(np.int64)
    by_row, by_env = np.argsort(at, kind="stable"), np.argsort(env, kind="stable")
    row_at = np.searchsorted(at[by_row], np.arange(len(rows) + 1))
    env_at = np.searchsorted(env[by_env], np.arange(len(ranks) + 1))
    env_of_row, row_of_env, n_of_env = env[by_row], at[by_env], n[by_env]
    gain = np.bincount(at, weights=n, minlength=len(rows)).astype(np.int64)
    open_ = np.ones(len(ranks), dtype=bool)
    heap = [(-g, i) for i, g in enumerate(gain.tolist())]
    heapq.heapify(heap)
    out = []
    while heap:
        g, i = heapq.heappop(heap)
        if gain[i] != -g:
            if gain[i]:
                heapq.heappush(heap, (-int(gain[i]), i))
            continue
        mine = env_of_row[row_at[i] : row_at[i + 1]]
        mine = mine[open_[mine]]
        open_[mine] = False
        for e in mine.tolist():
            a, b = env_at[e], env_at[e + 1]
            gain[row_of_env[a:b]] -= n_of_env[a:b]
        out.append((int(rows[i]), -g, len(mine)))
    yield pd.DataFrame(out, columns=["row", "gain", "closed"])


def greedy_cover(pairs: DataFrame, small: int | None = None) -> DataFrame:
    """(row, gain, closed) of the picks of greedy set cover over pairs (row, rank, n).

    The greedy order is by falling gain, then by row: gains only fall, so no row rises into a level of
    gain that is being picked. A row that comes before all rows it shares an open environment with is
    picked before any of them, with the gain it has now. So all such rows are picked in one round; they
    share nothing, and each environment has its best carrier as the only candidate. A round is two
    aggregates and joins; an environment carried by a third of all rows is closed by the first pick
    that carries it, and aggregates meet it combined map-side. What is left at ``small`` pairs or fewer
    is finished by the same rule in one task.
    """
    small = SMALL_PAIRS if small is None else small
    left, picked = stored(pairs.select("row", "rank", F.col("n").cast("bigint").alias("n"))), []
    while left.count() > small:
        gains = left.groupBy("row").agg(F.sum("n").alias("gain"))
        keyed = left.join(gains, "row")
        best = keyed.groupBy("rank").agg(F.min(F.struct(-F.col("gain"), F.col("row")))["row"].alias("first"))
        judged = keyed.join(best, "rank")
        now = judged.groupBy("row").agg(
            F.max("gain").alias("gain"), F.count(F.lit(1)).alias("closed"), F.min(F.col("first") == F.col("row")).alias("ok")
        ).where("ok").select("row", "gain", "closed")
        now = stored(now)
        gone = left.join(now.select("row"), "row", "left_semi").select("rank")  # each is closed by one pick
        left = stored(left.join(gone, "rank", "left_anti"))
        picked.append(now)
    last = stored(left.coalesce(1).mapInPandas(_finish, PICKED))
    for p in picked:
        last = last.unionByName(p)
    return last


def _keys(state: DataFrame, rule: Rule) -> DataFrame:
    """Rows that may be picked, with the keys of ``Rule.rank`` computed in the same order of operations."""
    gain, d = F.col("gain"), F.col("d")
    if rule.kind == "floor":
        return state.where("gain > 0").withColumns({"k0": -(F.lit(rule.w) * gain + F.lit(1.0 - rule.w) * d), "k1": F.col("rarest")})
    if rule.kind == "depth":
        return state.where((gain > 0) & (F.lit(1.0) - d <= rule.cut + 1e-12)).withColumns({"k0": -gain, "k1": -d})
    raise ValueError(rule.kind)


def _state(rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """(row, d, gain, rarest) of every row, gains as of now."""
    sums = pairs.groupBy("row").agg(F.sum("n").cast("double").alias("gain"), F.min("rank").cast("double").alias("rarest"))
    return stored(rows.select("row", "d").join(sums, "row"))


def _nearer(rows: DataFrame, rule: Rule, pending: dict) -> DataFrame:
    """``rows`` (row, payload, d, ...) with ``d`` lowered by the pending picks; payloads go to Python by Arrow."""

    @F.pandas_udf("double")
    def nearest(payload: pd.Series, d: pd.Series) -> pd.Series:
        return pd.Series(_distances(rule, np.zeros(len(d)), list(payload), d, np.zeros(len(d)), pending)[0])

    return rows.withColumn("d", nearest("payload", "d"))


def lazy_rounds(
    rows: DataFrame, pairs: DataFrame, rule: Rule, budget: int, first_number: int = 1, window: int = WINDOW, fold_at: int | None = None
) -> DataFrame:
    """(row, number, score) of the picks of a ``floor`` or ``depth`` rule.

    ``rows``: row, payload and d, the distance to what is picked already. ``pairs``: row, rank, n and b,
    the picked rows that carry the environment; only environments with ``b`` below the target are in it.
    Both are stored tables; picked rows are not in them. A round reads the ``window`` best rows by key from
    the narrow state, fetches their payloads and pairs, and makes every pick that they decide. The
    environments that close then lower the gains of their carriers, in Spark. Distances are brought up
    to date for the fetched rows only; where none of them can be picked, for all rows whose key
    stands before the best one. After ``fold_at`` picks all of them are, and the picks leave the driver.
    """
    spark = rows.sparkSession
    fold_at = FOLD_AT if fold_at is None else fold_at
    log, pending, number, left = PickLog(spark), {}, first_number, budget
    shut: set[int] = set()  # environments closed since the last fold
    state = _state(rows, pairs)
    while left > 0:
        top = _keys(state, rule).orderBy("k0", "k1", "row").limit(window + 1).toPandas()
        if not len(top):
            break
        bound = None
        if len(top) > window:
            bound = tuple(top.iloc[window][["k0", "k1", "row"]])
            top = top.iloc[:window]
        names = top["row"].tolist()
        held = rows.where(F.col("row").isin(names)).select("row", "payload").toPandas()
        env = pairs.where(F.col("row").isin(names)).groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "n", "b"))).alias("l")).select(
            "row", F.col("l.rank").alias("er"), F.col("l.n").alias("en"), F.col("l.b").alias("eb")).toPandas()
        part = top[["row", "d"]].merge(held, on="row").merge(env, on="row")
        part["d"], _ = _distances(rule, np.zeros(len(part)), part["payload"].tolist(), part["d"], np.zeros(len(part)), pending)
        carried = pending[0].carried if pending else {}
        before = dict(carried)
        picks = pick_from(part, rule, bound, left, carried)
        log.add(0, picks, number)
        if picks:
            _pend(pending, 0, picks, number)
        number, left = number + len(picks), left - len(picks)
        if left <= 0 or (bound is None and not picks):
            break
        gone = {x["row"] for x in picks}
        stays = ~part["row"].isin(gone).to_numpy()
        near = _distances(rule, np.zeros(len(part)), part["payload"].tolist(), part["d"], np.zeros(len(part)), pending)[0]
        fresh = pd.DataFrame({"row": part["row"][stays], "_d": near[stays]})
        base = {int(r): int(b) for er, eb in zip(part["er"], part["eb"], strict=True) for r, b in zip(er, eb, strict=True)}
        now = pending[0].carried if pending else {}
        closed = [r for r in {int(r) for x in picks for r in x["er"]} if base[r] + now[r] >= rule.target > base[r] + before.get(r, 0)]
        shut.update(closed)
        state = _lowered(state, pairs, fresh, gone, closed)
        if not picks:
            state = _refreshed(state, rows, pairs, rule, pending, part, shut)
        elif len(pending[0].payloads) >= fold_at:
            rows, pairs = _folded(rows, pairs, rule, pending)
            pending, shut = {}, set()
            state = _state(rows, pairs)
    return log.table().select("row", "number", "score")


def _lowered(state: DataFrame, pairs: DataFrame, fresh: pd.DataFrame, gone: set, closed: list[int]) -> DataFrame:
    """The state without the picked rows, with new distances of the fetched rows and without the gain of closed environments."""
    spark = state.sparkSession
    if gone:
        state = state.where(~F.col("row").isin(list(gone)))
    if len(fresh):
        state = state.join(F.broadcast(spark.createDataFrame(fresh, "row bigint, _d double")), "row", "left").withColumn("d", F.coalesce("_d", "d")).drop("_d")
    if closed:
        shut = spark.createDataFrame(pd.DataFrame({"rank": closed}), "rank bigint")
        shut = F.broadcast(shut) if fits_broadcast(shut) else shut
        delta = pairs.join(shut, "rank", "left_semi").groupBy("row").agg(F.sum("n").alias("_less"))
        state = state.join(delta, "row", "left").withColumn("gain", F.col("gain") - F.coalesce("_less", F.lit(0))).drop("_less")
    return stored(state)


def _refreshed(state: DataFrame, rows: DataFrame, pairs: DataFrame, rule: Rule, pending: dict, part: pd.DataFrame, shut: set) -> DataFrame:
    """The state with exact keys of all rows whose key stands before or beside the best exact one."""
    if not pending:
        return state
    d = part["d"].to_numpy()
    live = np.array([sum(n for n, b, r in zip(en, eb, er, strict=True) if b + pending[0].carried.get(int(r), 0) < rule.target)
                     for en, eb, er in zip(part["en"], part["eb"], part["er"], strict=True)], dtype=float)
    ok, k0, _ = rule.rank(d, live, np.zeros(len(part)))
    before = F.col("k0") <= float(k0[ok].min()) if ok.any() else F.lit(True)
    ahead = stored(_keys(state, rule).where(before).select("row", "d"))
    exact = _nearer(lookup_join(rows.drop("d"), ahead, "row", "inner"), rule, pending).select("row", F.col("d").alias("_d"))
    closed = state.sparkSession.createDataFrame(pd.DataFrame({"rank": sorted(shut)}, dtype="int64"), "rank bigint")
    open_ = lookup_join(pairs, ahead.select("row"), "row", "inner").join(F.broadcast(closed) if fits_broadcast(closed) else closed, "rank", "left_anti")
    exact = exact.join(open_.groupBy("row").agg(F.min("rank").cast("double").alias("_r")), "row", "left")
    return stored(state.join(exact, "row", "left").withColumns({"d": F.coalesce("_d", "d"), "rarest": F.coalesce("_r", "rarest")}).drop("_d", "_r"))


def _folded(rows: DataFrame, pairs: DataFrame, rule: Rule, pending: dict) -> tuple[DataFrame, DataFrame]:
    """Rows and pairs with the pending picks written into them."""
    spark = rows.sparkSession
    gone = spark.createDataFrame(pd.DataFrame({"row": sorted(pending[0].rows)}), "row bigint")
    kept = stored(_nearer(rows.join(F.broadcast(gone), "row", "left_anti"), rule, pending))
    more = spark.createDataFrame(pd.DataFrame({"rank": list(pending[0].carried), "_c": list(pending[0].carried.values())}), "rank bigint, _c bigint")
    open_ = lookup_join(pairs.join(F.broadcast(gone), "row", "left_anti"), more, "rank").withColumn("b", F.col("b") + F.coalesce("_c", F.lit(0))).drop("_c")
    return kept, stored(open_.where(F.col("b") < rule.target))
