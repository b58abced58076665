"""Exact greedy selection on a distributed pool, many picks per pass over the data.

All greedy rules here share one property: while picks are made, a row's rank only gets
worse (distances shrink, gains shrink, ties move back). So after ranking the pool once,
the best ``window`` rows are enough to make several exact picks: a pick is safe as long as
the best re-scored row of the window still ranks before the first row outside of it.

Each pass over the pool is a scan with an Arrow function (the few pending picks travel
with the function), a filter, and a bounded top-k. Nothing is shuffled but the top-k. Only
the window and the pending picks ever reach the driver; both have fixed limits. When
enough picks are pending they are folded into the pool's state columns and the pool is
checkpointed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from ..functions.geometry import Metric
from ..session import checkpointed

WINDOW = 512
FOLD_AT = 2048
START = 1e300
# Rows of all groups together that one round may bring to the driver.
ROUND_ROWS = 20_000


@dataclass(frozen=True)
class Rule:
    """How rows rank. ``kind``:

    * ``farthest``: largest distance to the picks; stops below ``cut`` when given
    * ``cover``: most instances of open environments
    * ``floor``: ``w * open instances + (1 - w) * distance``, ties by rarest open environment
    * ``depth``: most instances of open environments, ties by larger distance, only rows
      whose similarity to the picks is at most ``cut``

    An environment is open while fewer than ``target`` picked rows carry it.
    """

    kind: str
    metric: Metric | None = None
    cut: float | None = None
    w: float = 0.5
    target: int = 1

    @property
    def uses_envs(self) -> bool:
        return self.kind != "farthest"

    def rank(self, d: np.ndarray, gain: np.ndarray, rarest: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(eligible, first key, second key); smaller keys rank first."""
        zero = np.zeros(len(d))
        if self.kind == "farthest":
            return (d >= self.cut) if self.cut is not None else np.ones(len(d), bool), -d, zero
        if self.kind == "cover":
            return gain > 0, -gain, zero
        if self.kind == "floor":
            return gain > 0, -(self.w * gain + (1.0 - self.w) * d), rarest
        if self.kind == "depth":
            ok = (gain > 0) & ((1.0 - d) <= self.cut + 1e-12)
            return ok, -gain, -d
        raise ValueError(self.kind)


@dataclass
class Pending:
    """Picks of one group that are not yet folded into the pool."""

    payloads: list = field(default_factory=list)
    numbers: list = field(default_factory=list)
    rows: set = field(default_factory=set)
    carried: dict = field(default_factory=dict)


def _open_stats(er, en, eb, carried: dict, target: int) -> tuple[np.ndarray, np.ndarray]:
    """Open instances and the smallest open rank of every row."""
    sizes = np.array([len(x) for x in er])
    gain, rarest = np.zeros(len(er)), np.full(len(er), np.inf)
    if not sizes.sum():
        return gain, rarest
    r = np.concatenate([np.asarray(x, dtype=np.int64) for x in er])
    n = np.concatenate([np.asarray(x, dtype=float) for x in en])
    b = np.concatenate([np.asarray(x, dtype=np.int64) for x in eb])
    if carried:
        keys = np.array(sorted(carried), dtype=np.int64)
        adds = np.array([carried[k] for k in keys.tolist()], dtype=np.int64)
        at = np.minimum(np.searchsorted(keys, r), len(keys) - 1)
        b = b + np.where(keys[at] == r, adds[at], 0)
    live = b < target
    owner = np.repeat(np.arange(len(er)), sizes)
    gain = np.bincount(owner, weights=n * live, minlength=len(er))
    np.minimum.at(rarest, owner[live], r[live].astype(float))
    return gain, rarest


def _distances(rule: Rule, groups, payloads, d, near, pending: dict) -> tuple[np.ndarray, np.ndarray]:
    """Distance to, and number of, the nearest pick so far (the earlier pick on ties)."""
    d, near = np.array(d, dtype=float), np.array(near, dtype=np.int64)
    if rule.metric is None:
        return d, near
    groups = np.asarray(groups)
    for g, p in pending.items():
        if not p.payloads:
            continue
        idx = np.flatnonzero(groups == g)
        for lo in range(0, len(idx), 2048):
            part = idx[lo : lo + 2048]
            val, best = rule.metric.nearest([payloads[i] for i in part], p.payloads, d[part])
            closer = val < d[part]
            d[part] = np.where(closer, val, d[part])
            near[part] = np.where(closer, np.asarray(p.numbers)[best], near[part])
    return d, near


def _score_column(rule: Rule, pending: dict):
    schema = "ok boolean, k0 double, k1 double, d double, near bigint"

    if rule.uses_envs:

        @F.pandas_udf(schema)
        def score(it: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
            for grp, row, payload, d, near, er, en, eb in it:
                dist, n = _distances(rule, grp, list(payload), d, near, pending)
                gain, rarest = np.zeros(len(grp)), np.full(len(grp), np.inf)
                g = grp.to_numpy()
                for key in pd.unique(g):
                    m = np.flatnonzero(g == key)
                    carried = pending[key].carried if key in pending else {}
                    gain[m], rarest[m] = _open_stats(
                        er.iloc[m].tolist(), en.iloc[m].tolist(), eb.iloc[m].tolist(), carried, rule.target
                    )
                yield _frame(rule, pending, g, row, dist, n, gain, rarest)

        return score("grp", "row", "payload", "d", "near", "er", "en", "eb")

    @F.pandas_udf(schema)
    def score_plain(it: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.DataFrame]:
        for grp, row, payload, d, near in it:
            dist, n = _distances(rule, grp, list(payload), d, near, pending)
            z = np.zeros(len(grp))
            yield _frame(rule, pending, grp.to_numpy(), row, dist, n, z, z)

    return score_plain("grp", "row", "payload", "d", "near")


def _frame(rule, pending, groups, rows, d, near, gain, rarest) -> pd.DataFrame:
    ok, k0, k1 = rule.rank(d, gain, rarest)
    taken = np.array([g in pending and r in pending[g].rows for g, r in zip(groups, rows)], dtype=bool)
    return pd.DataFrame({"ok": ok & ~taken, "k0": k0, "k1": k1, "d": d, "near": near})


def pick_from(
    cands: pd.DataFrame, rule: Rule, bound: tuple | None, budget: int, carried: dict, found: dict | None = None
) -> list[dict]:
    """Make every pick that the candidates decide, in order.

    ``cands`` has columns row, payload, d (and er, en, eb); ``bound`` is the rank of the
    first row outside, or None when the candidates are the whole group. ``found`` gets ``d``
    and ``near`` of the candidates: the distance to the nearest pick and its number here, 0 for none.
    """
    rows = cands["row"].to_numpy()
    payloads = cands["payload"].tolist()
    made = rule.metric.prepare(payloads) if rule.metric is not None else None
    nearer = rule.metric.nearer(made) if rule.metric is not None else None
    d = cands["d"].to_numpy(dtype=float).copy()
    near = np.zeros(len(rows), dtype=np.int64)
    alive = np.ones(len(rows), dtype=bool)
    gain, rarest = np.zeros(len(rows)), np.zeros(len(rows))
    holders: dict[int, list[tuple[int, float]]] = {}
    opened: list[dict] = []
    base: dict[int, int] = {}
    carried = dict(carried)
    if rule.uses_envs:
        for i, (er, en, eb) in enumerate(zip(cands["er"], cands["en"], cands["eb"])):
            live = {}
            for r, n, b in zip(er, en, eb):
                base[int(r)] = int(b)
                if b + carried.get(int(r), 0) < rule.target:
                    live[int(r)] = float(n)
                    holders.setdefault(int(r), []).append((i, float(n)))
            opened.append(live)
            gain[i] = sum(live.values())
            rarest[i] = min(live, default=np.inf)
    out: list[dict] = []
    while len(out) < budget:
        ok, k0, k1 = rule.rank(d, gain, rarest)
        idx = np.flatnonzero(ok & alive)
        if not len(idx):
            break
        best = idx[np.lexsort((rows[idx], k1[idx], k0[idx]))[0]]
        key = (k0[best], k1[best], rows[best])
        if bound is not None and not key < bound:
            break
        closed = 0
        if rule.uses_envs:
            for r in cands["er"].iloc[best]:
                r = int(r)
                carried[r] = carried.get(r, 0) + 1
                if base[r] + carried[r] == rule.target:
                    closed += 1
                    for i, n in holders.get(r, ()):
                        gain[i] -= n
                        opened[i].pop(r, None)
                        if rarest[i] == r:
                            rarest[i] = min(opened[i], default=np.inf)
        alive[best] = False
        out.append({"row": int(rows[best]), "payload": payloads[best], "k0": float(k0[best]),
                    "d": float(d[best]), "gain": float(-k0[best]), "closed": closed,
                    "er": list(cands["er"].iloc[best]) if rule.uses_envs else []})
        if rule.metric is not None:
            val, _ = nearer(made[[best]], d)
            closer = val < d
            d, near = np.where(closer, val, d), np.where(closer, len(out), near)
    if found is not None:
        found["d"], found["near"] = d, near
    return out


def fold(pool: DataFrame, rule: Rule, pending: dict) -> DataFrame:
    """Write pending picks into ``d``, ``near`` and ``eb``; picked rows leave the pool, and so do rows nearer
    than the ``cut`` of a farthest-first rule, which are never picked."""
    if not pending:
        return pool
    schema = pool.schema
    settled = rule.kind == "farthest" and rule.cut is not None

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            g = pdf["grp"].to_numpy()
            taken = [k in pending and r in pending[k].rows for k, r in zip(g, pdf["row"])]
            pdf["d"], pdf["near"] = _distances(rule, g, pdf["payload"].tolist(), pdf["d"], pdf["near"], pending)
            if "eb" in pdf:
                pdf["eb"] = [
                    [int(b) + pending[k].carried.get(int(r), 0) for r, b in zip(er, eb)] if k in pending else eb
                    for k, er, eb in zip(g, pdf["er"], pdf["eb"])
                ]
            taken = np.asarray(taken, dtype=bool)
            yield pdf[~taken & (pdf["d"].to_numpy() >= rule.cut if settled else True)]

    return checkpointed(pool.mapInPandas(run, schema))


def _pend(pending: dict, g, picks: list[dict], start: int) -> None:
    p = pending.setdefault(g, Pending())
    for i, x in enumerate(picks):
        p.payloads.append(x["payload"])
        p.numbers.append(start + i)
        p.rows.add(x["row"])
        for r in x["er"]:
            p.carried[int(r)] = p.carried.get(int(r), 0) + 1


PICK_SCHEMA = "grp bigint, row bigint, number int, score double, d double, closed int"


class PickLog:
    """Picks in order; long logs move to checkpointed tables."""

    def __init__(self, spark):
        self.spark, self.rows, self.tables = spark, [], []

    def add(self, g: int, picks: list[dict], start: int) -> None:
        self.rows += [
            (g, x["row"], start + i, -x["k0"], x["d"], x["closed"]) for i, x in enumerate(picks)
        ]
        if len(self.rows) > 50_000:
            self.tables.append(checkpointed(self.spark.createDataFrame(self.rows, PICK_SCHEMA)))
            self.rows = []

    def table(self) -> DataFrame:
        out = self.spark.createDataFrame(self.rows, PICK_SCHEMA)
        for t in self.tables:
            out = out.unionByName(t)
        return out


def pick_rounds(
    pool: DataFrame, rule: Rule, budgets: dict[int, int] | int | None, groups: list[int] | None = None,
    window: int = WINDOW, first_number: int = 1,
) -> tuple[DataFrame, DataFrame, dict]:
    """Picks of a few large groups (or of one ungrouped pool with ``grp`` = 0).

    Returns (picks, pool, pending): the pool still lacks the pending picks; pass both to
    :func:`fold` to bring it up to date.
    """
    log = PickLog(pool.sparkSession)
    groups = groups if groups is not None else [0]
    left = {
        g: (2**62 if budgets is None else budgets if isinstance(budgets, int) else budgets[g]) for g in groups
    }
    number = {g: first_number for g in groups}
    pending: dict[int, Pending] = {}
    active = [g for g in groups if left[g] > 0]
    per_round = max(1, ROUND_ROWS // (window + 1))
    while active:
        now = active[:per_round]
        scored = pool if len(groups) == 1 else pool.where(F.col("grp").isin(now))
        scored = scored.withColumn("k", _score_column(rule, pending))
        # The window keeps the current distance; the stored one is the state at the last fold.
        ranked = (
            scored.where("k.ok")
            .withColumn("d", F.col("k.d"))
            .withColumn("k0", F.col("k.k0"))
            .withColumn("k1", F.col("k.k1"))
            .drop("k", "near")
        )
        if len(groups) == 1:
            top = ranked.orderBy("k0", "k1", "row").limit(window + 1)
        else:
            w = Window.partitionBy("grp").orderBy("k0", "k1", "row")
            top = ranked.withColumn("_n", F.row_number().over(w)).where(F.col("_n") <= window + 1).drop("_n")
        got = {g: part.sort_values(["k0", "k1", "row"]) for g, part in top.toPandas().groupby("grp")}
        done = set()
        for g in now:
            part = got.get(g)
            if part is None:
                done.add(g)
                continue
            bound = None
            if len(part) > window:
                last = part.iloc[window]
                bound = (last["k0"], last["k1"], last["row"])
                part = part.iloc[:window]
            carried = pending[g].carried if g in pending else {}
            picks = pick_from(part.reset_index(drop=True), rule, bound, left[g], carried)
            log.add(g, picks, number[g])
            _pend(pending, g, picks, number[g])
            number[g] += len(picks)
            left[g] -= len(picks)
            if left[g] <= 0 or bound is None:
                done.add(g)
        active = [g for g in active if g not in done]
        if sum(len(p.payloads) for p in pending.values()) >= FOLD_AT and active:
            pool = fold(pool, rule, pending)
            pending = {}
    return log.table(), pool, pending
