"""Selection passes against step-by-step Python, with wide and narrow windows."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkcurate.operators import cover, coverage, greedy
from sparkcurate.plans import selection as S


class Brute:
    def __init__(self, recs):
        self.env, self.fp, self.fam = [r[0] for r in recs], [set(r[1]) for r in recs], [r[2] for r in recs]
        self.n = len(recs)
        self.atoms = Counter(e for r in self.env for e in r)
        self.mols = Counter(e for r in self.env for e in set(r))
        self.order = sorted(self.mols, key=lambda e: (self.mols[e], self.atoms[e], e))
        self.carriers = defaultdict(list)
        for i, r in enumerate(self.env):
            for e in set(r):
                self.carriers[e].append(i)
        self.sim = np.array([[len(a & b) / len(a | b) if a | b else 0.0 for b in self.fp] for a in self.fp])

    def floor(self, budget, w):
        sel, covered, ms = [], set(), np.zeros(self.n)

        def add(i):
            nonlocal ms
            sel.append(i)
            covered.update(self.env[i])
            ms = np.maximum(ms, self.sim[i])

        for e in self.order:
            if self.mols[e] == 1 and self.carriers[e][0] not in sel and len(sel) < budget:
                add(self.carriers[e][0])
        while len(sel) < budget and len(covered) < len(self.mols):
            best, top = None, -1.0
            seen = set()
            for e in self.order:
                for i in self.carriers[e] if e not in covered else []:
                    if i in sel or i in seen:
                        continue
                    seen.add(i)
                    score = w * sum(x not in covered for x in self.env[i]) + (1 - w) * (1 - ms[i])
                    if score > top:
                        best, top = i, score
            add(best)
        return sel

    def curve(self):
        sel, covered, out = [], set(), []
        forced = [self.carriers[e][0] for e in self.order if self.mols[e] == 1]
        for i in dict.fromkeys(forced):
            sel.append(i)
            covered.update(self.env[i])
            out.append((len(sel), len(covered)))
        while len(covered) < len(self.mols):
            i = max((i for i in range(self.n) if i not in sel), key=lambda i: (sum(x not in covered for x in self.env[i]), -i))
            sel.append(i)
            covered.update(self.env[i])
            out.append((len(sel), len(covered)))
        return out

    def seed(self, rows):
        m = np.zeros((len(rows), 64))
        for k, i in enumerate(rows):
            m[k, list(self.fp[i])] = 1
        mean = m.mean(axis=0)
        return rows[int(np.argmax(np.round(m @ mean / (np.sqrt(m.sum(axis=1)) * np.linalg.norm(mean) + 1e-12), 12)))]

    def maxmin(self, rows, k):
        first = self.seed(rows)
        if k >= len(rows):
            return [first] + [i for i in rows if i != first]
        out = [first]
        while len(out) < k:
            out.append(min((i for i in rows if i not in out), key=lambda i: (self.sim[i, out].max(), i)))
        return out

    def diversity(self, taken, budget, tier1_min, ff):
        fam = defaultdict(list)
        for i in range(self.n):
            if i not in taken:
                fam[self.fam[i]].append(i)
        big = {f: r for f, r in fam.items() if len(r) > tier1_min}
        k1, total = math.floor(ff * budget), sum(math.sqrt(len(r)) for r in big.values())
        out = []
        for f in sorted(big):
            out += self.maxmin(big[f], min(max(1, round(k1 * math.sqrt(len(big[f])) / total)), len(big[f])))
        rest = [i for i in range(self.n) if i not in taken and self.fam[i] not in big]
        return out + (self.maxmin(rest, budget - len(out)) if rest and budget > len(out) else [])

    def depth(self, taken, n, target, cap):
        ms = self.sim[taken].max(axis=0)
        mult = Counter(e for i in taken for e in set(self.env[i]))
        out = []
        while len(out) < n:
            options = []
            for i in range(self.n):
                gain = sum(mult[e] < target for e in self.env[i])
                if i not in taken and i not in out and gain and ms[i] <= cap:
                    options.append((-gain, ms[i], i))
            if not options:
                break
            i = min(options)[2]
            out.append(i)
            mult.update(set(self.env[i]))
            ms = np.maximum(ms, self.sim[i])
        return out


@pytest.fixture(scope="module")
def recs():
    rng = np.random.default_rng(11)
    out = []
    for i in range(70):
        envs = np.minimum(rng.geometric(0.08, size=rng.integers(2, 9)), 40).tolist() + ([100 + i] if i % 17 == 0 else [])
        bits = sorted(set(rng.choice(64, size=rng.integers(3, 20)).tolist()))
        out.append((envs, bits, ["f1", "f2", "f3", None][int(rng.integers(0, 4))] if i % 3 else "f1"))
    return out


@pytest.fixture(scope="module")
def rows(spark, recs):
    data = [(str(i), e, b, f) for i, (e, b, f) in enumerate(recs)]
    df = spark.createDataFrame(data, "CompoundID string, e array<long>, morgan_fp array<int>, scaffold string")
    df = df.withColumns({
        "atom_envs": F.transform("e", lambda x: F.array(x)), "heavy_elements": F.transform("e", lambda x: F.lit("C")),
        "smiles": F.lit(""), "mol_block": F.lit(""), "bonds": F.array(F.lit("C-C:1")), "no": F.col("CompoundID").cast("int"),
        "molwt": F.col("CompoundID").cast("double"),
    })
    return S.prepare(df, ["no"])


@pytest.fixture(params=[512, 5], ids=["wide", "narrow"])
def window(request, monkeypatch):
    defaults = tuple(request.param if v == greedy.WINDOW else v for v in greedy.pick_rounds.__defaults__)
    monkeypatch.setattr(greedy.pick_rounds, "__defaults__", defaults)
    monkeypatch.setattr(greedy, "FOLD_AT", 2048 if request.param > 5 else 6)
    monkeypatch.setattr(cover, "FOLD_AT", 2048 if request.param > 5 else 6)
    defaults = tuple(request.param if v == greedy.WINDOW else v for v in cover.lazy_rounds.__defaults__)
    monkeypatch.setattr(cover.lazy_rounds, "__defaults__", defaults)
    monkeypatch.setattr(cover, "SMALL_PAIRS", 2_000_000 if request.param > 5 else 0)
    return request.param


def test_all_passes(rows, recs, window):
    brute = Brute([(e, b, f or S.ACYCLIC) for e, b, f in recs])
    b = S.Budget(n=40, floor_budget=0.3, depth_budget=0.2, tier1_min=12, ff=0.5, depth_nn_sim=0.35)
    picks = S.select(rows, b)
    got = picks.orderBy("selection_order").collect()
    floor = brute.floor(12, b.w)
    assert len({e for e in brute.mols if brute.mols[e] == 1}) > 0
    div = brute.diversity(floor, 40 - len(floor) - 8, 12, 0.5)
    depth = brute.depth(floor + div, 8, 2, 0.35)
    per = lambda p: [r["row"] for r in got if r["pass"] == p]
    assert per("floor") == floor
    assert per("diversity") == div
    assert per("depth") == depth
    assert [r["selection_order"] for r in got] == list(range(1, len(got) + 1))
    assert {r["tier"] for r in got if r["pass"] == "diversity"} <= {"tier1", "tier2"}
    assert S.summary(picks, b)["n_selected"] == len(got)
    rep = S.reports(rows, picks, ("molwt",))
    assert rep["coverage"].count() > 0 and rep["bond_types"].first()["selected_count"] == len(got)


def test_cost_curve(rows, recs, window):
    brute = Brute([(e, b, f) for e, b, f in recs])
    ranked = S.rank_envs(coverage.env_frequency(rows, "envs", "row"))
    pool = S.env_pool(rows, ranked)
    got = S.set_cover_curve(pool, ranked.where("n_mols = 1").count()).orderBy("molecules").collect()
    assert [(r["molecules"], r["covered"]) for r in got] == brute.curve()


def test_everything_when_budget_exceeds_pool(rows):
    picks = S.select(rows, S.Budget(n=500, passes=("diversity",), tier1_min=10))
    assert picks.select("row").distinct().count() == picks.count()


def test_distinct_counts_environments_once(spark, rows, recs):
    """With ``distinct`` the passes act as if each record carried each environment once."""
    brute = Brute([(sorted(set(e)), b, f or S.ACYCLIC) for e, b, f in recs])
    brute.order = Brute([(e, b, f) for e, b, f in recs]).order
    picks = S.select(rows, S.Budget(n=40, passes=("floor",), floor_budget=0.3, distinct=True))
    assert [r["row"] for r in picks.orderBy("selection_order").collect()] == brute.floor(12, 0.4)


def test_capped_budgets_never_overshoot(spark):
    data = [(f"f{i}",) for i in range(30) for _ in range(60 + i)]
    df = spark.createDataFrame(data, "family string")
    free = S.family_budgets(df, 40, 50, 0.3).agg(F.sum("k")).first()[0]
    got = S.family_budgets(df, 40, 50, 0.3, capped=True)
    assert free == 30 and got.agg(F.sum("k")).first()[0] == 12 and got.columns == ["family", "m", "k"]


def test_unknown_pass():
    with pytest.raises(ValueError):
        S.Budget(passes=("floor", "width"))


def test_pool_counts_inside_the_record(spark):
    """Environments of a record are counted without a shuffle, and no payload is in the pool."""
    envs = [[7, 3, 7, 7, 1], [], [3, 3]]
    rows = spark.createDataFrame([(i, [(e, "C") for e in r]) for i, r in enumerate(envs)], "row bigint, envs array<struct<env:bigint,element:string>>")
    counts = rows.select("row", S.env_counts().alias("c"))
    assert "Exchange" not in counts._jdf.queryExecution().executedPlan().toString()
    assert {r["row"]: [tuple(x) for x in r["c"]] for r in counts.collect()} == {0: [(1, 1), (3, 1), (7, 3)], 1: [], 2: [(3, 2)]}
    ranked = spark.createDataFrame([(1, 1, 1), (7, 2, 1), (3, 3, 2)], "env_id bigint, rank bigint, n_mols bigint")
    assert sorted(map(tuple, S.env_pool(rows, ranked).collect())) == [(0, 1, 1, 0), (0, 2, 3, 0), (0, 3, 1, 0), (2, 3, 2, 0)]


@pytest.fixture()
def no_broadcast(monkeypatch):
    """Tables of more than five rows count as too large to broadcast."""
    monkeypatch.setattr(S, "BROADCAST_ROWS", 5)
    monkeypatch.setattr(S, "fits_broadcast", lambda df: df.limit(6).count() <= 5)


def test_pool_beyond_broadcast_is_the_same(rows, no_broadcast, monkeypatch):
    """Ranks that are broadcast and ranks that are joined by a shuffle make one pool, without a second pass over the records."""
    ranked = S.rank_envs(coverage.env_frequency(rows, "envs", "row"))
    carried = ranked.where("rank % 3 = 0").select("env_id", (F.col("rank") % 4).alias("mult"))
    got = S.env_pool(rows, ranked, carried)
    counted, real = [], coverage.counted
    monkeypatch.setattr(coverage, "counted", lambda *a: counted.append(a) or real(*a))
    S.env_pool(rows, ranked, carried)
    assert len(counted) == 1
    want = rows.select("row", F.explode(S.env_counts()).alias("e")).select("row", "e.*").join(ranked, "env_id").join(carried, "env_id", "left").select(
        "row", "rank", F.col("n").cast("bigint"), F.coalesce("mult", F.lit(0)).cast("bigint").alias("b"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_cost_curve_beyond_broadcast(rows, recs, no_broadcast):
    ranked = S.rank_envs(coverage.env_frequency(rows, "envs", "row"))
    got = S.set_cover_curve(S.env_pool(rows, ranked), ranked.where("n_mols = 1").count()).orderBy("molecules").collect()
    assert [(r["molecules"], r["covered"]) for r in got] == Brute([(e, b, f) for e, b, f in recs]).curve()


def test_selection_from_texts_equals_that_from_arrays(spark):
    """Environments read from a text give the picks and reports of those in columns."""
    from sparkcurate.functions import columns as C
    from sparkcurate.plans import queries

    rng = np.random.default_rng(9)
    texts = [" ".join(f"{'abcdefgh'[k % 8]}w{k}" for k in rng.geometric(0.06, size=rng.integers(0, 25))) for _ in range(60)]
    docs = spark.createDataFrame([(i, "en", "s", len(t), t) for i, t in enumerate(texts)], "doc_id long, lang string, source string, n_chars int, text string")
    made = queries.described(docs).join(docs.select("doc_id", "text"), "doc_id").select(
        F.col("doc_id").alias("row"), F.col("doc_id").alias("CompoundID"), C.on_bits("t").alias("morgan_fp"), "atom_envs", "heavy_elements",
        F.col("lang").alias("scaffold"), C.neighbour_pairs("t").alias("bonds"), F.col("n_chars").cast("double").alias("molwt"), "text")
    wide = S.prepare(made, ["CompoundID"])
    slim = S.prepare(made.drop("atom_envs", "heavy_elements", "bonds"), ["CompoundID"])
    assert "envs" not in slim.columns
    b = S.Budget(n=30, floor_budget=0.3, depth_budget=0.2, tier1_min=12, depth_nn_sim=0.9)
    want, got = S.select(wide, b), S.select(slim, b, queries.ENVS)
    rows_of = lambda df: sorted(map(repr, df.collect()))
    assert got.count() and rows_of(got) == rows_of(want)
    old, new = S.reports(wide, want, ("molwt",)), S.reports(slim, got, ("molwt",), queries.ENVS, queries.PAIRS)
    for name in ("coverage", "thin_coverage", "bond_types"):
        assert rows_of(new[name]) == rows_of(old[name]), name
