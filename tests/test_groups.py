"""Grouped kernels: brute force equals the small-group and the large-group path."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sparkcurate.functions.geometry import cosine, permuted_rmsd
from sparkcurate.operators.leader import leader_clusters, near_dedup
from sparkcurate.operators.maxmin import farthest_first
from sparkcurate.operators.nearest import tanimoto_nearest


def points(seed=0, n=90, copies=30):
    """Two groups; one vector has many near copies and holds a third of the rows."""
    rng = np.random.default_rng(seed)
    base = rng.normal(size=6)
    rows = [(i, "a" if i % 9 else "b", rng.normal(size=6).tolist()) for i in range(n - copies)]
    rows += [(n - copies + i, "a", (base + rng.normal(size=6) * 1e-3).tolist()) for i in range(copies)]
    rng.shuffle(rows)
    return [(i, g, v) for i, (_, g, v) in enumerate(rows)]


def groups(rows):
    out = {}
    for r, g, v in rows:
        out.setdefault(g, []).append((r, v))
    return out


def brute_maxmin(rows, cut, covered=None):
    number = {}
    for part in groups(rows).values():
        d = cosine().pairwise([v for _, v in part], [v for _, v in part])
        sel = [0]
        while len(sel) < len(part):
            near = d[:, sel].min(axis=1)
            if covered and np.mean([(i in sel) or near[i] < cut for i in range(len(part))]) >= covered:
                break
            rest = [i for i in range(len(part)) if i not in sel]
            j = max(rest, key=lambda i: (near[i], -i))
            if not covered and near[j] < cut:
                break
            sel.append(j)
        number |= {part[i][0]: k for k, i in enumerate(sel, 1)}
        number |= {part[i][0]: -(int(d[i, sel].argmin()) + 1) for i in range(len(part)) if i not in sel}
    return number


@pytest.mark.parametrize("covered", [None, 0.95])
@pytest.mark.parametrize("light", [1000, 10])
def test_farthest_first(spark, light, covered):
    rows = points()
    df = spark.createDataFrame(rows, "row long, g string, v array<double>")
    got = farthest_first(df, ["g"], "row", "v", cosine(), 0.4, covered=covered, light=light, window=8).collect()
    assert {r["row"]: r["number"] if r["number"] else -r["near"] for r in got} == brute_maxmin(rows, 0.4, covered)


def brute_leader(rows, cut):
    rep = {}
    for part in groups(rows).values():
        kept = []
        for r, v in part:
            d = cosine().pairwise([v], [k for _, k in kept])[0] if kept else np.array([])
            if len(d) and d.min() < cut:
                rep[r] = kept[int(d.argmin())][0]
            else:
                kept.append((r, v))
                rep[r] = r
    return rep


@pytest.mark.parametrize("cut", [0.5, 0.02])
@pytest.mark.parametrize("light", [1000, 10])
def test_leader_clusters(spark, light, cut):
    rows = points(1)
    df = spark.createDataFrame(rows, "row long, g string, v array<double>").repartition(5)
    got = leader_clusters(df, ["g"], "row", "v", cosine(), cut, light=light, offer=5, block=12).collect()
    assert {r["row"]: r["rep"] for r in got} == brute_leader(rows, cut)


def test_cluster_numbers_follow_first_seen_groups(spark):
    rows = [(0, "b", [1.0, 0.0]), (1, "a", [1.0, 0.0]), (2, "b", [0.0, 1.0]), (3, "a", [1.0, 0.001]), (4, "a", [0.0, 1.0])]
    df = spark.createDataFrame(rows, "row long, g string, v array<double>")
    got = {r["row"]: (r["dedup_status"], r["cluster_id"]) for r in near_dedup(df, ["g"], "row", "v", cosine(), 0.1).collect()}
    assert got == {0: ("kept", 1), 2: ("kept", 2), 1: ("kept", 3), 3: ("near_dup", 3), 4: ("kept", 4)}


@pytest.mark.parametrize("light", [1000, 4])
def test_leader_on_geometries(spark, light):
    rng = np.random.default_rng(4)
    shapes = [rng.normal(size=(5, 3)) * 2 for _ in range(4)]
    rows = []
    for i in range(24):
        q, _ = np.linalg.qr(rng.normal(size=(3, 3)))
        xyz = (shapes[i % 4] + rng.normal(size=(5, 3)) * 0.01) @ (q * np.sign(np.linalg.det(q)))
        rows.append((i, [[6.0, *p] for p in xyz.tolist()]))
    df = spark.createDataFrame(rows, "row long, p array<array<double>>").withColumn("g", F.lit(1))
    got = leader_clusters(df, ["g"], "row", "p", permuted_rmsd(), 0.25, light=light, offer=3, block=6).collect()
    assert {r["row"]: r["rep"] for r in got} == {i: i % 4 for i in range(24)}


@pytest.mark.parametrize("light, block", [(1000, 2000), (5, 2000), (5, 20)])
def test_tanimoto_nearest(spark, light, block):
    rng = np.random.default_rng(2)
    sets = [sorted(set(rng.choice(60, size=rng.integers(1, 15)).tolist())) for _ in range(50)]
    sets += [sorted({1, 2, 3, 4, 5, 6, 7, 8, 9, 10 + i}) for i in range(25)] + [sets[0], [], [], None, [999]]
    df = spark.createDataFrame(list(enumerate(sets)), "id long, bits array<int>")
    got = {r["id"]: r["max_tanimoto"] for r in tanimoto_nearest(df, "id", "bits", block=block, light=light).collect()}
    for i, a in enumerate(sets):
        if a is None:
            assert got[i] is None
            continue
        best = max((len(set(a) & set(b)) / max(len(set(a) | set(b)), 1) for j, b in enumerate(sets) if j != i and b is not None))
        assert got[i] == pytest.approx(best, abs=1e-12), i
    lone = spark.createDataFrame([(1, [1]), (2, None)], "id long, bits array<int>")
    assert [r["max_tanimoto"] for r in tanimoto_nearest(lone, "id", "bits").collect()] == [None, None]


def test_tanimoto_blocks_hold_each_set_once(spark, monkeypatch):
    """However many pairs of blocks meet, the sets are written once."""
    from sparkcurate.operators import nearest

    tables, write = [], nearest.stored
    monkeypatch.setattr(nearest, "stored", lambda df: tables.append(write(df)) or tables[-1])
    rng = np.random.default_rng(5)
    sets = [sorted(set(rng.choice(300, size=40).tolist())) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(sets)), "id long, bits array<int>")
    got = {r["id"]: r["max_tanimoto"] for r in tanimoto_nearest(df, "id", "bits", block=10, light=0).collect()}
    packed = [t for t in tables if "best" in t.columns][0].collect()
    assert len(packed) == 12 and sum(len(r["bits"]) for r in packed) == 8 * sum(map(len, sets))
    for i, a in enumerate(sets):
        assert got[i] == max(len(set(a) & set(b)) / len(set(a) | set(b)) for j, b in enumerate(sets) if j != i)


@pytest.mark.parametrize("direct", [1 << 22, 300])
def test_tanimoto_blocks_are_bounded_by_bits(spark, monkeypatch, direct):
    """Blocks of large sets hold few of them, and the answer is the same."""
    from sparkcurate.operators import nearest

    tables, write = [], nearest.stored
    monkeypatch.setattr(nearest, "stored", lambda df: tables.append(write(df)) or tables[-1])
    monkeypatch.setattr(nearest, "BLOCK_BITS", 2000)
    monkeypatch.setattr(nearest, "DIRECT", direct)
    rng = np.random.default_rng(6)
    sets = [sorted(set(rng.choice(700, size=rng.integers(20, 400)).tolist())) for _ in range(80)]
    df = spark.createDataFrame(list(enumerate(sets)), "id long, bits array<int>")
    got = {r["id"]: r["max_tanimoto"] for r in tanimoto_nearest(df, "id", "bits", light=0).collect()}
    packed = [t for t in tables if "best" in t.columns][0].collect()
    assert max(len(r["bits"]) for r in packed) <= 8 * (2000 + 400)
    for i, a in enumerate(sets):
        assert got[i] == max(len(set(a) & set(b)) / len(set(a) | set(b)) for j, b in enumerate(sets) if j != i)


@pytest.mark.parametrize("cut", [None, 0.6])
def test_nearest_of_many_picks_in_slices(spark, monkeypatch, cut):
    """Picks that come in slices give the distance and the first pick of all of them together."""
    from sparkcurate.functions.geometry import tanimoto_distance
    from sparkcurate.operators import maxmin

    monkeypatch.setattr(maxmin, "FOLD_AT", 7)
    rng = np.random.default_rng(8)
    sets = [sorted(set(rng.choice(30, size=rng.integers(1, 9)).tolist())) for _ in range(90)] + [[], [29]]
    rows = [(i % 2, i, s) for i, s in enumerate(sets)]
    picks = [(i % 2, 1000 - i, s) for i, s in enumerate(sets[::2] + sets[1::2] + sets[:9])]
    df = spark.createDataFrame(rows, "grp bigint, row bigint, payload array<int>")
    pf = spark.createDataFrame(picks, "grp bigint, number bigint, payload array<int>")
    got = maxmin.assign_nearest(df, pf, tanimoto_distance(), cut, slice_at=20).collect()
    assert len(got) == len(rows)
    for r in got:
        d = [(1.0 - len(set(r["payload"]) & set(p)) / max(len(set(r["payload"]) | set(p)), 1), n) for g, n, p in picks if g == r["grp"]]
        assert (r["d"], r["near"]) == min(d)
        assert r["first"] == (min((n for v, n in d if v < cut), default=maxmin.NO_BUDGET) if cut else maxmin.NO_BUDGET)
