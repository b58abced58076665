"""Bounded search of the nearest pick by RMSD: the same distances as all superpositions, most of which are left out."""

import numpy as np
import pytest

from sparkcurate.functions import geometry as G
from sparkcurate.operators.maxmin import farthest_first


def frames(rng, n, atoms):
    xyz = rng.normal(size=(n, atoms, 3)) * rng.uniform(0.3, 1.0, size=(n, 1, 1))
    xyz[:3, :, 1:] = 0  # on a line
    xyz[3:6, :, 2] = 0  # in a plane
    xyz[6] = 0
    xyz[7:9] = xyz[9], xyz[9] * [1, 1, -1]  # a copy and a mirror image
    return xyz


@pytest.mark.parametrize("atoms", [1, 2, 3, 16])
@pytest.mark.parametrize("normalized", [False, True])
def test_nearer_equals_all_superpositions(atoms, normalized):
    rng = np.random.default_rng(atoms)
    metric, xyz = G.ordered_rmsd(normalized), frames(rng, 400, atoms)
    picks = xyz[rng.permutation(400)[:150]]
    full = metric.between(xyz, picks)
    for d in (np.full(400, 1e300), full[:, :20].min(axis=1), np.full(400, np.median(full))):
        val, first = metric.nearer(xyz)(picks, d)
        want = full.min(axis=1)
        # At zero a superposition is exact to half the digits only.
        below = want < d - 1e-7
        assert np.allclose(val[below], want[below], rtol=1e-9, atol=1e-7) and np.isinf(val[want > d + 1e-7]).all()
        clear = below & (np.sort(full, axis=1)[:, 1] > want + 1e-6)
        assert (first[clear] == full.argmin(axis=1)[clear]).all()


def test_few_pairs_are_superposed(monkeypatch):
    rng, pairs, items = np.random.default_rng(5), [], G._rmsd_items
    monkeypatch.setattr(G, "_rmsd_items", lambda xs, ys: pairs.append(len(xs)) or items(xs, ys))
    xyz = rng.normal(size=(2000, 16, 3)) / 8
    val, _ = G.ordered_rmsd().nearer(xyz)(xyz[:300], np.full(2000, 1e300))
    assert np.isfinite(val).all() and sum(pairs) < 2000 * 300 / 20


def test_other_shapes_and_the_transposed_variant():
    rng = np.random.default_rng(6)
    mixed = [rng.normal(size=(k, 3)).tolist() for k in (4, 5, 4, 5, 5)]
    for metric in (G.ordered_rmsd(), G.ordered_rmsd(transposed=True)):
        made = metric.prepare(mixed)
        val, first = metric.nearer(made)(made[[1, 3]], np.full(5, 1e300))
        assert np.isinf(val[[0, 2]]).all() and np.allclose(val[[1, 3]], 0, atol=1e-6) and first.tolist()[1::2] == [0, 1]
        same = metric.prepare(mixed[1::2])
        val, first = metric.nearer(same)(metric.prepare([mixed[4]]), np.full(2, 1e300))
        assert np.allclose(val, metric.pairwise(mixed[1::2], [mixed[4]])[:, 0]) and first.tolist() == [0, 0]


@pytest.mark.parametrize("light", [1000, 10])
def test_farthest_first_by_rmsd(spark, light):
    """Picks, nearest picks and distances are those of all pairs, whichever way a group goes."""
    rng, metric, cut = np.random.default_rng(8), G.ordered_rmsd(), 0.3
    base = rng.normal(size=(12, 6, 3)) / 3
    xyz = [(base[i % 12] + rng.normal(size=(6, 3)) * 0.08).tolist() for i in range(150)]
    xyz += [xyz[3], rng.normal(size=(4, 3)).tolist(), rng.normal(size=(4, 3)).tolist()]
    rows = [(i, "a" if i % 5 else "b", p) for i, p in enumerate(xyz)]
    df = spark.createDataFrame(rows, "row long, g string, p array<array<double>>")
    got = {r["row"]: r for r in farthest_first(df, ["g"], "row", "p", metric, cut, light=light, window=8).collect()}
    for g in "ab":
        at = [i for i, k, _ in rows if k == g]
        d = np.array([[G.kabsch_rmsd(np.array(xyz[i]), np.array(xyz[j])) for j in at] for i in at])
        picks, score = [0], {0: None}
        while True:
            near = d[:, picks].min(axis=1)
            near[picks] = -1
            best = int(near.argmax())
            if near[best] < cut:
                break
            score[best] = near[best]
            picks.append(best)
        for k, i in enumerate(at):
            r = got.pop(i)
            assert r["number"] == (picks.index(k) + 1 if k in picks else None)
            assert r["near"] == (picks.index(k) + 1 if k in picks else int(d[k, picks].argmin()) + 1)
            if k and np.isfinite(want := score.get(k, d[k, picks].min())):
                assert r["d"] == pytest.approx(want, abs=1e-6)
    assert not got


def test_conformers_by_both_ways(spark):
    from sparkcurate.operators.maxmin import conformer_filter

    rng = np.random.default_rng(9)
    base = rng.normal(size=(20, 6, 3)) / 3
    rows = [(i, f"c{i % 3}" if i % 41 else None, (base[i % 20] + rng.normal(size=(6, 3)) * 0.05).tolist() if i % 37 else None, float(i * 7 % 50)) for i in range(240)]
    df = spark.createDataFrame(rows, "row long, key string, xyz array<array<double>>, e double")
    one, two = (
        sorted(conformer_filter(df, "key", "row", "xyz", "e", 0.25, light=light).select("row", "conformer_status", "cluster_id").collect())
        for light in (None, 10))
    assert one == two and {r.conformer_status for r in one} == {"kept", "removed_conformer", "mol_corrupt", "no_compound_id"}
