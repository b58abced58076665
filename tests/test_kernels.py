"""Numeric kernels against golden values and rigid motions."""

import math

import numpy as np
import pytest

from sparkcurate.functions import geometry as G

LI4 = np.array([[0.0, 0, 0], [2.5, 0, 0], [0, 2.7, 0], [0.3, 0.4, 2.9]])


def rotation(seed):
    q, _ = np.linalg.qr(np.random.default_rng(seed).normal(size=(3, 3)))
    return q * np.sign(np.linalg.det(q))


def test_two_points():
    a, b = np.array([[0, 0, 0], [1.0, 0, 0]]), np.array([[0, 0, 0], [4.0, 0, 0]])
    assert G.kabsch_rmsd(a, b) == pytest.approx(1.5)


def test_rigid_motion_and_mirror():
    moved = LI4 @ rotation(3) + 5
    assert G.kabsch_rmsd(LI4, moved) < 1e-9
    assert G.kabsch_rmsd(LI4, LI4 * [1, 1, -1]) > 0.1


def test_permuted_copies_and_mismatch():
    z = np.array([3, 3, 3, 3])
    order = [2, 0, 3, 1]
    assert G.conformer_rmsd(z, LI4, z, (LI4 @ rotation(1) + 1)[order]) < 1e-9
    assert math.isinf(G.conformer_rmsd(z, LI4, np.array([3, 3, 3, 1]), LI4))
    none = np.zeros((0, 3))
    assert G.conformer_rmsd(np.array([], int), none, np.array([], int), none) == 0.0
    assert G.conformer_rmsd(np.array([1]), LI4[:1], np.array([1]), LI4[1:2]) == pytest.approx(0.0)


def test_stacked_equals_single():
    rng = np.random.default_rng(0)
    xs, ys = rng.normal(size=(5, 6, 3)), rng.normal(size=(7, 6, 3))
    for flag in (False, True):
        want = [[G.kabsch_rmsd(x, y, flag) for y in ys] for x in xs]
        assert np.allclose(G.ordered_rmsd(transposed=flag).pairwise(list(xs), list(ys)), want)


@pytest.mark.parametrize("metric, make", [
    (G.permuted_rmsd(), lambda r: np.column_stack([np.sort(r.integers(1, 3, 6)) * 0 + [1, 1, 6, 6, 8, 8], r.normal(size=(6, 3))])),
    (G.ordered_rmsd(True), lambda r: r.normal(size=(5, 3))),
    (G.cosine(), lambda r: r.normal(size=8)),
])
def test_feature_never_differs_by_more_than_the_reach(metric, make):
    rng = np.random.default_rng(5)

    items = [make(rng) for _ in range(12)]
    d, f = metric.pairwise(items, items), metric.feature(items)
    for i in range(12):
        for j in range(12):
            assert abs(f[i] - f[j]) <= metric.reach(max(d[i, j], 0)) + 1e-9


def test_tanimoto_distance():
    d = G.tanimoto_distance().pairwise([[0, 1, 2], []], [[2, 3], [0, 1, 2], [], [9]])
    assert d.tolist() == [[0.75, 0.0, 1.0, 1.0], [1.0, 1.0, 1.0, 1.0]]


def test_stacked_distances_equal_those_pair_by_pair():
    rng = np.random.default_rng(5)

    def structure(n):
        return [[float(z), *p] for z, p in zip(rng.integers(1, 4, n), np.round(rng.normal(size=(n, 3)), int(rng.integers(0, 3))))]

    items = [structure(n) for n in (0, 1, 2, 5, 5, 9, 9, 9) for _ in range(3)]
    items += [[items[-1][i] for i in rng.permutation(9)], items[-2], []]
    m = G.permuted_rmsd()
    made = m.prepare(items)
    i, j = np.divmod(np.arange(len(items) ** 2), len(items))
    want = [G.conformer_rmsd(*(np.array(items[k]).reshape(-1, 4)[:, s] for k in (a, b) for s in (0, slice(1, 4)))) for a, b in zip(i, j)]
    assert m.items(made[i], made[j]).tolist() == want
    assert m.pairwise(items, items).ravel().tolist() == want


def test_closest_by_tanimoto_is_the_first_of_the_nearest():
    rng = np.random.default_rng(3)
    sets = [sorted(set(rng.choice(40, size=rng.integers(0, 12)).tolist())) for _ in range(80)]
    m = G.tanimoto_distance()
    xs, ys = sets[:50], [*sets[30:], *sets[40:60], []]
    for d in (np.full(50, np.inf), np.full(50, 1.0), rng.uniform(0, 1, 50)):
        val, first = m.closest(xs, ys, d)
        want, at = G._nearest(m.pairwise(xs, ys), d)
        assert (val == want).all() and (first == at)[np.isfinite(val)].all()
