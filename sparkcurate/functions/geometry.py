"""Distance kernels on small bounded arrays, for use inside Arrow tasks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np

# Fixed value: refinements after the first pairing of a permutation-aware RMSD.
REMATCHES = 5
# Entries of the distance matrices that one step of stacked structures holds.
STACKED = 500_000
# Pairs whose covariances one step of a bounded search holds, and the part of the squared sizes that its closed form may be off.
BOUNDED = 32_768
MARGIN = 1e-3


def _superpose(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Proper rotation R and the two centroids that carry ``b`` onto ``a``."""
    ma, mb = a.mean(axis=0), b.mean(axis=0)
    u, _, vt = np.linalg.svd((b - mb).T @ (a - ma))
    if np.linalg.det(u @ vt) < 0:
        u[:, 2] = -u[:, 2]
    return u @ vt, ma, mb


def kabsch_rmsd(a: np.ndarray, b: np.ndarray, transposed: bool = False) -> float:
    """RMSD of two equally ordered point sets after the best proper rotation.

    ``transposed`` applies the rotation the other way round; it is only for matching
    results made with that variant, which overestimates for rotated copies.
    """
    if a.shape != b.shape:
        return float("inf")
    if len(a) == 0:
        return 0.0
    rot, ma, mb = _superpose(a, b)
    moved = (b - mb) @ (rot.T if transposed else rot)
    return float(np.sqrt(((a - ma - moved) ** 2).sum() / len(a)))


def _stacked_rmsd(xs: np.ndarray, ys: np.ndarray, transposed: bool) -> np.ndarray:
    """:func:`kabsch_rmsd` of all pairs of two stacks of equally sized point sets."""
    xs, ys = xs - xs.mean(axis=1, keepdims=True), ys - ys.mean(axis=1, keepdims=True)
    out = np.empty((len(xs), len(ys)))
    step = max(1, 200_000 // max(1, ys.shape[0] * ys.shape[1]))
    for lo in range(0, len(xs), step):
        x = xs[lo : lo + step]
        u, _, vt = np.linalg.svd(np.einsum("kmi,nmj->nkij", ys, x))
        u[np.linalg.det(u @ vt) < 0, :, 2] *= -1
        rot = u @ vt
        moved = np.einsum("kmi,nkji->nkmj" if transposed else "kmi,nkij->nkmj", ys, rot)
        out[lo : lo + step] = np.sqrt(((x[:, None] - moved) ** 2).sum(axis=(2, 3)) / x.shape[1])
    return out


def _profile_order(zs: np.ndarray, xyz: np.ndarray) -> np.ndarray:
    """Atom order by element, sorted distances to each element, then position."""
    if not len(zs):
        return np.zeros(0, dtype=int)
    gaps = np.linalg.norm(xyz[:, None, :] - xyz[None, :, :], axis=2)
    np.fill_diagonal(gaps, np.inf)  # the atom itself comes last, for all atoms of its element alike
    profile = np.concatenate([np.sort(gaps[:, zs == k], axis=1) for k in np.unique(zs)], axis=1)
    return np.lexsort((*xyz.T[::-1], *profile.T[::-1], zs))


def _nearest_pairs(same: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each atom of ``a`` its partner in ``b``, taking the shortest free pair first."""
    gap = np.linalg.norm(a[:, None, :] - b[None, :, :], axis=2)
    ii, jj = np.nonzero(same)
    partner = np.full(len(a), -1)
    taken = np.zeros(len(b), dtype=bool)
    for k in np.lexsort((jj, ii, gap[ii, jj])):
        i, j = ii[k], jj[k]
        if partner[i] < 0 and not taken[j]:
            partner[i], taken[j] = j, True
    return partner


def conformer_rmsd(za: np.ndarray, a: np.ndarray, zb: np.ndarray, b: np.ndarray) -> float:
    """RMSD over rotations, translations and same-element permutations (greedy matching)."""
    return _matched_rmsd(*_profiled(za, a), *_profiled(zb, b))


def _profiled(zs: np.ndarray, xyz: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = _profile_order(zs, xyz)
    return zs[order], xyz[order]


def _matched_rmsd(za: np.ndarray, a: np.ndarray, zb: np.ndarray, b: np.ndarray) -> float:
    """:func:`conformer_rmsd` of structures whose atoms are in profile order already."""
    if not np.array_equal(za, zb):  # the profile order sorts by element first
        return float("inf")
    if len(za) == 0:
        return 0.0
    z = za
    same = z[:, None] == z[None, :]
    partner, tried, best = np.arange(len(z)), [], float("inf")
    while len(tried) <= REMATCHES and not any(np.array_equal(partner, t) for t in tried):
        tried.append(partner)
        rot, ma, mb = _superpose(a, b[partner])
        b = (b - mb) @ rot + ma
        best = min(best, float(np.sqrt(((a - b[partner]) ** 2).sum() / len(z))))
        partner = _nearest_pairs(same, a, b)
    return best


def _stacked_pairs(same: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """:func:`_nearest_pairs` of two stacks of structures, item by item.

    A free pair that is the shortest of both its atoms is taken by the shortest-first rule too, so all
    of those are taken at once.
    """
    gap = np.zeros((len(a), *same.shape))
    for k in range(3):
        gap += (a[:, :, None, k] - b[:, None, :, k]) ** 2
    gap = np.sqrt(gap)
    gap[:, ~same] = np.inf
    partner = np.full(a.shape[:2], -1)
    left = np.arange(len(a))
    while len(left):
        to, back = gap.argmin(axis=2), gap.argmin(axis=1)
        mutual = (np.take_along_axis(back, to, axis=1) == np.arange(len(same))) & np.isfinite(gap.min(axis=2))
        item, i = np.nonzero(mutual)
        if not len(item):
            break
        j = to[item, i]
        partner[left[item], i] = j
        gap[item, i, :] = np.inf
        gap[item, :, j] = np.inf
        more = (partner[left] < 0).any(axis=1)
        left, gap = left[more], gap[more]
    return partner


def _stacked_matched(z: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """:func:`_matched_rmsd` of two stacks of structures with the same elements, item by item."""
    n = len(z)
    best = np.full(len(a), np.inf if n else 0.0)
    if not n:
        return best
    same = z[:, None] == z[None, :]
    at, tried = np.arange(len(a)), []
    partner = np.tile(np.arange(n), (len(a), 1))
    pick = lambda ps: np.take_along_axis(b, ps[:, :, None], axis=1)
    for turn in range(REMATCHES + 1):
        tried.append(partner)
        ma, mb = a.mean(axis=1, keepdims=True), pick(partner).mean(axis=1, keepdims=True)
        u, _, vt = np.linalg.svd(np.swapaxes(pick(partner) - mb, 1, 2) @ (a - ma))
        u[np.linalg.det(u @ vt) < 0, :, 2] *= -1
        b = (b - mb) @ (u @ vt) + ma
        best[at] = np.minimum(best[at], np.sqrt(((a - pick(partner)) ** 2).sum(axis=(1, 2)) / n))
        if turn == REMATCHES:
            break
        partner = _stacked_pairs(same, a, b)
        new = ~np.any([(partner == t).all(axis=1) for t in tried], axis=0)
        at, a, b, partner, tried = at[new], a[new], b[new], partner[new], [t[new] for t in tried]
        if not len(at):
            break
    return best


def _matched_items(xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """:func:`_matched_rmsd` of ``xs[k]`` and ``ys[k]`` for all k; items of one composition go through numpy together."""
    out = np.full(len(xs), np.inf)
    kinds: dict[bytes, list[int]] = {}
    for k, ((za, _), (zb, _)) in enumerate(zip(xs, ys, strict=True)):
        if za is zb or np.array_equal(za, zb):
            kinds.setdefault(za.tobytes(), []).append(k)
    for rows in kinds.values():
        z = xs[rows[0]][0]
        step = max(1, STACKED // max(1, len(z)) ** 2)
        for lo in range(0, len(rows), step):
            part = rows[lo : lo + step]
            out[part] = _stacked_matched(z, np.stack([xs[k][1] for k in part]), np.stack([ys[k][1] for k in part]))
    return out


def _nearest(m: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    best = m.argmin(axis=1)
    val = m[np.arange(len(m)), best]
    return np.where(val < d, val, np.inf), best


def _rmsd_items(xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
    """:func:`kabsch_rmsd` of ``xs[k]`` and ``ys[k]`` for all k."""
    xs, ys = xs - xs.mean(axis=1, keepdims=True), ys - ys.mean(axis=1, keepdims=True)
    u, _, vt = np.linalg.svd(np.swapaxes(ys, 1, 2) @ xs)
    u[np.linalg.det(u @ vt) < 0, :, 2] *= -1
    return np.sqrt(((xs - ys @ (u @ vt)) ** 2).sum(axis=(1, 2)) / xs.shape[1])


def _overlap(c: np.ndarray) -> np.ndarray:
    """Sum of the singular values of 3x3 matrices (9, k), the smallest with the sign of the determinant, in closed form.

    It is off by up to some 1e-4 of the largest one where the matrix is nearly singular.
    """
    a, b, d = c[0:3], c[3:6], c[6:9]
    aa, bb, dd = (a * a).sum(axis=0), (b * b).sum(axis=0), (d * d).sum(axis=0)
    ab, ad, bd = (a * b).sum(axis=0), (a * d).sum(axis=0), (b * d).sum(axis=0)
    mid = (aa + bb + dd) / 3
    x, y, z = aa - mid, bb - mid, dd - mid
    p = np.sqrt((x * x + y * y + z * z + 2 * (ab * ab + ad * ad + bd * bd)) / 6)
    half = (x * (y * z - bd * bd) - ab * (ab * z - bd * ad) + ad * (ab * bd - y * ad)) / 2
    turn = np.arccos(np.clip(half / np.maximum(p * p * p, 1e-300), -1, 1)) / 3
    high, low = mid + 2 * p * np.cos(turn), mid + 2 * p * np.cos(turn + 2 * np.pi / 3)
    det = a[0] * (b[1] * d[2] - b[2] * d[1]) - a[1] * (b[0] * d[2] - b[2] * d[0]) + a[2] * (b[0] * d[1] - b[1] * d[0])
    root = lambda v: np.sqrt(np.maximum(v, 0))
    return root(high) + root(3 * mid - high - low) + np.copysign(root(low), det)


def _against_rmsd(made: np.ndarray, between: Callable, scale: float) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """:meth:`Metric.nearer` for stacked point sets of one size, with distances divided by ``scale``.

    Three steps, each for what the one before leaves: a bound from the norm of the covariance, the RMSD in closed form
    with a margin, and the superposition itself. So the distances are those of the superposition.
    """
    n = made.shape[1]
    # One row per axis and structure, so that all covariances are one product.
    flat = np.ascontiguousarray((made - made.mean(axis=1, keepdims=True)).transpose(2, 0, 1))
    norm = (flat**2).sum(axis=(0, 2)) / n

    def near(picks: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if picks.shape[1:] != made.shape[1:] or not np.isfinite(picks).all():
            return _nearest(between(made, picks), d)
        ys = np.ascontiguousarray((picks - picks.mean(axis=1, keepdims=True)).transpose(2, 1, 0))
        size = (ys**2).sum(axis=(0, 1)) / n
        best, first = np.array(d, dtype=float), np.full(len(made), -1)
        wide = min(len(picks), 64)
        step = max(1, BOUNDED // wide)
        for lo in range(0, len(made), step):
            x, e, held, at = flat[:, lo : lo + step], norm[lo : lo + step], best[lo : lo + step], first[lo : lo + step]
            for start in range(0, len(picks), wide):
                y, both = ys[:, :, start : start + wide], e[:, None] + size[start : start + wide]
                cov = np.empty((9, *both.shape))
                for i in range(3):
                    for j in range(3):
                        np.matmul(x[i], y[j], out=cov[3 * i + j])
                most = np.minimum(held * scale, 1e150)[:, None] ** 2 + MARGIN * both
                row, col = np.nonzero(both - 2 / n * np.sqrt(3 * np.einsum("kij,kij->ij", cov, cov)) <= most)
                about = both[row, col] - 2 / n * _overlap(cov[:, row, col])
                least = np.full(len(held), np.inf)
                np.minimum.at(least, row, about)
                close = np.flatnonzero(about <= np.minimum(most[row, col], least[row] + MARGIN * both[row, col]))
                row, col = row[close], col[close]
                if not len(row):
                    continue
                exact = _rmsd_items(made[lo + row], picks[start + col]) / scale
                order = np.lexsort((col, exact, row))
                order = order[np.r_[True, np.diff(row[order]) > 0]]
                order = order[exact[order] < held[row[order]]]
                held[row[order]], at[row[order]] = exact[order], start + col[order]
        return np.where(first >= 0, best, np.inf), np.maximum(first, 0)

    return near


@dataclass(frozen=True)
class Metric:
    """A distance between payloads, and a feature that never differs by more than it.

    ``feature`` may be scaled: two payloads closer than ``thr`` have features that differ
    by less than ``reach(thr)``. ``prepare`` turns a list of payloads once into an array that
    can be indexed, and ``between`` gives the distances of two such arrays. A metric that is not
    ``vectorized`` has ``items``: the distances of two such arrays item by item.
    """

    pairwise: Callable[[list, list], np.ndarray]
    feature: Callable[[list], np.ndarray]
    reach: Callable[[float], float]
    prepare: Callable[[list], np.ndarray]
    between: Callable[[np.ndarray, np.ndarray], np.ndarray]
    vectorized: bool = True
    items: Callable[[np.ndarray, np.ndarray], np.ndarray] | None = None
    against: Callable[[np.ndarray], Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]] | None = None
    closest: Callable[[list, list, np.ndarray], tuple[np.ndarray, np.ndarray]] | None = None

    def nearer(self, made: np.ndarray) -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Function of prepared picks and of a distance per row: the distance of the nearest pick where it is below
        that, else infinite, and the first pick that has it. ``against`` makes one that leaves out what bounds exclude."""
        return (lambda picks, d: _nearest(self.between(made, picks), d)) if self.against is None else self.against(made)

    def nearest(self, xs: list, ys: list, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`nearer` of payloads ``xs`` for the picks ``ys``; ``closest`` gives it without all distances."""
        if self.closest is not None and len(xs) and len(ys):
            return self.closest(xs, ys, d)
        return _nearest(self.pairwise(xs, ys), d) if self.against is None else self.against(self.prepare(xs))(self.prepare(ys), d)

    def near(self, made: np.ndarray, features: np.ndarray, i: int, others: np.ndarray, cut: float) -> np.ndarray:
        """Distances of prepared payload ``i`` to ``others`` below ``cut``; else infinite."""
        if self.vectorized:
            m = self.between(made[[i]], made[others])[0]
            return np.where(m < cut, m, np.inf)
        out = np.full(len(others), np.inf)
        close = np.flatnonzero(np.abs(features[others] - features[i]) <= self.reach(cut) * (1 + 1e-9))
        if len(close):
            m = self.items(made[np.full(len(close), i)], made[others[close]])
            out[close] = np.where(m < cut, m, np.inf)
        return out

    def within(self, xs: list, ys: list, cut: float) -> np.ndarray:
        """Distances below ``cut``; other entries are infinite.

        A distance computed item by item is left out where the features already exclude it.
        """
        if not len(xs) or not len(ys):
            return np.full((len(xs), len(ys)), np.inf)
        if self.vectorized:
            m = self.pairwise(xs, ys)
            return np.where(m < cut, m, np.inf)
        gap = np.abs(self.feature(xs)[:, None] - self.feature(ys)[None, :])
        out = np.full(gap.shape, np.inf)
        a, b = self.prepare(xs), self.prepare(ys)
        ii, jj = np.nonzero(gap <= self.reach(cut) * (1 + 1e-9))
        for lo in range(0, len(ii), 4096):
            i, j = ii[lo : lo + 4096], jj[lo : lo + 4096]
            m = self.items(a[i], b[j])
            out[i, j] = np.where(m < cut, m, np.inf)
        return out


def _ragged(items: list) -> np.ndarray:
    """Items of different shapes as an array that can be indexed."""
    out = np.empty(len(items), dtype=object)
    for i, x in enumerate(items):
        out[i] = x
    return out


def _points(payload) -> np.ndarray:
    return np.asarray([list(p) for p in payload], dtype=float).reshape(-1, 3)


def _atoms(payload) -> tuple[np.ndarray, np.ndarray]:
    rows = np.asarray([list(p) for p in payload], dtype=float).reshape(-1, 4)
    return rows[:, 0].astype(int), rows[:, 1:]


def _spread(xyz: np.ndarray) -> float:
    return float(np.sqrt(((xyz - xyz.mean(axis=0)) ** 2).sum() / len(xyz))) if len(xyz) else 0.0


def ordered_rmsd(normalized: bool = False, transposed: bool = False) -> Metric:
    """Kabsch RMSD of payloads ``[[x,y,z], ...]`` in one atom order."""

    def prepare(ps: list) -> np.ndarray:
        lens = {len(p) for p in ps}
        if len(lens) != 1 or lens == {0}:
            return _ragged([_points(p) for p in ps])
        return np.concatenate([q for p in ps for q in p]).astype(float).reshape(len(ps), -1, 3)

    def between(xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
        shapes = {x.shape for x in (*xs, *ys)}
        if len(shapes) == 1 and len(xs[0]):
            d = _stacked_rmsd(np.stack(xs), np.stack(ys), transposed)
        else:
            d = np.array([[kabsch_rmsd(x, y, transposed) for y in ys] for x in xs]).reshape(len(xs), len(ys))
        sizes = np.array([max(len(x), 1) for x in xs], dtype=float)
        return d / np.sqrt(sizes)[:, None] if normalized else d

    def feature(ps: list) -> np.ndarray:
        xs = [_points(p) for p in ps]
        return np.array([_spread(x) / (np.sqrt(len(x)) if normalized and len(x) else 1.0) for x in xs])

    def against(made: np.ndarray) -> Callable:
        if transposed or made.ndim != 3 or not np.isfinite(made).all():
            return lambda picks, d: _nearest(between(made, picks), d)
        return _against_rmsd(made, between, float(np.sqrt(made.shape[1])) if normalized else 1.0)

    return Metric(lambda ps, qs: between(prepare(ps), prepare(qs)), feature, lambda t: t, prepare, between, against=against)


def permuted_rmsd() -> Metric:
    """Permutation-aware RMSD of payloads ``[[Z,x,y,z], ...]``.

    The root mean square distance to the centroid is unchanged by rigid motion and
    permutation, and differs by at most the RMSD between two structures.
    """
    def prepare(ps: list) -> np.ndarray:
        return _ragged([_profiled(*_atoms(p)) for p in ps])

    def between(xs: np.ndarray, ys: np.ndarray) -> np.ndarray:
        return _matched_items(np.repeat(xs, len(ys)), np.tile(ys, len(xs))).reshape(len(xs), len(ys))

    return Metric(
        lambda ps, qs: between(prepare(ps), prepare(qs)),
        lambda ps: np.array([_spread(_atoms(p)[1]) for p in ps]),
        lambda t: t,
        prepare,
        between,
        vectorized=False,
        items=_matched_items,
    )


def cosine() -> Metric:
    """One minus the cosine of two vectors.

    The chord between unit vectors is ``sqrt(2 d)``; the first coordinate of the unit
    vector differs by at most the chord.
    """

    def unit(ps: list) -> np.ndarray:
        m = np.asarray([np.asarray(p, dtype=float) for p in ps], dtype=float)
        return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)

    return Metric(
        lambda xs, ys: 1.0 - unit(xs) @ unit(ys).T if len(xs) and len(ys) else np.zeros((len(xs), len(ys))),
        lambda ps: unit(ps)[:, 0],
        lambda t: float(np.sqrt(2.0 * max(t, 0.0))),
        unit,
        lambda a, b: 1.0 - a @ b.T,
    )


def tanimoto_distance() -> Metric:
    """One minus the Tanimoto similarity of two on-bit arrays; empty against empty is 1."""

    def dense(ps: list, width: int) -> np.ndarray:
        m = np.zeros((len(ps), width), dtype=np.float32)
        sizes = [len(p) for p in ps]
        if sum(sizes):
            m[np.repeat(np.arange(len(ps)), sizes), np.concatenate([np.asarray(p, dtype=int) for p in ps])] = 1.0
        return m

    def pairwise(xs: list, ys: list) -> np.ndarray:
        if not len(xs) or not len(ys):
            return np.zeros((len(xs), len(ys)))
        width = widest([*xs, *ys])
        return between(dense(xs, width), dense(ys, width))

    def widest(ps: list) -> int:
        return 1 + max((int(np.max(p)) for p in ps if len(p)), default=0)

    def between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        both = (a @ b.T).astype(float)
        union = a.sum(axis=1, dtype=float)[:, None] + b.sum(axis=1, dtype=float)[None, :] - both
        return 1.0 - np.divide(both, union, out=np.zeros_like(both), where=union > 0)

    def closest(xs: list, ys: list, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = widest([*xs, *ys])
        size, other = (np.array([len(p) for p in ps]) for ps in (xs, ys))
        both = dense(xs, width) @ dense(ys, width).T
        sim = np.add.outer(size.astype(np.float32), other.astype(np.float32))
        sim -= both
        np.divide(both, np.maximum(sim, 1, out=sim), out=sim)
        # Rounding keeps the order of the quotients: only those that round to the largest are divided in double precision.
        top = sim.max(axis=1)
        best, first = np.where(top > 0, np.inf, 1.0), np.zeros(len(xs), dtype=np.int64)
        up = np.flatnonzero((top > 0) & (1.0 - top <= d + 1e-6))
        row, col = np.nonzero(sim[up] == top[up, None])
        row = up[row]
        shared = both[row, col].astype(float)
        exact = 1.0 - shared / (size[row] + other[col] - shared)
        order = np.lexsort((col, exact, row))
        order = order[np.r_[True, np.diff(row[order]) > 0]] if len(order) else order
        best[row[order]], first[row[order]] = exact[order], col[order]
        return np.where(best < d, best, np.inf), first

    return Metric(
        pairwise, lambda ps: np.array([float(len(p)) for p in ps]), lambda t: t, lambda ps: dense(ps, widest(ps)), between, closest=closest)
