import math
import random

import numpy as np
import pytest

from sparkcurate.llm import hnsw_dedup as H

SCHEMA = "vec_id bigint, embedding array<float>, label int, n_links string, node int"


def cloud(rng, n, dim, groups, noise):
    """``n`` random vectors and groups of near copies of some of them."""
    base = rng.standard_normal((n, dim))
    out = list(base)
    for size in groups:
        seed = base[rng.integers(n)]
        out += [seed + noise * rng.standard_normal(dim) for _ in range(size)]
    return np.array(out, dtype=np.float32)


def plain(rows, cosine=0.9):
    """[(vec_id, n_links, component, kept)] by all pairs."""
    def ok(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if ok(v) else None for _, v, *_ in rows]
    link = [[j for j in range(len(rows)) if j != i and unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= cosine]
            for i in range(len(rows))]
    out, seen = [None] * len(rows), set()
    for i in range(len(rows)):
        if i in seen:
            continue
        stack, group = [i], {i}
        while stack:
            for j in link[stack.pop()]:
                if j not in group:
                    group.add(j)
                    stack.append(j)
        seen |= group
        low = min((rows[j][0] for j in group if rows[j][0] is not None), default=None)
        for j in group:
            out[j] = (rows[j][0], len(link[j]), low, rows[j][0] == low)
    return sorted(out, key=repr)


def got(df):
    assert df.columns == ["vec_id", "n_links", "component_id", "kept"]
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    vectors = cloud(np.random.default_rng(3), 500, 24, [1, 1, 2, 5, 60, 150], 0.12)
    order = list(range(len(vectors)))
    random.Random(4).shuffle(order)
    return [(i, [float(x) for x in vectors[k]], 0, "x", 1) for i, k in enumerate(order)]


@pytest.mark.parametrize(("shard_rows", "beam"), [(10_000, None), (120, None), (120, 16)])
def test_links_equal_all_pairs(spark, rows, shard_rows, beam):
    """In one shard, over many shards, and where groups are larger than the beam."""
    docs = spark.createDataFrame(rows, SCHEMA)
    assert got(H.near_duplicates(docs, shard_rows=shard_rows, beam=beam)) == plain(rows)


def test_awkward_vectors(spark):
    nan, inf = float("nan"), float("inf")
    same = [0.5, -0.25, 1.0]
    rows = [(1, None), (2, []), (3, [0.0, 0.0, 0.0]), (4, [1.0, None, 0.0]), (5, [nan, 1.0, 0.0]), (6, [inf, 1.0, 0.0]), (7, same), (9, same), (9, same),
            (9, [0.0, 0.0, -1.0]), (8, [x * 3 for x in same]), (10, [1e-30, 0.0, 0.0]), (11, [1e30, 1e25, 0.0]), (12, [1.0, 0.0]), (None, [2.0, 0.0]),
            (None, [0.0, 7.0, 0.0]), (13, [-0.0, 1.0, 0.0]), (14, [0.0, 1.0, 0.0])]
    rows = [(*r, None, None, None) for r in rows]
    assert got(H.near_duplicates(spark.createDataFrame(rows, SCHEMA))) == plain(rows)
    assert got(H.near_duplicates(spark.createDataFrame([], SCHEMA))) == []
    assert got(H.near_duplicates(spark.createDataFrame(rows[:6], SCHEMA))) == plain(rows[:6])


def test_graph_finds_neighbours():
    """Recall of the ten nearest among random vectors, the hardest case, and links of every beam are real positions."""
    rng = np.random.default_rng(5)
    vectors = H.unit(rng.standard_normal((3000, 32))).astype(np.float32)
    order, sizes = H.Graph.order(len(vectors))
    vectors = vectors[order]
    graph = H.Graph.build(vectors, sizes)
    assert [len(x) for x in graph.layers] == sizes and sizes[0] == 3000 and len(sizes) > 1
    for layer, size in zip(graph.layers, sizes, strict=True):
        assert layer.max() < size and all(len(set(r[r >= 0])) == (r >= 0).sum() for r in layer)
    queries = H.unit(rng.standard_normal((200, 32))).astype(np.float32)
    truth = np.argsort(-(queries @ vectors.T), axis=1)[:, :10]
    at, _ = graph.nearest(queries, 128)
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(at.tolist(), truth.tolist(), strict=True)]) > 0.9


def test_beam_follows_audits():
    rows = [dict(beam=b, kind=k, wanted=100, found=f) for b, k, f in [(16, "planted", 99), (16, "links", 90), (32, "planted", 99), (32, "links", 100), (64, "planted", 100), (64, "links", 100)]]
    assert H.beam_width(rows) == 32 and H.beam_width(rows, 0.995) == 64 and H.beam_width(rows[:2]) is None and H.beam_width([]) is None


def test_joining_edges_are_few():
    rng = np.random.default_rng(1)
    for share in (0.01, 0.2, 1.0):
        found = rng.random((40, 30)) < share
        label = np.arange(30)
        edges = [(i, j) for i, j in H._joining(found[:25], label)] + [(i + 25, j) for i, j in H._joining(found[25:], label)]
        assert all(found[i, j] for i, j in edges) and len(edges) <= 70
        def parts(pairs):
            up = {}
            def root(x):
                while up.setdefault(x, x) != x:
                    x = up[x]
                return x
            for i, j in pairs:
                up[root(("r", i))] = root(("c", j))
            return {frozenset(x for x in up if root(x) == r) for r in map(root, list(up))}
        assert parts(edges) == parts(zip(*map(list, np.nonzero(found)), strict=True))


def test_double_precision_decides(spark):
    """Vectors a hair above and below the threshold."""
    c = 0.9
    rows = [(1, [1.0, 0.0]), (2, [c + 1e-9, math.sqrt(1 - (c + 1e-9) ** 2)]), (3, [c - 1e-9, -math.sqrt(1 - (c - 1e-9) ** 2)])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert got(H.near_duplicates(df)) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]
