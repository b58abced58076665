"""Near-duplicate embeddings by hierarchical navigable small-world graphs, one per shard.

1. Rows with equal vectors become one class (hashes of the vector, combined map-side), so a mass of exact
   copies is one entry with a weight. Classes are dealt to shards of about ``SHARD_ROWS`` by hash.
2. Each shard builds a layered graph in one task. A vector is in layer l with probability M ** -l; layers
   are linked from the top by beam searches of the vectors linked so far, in growing batches.
   Links are chosen so that none is closer to another chosen one than to the vector, and
   lists that overflow are chosen anew.
3. Audits: every shard searches for a bounded number of its vectors (``AUDIT_ROWS``) with planted copies at
   the similarity of the threshold, and compares their links with those of a full scan. The beam
   is the narrowest of ``BEAMS`` that reaches ``RECALL`` in both, summed over all shards; if none
   does, shards are scanned.
4. All shards are queried: each pair of shards meets once, in one task where the classes of the one query
   the graph of the other, and a link counts for both ends. Candidates are verified by their cosine in
   double precision. A beam that is full of links may hide more, so such a query is compared with
   the whole shard. Links are counted where they are found; only the edges that join components
   leave the task, at most one per vector, so a group of copies with a third of all rows makes no list of
   pairs.
5. The edges are united into components on Spark (``common.components``).

A task holds two shards and the links of one batch of queries, whatever the data; the pairs of shards grow with
the square of the rows over ``SHARD_ROWS``, which is the price of querying every shard, so
``shard_rows`` should grow with the memory of a task.

Edge cases: null vectors, zero vectors and vectors with null or non-finite components link with
nothing. Vectors of different lengths do not link. Rows with one id are separate; a null id is never
the smallest of a component unless all are null. Ties have no part: every link at or above the
threshold counts. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import lookup_join
from .common import components, table, written

COSINE = 0.9
SHARD_ROWS = 16384
M = 16  # links that a new vector chooses; layer 0 keeps twice as many per vector
BUILD_BEAM, BATCH = 64, 512
BEAMS = (16, 32, 64, 128, 256)
RECALL, AUDIT_ROWS = 0.99, 64
# Candidates of the 32-bit search within this of the threshold are verified in double precision.
_SLACK = 1e-4


def search(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int, expand: int = 4) -> tuple[np.ndarray, np.ndarray]:
    """(positions, similarities) of the ``width`` best vectors that a beam search meets, per query.

    ``links`` has a row per vector, padded with -1, and may cover only the first vectors. ``entry`` has
    starting positions per query, padded with -1. Unfilled places have similarity -2. All
    queries go on in step: each expands its ``expand`` best open positions, until none is open.
    """
    n, count = len(links), len(queries)
    table_ = np.vstack([links, np.full((1, links.shape[1]), -1, links.dtype)])
    table_[table_ < 0] = n
    expand = min(expand, width)
    at = np.full((count, width), n, dtype=np.int64)
    like = np.full((count, width), -2, dtype=np.float32)
    unexpanded = np.zeros((count, width), dtype=bool)
    seen = np.zeros((count, n + 1), dtype=bool)
    seen[:, n] = True
    first = np.where(entry < 0, n, entry)[:, :width]
    like[:, : first.shape[1]] = np.where(first < n, np.einsum("bed,bd->be", vectors[np.minimum(first, n - 1)], queries), -2)
    at[:, : first.shape[1]] = first
    unexpanded[:, : first.shape[1]] = first < n
    np.put_along_axis(seen, first, True, axis=1)
    live = np.arange(count)
    while live.size:
        key = np.where(unexpanded[live], like[live], -3)
        pick = np.argpartition(-key, expand - 1, axis=1)[:, :expand]
        value = np.take_along_axis(key, pick, axis=1)
        some = value.max(axis=1) > -3
        live, pick, value = live[some], pick[some], value[some]
        if not live.size:
            break
        node = np.where(value > -3, np.take_along_axis(at[live], pick, axis=1), n)
        unexpanded[live[:, None], pick] = False
        near = np.sort(table_[node].reshape(len(live), -1), axis=1)
        fresh = ~seen[live[:, None], near]
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        row, col = np.nonzero(fresh)
        target = near[row, col]
        seen[live[row], target] = True
        new = np.full(near.shape, -2, dtype=np.float32)
        new[row, col] = np.einsum("ij,ij->i", queries[live[row]], vectors[target])
        all_like = np.concatenate([like[live], new], axis=1)
        top = np.argpartition(-all_like, width - 1, axis=1)[:, :width]
        like[live] = np.take_along_axis(all_like, top, axis=1)
        at[live] = np.take_along_axis(np.concatenate([at[live], near], axis=1), top, axis=1)
        unexpanded[live] = np.take_along_axis(np.concatenate([unexpanded[live], fresh], axis=1), top, axis=1)
    return at, like


def choose(vectors: np.ndarray, near: np.ndarray, like: np.ndarray, k: int) -> np.ndarray:
    """At most ``k`` links per row of candidates: those that no chosen one is closer to, then the most similar."""
    order = np.argsort(-like, axis=1, kind="stable")
    near, like = np.take_along_axis(near, order, axis=1), np.take_along_axis(like, order, axis=1)
    own = vectors[np.maximum(near, 0) % len(vectors)]
    between = own @ own.transpose(0, 2, 1)
    rows, width = near.shape
    chosen = np.zeros((rows, width), dtype=bool)
    closest = np.full((rows, width), -2, dtype=np.float32)
    for j in range(width):
        take = (like[:, j] > -2) & (closest[:, j] < like[:, j]) & (chosen.sum(axis=1) < k)
        chosen[:, j] = take
        closest = np.where(take[:, None], np.maximum(closest, between[:, j]), closest)
    first = np.argsort(~chosen, axis=1, kind="stable")[:, :k]
    return np.where(np.take_along_axis(like, first, axis=1) > -2, np.take_along_axis(near, first, axis=1), -1)


class Graph:
    """Layers of links over unit vectors that are sorted by layer, highest first: layer l covers a prefix."""

    def __init__(self, vectors: np.ndarray, layers: list[np.ndarray]) -> None:
        self.vectors, self.layers = vectors, layers

    @staticmethod
    def order(n: int) -> tuple[np.ndarray, list[int]]:
        """(order of the vectors, sizes of the layers from 0): layers drop off by powers of ``M``."""
        level = np.floor(-np.log(1 - np.random.default_rng(n).random(n)) / np.log(M)).astype(int)
        return np.argsort(-level, kind="stable"), [int((level >= k).sum()) for k in range(int(level.max(initial=0)) + 1)]

    @classmethod
    def build(cls, vectors: np.ndarray, sizes: list[int]) -> Graph:
        graph = cls(vectors, [])
        for size in reversed(sizes):
            degree = 2 * M if size == sizes[0] else M
            graph.layers.insert(0, graph._linked(size, degree))
        return graph

    def entry(self, queries: np.ndarray, above: list[np.ndarray]) -> np.ndarray:
        """Where to enter the layer below ``above`` (from low to high)."""
        at = np.zeros((len(queries), 1), dtype=np.int64)
        for layer in reversed(above):
            found, like = search(self.vectors, layer, queries, at, 4)
            at = np.where(like > -2, found, -1)
        return at

    def _linked(self, size: int, degree: int) -> np.ndarray:
        vectors = self.vectors
        links = np.full((size, degree + degree // 2), -1, dtype=np.int32)
        done = 0
        while done < size:
            fresh = np.arange(done, min(size, done + min(BATCH, max(64, done // 2))))
            own = vectors[fresh]
            mates = own @ own.T
            np.fill_diagonal(mates, -2)
            top = np.argsort(-mates, axis=1)[:, :M]
            near, like = fresh[top], np.take_along_axis(mates, top, axis=1)
            if done:
                entry = self.entry(own, self.layers)
                entry[entry >= done] = -1
                entry[(entry < 0).all(axis=1), 0] = 0
                found, value = search(vectors, links[:done], own, entry, BUILD_BEAM)
                near, like = np.concatenate([near, found], axis=1), np.concatenate([like, value], axis=1)
            chosen = choose(vectors, near, like, M)
            links[fresh, : chosen.shape[1]] = chosen
            self._back(links, fresh, chosen, degree)
            done += len(fresh)
        return links

    def _back(self, links: np.ndarray, fresh: np.ndarray, chosen: np.ndarray, degree: int) -> None:
        """Links from the chosen to the new vectors; lists that overflow keep ``degree`` chosen ones."""
        source, target = np.repeat(fresh, chosen.shape[1]), chosen.ravel()
        source, target = source[target >= 0], target[target >= 0]
        known = (links[target] == source[:, None]).any(axis=1)
        source, target = source[~known], target[~known]
        like = np.einsum("ij,ij->i", self.vectors[source], self.vectors[target])
        order = np.lexsort((-like, target))
        source, target = source[order], target[order]
        names, start = np.unique(target, return_index=True)
        rank = np.arange(len(target)) - np.repeat(start, np.diff([*start.tolist(), len(target)]))
        # Beyond a full list of new ones the least similar cannot be chosen first; they stay reachable by their own links.
        source, target, rank = source[rank < degree], target[rank < degree], rank[rank < degree]
        for a in range(0, len(names), 1024):
            some = names[a : a + 1024]
            inside = (target >= some[0]) & (target <= some[-1])
            pool = np.concatenate([links[some], np.full((len(some), degree), -1, links.dtype)], axis=1)
            pool[np.searchsorted(some, target[inside]), links.shape[1] + rank[inside]] = source[inside]
            over = (pool >= 0).sum(axis=1) > links.shape[1]
            packed = np.take_along_axis(pool, np.argsort(pool < 0, axis=1, kind="stable"), axis=1)[:, : links.shape[1]]
            if over.any():
                wide, base = pool[over], self.vectors[some[over]]
                value = np.einsum("bed,bd->be", self.vectors[np.maximum(wide, 0)], base)
                value[wide < 0] = -2
                packed[over] = -1
                packed[over, :degree] = choose(self.vectors, wide, value, degree)
            links[some] = packed

    def nearest(self, queries: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        return search(self.vectors, self.layers[0], queries, self.entry(queries, self.layers[1:]), width)


class Shard:
    """A shard as it travels: keys, weights, unit vectors in double precision and the graph."""

    def __init__(self, row: pd.Series) -> None:
        self.nodes = np.frombuffer(row["nodes"], dtype=np.int64)
        self.weights = np.frombuffer(row["weights"], dtype=np.int64)
        self.exact = unit(np.frombuffer(row["vectors"], dtype=row["kind"]).reshape(len(self.nodes), -1))
        layers = [np.frombuffer(b, dtype=np.int32).reshape(size, -1) for b, size in zip(row["layers"], row["sizes"], strict=True)]
        self.graph = Graph(self.exact.astype(np.float32), layers)

    def linked(self, queries: np.ndarray, width: int | None, cosine: float) -> np.ndarray:
        """Bit matrix (query, vector) of the pairs found at or above ``cosine``; without a width all pairs are compared."""
        out = np.zeros((len(queries), len(self.nodes)), dtype=bool)
        full = np.arange(len(queries))
        if width is not None:
            at, like = self.graph.nearest(queries.astype(np.float32), min(width, len(self.nodes)))
            row, col = np.nonzero(like >= cosine - _SLACK)
            target = at[row, col]
            true = np.einsum("ij,ij->i", queries[row], self.exact[target]) >= cosine
            out[row[true], target[true]] = True
            full = np.flatnonzero((like >= cosine - _SLACK).all(axis=1))
        if full.size:
            out[full] = queries[full] @ self.exact.T >= cosine
        return out


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, in double precision and without overflow."""
    wide = vectors.astype(np.float64)
    wide /= np.abs(wide).max(axis=1, keepdims=True)
    return wide / np.sqrt(np.einsum("ij,ij->i", wide, wide))[:, None]


_SHARD = "dim int, shard int, shards int, kind string, nodes binary, weights binary, vectors binary, layers array<binary>, sizes array<int>"


def _build(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("node")
    vectors = np.stack(rows["embedding"].tolist())
    order, sizes = Graph.order(len(vectors))
    vectors = np.ascontiguousarray(vectors[order])
    graph = Graph.build(unit(vectors).astype(np.float32), sizes)
    return pd.DataFrame([{
        "dim": key[0], "shard": key[1], "shards": key[2], "kind": vectors.dtype.str,
        "nodes": rows["node"].to_numpy(np.int64)[order].tobytes(), "weights": rows["weight"].to_numpy(np.int64)[order].tobytes(),
        "vectors": vectors.tobytes(), "layers": [x.astype(np.int32).tobytes() for x in graph.layers], "sizes": sizes}])


def _auditor(cosine: float) -> Callable[[tuple, pd.DataFrame], pd.DataFrame]:
    def audit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(rows.iloc[0])
        some = np.argsort(shard.nodes, kind="stable")
        some = some[:: max(1, len(some) // AUDIT_ROWS)][:AUDIT_ROWS]
        own = shard.exact[some]
        noise = np.random.default_rng(len(some)).standard_normal(own.shape)
        noise -= np.einsum("ij,ij->i", noise, own)[:, None] * own
        size = np.sqrt(np.einsum("ij,ij->i", noise, noise))[:, None]
        at = min(1.0, cosine + 1e-6)
        copies = at * own + np.sqrt(1 - at * at) * noise / np.where(size > 0, size, 1)
        copies /= np.sqrt(np.einsum("ij,ij->i", copies, copies))[:, None]
        truth = shard.linked(own, None, cosine)
        planted = np.einsum("ij,ij->i", copies, own) >= cosine
        out = []
        for width in BEAMS:
            found = shard.linked(copies, width, cosine)[np.arange(len(some)), some]
            out.append((width, "planted", int(planted.sum()), int((found & planted).sum())))
            out.append((width, "links", int(truth.sum()), int((shard.linked(own, width, cosine) & truth).sum())))
        return pd.DataFrame(out, columns=["beam", "kind", "wanted", "found"])

    return audit


def audits(shards: DataFrame, cosine: float = COSINE) -> DataFrame:
    """(beam, kind, wanted, found) over all shards: planted copies at the threshold, and links of a full scan."""
    each = shards.groupBy("dim", "shard").applyInPandas(_auditor(cosine), "beam int, kind string, wanted bigint, found bigint")
    return each.groupBy("beam", "kind").agg(F.sum("wanted").alias("wanted"), F.sum("found").alias("found"))


def beam_width(rows: list, recall: float = RECALL) -> int | None:
    """The narrowest beam whose audits all reach ``recall``; None if there is none."""
    passed = {b: all(r["found"] >= recall * r["wanted"] for r in rows if r["beam"] == b) for b in {r["beam"] for r in rows}}
    return min((b for b, ok in passed.items() if ok), default=None)


def _joining(found: np.ndarray, label: np.ndarray) -> Iterator[tuple[int, int]]:
    """Edges (row, column) of a bit matrix that keep what its set bits connect; one per row, and one per joined column.

    ``label`` numbers the components of the columns and goes on from matrix to matrix.
    """
    for row in np.flatnonzero(found.any(axis=1)).tolist():
        columns = np.flatnonzero(found[row])
        names, first = np.unique(label[columns], return_index=True)
        for k in first.tolist():
            yield row, int(columns[k])
        if len(names) > 1:
            label[np.isin(label, names)] = names[0]


def _pair(width: int | None, cosine: float) -> Callable[[tuple, pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    def search_pair(key: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        a = Shard(left.iloc[0])
        b = a if right.empty else Shard(right.iloc[0])
        counts, others = np.zeros(len(a.nodes), dtype=np.int64), np.zeros(len(b.nodes), dtype=np.int64)
        label, edges = np.arange(len(b.nodes)), []
        for i in range(0, len(a.nodes), BATCH):
            found = b.linked(a.exact[i : i + BATCH], width, cosine)
            if right.empty:  # each pair of a shard once, and no vector with itself
                found &= np.arange(len(b.nodes)) > np.arange(i, i + len(found))[:, None]
            bits = found.astype(np.float64)
            counts[i : i + BATCH] += (bits @ b.weights).astype(np.int64)
            others += (a.weights[i : i + BATCH] @ bits).astype(np.int64)
            edges += [(i + x, y) for x, y in _joining(found, label)]
        x, y = np.array(edges, dtype=np.int64).reshape(-1, 2).T
        x, y = np.concatenate([a.nodes[x], a.nodes, b.nodes]), np.concatenate([b.nodes[y], a.nodes, b.nodes])
        n = np.concatenate([np.zeros(len(edges), np.int64), counts, others])
        use = (n > 0) | (x != y)
        return pd.DataFrame({"a": x[use], "b": y[use], "n": n[use]})

    return search_pair


def found_links(shards: DataFrame, width: int | None, cosine: float = COSINE) -> DataFrame:
    """(a, b, n): with a = b the number ``n`` of rows that a links with in a pair of shards, else a joining edge."""
    left = shards.withColumn("other", F.explode(F.sequence("shard", F.col("shards") - 1)))
    right = shards.withColumn("other", F.col("shard")).withColumn("shard", F.explode(F.sequence(F.lit(0), "shard"))).where("shard < other")
    keys = ["dim", "shard", "other"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_pair(width, cosine), "a bigint, b bigint, n bigint")


def linkable(vector: Column) -> Column:
    """True for vectors with finite components that are not all zero."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def build_shards(classes: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per shard of (node, weight, embedding): its vectors and its graph."""
    sized = classes.withColumn("dim", F.size("embedding"))
    counts = sized.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / shard_rows).cast("int").alias("shards"))
    dealt = lookup_join(sized, counts, "dim").withColumn("shard", F.pmod(F.xxhash64("node"), F.col("shards")).cast("int"))
    return dealt.select("dim", "shard", "shards", "node", "weight", "embedding").groupBy("dim", "shard", "shards").applyInPandas(_build, _SHARD)


def near_duplicates(
    vectors: DataFrame, cosine: float = COSINE, shard_rows: int = SHARD_ROWS, beam: int | None = None
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) per row of (vec_id, embedding). ``beam`` sets the width without audits."""
    value = F.col("embedding")
    hashed = vectors.select(
        "vec_id", "embedding", *[F.when(linkable(value), F.xxhash64(F.lit(seed), value)).alias(f"_h{seed}") for seed in (1, 2)])
    grouped = hashed.where("_h1 IS NOT NULL").groupBy("_h1", "_h2").agg(
        F.first("embedding").alias("embedding"), F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("weight"))
    classes = written(grouped.withColumn("node", F.monotonically_increasing_id()))
    shards = written(build_shards(classes.select("node", "weight", "embedding"), shard_rows))
    width = beam or beam_width(audits(shards, cosine).collect())  # two rows per beam
    links = written(found_links(shards, width, cosine))
    counts = links.where("a = b").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("_linked"))
    labels = components(links.where("a <> b").select("a", "b"))
    known = classes.select("_h1", "_h2", "node", "low", "weight").join(counts, "node", "left").join(labels, "node", "left")
    known = written(known.withColumn("label", F.coalesce("label", "node")))
    lows = known.groupBy("label").agg(F.min("low").alias("_component"))
    known = lookup_join(known, lows, "label").select("_h1", "_h2", "weight", "_linked", "_component")
    joined = lookup_join(hashed.drop("embedding"), known, ["_h1", "_h2"])
    component = F.when(F.col("weight").isNull(), F.col("vec_id")).otherwise(F.col("_component"))
    return joined.select(
        "vec_id", F.coalesce(F.col("weight") - 1 + F.coalesce("_linked", F.lit(0)), F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))


def op13_hnsw_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``embeddings``, whatever their labels, at a cosine of 0.9 or more."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))


ORACLE = """
WITH RECURSIVE good AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
long AS (SELECT r, vec_id, v, sqrt(list_dot_product(v, v)) AS size FROM good),
link AS (
  SELECT a.r AS a, b.r AS b FROM long a JOIN long b ON a.r <> b.r AND len(a.v) = len(b.v)
  WHERE list_dot_product(a.v, b.v) / (a.size * b.size) >= 0.9),
reach AS (SELECT r AS a, r AS b FROM good UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
low AS (SELECT reach.a, min(good.vec_id) AS component_id FROM reach JOIN good ON reach.b = good.r GROUP BY reach.a),
n AS (SELECT a, count(*) AS n_links FROM link GROUP BY a)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id = component_id AS kept FROM good JOIN low ON r = low.a LEFT JOIN n ON r = n.a
UNION ALL
SELECT vec_id, 0, vec_id, true FROM embeddings
WHERE embedding IS NULL OR len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) > 0 OR len(list_filter(embedding, lambda x: x <> 0)) = 0
"""

QUERIES = {"op13_hnsw_near_dedup": op13_hnsw_near_dedup}
ORACLES = {"op13_hnsw_near_dedup": ORACLE}
