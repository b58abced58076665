"""Periodic runs of words: maximal stretches that repeat with a period, and texts without the repeats.

A run is a stretch of consecutive words with smallest period q and length at least
max(MIN_WORDS, 3 * q) that no neighbouring word extends. Runs are found by the Lyndon-root method:
every run holds a Lyndon word of its period's length, under the order of the words or under the
reversed one. So each position offers one candidate per order, its longest Lyndon word; the
candidate is extended to the right by the longest common extension of its two ends, and to the left by
that of the reversed text. Extensions come from suffix trees (Ukkonen) of the text and of its
reversal, as depths of lowest common ancestors, which a range minimum over the Euler tour answers in
constant time for all candidates at once.

Trees are built only where runs can be. A run matches itself at distance q over at least
``GRAM`` words, so every word of it lies in a ``GRAM``-word passage that occurs twice in the document;
runs lie whole inside the stretches that such passages cover. This is exact, and most
texts have no such stretch.

All of it happens per document in Arrow batches: nothing is shuffled, and a task holds the trees of one
stretch at a time, in memory linear in its length.

Edge cases: null and empty texts and texts of white space have no words and no runs. A null id counts
as empty text for the edit. Ties between runs go to the smallest start, then the smallest period.
Repeated rows give repeated results. Other columns are ignored. An empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import table

MIN_WORDS, TIMES = 24, 3
# Shortest match of a run with itself: 24 - q words up to period 8, 2 * q words beyond.
GRAM = 16
_BLOCK = 32  # entries of an Euler tour per block of the range minimum


class SuffixTree:
    """Suffix tree of a list of small integers by Ukkonen's algorithm, with constant-time extensions.

    Symbols are 0 or more; an end symbol below all of them is added. Node 0 is the root.
    """

    def __init__(self, symbols: list[int]) -> None:
        self.n = len(symbols)
        self._grow([s + 1 for s in symbols] + [0])
        self._tour()

    def _grow(self, text: list[int]) -> None:
        width = max(text) + 1
        size = len(text)
        start, end, link = [0], [0], [0]  # of the edge into the node; inner ends are fixed, a leaf's is the text's
        child: dict[int, int] = {}  # node * width + first symbol
        node, edge, length, open_leaves = 0, 0, 0, 0
        for i, symbol in enumerate(text):
            open_leaves += 1
            last = 0
            while open_leaves:
                if length == 0:
                    edge = i
                key = node * width + text[edge]
                below = child.get(key)
                if below is None:
                    child[key] = len(start)
                    start.append(i)
                    end.append(size)
                    link.append(0)
                    if last:
                        link[last] = node
                        last = 0
                else:
                    first = start[below]
                    span = min(end[below], i + 1) - first
                    if length >= span:
                        edge += span
                        length -= span
                        node = below
                        continue
                    if text[first + length] == symbol:
                        length += 1
                        if last:
                            link[last] = node
                        break
                    middle = len(start)
                    child[key] = middle
                    start.append(first)
                    end.append(first + length)
                    link.append(0)
                    start[below] = first + length
                    child[middle * width + text[first + length]] = below
                    child[middle * width + symbol] = middle + 1
                    start.append(i)
                    end.append(size)
                    link.append(0)
                    if last:
                        link[last] = middle
                    last = middle
                open_leaves -= 1
                if node == 0 and length:
                    length -= 1
                    edge = i - open_leaves + 1
                elif node:
                    node = link[node]
        self._span = np.array(end, dtype=np.int64) - np.array(start, dtype=np.int64)
        keys = np.fromiter(child.keys(), dtype=np.int64, count=len(child))
        kids = np.fromiter(child.values(), dtype=np.int64, count=len(child))
        self._symbol = np.zeros(len(start), dtype=np.int64)
        self._symbol[kids] = keys % width
        self._parent = np.zeros(len(start), dtype=np.int64)
        self._parent[kids] = keys // width

    def _tour(self) -> None:
        """Euler tour with the depth of every visit; ranks of suffixes under both orders of symbols."""
        kids = np.arange(1, len(self._parent))
        order = kids[np.lexsort((self._symbol[kids], self._parent[kids]))]
        bounds = np.searchsorted(self._parent[order], np.arange(len(self._parent) + 1)).tolist()
        children, span = order.tolist(), self._span.tolist()
        size = self.n + 1
        depths, seen = [0], [0] * (size + 1)
        up = list(bounds[:-1])
        stack, depth = [0], [0]
        ranks = np.zeros(size, dtype=np.int64)
        leaf = 0
        while stack:
            node = stack[-1]
            at = up[node]
            if at < bounds[node + 1]:
                up[node] = at + 1
                kid = children[at]
                below = depth[-1] + span[kid]
                if bounds[kid] == bounds[kid + 1]:
                    suffix = size - below
                    seen[suffix] = len(depths)
                    ranks[suffix] = leaf
                    leaf += 1
                    depths.append(below)
                    depths.append(depth[-1])
                else:
                    depths.append(below)
                    stack.append(kid)
                    depth.append(below)
            else:
                stack.pop()
                depth.pop()
                if depth:
                    depths.append(depth[-1])
        self._seen = np.array(seen, dtype=np.int64)
        self.rank = ranks
        self._minimum(np.array(depths, dtype=np.int32))
        self._reversed_ranks(bounds, children, span)

    def _reversed_ranks(self, bounds: list[int], children: list[int], span: list[int]) -> None:
        """Ranks of suffixes when the order of symbols is reversed and the end stays the smallest."""
        size = self.n + 1
        self.rank_reversed = np.zeros(size, dtype=np.int64)
        first_symbol = self._symbol.tolist()
        stack, leaf = [(0, 0)], 0
        while stack:
            node, depth = stack.pop()
            a, b = bounds[node], bounds[node + 1]
            if a == b:
                self.rank_reversed[size - depth] = leaf
                leaf += 1
                continue
            # The last pushed is visited first: the end symbol, then the largest symbols.
            kids = children[a:b]
            if first_symbol[kids[0]] == 0:
                kids = [*kids[1:], kids[0]]
            stack += [(k, depth + span[k]) for k in kids]

    def _minimum(self, depths: np.ndarray) -> None:
        blocks = -(-len(depths) // _BLOCK)
        padded = np.full(blocks * _BLOCK, np.iinfo(np.int32).max, dtype=np.int32)
        padded[: len(depths)] = depths
        grid = padded.reshape(blocks, _BLOCK)
        self._head = np.minimum.accumulate(grid, axis=1).ravel()
        self._tail = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
        self._flat = padded
        self._sparse = [grid.min(axis=1)]
        step = 1
        while 2 * step <= blocks:
            low = self._sparse[-1]
            self._sparse.append(np.minimum(low[:-step], low[step:]))
            step *= 2

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Lengths of the longest common prefixes of suffixes ``i`` and ``j`` (i != j, both at most n)."""
        a, b = self._seen[i], self._seen[j]
        a, b = np.minimum(a, b), np.maximum(a, b)
        first, last = a // _BLOCK, b // _BLOCK
        out = np.minimum(self._tail[a], self._head[b])
        between = last - first - 1
        wide = np.flatnonzero(between > 0)
        if wide.size:
            level = np.frexp(between[wide].astype(np.float64))[1] - 1
            for k in np.unique(level).tolist():
                at = wide[level == k]
                row = self._sparse[k]
                out[at] = np.minimum(out[at], np.minimum(row[first[at] + 1], row[last[at] - (1 << k)]))
        same = np.flatnonzero(first == last)
        if same.size:
            steps = a[same][:, None] + np.arange(_BLOCK)
            inside = np.where(steps <= b[same][:, None], self._flat[np.minimum(steps, len(self._flat) - 1)], np.iinfo(np.int32).max)
            out[same] = inside.min(axis=1)
        return out.astype(np.int64)


def _lyndon_lengths(ranks: np.ndarray) -> np.ndarray:
    """Length of the longest Lyndon word at each position: the way to the next smaller suffix."""
    rank = ranks.tolist()
    size = len(rank) - 1
    out = [0] * size
    stack = [size]  # the empty suffix is the smallest
    for i in range(size - 1, -1, -1):
        r = rank[i]
        while rank[stack[-1]] > r:
            stack.pop()
        out[i] = stack[-1] - i
        stack.append(i)
    return np.array(out, dtype=np.int64)


def stretch_runs(symbols: list[int]) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a list of integers, in order of start and period."""
    n = len(symbols)
    if n < MIN_WORDS:
        return []
    forward, backward = SuffixTree(symbols), SuffixTree(symbols[::-1])
    found = []
    for ranks in (forward.rank, forward.rank_reversed):
        at, period = np.arange(n), _lyndon_lengths(ranks)
        period_end = at + period
        can = TIMES * period <= n
        at, period, period_end = at[can], period[can], period_end[can]
        right = forward.extension(at, period_end)
        # The words before both ends, read backwards: suffixes of the reversed text.
        left = np.zeros(len(at), dtype=np.int64)
        inner = np.flatnonzero(at > 0)
        left[inner] = backward.extension(n - at[inner], n - period_end[inner])
        start, length = at - left, left + period + right
        long = length >= np.maximum(MIN_WORDS, TIMES * period)
        found.append(np.stack([start[long], length[long], period[long]], axis=1))
    return sorted({tuple(row) for row in np.concatenate(found).tolist()}, key=lambda r: (r[0], r[2]))


_ODD = np.uint64(0x9E3779B97F4A7C15)


def _covered(codes: np.ndarray) -> list[tuple[int, int]]:
    """Maximal stretches covered by ``GRAM``-word passages that occur at least twice."""
    n = len(codes)
    if n < MIN_WORDS:
        return []
    rolled, width, factor = codes.astype(np.uint64), 1, _ODD
    while width < GRAM:
        rolled = rolled[: len(rolled) - width] * factor + rolled[width:]
        width, factor = 2 * width, factor * factor
    order = np.argsort(rolled, kind="stable")
    equal = rolled[order[1:]] == rolled[order[:-1]]
    if not equal.any():
        return []
    mark = np.zeros(n + 1, dtype=np.int64)
    twice = np.zeros(len(rolled), dtype=bool)
    twice[order[1:][equal]] = twice[order[:-1][equal]] = True
    at = np.flatnonzero(twice)
    np.add.at(mark, at, 1)
    np.add.at(mark, at + GRAM, -1)
    inside = np.concatenate([[False], np.cumsum(mark)[:n] > 0, [False]])
    turns = np.flatnonzero(inside[1:] != inside[:-1])
    return list(zip(turns[::2].tolist(), turns[1::2].tolist(), strict=True))


def runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs of a list of words, in order of start and period."""
    if len(words) < MIN_WORDS:
        return []
    with np.errstate(over="ignore"):
        codes = np.fromiter(map(hash, words), dtype=np.int64, count=len(words)).view(np.uint64)
        stretches = _covered(codes)
    found = []
    for a, b in stretches:
        number: dict = {}
        symbols = [number.setdefault(w, len(number)) for w in words[a:b]]
        found += [(a + s, length, q) for s, length, q in stretch_runs(symbols)]
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words: list, found: list[tuple[int, int, int]]) -> list:
    """The words without those that a run repeats: all that any run holds after its first period."""
    if not found:
        return words
    edge = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in found:
        edge[start + period] += 1
        edge[start + length] -= 1
    keep = np.cumsum(edge)[:-1] == 0
    return [w for w, k in zip(words, keep.tolist(), strict=True) if k]


def strongest(found: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, exactly; ties go to the smallest start, then period."""
    best = None
    for run in found:  # in order of start, then period
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def planted(words: list, doc_id: int | None) -> list:
    """The words with a periodic tail where 10 divides the crc32 of the id; its place and period follow from the hash."""
    h = crc32(b"" if doc_id is None else str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


_SCHEMA = (
    "n_words bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
    "runs_sha256 string, collapsed_sha256 string")
_TEXTS = ", runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"


def detect(docs: DataFrame, edit: bool = False, texts: bool = True) -> DataFrame:
    """(doc_id, ...) per row: its runs, the strongest one, and the text without repeats, words joined by one blank.

    With ``edit`` the texts get the periodic tails of ``planted`` first; without ``texts`` only the
    digests of runs and of the text are returned.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = _SCHEMA + (_TEXTS if texts else "")

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            rows = []
            for doc_id, text in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                words = (text.as_buffer().to_pybytes() if text.is_valid else b"").split()
                words = planted(words, doc_id) if edit else words
                found = runs(words)
                best = strongest(found)
                kept = b" ".join(collapsed(words, found))
                lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
                row = (
                    len(words), len(found), *(best or (None, None, None)), best and 1000 * best[1] // best[2],
                    sha256(lines.encode()).hexdigest(), sha256(kept).hexdigest())
                rows.append((*row, [dict(zip(run.names, r, strict=True)) for r in found], kept) if texts else row)
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
            arrays = [pa.array(list(c), type=t) for c, t in zip(columns, types, strict=True)]
            yield pa.RecordBatch.from_arrays([part.column(0), *arrays], ["doc_id", *names])

    names = [f.split(" ")[0] for f in schema.split(", ")]
    run = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
    types = ([pa.int64()] * 6 + [pa.string()] * 2 + [pa.list_(run), pa.string()])[: len(names)]
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(batches, f"doc_id {kind}, {schema}")


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``documents``, a tenth of them with planted periodic tails."""
    return detect(table(spark, sf_dir, "documents"), edit=True, texts=False)


QUERIES = {"op11_periodic_runs": op11_periodic_runs}
ORACLES: dict[str, str] = {}
