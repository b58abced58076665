"""Benchmark decontamination by q-gram lemma filtering over overlapping diagonal bands.

Texts and benchmark items are normalized: lower case, runs of white space as one space. A region
of a document leaks an item of m characters when its edit distance to the item is at most
k = floor(error_rate * m), as far as the lemma leaves a bound for it (see ``edit_budget``).

* Lemma: such a region shares at least t = m - q + 1 - q * k q-grams with the item, on diagonals
  at most k apart. Diagonals are cut into bands of width 2k + 2 that start every k + 1, so any
  k + 1 neighbouring diagonals lie wholly in one band.
* q-grams that are frequent in the benchmark itself may be left out of the index as long as the
  bound stays at least one: leaving out c occurrences of an item lowers its bound to t - c.
* Regions that meet the bound are verified by banded alignment: the item against the text around
  the band, free ends in the text, only cells inside the band.

The benchmark is broadcast to the tasks as one index, in blocks of at most ``ITEM_CHARS``
characters: a benchmark of any size is handled block by block, each of bounded size. Every text is
read whole, once per block, without a shuffle of texts.

Edge cases: null and empty texts and items neither leak nor are leaked; an item shorter than q
characters is found as an exact substring. Repeated rows are each reported; a null doc_id is
reported as null; repeated item rows count once. Other columns are ignored. Empty tables
give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import table, written
from .textvec import mix

_U = np.uint64
Q = 8
ERROR_RATE = 0.1
ITEM_CHARS = 2_000_000
BLOCK_CHARS = 1 << 20
LOOKUP_BITS = 22
# An item occurrence of a q-gram is left out, the most frequent first, while the bound stays above this share of it.
KEEP_BOUND = 0.5

_BASE = _U(0x9E3779B97F4A7C15)


def normalize(text: str | None) -> str:
    return " ".join(text.lower().split()) if text else ""


def edit_budget(m: int, q: int = Q, error_rate: float = ERROR_RATE) -> int:
    """The largest k up to ``error_rate * m`` for which the lemma asks for at least one shared q-gram."""
    return max(0, min(int(error_rate * m), (m - q) // q))


def qgram_hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """Hashes of all q-grams of an array of code points; q is a power of two."""
    h, width, base = codes.astype(_U) + _U(1), 1, _BASE
    with np.errstate(over="ignore"):
        while width < q:
            if len(h) <= width:
                return h[:0]
            h = h[:-width] * base + h[width:]
            base, width = base * base, 2 * width
    return mix(h)


@dataclass
class Index:
    """Postings of the q-grams of a block of items, and each item's bound, budget and text."""

    keys: np.ndarray
    bounds: np.ndarray
    item: np.ndarray
    offset: np.ndarray
    maybe: np.ndarray
    need: np.ndarray
    budget: np.ndarray
    codes: list
    texts: list
    ids: list
    short: list


def build_index(items: list[tuple[int, str]], q: int = Q, error_rate: float = ERROR_RATE) -> Index:
    texts = [(i, t) for i, t in items if len(t) >= q]
    codes = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for _, t in texts]
    grams = [qgram_hashes(c, q) for c in codes]
    budget = np.array([edit_budget(len(c), q, error_rate) for c in codes], dtype=np.int64)
    need = np.array([len(g) - q * k for g, k in zip(grams, budget, strict=True)], dtype=np.int64)
    item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    offset = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.zeros(0, np.int64)
    flat = np.concatenate(grams) if grams else np.zeros(0, _U)
    _, back, count = np.unique(flat, return_inverse=True, return_counts=True)
    many = count[back] if len(flat) else count
    keep = np.ones(len(flat), dtype=bool)
    first = np.concatenate([[0], np.cumsum([len(g) for g in grams])]).astype(np.int64)
    for x in range(len(grams)):
        own = np.arange(first[x], first[x + 1])
        spare = int(need[x] - max(1, np.ceil(KEEP_BOUND * need[x])))
        often = own[np.argsort(-many[own], kind="stable")]
        often = often[many[often] > 1][: max(0, spare)]
        keep[often] = False
        need[x] -= len(often)
    flat, item, offset = flat[keep], item[keep], offset[keep]
    order = np.argsort(flat, kind="stable")
    flat, item, offset = flat[order], item[order], offset[order]
    start = np.flatnonzero(np.r_[True, flat[1:] != flat[:-1]]) if len(flat) else np.zeros(0, np.int64)
    maybe = np.zeros(1 << LOOKUP_BITS, dtype=bool)
    maybe[(flat >> _U(64 - LOOKUP_BITS)).astype(np.int64)] = True
    return Index(flat[start], np.r_[start, len(flat)], item, offset, maybe, need, budget, codes,
                 [t for _, t in texts], [i for i, _ in texts], [(i, t) for i, t in items if 0 < len(t) < q])


def banded_distance(item: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int, int]:
    """(distance, start, end) of the best region of ``text`` for the whole item, on diagonals low to high.

    The region may start and end anywhere; a distance above the budget comes back as budget + 1.
    """
    m, width, far = len(item), high - low + 1, budget + 1
    # Cell d of row i is text position i + low + d; a start costs nothing where it lies in the text.
    d = np.arange(width)
    at = low + d
    row = np.where((at >= 0) & (at <= len(text)), 0, far)
    begin = at.copy()
    for i in range(1, m + 1):
        at = i + low + d
        inside = (at >= 1) & (at <= len(text))
        char = text[np.clip(at - 1, 0, max(0, len(text) - 1))] if len(text) else np.zeros(width, np.uint32)
        diag = row + np.where(inside & (char == item[i - 1]), 0, 1)
        diag[~inside] = far
        up = np.append(row[1:], far) + 1  # a character of the item is missing in the text
        take = up < diag
        new, origin = np.where(take, up, diag), np.where(take, np.append(begin[1:], 0), begin)
        new = np.where((at >= 0) & (at <= len(text)), new, far)
        # Extra characters of the text move right along the row: a running minimum of cost minus index.
        slid = np.minimum.accumulate(new - d) + d
        from_left = slid < new
        if from_left.any():
            src = np.maximum.accumulate(np.where(from_left, 0, d))
            new, origin = np.where(from_left, slid, new), np.where(from_left, origin[src], origin)
        row, begin = np.minimum(new, far), origin
        if row.min() >= far:
            return far, 0, 0
    best = int(np.argmin(row))
    return int(row[best]), int(begin[best]), int(m + low + best)


def leaks_in(texts: list[str], index: Index, q: int = Q) -> list[tuple[int, int, int, int, int]]:
    """(row, item_id, start, end, distance) for all regions of a block of normalized texts."""
    found = []
    for i, short in index.short:
        for r, t in enumerate(texts):
            at = t.find(short)
            while at >= 0:
                found.append((r, i, at, at + len(short), 0))
                at = t.find(short, at + len(short))
    lens = np.array([len(t) for t in texts], dtype=np.int64)
    gap = q  # code point 0 between texts, so no q-gram of an item spans two of them
    codes = np.frombuffer(("\0" * gap).join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    begins = np.r_[0, np.cumsum(lens + gap)[:-1]]
    h = qgram_hashes(codes, q)
    if not len(h) or not len(index.keys):
        return found
    pos = np.flatnonzero(index.maybe[(h >> _U(64 - LOOKUP_BITS)).astype(np.int64)])
    at = np.searchsorted(index.keys, h[pos])
    hit = index.keys[np.minimum(at, len(index.keys) - 1)] == h[pos]
    pos, at = pos[hit], at[hit]
    count = index.bounds[at + 1] - index.bounds[at]
    pos = np.repeat(pos, count)
    where = np.arange(len(pos)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(index.bounds[at], count)
    item, offset = index.item[where], index.offset[where]
    diag = pos - offset + len(codes)  # never negative
    step = index.budget[item] + 1
    lo = diag // step
    # Band b covers the diagonals b * step to (b + 2) * step - 1: each diagonal lies in two bands.
    key = np.concatenate([lo, lo - 1])
    item2, pos2, offset2 = np.r_[item, item], np.r_[pos, pos], np.r_[offset, offset]
    span = int(key.max() + 2) if len(key) else 1
    # Several texts can fall in one band only when they are shorter than it; they are told apart here.
    doc = np.searchsorted(begins, pos2, side="right") - 1
    code = (doc * len(index.need) + item2) * span + key
    # A q-gram of the item counts once per band, however often it occurs there.
    order = np.lexsort((offset2, code))
    code, offset2 = code[order], offset2[order]
    first = np.r_[True, (code[1:] != code[:-1]) | (offset2[1:] != offset2[:-1])] if len(code) else np.zeros(0, bool)
    bands, shared = np.unique(code[first], return_counts=True)
    b_item, b_key, b_doc = (bands // span) % max(1, len(index.need)), bands % span, bands // span // max(1, len(index.need))
    good = shared >= index.need[b_item]
    for x, b, r, n in sorted(zip(b_item[good], b_key[good], b_doc[good], shared[good], strict=True), key=lambda v: (v[2], v[0], -v[3])):
        k = int(index.budget[x])
        base = int(b * (k + 1) - len(codes) - begins[r])  # band start as a diagonal of the text
        low, high = base - k, base + 2 * (k + 1) + k
        item_codes = index.codes[x]
        a, e = max(0, low), min(int(lens[r]), high + len(item_codes) + 1)
        exact = texts[r].find(index.texts[x], a, e)
        if exact >= 0:  # nothing can be closer
            found.append((int(r), index.ids[x], exact, exact + len(item_codes), 0))
            continue
        text = codes[begins[r] + a : begins[r] + e]
        dist, start, end = banded_distance(item_codes, text, low - a, high - a, k)
        if dist <= k:
            found.append((int(r), index.ids[x], start + a, end + a, dist))
    # Bands overlap, so one region can be found twice: keep the closest of regions that touch.
    found.sort(key=lambda f: (f[0], f[1], f[4], f[2], f[3]))
    kept: dict[tuple[int, int], list] = {}
    for f in found:
        near = kept.setdefault(f[:2], [])
        if not any(f[2] < g[3] and g[2] < f[3] for g in near):
            near.append(f)
    return [f for near in kept.values() for f in near]


def item_blocks(benchmark: DataFrame) -> Iterator[list[tuple[int, str]]]:
    """Blocks of (item_id, normalized text) of bounded size, read block by block."""
    held, size = [], 0
    rows = benchmark.where("text IS NOT NULL").select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    for row in rows.dropDuplicates().orderBy("item_id", "text").toLocalIterator():
        t = normalize(row.text)
        if not t:
            continue
        held.append((row.item_id, t))
        size += len(t)
        if size >= ITEM_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _grouped(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    first, size = 0, 0
    for r, t in enumerate(texts):
        if size and size + len(t) > BLOCK_CHARS:
            yield first, texts[first:r]
            first, size = r, 0
        size += len(t)
    if first < len(texts):
        yield first, texts[first:]


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, end, distance): the leaking regions, positions in the normalized text.

    Where the benchmark has several blocks, each is scanned for and stored before the next one is sent, so
    the executors hold one index.
    """
    schema = "doc_id bigint, item_id bigint, start bigint, end bigint, distance bigint"
    source = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    parts, before = [], None
    for block in item_blocks(benchmark):
        if before is not None:
            parts[-1] = written(parts[-1])
            before.unpersist()
        before = shared = docs.sparkSession.sparkContext.broadcast(build_index(block))  # at most ITEM_CHARS characters

        def scan(frames: Iterator[pd.DataFrame], shared=shared) -> Iterator[pd.DataFrame]:
            for frame in frames:
                texts = [normalize(t) for t in frame.iloc[:, 1]]
                ids = frame.iloc[:, 0].to_list()
                rows = [(ids[first + f[0]], *f[1:]) for first, part in _grouped(texts) for f in leaks_in(part, shared.value)]
                cols = list(zip(*rows, strict=True)) if rows else [[]] * 5
                yield pd.DataFrame({n: pd.array([None if v is None or v != v else int(v) for v in c], dtype="Int64")
                                    for n, c in zip(("doc_id", "item_id", "start", "end", "distance"), cols, strict=True)})

        parts.append(source.mapInPandas(scan, schema))
    return reduce(DataFrame.unionAll, parts) if parts else docs.sparkSession.createDataFrame([], schema)


def drop_leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no leaking region; judged in place."""
    where = docs.columns.index("text")
    for block in item_blocks(benchmark):
        shared = docs.sparkSession.sparkContext.broadcast(build_index(block))

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = [normalize(t) for t in batch.column(where).to_pylist()]
                clean = np.ones(len(texts), dtype=bool)
                for first, part in _grouped(texts):
                    for f in leaks_in(part, shared.value):
                        clean[first + f[0]] = False
                yield batch.filter(pa.array(clean))

        docs = docs.mapInArrow(scan, docs.schema)
    return docs


def op4_benchmark_qgram_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op4_benchmark_qgram_filter": op4_benchmark_qgram_filter}
ORACLES: dict[str, str] = {}
