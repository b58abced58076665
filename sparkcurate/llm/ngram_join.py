"""N-gram Jaccard join by T-occurrence search (DivideSkip), routed by posting lists that lose no link.

Two documents link when their sets of k-word shingles have Jaccard similarity >= percent/100.

1. Every text is scanned once for its set size, a 128-bit digest of the set and a bitmap: each shingle
   flips one of 2 n to 4 n bits. Equal sets become one class, numbered in a stored table (an
   aggregate, combined map-side). Classes, not ids, are what is searched and linked.
2. Posting lists. Linked sets of sizes a <= b differ in at most h = floor((1 - t) / t * a) shingles, so
   of h + 1 + z parts of the shingle universe at least 1 + z hold the same shingles in both. A
   signature per part (size interval, part, its shingles) makes a posting; linked sets share a list. Parts
   with no shingle carry no signature; a set with more than z such parts also sends the
   smallest hashes that a prefix filter needs, under each of them. Postings are packed into
   arrays before the shuffle. A signature that is common within one flush of a task is spread over the
   buckets record by record, so no task holds a list with a third of all rows.
3. Each list is a small search of its own. Bitmaps of two sets differ in no more bits than the sets
   differ in shingles, so pairs that differ in more than the similarity allows are no links; with so
   many bits, pairs below about 0.78 (of 0.8) fail. Passages that many texts share make lists, but
   no pair of their texts passes. Lists with equal members are searched once, long lists in
   blocks. Only edges that join components leave a search, never pairs.
4. What passes is grouped and decided by DivideSkip on the shingles themselves: the inverted lists of a
   query's shingles are sorted by length, short ones are merged and counted, long ones are probed by
   binary search for candidates that can still reach the required overlap. Groups above
   ``GROUP_SHINGLES`` or ``GROUP_SETS`` are cut into blocks.

``jaccard_links`` counts links: every pair of classes of a group is decided, large groups are cut by
set size, and each pair of blocks that can link meets once (``link_counts``, ``_big_links``).
``jaccard_components`` needs no pair inside one component already known, so a mass of near copies costs
little more than one star (``t_occurrence``, ``_big_groups``).

Edge cases: null and empty texts, and texts of white space, have an empty set, link with nothing
and are their own component. Fewer than k words: the whole sequence is one shingle. Repeated rows
of one doc_id are one node, linked when any of its texts is; links are counted per row and text. A
null doc_id is no name: such rows come back with null class and component and take no part. Texts of any
length are scanned whole; one of m words costs m log m. Other columns are ignored. An empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import checkpointed, lookup_join
from .common import components, table, written
from .textvec import mix, shingles, text_blocks, words

_U = np.uint64
FLUSH_POSTINGS = 1 << 18  # postings a task combines before it sends them
BLOCK_BYTES = 1 << 18  # texts hashed together
GROUP_SHINGLES = 1_000_000  # shingles of a block; a search holds two
GROUP_SETS = 2000  # sets of a block
BUCKET_DOCS = 250  # documents per bucket of postings
HOT_LIST = 64  # a signature with more records in one flush is spread over the buckets
LIST_SETS = 2000  # sets of a block of a posting list
# DivideSkip: the number of long lists is T / (MU * log2(longest list) + 1). A posting is merged some
# ten times faster than a list is probed, so most lists are merged.
MU = 1.0
PIVOT_FROM = 64  # groups of so many sets first compare all with a few pivots


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[object, np.ndarray]]:
    """(doc_id, shingle set) of each row of a batch with columns doc_id, text."""
    ids = batch.column(0)
    for row, raw, bounds in text_blocks(batch.column(1), BLOCK_BYTES):
        _, _, hashes, first = words(raw, bounds)
        for r, s in enumerate(shingles(hashes, first, k)):
            yield ids[row + r].as_py(), s


def _digest(s: np.ndarray) -> tuple[int, int]:
    one = int(np.add.reduce(mix(s), dtype=_U)) if len(s) else 0
    two = int(np.add.reduce(mix(s ^ _U(0x5851F42D4C957F2D)), dtype=_U)) if len(s) else 0
    return one, two


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _bitmap(s: np.ndarray) -> bytes:
    """Parities of the shingles that fall on each of at least 2 n bits, a power of two; 64 at least."""
    bits = 1 << max(6, (2 * len(s) - 1).bit_length())
    at = (mix(s ^ _U(0xA0761D6478BD642F)) & _U(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def set_sizes(docs: DataFrame, k: int) -> DataFrame:
    """(doc_id, n_shingles, d1, d2, bits): set size, digest and bitmap of every row."""
    kinds = [pa.int64()] * 4 + [pa.binary()]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(i, len(s), *map(_signed, _digest(s)), _bitmap(s)) for i, s in _sets(batch, k)]
            cols = list(zip(*out, strict=True)) if out else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["doc_id", "n_shingles", "d1", "d2", "bits"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        scan, "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, bits binary")


def _intervals(n: int, percent: int) -> tuple[int, int, int]:
    """(i, upper end of interval i, upper end of interval i - 1) for the size interval that holds n."""
    i, low, before = 0, 1, 0
    while True:
        high = low * 100 // percent
        if n <= high:
            return i, high, before
        i, low, before = i + 1, high + 1, high


@lru_cache(maxsize=None)
def _parts(upper: int, percent: int) -> tuple[int, int]:
    """(parts, spare parts) of a level: so many spare ones that few sets have more empty parts."""
    differ, low = upper * (100 - percent) // percent, upper * percent / 100
    spare = 0
    for _ in range(6):
        empty = (differ + 1 + spare) * math.exp(-low / (differ + 1 + spare))
        spare = math.ceil(empty + 3 * math.sqrt(empty))
    return differ + 1 + spare, spare


def signatures(s: np.ndarray, percent: int) -> np.ndarray:
    """Signatures such that any two linked sets share at least one."""
    n = len(s)
    i, high, before = _intervals(n, percent)
    scattered = mix(s ^ _U(0xD6E8FEB86659FD93))
    low, top = (s & _U(0xFFFFFFFF)).astype(np.float64), (s >> _U(32)).astype(np.float64)
    out = []
    for level, upper in ((i, high), (i - 1, before)):
        if upper == 0:
            continue
        parts, spare = _parts(upper, percent)
        at = (scattered % _U(parts)).astype(np.int64)
        size = np.bincount(at, minlength=parts)
        # Sums of 32-bit halves stay below 2**53, so they are exact.
        one, two = np.bincount(at, low, parts).astype(_U), np.bincount(at, top, parts).astype(_U)
        tag = mix(np.arange(parts, dtype=_U) + _U(level) * _U(1 << 40))
        full = size > 0
        out.append(mix(tag[full] + mix(one[full]) + mix(two[full] + _U(1 << 60)) * _U(3)))
        empty = tag[~full]
        if len(empty) > spare:
            prefix = np.sort(mix(s))[: n - -(-percent * n // 100) + 1]
            out.append(mix((mix(empty + _U(77))[:, None] + prefix[None, :]).ravel()))
    return np.concatenate(out) if out else s[:0]


def _coded(rec: np.ndarray) -> bytes:
    """Sorted record numbers as their first one and two-byte steps where these fit."""
    steps = np.diff(rec)
    if len(steps) and steps.max() < 1 << 16 and rec[-1] - rec[0] >= 0:
        return rec[:1].tobytes() + steps.astype(np.uint16).tobytes()
    return rec.tobytes()


def _decoded(data: bytes, count: int) -> np.ndarray:
    if len(data) == 8 * count:
        return np.frombuffer(data, np.int64)
    return np.cumsum(np.r_[np.frombuffer(data, np.int64, 1), np.frombuffer(data, np.uint16, count - 1, 8).astype(np.int64)])


def _pack(sig: np.ndarray, rec: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Postings by bucket of their signature. Those of hot signatures go to buckets by record, and their
    own bucket gets the signature without a record."""
    order = np.lexsort((rec, sig))
    sig, rec = sig[order], rec[order]
    starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
    count = np.diff(np.r_[starts, len(sig)])
    hot = np.repeat(count > HOT_LIST, count)
    blobs = []

    def deal(kind: int, to: np.ndarray, sig: np.ndarray, rec: np.ndarray) -> None:
        if not len(sig):
            return
        bucket = (mix(to) % _U(buckets)).astype(np.int64)
        order = np.lexsort((rec, bucket))
        sig, rec, bucket = sig[order], rec[order], bucket[order]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        for a, b in zip(cuts, np.r_[cuts[1:], len(bucket)], strict=True):
            blobs.append((int(bucket[a]), kind, sig[a:b].tobytes(), _coded(rec[a:b])))

    deal(0, sig[~hot], sig[~hot], rec[~hot])
    deal(1, rec[hot].astype(_U), sig[hot], rec[hot])
    marks = sig[starts[count > HOT_LIST]]
    deal(2, marks, marks, np.zeros(len(marks), np.int64))
    cols = list(zip(*blobs, strict=True)) if blobs else [[]] * 4
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=["bucket", "kind", "sigs", "recs"])


def _postings(batches: Iterator[pa.RecordBatch], k: int, percent: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Packed postings of all sets, combined per flush."""
    sigs, recs, held, seen = [], [], 0, set()
    for batch in batches:
        for i, s in _sets(batch, k):
            if i is None or not len(s):
                continue
            digest = (_digest(s))
            if digest in seen:  # an equal set of this flush: its class is known from the digest
                continue
            seen.add(digest)
            sig = signatures(s, percent)
            sigs.append(sig)
            recs.append(np.full(len(sig), i, dtype=np.int64))
            held += len(sig)
            if held >= FLUSH_POSTINGS:
                yield _pack(np.concatenate(sigs), np.concatenate(recs), buckets)
                sigs, recs, held, seen = [], [], 0, set()
    if sigs:
        yield _pack(np.concatenate(sigs), np.concatenate(recs), buckets)


def _lists(pdf: pd.DataFrame) -> pd.DataFrame:
    """(list, doc_id): the posting lists of a bucket with two records or more; lists with equal members are one.

    A list is named by its members, a hot one (of which other buckets hold parts) by its signature. Two
    lists that got one name by chance are searched together, which loses nothing.
    """
    kept, marks = [np.zeros((2, 0), dtype=np.int64)], [np.zeros(0, _U)]
    sig, rec = [np.zeros(0, _U)], [np.zeros(0, np.int64)]
    for kind, raw, members in zip(pdf.kind, pdf.sigs, pdf.recs, strict=True):
        own = np.frombuffer(raw, _U)
        if kind == 2:
            marks.append(own)
        elif kind == 1:
            kept.append(np.stack([mix(own).view(np.int64), _decoded(members, len(own))]))
        else:
            sig.append(own)
            rec.append(_decoded(members, len(own)))
    sig, rec = np.concatenate(sig), np.concatenate(rec)
    order = np.lexsort((rec, sig))
    sig, rec = sig[order], rec[order]
    new = np.r_[True, (sig[1:] != sig[:-1]) | (rec[1:] != rec[:-1])][: len(sig)]
    sig, rec = sig[new], rec[new]
    if len(sig):
        starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        count = np.diff(np.r_[starts, len(sig)])
        hot = np.isin(sig[starts], np.concatenate(marks))
        name = np.where(hot, mix(sig[starts]), mix(np.add.reduceat(mix(rec.astype(_U)), starts)))
        use = np.repeat(hot | (count > 1), count)
        kept.append(np.stack([np.repeat(name, count)[use].view(np.int64), rec[use]]))
    both = np.unique(np.concatenate(kept, axis=1), axis=1)
    return pd.DataFrame({"list": both[0], "doc_id": both[1]})


def _bit_search(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """(a, b): classes of a list whose bitmaps allow a link, each with the smallest of its component. With a
    column ``is_query``, pairs without a query are left out."""
    out = [np.zeros((2, 0), dtype=np.int64)]
    for _, part in pdf.groupby("grp", sort=False):
        part = part.sort_values("n", kind="stable")
        if "is_query" in part:
            part = part.sort_values("is_query", ascending=False, kind="stable").drop_duplicates("class").sort_values("n", kind="stable")
        ids, size = part["class"].to_numpy(np.int64), part["n"].to_numpy(np.int64)
        query = part["is_query"].to_numpy(bool) if "is_query" in part else None
        maps = [np.frombuffer(b, _U) for b in part["bits"]]
        width = np.array([len(m) for m in maps])  # ascends with the size
        at, rows = -1, np.zeros((0, 0), _U)
        ends = np.searchsorted(size, size * 100 // percent, side="right")
        group = _Union(len(ids))
        for x in range(len(ids) - 1):
            a, b = x + 1, int(ends[x])
            if b <= a:
                continue
            if at < 0 or width[x] != width[at]:  # partners have as many bits or more, which are folded
                at, last = x, np.searchsorted(size, size[width == width[x]].max() * 100 // percent, side="right")
                rows = np.stack([np.bitwise_xor.reduce(m.reshape(-1, width[x]), axis=0) for m in maps[x:last]])
            differ = np.bitwise_count(rows[a - at : b - at] ^ rows[x - at]).sum(axis=1, dtype=np.int64)
            near = (100 + percent) * differ <= (100 - percent) * (size[a:b] + size[x])
            if query is not None and not query[x]:
                near &= query[a:b]
            for y in np.unique(group.up[a:b][near]).tolist():
                group.join(x, y)
        root = group.roots()
        low = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(low, root, ids)
        out.append(np.stack([ids, low[root]])[:, ids != low[root]])
    a, b = np.concatenate(out, axis=1)
    return pd.DataFrame({"a": a, "b": b})


class _Union:
    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return int(x)

    def roots(self) -> np.ndarray:
        up = self.up
        while not np.array_equal(up, nxt := up[up]):
            up = nxt
        self.up = up.copy()
        return self.up

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)


def t_occurrence(sets: list[np.ndarray], percent: int, queries: np.ndarray | None = None) -> np.ndarray:
    """Component number of each set. With ``queries`` (a mask) only links with a query count."""
    n = len(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    flat = np.concatenate(sets) if n else np.zeros(0, _U)
    order = np.argsort(flat, kind="stable")  # equal tokens stay in the order of their sets
    posting, token = np.repeat(np.arange(n, dtype=np.int32), sizes)[order], flat[order]
    del order
    starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]]) if len(token) else np.zeros(0, np.int64)
    keys, bounds = token[starts], np.r_[starts, len(token)]
    del token, starts
    first = np.r_[0, np.cumsum(sizes)]
    group = _Union(n)
    wanted = np.ones(n, dtype=bool) if queries is None else queries

    def enough(overlap: np.ndarray, x: int, y: np.ndarray) -> np.ndarray:
        return 100 * overlap >= percent * (sizes[x] + sizes[y] - overlap)

    done = np.zeros(n, dtype=bool)
    if n >= PIVOT_FROM:
        # All overlaps of a few pivots at once; a mass of near copies becomes one component.
        for _ in range(4):
            open_ = np.flatnonzero(wanted & ~done)
            if not len(open_):
                break
            roots = group.roots()
            lone = open_[roots[open_] == open_]
            p = int((lone if len(lone) else open_)[len(lone if len(lone) else open_) // 2])
            at = np.searchsorted(sets[p], flat)
            hit = sets[p][np.minimum(at, sizes[p] - 1)] == flat
            overlap = np.add.reduceat(hit, first[:-1], dtype=np.int64)
            for y in np.flatnonzero(enough(overlap, p, np.arange(n))):
                group.join(p, int(y))
            done[p] = True
    roots = group.roots()
    count = np.bincount(roots, minlength=n)
    main = int(np.argmax(count)) if n else 0
    for x in np.flatnonzero(wanted & ~done):
        if queries is None and count[main] > 1 and roots[x] == main:
            continue  # met by the queries outside the largest component
        size = int(sizes[x])
        need = -(-percent * size // 100)  # least overlap over all partner sizes
        at = np.searchsorted(keys, sets[x])
        length = bounds[at + 1] - bounds[at]
        by = np.argsort(length, kind="stable")
        longest = int(length[by[-1]])
        long_ = min(need - 1, int(need / (MU * np.log2(max(2, longest)) + 1)))
        short, probed = by[: size - long_], by[size - long_ :]
        merged = np.concatenate([posting[bounds[at[j]] : bounds[at[j] + 1]] for j in short])
        seen = np.bincount(merged, minlength=0)
        cand = np.flatnonzero(seen >= need - long_)
        cand = cand[(cand != x) & (100 * np.minimum(sizes[cand], size) >= percent * np.maximum(sizes[cand], size))]
        cand = cand[np.argsort(-seen[cand], kind="stable")]
        step = 4
        while len(cand):
            mine = group.root(int(x))
            cand = cand[np.array([group.root(int(y)) != mine for y in cand], dtype=bool)]
            part, cand = np.sort(cand[:step]), cand[step:]
            step *= 4
            overlap = seen[part].astype(np.int64)
            for left, j in enumerate(probed[::-1]):
                rest = len(probed) - left
                part_ok = enough(overlap + rest, int(x), part)
                if not part_ok.all():
                    part, overlap = part[part_ok], overlap[part_ok]
                if not len(part):
                    break
                row = posting[bounds[at[j]] : bounds[at[j] + 1]]
                spot = np.minimum(np.searchsorted(row, part), len(row) - 1)
                overlap = overlap + (row[spot] == part)
            for y in part[enough(overlap, int(x), part)]:
                group.join(int(x), int(y))
    return group.roots()


def link_counts(sets: list[np.ndarray], weights: np.ndarray, percent: int, left: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(component number, links) of each set; a link counts with the weight of the set at its other end.

    All sets are non-empty and different. With ``left`` (a mask) only pairs of a set inside and one
    outside it count. Sets are queries by size, so partners not yet met follow within a range. Of a
    query's inverted lists the short ones are merged and counted; the long ones are probed by binary
    search for the sets that can still reach the required overlap.
    """
    n = len(sets)
    order = np.argsort([len(s) for s in sets], kind="stable")
    sizes = np.array([len(sets[i]) for i in order], dtype=np.int64)
    weights = weights[order]
    side = None if left is None else left[order]
    flat = np.concatenate([sets[i] for i in order])
    by = np.argsort(flat, kind="stable")  # postings of a list ascend
    token, posting = flat[by], np.repeat(np.arange(n, dtype=np.int32), sizes)[by]
    starts = np.flatnonzero(np.r_[True, token[1:] != token[:-1]])
    length = np.diff(np.r_[starts, len(token)])
    lists = np.empty(len(flat), dtype=np.int64)  # list of each shingle
    lists[by] = np.repeat(np.arange(len(starts)), length)
    del flat, by, token
    first = np.r_[0, np.cumsum(sizes)]
    ends = np.searchsorted(sizes, sizes * 100 // percent, side="right")
    needs = -(-2 * percent * sizes // (100 + percent))  # least overlap with a set of at least this size
    group, links = _Union(n), np.zeros(n, dtype=np.int64)
    for x in range(n - 1):
        low, end, need = x + 1, int(ends[x]), int(needs[x])
        own = lists[first[x] : first[x + 1]]
        own = own[length[own] > 1]
        if end <= low or len(own) < need:
            continue
        own = own[np.argsort(length[own], kind="stable")]
        long_ = min(need - 1, int(need / (MU * math.log2(max(2, int(length[own[-1]]))) + 1)))
        short, probed = own[: len(own) - long_], own[len(own) - long_ :]
        count = length[short]
        to = np.cumsum(count)
        merged = posting[np.repeat(starts[short] - to + count, count) + np.arange(to[-1])]
        merged = merged[(merged >= low) & (merged < end)]
        if 8 * len(merged) < end - low:
            part, overlap = np.unique(merged, return_counts=True)
        else:
            part, overlap = np.arange(low, end), np.bincount(merged - low, minlength=end - low)
        able = overlap >= need - long_
        if side is not None:
            able &= side[part] != side[x]
        part, overlap = part[able], overlap[able]
        for rest, j in zip(range(long_, 0, -1), probed[::-1], strict=True):
            able = (100 + percent) * (overlap + rest) >= percent * (sizes[x] + sizes[part])
            part, overlap = part[able], overlap[able]
            if not len(part):
                break
            row = posting[starts[j] : starts[j] + length[j]]
            overlap = overlap + (row[np.minimum(np.searchsorted(row, part), len(row) - 1)] == part)
        part = part[(100 + percent) * overlap >= percent * (sizes[x] + sizes[part])]
        if len(part):
            links[x] += weights[part].sum()
            links[part] += weights[x]
            for y in np.unique(group.up[part]):
                group.join(x, int(y))
            group.up[part] = group.root(x)
    roots, counted = np.empty(n, dtype=np.int64), np.empty(n, dtype=np.int64)
    roots[order], counted[order] = order[group.roots()], links
    return roots, counted


_LINKS = "a bigint, b bigint, links bigint"


def _class_sets(part: pd.DataFrame, k: int) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
    """(classes, their sets, positions in ``part``): one row per class; texts with another set are left out."""
    batch = pa.RecordBatch.from_arrays([pa.array(part["class"], pa.int64()), pa.array(part.text, pa.string())], names=["class", "text"])
    rows = {}
    for at, ((i, s), d1) in enumerate(zip(_sets(batch, k), part.d1, strict=True)):
        if i not in rows and _signed(_digest(s)[0]) == d1:
            rows[i] = (s, at)
    return np.array(list(rows), dtype=np.int64), [s for s, _ in rows.values()], np.array([at for _, at in rows.values()], dtype=np.int64)


def _count(pdf: pd.DataFrame, k: int, percent: int) -> pd.DataFrame:
    """(a, b, links): each class of the pack, the smallest class of its component and its links, per group.

    A group with a column ``is_left`` that differs between rows is a pair of blocks.
    """
    out = [np.zeros((3, 0), dtype=np.int64)]
    for _, part in pdf.groupby("grp", sort=False):
        ids, sets, at = _class_sets(part, k)
        if not len(ids):
            continue
        left = part.is_left.to_numpy(bool)[at] if "is_left" in part else None
        if left is not None and left.all():  # a block with itself
            left = None
        roots, links = link_counts(sets, part.w.to_numpy(np.int64)[at], percent, left)
        low = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(low, roots, ids)
        out.append(np.stack([ids, low[roots], links]))
    a, b, links = np.concatenate(out, axis=1)
    return pd.DataFrame({"a": a, "b": b, "links": links})


def _blocks(n: Column) -> Column:
    """Number of blocks for rows with ``n`` shingles each, as an aggregate."""
    return F.ceil(F.greatest(F.sum(n) / GROUP_SHINGLES, F.count(F.lit(1)) / GROUP_SETS)).cast("bigint")


def _big_links(rows: DataFrame, percent: int, k: int, largest: int) -> DataFrame:
    """Links of groups that are too large for one search: columns grp, class, d1, text, n, w.

    Linked sets are in one size interval or in neighbouring ones (``_intervals``). Each interval of a
    group is cut into blocks by hash, and each pair of blocks of one or of neighbouring intervals is
    searched once.
    """
    uppers, low = [], 1
    while low <= largest:
        uppers.append(low * 100 // percent)
        low = uppers[-1] + 1
    level = F.size(F.filter(F.array(*[F.lit(u).cast("bigint") for u in uppers]), lambda u: u < F.col("n")))
    cut = rows.withColumn("level", level)
    held = checkpointed(cut.select("grp", "level", "class", "n").distinct().groupBy("grp", "level").agg(_blocks(F.col("n")).alias("blocks")))
    near = held.select("grp", (F.col("level") + 1).alias("level"), F.col("blocks").alias("before")).join(held, ["grp", "level"], "full").join(
        held.select("grp", (F.col("level") - 1).alias("level"), F.col("blocks").alias("after")), ["grp", "level"], "left").where("blocks IS NOT NULL")
    blk = F.pmod(F.xxhash64("class"), F.col("blocks"))

    def pairs(count: Column, to_pair: Callable[[Column], Column]) -> Column:
        return F.when(count > 0, F.transform(F.sequence(F.lit(0).cast("bigint"), count - 1), to_pair)).otherwise(F.array())

    def pair(la: Column, a: Column, lb: Column, b: Column, is_left: Column) -> Column:
        return F.struct(la.alias("la"), a.alias("ba"), lb.alias("lb"), b.alias("bb"), is_left.alias("is_left"))

    here, yes, no = F.col("level"), F.lit(True), F.lit(False)
    meets = F.concat(
        pairs(F.col("blocks"), lambda j: pair(here, F.least("blk", j), here, F.greatest("blk", j), F.col("blk") <= j)),
        pairs(F.col("after"), lambda j: pair(here, F.col("blk"), here + 1, j, yes)),
        pairs(F.col("before"), lambda j: pair(here - 1, j, here, F.col("blk"), no)))
    dealt = lookup_join(cut, near, ["grp", "level"], "inner").withColumn("blk", blk).withColumn("m", F.explode(meets)).select(
        "grp", "m.la", "m.ba", "m.lb", "m.bb", "m.is_left", "class", "d1", "text", "w")
    return dealt.groupBy("grp", "la", "ba", "lb", "bb").applyInPandas(partial(_count, k=k, percent=percent), _LINKS)


def _search(pdf: pd.DataFrame, k: int, percent: int) -> pd.DataFrame:
    """(a, b): each class of the pack and the smallest class of its component, per group."""
    out = [np.zeros((2, 0), dtype=np.int64)]
    for _, part in pdf.groupby("grp", sort=False):
        if "is_query" in part:
            part = part.sort_values("is_query", ascending=False, kind="stable")
        ids, sets, at = _class_sets(part, k)
        if not len(ids):
            continue
        roots = t_occurrence(sets, percent, part.is_query.to_numpy(bool)[at] if "is_query" in part else None)
        low = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(low, roots, ids)
        out.append(np.stack([ids, low[roots]]))
    a, b = np.concatenate(out, axis=1)
    return pd.DataFrame({"a": a, "b": b})


def _big_groups(rows: DataFrame, run: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Edges of groups that are too large for one search: columns grp, class, n, blocks and what ``run`` searches by.

    First every block is searched together with block 0. What is in the largest component
    then needs no further check among itself; every other class is searched against all
    blocks. For a mass of near copies this moves each class about twice.
    """
    payload = [c for c in rows.columns if c not in ("grp", "class", "blocks")]
    cut = rows.withColumn("blk", F.pmod(F.xxhash64("class"), F.col("blocks")))
    with_hub = cut.withColumn("with", F.explode(F.when(F.col("blk") == 0, F.sequence(F.lit(1).cast("bigint"), F.col("blocks") - 1)).otherwise(F.array("blk"))))
    first = checkpointed(with_hub.select("grp", "with", "class", *payload).groupBy("grp", "with").applyInPandas(run, "a bigint, b bigint"))
    label = components(first.where("a <> b")).select(F.col("node").alias("class"), F.col("label"))
    named = cut.select("grp", "class", "blk", "blocks", "n").distinct().join(label, "class", "left").withColumn("label", F.coalesce("label", "class"))
    main = (
        named.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("m"))
        .groupBy("grp").agg(F.max_by("label", F.struct("m", "label")).alias("main"))
    )
    others = named.join(main, "grp").where("label <> main")
    parts = others.groupBy("grp").agg(F.greatest(F.lit(1), _blocks(F.col("n"))).cast("bigint").alias("parts"))
    others = checkpointed(others.join(parts, "grp").select("grp", "class", F.pmod(F.xxhash64("class", F.lit(1)), F.col("parts")).alias("part")))
    asked = (
        cut.join(others, ["grp", "class"])
        .withColumn("with", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
        .select("grp", "part", "with", "class", *payload, F.lit(True).alias("is_query"))
    )
    held = (
        cut.join(parts, "grp")
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)))
        .select("grp", "part", F.col("blk").alias("with"), "class", *payload, F.lit(False).alias("is_query"))
    )
    second = asked.unionAll(held).groupBy("grp", "part", "with").applyInPandas(run, "a bigint, b bigint")
    return first.unionAll(checkpointed(second)).where("a <> b").distinct()


def _candidates(docs: DataFrame, named: DataFrame, classes: DataFrame, k: int, percent: int) -> DataFrame:
    """(class, grp): the classes that share a posting list with one whose bitmap allows a link, by component."""
    buckets = max(1024, -(-named.count() // BUCKET_DOCS))
    blobs = docs.mapInArrow(partial(_postings, k=k, percent=percent, buckets=buckets), "bucket bigint, kind bigint, sigs binary, recs binary")
    members = blobs.groupBy("bucket").applyInPandas(_lists, "list bigint, doc_id bigint").distinct()
    of = named.where("class IS NOT NULL").select("doc_id", "class").distinct()
    members = written(members.join(of, "doc_id").select(F.col("list").alias("grp"), "class").distinct())
    sizes = members.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / LIST_SETS).cast("bigint").alias("blocks"), F.count(F.lit(1)).alias("m")).where("m > 1")
    sketch = classes.select("class", F.col("n_shingles").alias("n"), "bits")
    rows = members.join(sizes, "grp").join(sketch, "class")
    run = partial(_bit_search, percent=percent)
    small, big = rows.where("blocks = 1").drop("blocks", "m"), rows.where("blocks > 1").drop("m")
    packs = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), members.count() // (10 * LIST_SETS) + 1)
    edges = small.withColumn("pack", F.pmod(F.xxhash64("grp"), F.lit(packs))).groupBy("pack").applyInPandas(run, "a bigint, b bigint")
    if sizes.where("blocks > 1").limit(1).count():
        edges = edges.unionAll(_big_groups(big, run))
    return components(edges).select(F.col("node").alias("class"), F.col("label").alias("grp"))


def _routed(docs: DataFrame, k: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(every row as doc_id, n_shingles, class; classes; the classes that others may link with: class, d1, low, w, grp, n, total, blocks).

    A class has its number, its digest, its smallest doc_id ``low``, its rows ``w`` and a bitmap. Rows
    with an empty set or without a doc_id have no class.
    """
    sized = written(set_sizes(docs, k))
    classes = written(
        sized.where("n_shingles > 0 AND doc_id IS NOT NULL").groupBy("d1", "d2", "n_shingles").agg(
            F.min("doc_id").alias("low"), F.count(F.lit(1)).alias("w"), F.first("bits").alias("bits"))
        .withColumn("class", F.monotonically_increasing_id()))
    keyed = classes.select(F.col("d1").alias("k1"), F.col("d2").alias("k2"), F.col("n_shingles").alias("k3"), "class")
    keys = sized.select("doc_id", "n_shingles", *[F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col(c)).alias(k) for c, k in
                                                  (("d1", "k1"), ("d2", "k2"), ("n_shingles", "k3"))])
    named = written(lookup_join(keys, keyed, ["k1", "k2", "k3"]).select("doc_id", "n_shingles", "class"))
    groups = _candidates(docs, named, classes, k, percent)
    rows = groups.join(classes.select("class", "d1", "low", "w", F.col("n_shingles").alias("n")), "class")
    sizes = rows.groupBy("grp").agg(F.sum("n").alias("total"), _blocks(F.col("n")).alias("blocks"))
    return named, classes, written(rows.join(sizes, "grp"))


def _texts(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """``rows`` with the texts of their smallest doc_id, which has a text with the set of the class."""
    held = F.struct(*[c for c in rows.columns if c != "low"])
    wanted = rows.groupBy("low").agg(F.collect_list(held).alias("_held"))  # one class, but for ids with several texts
    text = lookup_join(docs.where("doc_id IS NOT NULL").withColumnRenamed("doc_id", "low"), wanted, "low", "inner")
    return text.select("text", F.explode("_held").alias("_h")).select("_h.*", "text")


def _typed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _packs(spark: SparkSession, total: int) -> int:
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // (GROUP_SHINGLES // 2) + 1)


def _components_of(named: DataFrame, classes: DataFrame, edges: DataFrame) -> DataFrame:
    """``named`` with class_id (the smallest doc_id of the class) and component_id, from edges (a, b) of classes.

    Classes that share a doc_id are one node."""
    shared = named.where("class IS NOT NULL").groupBy("doc_id").agg(F.min("class").alias("a"), F.max("class").alias("m")).where("a < m").select("doc_id", "a")
    chained = named.join(shared, "doc_id").select("a", F.col("class").alias("b"))
    found = components(edges.where("a <> b").select("a", "b").unionAll(chained)).select(F.col("node").alias("class"), "label")
    placed = classes.select("class", "low").join(found, "class", "left").withColumn("label", F.coalesce("label", "class"))
    lows = placed.groupBy("label").agg(F.min("low").alias("component_id"))
    placed = lookup_join(placed, lows, "label").select("class", F.col("low").alias("class_id"), "component_id")
    joined = lookup_join(named, placed, "class")
    return joined.withColumns({c: F.coalesce(c, "doc_id") for c in ("class_id", "component_id")})


def _grouped(docs: DataFrame, rows: DataFrame, run: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """The groups of one block each, searched in packs."""
    total = rows.agg(F.sum("n")).first()[0] or 0
    text = _texts(docs, rows.where("blocks = 1").select("low", "class", "d1", "grp", "w"))
    packs = _packs(docs.sparkSession, total)
    return text.withColumn("pack", F.pmod(F.xxhash64("grp"), F.lit(packs))).groupBy("pack").applyInPandas(run, schema)


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id) of every row of ``docs`` (doc_id, text).

    ``class_id`` is the smallest doc_id with an equal set; ``component_id`` the smallest doc_id
    reachable by links.
    """
    docs = _typed(docs)
    named, classes, rows = _routed(docs, k, percent)
    run = partial(_search, k=k, percent=percent)
    edges = _grouped(docs, rows, run, "a bigint, b bigint")
    large = rows.where("blocks > 1")
    if large.limit(1).count():
        edges = edges.unionAll(_big_groups(_texts(docs, large.select("low", "class", "d1", "grp", "n", "blocks")), run))
    return _components_of(named, classes, edges).select("doc_id", "n_shingles", "class_id", "component_id")


def jaccard_links(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id, n_links) of every row of ``docs`` (doc_id, text).

    As ``jaccard_components``, and ``n_links`` is the number of other rows (with a doc_id) that the row
    links with, rows with an equal set among them; it is null for a null doc_id. Every link is verified.
    """
    docs = _typed(docs)
    named, classes, rows = _routed(docs, k, percent)
    found = _grouped(docs, rows, partial(_count, k=k, percent=percent), _LINKS)
    large = rows.where("blocks > 1")
    largest = large.agg(F.max("n")).first()[0]
    if largest is not None:
        found = found.unionAll(_big_links(_texts(docs, large.select("low", "class", "d1", "grp", "n", "w")), percent, k, int(largest)))
    found = written(found.where("links > 0"))
    counts = classes.select("class", "w").join(found.groupBy(F.col("a").alias("class")).agg(F.sum("links").alias("links")), "class", "left")
    counted = lookup_join(_components_of(named, classes, found), counts, "class")
    n_links = F.when(F.col("doc_id").isNotNull(), F.coalesce(F.col("w") - 1, F.lit(0)) + F.coalesce("links", F.lit(0)))
    return counted.select("doc_id", "n_shingles", "class_id", "component_id", n_links.cast("bigint").alias("n_links"))


def keep_one(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose doc_id is the smallest of its component; each such doc_id once.

    Rows with a null doc_id are kept as they are.
    """
    found = checkpointed(jaccard_components(docs, k, percent).where("doc_id IS NOT NULL").select("doc_id", "component_id"))
    per_id = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows"), F.first("component_id").alias("component_id"))
    # Only ids that go, or that repeat, are named; texts move only when these are too many to broadcast.
    marked = per_id.where("doc_id <> component_id OR rows > 1").select(
        F.col("doc_id").alias("__id"), (F.col("doc_id") == F.col("component_id")).alias("__stays"))
    rows = lookup_join(docs.withColumn("__id", F.col("doc_id").cast("bigint")), marked, "__id", "left")
    single = rows.where("__stays IS NULL").select(docs.columns)
    several = rows.where("__stays").dropDuplicates(["__id"]).select(docs.columns)
    return single.unionAll(several)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``documents``: four words, 85 percent, with the number of links of each."""
    return jaccard_links(table(spark, sf_dir, "documents"), k=4, percent=85)


QUERIES = {"op2_ngram_jaccard_join": op2_ngram_jaccard_join}
ORACLES = {
    "op2_ngram_jaccard_join": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
        t AS (SELECT doc_id, len(w) AS n, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM d),
        l AS (
            SELECT doc_id, n, i, a, lead(a, 1) OVER v AS b, lead(a, 2) OVER v AS c, lead(a, 3) OVER v AS e FROM t
            WINDOW v AS (PARTITION BY doc_id ORDER BY i)),
        s AS (SELECT DISTINCT doc_id, concat_ws(' ', a, b, c, e) AS g FROM l WHERE e IS NOT NULL OR (n < 4 AND i = 1)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        p AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id),
        e AS (
            SELECT x, y FROM p JOIN n u ON u.doc_id = x JOIN n v ON v.doc_id = y
            WHERE 100 * i >= 85 * (u.n + v.n - i)),
        r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e.y, r.c FROM r JOIN e ON r.doc_id = e.x),
        m AS (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles,
            m.component_id AS component_id, k.class_id AS class_id,
            (SELECT count(*) FROM e WHERE e.x = d.doc_id) AS n_links
        FROM d LEFT JOIN n USING (doc_id) JOIN m USING (doc_id) JOIN (
            SELECT doc_id, CASE WHEN g IS NULL THEN doc_id ELSE min(doc_id) OVER (PARTITION BY g) END AS class_id
            FROM (SELECT d.doc_id, q.g FROM d LEFT JOIN (
                SELECT doc_id, string_agg(g, chr(1) ORDER BY g) AS g FROM s GROUP BY doc_id) q USING (doc_id))) k USING (doc_id)
    """,
}
