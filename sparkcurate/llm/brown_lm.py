"""LM scoring with Brown class-based bigrams.

P(w | before) = P(class(w) | class(before)) * P(w | class(w)), both with additive smoothing.

* Classes. Their number is the fourth root of the training tokens. Exchange clustering starts with
  the ``CLUSTERED`` most frequent training words and the groups of word endings as symbols: each symbol moves to the class
  that raises the likelihood of the class bigrams most, until few move. Then every other training word makes its
  own exchange on Spark: the classes that stand before and after it, counted over all training
  texts, choose its class against the table of class bigrams; it stays in the class of its ending unless another raises
  the likelihood by more than ``STAY``. Only words that no training text has keep the class of their ending. The
  end of a text is a word and a class of its own, and the context of the first word.
* Counts cover all training texts: the ``FREQUENT`` most frequent words are a fixed array; all
  other words meet their contexts and counts in a shuffle by word, packed into arrays. Classes and counts go back to
  the texts in a second one, where each text becomes its sequence of classes. These are stored once:
  the class bigrams are counted over them, and then they are scored. A word common to a third of all
  texts is a frequent word, so no bucket grows with it; copies of a row are sent once by each flush of a task.
* The candidates for frequent words are found exactly: a word with at least a share ``HEAVY`` of
  all tokens has that share in at least one part of the corpus.

Words are handled as 64-bit hashes; two words with one hash would count as one.

Edge cases: null, empty and white-space texts are one end token. A null doc_id is hashed as empty
text for the fold. Repeated rows are scored each and count each in training. Ties between classes go to the
smaller number. A very long text costs memory of some 20 bytes a word in the task that holds it. Other columns are ignored.
An empty table gives an empty result; without training texts all counts are zero and N and V are 0.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import checkpointed
from .common import fold, table
from .textvec import mix, text_blocks, words

_U = np.uint64
FOLDS = 10
CLUSTERED, ENDINGS = 1024, 128
STAY = 2.0  # nats
FREQUENT = 16_384
HEAVY = 4e-6
ADD, ADD_CLASS = 0.1, 0.5
SWEEPS = 12
PART_TOKENS = 1 << 20  # tokens counted together when candidates are sought
FLUSH = 3 << 18  # postings or words packed together
TOGETHER = 256  # words whose contexts are summed together
BUCKETS, BUCKET_DOCS = 1024, 500
STATS_TARGETS = 64


@dataclass
class Model:
    """What every task needs: at most ``FREQUENT`` words, and tables of the classes."""

    frequent: np.ndarray  # sorted hashes
    count: np.ndarray  # training count of each frequent word
    class_of: np.ndarray  # class of each frequent word
    by_ending: np.ndarray  # class of each group of endings
    affinity: np.ndarray  # log of observed against expected bigrams: class before, then class after, by own class
    tokens: int
    log_next: np.ndarray | None = None  # log10 P(class | class before)
    class_words: np.ndarray | None = None  # distinct training words per class
    class_tokens: np.ndarray | None = None
    types: int = 0

    @property
    def classes(self) -> int:
        return self.affinity.shape[1]

    def log_room(self) -> np.ndarray:
        return np.log10(self.class_tokens + ADD * (self.class_words + 1))


def class_number(tokens: int) -> int:
    """Number of classes, with the one of the end."""
    return max(4, math.ceil(tokens**0.25))


def _ending(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Group of a word by its last two bytes, in lower case, and whether it is long."""
    last = raw[ends - 1].astype(np.uint64)
    before = np.where(ends - starts > 1, raw[np.maximum(ends - 2, 0)], 0).astype(np.uint64)
    last, before = (np.where((x >= 65) & (x <= 90), x + _U(32), x) for x in (last, before))
    return (mix(last * _U(257) + before * _U(65537) + (ends - starts > 8)) % _U(ENDINGS)).astype(np.int64)


def _blocks(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """(first row, rows, hashes, first word per row, ending group) of a batch with the text in column 0."""
    for row, raw, bounds in text_blocks(batch.column(0)):
        starts, ends, hashes, first = words(raw, bounds)
        yield row, len(bounds) - 1, hashes, first, _ending(raw, starts, ends) if len(starts) else np.zeros(0, np.int64)


def _symbols(hashes: np.ndarray, ending: np.ndarray, frequent: np.ndarray, symbol: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(symbol, place among the frequent words or -1) of each word."""
    if not len(frequent):
        return CLUSTERED + ending, np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
    hit = frequent[at] == hashes
    own = np.where(hit, symbol[at], -1)
    return np.where(own >= 0, own, CLUSTERED + ending), np.where(hit, at, -1)


_END = CLUSTERED + ENDINGS  # the symbol of the end of a text
_SYMBOLS = _END + 1


def frequent_words(train: DataFrame) -> np.ndarray:
    """Hashes of the most frequent words, the most frequent first; train has one column, text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def heavy() -> pa.RecordBatch:
            key, n = np.unique(np.concatenate(held), return_counts=True)
            keep = n >= HEAVY * size
            return pa.RecordBatch.from_arrays([pa.array(key[keep].view(np.int64)), pa.array(n[keep].astype(np.int64))], names=["h", "n"])

        for batch in batches:
            for _, _, hashes, _, _ in _blocks(batch):
                held.append(hashes)
                size += len(hashes)
                if size >= PART_TOKENS:
                    yield heavy()
                    held, size = [], 0
        if size:
            yield heavy()

    found = train.mapInArrow(run, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "h").limit(FREQUENT)
    return np.array([r.h for r in found.collect()], dtype=np.int64).view(_U)  # at most FREQUENT rows


def count_symbols(train: DataFrame, ranked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(matrix of symbol bigrams, counts and ending groups of the frequent words in sorted order)."""
    frequent = np.sort(ranked)
    symbol = _ranks(ranked, frequent)
    shared = train.sparkSession.sparkContext.broadcast((frequent, symbol))  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, symbol = shared.value
        pairs = np.zeros(_SYMBOLS * _SYMBOLS, dtype=np.int64)
        count, ends = np.zeros((2, len(frequent)), dtype=np.int64)
        for batch in batches:
            for _, rows, hashes, first, ending in _blocks(batch):
                sym, place = _symbols(hashes, ending, frequent, symbol)
                ends[place[place >= 0]] = ending[place >= 0]
                count += np.bincount(place[place >= 0], minlength=len(count))
                # Each text's words, with an end before and after.
                flow = np.full(len(sym) + rows + 1, _END)
                flow[np.arange(len(sym)) + np.repeat(np.arange(rows), np.diff(first)) + 1] = sym
                pairs += np.bincount(flow[:-1] * _SYMBOLS + flow[1:], minlength=len(pairs))
        used = np.flatnonzero(pairs.reshape(_SYMBOLS, _SYMBOLS).sum(1))
        rows_ = [pairs[i * _SYMBOLS : (i + 1) * _SYMBOLS].tobytes() for i in used]
        yield pa.RecordBatch.from_arrays(
            [pa.array([*used, -1, -2], pa.int64()), pa.array([*rows_, count.tobytes(), ends.tobytes()], pa.binary())], names=["i", "row"])

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[int, np.ndarray] = {}
        for frame in frames:
            for i, row in zip(frame.i, frame.row, strict=True):
                part = np.frombuffer(row, np.int64)
                total[i] = part.copy() if i not in total else (np.maximum if i == -2 else np.add)(total[i], part)
        yield pd.DataFrame({"i": list(total), "row": [v.tobytes() for v in total.values()]})

    # Each task sends a row of fixed size per symbol; the receiving tasks stream them into sums, so
    # they hold their part of one matrix, however many tasks send.
    summed = train.mapInArrow(run, "i bigint, row binary").repartition("i").mapInPandas(add, "i bigint, row binary")
    pairs = np.zeros((_SYMBOLS, _SYMBOLS), dtype=np.int64)
    count, ends = np.zeros((2, len(frequent)), dtype=np.int64)
    for r in summed.toLocalIterator():  # _SYMBOLS + 2 rows
        row = np.frombuffer(bytes(r.row), np.int64)
        if r.i == -1:
            count = row.copy()
        elif r.i == -2:
            ends = row.copy()
        else:
            pairs[r.i] = row
    return pairs, count, ends


def _ranks(ranked: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    symbol = np.full(len(frequent), -1, dtype=np.int64)
    top = ranked[:CLUSTERED]
    symbol[np.searchsorted(frequent, top)] = np.arange(len(top))
    return symbol


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange_clusters(pairs: np.ndarray, classes: int, sweeps: int = SWEEPS) -> np.ndarray:
    """Class of each symbol; the last symbol (the end) keeps the last class alone.

    In a sweep each symbol, the most frequent first, leaves its class and joins the one with the
    greatest likelihood of class bigrams.
    """
    n = len(pairs)
    size = pairs.sum(0)
    order = np.argsort(-size[:-1], kind="stable")
    class_of = np.zeros(n, dtype=np.int64)
    class_of[order] = np.arange(n - 1) % (classes - 1)
    class_of[-1] = classes - 1
    one = np.zeros((n, classes))
    one[np.arange(n), class_of] = 1
    after, before = pairs @ one, pairs.T @ one  # per symbol, how often each class follows and precedes
    table = (one.T @ after).astype(np.float64)
    for _ in range(sweeps):
        moved = 0
        for w in order:
            if size[w] == 0 and pairs[w].sum() == 0:
                continue
            old, own = class_of[w], float(pairs[w, w])
            r, l = after[w].copy(), before[w].copy()  # noqa: E741
            r[old] -= own
            l[old] -= own
            table[old] -= r
            table[:, old] -= l
            table[old, old] -= own
            rows, cols = table.sum(1), table.sum(0)
            total_r, total_l = r.sum() + own, l.sum() + own
            gain = (_xlogx(table + r[None, :]) - _xlogx(table)).sum(1) + (_xlogx(table + l[:, None]) - _xlogx(table)).sum(0)
            diag = np.diag(table)
            gain += _xlogx(diag + r + l + own) - _xlogx(diag + r) - _xlogx(diag + l) + _xlogx(diag)
            gain -= _xlogx(rows + total_r) - _xlogx(rows) + _xlogx(cols + total_l) - _xlogx(cols)
            gain[classes - 1] = -np.inf
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = int(old)
            table[new] += r
            table[:, new] += l
            table[new, new] += own
            if new != old:
                class_of[w] = new
                after[:, old] -= pairs[:, w]
                after[:, new] += pairs[:, w]
                before[:, old] -= pairs[w]
                before[:, new] += pairs[w]
                moved += 1
        if moved <= n // 200:
            break
    return class_of


def affinities(moves: np.ndarray) -> np.ndarray:
    """What a neighbour adds to the likelihood of a class: one row per class before, then one per class after."""
    seen = moves + ADD_CLASS
    pull = np.log(seen) - np.log(seen.sum(1, keepdims=True)) - np.log(seen.sum(0, keepdims=True)) + np.log(seen.sum())
    return np.concatenate([pull, pull.T])


def choose(code: np.ndarray, n: np.ndarray, start: np.ndarray, affinity: np.ndarray) -> np.ndarray:
    """Class of each word after its exchange.

    ``code``, sorted: word * 2 * classes + row of ``affinity``, with ``n`` occurrences; ``start``: class of each word before.
    """
    k = affinity.shape[1]
    word, side = code // (2 * k), code % (2 * k)
    out = start.copy()
    for first in range(0, len(start), TOGETHER):
        i, j = np.searchsorted(word, [first, first + TOGETHER])
        if i == j:
            continue
        new = np.flatnonzero(np.r_[True, word[i + 1 : j] != word[i : j - 1]])
        gain = np.add.reduceat(affinity[side[i:j]] * n[i:j, None], new, axis=0)
        gain[:, k - 1] = -np.inf
        who, best, at = word[i:j][new], gain.argmax(1), np.arange(len(new))
        moves = gain[at, best] > gain[at, start[who]] + STAY
        out[who[moves]] = best[moves]
    return out


def _places(hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Place of each word among the frequent words, or -1."""
    if not len(frequent):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
    return np.where(frequent[at] == hashes, at, -1)


def _neighbours(model: Model, place: np.ndarray, ending: np.ndarray, doc: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Classes before and after each word, as of before the exchange on Spark for words that are not frequent."""
    known = place >= 0
    cls = model.by_ending[ending]
    cls[known] = model.class_of[place[known]]
    flow = np.full(len(cls) + rows + 1, model.classes - 1)
    at = np.arange(len(cls)) + doc + 1
    flow[at] = cls
    return flow[at - 1], flow[at + 1]


def frequent_exchange(train: DataFrame, model: Model, settled: np.ndarray) -> np.ndarray:
    """Classes of the frequent words after their exchange; ``settled`` ones stay where they are."""
    shared = train.sparkSession.sparkContext.broadcast(model)
    k2 = 2 * model.classes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, held, size = shared.value, [], 0

        def pack() -> pa.RecordBatch:
            code, n = np.unique(np.concatenate(held), return_counts=True)
            part = code // (TOGETHER * k2)
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
            spans = list(zip(cuts, np.r_[cuts[1:], len(code)], strict=True))
            return pa.RecordBatch.from_arrays([
                pa.array(part[cuts]), pa.array([code[a:b].tobytes() for a, b in spans], pa.binary()),
                pa.array([n[a:b].tobytes() for a, b in spans], pa.binary())], names=["part", "code", "n"])

        for batch in batches:
            for _, rows, hashes, first, ending in _blocks(batch):
                place, doc = _places(hashes, m.frequent), np.repeat(np.arange(rows), np.diff(first))
                before, after = _neighbours(m, place, ending, doc, rows)
                hit = place >= 0
                if hit.any():
                    held.append(np.concatenate([place[hit] * k2 + before[hit], place[hit] * k2 + m.classes + after[hit]]))
                    size += len(held[-1])
            if size >= FLUSH:
                yield pack()
                held, size = [], 0
        if size:
            yield pack()

    def add(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m, total = shared.value, {}
        for frame in frames:
            for part, code, n in zip(frame.part, frame.code, frame.n, strict=True):
                sums = total.setdefault(part, np.zeros(TOGETHER * k2, np.int64))
                sums[np.frombuffer(code, np.int64) - part * TOGETHER * k2] += np.frombuffer(n, np.int64)
        for part, sums in total.items():
            code = np.flatnonzero(sums)
            start = m.class_of[part * TOGETHER : (part + 1) * TOGETHER]
            yield pd.DataFrame({"place": part * TOGETHER + np.arange(len(start)), "cls": choose(code, sums[code], start, m.affinity)})

    moved = train.mapInArrow(run, "part bigint, code binary, n binary").repartition("part").mapInPandas(add, "place bigint, cls bigint").toPandas()
    out = model.class_of.copy()  # at most FREQUENT rows
    out[moved.place.to_numpy(np.int64)] = moved.cls.to_numpy(np.int64)
    return np.where(settled, model.class_of, out)


def _row_key(doc_id: Column, text: Column) -> Column:
    return F.xxhash64(doc_id, text)


def _rare(hashes: np.ndarray, doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words that are not frequent, by text and hash: (their places in the block, first of each run, number of the run in its text)."""
    rare = np.flatnonzero(place < 0)
    at = rare[np.lexsort((hashes[rare], doc[rare]))]
    if not len(at):
        return at, at, at
    w, d = hashes[at], doc[at]
    new = np.flatnonzero(np.r_[True, (w[1:] != w[:-1]) | (d[1:] != d[:-1])])
    return at, new, np.arange(len(new)) - np.searchsorted(d[new], d[new])


def _spans(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices of all spans, one after the other."""
    return np.arange(length.sum()) + np.repeat(start - np.r_[0, np.cumsum(length)[:-1]], length)


def _rare_postings(docs: DataFrame, model: Model, buckets: int) -> DataFrame:
    """Packed postings of the words that are not frequent: per word and text the occurrences with their neighbours' classes."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def pack(held: list[tuple], near: list[np.ndarray]) -> pa.RecordBatch:
        word, key, number, tf, end = (np.concatenate(c) for c in zip(*held, strict=True))
        around = np.concatenate(near)
        bucket = (mix(word) % _U(buckets)).astype(np.int64)
        order = np.lexsort((word, bucket))
        size = np.abs(tf)
        start = (np.cumsum(size) - size)[order]
        word, key, number, tf, end, bucket, size = word[order], key[order], number[order], tf[order], end[order], bucket[order], size[order]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        out = []
        for a, b in zip(cuts, np.r_[cuts[1:], len(bucket)], strict=True):
            w = word[a:b]
            new = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
            reps = np.diff(np.r_[new, len(w)]).astype(np.int32)
            parts = [w[new], key[a:b], end[a:b][new], reps, number[a:b], tf[a:b], around[_spans(start[a:b], size[a:b])]]
            out.append((int(bucket[a]), len(new), b - a, b"".join(x.tobytes() for x in parts)))
        cols = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in cols[:3]), pa.array(cols[3], pa.binary())], names=["bucket", "types", "n", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, held, near, size = shared.value, [], [], 0
        for batch in batches:
            keys = batch.column(1).to_numpy(zero_copy_only=False)
            train = batch.column(2).to_numpy(zero_copy_only=False)
            for row, rows, hashes, first, ending in _blocks(batch):
                place, doc = _places(hashes, m.frequent), np.repeat(np.arange(rows), np.diff(first))
                before, after = _neighbours(m, place, ending, doc, rows)
                at, new, number = _rare(hashes, doc, place)
                if not len(at):
                    continue
                tf = np.diff(np.r_[new, len(at)])
                of = doc[at[new]] + row
                # The sign tells training texts (positive) from the others.
                held.append((hashes[at[new]], keys[of], number.astype(np.int32), np.where(train[of], tf, -tf).astype(np.int32), ending[at[new]].astype(np.int32)))
                near.append(np.stack([before[at], after[at]], axis=1).astype(np.int16))
                size += len(new)
                if size >= FLUSH:
                    yield pack(held, near)
                    held, near, size = [], [], 0
        if size:
            yield pack(held, near)

    return docs.select("text", "key", "train").mapInArrow(run, "bucket bigint, types bigint, n bigint, data binary")


def _unpack(types: int, n: int, data: bytes) -> tuple[np.ndarray, ...]:
    """(hash, key, ending, number in the text, occurrences) of each posting, and the classes around each occurrence."""
    word = np.frombuffer(data, _U, types)
    key = np.frombuffer(data, np.int64, n, types * 8)
    at = (types + n) * 8
    end, reps = np.frombuffer(data, np.int32, types, at), np.frombuffer(data, np.int32, types, at + types * 4)
    at += types * 8
    number, tf = np.frombuffer(data, np.int32, n, at), np.frombuffer(data, np.int32, n, at + n * 4)
    return np.repeat(word, reps), key, np.repeat(end, reps), number, tf, np.frombuffer(data, np.int16, -1, at + n * 8).reshape(-1, 2)


_TO_TEXT = "target bigint, n bigint, flow boolean, data binary"


def _settle_bucket(pdf: pd.DataFrame, model: Model, buckets: int) -> pd.DataFrame:
    """Counts and classes of one bucket of words, sent to the texts that have them.

    Negative targets take the number of training words per class.
    """
    word, key, end, number, tf, around = (
        np.concatenate(c) for c in zip(*[_unpack(t, n, d) for t, n, d in zip(pdf.types, pdf.n, pdf.data, strict=True)], strict=True))
    types, first, back = np.unique(word, return_index=True, return_inverse=True)
    count = np.bincount(back, np.maximum(tf, 0), len(types)).astype(np.int64)
    size = np.abs(tf)
    use = np.repeat(tf > 0, size)
    owner, around = np.repeat(back, size)[use] * (2 * model.classes), around[use].astype(np.int64)
    code, n = np.unique(np.concatenate([owner + around[:, 0], owner + model.classes + around[:, 1]]), return_counts=True)
    cls = choose(code, n, model.by_ending[end[first]], model.affinity)
    by_class = np.bincount(cls[count > 0], minlength=model.classes).astype(np.int64)
    out = [(-1 - int(pdf.bucket.iloc[0]) % STATS_TARGETS, 0, False, by_class.tobytes())]
    target = (mix(key.view(_U)) % _U(buckets)).astype(np.int64)
    order = np.lexsort((number, key, target))
    order = order[np.r_[True, (np.diff(key[order]) != 0) | (np.diff(number[order]) != 0)]]  # rows that occur twice
    key, number, target, of = key[order], number[order], target[order], back[order]
    cuts = np.flatnonzero(np.r_[True, target[1:] != target[:-1]])
    for a, b in zip(cuts, np.r_[cuts[1:], len(target)], strict=True):
        parts = [key[a:b], count[of[a:b]], number[a:b], cls[of[a:b]].astype(np.int16)]
        out.append((int(target[a]), b - a, False, b"".join(x.tobytes() for x in parts)))
    return pd.DataFrame(out, columns=["target", "n", "flow", "data"])


def _flows(docs: DataFrame, model: Model, buckets: int) -> DataFrame:
    """Texts as packed sequences: place of a frequent word, or -1 - number of another word in its text."""
    shared = docs.sparkSession.sparkContext.broadcast(model.frequent)

    def pack(held: dict[int, list]) -> pa.RecordBatch:
        keys = np.array(list(held), dtype=np.int64)
        target = (mix(keys.view(_U)) % _U(buckets)).astype(np.int64)
        order = np.argsort(target, kind="stable")
        cuts = np.flatnonzero(np.r_[True, np.diff(target[order]) != 0])
        out = []
        for a, b in zip(cuts, np.r_[cuts[1:], len(order)], strict=True):
            mine = keys[order[a:b]]
            copies = np.array([held[k][0] for k in mine.tolist()], np.int64)
            flows = [held[k][1] for k in mine.tolist()]
            parts = [mine, copies, np.array([len(f) for f in flows], np.int64), *flows]
            out.append((int(target[order[a]]), b - a, True, b"".join(x.tobytes() for x in parts)))
        cols = list(zip(*out, strict=True))
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2]), pa.array(cols[3], pa.binary())], names=["target", "n", "flow", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = {}, 0
        for batch in batches:
            keys = batch.column(1).to_numpy(zero_copy_only=False).tolist()
            train = batch.column(2).to_numpy(zero_copy_only=False)
            for row, rows, hashes, first, _ in _blocks(batch):
                place, doc = _places(hashes, shared.value), np.repeat(np.arange(rows), np.diff(first))
                at, new, number = _rare(hashes, doc, place)
                flow = place.astype(np.int32)
                flow[at] = -1 - np.repeat(number, np.diff(np.r_[new, len(at)]))
                for i in range(rows):
                    # Copies of a row share key and fold; the sign tells training texts from the others.
                    one = held.setdefault(keys[row + i], [0, flow[first[i] : first[i + 1]].copy()])
                    one[0] += 1 if train[row + i] else -1
                    size += len(one[1]) + 8
                if size >= 2 * FLUSH:
                    yield pack(held)
                    held, size = {}, 0
        if held:
            yield pack(held)

    return docs.select("text", "key", "train").mapInArrow(run, _TO_TEXT)


_CLASSED = "key bigint, copies bigint, n_tokens bigint, n_known bigint, emitted double, flow binary, words array<bigint>"


def _class_texts(pdf: pd.DataFrame, model: Model) -> pd.DataFrame:
    """Per text its sequence of classes and the sum of the logarithms of its counts."""
    if pdf.target.iloc[0] < 0:
        total = np.sum([np.frombuffer(d, np.int64) for d in pdf.data], axis=0)
        return pd.DataFrame({"key": [None], "copies": 0, "n_tokens": 0, "n_known": 0, "emitted": 0.0, "flow": b"", "words": [total]})
    settled, flows, copies = [], {}, {}
    for n, is_flow, d in zip(pdf.n, pdf.flow, pdf.data, strict=True):
        key = np.frombuffer(d, np.int64, n)
        if not is_flow:
            settled.append((key, np.frombuffer(d, np.int64, n, n * 8), np.frombuffer(d, np.int32, n, n * 16), np.frombuffer(d, np.int16, n, n * 20)))
            continue
        cuts = np.r_[0, np.cumsum(np.frombuffer(d, np.int64, n, n * 16))]
        flow = np.frombuffer(d, np.int32, -1, n * 24)
        for i, (k, c) in enumerate(zip(key.tolist(), np.frombuffer(d, np.int64, n, n * 8).tolist(), strict=True)):
            copies[k] = copies.get(k, 0) + c
            flows.setdefault(k, flow[cuts[i] : cuts[i + 1]])
    none = np.zeros(0, np.int64)
    key, count, number, cls = (np.concatenate(c) for c in zip(*settled, strict=True)) if settled else (none, none, none, none)
    order = np.lexsort((number, key))
    key, count, cls = key[order], count[order], cls[order]
    out = []
    for k in sorted(flows):
        flow, base = flows[k].astype(np.int64), np.searchsorted(key, k)
        hit = flow >= 0
        seq, n = np.empty(len(flow), np.int16), np.empty(len(flow), np.int64)
        seq[hit], n[hit] = model.class_of[flow[hit]], model.count[flow[hit]]
        at = base - 1 - flow[~hit]
        seq[~hit], n[~hit] = cls[at], count[at]
        out.append((k, copies[k], len(flow) + 1, int((n > 0).sum()), float(np.log10(n + ADD).sum()), seq.tobytes(), None))
    return pd.DataFrame(out, columns=["key", "copies", "n_tokens", "n_known", "emitted", "flow", "words"])


def _steps(flow: bytes, end: int) -> np.ndarray:
    return np.concatenate([[end], np.frombuffer(flow, np.int16), [end]])


def class_moves(classed: DataFrame, classes: int) -> np.ndarray:
    """Class bigrams of all training texts."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(classes * classes, np.int64)
        for frame in frames:
            if not len(frame):
                continue
            steps = [_steps(f, classes - 1) for f in frame.flow]
            code = np.concatenate([s[:-1] * classes + s[1:] for s in steps])
            weight = np.repeat(frame.copies.to_numpy(), [len(s) - 1 for s in steps])
            total += np.bincount(code, weight, len(total)).astype(np.int64)
        at = np.flatnonzero(total)
        yield pd.DataFrame({"at": at, "n": total[at]})

    found = classed.where("copies > 0").select("copies", "flow").mapInPandas(run, "at bigint, n bigint").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    moves = np.zeros(classes * classes, np.int64)  # one row per pair of classes
    moves[found["at"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return moves.reshape(classes, classes)


def learn(docs: DataFrame) -> tuple[Model, DataFrame]:
    """The model, and the distinct rows (key, copies, n_tokens, n_known, emitted, flow) as sequences of classes; docs: text, key, train."""
    train = docs.where("train").select("text")
    ranked = frequent_words(train)
    pairs, count, ends = count_symbols(train, ranked)
    tokens = int(pairs.sum())
    classes = class_number(tokens)
    frequent = np.sort(ranked)
    symbol = _ranks(ranked, frequent)
    of_symbol = exchange_clusters(pairs, classes)
    one = np.zeros((_SYMBOLS, classes))
    one[np.arange(_SYMBOLS), of_symbol] = 1
    start = of_symbol[np.where(symbol >= 0, symbol, CLUSTERED + ends)]
    model = Model(frequent, count, start, of_symbol[CLUSTERED:_END], affinities(one.T @ pairs @ one), tokens)
    model.class_of = frequent_exchange(train, model, symbol >= 0)
    buckets = max(BUCKETS, -(-docs.count() // BUCKET_DOCS))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    settled = _rare_postings(docs, model, buckets).groupBy("bucket").applyInPandas(lambda p: _settle_bucket(p, shared.value, buckets), _TO_TEXT)
    classed = checkpointed(
        settled.unionByName(_flows(docs, model, buckets)).groupBy("target").applyInPandas(lambda p: _class_texts(p, shared.value), _CLASSED))
    words_ = np.zeros(classes, np.int64)
    for r in classed.where("key IS NULL").select("words").collect():  # at most STATS_TARGETS rows
        words_ += np.array(r.words)
    words_ += np.bincount(model.class_of[count > 0], minlength=classes)
    classed = classed.where("key IS NOT NULL").drop("words")
    moves = class_moves(classed, classes)
    words_[classes - 1] += int(moves[:, classes - 1].sum() > 0)
    model.log_next = np.log10((moves + ADD_CLASS) / (moves.sum(1, keepdims=True) + ADD_CLASS * classes))
    model.class_words, model.class_tokens, model.types = words_, moves.sum(0), int(words_.sum())
    return model, classed


def keyed(docs: DataFrame, train: Column) -> DataFrame:
    """doc_id, text, train and the key of the row: equal rows share it."""
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        F.coalesce(train, F.lit(False)).alias("train")).withColumn("key", _row_key(F.col("doc_id"), F.col("text")))


def score_corpus(docs: DataFrame, train: Column) -> DataFrame:
    """(doc_id, train, n_tokens, n_known, train_tokens, base_score, score, perplexity) of every row.

    Learns from the rows where ``train`` holds and scores all.
    """
    docs = keyed(docs, train)
    model, classed = learn(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        room, end = m.log_room(), m.classes - 1
        for frame in frames:
            moves = []
            for flow in frame.flow:
                s = _steps(flow, end)
                moves.append(float((m.log_next[s[:-1], s[1:]] - room[s[1:]]).sum()))
            yield frame[["key", "n_tokens", "n_known", "emitted"]].assign(moves=np.array(moves, dtype=float))

    scored = classed.mapInPandas(run, "key bigint, n_tokens bigint, n_known bigint, emitted double, moves double")
    end = int(model.class_tokens[-1])
    emitted = F.col("emitted") + F.lit(float(np.log10(end + ADD)))
    base_room = float(np.log10(model.tokens + ADD * (model.types + 1)))
    out = docs.select("doc_id", "train", "key").join(scored, "key").select(
        "doc_id", "train", "n_tokens", (F.col("n_known") + F.lit(int(end > 0))).alias("n_known"), F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (emitted - F.col("n_tokens") * F.lit(base_room)).alias("base_score"), (emitted + F.col("moves")).alias("score"))
    return out.withColumn("perplexity", F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")))


def op10_brown_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_corpus(docs, fold(F.col("doc_id"), FOLDS) != 0).select(
        "doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score", "perplexity")


QUERIES = {"op10_brown_class_lm": op10_brown_class_lm}
ORACLES: dict[str, str] = {}
