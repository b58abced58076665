"""Quality classifier: gated-attention multiple-instance learning over the passages of a document.

A document is a bag of passages of ``PASSAGE_WORDS`` words (the last may be shorter). Every
passage is described by byte statistics of its own (shares of character kinds and of common
separators, word lengths, repeated words), encoded by a learned layer, weighted by gated attention
(tanh times sigmoid, softmax over the bag), and the weighted sum is scored by a logistic unit.
Only document labels are used for learning.

The model is fitted on a bounded sample: at most ``max_docs`` labelled documents, chosen by a hash
of the doc_id, of the folds that are not held out. The sample is described by Spark tasks and
fitted in one task's memory; scoring runs over all rows in Arrow batches.

Edge cases: null, empty and white-space texts are one passage of zeros and get the score the
model gives it. Repeated label rows of one doc_id count by their mean (at least a half is 1);
null labels and null doc_ids never train. Without any usable label the score is the constant 0.5.
Repeated rows are scored each. Other columns of ``docs`` stay out of the score and of the result.
An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import fold, table
from .textvec import text_blocks, words

PASSAGE_WORDS = 50
MAX_DOCS = 6000
HIDDEN, ATTENTION = 12, 6
EPOCHS, RATE, BATCH, DECAY = 30, 0.01, 32, 1e-4
THRESHOLD = 0.3
FOLDS = 5

_SINGLE = [ord(c) for c in "|%$&*#!.,\"\n"]
_KINDS = 5 + len(_SINGLE)
FEATURES = _KINDS + 8


def _kind_table() -> np.ndarray:
    """Row b: which of the counted kinds byte b belongs to."""
    out = np.zeros((_KINDS, 256), dtype=np.int32)
    out[0, ord("A") : ord("Z") + 1] = 1
    out[1, ord("a") : ord("z") + 1] = 1
    out[2, ord("0") : ord("9") + 1] = 1
    out[3, 128:] = 1
    for b in range(33, 127):
        if not chr(b).isalnum():
            out[4, b] = 1
    for k, b in enumerate(_SINGLE):
        out[5 + k, b] = 1
    return out


_KIND = _kind_table()


def passages(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features, first): one row per passage of a block of texts; the passages of text r are rows
    first[r] to first[r + 1]. Every text has at least one."""
    starts, ends, hashes, word_at = words(raw, bounds)
    n_words = np.diff(word_at)
    n_pass = np.maximum(1, -(-n_words // PASSAGE_WORDS))
    first = np.r_[0, np.cumsum(n_pass)]
    doc = np.repeat(np.arange(len(n_words)), n_pass)
    nth = np.arange(first[-1]) - first[doc]
    a = word_at[doc] + nth * PASSAGE_WORDS
    b = np.minimum(a + PASSAGE_WORDS, word_at[doc + 1])
    full = b > a
    out = np.zeros((first[-1], FEATURES), dtype=np.float32)
    if not full.any():
        return out, first
    low, high = starts[a[full]], ends[b[full] - 1]
    size = (high - low).astype(np.float32)
    for k in range(_KINDS):
        total = np.r_[0, np.cumsum(_KIND[k][raw], dtype=np.int64)]
        out[full, k] = (total[high] - total[low]) / size
    at = _KINDS
    length = (ends - starts).astype(np.float64)
    count = (b - a)[full].astype(np.float32)

    def mean(values: np.ndarray) -> np.ndarray:
        total = np.r_[0.0, np.cumsum(values)]
        return ((total[b[full]] - total[a[full]]) / count).astype(np.float32)

    average = mean(length)
    out[full, at] = average / 10
    out[full, at + 1] = np.sqrt(np.maximum(0, mean(length**2) - average**2)) / 10
    out[full, at + 2] = mean(length <= 2)
    same = np.zeros(len(hashes))
    same[1:] = hashes[1:] == hashes[:-1]
    out[full, at + 3] = mean(same)
    # Words whose last byte is one of a few separators, and words that occurred before in the passage.
    last = raw[ends - 1]
    out[full, at + 4] = mean(np.isin(last, _SINGLE))
    owner = np.repeat(np.arange(len(a)), b - a)
    order = np.lexsort((np.arange(len(hashes)), hashes, owner))
    again = np.zeros(len(hashes))
    again[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (owner[order[1:]] == owner[order[:-1]])
    out[full, at + 5] = mean(again)
    # The same against the whole document, and the length of the document in passages.
    in_doc = np.repeat(np.arange(len(n_words)), n_words)
    order = np.lexsort((np.arange(len(hashes)), hashes, in_doc))
    again = np.zeros(len(hashes))
    again[order[1:]] = (hashes[order[1:]] == hashes[order[:-1]]) & (in_doc[order[1:]] == in_doc[order[:-1]])
    out[full, at + 6] = mean(again)
    out[full, at + 7] = np.log1p(count) / 4
    return out, first


class Model:
    """Encoder, gated attention and logistic output; plain arrays, so it travels with a task."""

    def __init__(self, seed: int = 7) -> None:
        g = np.random.default_rng(seed)
        self.mean, self.scale = np.zeros(FEATURES, np.float32), np.ones(FEATURES, np.float32)
        self.w = {
            "E": g.normal(0, 0.3, (FEATURES, HIDDEN)), "e": np.zeros(HIDDEN),
            "V": g.normal(0, 0.3, (HIDDEN, ATTENTION)), "U": g.normal(0, 0.3, (HIDDEN, ATTENTION)),
            "a": g.normal(0, 0.3, ATTENTION), "o": g.normal(0, 0.3, HIDDEN), "c": np.zeros(1),
        }
        self.fitted = False

    def _forward(self, x: np.ndarray, first: np.ndarray) -> dict:
        w, lens = self.w, np.diff(first)
        h = np.tanh(x @ w["E"] + w["e"])
        t, s = np.tanh(h @ w["V"]), 1 / (1 + np.exp(-np.clip(h @ w["U"], -30, 30)))
        z = (t * s) @ w["a"]
        z = np.exp(z - np.repeat(np.maximum.reduceat(z, first[:-1]), lens))
        alpha = z / np.repeat(np.add.reduceat(z, first[:-1]), lens)
        bag = np.add.reduceat(alpha[:, None] * h, first[:-1], axis=0)
        score = 1 / (1 + np.exp(-np.clip(bag @ w["o"] + w["c"][0], -30, 30)))
        return {"h": h, "t": t, "s": s, "alpha": alpha, "bag": bag, "score": score}

    def score(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        if not self.fitted:
            return np.full(len(first) - 1, 0.5)
        return self._forward((x - self.mean) / self.scale, first)["score"]

    def attention(self, x: np.ndarray, first: np.ndarray) -> np.ndarray:
        """The weight of each passage inside its document."""
        return self._forward((x - self.mean) / self.scale, first)["alpha"]

    def fit(self, bags: list[np.ndarray], labels: np.ndarray, seed: int = 7) -> Model:
        if not len(bags):
            return self
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(0), every.std(0) + 1e-3
        bags = [(b - self.mean) / self.scale for b in bags]
        self.w["c"][0] = np.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1))
        g = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.w.items()}
        v2 = {k: np.zeros_like(v) for k, v in self.w.items()}
        step = 0
        for _ in range(EPOCHS):
            order = g.permutation(len(bags))
            for at in range(0, len(order), BATCH):
                pick = order[at : at + BATCH]
                x = np.concatenate([bags[i] for i in pick])
                first = np.r_[0, np.cumsum([len(bags[i]) for i in pick])]
                grad = self._gradient(x, first, labels[pick])
                step += 1
                for k, d in grad.items():
                    d = d + DECAY * self.w[k] * (k in "EVUao")
                    m[k] = 0.9 * m[k] + 0.1 * d
                    v2[k] = 0.999 * v2[k] + 0.001 * d * d
                    self.w[k] = self.w[k] - RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(v2[k] / (1 - 0.999**step)) + 1e-8)
        self.fitted = True
        return self

    def _gradient(self, x: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict:
        f, w, lens = self._forward(x, first), self.w, np.diff(first)
        d_out = (f["score"] - y) / len(y)
        d_bag = np.repeat(d_out[:, None] * w["o"], lens, axis=0)
        d_h = f["alpha"][:, None] * d_bag
        d_alpha = (d_bag * f["h"]).sum(1)
        d_z = f["alpha"] * (d_alpha - np.repeat(np.add.reduceat(f["alpha"] * d_alpha, first[:-1]), lens))
        gate = f["t"] * f["s"]
        d_t = d_z[:, None] * w["a"] * f["s"] * (1 - f["t"] ** 2)
        d_s = d_z[:, None] * w["a"] * f["t"] * f["s"] * (1 - f["s"])
        d_h = (d_h + d_t @ w["V"].T + d_s @ w["U"].T) * (1 - f["h"] ** 2)
        return {
            "E": x.T @ d_h, "e": d_h.sum(0), "V": f["h"].T @ d_t, "U": f["h"].T @ d_s, "a": gate.T @ d_z,
            "o": f["bag"].T @ d_out, "c": np.array([d_out.sum()]),
        }


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = FOLDS, max_docs: int = MAX_DOCS) -> Model:
    """A model from at most ``max_docs`` labelled documents outside the held-out fold."""
    marked = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold(F.col("doc_id"), folds) != 0))
        .groupBy("doc_id").agg((F.avg(F.col(label).cast("double")) >= 0.5).cast("int").alias("y"))
    )
    present = marked.join(docs.select("doc_id").distinct(), "doc_id", "left_semi")
    sample = present.orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_docs)
    picked = F.broadcast(sample)  # at most max_docs rows of two numbers
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(picked, "doc_id")

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ys, feats = batch.column("doc_id").to_pylist(), batch.column("y").to_pylist(), []
            for _, raw, bounds in text_blocks(batch.column("text")):
                x, first = passages(raw, bounds)
                feats += [x[first[r] : first[r + 1]].tobytes() for r in range(len(bounds) - 1)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ys, pa.int32()), pa.array(feats, pa.binary())], names=["doc_id", "y", "x"])

    found = rows.withColumn("doc_id", F.col("doc_id").cast("bigint")).mapInArrow(describe, "doc_id bigint, y int, x binary")
    got = sorted({(r.doc_id, r.y, bytes(r.x)) for r in found.collect()})  # the bounded sample
    bags = [np.frombuffer(x, np.float32).reshape(-1, FEATURES) for _, _, x in got]
    return Model().fit(bags, np.array([y for _, y, _ in got], dtype=np.float64))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` rows as (doc_id, score, n_passages)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, count = [], []
            for _, raw, bounds in text_blocks(batch.column(1)):
                x, first = passages(raw, bounds)
                out.append(model.score(x, first))
                count.append(np.diff(first))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(np.concatenate(out)), pa.array(np.concatenate(count).astype(np.int64))],
                    names=["doc_id", "score", "n_passages"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id bigint, score double, n_passages bigint")


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted, n_passages) of every row of ``docs``."""
    return score(docs, fit(docs, labels)).select(
        "doc_id", (fold(F.col("doc_id"), FOLDS) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "n_passages")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that the classifier does not reject.

    The texts are scored in place (the score depends on the text alone), so no join is needed.
    """
    model = fit(docs, labels)
    names = docs.columns
    where = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = [model.score(*passages(raw, bounds)) >= THRESHOLD for _, raw, bounds in text_blocks(batch.column(where).cast(pa.string()))]
            if good:
                yield batch.filter(pa.array(np.concatenate(good)))

    return docs.mapInArrow(run, docs.schema)


def op3_quality_attention_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op3_quality_attention_mil": op3_quality_attention_mil}
ORACLES: dict[str, str] = {}
