import numpy as np
from pyspark.sql import functions as F

from conftest_helpers import fold
from sparkcurate.llm import quality_mil as Q

SF = "/root/testdata/sf0.01"


def auc(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(score))
    rank[order] = np.arange(1, len(score) + 1)
    good = label == 1
    return (rank[good].sum() - good.sum() * (good.sum() + 1) / 2) / (good.sum() * (~good).sum())


def test_held_out_quality(spark):
    got = {r.doc_id: r for r in Q.op3_quality_attention_mil(spark, "/root/testdata/sf0.1").collect()}
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()
    held = [(got[r.doc_id], r.quality) for r in labels if fold(r.doc_id, 5) == 0 and r.doc_id in got]
    score, label = np.array([g.score for g, _ in held]), np.array([y for _, y in held])
    assert auc(score, label) > 0.95
    assert np.mean([g.predicted == y for g, y in held]) > 0.93
    assert np.mean([g.predicted for g, y in held if y == 1]) > 0.97
    assert all(g.held_out == (fold(g.doc_id, 5) == 0) for g in got.values())


def test_every_row_is_scored(spark, docs, rows, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    odd = docs.withColumn("y", F.lit("x")).withColumn("x", F.lit(1)).withColumn("score", F.lit(2))
    got = Q.classified(odd, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    same = {r.score for r in got if r.doc_id in (0, 1, 2)}
    assert len(same) == 1  # null, empty and white space
    kept = Q.keep_good(docs, labels)
    assert kept.columns == docs.columns
    good = sorted(r.doc_id for r in got if r.predicted)
    assert sorted(r.doc_id for r in kept.collect()) == good


def test_without_labels(spark, docs, none, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    assert {r.score for r in Q.classified(docs, labels.limit(0)).collect()} == {0.5}
    assert {r.score for r in Q.classified(docs, labels.withColumn("quality", F.lit(None).cast("int"))).collect()} == {0.5}
    assert Q.classified(none, labels).collect() == []


def test_held_out_labels_are_not_used(spark, docs, folder):
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    flipped = labels.withColumn("quality", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a = [r.score for r in Q.classified(docs, labels).orderBy("doc_id", "score").collect()]
    assert a == [r.score for r in Q.classified(docs, flipped).orderBy("doc_id", "score").collect()]


def test_gradient():
    g = np.random.default_rng(1)
    m = Q.Model()
    x, first, y = g.normal(size=(9, Q.FEATURES)), np.array([0, 4, 5, 9]), np.array([1.0, 0.0, 1.0])

    def loss():
        s = m._forward(x, first)["score"]
        return -np.mean(y * np.log(s) + (1 - y) * np.log(1 - s))

    grad = m._gradient(x, first, y)
    for k, w in m.w.items():
        at = tuple(0 for _ in w.shape)
        keep = w[at]
        w[at] = keep + 1e-5
        up = loss()
        w[at] = keep - 1e-5
        down = loss()
        w[at] = keep
        assert abs((up - down) / 2e-5 - grad[k][at]) < 1e-6
