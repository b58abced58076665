import math
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from conftest_helpers import fold, words
from sparkcurate.llm import brown_lm as B


def base(rows):
    end = "\0end"
    tokens = [(i, [*words(t), end]) for i, t, *_ in rows]
    count = Counter(w for i, ws in tokens if fold(i, 10) for w in ws)
    n, v = sum(count.values()), len(count)
    return Counter(
        (i, fold(i, 10) == 0, len(ws), sum(count[w] > 0 for w in ws), n, round(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws), 6))
        for i, ws in tokens)


def test_base_against_brute_force(spark, folder, rows):
    got = B.op10_brown_class_lm(spark, folder).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == base(rows)
    assert all(r.score < 0 and abs(r.perplexity - 10 ** (-r.score / r.n_tokens)) < 1e-6 * r.perplexity for r in got)


def test_rare_words_take_the_long_way(spark, folder, rows, monkeypatch):
    """With few frequent words the counts that come by shuffle give the same base scores."""
    monkeypatch.setattr(B, "FREQUENT", 5)
    got = B.op10_brown_class_lm(spark, folder).collect()
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == base(rows)


def test_probabilities_add_up(spark):
    """Over all next words, seen or not, the model gives at most one, and nearly all of it."""
    rows = [(i, " ".join(["ab cd ef"] * (i % 4) + ["gh"] * (i % 3))) for i in range(1, 60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    seen = ["ab", "cd", "ef", "gh"]
    probe = spark.createDataFrame([(1000 + k, w) for k, w in enumerate(seen)], "doc_id bigint, text string")
    empty = spark.createDataFrame([(2000, "")], "doc_id bigint, text string")
    every = docs.unionAll(probe).unionAll(empty)
    got = {r.doc_id: r.score for r in B.score_corpus(every, F.col("doc_id") < 1000).collect()}
    assert 10 ** got[2000] < 1 and all(got[1000 + k] < 0 for k in range(4))
    assert sum(10 ** got[1000 + k] for k in range(4)) + 10 ** got[2000] <= 1


def test_exchange_raises_likelihood():
    rng = np.random.default_rng(3)
    true = rng.integers(0, 4, 60)
    n = np.zeros((61, 61), dtype=np.int64)
    for _ in range(20000):
        a = rng.integers(0, 60)
        b = rng.choice(np.flatnonzero(true == (true[a] + 1) % 4))
        n[a, b] += 1
    got = B.exchange_clusters(n, classes=5)

    def likelihood(c):
        one = np.eye(5)[c]
        t = one.T @ n @ one
        return B._xlogx(t).sum() - B._xlogx(t.sum(0)).sum() - B._xlogx(t.sum(1)).sum()

    start = np.r_[np.arange(60) % 4, 4]
    assert got[-1] == 4 and (got[:-1] < 4).all()
    assert likelihood(got) > likelihood(start) and likelihood(got) >= likelihood(np.r_[true, 4]) - 1e-6


def test_score_against_brute_force(spark, docs, rows, monkeypatch):
    """Every word has one class in all texts, and the score is the formula over these classes, however words travel."""
    for frequent in (B.FREQUENT, 5):
        monkeypatch.setattr(B, "FREQUENT", frequent)
        train = B.fold(F.col("doc_id"), 10) != 0
        keyed = B.keyed(docs, train).select("doc_id", "text", "key").distinct().collect()
        model, classed = B.learn(B.keyed(docs, train))
        flow = {r.key: np.frombuffer(bytes(r.flow), np.int16).tolist() for r in classed.collect()}
        end = model.classes - 1
        cls = {}
        for r in keyed:
            assert len(words(r.text)) == len(flow[r.key])
            for w, c in zip(words(r.text), flow[r.key]):
                assert cls.setdefault(w, c) == c != end
        cls["\0end"] = end
        texts = [["\0end", *words(t), "\0end"] for i, t, *_ in rows if fold(i, 10)]
        count = Counter(w for t in texts for w in t[1:])
        moves = Counter((cls[a], cls[b]) for t in texts for a, b in zip(t, t[1:]))
        leaving, arriving, types = Counter(), Counter(), Counter(cls[w] for w in count)
        for (a, b), n in moves.items():
            leaving[a] += n
            arriving[b] += n
        assert model.classes == max(4, math.ceil(sum(count.values()) ** 0.25))

        def score(text):
            t = ["\0end", *words(text), "\0end"]
            return sum(
                math.log10((moves[cls[a], cls[b]] + 0.5) / (leaving[cls[a]] + 0.5 * model.classes))
                + math.log10((count[b] + 0.1) / (arriving[cls[b]] + 0.1 * (types[cls[b]] + 1))) for a, b in zip(t, t[1:]))

        got = Counter((r.doc_id, round(r.score, 5)) for r in B.score_corpus(docs, train).collect())
        assert got == Counter((i, round(score(t), 5)) for i, t, *_ in rows)


def test_choice_of_a_class_against_brute_force():
    rng = np.random.default_rng(4)
    k, n_words = 6, 700
    pull = B.affinities(rng.integers(0, 50, (k, k)))
    owner, side = rng.integers(0, n_words, 9000), rng.integers(0, 2 * k, 9000)
    code, n = np.unique(owner * 2 * k + side, return_counts=True)
    start = rng.integers(0, k - 1, n_words)
    want = []
    for w in range(n_words):
        gain = [sum(pull[s, c] for s in side[owner == w]) for c in range(k - 1)]
        best = int(np.argmax(gain))
        want.append(best if gain[best] > gain[start[w]] + B.STAY else start[w])
    assert B.choose(code, n, start, pull).tolist() == want


def test_rare_words_get_the_class_of_their_contexts(spark, monkeypatch):
    """Words of one use, all with the same ending, are told apart by what stands around them."""
    monkeypatch.setattr(B, "FREQUENT", 8)
    rows = []
    for i in range(200):
        kind = ["go the x{}qq big", "run one x{}qq red"][i % 2]
        rows.append((i, " ".join(kind.format(i % 20) for _ in range(6))))
    docs = B.keyed(spark.createDataFrame(rows, "doc_id bigint, text string"), F.lit(True))
    _, classed = B.learn(docs)
    flow = {r.key: np.frombuffer(bytes(r.flow), np.int16) for r in classed.collect()}
    found = [{int(flow[r.key][2]) for r in docs.collect() if r.doc_id % 2 == side} for side in (0, 1)]
    assert not found[0] & found[1]


def test_better_than_single_words(spark):
    got = B.op10_brown_class_lm(spark, "/root/testdata/sf0.01").where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


def test_edges(spark, none, docs, rows):
    assert B.score_corpus(none, F.lit(True)).collect() == []
    odd = docs.withColumn("key", F.lit(1)).withColumn("train", F.lit(2)).withColumn("s", F.lit(3))
    got = B.score_corpus(odd, F.lit(False)).collect()
    assert len(got) == len(rows) and {(r.train_tokens, r.n_known) for r in got} == {(0, 0)}
    assert B.score_corpus(docs.withColumn("doc_id", F.lit(None).cast("bigint")), F.lit(True)).count() == len(rows)
