from collections import Counter


import corpus_pipeline as P
from conftest_helpers import DOCS
from sparkcurate.llm import decontaminate, quality_mil
from test_decontaminate import distance
from test_mixing import size_of, targets
from test_ngram_join import brute


def stages(spark, docs, folder, tmp):
    out = [docs]
    for k, (_, f) in enumerate(P.STAGES):
        f(spark, out[-1], folder).write.parquet(f"{tmp}/{k}")
        out.append(spark.read.parquet(f"{tmp}/{k}"))
    return out


def test_stages(spark, folder, rows, tmp_path):
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "benchmark_leaks", "mix", "shards"]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    t = stages(spark, docs, folder, tmp_path)
    found = [[tuple(r) for r in x.collect()] for x in t]
    assert all(x.columns == docs.columns for x in t[1:5])
    good = {r.doc_id for r in quality_mil.classified(docs, spark.read.parquet(f"{folder}/labels.parquet")).where("predicted = 1").collect()}
    assert Counter(found[1]) == Counter(r for r in found[0] if r[0] in good)
    want, _ = brute(found[1], 5, 80)
    assert sorted(r[0] for r in found[2]) == sorted(set(want.values()))
    items = [decontaminate.normalize(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    leak = lambda text: any(i and text and distance(i, decontaminate.normalize(text)) <= decontaminate.edit_budget(len(i)) for i in items)
    assert Counter(found[3]) == Counter(r for r in found[2] if not leak(r[1]))
    assert set(found[4]) <= set(found[3])
    sizes = Counter()
    for r in found[3]:
        sizes[r[3]] += size_of(r[1])
    goal = targets(sizes)
    used = Counter()
    for r in found[4]:
        used[r[3]] += size_of(r[1])
    longest = max(size_of(r[1]) for r in found[3])
    assert all(goal[s] <= used[s] + 1 and used[s] <= goal[s] + longest for s in goal)
    assert Counter(r[0] for r in found[5]) == Counter(r[0] for r in found[4])
    run = Counter(tuple(r) for r in P.run(spark, folder).collect())
    assert run == Counter(found[5])


def test_empty(spark, folder, tmp_path):
    none = spark.createDataFrame([], DOCS)
    assert [x.count() for x in stages(spark, none, folder, tmp_path)] == [0] * 6
