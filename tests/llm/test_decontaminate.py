import random
import re

import numpy as np
from pyspark.sql import functions as F

from conftest_helpers import prose
from sparkcurate.llm import decontaminate as D


def distance(item, text):
    """Least edit distance of the item to any region of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def damaged(rng, text, edits):
    chars = list(text)
    for _ in range(edits):
        at, kind = rng.randrange(len(chars)), rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("qxz ")
        elif kind == 1:
            chars.insert(at, rng.choice("qxz"))
        elif len(chars) > 1:
            del chars[at]
    return "".join(chars)


def test_against_brute_force(spark):
    rng = random.Random(4)
    items = [(i, prose(rng, rng.choice([2, 4, 8, 14]))) for i in range(12)] + [(90, "tiny"), (91, None), (92, " ")]
    texts = []
    for i, t in items[:12]:
        norm = D.normalize(t)
        k = D.edit_budget(len(norm))
        for edits in (0, k // 2, k, k + 1, 2 * k + 2):
            texts.append(f"{prose(rng, 12)} {damaged(rng, norm, edits)} {prose(rng, 12)}")
        texts.append(damaged(rng, norm, k))
    texts += [prose(rng, 40) for _ in range(10)] + [None, "", "a tiny thing", items[2][1].upper().replace(" ", "\n\t")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    bench = spark.createDataFrame(items + items[:2], "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): r for r in D.leaks(docs, bench).orderBy(F.desc("distance")).collect()}
    want = {}
    for d, t in enumerate(texts):
        for i, x in items:
            a, b = D.normalize(x), D.normalize(t)
            if a and b and (n := distance(a, b)) <= D.edit_budget(len(a)):
                want[d, i] = n
    assert {k: r.distance for k, r in got.items()} == want
    for (d, i), r in got.items():
        region = D.normalize(texts[d])[r.start : r.end]
        assert distance(region, D.normalize(dict(items)[i])) <= r.distance or abs(len(region) - len(D.normalize(dict(items)[i]))) <= r.distance
    kept = {r.doc_id for r in D.drop_leaking(docs, bench).collect()}
    assert kept == set(range(len(texts))) - {d for d, _ in want}


def test_blocks_of_items(spark, docs, monkeypatch):
    rng = random.Random(8)
    bench = spark.createDataFrame([(i, prose(rng, 10)) for i in range(6)], "item_id bigint, text string")
    text = " ".join(r.text for r in bench.collect())
    one = docs.limit(1).withColumn("text", F.lit(text))
    want = sorted(map(tuple, D.leaks(one, bench).collect()))
    assert {r[1] for r in want} == set(range(6))
    monkeypatch.setattr(D, "ITEM_CHARS", 50)
    assert sorted(map(tuple, D.leaks(one, bench).collect())) == want


def test_short_items_at_all_places(spark):
    docs = spark.createDataFrame([(1, "Tiny, a tiny TINY\ttinytiny thing"), (2, "none")], "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, "tiny"), (8, "a long passage that no document has at all")], "item_id bigint, text string")
    got = sorted((r.doc_id, r.item_id, r.start, r.end, r.distance) for r in D.leaks(docs, bench).collect())
    text = D.normalize("Tiny, a tiny TINY\ttinytiny thing")
    want = [m.start() for m in re.finditer("tiny", text)]
    assert got == [(1, 7, a, a + 4, 0) for a in want] and len(want) == 5
    assert [r.doc_id for r in D.drop_leaking(docs, bench).collect()] == [2]


def test_edges(spark, docs, none, rows):
    bench = spark.createDataFrame([(1, "a passage that no document has, not even in part")], "item_id bigint, text string")
    assert D.leaks(docs, bench).collect() == []
    assert D.leaks(none, bench).collect() == [] and D.leaks(docs, bench.limit(0)).collect() == []
    odd = docs.withColumn("item_id", F.lit(1)).withColumn("start", F.lit(1))
    kept = D.drop_leaking(odd, bench)
    assert kept.columns == odd.columns and kept.count() == len(rows)


def test_aligned_distance():
    rng = random.Random(2)
    codes = lambda s: np.frombuffer(s.encode("utf-32-le"), np.uint32)
    for _ in range(150):
        item = "".join(rng.choice("abc ") for _ in range(rng.randrange(1, 30)))
        text = "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 20))) + damaged(rng, item, rng.randrange(5)) + "".join(rng.choice("abc ") for _ in range(rng.randrange(0, 20)))
        k = 6
        got, start, end = D.banded_distance(codes(item), codes(text), -len(item) - 7, len(text) + 7, k)
        assert got == min(k + 1, distance(item, text))
        if got <= k:
            assert distance(item, text[start:end]) == got
