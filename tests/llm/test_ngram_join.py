import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_helpers import shingle_sets
from sparkcurate.llm import ngram_join


def linked(a, b, percent):
    both = len(a & b)
    return bool(a) and bool(b) and 100 * both >= percent * (len(a) + len(b) - both)


def brute(rows, k, percent):
    sets = defaultdict(list)
    for i, t, *_ in rows:
        sets[i].append(shingle_sets(t, k))
    up = {i: i for i in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x in sets:
        for y in sets:
            if x < y and any(linked(a, b, percent) for a in sets[x] for b in sets[y]):
                a, b = root(x), root(y)
                up[max(a, b)] = min(a, b)
    return {i: root(i) for i in sets}, sets


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_components(docs, rows, k, percent):
    want, sets = brute(rows, k, percent)
    got = ngram_join.jaccard_components(docs, k, percent).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows)
    for r in got:
        assert r.component_id == want[r.doc_id]
        assert r.n_shingles in {len(s) for s in sets[r.doc_id]}


def test_empty_and_null_ids(spark, none, docs):
    assert ngram_join.jaccard_components(none).collect() == []
    odd = docs.where("doc_id = 8").withColumn("doc_id", F.lit(None).cast("bigint"))
    assert [r.component_id for r in ngram_join.jaccard_components(odd).collect()] == [None] * 3


def test_extra_columns_do_not_clash(docs, rows):
    odd = docs.withColumn("class_id", F.lit("x")).withColumn("a", F.lit(1)).withColumn("label", F.lit(2)).withColumn("grp", F.lit(3))
    want, _ = brute(rows, 4, 85)
    assert {r.doc_id: r.component_id for r in ngram_join.jaccard_components(odd, 4, 85).collect()} == want


def test_keep_one(docs, rows):
    want, _ = brute(rows, 5, 80)
    kept = ngram_join.keep_one(docs).collect()
    assert sorted(r.doc_id for r in kept) == sorted(set(want.values()))
    assert kept[0].asDict().keys() == set(docs.columns)


def families(rng, n):
    """Sets in families of near copies of all sizes, and sets that share a long passage."""
    out = []
    for f in range(n):
        size = rng.choice([1, 2, 3, 5, 8, 13, 30, 90])
        base = [rng.getrandbits(64) for _ in range(size)]
        for _ in range(rng.randrange(1, 6)):
            own = base[:]
            for _ in range(rng.randrange(0, max(1, size // 8) + 1)):
                own[rng.randrange(size)] = rng.getrandbits(64)
            own += [rng.getrandbits(64) for _ in range(rng.randrange(0, max(1, size // 10) + 1))]
            out.append(np.unique(np.array(own, dtype=np.uint64)))
    return out


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_linked_sets_share_a_signature(percent):
    sets = families(random.Random(percent), 60)
    sigs = [set(ngram_join.signatures(s, percent).tolist()) for s in sets]
    plain = [set(s.tolist()) for s in sets]
    for x in range(len(sets)):
        for y in range(x):
            if linked(plain[x], plain[y], percent):
                assert sigs[x] & sigs[y]


@pytest.mark.parametrize("percent", [80, 85])
def test_t_occurrence(percent):
    sets = families(random.Random(3), 50)
    plain = [set(s.tolist()) for s in sets]
    up = list(range(len(sets)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for x in range(len(sets)):
        for y in range(x):
            if linked(plain[x], plain[y], percent):
                a, b = root(x), root(y)
                up[max(a, b)] = min(a, b)
    got = ngram_join.t_occurrence(sets, percent)
    assert [int(v) for v in got] == [root(x) for x in range(len(sets))]


def test_groups_in_blocks(spark, monkeypatch):
    """A group larger than one search gives the same components."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        own = base[:]
        for _ in range(rng.randrange(0, 4)):
            own[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    want, _ = brute(rows, 4, 85)
    monkeypatch.setattr(ngram_join, "GROUP_SHINGLES", 800)
    got = ngram_join.jaccard_components(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, 85).collect()
    assert {r.doc_id: r.component_id for r in got} == want


def counted(rows, k, percent):
    """Per row, the number of other rows with a linked set."""
    sets = [(i, shingle_sets(t, k)) for i, t, *_ in rows]
    return Counter((i, sum(linked(s, other, percent) for at, (_, other) in enumerate(sets) if at != me)) for me, (i, s) in enumerate(sets))


@pytest.mark.parametrize("percent", [80, 85])
@pytest.mark.parametrize("mu", [0.0, 1.0, 50.0])
def test_link_counts(percent, mu, monkeypatch):
    """From most lists probed to all merged."""
    monkeypatch.setattr(ngram_join, "MU", mu)
    rng = random.Random(4)
    sets = list({s.tobytes(): s for s in families(rng, 50)}.values())
    base = [rng.getrandbits(64) for _ in range(40)]
    sets += [np.unique(np.array([*base[:j], rng.getrandbits(64), *base[j + 1 :]], dtype=np.uint64)) for j in range(40)]
    plain = [set(s.tolist()) for s in sets]
    weights = np.array([rng.randrange(1, 5) for _ in sets])
    left = np.array([rng.random() < 0.5 for _ in sets])
    for mask in (None, left):
        want = [sum(int(weights[y]) for y in range(len(sets)) if y != x and (mask is None or left[x] != left[y]) and linked(plain[x], plain[y], percent)) for x in range(len(sets))]
        roots, got = ngram_join.link_counts(sets, weights, percent, mask)
        assert got.tolist() == want and max(want) > 30
        if mask is None:
            assert len(set(roots.tolist())) == len(set(ngram_join.t_occurrence(sets, percent).tolist()))


@pytest.mark.parametrize(("k", "percent"), [(4, 85), (5, 80)])
def test_links(docs, rows, k, percent):
    want, _ = brute(rows, k, percent)
    got = ngram_join.jaccard_links(docs, k, percent).collect()
    assert Counter((r.doc_id, r.n_links) for r in got) == counted(rows, k, percent)
    assert all(r.component_id == want[r.doc_id] for r in got)


def test_links_in_blocks(spark, monkeypatch, none):
    """All links of a mass of near copies of several sizes, cut into blocks, are counted."""
    rng = random.Random(9)
    base = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(120):
        own = base[: rng.randrange(50, 61)]
        for _ in range(rng.randrange(0, 3)):
            own[rng.randrange(len(own))] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(own)))
    want = counted(rows, 4, 85)
    monkeypatch.setattr(ngram_join, "GROUP_SHINGLES", 800)
    got = ngram_join.jaccard_links(spark.createDataFrame(rows, "doc_id bigint, text string"), 4, 85).collect()
    assert Counter((r.doc_id, r.n_links) for r in got) == want
    assert {r.doc_id: r.component_id for r in got} == brute(rows, 4, 85)[0]
    assert ngram_join.jaccard_links(none).collect() == []


@pytest.mark.parametrize("lists", [2000, 6])
def test_one_id_with_different_texts(spark, lists, monkeypatch):
    """Texts of one id that equal those of other ids keep all their links, in short and in long posting lists."""
    monkeypatch.setattr(ngram_join, "LIST_SETS", lists)
    monkeypatch.setattr(ngram_join, "HOT_LIST", lists // 2)
    a, b = [f"a{i}" for i in range(60)], [f"b{i}" for i in range(60)]
    near = [*a[:30], "x", *a[31:]]
    rows = [(5, " ".join(a)), (5, " ".join(b)), (3, " ".join(b)), (7, " ".join(near)), (9, "c d"), (9, None), (2, " ".join(b[:58]))]
    rows += [(20 + i, " ".join([*a[: i + 8], "y", *a[i + 9 :]])) for i in range(25)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    want, _ = brute(rows, 5, 80)
    assert want[7] == want[5] == want[3] == 2
    got = ngram_join.jaccard_links(docs, 5, 80).collect()
    assert all(r.component_id == want[r.doc_id] for r in got)
    assert Counter((r.doc_id, r.n_links) for r in got) == counted(rows, 5, 80)
    assert {r.doc_id: r.component_id for r in ngram_join.jaccard_components(docs, 5, 80).collect()} == want


@pytest.mark.parametrize("percent", [80, 85])
def test_bitmaps_lose_no_link_and_stop_shared_passages(percent):
    import pandas as pd
    rng = random.Random(percent)
    sets = list({s.tobytes(): s for s in families(rng, 60)}.values())
    passage = [rng.getrandbits(64) for _ in range(60)]
    shared = [np.unique(np.array(passage + [rng.getrandbits(64) for _ in range(240)], dtype=np.uint64)) for _ in range(40)]
    rows = [(0, i, len(s), ngram_join._bitmap(s)) for i, s in enumerate([*sets, *shared])]
    found = ngram_join._bit_search(pd.DataFrame(rows, columns=["grp", "class", "n", "bits"]), percent)
    label = dict(zip(found.a, found.b, strict=True))
    plain = [set(s.tolist()) for s in sets]
    for x in range(len(sets)):
        for y in range(x):
            if linked(plain[x], plain[y], percent):
                assert label.get(x, x) == label.get(y, y)
    assert not any(i in label for i in range(len(sets), len(rows)))
