import random
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest_helpers import WORD, fold, prose
from zlib import crc32

from sparkcurate.llm import periodic_runs as P


def plain_runs(w):
    """All (start, length, smallest period) by trying every period."""
    n, out = len(w), {}
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            length = j - i + q
            if j > i and length >= max(24, 3 * q) and (i, length) not in out:
                out[i, length] = q
            i = max(j, i + 1)
    return sorted(((s, m, q) for (s, m), q in out.items()), key=lambda r: (r[0], r[2]))


def plain_edit(w, doc_id):
    h = crc32(b"" if doc_id is None else str(doc_id).encode())
    if h % 10 or not w:
        return w
    n, g = len(w), h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def plain_row(doc_id, text):
    w = plain_edit(WORD.findall(text or ""), doc_id)
    found = plain_runs(w)
    top = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    drop = {i for s, m, q in found for i in range(s + q, s + m)}
    return (len(found), *top, top[0] is not None and 1000 * top[1] // top[2] or None,
            sha256("".join(f"{s},{m},{q}\n" for s, m, q in found).encode()).hexdigest(),
            sha256(" ".join(x for i, x in enumerate(w) if i not in drop).encode()).hexdigest())


def texts(rng):
    for _ in range(150):
        out = []
        for _ in range(rng.randrange(1, 5)):
            root = [rng.randrange(rng.choice([1, 2, 3, 40])) for _ in range(rng.randrange(1, 14))]
            times = rng.choice([1, 2, 3, 4, 9])
            run = (root * times)[: len(root) * times - rng.randrange(len(root))]
            if rng.random() < 0.3 and run:
                run[rng.randrange(len(run))] = 99
            out += run + [rng.randrange(50) for _ in range(rng.randrange(0, 9))]
        yield out


def test_runs_equal_all_periods():
    rng, some = random.Random(4), 0
    for w in texts(rng):
        assert P.runs(w) == P.stretch_runs(w) == plain_runs(w)
        some += bool(P.runs(w))
    assert some > 30


def fibonacci(n):
    a, b = "a", "ab"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


@pytest.mark.parametrize("w", [["a"] * 200, ["a", "b"] * 40 + ["a"], fibonacci(400), [], ["x"] * 23, ["x"] * 24, list("abcabc" * 8 + "abd" * 8)])
def test_structured(w):
    assert P.runs(w) == plain_runs(w)


def test_extensions():
    rng = random.Random(8)
    for w in [*texts(rng)][:30] + [[0] * 90, [1, 0] * 50]:
        n, tree = len(w), P.SuffixTree(w)
        i = np.array([rng.randrange(n) for _ in range(60)])
        j = np.array([(x + rng.randrange(1, n + 1)) % (n + 1) for x in i])
        for a, b, got in zip(i.tolist(), j.tolist(), tree.extension(i, j).tolist(), strict=True):
            k = 0
            while max(a, b) + k < n and w[a + k] == w[b + k]:
                k += 1
            assert got == k
        assert np.argsort(tree.rank).tolist() == sorted(range(n + 1), key=lambda a: w[a:])
        assert np.argsort(tree.rank_reversed).tolist() == sorted(range(n + 1), key=lambda a: [-x for x in w[a:]])


def digest(r):
    return (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256)


def test_query(spark, folder, rows):
    got = P.op11_periodic_runs(spark, folder).collect()
    assert sorted((repr(r.doc_id), *map(repr, digest(r))) for r in got) == sorted((repr(i), *map(repr, plain_row(i, t))) for i, t, *_ in rows)
    assert any(r.n_runs for r in got) and any(fold(r.doc_id, 10) == 0 for r in got)


def test_repeats_nulls_ties_and_other_columns(spark, none):
    rng = random.Random(2)
    line = prose(rng, 12)
    cases = [(None, None), (None, "a b"), (3, ""), (4, " ".join(["no no"] * 30)), (4, " ".join(["no no"] * 30)), (5, line + "\n" + "\n".join([line] * 40)),
             (6, "x y " * 20 + "z " + "x y " * 20), (7, "A a " * 12), (8, "w " * 60_000)]
    docs = spark.createDataFrame([(*c, 1, "r") for c in cases], "doc_id bigint, text string, n_runs int, runs string")
    got = P.detect(docs, edit=True).collect()
    for r, (i, t) in zip(got, cases, strict=True):
        if i != 8:
            assert digest(r) == plain_row(i, t) and r.doc_id == i
    assert got[6].start == 0 and got[6].n_runs == 2 and got[8].period == 1 and got[8].length == 60_000
    assert got[5].collapsed == " ".join(line.split()) and P.detect(none).count() == 0
    plain = P.detect(docs.where("doc_id = 5")).select("runs").first()[0]
    assert [(x.start, x.length, x.period) for x in plain] == plain_runs(cases[5][1].split())


def test_speed_is_near_linear_in_long_texts():
    import time
    rng = random.Random(1)
    root = [rng.randrange(500) for _ in range(3000)]
    start = time.perf_counter()
    assert P.runs(root * 20) == [(0, 60_000, 3000)]
    assert time.perf_counter() - start < 30
