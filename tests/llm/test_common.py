import random

import pytest

from sparkcurate.llm.common import components, fold
from conftest_helpers import fold as plain_fold


def graphs():
    rng = random.Random(1)
    path = [(i, i + 1) for i in range(60)]
    star = [(500, i) for i in range(400, 470)]
    loose = [(rng.randrange(1000, 1200), rng.randrange(1000, 1200)) for _ in range(90)]
    return {"path": path, "star": star, "random": loose, "all": path + star + loose + [(7, 7), (3, 4), (4, 3)], "loops": [(5, 5)], "none": []}


@pytest.mark.parametrize("small", [0, 10**6])
@pytest.mark.parametrize("name", list(graphs()))
def test_components(spark, name, small):
    edges = graphs()[name]
    up = {v: v for e in edges for v in e}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    linked = {v for a, b in edges if a != b for v in (a, b)}
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint"), small).collect()}
    assert got == {v: root(v) for v in linked}


def test_fold(spark):
    rows = spark.createDataFrame([(i,) for i in (0, 7, -7, 10**12, None)], "doc_id bigint")
    assert all(r.f == plain_fold(r.doc_id, 5) for r in rows.select("doc_id", fold(rows.doc_id, 5).alias("f")).collect())
