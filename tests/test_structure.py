"""Structure features against plain Python and permutations."""

import itertools
import random
from hashlib import md5

import pytest
from pyspark.sql import functions as F

from sparkcurate.functions import structure as S


def feature(text):
    return int(md5(text.encode()).hexdigest()[:8], 16)


def near(n, bonds):
    out = [[] for _ in range(n)]
    for a, b, o in bonds:
        out[a - 1].append((b - 1, o))
        out[b - 1].append((a - 1, o))
    return out


def plain_codes(symbols, bonds, radius):
    to = near(len(symbols), bonds)
    codes = [[feature(f"{s}|{len(to[i])}")] for i, s in enumerate(symbols)]
    for r in range(radius):
        now = [c[r] for c in codes]
        for i, c in enumerate(codes):
            c.append(feature(f"{now[i]}({','.join(sorted(f'{o}:{now[j]}' for j, o in to[i]))})"))
    return codes


def connected(n, bonds, a, b):
    to, seen, stack = near(n, bonds), set(), [a]
    while stack:
        i = stack.pop()
        if i not in seen:
            seen.add(i)
            stack += [j for j, _ in to[i]]
    return b in seen


def plain_core(n, bonds):
    while True:
        deg = [len(x) for x in near(n, bonds)]
        kept = [e for e in bonds if deg[e[0] - 1] > 1 and deg[e[1] - 1] > 1]
        if len(kept) == len(bonds):
            return kept
        bonds = kept


def records(rng, count, most):
    out = []
    for _ in range(count):
        n = rng.randrange(1, most)
        bonds = {(rng.randrange(1, i), i) for i in range(2, n + 1) if rng.random() < 0.9}
        bonds |= {tuple(sorted(rng.sample(range(1, n + 1), 2))) for _ in range(rng.randrange(0, 4)) if n > 1}
        out.append(([rng.choice("CCCNOH") for _ in range(n)], [(a, b, rng.choice([1, 1, 2])) for a, b in sorted(bonds)]))
    ring = lambda n, o=1: [(i, i + 1, o) for i in range(1, n)] + [(1, n, o)]
    out += [(["C"] * 6, ring(6)), (["C"] * 8, [*ring(4), *((a + 4, b + 4, o) for a, b, o in ring(4))]), (["C"] * 7, [*ring(3), (3, 4, 1), (4, 5, 1), (5, 6, 1), (6, 7, 1), (5, 7, 1)]), ([], []), (["H"], [])]
    # Two rings of three against one of six: refinement sees no difference.
    out += [(["C"] * 6, [*ring(3), *((a + 3, b + 3, o) for a, b, o in ring(3))])]
    return out


SCHEMA = "id int, symbols array<string>, bonds array<struct<a:int,b:int,order:int>>, n string"


@pytest.fixture(scope="module")
def cases():
    return records(random.Random(7), 60, 14)


@pytest.fixture(scope="module")
def table(spark, cases):
    return spark.createDataFrame([(i, s, b, "x") for i, (s, b) in enumerate(cases)] + [(-1, None, None, None)], SCHEMA)


def test_environments_and_bits(table, cases):
    for radius in (0, 2, 3):
        df = table.withColumn("e", S.environments(F.col("symbols"), F.col("bonds"), radius)).withColumn("f", S.fingerprint(F.col("e")))
        for r in df.collect():
            if r.id < 0:
                assert r.e is None and r.f is None
                continue
            want = plain_codes(*cases[r.id], radius)
            assert r.e == want and r.f == sorted({c % 2048 for x in want for c in x})


def test_refinement(table, cases):
    for r in table.select("id", S.refined_classes(F.col("symbols"), F.col("bonds")).alias("c")).where("id >= 0").collect():
        symbols, bonds = cases[r.id]
        last = [c[-1] for c in plain_codes(symbols, bonds, len(symbols))]
        assert r.c == [last.index(c) + 1 for c in last]


def test_scaffold(table, cases):
    df = table.withColumn("core", S.core_bonds(F.size("symbols"), F.col("bonds"))).withColumn("ring", S.ring_bonds(F.size("symbols"), F.col("core")))
    for r in df.withColumn("atoms", S.atoms_of(F.col("core"))).where("id >= 0").collect():
        symbols, bonds = cases[r.id]
        core = plain_core(len(symbols), bonds)
        assert [tuple(e) for e in r.core] == core and r.atoms == sorted({i for a, b, _ in core for i in (a, b)})
        assert [tuple(e) for e in r.ring] == [e for e in core if connected(len(symbols), [x for x in core if x != e], e[0] - 1, e[1] - 1)]


def renumbered(symbols, bonds, order):
    """The record with atom ``order[k]`` as atom k + 1."""
    place = {a: k + 1 for k, a in enumerate(order)}
    return [symbols[a - 1] for a in order], sorted((min(place[a], place[b]), max(place[a], place[b]), o) for a, b, o in bonds)


def test_identity_keys_against_permutations():
    """Equal keys exactly for records of which one is a renumbering of the other."""
    rng = random.Random(3)
    small = [r for r in records(rng, 60, 6) if len(r[0]) < 6]
    plain = [min((renumbered(s, b, p) for p in itertools.permutations(range(1, len(s) + 1))), default=([], [])) for s, b in small]
    keys = [S.canonical(s, b)[1] for s, b in small]
    for (x, k), (y, m) in itertools.combinations(zip(plain, keys, strict=True), 2):
        assert (x == y) == (k == m)


def test_canonical_order_ignores_numbering(spark, cases):
    rng = random.Random(9)
    for s, b in cases:
        order, key = S.canonical(s, b)
        assert sorted(order) == list(range(1, len(s) + 1))
        p = list(range(1, len(s) + 1))
        rng.shuffle(p)
        again, other = S.canonical(*renumbered(s, b, p))
        assert other == key and renumbered(*renumbered(s, b, p), again) == renumbered(s, b, order)
    star = (["C"] * 5 + ["H"] * 12, [(1, i, 1) for i in range(2, 6)] + [(2 + i // 3, 6 + i, 1) for i in range(12)])
    assert S.canonical(*star)[1] == S.canonical(*renumbered(*star, list(range(17, 0, -1))))[1]
    water = (["O", "H", "H"] * 9, [(3 * i + 1, 3 * i + k, 1) for i in range(9) for k in (2, 3)])
    assert S.canonical(*water)[1].count("O") == 9
    df = spark.createDataFrame([(1, *star, ""), (2, None, None, "")], SCHEMA).withColumn("f", S.canonical_form(F.col("symbols"), F.col("bonds")))
    syms, bonds = S.reordered(F.col("symbols"), F.col("bonds"), F.col("f.order"))
    a, b = df.select(syms.alias("s"), bonds.alias("b"), "f.key").collect()
    assert ([*a.s], [tuple(x) for x in a.b]) == renumbered(*star, S.canonical(*star)[0]) and b.key is None


def test_bonds_from_coordinates(spark):
    methane = (["C", "H", "H", "H", "H"], [[0.0, 0.0, 0.0], [0.63, 0.63, 0.63], [-0.63, -0.63, 0.63], [-0.63, 0.63, -0.63], [0.63, -0.63, -0.63]])
    water = (["O", "H", "H"], [[0.0, 0.0, 0.0], [0.96, 0.0, 0.0], [-0.24, 0.93, 0.0]])
    rows = [(1, *methane, [(1, i, 1) for i in range(2, 6)]), (2, *water, [(2, 1, 1), (2, 3, 1)]), (3, ["Xx"], [[0.0] * 3], []), (4, ["H"], None, []), (5, [], [], []), (6, ["H", "H"], [[0.0] * 3], [])]
    df = spark.createDataFrame(rows, "id int, s array<string>, p array<array<double>>, l array<struct<a:int,b:int,order:int>>").withColumn("b", S.perceived_bonds(F.col("s"), F.col("p")))
    got = {r.id: r for r in df.withColumn("t", S.topology_differences(F.col("l"), F.col("b"))).collect()}
    assert [tuple(x) for x in got[1].b] == [(1, i, 1) for i in range(2, 6)] and tuple(got[1].t) == (0, 0)
    assert [tuple(x)[:2] for x in got[2].b] == [(1, 2), (1, 3)] and tuple(got[2].t) == (1, 1)
    assert got[3].b is None and got[3].t is None and got[4].b is None and got[5].b == [] and tuple(got[5].t) == (0, 0) and got[6].b is None


def test_topology_warning_in_the_gate(spark):
    from sparkcurate.functions import molblock
    from sparkcurate.plans import graph
    xyz = [[0.0, 0.0, 0.0], [0.96, 0.0, 0.0], [-0.24, 0.93, 0.0]]
    rows = [(1, ["O", "H", "H"], xyz, [(1, 2, 1), (1, 3, 1)]), (2, ["O", "H", "H"], [[3 * v for v in p] for p in xyz], [(1, 2, 1), (1, 3, 1)])]
    df = spark.createDataFrame(rows, "row_index int, s array<string>, p array<array<double>>, e array<struct<a:int,b:int,order:int>>")
    block = df.withColumn("mol_block", molblock.build_block(F.lit("t"), F.col("s"), F.col("p"), F.col("e"))).select("row_index", "mol_block")
    for on, want in ((False, ["ok", "ok"]), (True, ["ok", "topology_warning"])):
        out = graph.chemistry_gate(block, graph.Options(preset="neutral", topology=on, max_fragments=None)).orderBy("row_index").collect()
        assert [r.filter_status for r in out] == want
    assert out[1].filter_reason == "2 listed bonds not seen, 0 seen not listed"
