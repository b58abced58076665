import hashlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from conftest_helpers import WORD
from sparkcurate.llm import mixing as M


def targets(sizes, weights=M.WEIGHTS, share=M.SHARE, cap=M.CAP):
    """The rule itself: deal by weight, stop at the cap, deal the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, out, open_ = share * sum(sizes.values()), {}, list(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / total > cap * sizes[s]]
        if not over:
            out |= {s: left * weight[s] / total for s in open_}
            break
        for s in over:
            out[s] = cap * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


def size_of(text):
    return len(WORD.findall(text or ""))


def key(i, t):
    return hashlib.md5(f"{'' if i is None else i}:{hashlib.sha256((t or '').encode()).hexdigest()}".encode()).hexdigest()


def brute(rows):
    sizes = defaultdict(int)
    for _, t, _, s, _ in rows:
        sizes[s] += size_of(t)
    goal, out = targets(sizes), []
    for s in sizes:
        own = sorted((key(i, t), i, size_of(t)) for i, t, _, x, _ in rows if x == s)
        need = [int(goal[s]), int(goal[s]) - sizes[s]]
        for _, i, n in own:
            taken = 0
            for p in (0, 1):
                use = max(0, min(n, need[p]))
                taken += use
                need[p] -= n
            out.append((i, n, sizes[s], round(goal[s], 6), taken))
    return Counter(out), goal


def test_against_brute_force(spark, folder, rows):
    got = M.op6_mix_curriculum(spark, folder).collect()
    want, goal = brute(rows)
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got) == want
    assert sum(r.taken for r in got) >= 1.5 * sum(r.size for r in got) - len(goal)
    assert all(r.position is None or 0 <= r.position <= 1 for r in got)
    assert [tuple(r) for r in got] == [tuple(r) for r in M.op6_mix_curriculum(spark, folder).collect()]


def test_positions_follow_the_schedule(docs):
    plan = M.curriculum(docs)
    order = [r for r in M.training_order(plan).collect()]
    assert [r.position for r in order] == sorted(r.position for r in order)
    by = defaultdict(int)
    for r in order:
        by[r.source] += r.words
    goal = {r.source: r.target for r in plan.select("source", "target").distinct().collect()}
    assert all(goal[s] - 1 <= by[s] <= goal[s] for s in by)
    # At a position the demand up to it equals the words before.
    for r in plan.where("position IS NOT NULL AND target > 0").collect():
        b, t = r.slope, r.position
        assert abs(r.target * ((1 + b) * t - b * t * t) - r.before) < 1e-6 * r.target + 1e-6


def test_mixed_rows(docs, rows):
    want, _ = brute(rows)
    got = Counter(r.doc_id for r in M.mixed(docs).collect())
    taken = defaultdict(lambda: [0, 0, 0])
    for (i, n, _, _, t), c in want.items():
        taken[i][0] += c * -(-t // n) if n else c
    for i, (uses, *_) in taken.items():
        if i != 8:
            assert got[i] in (uses, uses + 1) if uses else got[i] <= 1
    assert M.mixed(docs).columns == docs.columns


def test_edges(docs, none):
    assert M.curriculum(none).collect() == [] and M.mixed(none).collect() == []
    odd = docs.withColumn("target", F.lit(1)).withColumn("weight", F.lit(2)).withColumn("_h", F.lit(3)).withColumn("before", F.lit("x"))
    assert sorted(map(str, M.curriculum(odd).collect())) == sorted(map(str, M.curriculum(docs).collect()))
    blank = M.curriculum(docs.withColumn("text", F.lit(" "))).collect()
    assert {(r.size, r.target, r.taken) for r in blank} == {(0, 0.0, 0)}
