import itertools
import random
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from conftest_helpers import fold
from sparkcurate.llm import sharding as S


def test_flow_is_cheapest():
    rng = random.Random(1)
    for _ in range(60):
        n, m = rng.randrange(1, 4), rng.randrange(1, 4)
        supply = [rng.randrange(5) for _ in range(n)]
        cuts = sorted(rng.randrange(sum(supply) + 1) for _ in range(m - 1))
        demand = [b - a for a, b in zip([0, *cuts], [*cuts, sum(supply)], strict=True)]
        cost = [[rng.randrange(6) for _ in range(m)] for _ in range(n)]
        flow = S.min_cost_flow(supply, demand, cost)
        assert [sum(r) for r in flow] == supply and [sum(c) for c in zip(*flow, strict=True)] == demand
        got = sum(f * c for r, k in zip(flow, cost, strict=True) for f, c in zip(r, k, strict=True))
        units = [i for i, s in enumerate(supply) for _ in range(s)]
        places = [j for j, d in enumerate(demand) for _ in range(d)]
        if len(units) <= 6:
            assert got == min(sum(cost[i][j] for i, j in zip(units, p, strict=True)) for p in itertools.permutations(places))


def check(rows, got, n):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, crc32((t or "").encode())) for i, t, *_ in rows)
    for shard in {r.shard for r in got}:
        slots = sorted(r.slot for r in got if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(0 <= r.shard < n for r in got)


def test_reshard(spark, docs, rows, folder):
    got = S.op5_shard_min_cost_flow(spark, folder).collect()
    check(rows, got, 16)
    assert all(r.old_shard == fold(r.doc_id, S.OLD_SHARDS) and r.law == "bytes" and r.grown_shard is None for r in got)


def test_even_and_least_moves(spark):
    rng = random.Random(3)
    rows = [(i, "x" * rng.randrange(1, 200)) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = S.reshard(docs, S.key_shard(F.col("doc_id"), 4), 4, 6).collect()
    check(rows, got, 6)
    size = Counter()
    for r in got:
        size[r.shard] += r.size
    assert max(size.values()) - min(size.values()) <= 2 * 201
    old = Counter()
    for r in got:
        old[r.old_shard] += r.size
    even = sum(size.values()) / 6
    least = sum(max(0, s - even) for s in old.values())
    moved = sum(r.size for r in got if r.shard != r.old_shard)
    assert moved <= least + 201 * 10


def test_hot_shard_and_other_costs(spark, docs, rows):
    one = S.reshard(docs, F.lit(0), 1, 3, capacities=None).collect()
    check(rows, one, 3)
    cost = [[0, 1, 1]] * 2
    got = S.reshard(docs.withColumn("slot", F.lit(1)).withColumn("before", F.lit(2)), F.lit(1), 2, 3, cost=cost).collect()
    check(rows, got, 3)


def test_empty(none):
    assert S.reshard(none, F.lit(0), 1, 3).collect() == []


def test_rewrite(spark, tmp_path):
    docs = spark.createDataFrame([(i, "y" * (i % 17), f"k{i}") for i in range(400)], "doc_id bigint, text string, extra string")
    plan = S.reshard(docs, S.key_shard(F.col("doc_id"), 3), 3, 4)
    plan = spark.createDataFrame(plan.collect(), plan.schema)
    changed = S.rewrite(docs, plan, str(tmp_path / "out"))
    want = {(r.doc_id, r.shard, r.slot) for r in plan.collect() if r.shard in changed}
    got = spark.read.parquet(str(tmp_path / "out"))
    assert {(r.doc_id, r.shard, r.slot) for r in got.collect()} == want and "extra" in got.columns
    still = plan.where("shard = old_shard").count()
    assert 3 in changed and still > 0


@pytest.mark.parametrize("total", [0, 7, 100])
def test_capacities(total):
    got = S.even_capacities(total, 8)
    assert sum(got) == total and max(got) - min(got) <= 1


def test_texts_move_once_however_often_a_row_occurs(spark, tmp_path, docs, rows):
    """A document that occurs n times is written n times, with its own other columns and every slot once."""
    base = [(i, "y" * (i % 17), f"k{i}") for i in range(300)] + [(5, "y" * 5, "other"), (None, None, "k"), (None, None, None)]
    rows = [*base, *base[:40] * 3, (7, "changed", "k7")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, extra string")
    plan = S.reshard(docs, S.key_shard(F.col("doc_id"), 3), 3, 4)
    plan = spark.createDataFrame(plan.collect(), plan.schema)
    changed = S.rewrite(docs, plan, str(tmp_path / "out"))
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    at = {(r.shard, r.slot): (r.doc_id, r.size, r.text_crc32, r.old_shard) for r in plan.collect()}
    assert len({(r.shard, r.slot) for r in got}) == len(got) == sum(s in changed for s, _ in at)
    for r in got:
        raw = (r.text or "").encode()
        assert at[r.shard, r.slot] == (r.doc_id, len(raw) + 1, crc32(raw), r.old_shard)
    assert changed == [0, 1, 2, 3] and Counter((r.doc_id, r.text, r.extra) for r in got) == Counter(rows)


def test_op5_and_pipeline_write_the_shards(spark, folder, docs, rows):
    from pathlib import Path

    import corpus_pipeline

    S.ensure_checkpoint_dir(spark)
    top = Path(spark.sparkContext.getCheckpointDir().removeprefix("file:"))
    for run in (lambda: S.op5_shard_min_cost_flow(spark, folder), lambda: corpus_pipeline.shards(spark, docs, folder)):
        before = set(top.glob("shards-*"))
        got = run().collect()
        new = set(top.glob("shards-*")) - before
        assert len(new) == 1
        files = spark.read.parquet(str(new.pop()))
        moved = {s for r in got if r.shard != r.old_shard for s in (r.shard, r.old_shard)}
        assert moved and Counter((r.doc_id, r.shard, r.slot) for r in got if r.shard in moved) == Counter((r.doc_id, r.shard, r.slot) for r in files.collect())
        assert Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in files.collect()) <= Counter(rows)
        check(rows, got, 16)
