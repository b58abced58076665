"""Resharding by minimum-cost flow: the fewest bytes move from old shards to new capacities.

The sizes of the old shards (one row each) and the capacities of the new ones are a
transportation problem: a unit of flow is a byte, keeping a byte in its shard costs nothing,
moving it costs one (or what ``cost`` says). The flow is solved on the driver, where it has as many
nodes as there are shards. It tells how many bytes of old shard i go to new shard j; the documents
of an old shard lie on a line in hash order, and runs of that line become the transfers. A document
that lies across the end of a run (at most one per run) goes to the new shard that misses most.

``resharded`` carries the plan out: the new shards that gain or lose documents are written to the shared folder,
and what it returns is read from there.

Documents are cut into blocks by hash for the running sums, so a shard that holds a third of all
rows is not one task, and the slots of a new shard are numbered the same way.

Edge cases: null and empty texts have size 1 (the extra byte) and crc32 0. A null doc_id is hashed
as empty text. Repeated rows are documents of their own; rows equal in doc_id and text may
change places. An empty table gives an empty result. Other columns do not matter for the plan. ``rewrite`` keeps
them, but for old columns named shard, slot and old_shard: the new place stands there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import checkpointed, ensure_checkpoint_dir, lookup_join
from .common import fold, table, written
from .prefix import block_sums

OLD_SHARDS, NEW_SHARDS = 12, 16
BLOCK_DIGITS = 3


def min_cost_flow(supply: list[int], demand: list[int], cost: list[list[int]]) -> list[list[int]]:
    """flow[i][j] of least total cost that sends every supply into the demands (sums are equal).

    Successive shortest paths in the residual graph; distances by Bellman and Ford, since
    backward edges have negative cost.
    """
    n, m = len(supply), len(demand)
    flow = [[0] * m for _ in range(n)]
    left, open_ = list(supply), list(demand)
    far = float("inf")
    while any(left):
        dist = [0 if left[i] else far for i in range(n)] + [far] * m
        back: list[int | None] = [None] * (n + m)
        changed = True
        while changed:
            changed = False
            for i in range(n):
                for j in range(m):
                    if dist[i] + cost[i][j] < dist[n + j]:
                        dist[n + j], back[n + j], changed = dist[i] + cost[i][j], i, True
                    if flow[i][j] and dist[n + j] - cost[i][j] < dist[i]:
                        dist[i], back[i], changed = dist[n + j] - cost[i][j], n + j, True
        end = min((j for j in range(m) if open_[j]), key=lambda j: dist[n + j])
        path, node = [], n + end
        while back[node] is not None:
            path.append((back[node], node))
            node = back[node]
        amount = min([left[node], open_[end], *(flow[v][u - n] for u, v in path if u >= n)])
        for u, v in path:
            if u < n:
                flow[u][v - n] += amount
            else:
                flow[v][u - n] -= amount
        left[node] -= amount
        open_[end] -= amount
    return flow


def even_capacities(total: int, shards: int) -> list[int]:
    return [total // shards + (j < total % shards) for j in range(shards)]


def _row_key() -> Column:
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text_crc32").cast("string"), F.col("size").cast("string")))


def _content() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")


def _size() -> Column:
    return (F.octet_length(_content()) + 1).cast("bigint")


def _row_hash(docs: DataFrame) -> Column:
    """A hash of all columns; the last part tells nulls in different columns apart."""
    def plain(c: str, kind: str) -> Column:
        col = F.col(f"`{c}`")
        return F.to_json(F.struct(col), {"ignoreNullFields": "false"}) if kind.startswith(("array", "struct", "map", "variant")) else col

    cols = [plain(c, kind) for c, kind in docs.dtypes]
    return F.md5(F.concat_ws(":", F.xxhash64(*cols).cast("string"), F.xxhash64(F.lit(1), *cols).cast("string"), *[c.isNull().cast("int").cast("string") for c in cols]))


def reshard(
    docs: DataFrame, old_shard: Column, n_old: int, n_new: int,
    capacities: list[int] | None = None, cost: list[list[int]] | None = None,
) -> DataFrame:
    """(doc_id, size, text_crc32, old_shard, row_hash, shard, slot) of every row of ``docs``.

    ``row_hash`` is equal for rows equal in all columns. ``old_shard`` is the present place, 0 to n_old - 1; ``capacities`` are bytes per new shard,
    near-equal by default. A shard keeps its number. Slots count from 0 in each new shard.
    """
    spark = docs.sparkSession
    narrow = docs.select(
        F.col("doc_id"), _size().alias("size"), F.crc32(_content()).alias("text_crc32"),
        old_shard.cast("int").alias("old_shard"), _row_hash(docs).alias("row_hash")).withColumn("_h", _row_key())
    placed = checkpointed(block_sums(narrow, ["old_shard"], F.substring("_h", 1, BLOCK_DIGITS), [F.col("_h")], {"before": F.col("size")}).drop("_block"))
    held = {r.old_shard: r.s for r in placed.groupBy("old_shard").agg(F.sum("size").alias("s")).collect()}  # one row per old shard
    supply = [held.get(i, 0) for i in range(n_old)]
    capacities = capacities or even_capacities(sum(supply), n_new)
    cost = cost or [[0 if i == j else 1 for j in range(n_new)] for i in range(n_old)]
    flow = min_cost_flow(supply, capacities, cost)
    runs = []
    for i in range(n_old):
        to = sorted((j for j in range(n_new) if flow[i][j]), key=lambda j: (cost[i][j], j)) or [min(i, n_new - 1)]
        ends, at = [], 0
        for j in to:
            at += flow[i][j]
            ends.append(at)
        runs.append((i, ends[:-1], to))
    plan = spark.createDataFrame(runs, "old_shard int, ends array<bigint>, targets array<int>")

    def run_of(byte: Column) -> Column:
        return F.size(F.filter("ends", lambda e: e <= byte))

    # One row per old shard: a broadcast of fixed size.
    cut = placed.join(F.broadcast(plan), "old_shard").withColumn("_r", run_of(F.col("before"))).withColumn(
        "_last", run_of(F.col("before") + F.col("size") - 1)).withColumn("_t", F.get("targets", F.col("_r"))).drop("ends", "targets")
    whole = {r._t: r.s for r in cut.where("_r = _last").groupBy("_t").agg(F.sum("size").alias("s")).collect()}
    across = cut.where("_r <> _last").groupBy("old_shard", "_r").agg(F.max("size").alias("size")).collect()  # at most one per run
    missing = {j: capacities[j] - whole.get(j, 0) for j in range(n_new)}
    chosen = []
    for r in sorted(across, key=lambda r: (-r.size, r.old_shard, r._r)):
        j = max(missing, key=lambda j: (missing[j], -j))
        missing[j] -= r.size
        chosen.append((r.old_shard, r._r, j))
    loose = F.broadcast(spark.createDataFrame(chosen, "old_shard int, _r int, _to int"))
    done = cut.join(loose, ["old_shard", "_r"], "left").select(
        "doc_id", "size", "text_crc32", "old_shard", "row_hash", "_h", F.when(F.col("_r") == F.col("_last"), F.col("_t")).otherwise(F.col("_to")).alias("shard"))
    block = F.concat(F.substring("_h", 1, BLOCK_DIGITS), F.col("old_shard").cast("string"))
    return block_sums(done, ["shard"], block, [F.col("_h"), F.col("old_shard")], {"slot": F.lit(1).cast("bigint")}).drop("_block", "_h")


def key_shard(doc_id: Column, shards: int) -> Column:
    """The present place: shards by a hash of the id."""
    return fold(doc_id, shards).cast("int")


def rewrite(docs: DataFrame, plan: DataFrame, path: str) -> list[int]:
    """Write the new shards that gain or lose documents, with all columns, below ``path``; their numbers.

    ``plan`` is a stored result of ``reshard(docs, ...)``. Shards whose documents all stay are not touched.
    Rows meet their places by a hash of all columns. Rows equal in all columns share one content, which
    goes to each of their places, so each is written once however often a document occurs.
    """
    changed = plan.where("shard <> old_shard").select(F.explode(F.array("shard", "old_shard")).alias("s")).distinct()
    numbers = sorted(r.s for r in changed.collect())  # at most one row per shard
    if not numbers:
        return numbers
    kept = [c for c in docs.columns if c not in ("shard", "slot", "old_shard")]
    rows = docs.select(_row_hash(docs).alias("_k"), *[F.col(f"`{c}`") for c in kept])
    several = written(plan.groupBy(F.col("row_hash").alias("_k")).agg(F.count(F.lit(1)).alias("_c")).where("_c > 1").select("_k", F.lit(True).alias("_several")))
    place = lookup_join(plan.select(F.col("row_hash").alias("_k"), "old_shard", "shard", "slot").where(F.col("shard").isin(numbers)), several, "_k")
    rows = lookup_join(rows, several, "_k")
    single = place.where("_several IS NULL").drop("_several").join(rows.where("_several IS NULL").drop("_several"), "_k")
    # Texts are never broadcast; a document with very many places is a hot key of the narrow side.
    one = rows.where("_several").drop("_several").dropDuplicates(["_k"])
    many = lookup_join(place.where("_several").drop("_several"), one, "_k", "inner", max_rows=0)
    out = [*[F.col(f"`{c}`") for c in kept], "old_shard", "slot", "shard"]
    # Tasks write their part of each shard as they have it: texts are shuffled once, by row.
    single.select(out).unionAll(many.select(out)).write.mode("append").partitionBy("shard").parquet(path)
    return numbers


def resharded(docs: DataFrame, old_shard: Column, n_old: int, n_new: int) -> DataFrame:
    """(doc_id, size, text_crc32, old_shard, shard, slot) of every row of ``docs`` after the move.

    The affected shards are written to the shared folder; their rows of the result are read from there. Rows of
    shards that are not touched come from the plan.
    """
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/shards-{uuid.uuid4().hex}"
    plan = written(reshard(docs, old_shard, n_old, n_new))
    numbers = rewrite(docs, plan, path)
    columns = ["doc_id", "size", "text_crc32", "old_shard", "shard", "slot"]
    stay = plan.where(~F.col("shard").isin(numbers)).select(columns)
    if not numbers:
        return stay
    kinds = {f.name: f.dataType for f in [*docs.schema, *plan.schema] if f.name in ("doc_id", "text")} | {c: plan.schema[c].dataType for c in ("old_shard", "slot", "shard")}
    moved = spark.read.schema(T.StructType([T.StructField(c, t) for c, t in kinds.items()])).parquet(path)
    return moved.select("doc_id", _size().alias("size"), F.crc32(_content()).alias("text_crc32"), "old_shard", "shard", "slot").unionAll(stay)


def op5_shard_min_cost_flow(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return resharded(docs, key_shard(F.col("doc_id"), OLD_SHARDS), OLD_SHARDS, NEW_SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "old_shard")


QUERIES = {"op5_shard_min_cost_flow": op5_shard_min_cost_flow}
ORACLES: dict[str, str] = {}
