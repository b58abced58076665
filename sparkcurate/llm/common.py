"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared checkpoint folder, read back.

    For loops: unlike a checkpoint, the table carries no constraints of earlier rounds, which would
    make planning slower with every round.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# A graph of so many edges is at most a few dozen MB and is finished in one task.
SMALL_EDGES = 500_000


def _finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(node, to) of a small graph by union-find; the root is the smallest node."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for frame in frames:
        for a, b in zip(frame.a.tolist(), frame.b.tolist(), strict=True):
            a, b = root(up.setdefault(a, a)), root(up.setdefault(b, b))
            up[max(a, b)] = min(a, b)
    nodes = list(up)
    yield pd.DataFrame({"node": nodes, "to": [root(x) for x in nodes]}, dtype="int64")


def components(edges: DataFrame, small: int | None = None) -> DataFrame:
    """(node, label) of an undirected graph of edges (a, b): the label is the smallest node reachable.

    The graph is contracted: in a round every node goes to the neighbour (or itself) with the
    smallest hash, and edges are carried over to where their ends went. Hashes change with
    the round, so a good part of the nodes vanishes each time whatever their order, and the rounds
    grow with the logarithm of the graph. What is left at ``small`` edges or fewer is finished at
    once. Only joins and combined aggregates are used; a join always meets one row per key on
    one side, so a node with very many edges is split by adaptive skew handling. State is
    written to the shared folder.
    """
    small = SMALL_EDGES if small is None else small
    left = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).where("a <> b").distinct())
    moves: list[DataFrame] = []
    while (count := left.count()) > small:
        seed = F.lit(len(moves))
        ends = left.unionAll(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        best = ends.groupBy("a").agg(F.min(F.struct(F.xxhash64("b", seed).alias("h"), F.col("b").alias("to"))).alias("m"))
        own = F.struct(F.xxhash64("a", seed).alias("h"), F.col("a").alias("to"))
        to = written(best.select(F.col("a").alias("node"), F.least("m", own)["to"].alias("to")))
        first = left.join(to.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
        both = first.join(to.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
        left = written(both.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())
        moves.append(to)
    if count:
        moves.append(written(left.coalesce(1).mapInPandas(_finish, "node bigint, to bigint")))
    if not moves:
        return left.select(F.col("a").alias("node"), F.col("b").alias("label"))
    # Follow each node through the rounds; a node that no longer moves has arrived.
    at = moves[0]
    for to in moves[1:]:
        at = written(at.join(to.select(F.col("node").alias("to"), F.col("to").alias("next")), "to", "left").select("node", F.coalesce("next", "to").alias("to")))
    if len(moves) == 1 and count:
        return at.select("node", F.col("to").alias("label"))
    low = at.groupBy("to").agg(F.min("node").alias("label"))
    return written(at.join(low, "to").select("node", "label"))
