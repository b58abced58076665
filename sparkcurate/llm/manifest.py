"""Merkle manifest of a dataset: one tree over the rows of a table, and a version of it per changed row.

Each row is a leaf: the SHA-256 of its columns, length-prefixed. The leaves of a language ascend by
doc_id; every ``FAN`` consecutive nodes become their parent until one is left, the subroot. Subroots,
ordered by language, are joined the same way into the root.

The tree is persistent. A changed row makes a version of its own, which copies the ancestors of its
leaf and shares every other node with the stored tree. Work follows aligned blocks of
``FAN ** BLOCK_LEVELS`` leaves: the nodes of a block are built and copied in one task, so a language
with a third of all rows is many tasks. Above the blocks the tree is a table per level, a few
hundredths of a per cent of the rows, built by grouped aggregates; the path of a block through it (the
hashes left and right of it in each run) is joined to the block, and the block's versions go on
along it. Only leaf hashes are shuffled, never texts.

Edge cases: null in any column is ``-`` in the leaf. Null languages and null ids come first, a null id
counts as empty text for the tamper rule. Repeated rows are separate leaves; rows with one id are
ordered by their leaf hash. A single leaf is its own subroot, a single subroot the root; without
siblings the proof is the hash of no input. Texts of any length are hashed once, at the scan. Other
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..operators.ordering import number_rows
from ..session import lookup_join
from .common import fold, table, written

FAN = 8
BLOCK_LEVELS = 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*[_field(c) for c in columns]).cast("binary"), 256)


def leaves(docs: DataFrame, changed: Column, text: Column) -> DataFrame:
    """(doc_id, lang_key, leaf, new_leaf): ``new_leaf`` has ``text`` for the row's, where ``changed``; else it is null."""
    values = [F.col(c) for c in COLUMNS]
    new = leaf_hash([*values[:-1], text])
    return docs.select(
        "doc_id",
        # In byte order like the language, null first, and never null.
        F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit("")).alias("lang_key"),
        leaf_hash(values).alias("leaf"),
        F.when(changed & F.col("text").isNotNull() & (text != F.col("text")), new).alias("new_leaf"),
    )


def placed(rows: DataFrame) -> DataFrame:
    """``rows`` with ``tree`` (number of the language from 0), ``pos`` (from 0 in the language) and ``n`` (its leaves)."""
    numbered = written(number_rows(rows, ["lang_key", "doc_id", "leaf"], "_no"))
    langs = numbered.groupBy("lang_key").agg(F.min("_no").alias("_first"), F.count(F.lit(1)).alias("n"))
    langs = written(number_rows(langs, ["lang_key"], "_tree").select("lang_key", (F.col("_tree") - 1).alias("tree"), "_first", "n"))
    return lookup_join(numbered, langs, "lang_key").withColumn("pos", F.col("_no") - F.col("_first")).drop("_no", "_first")


def levels_of(n: int) -> int:
    """Levels from ``n`` nodes up to one."""
    k = 0
    while n > 1:
        n, k = -(-n // FAN), k + 1
    return k


def _parent(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _block_levels(hashes: list[str], n: int) -> list[list[str]]:
    """Node hashes of a block by level, from the leaves up to the block's one node."""
    out = [hashes]
    for _ in range(min(BLOCK_LEVELS, levels_of(n))):
        below = out[-1]
        out.append([_parent("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
    return out


def _block_node(key: tuple, block: pd.DataFrame) -> pd.DataFrame:
    tree, number, n = (int(k) for k in key)
    ordered = block.sort_values("pos")["leaf"].tolist()
    width = FAN**BLOCK_LEVELS
    return pd.DataFrame({"tree": [tree], "pos": [number], "hash": [_block_levels(ordered, n)[-1][0]], "n": [-(-n // width)]})


_NODE = "tree bigint, pos bigint, hash string, n bigint"


def paths(nodes: DataFrame) -> DataFrame:
    """(tree, pos, path, top) of the nodes (tree, pos, hash, n) of trees with ``n`` nodes each.

    ``path`` holds, from this level up, the hashes left and right of the node's ancestor in its run
    (``before``, ``after``, concatenated); ``top`` is the tree's last node. Every level is a table.
    """
    levels, runs = [written(nodes)], []
    while levels[-1].where("n > 1").limit(1).count():
        run = levels[-1].where("n > 1").groupBy("tree", F.expr(f"pos div {FAN}").alias("up"), "n").agg(
            F.array_sort(F.collect_list(F.struct("pos", "hash"))).alias("members"))  # at most FAN entries
        run = run.select("tree", "up", "n", F.transform("members", lambda m: m["pos"]).alias("at"), F.transform("members", lambda m: m["hash"]).alias("parts"))
        runs.append(written(run))
        levels.append(written(runs[-1].select(
            "tree", F.col("up").alias("pos"), F.sha2(F.array_join("parts", "").cast("binary"), 256).alias("hash"), F.expr(f"(n + {FAN - 1}) div {FAN}").alias("n"))))

    def tops(level: DataFrame) -> DataFrame:
        none = F.array().cast("array<struct<before:string,after:string>>")
        return level.where("n = 1").select("tree", "pos", none.alias("path"), F.col("hash").alias("top"))

    found = tops(levels[-1])
    for level, run in zip(reversed(levels[:-1]), reversed(runs), strict=True):
        each = run.select("tree", "up", "parts", F.posexplode("at").alias("i", "pos")).select(
            "tree", "up", "pos",
            F.struct(
                F.array_join(F.slice("parts", F.lit(1), F.col("i")), "").alias("before"),
                F.array_join(F.slice("parts", F.col("i") + 2, F.lit(FAN)), "").alias("after")).alias("_step"))
        parent = found.select("tree", F.col("pos").alias("up"), "path", "top")
        below = each.join(parent, ["tree", "up"]).select("tree", "pos", F.concat(F.array("_step"), "path").alias("path"), "top")
        found = written(below.unionByName(tops(level)))
    return found


def _versions(key: tuple, block: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
    """Proofs and versions of a block's leaves: each changed leaf copies its ancestors, all else is shared."""
    block = block.sort_values("pos")
    levels = _block_levels(block["leaf"].tolist(), int(key[2]))
    path = [(p["before"], p["after"]) for p in above["path"].iloc[0]]
    upper = "".join(b + a for b, a in path)
    subroot, root = above["subroot"].iloc[0], above["root"].iloc[0]
    sides: list[list[tuple[str, str]]] = []
    for nodes in levels[:-1]:
        side = []
        for i in range(0, len(nodes), FAN):
            run = nodes[i : i + FAN]
            side += [("".join(run[:j]), "".join(run[j + 1 :])) for j in range(len(run))]
        sides.append(side)
    rest = [""] * len(levels[-1])  # siblings above a node, level by level
    for side in reversed(sides):
        rest = [b + a + rest[i // FAN] for i, (b, a) in enumerate(side)]
    proofs, roots, copies = [], [], []
    for i, new in enumerate(block["new_leaf"].tolist()):
        proofs.append(_parent(rest[i] + upper))
        made: list[str] = []
        if isinstance(new, str):
            at, node = i, new
            for side in sides:
                before, after = side[at]
                node = _parent(before + node + after)
                made.append(node)
                at //= FAN
            for before, after in path:
                node = _parent(before + node + after)
                made.append(node)
            roots.append(node)
        else:
            roots.append(root)
        copies.append(made)
    return pd.DataFrame({
        "doc_id": block["doc_id"].to_numpy(), "leaf": block["leaf"].to_numpy(), "subroot": subroot, "root": root,
        "proof_sha256": proofs, "folded_root": roots, "verified": [r == root for r in roots],
        "tree": block["tree"].to_numpy(), "pos": block["pos"].to_numpy(), "copied_nodes": copies,
    })


def manifest(docs: DataFrame, changed: Column, text: Column) -> DataFrame:
    """Per row of ``docs``: leaf, subroot, root, proof, and the version in which its text is ``text`` (where ``changed``).

    ``copied_nodes`` are the hashes of the ancestors that the version copies, from the leaf's parent to
    the root; it is empty where the row's leaf is the stored one, and the version is the stored tree.
    """
    width = FAN**BLOCK_LEVELS
    rows = written(placed(written(leaves(docs, changed, text))).withColumn("block", F.expr(f"pos div {width}")))
    blocks = rows.select("tree", "block", "n", "pos", "leaf").groupBy("tree", "block", "n").applyInPandas(_block_node, _NODE)
    inner = paths(blocks)
    subroots = inner.where("pos = 0").select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("pos"), F.col("top").alias("hash"))
    outer = paths(subroots.withColumn("n", F.lit(subroots.count())))
    outer = outer.select(F.col("pos").alias("tree"), F.col("path").alias("_more"), F.col("top").alias("root"))
    above = lookup_join(inner, outer, "tree").select(
        "tree", F.col("pos").alias("block"), F.concat("path", "_more").alias("path"), F.col("top").alias("subroot"), "root")
    # The key carries n as a third column on both sides, so that a block knows the height of its tree.
    sizes = rows.groupBy("tree", "block").agg(F.first("n").alias("n"))
    above = above.join(sizes, ["tree", "block"]).select(*[F.col(c).alias(c) for c in ("tree", "block", "n", "path", "subroot", "root")])
    schema = (
        f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, leaf string, subroot string, root string, proof_sha256 string, "
        "folded_root string, verified boolean, tree bigint, pos bigint, copied_nodes array<string>")
    keys = ["tree", "block", "n"]
    return rows.drop("lang_key").groupBy(*keys).cogroup(above.groupBy(*keys)).applyInPandas(_versions, schema)


def lowered(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of ``documents``; where 3 divides the crc32 of the id, a version with A-Z of the text lower-cased."""
    found = manifest(table(spark, sf_dir, "documents"), fold(F.col("doc_id"), 3) == 0, lowered(F.col("text")))
    return found.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified",
        F.size("copied_nodes").cast("bigint").alias("n_copied"))


# crc32 by bits over the digits of the id: a step of the list is a byte to add, or -1 to shift.
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length(d) + 1),
    lambda i: list_prepend(ord(d[i])::BIGINT, list_transform(range(8), lambda k: -1::BIGINT))))),
    lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295)"""


def _enc(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')"


_HEAD = " || ".join(_enc(c) for c in COLUMNS[:-1])

ORACLE = f"""
WITH RECURSIVE given AS (
  SELECT *, translate(text, '{UPPER}', '{LOWER}') AS low, coalesce(doc_id::VARCHAR, '') AS d FROM documents),
hashed AS (
  SELECT doc_id, lang, sha256({_HEAD} || {_enc("text")}) AS leaf,
    CASE WHEN {_CRC} % 3 = 0 THEN sha256({_HEAD} || {_enc("low")}) END AS new_leaf
  FROM given),
leaf AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY lang) AS n, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree FROM hashed),
lvl AS (
  SELECT tree, 0 AS level, pos, leaf AS hash, n FROM leaf
  UNION ALL
  SELECT tree, level + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)), (n + 7) // 8 FROM lvl WHERE n > 1 GROUP BY tree, level, pos // 8, n),
sub AS (SELECT tree, hash AS subroot FROM lvl WHERE n = 1),
top AS (
  SELECT 0 AS level, tree AS pos, subroot AS hash, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT level + 1, pos // 8, sha256(string_agg(hash, '' ORDER BY pos)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY level, pos // 8, n),
side AS (
  SELECT l.tree, l.pos, s.level,
    coalesce(string_agg(s.hash, '' ORDER BY s.pos) FILTER (s.pos < l.pos >> (3 * s.level)), '') AS before,
    coalesce(string_agg(s.hash, '' ORDER BY s.pos) FILTER (s.pos > l.pos >> (3 * s.level)), '') AS after
  FROM leaf l JOIN lvl s ON s.tree = l.tree AND s.n > 1 AND s.pos >> 3 = l.pos >> (3 * s.level + 3) GROUP BY ALL
  UNION ALL
  SELECT l.tree, l.pos, 1000 + s.level,
    coalesce(string_agg(s.hash, '' ORDER BY s.pos) FILTER (s.pos < l.tree >> (3 * s.level)), ''),
    coalesce(string_agg(s.hash, '' ORDER BY s.pos) FILTER (s.pos > l.tree >> (3 * s.level)), '')
  FROM leaf l JOIN top s ON s.n > 1 AND s.pos >> 3 = l.tree >> (3 * s.level + 3) GROUP BY ALL),
path AS (SELECT tree, pos, list({{'b': before, 'a': after}} ORDER BY level) AS steps, string_agg(before || after, '' ORDER BY level) AS sib FROM side GROUP BY ALL),
folded AS (
  SELECT leaf.*, steps, coalesce(sib, '') AS sib,
    list_reduce(list_prepend({{'b': coalesce(new_leaf, leaf), 'a': ''}}, coalesce(steps, [])), lambda x, y: {{'b': sha256(y.b || x.b || y.a), 'a': ''}}).b AS folded_root
  FROM leaf LEFT JOIN path USING (tree, pos))
SELECT doc_id, leaf, subroot, root, sha256(sib) AS proof_sha256, folded_root, folded_root = root AS verified,
  CASE WHEN new_leaf <> leaf THEN len(coalesce(steps, [])) ELSE 0 END AS n_copied
FROM folded JOIN sub USING (tree), (SELECT hash AS root FROM top WHERE n = 1)
"""

QUERIES = {"op12_merkle_manifest": op12_merkle_manifest}
ORACLES = {"op12_merkle_manifest": ORACLE}
