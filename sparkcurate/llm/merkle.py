"""Document fingerprints: a Merkle tree over pieces, paragraphs and sections.

* A paragraph is a line. Its hash is the SHA-256 of its text.
* A section is a run of paragraphs; it ends after a paragraph whose hash ends in 0 or 1, so about
  every eighth, and an inserted paragraph changes only the sections around it. Its hash covers
  the hashes of its paragraphs.
* The root covers the hashes of the sections. Equal roots mean equal texts.
* Below the paragraphs, pieces of ``PIECE`` characters from the start of their line are hashed to 24 bits;
  they measure how much of a changed paragraph is shared.

The fingerprint is ``root;sections;paragraphs;pieces``: hex digits of the root, base64 of six
bytes per section and per paragraph and of three bytes per distinct piece. Everything is a DataFrame
function on the document's own row; only neighbours in id order need a shuffle.

Edge cases: null text is empty; the fingerprint of the empty text is that of one empty paragraph.
Two empty texts have likeness 1, an empty and another text 0. Repeated rows with one doc_id are
each fingerprinted; they share the next doc_id's document as neighbour (its smallest text, if that
id is repeated too), and a single distinct doc_id is its own neighbour. A null doc_id is last in
descending order. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.columns import let
from ..session import checkpointed
from .common import table

PIECE = 16
_BREAK = r"[01]$"
_EMPTY = "array<int>"


def pieces(text: Column) -> Column:
    """The distinct 24-bit hashes of the pieces of all lines."""
    found = F.regexp_extract_all(text, F.lit(r"[^\n]{1,%d}" % PIECE), F.lit(0))
    return F.array_distinct(F.transform(found, lambda p: F.xxhash64(p).bitwiseAND(0xFFFFFF).cast("int")))


def paragraphs(text: Column) -> Column:
    """Hex SHA-256 of each line."""
    return F.transform(F.split(text, "\n", -1), lambda p: F.sha2(p, 256))


def sections(hashes: Column) -> Column:
    """Each section as the comma-joined hashes of its paragraphs."""
    marked = F.array_join(F.transform(hashes, lambda h: F.concat(h, F.when(h.rlike(_BREAK), ";").otherwise(","))), "")
    return F.split(F.regexp_replace(marked, "[;,]$", ""), ";")


def tree(text: Column) -> Column:
    """struct(root, sections, paragraphs, pieces) of a text that is not null."""
    def build(hashes: Column) -> Column:
        tops = F.transform(sections(hashes), lambda s: F.sha2(s, 256))
        return let(tops, lambda t: F.struct(
            F.sha2(F.array_join(t, ","), 256).alias("root"), t.alias("sections"), hashes.alias("paragraphs"), pieces(text).alias("pieces")))

    return let(paragraphs(text), build)


def fingerprint(node: Column) -> Column:
    """The tree as one string."""
    def packed(values: Column, digits: int) -> Column:
        coded = F.base64(F.unhex(F.array_join(F.transform(values, lambda h: F.substring(h, 1, digits)), "")))
        return F.translate(coded, "\r\n", "")

    small = F.transform(node["pieces"], lambda p: F.lpad(F.hex(p), 6, "0"))
    return F.concat_ws(";", node["root"], packed(node["sections"], 12), packed(node["paragraphs"], 12), packed(small, 6))


def likeness(a: Column, b: Column) -> Column:
    """Shared pieces of two piece sets, 0 to 1: twice the intersection over both sizes."""
    both = F.size(a) + F.size(b)
    return F.when(both == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / both)


def changed_paragraphs(a: Column, b: Column) -> Column:
    """Numbers of the paragraphs of tree ``a`` that tree ``b`` lacks, found from the top.

    Equal roots end the search; only paragraphs of sections that ``b`` does not have are compared.
    """
    def inside(keep: Column) -> Column:
        # Sections are runs of paragraphs: their number is the count of breaks before.
        number = F.sequence(F.lit(0), F.size(a["paragraphs"]) - 1)
        breaks = F.transform(a["paragraphs"], lambda h: h.rlike(_BREAK).cast("int"))
        of = F.aggregate(
            breaks, F.struct(F.lit(0).alias("n"), F.array().cast(_EMPTY).alias("at")),
            lambda acc, x: F.struct((acc["n"] + x).alias("n"), F.array_append(acc["at"], acc["n"]).alias("at")), lambda acc: acc["at"])
        return let(of, lambda s: F.filter(number, lambda i: F.array_contains(keep, F.get(s, i)) & ~F.array_contains(b["paragraphs"], F.get(a["paragraphs"], i))))

    open_ = F.filter(
        F.sequence(F.lit(0), F.size(a["sections"]) - 1), lambda i: ~F.array_contains(b["sections"], F.get(a["sections"], i)))
    return F.when(a["root"] == b["root"], F.array().cast(_EMPTY)).otherwise(let(open_, inside))


def _id_order(docs: DataFrame) -> DataFrame:
    """(doc_id, next_id, need): the next smaller id, wrapped around, and the code points to take from it.

    Ids are cut into ranges; neighbours meet inside a range, and the ends of ranges, one row each,
    are joined up. No task holds more than a range.
    """
    ids = docs.groupBy("doc_id").agg(F.floor(F.max(F.length("text")) / 3).cast("int").alias("need"))
    n = int(ids.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    down = F.col("doc_id").desc_nulls_last()
    cut = checkpointed(ids.repartitionByRange(n, down).withColumn("part", F.spark_partition_id()))
    local = Window.partitionBy("part").orderBy(down)
    # A struct, so that a null id differs from no row at all.
    near = cut.withColumn("next", F.lead(F.struct("doc_id")).over(local))
    heads = cut.groupBy("part").agg(F.max(F.struct(F.col("doc_id").isNotNull().alias("k"), F.col("doc_id").alias("doc_id"))).alias("h"))
    by_part, every = Window.orderBy("part"), Window.partitionBy()
    heads = heads.select(F.col("part").alias("_p"), F.coalesce(
        F.lead(F.struct("h.doc_id")).over(by_part), F.min_by(F.struct("h.doc_id"), F.col("part")).over(every)).alias("after"))
    joined = near.join(F.broadcast(heads), F.col("part") == F.col("_p"))  # one row per range
    return joined.select("doc_id", F.coalesce("next", "after")["doc_id"].alias("next_id"), "need")


def with_neighbours(docs: DataFrame) -> DataFrame:
    """Every row as (doc_id, text, next_head, next_pieces): the start and the pieces of the next document.

    Texts move once: both joins use the same shuffle by doc_id.
    """
    kind = dict(docs.dtypes)["doc_id"]
    order = _id_order(docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    # Ids as text that is never null: plain equality lets the joins and the aggregate share one partitioning.
    rows = docs.select(_name("doc_id").alias("key"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    to = order.select(_name("doc_id").alias("for"), _name("next_id").alias("from"), "need")
    head = rows.join(to, F.col("key") == F.col("from")).select(
        "for", F.struct(F.expr("substring(text, 1, need)").alias("head"), F.xxhash64("text").alias("h"), pieces(F.col("text")).alias("pieces")).alias("next"))
    nearest = head.groupBy("for").agg(F.min_by("next", F.struct("next.head", "next.h")).alias("next"))
    return rows.join(nearest, F.col("key") == F.col("for")).select(
        F.when(F.col("key") != "", F.col("key")).cast(kind).alias("doc_id"), "text",
        F.col("next.head").alias("next_head"), F.col("next.pieces").alias("next_pieces"))


def _name(doc_id: str) -> Column:
    return F.coalesce(F.col(doc_id).cast("string"), F.lit(""))


def edited(text: Column, head: Column) -> Column:
    """``text`` with its last third replaced by as much of ``head``."""
    n = F.floor(F.length(text) / 3).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - n), F.substring(head, F.lit(1), n))


def op1_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_neighbours(table(spark, sf_dir, "documents")).withColumn("edit", edited(F.col("text"), F.col("next_head")))
    trees = rows.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("edit", 256).alias("edited_sha256"),
        tree(F.col("text")).alias("own"), tree(F.col("edit")).alias("other"), "next_pieces")
    return trees.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("own")).alias("fingerprint"),
        fingerprint(F.col("other")).alias("edited_fingerprint"), likeness(F.col("own.pieces"), F.col("other.pieces")).alias("near_edited"),
        likeness(F.col("own.pieces"), F.col("next_pieces")).alias("near_next"),
        F.size(changed_paragraphs(F.col("own"), F.col("other"))).alias("changed_paragraphs"))


QUERIES = {"op1_merkle_fingerprint": op1_merkle_fingerprint}
ORACLES: dict[str, str] = {}
