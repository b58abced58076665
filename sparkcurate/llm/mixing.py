"""Mixing sources to target weights by a time-varying curriculum.

Each source has a weight schedule over training time t in [0, 1]. Its integral is the source's
target (words it contributes); its shape is a straight ramp, steeper or flatter and rising or
falling by the source's rank, so the mix changes while training goes on. The words of a source
lie in passes over its documents, in hash order. The cumulative demand
D(t) = target * ((1 + b) * t - b * t**2) of a source with slope b is inverted at the words before
a document: that is the training position at which the document is needed. Sorting by
position gives the training order.

Targets: ``share`` of all words is dealt to the sources by weight; a source stops at ``cap`` times
its size, and the excess is dealt again by weight until none is above. That fixed point is
min(cap * size, x * weight) for one x, found with a running sum over the sources, one row each.

All steps are DataFrame functions. A source that holds a third of all rows is cut into blocks
by hash; running sums go over blocks (``prefix.block_sums``).

Edge cases: null text has size 0, and a document of size 0 takes nothing but has a position. A null
source is a source of its own, last in order. Repeated rows are separate documents. A null doc_id
is ordered like empty text. A source whose documents are all empty gets target 0. The document
in which a target ends is taken in part: its first words. Other columns are ignored, except by
``mixed``, which keeps all. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import WORD, table
from .prefix import block_sums

WEIGHTS = (5.0, 2.0, 1.0)
SHARE, CAP = 1.5, 2.0
# Slopes of the schedules, repeating by rank: falling, level and rising need over time.
SLOPES = (0.5, 0.0, -0.5)
BLOCK_DIGITS = 3  # hex digits of the hash that number the blocks of a source


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _row_key() -> Column:
    """A hash of doc_id and text: the order of documents inside a source."""
    text = F.sha2(F.coalesce(F.col("text").cast("string"), F.lit("")), 256)
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), text))


def _repeating(values: tuple[float, ...], rank: Column) -> Column:
    return F.get(F.array(*[F.lit(float(v)) for v in values]), ((rank - 1) % len(values)).cast("int"))


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """(source, source_size, rank, weight, target) from (source, source_size), one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("rank", F.row_number().over(by_name)).withColumn("weight", _repeating(weights, F.col("rank")))
    # In order of cap * size / weight the first sources stop at their cap, the others share the rest.
    by_ratio = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    every = Window.partitionBy()
    capped = F.coalesce(F.sum("source_size").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) * F.lit(cap)
    open_ = F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    levels = ranked.select(
        "*", ((F.sum("source_size").over(every) * F.lit(share) - capped) / open_).alias("level"),
        (F.col("source_size") * F.lit(cap) / F.col("weight")).alias("ratio"))
    # The level of the first source that stays below its cap holds for all after it.
    first = F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "rank", "level"))).over(every)
    return levels.select(
        "source", "source_size", "rank", "weight",
        F.least(F.col("source_size") * F.lit(cap), F.coalesce(first["level"], F.lit(float("inf"))) * F.col("weight")).alias("target"))


def _position(words_before: Column, target: Column, slope: Column) -> Column:
    """Training time at which the cumulative demand of a source reaches ``words_before``."""
    part = F.least(F.lit(1.0), words_before / target)
    bent = ((1.0 + slope) - F.sqrt((1.0 + slope) * (1.0 + slope) - 4.0 * slope * part)) / (2.0 * slope)
    return F.when(target <= 0, F.lit(0.0)).when(slope == 0, part).otherwise(bent)


def curriculum(
    docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP,
    slopes: tuple[float, ...] = SLOPES,
) -> DataFrame:
    """Every row of ``docs`` as (doc_id, source, size, source_size, target, before, taken, position).

    ``before``: words of the source before the document in one pass. ``taken``: words taken over all
    passes. ``position``: time of its first use in [0, 1]; null when it is not used.
    """
    narrow = docs.select(
        F.col("doc_id").alias("doc_id"), F.col("source").cast("string").alias("source"),
        word_count(F.col("text").cast("string")).alias("size"),
        _row_key().alias("_h"))
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = source_targets(sizes, weights, share, cap).withColumn("slope", _repeating(slopes, F.col("rank")))
    placed = block_sums(narrow, ["source"], F.substring("_h", 1, BLOCK_DIGITS), [F.col("_h")], {"before": F.col("size")})
    key = targets.withColumnRenamed("source", "_s")
    # Sources are few against documents; the join is by hash unless Spark finds the side small.
    joined = placed.join(key, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    goal = F.floor(F.col("target")).cast("bigint")

    def used(p: int) -> Column:
        return F.greatest(F.lit(0), F.least(F.col("size"), goal - F.col("before") - F.col("source_size") * p))

    passes = max(1, int(-(-cap // 1)))
    taken = used(0)
    for p in range(1, passes):
        taken = taken + used(p)
    return joined.select(
        "doc_id", "source", "size", "source_size", "target", "before", taken.cast("bigint").alias("taken"),
        F.when(used(0) > 0, _position(F.col("before").cast("double"), F.col("target"), F.col("slope"))).alias("position"),
        "slope", "_h")


def training_order(plan: DataFrame, cap: float = CAP) -> DataFrame:
    """One row per use of a document, sorted by range over training time.

    (doc_id, source, pass, words, position); a document repeated in a later pass comes again at the
    time at which the demand of its source reaches it.
    """
    goal = F.floor(F.col("target")).cast("bigint")
    at = F.col("before") + F.col("source_size") * F.col("pass")
    uses = plan.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(max(1, int(-(-cap // 1))) - 1)))).select(
        "*", F.greatest(F.lit(0), F.least(F.col("size"), goal - at)).cast("bigint").alias("words"))
    return uses.where("words > 0").select(
        "doc_id", "source", "pass", "words", "_h", _position(at.cast("double"), F.col("target"), F.col("slope")).alias("use")
    ).orderBy("use", "source", "pass", "_h").select("doc_id", "source", "pass", "words", F.col("use").alias("position"))


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """The rows of ``docs``, all columns, repeated once for every pass that uses them.

    The row in which a target ends is kept whole. A document without words is kept once, for it
    takes no budget. Texts move once, to meet the plan on a key of the document. Rows equal in doc_id,
    source and text count as one row that is repeated, and share their uses.
    """
    plan = curriculum(docs, weights, share, cap)
    goal = F.floor(F.col("target")).cast("bigint")
    uses = F.lit(0)
    for p in range(max(1, int(-(-cap // 1)))):
        uses = uses + F.when(goal - F.col("before") - F.col("source_size") * p > 0, 1).otherwise(0)
    uses = F.when(F.col("size") == 0, F.lit(1)).otherwise(uses)
    counts = plan.groupBy(F.col("_h").alias("__plan_key"), F.col("source").alias("__plan_source")).agg(
        F.sum(uses).cast("int").alias("__uses"), F.count(F.lit(1)).alias("__rows")).where("__uses > 0")
    rows = docs.select("*", _row_key().alias("__key"), F.col("source").cast("string").alias("__source"))
    joined = rows.join(counts, (F.col("__key") == F.col("__plan_key")) & F.col("__source").eqNullSafe(F.col("__plan_source")))
    single = joined.where("__rows = 1")
    several = joined.where("__rows > 1").dropDuplicates(["__key", "__source"])
    return single.unionAll(several).withColumn("__use", F.explode(F.sequence(F.lit(1), F.col("__uses")))).select(*docs.columns)


def op6_mix_curriculum(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = curriculum(table(spark, sf_dir, "documents"))
    return plan.orderBy(F.col("position").asc_nulls_last(), "source", "_h").select(
        "doc_id", "size", "source_size", "target", "taken", "position")


QUERIES = {"op6_mix_curriculum": op6_mix_curriculum}
ORACLES = {
    "op6_mix_curriculum": r"""
        WITH d AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                md5(doc_id || ':' || sha256(coalesce(text, ''))) AS h FROM documents),
        s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
        r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM s),
        w AS (SELECT *, [5.0::DOUBLE, 2.0, 1.0][(rank - 1) % 3 + 1] AS weight, [0.5::DOUBLE, 0.0, -0.5][(rank - 1) % 3 + 1] AS slope FROM r),
        l AS (
            SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
                - 2.0::DOUBLE * coalesce(sum(source_size) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(weight) OVER (ORDER BY source_size / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level,
                source_size * 2.0::DOUBLE / weight AS ratio FROM w),
        t AS (
            SELECT source, source_size, slope, least(source_size * 2.0::DOUBLE,
                (SELECT level FROM l WHERE level <= ratio ORDER BY ratio, rank LIMIT 1) * weight) AS target FROM l),
        p AS (
            SELECT d.*, t.source_size, t.target, t.slope, CAST(coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS before
            FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
        q AS (
            SELECT *, greatest(0, least(size, CAST(floor(target) AS BIGINT) - before)) AS u0,
                greatest(0, least(size, CAST(floor(target) AS BIGINT) - before - source_size)) AS u1,
                least(1.0::DOUBLE, before / target) AS part FROM p)
        SELECT doc_id, size, source_size, target, u0 + u1 AS taken, CASE WHEN u0 > 0 THEN CASE WHEN target <= 0 THEN 0.0::DOUBLE
            WHEN slope = 0 THEN part
            ELSE ((1.0::DOUBLE + slope) - sqrt((1.0::DOUBLE + slope) * (1.0::DOUBLE + slope) - 4.0::DOUBLE * slope * part)) / (2.0::DOUBLE * slope) END END AS position
        FROM q
    """,
}
