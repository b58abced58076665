"""Keep-first windows, global numbering without a single task, and batch splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window, functions as F

from ..functions.columns import let

# Rows that one slice may hold before the table is cut, and sampled rows per slice.
SLICE_ROWS = 20_000
SAMPLES_PER_SLICE = 40


def keep_first(
    df: DataFrame,
    key: str,
    order: list[str],
    status: str = "status",
    first: str = "kept",
    later: str = "duplicate",
    keep_null_keys: bool = True,
) -> DataFrame:
    """Label the first row of each key, in source order, and its later copies.

    One aggregate finds the first row per key (combined map-side, so a key with a third
    of all rows costs one row per task), and the answer is joined back. A null key is
    never equal to another null key.
    """
    at = F.struct(*order)
    firsts = (
        df.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_k"))
        .agg(F.min(at).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    joined = df.join(firsts, df[key] == F.col("_k"), "left")
    dup = F.coalesce(F.col("_first") < at, F.lit(False))
    if not keep_null_keys:
        dup = dup | F.col(key).isNull()
    return joined.withColumn(status, F.when(dup, later).otherwise(first)).drop("_k", "_first")


def number_rows(df: DataFrame, order: list[str], out: str = "row_no", slices: int | None = None) -> DataFrame:
    """Consecutive numbers 1..N over the whole table in ``order``, without one global task."""
    return running_total(df, order, F.lit(1).cast("bigint"), out, slices)


def running_total(
    df: DataFrame, order: list[str], value: Column, out: str, slices: int | None = None
) -> DataFrame:
    """Running sum of ``value`` over the whole table in ``order`` (unique), without one global task.

    The order is cut at sampled bounds into slices; the sums of the slices before become
    offsets, and each slice sums inside itself. The bounds only balance the work: any
    bounds give the same totals. They compare the whole order struct, so a first column
    that is equal for many rows does not keep those rows together.
    """
    cuts = _bounds(df, order, slices)
    types = {f.name: f.dataType for f in df.select(*order).schema.fields}
    placed = df.withColumn("_v", value).withColumn("_slice", _position(cuts, order, types))
    sums = placed.groupBy("_slice").agg(F.sum("_v").alias("_s"))
    before = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_slice", F.coalesce(F.sum("_s").over(before), F.lit(0)).alias("_off"))
    inside = Window.partitionBy("_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumn("_local", F.sum("_v").over(inside))
        .join(F.broadcast(offsets), "_slice")  # one row per slice
        .withColumn(out, F.col("_off") + F.col("_local"))
        .drop("_slice", "_local", "_off", "_v")
    )


def _bounds(df: DataFrame, order: list[str], slices: int | None) -> list[Row]:
    """Sorted sampled bounds; none when the table is small enough for one slice."""
    wanted = slices or max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    n = df.select(*order).count()
    if slices is None:
        wanted = min(wanted, n // SLICE_ROWS + 1)
    if wanted == 1 or n == 0:
        return []
    share = min(1.0, SAMPLES_PER_SLICE * wanted / n)
    sample = df.select(*order)
    if share < 1.0:
        sample = sample.sample(share, seed=7)
    rows = sample.orderBy(*order).collect()  # about SAMPLES_PER_SLICE rows per slice
    step = max(1, len(rows) // wanted)
    return rows[step::step][: wanted - 1]


def _position(cuts: list[Row], order: list[str], types: dict) -> Column:
    """Number of bounds at or before the row, by binary search over the literal bounds."""
    if not cuts:
        return F.lit(0)
    bounds = F.array(*[F.struct(*[_literal(c[o]).cast(types[o]).alias(o) for o in order]) for c in cuts])
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(cuts).bit_length()))])

    def search(key: Column) -> Column:
        def move(at: Column, by: Column) -> Column:
            return F.when(F.get(bounds, at + by - 1) <= key, at + by).otherwise(at)

        return F.aggregate(steps, F.lit(0), move)

    # Never null, so that no null check on it is pushed below and computed a second time.
    return F.coalesce(let(F.struct(*order), search), F.lit(0))


def _literal(value) -> Column:
    """A literal of a scalar or of a struct of scalars."""
    if isinstance(value, Row):
        return F.struct(*[_literal(v).alias(k) for k, v in value.asDict().items()])
    return F.lit(value)


def split_batches(
    df: DataFrame, order: list[str], batch_size: int = 5000, prefix: str = "batch_"
) -> DataFrame:
    """Add ``batch_file`` (``batch_0000.parquet`` ...) and ``row_index`` inside the batch."""
    if batch_size < 1:
        raise ValueError("batch_size must be at least 1")
    no = F.col("_no") - 1
    return (
        number_rows(df, order, "_no")
        .withColumn("_b", F.floor(no / batch_size).cast("int"))
        .withColumn("row_index", (no % batch_size).cast("int"))
        .withColumn("batch_file", F.format_string(prefix + "%04d.parquet", F.col("_b")))
        .drop("_no", "_b")
    )


def number_clusters(reps: DataFrame, group: list[str], order: str, out: str = "cluster_id") -> DataFrame:
    """Number kept rows over all groups: groups by their first row, rows in order inside."""
    firsts = reps.groupBy(*group).agg(F.min(order).alias("_g0"))
    return number_rows(reps.join(firsts, group), ["_g0", order], out).drop("_g0")


def choose_representative(df: DataFrame, key: str, order: list[str], prefer: Column) -> DataFrame:
    """One row per key: the first preferred row, else the first; placed at the key's first row.

    Rows with a null key pass through. Only the winning position is aggregated; the wide
    row is fetched by a semi join on it.
    """
    at = F.struct(*order)
    best = F.struct(F.when(prefer, 0).otherwise(1).alias("p"), at.alias("at"))
    ranked = df.withColumn("_at", at)
    wins = (
        ranked.where(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("_k"))
        .agg(F.min(best)["at"].alias("_win"), F.min(at).alias("output_at"))
    )
    chosen = ranked.join(wins, (F.col(key) == F.col("_k")) & (F.col("_at") == F.col("_win")))
    loose = ranked.where(F.col(key).isNull()).withColumn("output_at", F.col("_at"))
    keep = [c for c in df.columns] + ["output_at"]
    return chosen.select(*keep).unionByName(loose.select(*keep))
