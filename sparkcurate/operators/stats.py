"""Histograms, divergence, summaries and twin reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.columns import is_finite, strip_chirality

# Bins, floor of empty bins, atom-count bands and peaks, similarity cuts.
BINS = 50
EMPTY_BIN = 1e-12
SIZE_BANDS = [(12, 40), (41, 65), (66, 92)]
SIZE_PEAKS = [(25, 35), (45, 55), (65, 75)]
TPSA_CUT = 140
SIMILAR = 0.85


def bin_number(x: Column, lo: float, hi: float, bins: int = BINS) -> Column:
    """Bin 0..bins-1 of equal bins on [lo, hi], the last one closed; null outside.

    The quotient gives a first guess and the edges themselves decide, so a value that lies
    on an edge falls to its right.
    """
    width = (hi - lo) / bins
    edge = lambda k: F.lit(lo) + k * F.lit(width)
    guess = F.floor((x - F.lit(lo)) / F.lit(width)).cast("int")
    fixed = F.when(x < edge(guess), guess - 1).when(x >= edge(guess + 1), guess + 1).otherwise(guess)
    return F.when((x >= lo) & (x <= hi), F.greatest(F.least(fixed, F.lit(bins - 1)), F.lit(0)))


def histogram(
    df: DataFrame, x: Column, bins: int = BINS, lo: float | None = None, hi: float | None = None,
    keep: Column | None = None,
) -> DataFrame:
    """``bin, left, right, n`` for every bin, empty ones included."""
    vals = df.select(x.cast("double").alias("x")) if keep is None else df.where(keep).select(x.cast("double").alias("x"))
    vals = vals.where(is_finite(F.col("x")))
    if lo is None or hi is None:
        a, b = vals.agg(F.min("x"), F.max("x")).first()
        if a is None:
            return df.sparkSession.createDataFrame([], "bin int, left double, right double, n long")
        lo = a if lo is None else lo
        hi = b if hi is None else hi
    if hi <= lo:
        lo, hi = lo - 0.5, lo + 0.5
    width = (hi - lo) / bins
    counts = vals.groupBy(bin_number(F.col("x"), lo, hi, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return every.join(F.broadcast(counts.where("bin is not null")), "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * width).alias("left"),
        (F.lit(lo) + (F.col("bin") + 1) * width).alias("right"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def js_divergence(df: DataFrame, props: dict[str, Column], selected: Column, bins: int = BINS) -> DataFrame:
    """Jensen-Shannon divergence (base 2) of pool against selection for every property.

    Two passes over the data for all properties together: the ranges, then the counts of
    one exploded (property, bin) table. NaN without values, 0 without spread.
    """
    names = list(props)
    x = {p: F.when(is_finite(c.cast("double")), c.cast("double")) for p, c in props.items()}
    sel = F.coalesce(selected, F.lit(False))
    ranges = df.agg(
        *[f(x[p]).alias(f"{k}_{i}") for i, p in enumerate(names) for k, f in (("lo", F.min), ("hi", F.max))],
        *[F.count(F.when(sel, x[p])).alias(f"n_{i}") for i, p in enumerate(names)],
    ).first()
    entries, plain = [], {}
    for i, p in enumerate(names):
        lo, hi, n = ranges[f"lo_{i}"], ranges[f"hi_{i}"], ranges[f"n_{i}"]
        if lo is None or n == 0:
            plain[p] = float("nan")
        elif hi <= lo:
            plain[p] = 0.0
        else:
            entries.append(F.struct(F.lit(p).alias("property"), bin_number(x[p], lo, hi, bins).alias("bin")))
    spark = df.sparkSession
    fixed = spark.createDataFrame(list(plain.items()), "property string, js_divergence double")
    if not entries:
        return fixed
    counts = (
        df.select(F.explode(F.array(*entries)).alias("e"), sel.cast("long").alias("s"))
        .where("e.bin is not null")
        .groupBy("e.property", "e.bin")
        .agg(F.count(F.lit(1)).alias("a"), F.sum("s").alias("b"))
    )
    totals = counts.groupBy("property").agg(F.sum("a").alias("ta"), F.sum("b").alias("tb"))
    p = F.greatest(F.col("a") / F.col("ta"), F.lit(EMPTY_BIN))
    q = F.when(F.col("b") > 0, F.col("b") / F.col("tb")).otherwise(F.lit(EMPTY_BIN))
    m = (p + q) / 2
    term = p * F.log2(p / m) + q * F.log2(q / m)
    # A bin empty on both sides contributes log2(1) = 0, so absent bins may be left out.
    js = counts.join(F.broadcast(totals), "property").groupBy("property").agg(
        (F.sum(term) / 2).alias("js_divergence")
    )
    return js.unionByName(fixed) if plain else js


def summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """``property, mean, median, min, max`` per numeric column."""
    from .outlier import exact_median

    parts = df.agg(
        *[f(F.col(c).cast("double")).alias(f"{k}_{i}") for i, c in enumerate(columns)
          for k, f in (("mean", F.avg), ("min", F.min), ("max", F.max), ("n", F.count))]
    ).first()
    rows = [
        (c, parts[f"mean_{i}"], exact_median(df, F.col(c), parts[f"n_{i}"]), parts[f"min_{i}"], parts[f"max_{i}"])
        for i, c in enumerate(columns)
    ]
    return df.sparkSession.createDataFrame(
        rows, "property string, mean double, median double, min double, max double"
    )


def share(cond: Column) -> Column:
    return F.avg(F.when(cond, 100.0).otherwise(0.0))


def band_shares(df: DataFrame, size: str, bands: list[tuple[int, int]] = SIZE_BANDS + SIZE_PEAKS) -> DataFrame:
    """Rows and percent in each inclusive size band."""
    entries = F.array(*[
        F.struct(F.lit(f"{lo}-{hi}").alias("band"), F.col(size).between(lo, hi).cast("long").alias("hit"))
        for lo, hi in bands
    ])
    return (
        df.select(F.explode(entries).alias("e")).groupBy("e.band")
        .agg(F.sum("e.hit").alias("n"), (F.avg("e.hit") * 100.0).alias("percent"))
    )


def similarity_summary(df: DataFrame, sim: str = "max_tanimoto") -> DataFrame:
    """Mean, median, maximum, and the counts equal to 1 and above the similarity cut."""
    from .outlier import exact_median

    s = F.col(sim)
    return df.agg(
        F.avg(s).alias("mean"), F.lit(exact_median(df, s)).cast("double").alias("median"), F.max(s).alias("max"),
        F.sum((s == 1.0).cast("long")).alias("n_identical"),
        F.sum((s > SIMILAR).cast("long")).alias("n_similar"),
    )


def polar_share(df: DataFrame, tpsa: str = "tpsa", cut: float = TPSA_CUT) -> DataFrame:
    """Percent of the rows with a polar surface that lies below the cut."""
    known = df.where(F.col(tpsa).isNotNull())
    return known.agg(F.count(F.lit(1)).alias("n"), share(F.col(tpsa) < cut).alias("percent"))


def perfect_twins(df: DataFrame, identity: str, smiles: str, sim: str = "max_tanimoto", limit: int | None = None) -> DataFrame:
    """Twin groups among rows with a similarity of 1, each identity once.

    ``limit`` keeps the first groups by skeleton, as a report shows them.
    """
    once = df.where(F.col(sim) == 1.0).groupBy(identity).agg(F.min(smiles).alias(smiles))
    groups = twin_groups(once, F.col(smiles), F.col(identity))
    return groups if limit is None else groups.orderBy("skeleton").limit(limit)


def twin_groups(df: DataFrame, smiles: Column, identity: Column, stripped: Column | None = None) -> DataFrame:
    """Rows with a perfect match grouped by their marker-free skeleton.

    ``stereo`` groups hold different identities, ``identical`` ones a single identity more
    than once, ``singleton`` one row.
    """
    skeleton = strip_chirality(smiles) if stripped is None else stripped
    per = df.select(skeleton.alias("skeleton"), identity.alias("i")).groupBy("skeleton", "i").agg(
        F.count(F.lit(1)).alias("n")
    )
    return per.groupBy("skeleton").agg(F.sum("n").alias("n_rows"), F.count(F.lit(1)).alias("n_ids")).withColumn(
        "kind",
        F.when(F.col("n_rows") == 1, "singleton").when(F.col("n_ids") > 1, "stereo").otherwise("identical"),
    )
