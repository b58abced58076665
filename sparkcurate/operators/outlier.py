"""Robust regression outliers: a no-intercept fit from sums, and exact medians."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from ..session import checkpointed

# Scale of the robust z-score, the zero-spread guard, the default cut.
Z_SCALE = 0.6745
ZERO_MAD = 1e-12
Z_CUT = 3.5

# Bands up to this many rows are sorted and picked from directly.
SMALL_BAND = 100_000


@dataclass(frozen=True)
class Fit:
    features: tuple[str, ...]
    beta: tuple[float, ...]
    median: float
    mad: float
    n: int

    def predicted(self) -> Column:
        return sum((F.col(f) * F.lit(b) for f, b in zip(self.features, self.beta)), F.lit(0.0))

    def z(self, y: str) -> Column:
        if self.n == 0 or self.mad < ZERO_MAD:
            return F.lit(0.0)
        return F.lit(Z_SCALE) * (F.col(y) - self.predicted() - F.lit(self.median)) / F.lit(self.mad)


def exact_median(df: DataFrame, value: Column, count: int | None = None) -> float | None:
    """The median without sorting the whole column in one task.

    Two approximate quantiles bracket the middle rank; only the values inside the bracket
    are counted and narrowed again, until the band is small or holds a single value.
    """
    vals = df.select(value.cast("double").alias("v")).where("v is not null and not isnan(v)")
    n = vals.count() if count is None else count
    if n == 0:
        return None
    ranks = [(n - 1) // 2, n // 2]
    lo, hi, below, size, spread = None, None, 0, n, 0.002
    while size > SMALL_BAND:
        band = vals if lo is None else vals.where(F.col("v").between(lo, hi))
        p = (ranks[0] - below + 0.5) / size
        probes = [max(0.0, p - spread), min(1.0, p + spread)]
        new_lo, new_hi = band.agg(F.percentile_approx("v", probes, 10_000)).first()[0]
        less, inside = vals.agg(
            F.sum((F.col("v") < new_lo).cast("long")),
            F.sum(F.col("v").between(new_lo, new_hi).cast("long")),
        ).first()
        if not (less <= ranks[0] and ranks[1] < less + inside):
            spread *= 4  # the bracket missed the middle: take a wider one
            continue
        if new_lo == new_hi:
            return float(new_lo)
        if inside >= size:
            return _counted_median(vals.where(F.col("v").between(new_lo, new_hi)), [r - less for r in ranks])
        lo, hi, below, size = new_lo, new_hi, less, inside
    band = vals if lo is None else vals.where(F.col("v").between(lo, hi))
    got = band.orderBy("v").offset(ranks[0] - below).limit(ranks[1] - ranks[0] + 1).collect()
    return float(sum(r["v"] for r in got) / len(got))


def _counted_median(band: DataFrame, ranks: list[int]) -> float:
    """The mean of the values at two ranks of a band that few values fill.

    Quantiles do not narrow such a band. Rows are counted per value (combined map-side) and the
    counts run up from the smallest value; only the two values reach the driver.
    """
    from .ordering import running_total

    counted = checkpointed(band.groupBy("v").agg(F.count(F.lit(1)).alias("c")))
    upto = running_total(counted, ["v"], F.col("c"), "upto")
    at = [upto.where(F.col("upto") > r).agg(F.min("v")).first()[0] for r in ranks]
    return float(sum(at) / 2)


def fit_no_intercept(df: DataFrame, features: list[str], y: str) -> Fit:
    """Minimum-norm least squares from the k x k sums, then median and MAD of the residuals.

    One pass sums the products (combined map-side); only k*(k+3)/2 numbers reach the driver.
    """
    k = len(features)
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    d = lambda c: F.col(c).cast("double")
    sums = df.agg(
        *[F.sum(d(features[i]) * d(features[j])).alias(f"x{i}_{j}") for i, j in pairs],
        *[F.sum(d(features[i]) * d(y)).alias(f"y{i}") for i in range(k)],
        F.count(F.lit(1)).alias("n"),
    ).first()
    n = sums["n"]
    if n == 0:
        return Fit(tuple(features), (0.0,) * k, 0.0, 0.0, 0)
    gram = np.zeros((k, k))
    for i, j in pairs:
        gram[i, j] = gram[j, i] = sums[f"x{i}_{j}"]
    beta = np.linalg.pinv(gram, rcond=1e-13, hermitian=True) @ np.array([sums[f"y{i}"] for i in range(k)])
    fit = Fit(tuple(features), tuple(map(float, beta)), 0.0, 0.0, n)
    residual = d(y) - fit.predicted()
    med = exact_median(df, residual, n)
    mad = exact_median(df, F.abs(residual - F.lit(med)), n)
    return Fit(fit.features, fit.beta, med, mad, n)


def label_outliers(
    df: DataFrame, features: list[str], y: str, corrupt: Column | None = None,
    threshold: float = Z_CUT, check_positive: bool = True, skip: bool = False,
    status: str = "energy_status", score: str | None = "robust_z",
) -> DataFrame:
    """Status per row: skipped, mol_corrupt, energy_missing, energy_positive, flagged_ols, ok.

    Corrupt, missing and (unless switched off) positive rows stay out of the fit.
    """
    if skip:
        return df.withColumn(status, F.lit("skipped"))
    bad = F.coalesce(corrupt, F.lit(False)) if corrupt is not None else F.lit(False)
    missing = F.col(y).isNull() | F.isnan(F.col(y).cast("double"))
    positive = (F.col(y) > 0) if check_positive else F.lit(False)
    usable = ~bad & ~missing & ~F.coalesce(positive, F.lit(False))
    # The fit reads its narrow input several times; the source is computed once.
    fit = fit_no_intercept(checkpointed(df.where(usable).select(*features, y)), features, y)
    if fit.n == 0 and df.limit(1).count():
        raise ValueError("no row is usable for the energy fit")
    z = F.when(usable, fit.z(y))
    out = df.withColumn("_z", z).withColumn(
        status,
        F.when(bad, "mol_corrupt")
        .when(missing, "energy_missing")
        .when(positive, "energy_positive")
        .when(F.abs("_z") > threshold, "flagged_ols")
        .otherwise("ok"),
    )
    return out.withColumnRenamed("_z", score) if score else out.drop("_z")
