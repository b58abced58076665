"""Budgeted selection of a diverse, coverage-balanced subset of descriptor rows.

Input rows carry ``CompoundID, smiles, mol_block, morgan_fp ARRAY<INT>``,
``atom_envs ARRAY<ARRAY<BIGINT>>``, ``heavy_elements ARRAY<STRING>``, ``scaffold``,
``bonds ARRAY<STRING>`` and properties. Passes: floor (rare environments), diversity
(MaxMin in scaffold families, then over the rest), depth (thin environments).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..chem import backend
from ..functions import columns as C, elements, molblock
from ..functions.columns import let
from ..functions.elements import weight_sum
from ..functions.geometry import tanimoto_distance
from ..operators import coverage, gates, stats
from ..operators.cover import greedy_cover, lazy_rounds
from ..operators.greedy import START, Rule, pick_rounds
from ..operators.maxmin import assign_nearest, farthest_first
from ..operators.ordering import keep_first, number_rows, running_total
from ..registry import DESCRIPTORS
from ..session import BROADCAST_ROWS, checkpointed, fits_broadcast, lookup_join, stored

# Name of the family without a scaffold, the pass names, the cosine guard.
ACYCLIC = "__acyclic__"
PASSES = ("floor", "diversity", "depth")
COSINE_GUARD = 1e-12
PICKS = "row bigint, number int, score double"


@dataclass(frozen=True)
class Budget:
    n: int = 10_000
    passes: tuple[str, ...] = PASSES
    floor_budget: float = 0.15
    floor_k: int | None = None
    w: float = 0.4
    depth_budget: float = 0.10
    target_mult: int = 2
    depth_nn_sim: float = 0.6
    tier1_min: int = 50
    ff: float = 0.30
    # Gains count environments instead of their instances.
    distinct: bool = False
    # Families share the tier's budget exactly instead of one pick each at least.
    capped: bool = False

    def __post_init__(self) -> None:
        for p in self.passes:
            if p not in PASSES:
                raise ValueError(f"unknown pass {p!r}")

    @property
    def n_floor(self) -> int:
        return round(self.floor_budget * self.n)

    @property
    def n_depth(self) -> int:
        return round(self.depth_budget * self.n)


def instances(atom_envs: str = "atom_envs", elements: str = "heavy_elements") -> Column:
    """ARRAY<STRUCT<env, element>> of all environment instances of a record."""
    return F.flatten(
        F.zip_with(
            atom_envs, elements,
            lambda sub, el: F.transform(sub, lambda e: F.struct(e.cast("bigint").alias("env"), el.alias("element"))),
        )
    )


def rank_envs(freq: DataFrame, k: int | None = None) -> DataFrame:
    """Environments numbered from the rarest, stored: ``env_id, rank, n_mols``."""
    # Without the elements, whose aggregate would sort all rows; numbering reads the table several times.
    freq = freq.select("env_id", "n_atoms", "n_mols")
    chosen = stored(freq if k is None else coverage.rarest(freq, k))
    return stored(number_rows(chosen, coverage.rarity_order(), "rank").select("env_id", "rank", "n_mols"))


def env_counts(envs: str = "envs") -> Column:
    """ARRAY<STRUCT<env_id, n>> of a record: its distinct environments with their instances, counted inside the record."""

    def runs(v: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(0), F.size(v) - 1), lambda i: (i == 0) | (F.get(v, i) != F.get(v, i - 1)))
        return let(starts, lambda at: F.transform(at, lambda i, k: F.struct(
            F.get(v, i).alias("env_id"), (F.coalesce(F.get(at, k + 1), F.size(v)) - i).cast("int").alias("n"))))

    none = F.expr("cast(array() as array<struct<env_id:bigint,n:int>>)")
    return let(F.sort_array(F.transform(envs, lambda e: e["env"])), lambda v: F.when(F.size(v) > 0, runs(v)).otherwise(none))


def env_pool(rows: DataFrame, ranked: DataFrame, carried: DataFrame | None = None, envs: coverage.Envs = "envs") -> DataFrame:
    """Greedy pool, stored: one row ``row, rank, n, b`` per record and environment of it.

    ``n`` instances, ``b`` picked rows that already carry the environment (``carried``: env_id, mult). Payloads stay
    in ``rows``. Ranks rise with the number of carriers, so the last ones have most of the pairs: they
    are broadcast, and only the pairs of the others are shuffled for their ranks.
    """
    inst = coverage.counted(rows, envs, "row")
    none = F.lit(0).cast("bigint")
    tab = ranked.select("env_id", "rank")
    tab = tab.withColumn("b", none) if carried is None else lookup_join(
        tab, carried.select("env_id", F.col("mult").alias("b")), "env_id", "left").withColumn("b", F.coalesce("b", none))
    if fits_broadcast(tab):
        return stored(inst.join(F.broadcast(tab), "env_id").select("row", "rank", "n", "b"))
    last = ranked.agg(F.max("rank")).first()[0] - BROADCAST_ROWS
    told = stored(inst.join(F.broadcast(tab.where(F.col("rank") > last)), "env_id", "left").select(
        "row", F.when(F.col("rank").isNull(), F.col("env_id")).alias("env_id"), "n", "rank", "b"))
    rest = told.where("rank is null").select("row", "env_id", "n").join(tab.where(F.col("rank") <= last), "env_id")
    return told.where("rank is not null").select("row", "rank", "n", "b").unionByName(stored(rest.select("row", "rank", "n", "b")))


def env_pairs(pool: DataFrame, target: int = 1, distinct: bool = False) -> DataFrame:
    """Of the pool: ``row, rank, n, b`` of environments carried by fewer than ``target`` picks."""
    n = F.lit(1).cast("bigint") if distinct else F.col("n")
    return pool.where(F.col("b") < target).select("row", "rank", n.alias("n"), "b")


def forced_rows(pairs: DataFrame, n_forced_envs: int) -> DataFrame:
    """(row, number) of the carriers of single-carrier environments, in order of rarity.

    These environments come first in rarity, so a record is forced exactly when its smallest rank is
    among them, and records are forced in the order of that rank.
    """
    first = pairs.where(F.col("rank") <= n_forced_envs).groupBy("row").agg(F.min("rank").alias("_first"))
    return stored(number_rows(stored(first), ["_first"], "number").select("row", "number"))


def by_record(pairs: DataFrame, some: DataFrame, how: str) -> DataFrame:
    """Pairs joined to a few columns of some records. No record has many pairs, so a plain shuffle is even; the side of
    the records is hashed, and the pairs are not sorted."""
    return pairs.join(F.broadcast(some) if fits_broadcast(some) else some.hint("shuffle_hash"), "row", how)


def floor_pass(
    rows: DataFrame, pool: DataFrame, n_forced_envs: int, budget: int | None, w: float, distinct: bool = False
) -> DataFrame:
    """Forced carriers of single-carrier environments, then weighted greedy picks: ``row, number, score``.

    ``rows`` have row and payload, ``pool`` their environments (see ``env_pool``).
    """
    pairs = env_pairs(pool, distinct=distinct)
    forced = forced_rows(pairs, n_forced_envs)
    if budget is not None:
        forced = forced.where(F.col("number") <= budget)
    n_forced = forced.count()
    log = forced.select("row", F.col("number").cast("int").alias("number"), F.lit(None).cast("double").alias("score"))
    left = (2**31 - 1 if budget is None else budget) - n_forced
    if left <= 0:
        return log
    if n_forced:
        covered = by_record(pairs, forced.select("row"), "left_semi").select("rank").distinct()
        pairs = stored(pairs.join(covered, "rank", "left_anti"))
    group = F.lit(0).cast("bigint").alias("grp")
    free = rows.select(group, "row", "payload").join(forced.select("row"), "row", "left_anti").select("grp", "row", "payload")
    picks = lookup_join(rows.select("row", "payload"), forced, "row", "inner").select(group, "row", "number", "payload")
    near = assign_nearest(free, picks, tanimoto_distance())
    free = stored(near.select("row", "payload", F.least("d", F.lit(1.0)).alias("d")))
    chosen = lazy_rounds(free, pairs, Rule("floor", tanimoto_distance(), w=w), left, first_number=n_forced + 1)
    return log.unionByName(chosen)


def set_cover_curve(pool: DataFrame, n_forced_envs: int) -> DataFrame:
    """``molecules, covered``: environments covered after each pick of the pure greedy cover.

    The forced part is a running sum over the first record that covers each environment;
    the rest is decided by rounds of picks that share no environment.
    """
    pairs = env_pairs(pool)
    forced = forced_rows(pairs, n_forced_envs)
    # The first forced record of each environment, null where only other records carry it.
    each = stored(by_record(pairs.select("row", "rank"), forced, "left").groupBy("rank").agg(F.min("number").alias("number")))
    covers = each.where("number is not null")
    new = stored(forced.select("number").join(
        covers.groupBy("number").agg(F.count(F.lit(1)).alias("new")), "number", "left"
    ).withColumn("new", F.coalesce("new", F.lit(0))))
    head = running_total(new, ["number"], F.col("new"), "covered").select(F.col("number").alias("molecules"), "covered")
    n_forced, n_covered = forced.count(), covers.count()
    # Their carriers are not forced, and these have few pairs.
    others = stored(by_record(pairs.select("row", "rank", "n"), forced.select("row"), "left_anti"))
    chosen = greedy_cover(lookup_join(others, each.where("number is null").select("rank"), "rank", "inner"))
    order = stored(number_rows(stored(chosen.withColumn("fall", -F.col("gain"))), ["fall", "row"], "number"))
    tail = running_total(order.select("number", "closed"), ["number"], F.col("closed"), "c")
    return head.unionByName(tail.select((F.col("number") + n_forced).alias("molecules"), (F.col("c") + n_covered).alias("covered")))


def centroid_seeds(rows: DataFrame, group: list[str]) -> DataFrame:
    """``row`` of the record closest (cosine) to its group's mean fingerprint; first on ties."""
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("m"))
    bits = rows.select(*group, "row", F.explode("payload").alias("bit"))
    mean = bits.groupBy(*group, "bit").agg(F.count(F.lit(1)).alias("c"))
    mean = lookup_join(mean, sizes, group, "inner").withColumn("v", F.col("c") / F.col("m"))
    norm = mean.groupBy(*group).agg(F.sqrt(F.sum(F.col("v") * F.col("v"))).alias("norm"))
    dots = lookup_join(bits, mean.select(*group, "bit", "v"), [*group, "bit"], "inner").groupBy(*group, "row").agg(
        F.sum("v").alias("dot")
    )
    full = rows.select(*group, "row", F.size("payload").alias("s")).join(dots, [*group, "row"], "left")
    # Dots are rounded far below their spacing, so the order of summation cannot break ties.
    cos = F.round(
        F.coalesce("dot", F.lit(0.0)) / (F.sqrt("s") * F.coalesce("norm", F.lit(0.0)) + COSINE_GUARD), 12
    )
    ranked = lookup_join(full, norm, group, "left").withColumn("cos", cos)
    return ranked.groupBy(*group).agg(F.min(F.struct(-F.col("cos"), "row"))["row"].alias("row"))


def maxmin_pass(rows: DataFrame, k: int) -> DataFrame:
    """Centroid seed, then MaxMin picks over the whole pool. Score: similarity when picked."""
    rows = checkpointed(rows.withColumn("_g", F.lit(0)))
    seed = centroid_seeds(rows, ["_g"]).first()["row"]
    m = rows.count()
    if k >= m:
        first = F.when(F.col("row") == seed, 0).otherwise(1)
        order = rows.select("row").withColumn("_f", first)
        return number_rows(order, ["_f", "row"], "number").select(
            "row", F.col("number").cast("int").alias("number"), F.lit(None).cast("double").alias("score")
        )
    pool = rows.select(
        F.lit(0).cast("bigint").alias("grp"), "row", "payload",
        F.when(F.col("row") == seed, F.lit(START * 10)).otherwise(F.lit(START)).alias("d"),
        F.lit(-1).cast("bigint").alias("near"),
    )
    log, _, _ = pick_rounds(pool, Rule("farthest", tanimoto_distance()), k)
    return log.select("row", "number", F.when(F.col("row") != seed, 1.0 - F.col("d")).alias("score"))


def family_budgets(
    rows: DataFrame, budget: int, tier1_min: int, ff: float, family: str = "family", capped: bool = False
) -> DataFrame:
    """Families larger than ``tier1_min`` and their picks, in proportion to the root of size.

    Each family gets at least one and at most all of its rows, so many small shares can
    add up to more than ``floor(ff * budget)``. With ``capped`` they never do: each family gets the whole
    part of its share, and the picks left over go to the largest remainders, the first family on ties.
    """
    big = rows.groupBy(family).agg(F.count(F.lit(1)).alias("m")).where(F.col("m") > tier1_min)
    k1 = math.floor(ff * budget)
    total = big.agg(F.sum(F.sqrt("m")).alias("t"))
    exact = F.lit(float(k1)) * F.sqrt("m") / total.scalar()
    if capped:
        # Rounded, so that equal families have equal remainders.
        part = stored(big.withColumn("_x", F.round(exact, 9)).withColumn("_k", F.floor("_x")).withColumn("_rest", F.col("_k") - F.col("_x")))
        over = k1 - (part.agg(F.sum("_k")).first()[0] or 0)
        k = F.col("_k") + F.when(F.col("_no") <= over, 1).otherwise(0)
        return number_rows(part, ["_rest", family], "_no").withColumn("k", F.least(k, F.col("m")).cast("int")).drop("_x", "_k", "_rest", "_no")
    share = F.greatest(F.lit(1), F.rint(exact).cast("int"))
    return big.withColumn("k", F.least(share, F.col("m").cast("int")))


def diversity_pass(rows: DataFrame, budget: int, tier1_min: int, ff: float, capped: bool = False) -> DataFrame:
    """Picks of both tiers: ``row, number, score, tier``."""
    spark = rows.sparkSession
    empty = spark.createDataFrame([], PICKS + ", tier string")
    if budget <= 0 or rows.isEmpty():
        return empty
    fam = checkpointed(family_budgets(rows, budget, tier1_min, ff, capped=capped).where("k > 0"))
    tier1 = lookup_join(rows, fam, "family", "inner")
    seeds = centroid_seeds(tier1.select("family", "row", "payload"), ["family"]).select("row", F.lit(True).alias("seed"))
    tier1 = checkpointed(tier1.join(seeds, "row", "left").withColumn("seed", F.coalesce("seed", F.lit(False))))
    part = tier1.where("k < m")
    got = farthest_first(part, ["family"], "row", "payload", tanimoto_distance(), budget=F.col("k"), seed=F.col("seed"))
    a = part.select("family", "row", "seed").join(got.where("number is not null"), "row").select(
        "family", "row", F.col("number").cast("bigint").alias("o"), F.when(~F.col("seed"), 1.0 - F.col("d")).alias("score")
    )
    b = tier1.where("k >= m").select(
        "family", "row", F.when(F.col("seed"), F.lit(-1).cast("bigint")).otherwise(F.col("row")).alias("o"),
        F.lit(None).cast("double").alias("score"),
    )
    first = checkpointed(number_rows(a.unionByName(b), ["family", "o"], "number"))
    n1 = first.count()
    out = first.select("row", F.col("number").cast("int").alias("number"), "score", F.lit("tier1").alias("tier"))
    rest = lookup_join(rows, fam.select("family", F.lit(1).alias("_t")), "family", "left").where("_t is null")
    k2 = max(0, budget - n1)
    if k2 > 0 and not rest.isEmpty():
        second = maxmin_pass(rest.select("row", "payload"), k2)
        out = out.unionByName(second.select("row", (F.col("number") + n1).cast("int").alias("number"), "score",
                                            F.lit("tier2").alias("tier")))
    return out


def depth_pass(rows: DataFrame, selected: DataFrame, ranked: DataFrame, b: Budget, envs: coverage.Envs = "envs") -> DataFrame:
    """Picks that deepen thin environments, away from what is already selected."""
    spark = rows.sparkSession
    if b.n_depth <= 0:
        return spark.createDataFrame([], PICKS)
    marked = lookup_join(rows, selected.select("row", F.lit(1).alias("_s")), "row", "left")
    chosen = marked.where("_s = 1")
    others = marked.where("_s is null").drop("_s")
    carried = coverage.counted(chosen, envs, "row").groupBy("env_id").agg(F.count(F.lit(1)).alias("mult"))
    pairs = env_pairs(env_pool(others, ranked, stored(carried), envs), b.target_mult, b.distinct)
    picks = lookup_join(chosen.select("row", "payload"), selected.select("row", "number"), "row", "inner").select(
        F.lit(0).cast("bigint").alias("grp"), "row", "number", "payload"
    )
    near = assign_nearest(others.select(F.lit(0).cast("bigint").alias("grp"), "row", "payload"), picks, tanimoto_distance())
    free = stored(near.select("row", "payload", F.least("d", F.lit(1.0)).alias("d")))
    rule = Rule("depth", tanimoto_distance(), cut=b.depth_nn_sim, target=b.target_mult)
    return lazy_rounds(free, pairs, rule, b.n_depth)


def describe(
    rows: DataFrame, order: list[str], allowed: list[str] | None = None, min_atoms: int | None = None, max_atoms: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """(descriptor rows in scope, counts of the rows left out per cause).

    The first row of each CompoundID is described. Fingerprint, environments, scaffold and
    polar surface come from columns of those names when present, else from the toolkit;
    formula, weight, elements and bonds come from the connection table.
    """
    text = F.coalesce("CanonicalSMILES", "SMILES")
    made = {
        "morgan_fp": backend.fingerprint, "atom_envs": backend.atom_environments, "scaffold": backend.scaffold,
        "tpsa": lambda c: backend.number(c, "TPSA"),
    }
    first = keep_first(rows, "CompoundID", order, "_first").where("_first = 'kept'").drop("_first")
    df = first.withColumn("smiles", text).withColumns({
        "_s": molblock.symbols("mol_block"), "_b": molblock.bonds("mol_block"),
    })
    df = df.withColumns({k: fn(F.col("smiles")) for k, fn in made.items() if k not in rows.columns})
    df = df.withColumns({
        "formula": C.hill_formula("_s"), "heavy_elements": F.filter("_s", lambda s: s != "H"),
        "molwt": weight_sum("_s"), "energy_ha": C.as_float("Energy_Ha"), "bonds": molblock.bond_types(F.col("_s"), F.col("_b")),
    }).withColumn("nat_heavy", F.size("heavy_elements"))
    parsed = df.where(F.col("_s").isNotNull() & F.col("morgan_fp").isNotNull() & F.col("atom_envs").isNotNull())
    known = set(elements.SYMBOLS)
    if allowed is not None and not set(allowed) <= known:
        raise ValueError(f"unknown element symbols: {sorted(set(allowed) - known)}")
    labelled = gates.scope_labels(parsed, F.array_distinct("heavy_elements"), "nat_heavy", allowed, min_atoms, max_atoms)
    out = labelled.where("scope = 'in'")
    return out.select(*DESCRIPTORS, *[c for c in order if c not in DESCRIPTORS]), gates.scope_counts(labelled)


def skipped_rows(rows: DataFrame, described: Column, symbols: Column, keep: list[str]) -> DataFrame:
    """Rows that could not be described: the columns ``keep``, their elements and the rare ones among them."""
    return rows.where(~F.coalesce(described, F.lit(False))).select(
        *keep, F.array_sort(F.array_distinct(symbols)).alias("elements"), elements.rare_elements(symbols).alias("rare"))


def prepare(descriptors: DataFrame, order: list[str], fp: str = "morgan_fp") -> DataFrame:
    """Number the rows and unfold their environments.

    Descriptors that have a ``row`` already are numbered by it. The table on disk holds the descriptors once; what
    repeats them (``payload``, ``envs``, ``family``) is derived whenever it is read. Descriptors without ``atom_envs``
    get no ``envs``: their environments are read from a text (``coverage.Read``).
    """
    df = descriptors
    if "row" not in df.columns:
        df = number_rows(stored(df), order, "_no").withColumn("row", F.col("_no") - 1).drop("_no")
    out = stored(df).withColumn("payload", F.col(fp))
    out = out.withColumn("envs", instances()) if "atom_envs" in df.columns else out
    return out.withColumn("family", F.coalesce(F.when(F.col("scaffold") != "NaN", F.col("scaffold")), F.lit(ACYCLIC)))


def select(rows: DataFrame, budget: Budget, envs: coverage.Envs = "envs") -> DataFrame:
    """Picks of all enabled passes: ``row, pass, tier, score, selection_order``."""
    spark = rows.sparkSession
    freq = coverage.env_frequency(rows, envs, "row")
    ranked = rank_envs(freq)
    out = spark.createDataFrame([], "row bigint, pass string, tier string, score double, selection_order int")
    from_ = coverage.column(envs)
    slim = rows.select("row", "payload", from_, "family")

    def add(picks: DataFrame, name: str, tier: Column) -> None:
        nonlocal out, count
        part = picks.select("row", F.lit(name).alias("pass"), tier.alias("tier"), "score",
                            (F.col("number") + count).cast("int").alias("selection_order"))
        out = checkpointed(out.unionByName(part))
        count = out.count()

    count = 0
    if "floor" in budget.passes:
        target = ranked if budget.floor_k is None else ranked.where(F.col("rank") <= budget.floor_k)
        limit = budget.n_floor if budget.floor_k is None else None
        forced = target.where("n_mols = 1").count()
        add(floor_pass(slim, env_pool(slim, target, envs=envs), forced, limit, budget.w, budget.distinct), "floor", F.lit(""))
    if "diversity" in budget.passes:
        left = max(0, budget.n - count - budget.n_depth)
        free = lookup_join(slim, out.select("row", F.lit(1).alias("_s")), "row", "left").where("_s is null").drop("_s", from_)
        add(diversity_pass(free, left, budget.tier1_min, budget.ff, budget.capped), "diversity", F.col("tier"))
    if "depth" in budget.passes:
        picked = out.select("row", F.col("selection_order").alias("number"))
        # Numbers continue from the passes before.
        add(depth_pass(slim, picked, ranked, budget, envs), "depth", F.lit(""))
    return out


def assemble(rows: DataFrame, picks: DataFrame) -> DataFrame:
    return lookup_join(rows, picks, "row", "inner").select(
        "CompoundID", "smiles", "mol_block", "pass", "tier", "score", "selection_order"
    )


def reports(
    rows: DataFrame, picks: DataFrame, props: tuple[str, ...] = ("molwt", "tpsa", "energy_ha"), envs: coverage.Envs = "envs",
    bonds: coverage.Envs = "bonds",
) -> dict[str, DataFrame]:
    """Coverage, thin coverage, bond coverage and property divergence of a selection."""
    marked = lookup_join(rows, picks.select("row", F.lit(True).alias("_s")), "row", "left")
    sel = F.coalesce("_s", F.lit(False))
    return {
        "coverage": coverage.coverage_report(marked, sel, envs),
        "thin_coverage": coverage.thin_coverage(marked, sel, envs, "CompoundID", "row"),
        "bond_types": coverage.pair_coverage(marked, sel, bonds),
        "property_js": stats.js_divergence(marked, {p: F.col(p) for p in props}, sel),
    }


def summary(picks: DataFrame, budget: Budget) -> dict:
    per = {r["pass"]: r["n"] for r in picks.groupBy("pass").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {
        "n_requested": budget.n, "n_selected": sum(per.values()),
        **{f"n_{p}": per.get(p, 0) for p in PASSES},
        "passes": sorted(budget.passes),
        "floor_budget": None if budget.floor_k is not None else budget.n_floor,
        "floor_k": budget.floor_k, "w": budget.w, "depth_budget": budget.n_depth,
        "target_mult": budget.target_mult, "tier1_min": budget.tier1_min, "ff": budget.ff,
    }
