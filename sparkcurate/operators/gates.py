"""Status gates: label every row, give a reason, keep or divert, and count.

A gate never drops a row by itself. :func:`divide` separates kept and rejected rows of a
labelled table, so reject accounting and the kept stream come from the same labels.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.columns import (
    INT_SYNTAX, col, int_value, is_finite, parses_as_float, parses_as_int, text_list,
)


@dataclass(frozen=True)
class Check:
    """``fails`` marks a failing row (null counts as passing); ``reason`` describes it."""

    fails: Column
    reason: Column
    status: str = "rejected"


def first_failing(
    df: DataFrame, checks: list[Check], status: str = "filter_status",
    reason: str = "filter_reason", ok: str = "ok",
) -> DataFrame:
    """Label by the first check that fails, in the given order."""
    verdict = F.lit(None).cast("struct<s:string,r:string>")
    hits = [
        F.when(c.fails, F.struct(F.lit(c.status).alias("s"), c.reason.cast("string").alias("r")))
        for c in checks
    ]
    first = F.coalesce(*hits, verdict) if hits else verdict
    return (
        df.withColumn("_v", first)
        .withColumn(status, F.coalesce(F.col("_v.s"), F.lit(ok)))
        .withColumn(reason, F.coalesce(F.col("_v.r"), F.lit("")))
        .drop("_v")
    )


def all_failing(checks: list[Check]) -> Column:
    """Array of the reasons of every failing check, in order."""
    if not checks:
        return text_list([])
    return F.array_compact(F.array(*[F.when(c.fails, c.reason.cast("string")) for c in checks]))


def divide(df: DataFrame, keep: Column, force_keep: bool = False) -> tuple[DataFrame, DataFrame]:
    """(kept, rejected). ``force_keep`` leaves rejected rows in the kept stream as well."""
    good = F.coalesce(keep, F.lit(False))
    return (df if force_keep else df.where(good)), df.where(~good)


def status_counts(df: DataFrame, *cols: str) -> DataFrame:
    """Counts per status (and reason), largest first."""
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), *cols)


def stop_on_rejects(rejects: DataFrame, what: str) -> None:
    """Fail-fast gate: a chain does not go on past a stage with rejects."""
    if not rejects.isEmpty():
        raise ValueError(f"{what}: rejected rows present")


# -- tag contract --------------------------------------------------------------

# Tags of the input contract and their types.
REQUIRED = {"Energy_Ha": "float", "FormalCharge": "int", "Multiplicity": "int"}
RECOMMENDED = {"SMILES": "str", "SourceID": "str"}
OPTIONAL = {"HOMO_Ha": "float", "LUMO_Ha": "float", "HL_Gap_Ha": "float", "PartialCharges": "str"}


def validate_tags(
    df: DataFrame,
    tags: str = "tags",
    required: dict[str, str] | None = None,
    recommended: dict[str, str] | None = None,
    optional: dict[str, str] | None = None,
    positive: tuple[str, ...] = ("Multiplicity",),
    lenient: bool = False,
    parsed: Column | None = None,
) -> DataFrame:
    """Add ``errors``, ``warnings`` (arrays) and ``contract_status`` (passed/rejected).

    A missing required tag is an error, or a warning when lenient; a missing other tag is
    a warning. A present value of the wrong type is always an error. Unlisted tags pass.
    """
    specs: dict[str, tuple[str, str]] = {}
    for level, group in (
        ("required", REQUIRED if required is None else required),
        ("recommended", RECOMMENDED if recommended is None else recommended),
        ("optional", OPTIONAL if optional is None else optional),
    ):
        for name, kind in group.items():
            specs.setdefault(name, (kind, level))
    errors, warns = [], []
    for name, (kind, level) in specs.items():
        value = F.element_at(F.col(tags), F.lit(name))
        absent = ~F.coalesce(F.map_contains_key(F.col(tags), F.lit(name)), F.lit(False))
        missing = Check(absent, F.lit(f"{name}: missing ({level})"))
        (errors if level == "required" and not lenient else warns).append(missing)
        quoted = F.concat(F.lit(f"{name}: '"), value, F.lit("' is not parseable as "))
        if name in positive:
            bad_int = ~absent & ~parses_as_int(value)
            errors.append(Check(bad_int, F.concat(quoted, F.lit("integer"))))
            errors.append(
                Check(
                    ~absent & parses_as_int(value) & ~_positive_int(value),
                    F.concat(F.lit(f"{name}: "), value, F.lit(" is not a positive integer")),
                )
            )
        elif kind == "int":
            errors.append(Check(~absent & ~parses_as_int(value), F.concat(quoted, F.lit("integer"))))
        elif kind == "float":
            errors.append(Check(~absent & ~parses_as_float(value), F.concat(quoted, F.lit("float"))))
    found, noted = all_failing(errors), all_failing(warns)
    if parsed is not None:
        found = F.when(parsed, found).otherwise(F.array(F.lit("could not parse molecule")))
        noted = F.when(parsed, noted).otherwise(text_list([]))
    return (
        df.withColumn("errors", found)
        .withColumn("warnings", noted)
        .withColumn("contract_status", F.when(F.size("errors") > 0, "rejected").otherwise("passed"))
    )


def _positive_int(value: Column) -> Column:
    """Sign and digits decide, so a number wider than 64 bits is still judged right."""
    digits = F.regexp_replace(F.trim(value), r"[+_]", "")
    return digits.rlike(r"^0*[1-9]\d*$") & value.rlike(INT_SYNTAX)


# -- composition and scalar filters --------------------------------------------

# Named presets of the charge and multiplicity ranges.
RANGE_PRESETS: dict[str, dict[str, tuple[int, int]]] = {
    "none": {},
    "neutral": {"charge": (0, 0)},
    "closed_shell": {"multiplicity": (1, 1)},
    "neutral_closed_shell": {"charge": (0, 0), "multiplicity": (1, 1)},
}

# Which chemistry checks a preset enables.
CHEMISTRY_PRESETS: dict[str, tuple[str, ...]] = {
    "neutral_closed_shell": ("charge", "zwitterion", "radicals"),
    "neutral": ("charge",),
    "none": (),
}


def parse_range(text: str) -> tuple[int, int]:
    m = re.fullmatch(r"\s*([+-]?\d+)\s*:\s*([+-]?\d+)\s*", text)
    if not m:
        raise ValueError(f"range must be MIN:MAX, got {text!r}")
    lo, hi = int(m[1]), int(m[2])
    if lo > hi:
        raise ValueError(f"range minimum exceeds maximum: {text!r}")
    return lo, hi


def parse_elements(text: str) -> list[str]:
    names = [p.strip().capitalize() for p in text.split(",") if p.strip()]
    for n in names:
        if not re.fullmatch(r"[A-Z][a-z]?", n):
            raise ValueError(f"bad element symbol {n!r}")
    if not names:
        raise ValueError("no element symbol given")
    return sorted(set(names))


def resolve_ranges(preset: str = "none", **override: tuple[int, int] | None) -> dict[str, tuple[int, int]]:
    """Preset ranges with explicit ranges taking their place one by one."""
    if preset not in RANGE_PRESETS:
        raise ValueError(f"unknown preset {preset!r}")
    return RANGE_PRESETS[preset] | {k: v for k, v in override.items() if v is not None}


def forbidden_check(symbols: Column | str, allowed: list[str] | None, implied: tuple[str, ...] = ()) -> list[Check]:
    if allowed is None:
        return []
    extra = F.array_sort(F.array_except(col(symbols), text_list([*allowed, *implied])))
    return [
        Check(F.size(extra) > 0, F.concat(F.lit("forbidden_elements:"), F.array_join(extra, ",")))
    ]


def bound_checks(
    value: Column | str, name: str, low: float | None = None, high: float | None = None,
    suffix: Column | None = None,
) -> list[Check]:
    """``name=value<low`` and ``name=value>high`` checks, low first."""
    v = col(value)
    text = lambda side, lim: F.concat(F.lit(f"{name}="), v.cast("string"), F.lit(f"{side}{lim}"))
    out = []
    if low is not None:
        out.append(Check(v < low, text("<", low)))
    if high is not None:
        why = text(">", high)
        out.append(Check(v > high, F.concat(why, suffix) if suffix is not None else why))
    return out


def scalar_filter(
    df: DataFrame, symbols: str = "symbols", n_atoms: str = "n_atoms", charge: str = "charge",
    multiplicity: str = "multiplicity", preset: str = "none", elements: list[str] | None = None,
    min_atoms: int | None = None, max_atoms: int | None = None,
    charge_range: tuple[int, int] | None = None, multiplicity_range: tuple[int, int] | None = None,
    decoded: Column | None = None,
) -> DataFrame:
    """First failing of: exact element list, atom bounds, charge range, multiplicity range."""
    ranges = resolve_ranges(preset, charge=charge_range, multiplicity=multiplicity_range)
    checks: list[Check] = []
    if decoded is not None:
        checks.append(Check(~decoded, F.lit("row_decode_failed")))
    checks += forbidden_check(symbols, elements)
    checks += bound_checks(n_atoms, "n_atoms", min_atoms, max_atoms)
    for name, c in (("charge", charge), ("multiplicity", multiplicity)):
        if name in ranges:
            checks += bound_checks(c, name, *ranges[name])
    return first_failing(df, checks)


def composition_filter(
    df: DataFrame, symbols: Column | str, n_heavy: Column | str, n_fragments: Column | str,
    corrupt: Column, fragment_text: Column, allowed: list[str] | None = None,
    min_heavy: int | None = None, max_heavy: int | None = None,
    min_fragments: int | None = None, max_fragments: int | None = None,
) -> DataFrame:
    """First failing of: corrupt, forbidden element (H is implied), heavy and fragment bounds."""
    shown = F.concat(F.lit("["), fragment_text, F.lit("]"))
    checks = [Check(corrupt, F.lit("mol_corrupt"), status="mol_corrupt")]
    checks += forbidden_check(symbols, allowed, ("H",))
    checks += bound_checks(n_heavy, "heavy_atoms", min_heavy, max_heavy)
    checks += bound_checks(n_fragments, "fragments", min_fragments, max_fragments, shown)
    return first_failing(df, checks)


# -- exclusion, scope, integrity -----------------------------------------------


def exclude_rules(df: DataFrame, rules: list[str]) -> DataFrame:
    """Drop rows with ``COL=VALUE`` for any rule.

    Both sides are stripped, and a rule without ``=`` is passed over. Values compare as text,
    a null as ``None``; an unknown column never matches unless the value is empty; of two
    rules on one column the later counts.
    """
    parsed: dict[str, str] = {}
    for rule in rules:
        name, sep, value = rule.partition("=")
        if sep:
            parsed[name.strip()] = value.strip()
    hits = []
    for name, value in parsed.items():
        if name in df.columns:
            hits.append(F.coalesce(F.col(name).cast("string"), F.lit("None")) == value)
        elif value == "":
            hits.append(F.lit(True))
    return df.where(~reduce(lambda a, b: a | b, hits)) if hits else df


def scope_labels(
    df: DataFrame, elements: Column | str, size: Column | str, allowed: list[str] | None = None,
    min_atoms: int | None = None, max_atoms: int | None = None,
) -> DataFrame:
    """Add ``scope`` (in, element, size) and ``outside`` (the elements not allowed).

    The element list is judged before the inclusive size bounds.
    """
    if min_atoms is not None and max_atoms is not None and min_atoms > max_atoms:
        raise ValueError("min_atoms exceeds max_atoms")
    outside = (
        F.array_sort(F.array_except(col(elements), text_list(allowed))) if allowed is not None
        else text_list([])
    )
    n = col(size)
    too_small = n < min_atoms if min_atoms is not None else F.lit(False)
    too_big = n > max_atoms if max_atoms is not None else F.lit(False)
    return df.withColumn("outside", outside).withColumn(
        "scope",
        F.when(F.size("outside") > 0, "element").when(too_small | too_big, "size").otherwise("in"),
    )


def scope_counts(labelled: DataFrame) -> DataFrame:
    """Rows excluded per element that caused it, plus the rows out of size and in scope."""
    parts = F.when(F.size("outside") > 0, F.transform("outside", lambda e: F.concat(F.lit("element:"), e))).otherwise(
        F.array(F.col("scope"))
    )
    return labelled.select(F.explode(parts).alias("key")).groupBy("key").agg(F.count(F.lit(1)).alias("n"))


def integrity_checks(
    declared_atoms: Column, atoms: Column, declared_bonds: Column, bonds: Column, energy: Column,
    compound_id: Column, recomputed_id: Column, parsed: Column,
) -> Column:
    """Array of all integrity errors; a block that does not parse reports only that."""
    e = energy.cast("double")
    shown = lambda c: F.coalesce(c.cast("string"), F.lit("None"))
    errors = all_failing(
        [
            Check(~declared_atoms.eqNullSafe(atoms),
                  F.concat(F.lit("num_atoms mismatch: "), shown(declared_atoms), F.lit(" vs "), shown(atoms))),
            Check(~declared_bonds.eqNullSafe(bonds),
                  F.concat(F.lit("num_bonds mismatch: "), shown(declared_bonds), F.lit(" vs "), shown(bonds))),
            Check(e.isNull() | ~is_finite(e), F.lit("energy is not finite")),
            Check(compound_id.isNotNull() & ~compound_id.eqNullSafe(recomputed_id), F.lit("CompoundID mismatch")),
        ]
    )
    return F.when(parsed, errors).otherwise(F.array(F.lit("mol_block does not parse")))


# -- funnels -------------------------------------------------------------------


def funnel(df: DataFrame, steps: list[tuple[str, Column]]) -> DataFrame:
    """Sequential funnel: each row counts at its first failing step.

    Columns ``step``, ``stage``, ``rejected`` and ``passed`` (cumulative survivors).
    """
    at = F.coalesce(*[F.when(c, i) for i, (_, c) in enumerate(steps, 1)], F.lit(0))
    sums = [
        F.struct(
            F.lit(i).alias("step"), F.lit(name).alias("stage"),
            F.coalesce(F.sum((F.col("_at") == i).cast("long")), F.lit(0)).alias("rejected"),
        )
        for i, (name, _) in enumerate(steps, 1)
    ]
    total = F.count(F.lit(1)).alias("total")
    one = df.select(at.alias("_at")).agg(total, F.array(*sums).alias("s"))
    rows = one.select("total", F.explode("s").alias("r")).select("total", "r.*")
    run = F.sum("rejected").over(Window.orderBy("step"))
    return rows.withColumn("passed", F.col("total") - run).drop("total")


def reject_funnel(rejects: DataFrame, stages: list[str], total: int, stage: str = "stage") -> DataFrame:
    """Funnel from reject counts: survivors after each stage, in the given stage order."""
    counts = rejects.groupBy(stage).agg(F.count(F.lit(1)).alias("n"))
    rank = F.create_map(*[x for i, s in enumerate(stages, 1) for x in (F.lit(s), F.lit(i))])
    listed = (
        rejects.sparkSession.createDataFrame([(i, s) for i, s in enumerate(stages, 1)], f"step int, {stage} string")
        .join(counts.where(rank[F.col(stage)].isNotNull()), stage, "left")
        .select("step", stage, F.coalesce("n", F.lit(0)).alias("rejected"))
    )
    run = F.sum("rejected").over(Window.orderBy("step"))
    return listed.withColumn("passed", F.lit(total) - run)


def reconcile(metrics: DataFrame, order: str = "step") -> DataFrame:
    """Stages whose input count differs from the output of the stage before, or whose
    rejects and output do not add up to their input."""
    prev = F.lag("n_out").over(Window.orderBy(order))
    gap = F.when(prev.isNotNull() & (prev != F.col("n_in")), F.lit("input differs from previous output"))
    sums = F.when(F.col("n_out") + F.col("n_rejected") != F.col("n_in"), F.lit("rejects do not add up"))
    return (
        metrics.withColumn("anomalies", F.array_compact(F.array(gap, sums)))
        .where(F.size("anomalies") > 0)
    )


def run_anomalies(counters: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The four findings about a run: ``stage, kind, n`` of those that are not zero, after the columns ``keep``.

    ``counters`` has one row per stage: ``stage, total, kept, removed, complexes, mol_corrupt,
    topology_warning, id_repeats, energy_positive``; a null counts as zero.
    """
    n = lambda c: F.coalesce(F.col(c).cast("bigint"), F.lit(0))
    # The stages the findings belong to.
    found = [
        ("stereo", "skipped_no_smiles", F.greatest(n("total") - n("kept") - n("removed") - n("complexes"), F.lit(0))),
        ("filter", "non_ok_rows_kept", n("mol_corrupt") + n("topology_warning")),
        ("validate", "id_repeats", n("id_repeats")),
        ("energy", "energy_positive", n("energy_positive")),
    ]
    rows = F.array(*[
        F.when(F.col("stage") == stage, F.struct(F.lit(kind).alias("kind"), value.cast("bigint").alias("n"))) for stage, kind, value in found
    ])
    hits = F.filter(rows, lambda r: r.isNotNull() & (r["n"] > 0))
    keep = keep or []
    return counters.select(*keep, "stage", F.explode(hits).alias("r")).select(*keep, "stage", "r.kind", "r.n")


def leftover(df: DataFrame, status: str = "filter_status", value: str = "rejected") -> DataFrame:
    """Rows that an earlier stage rejected and that are still present: one count."""
    return df.agg(F.coalesce(F.sum(F.coalesce((F.col(status) == value).cast("bigint"), F.lit(0))), F.lit(0)).alias("leftover"))


def guard_threshold(value: float, low: float, high: float, what: str) -> float:
    if not low <= value <= high:
        raise ValueError(f"{what} threshold {value} outside [{low}, {high}]")
    return value


def id_repeats(df: DataFrame, key: str, valid: Column) -> DataFrame:
    """Number of repeats of an id among valid rows (legitimate copies count as well)."""
    per = df.where(valid & F.col(key).isNotNull()).groupBy(key).agg((F.count(F.lit(1)) - 1).alias("r"))
    return per.agg(F.coalesce(F.sum("r"), F.lit(0)).alias("repeats"))
