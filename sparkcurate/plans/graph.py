"""Molecule track: contract gate, outlier filter, composition and chemistry gates, identity,
integrity, stereo, conformers, delivery and statistics, as one chain of DataFrames.

Canonical text and stereo come from columns (``canonical``, ``flat``, ``inverse``) when the
input has them, else from the optional toolkit. Order columns: ``batch_file, row_index``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from ..chem import backend
from ..functions import columns as C, molblock, structure
from ..functions.columns import let
from ..functions.elements import CNSO, FIT_ELEMENTS
from ..operators import gates, mirror, outlier
from ..operators.maxmin import conformer_filter
from ..operators.ordering import choose_representative, keep_first, number_rows, split_batches
from ..session import checkpointed
from ..sources.sdf import extract_rows

ORDER = ["batch_file", "row_index"]


@dataclass(frozen=True)
class Options:
    lenient: bool = False
    batch_size: int = 5000
    z_cut: float = 3.5
    skip_outliers: bool = False
    check_positive: bool = True
    atom_types: tuple[str, ...] = tuple(FIT_ELEMENTS)
    preset: str = "neutral_closed_shell"
    allowed_elements: list[str] | None = None
    min_heavy: int | None = None
    max_heavy: int | None = None
    min_fragments: int | None = None
    max_fragments: int | None = None
    topology: bool = False
    skip_integrity: bool = False
    remove_enantiomers: bool = False
    rmsd_threshold: float | None = None
    rmsd_mode: str = "raw"
    legacy_rotation: bool = False
    energy_aware: bool = True
    coverage_guarantee: bool = False
    force_keep: bool = False
    family: str = "QM40"
    exclude: list[str] = field(default_factory=list)


# The two collections that the chain is made for; only the family written into frames differs.
RECIPES = {"qm40": Options(family="QM40"), "qmugs": Options(family="QMUGS")}


def steps(o: Options = Options()) -> list[tuple[str, dict]]:
    """The chain that ``run`` would do with these options, in order, without running it: (step, its settings)."""
    of = lambda *names: {n: getattr(o, n) for n in names}
    return [
        ("contract", of("lenient")), ("split", of("batch_size")),
        ("energy_prefilter", of("skip_outliers", "z_cut", "check_positive", "atom_types", "force_keep")),
        ("chemistry_gate", {"checks": sorted(gates.CHEMISTRY_PRESETS[o.preset]), **of(
            "preset", "allowed_elements", "min_heavy", "max_heavy", "min_fragments", "max_fragments", "topology", "force_keep")}),
        ("identify", of("force_keep")), ("integrity", of("skip_integrity")), ("stereo", of("remove_enantiomers")),
        ("conformers", of("rmsd_threshold", "rmsd_mode", "energy_aware", "coverage_guarantee", "legacy_rotation", "force_keep")),
        ("extxyz", of("family", "exclude")),
    ]


def contract(records: DataFrame, lenient: bool = False) -> tuple[DataFrame, DataFrame]:
    """(passed, rejected) parsed SDF records."""
    checked = gates.validate_tags(records, lenient=lenient, parsed=F.col("parsed"))
    return gates.divide(checked, F.col("contract_status") == "passed")


def split(passed: DataFrame, order: list[str], batch_size: int = 5000) -> DataFrame:
    """Molecule rows in batches; the source order becomes ``batch_file, row_index``."""
    numbered = number_rows(passed, order, "_src")
    rows = extract_rows(numbered.drop("batch_file", "row_index", "errors", "warnings", "contract_status"))
    return split_batches(rows, ["_src"], batch_size).drop("_src")


def energy_prefilter(rows: DataFrame, o: Options) -> DataFrame:
    names = list(o.atom_types)
    counted = rows.withColumn("_c", molblock.atom_counts("mol_block", names))
    cols = {f"_n{i}": F.element_at("_c", F.lit(e)).cast("double") for i, e in enumerate(names)}
    out = outlier.label_outliers(
        counted.withColumns(cols), list(cols), "Energy_Ha", F.col("_c").isNull(), o.z_cut, o.check_positive,
        o.skip_outliers, score=None,
    )
    return out.drop("_c", *cols)


def structure_columns(rows: DataFrame) -> DataFrame:
    """Fragment counts, texts and charges as the connection table gives them."""

    def describe(s: Column) -> Column:
        groups = F.array_distinct(s["l"])
        part = lambda arr, c: F.filter(arr, lambda _, i: F.get(s["l"], i) == c)
        total = lambda qs: F.aggregate(qs, F.lit(0), lambda a, q: a + q)
        each = lambda fn: F.array_join(F.transform(groups, fn), ";")
        return F.struct(
            F.size(groups).alias("n"), s["s"].alias("s"),
            F.size(F.filter(s["s"], lambda x: x != "H")).alias("heavy"),
            each(lambda c: C.hill_formula(part(s["s"], c), True)).alias("f"),
            each(lambda c: total(part(s["q"], c)).cast("string")).alias("q"),
            each(lambda c: F.size(F.filter(part(s["s"], c), lambda x: x != "H")).cast("string")).alias("h"),
            total(s["q"]).alias("net"), molblock.true_zwitterion(s["q"], s["e"], s["l"]).alias("zw"),
        )

    parsed = F.struct(
        molblock.symbols("mol_block").alias("s"), molblock.bonds("mol_block").alias("e"),
        molblock.formal_charges("mol_block").alias("q"),
    )
    labelled = let(parsed, lambda p: F.struct(
        p["s"].alias("s"), p["e"].alias("e"), p["q"].alias("q"), molblock.fragment_labels(F.size(p["s"]), p["e"]).alias("l")
    ))
    ok = F.col("_m.s").isNotNull() & F.col("_m.e").isNotNull()
    return (
        rows.withColumn("_m", labelled).withColumn("_d", F.when(ok, let(F.col("_m"), describe)))
        .withColumns({
            "n_fragments": F.col("_d.n"), "fragment_formulas": F.coalesce("_d.f", F.lit("")),
            "fragment_charges": F.coalesce("_d.q", F.lit("")), "fragment_heavy_atoms": F.coalesce("_d.h", F.lit("")),
            "_symbols": F.col("_d.s"), "_heavy": F.col("_d.heavy"), "_net": F.col("_d.net"), "_zw": F.col("_d.zw"),
        }).drop("_m", "_d")
    )


def chemistry_gate(rows: DataFrame, o: Options) -> DataFrame:
    """Composition first; then net charge and true zwitterions of the given bonds and charges.

    Radical counts need valence perception: with a preset that asks for them, the column
    ``n_radicals`` is used when present, else the toolkit is required. With ``topology``, rows that pass are
    labelled ``topology_warning`` where the bonds that their coordinates show are not the listed ones.
    """
    if o.preset not in gates.CHEMISTRY_PRESETS:
        raise ValueError(f"unknown preset {o.preset!r}")
    wanted = gates.CHEMISTRY_PRESETS[o.preset]
    df = structure_columns(rows)
    corrupt = F.col("_symbols").isNull()
    composed = gates.composition_filter(
        df, "_symbols", "_heavy", "n_fragments", corrupt, F.col("fragment_formulas"), o.allowed_elements,
        o.min_heavy, o.max_heavy, o.min_fragments, o.max_fragments,
    )
    checks = []
    if "charge" in wanted:
        checks.append(gates.Check(F.col("_net") != 0, F.concat(F.lit("charge="), F.format_string("%+d", F.col("_net")))))
    if "zwitterion" in wanted:
        checks.append(gates.Check(F.col("_zw"), F.lit("zwitterion")))
    if "radicals" in wanted:
        if "n_radicals" not in rows.columns:
            backend.require()
        else:
            checks.append(gates.Check(F.col("n_radicals") > 0, F.concat(F.lit("radicals="), F.col("n_radicals").cast("string"))))
    later = gates.first_failing(composed, checks, "_s", "_r")
    open_ = F.col("filter_status") == "ok"
    later = later.withColumns({
        "filter_reason": F.when(open_, F.col("_r")).otherwise(F.col("filter_reason")),
        "filter_status": F.when(open_, F.col("_s")).otherwise(F.col("filter_status")),
    }).drop("_s", "_r", "_heavy", "_net", "_zw")
    if o.topology:
        shown = structure.perceived_bonds(F.col("_symbols"), molblock.coords("mol_block"))
        later = later.withColumn("_t", structure.topology_differences(molblock.bonds("mol_block"), shown))
        warned = (F.col("filter_status") == "ok") & (F.coalesce(F.col("_t.missing") + F.col("_t.extra"), F.lit(0)) > 0)
        reason = F.format_string("%d listed bonds not seen, %d seen not listed", F.col("_t.missing"), F.col("_t.extra"))
        later = later.withColumns({
            "filter_reason": F.when(warned, reason).otherwise(F.col("filter_reason")),
            "filter_status": F.when(warned, F.lit("topology_warning")).otherwise(F.col("filter_status")),
        }).drop("_t")
    return later.drop("_symbols")


def identify(rows: DataFrame) -> DataFrame:
    """CompoundID, formula and keep-first labels; later conformers stay in the stream."""
    if "canonical" not in rows.columns:
        rows = rows.withColumn("canonical", backend.canonical_smiles("SMILES"))
    axis = F.col("axis_key") if "axis_key" in rows.columns else None
    keyed = rows.withColumns({
        "CanonicalSMILES": F.col("canonical"),
        "CompoundID": F.when(F.col("canonical").isNotNull(), C.compound_key("canonical", axis)),
        "Formula": C.hill_formula(molblock.symbols("mol_block")),
    }).drop("canonical")
    out = keep_first(keyed, "CompoundID", ORDER, "dedup_status", "ok", "conformer_duplicate")
    failed = F.when(molblock.atom_rows("mol_block").isNull(), "mol_corrupt").when(F.col("CompoundID").isNull(), "bond_assignment_failed")
    return out.withColumn("dedup_status", F.coalesce(failed, F.col("dedup_status"))).withColumn(
        "ICONF", F.when(F.col("dedup_status") == "ok", F.lit(1))
    )


def integrity(rows: DataFrame, skip: bool = False) -> DataFrame:
    if skip:
        return rows.withColumn("validate_status", F.lit("ok")).withColumn("validate_errors", C.text_list([]))
    atoms, bonds = molblock.n_atoms("mol_block"), F.size(molblock.bonds("mol_block"))
    errors = gates.integrity_checks(
        F.col("num_atoms"), atoms, F.col("num_bonds"), bonds, F.col("Energy_Ha"), F.col("CompoundID"),
        C.compound_key("CanonicalSMILES") if "axis_key" not in rows.columns else C.compound_key("CanonicalSMILES", "axis_key"),
        molblock.atom_rows("mol_block").isNotNull(),
    )
    return rows.withColumn("validate_errors", errors).withColumn(
        "validate_status", F.when(F.size("validate_errors") > 0, "invalid").otherwise("ok")
    )


def stereo(rows: DataFrame, remove: bool = False) -> DataFrame:
    if "flat" not in rows.columns:
        rows = rows.withColumns({
            "flat": backend.canonical_smiles("CanonicalSMILES", isomeric=False), "inverse": backend.inverted_smiles("CanonicalSMILES"),
        })
    at = rows.withColumn("_at", F.struct(*ORDER))
    out = mirror.stereo_labels(at, "flat", "CanonicalSMILES", "inverse", "_at", F.col("n_fragments") > 1, remove)
    return out.drop("_at", "in_pair", "flat", "inverse")


def conformers(rows: DataFrame, o: Options) -> DataFrame:
    work = checkpointed(number_rows(rows, ORDER, "_row").withColumn("_xyz", molblock.heavy_coords("mol_block")))
    out = conformer_filter(
        work, "CompoundID", "_row", "_xyz", "Energy_Ha" if o.energy_aware else None, o.rmsd_threshold, o.rmsd_mode,
        o.coverage_guarantee, o.legacy_rotation,
    )
    return out.drop("_row", "_xyz")


def extxyz(rows: DataFrame, family: str = "QM40", exclude: list[str] | None = None) -> DataFrame:
    """Add ``frame``: atom count, comma-paired metadata in fixed order, atom lines.

    Descriptors come from columns ``TPSA, LogP, nRot`` when present, else stay empty; a null
    conformer number is 1.
    """
    df = gates.exclude_rules(rows, exclude or [])
    has = lambda c: c in df.columns
    text = lambda c, default="": F.coalesce(F.col(c).cast("string"), F.lit(default)) if has(c) else F.lit(default)
    two = lambda c: F.coalesce(F.format_string("%.2f", F.col(c).cast("double")), F.lit("")) if has(c) else F.lit("")

    def frame(s: Column) -> Column:
        syms = F.transform(s["r"], lambda r: F.get(r, F.lit(3)))
        n = F.size(s["r"]).cast("string")
        cnso = F.size(F.filter(syms, lambda e: e.isin(CNSO))).cast("string")
        stored = F.col("Formula") if has("Formula") else F.lit(None).cast("string")
        pairs = [
            ("SourceID", text("SourceID")), ("CompoundID", text("CompoundID")),
            ("Formula", F.coalesce(F.when(stored != "", stored), C.hill_formula(syms))), ("Nat", n), ("CNSO", cnso),
            ("chrg", text("FormalCharge", "0")), ("mult", text("Multiplicity", "1")), ("E", text("Energy_Ha")), ("fmax", F.lit("")),
            ("Family", F.lit(family)), ("smiles", text("CanonicalSMILES")), ("tpsa", two("TPSA")), ("logp", two("LogP")),
            ("nrot", text("nRot")), ("nfrag", text("n_fragments", "1")), ("iconf", text("ICONF", "1")),
        ]
        meta = F.concat_ws(",", *[x for k, v in pairs for x in (F.lit(k), v)])
        point = lambda r: F.array_join(F.transform(F.slice(r, 1, 3), lambda v: C.fixed6(v.try_cast("double"))), "  ")
        lines = F.transform(s["r"], lambda r: F.concat(F.rpad(F.get(r, F.lit(3)), 2, " "), F.lit("  "), point(r)))
        return F.when(s["r"].isNotNull(), F.array_join(F.concat(F.array(n, meta), lines), "\n"))

    return df.withColumn("frame", let(F.struct(molblock.atom_rows("mol_block").alias("r")), frame))


# Stages of the statistics funnel with the status that ends each.
FUNNEL = [
    ("Energy positive", "energy_status", "energy_positive"),
    ("Energy prefilter (OLS)", "energy_status", "flagged_ols"),
    ("Chemical filter", "filter_status", "rejected"),
    ("Stereo filter", "stereo_status", "removed_enantiomer"),
    ("Reorder", "reorder_status", "failed"),
    ("Conformer filter", "conformer_status", "removed_conformer"),
]


def status_funnel(rows: DataFrame) -> DataFrame:
    return gates.funnel(rows, [(name, F.col(c) == v) for name, c, v in FUNNEL if c in rows.columns])


def representatives(rows: DataFrame) -> DataFrame:
    return choose_representative(rows, "CompoundID", ORDER, F.col("conformer_status") == "kept")


def run(records: DataFrame, order: list[str], o: Options = Options()) -> dict[str, DataFrame]:
    """The whole chain. Fails when the contract or the integrity gate has rejects."""
    passed, rejected = contract(records, o.lenient)
    gates.stop_on_rejects(rejected, "contract")
    rows = checkpointed(split(passed, order, o.batch_size))
    fit = energy_prefilter(rows, o)
    kept, energy_out = gates.divide(fit, F.col("energy_status").isin("ok", "skipped"), o.force_keep)
    chem = checkpointed(chemistry_gate(kept, o))
    kept, chem_out = gates.divide(chem, F.col("filter_status") != "rejected", o.force_keep)
    ided = identify(kept)
    kept, id_out = gates.divide(ided, F.col("dedup_status").isin("ok", "conformer_duplicate"), o.force_keep)
    checked = checkpointed(integrity(kept, o.skip_integrity))
    gates.stop_on_rejects(checked.where("validate_status = 'invalid'"), "integrity")
    turned = stereo(checked, o.remove_enantiomers)
    kept, stereo_out = gates.divide(turned, F.col("stereo_status") != "removed_enantiomer")
    final = checkpointed(conformers(kept.drop("validate_errors"), o))
    kept, conf_out = gates.divide(final, F.col("conformer_status") != "removed_conformer", o.force_keep)
    return {
        "rows": kept, "frames": extxyz(kept, o.family, o.exclude), "contract_rejects": rejected,
        "energy_rejects": energy_out, "filter_rejects": chem_out, "dedup_rejects": id_out,
        "stereo_rejects": stereo_out, "conformer_rejects": conf_out,
    }
