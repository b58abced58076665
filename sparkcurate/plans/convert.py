"""Raw inputs to contract records: atom and bond tables, or a summary with structure files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import molblock
from ..functions.columns import fixed6
from ..sources.sdf import block_of, unix_text


def formal_charge(charges: Column | str) -> Column:
    """Sum of atomic charges rounded to the nearest integer, halves to even."""
    c = F.col(charges) if isinstance(charges, str) else charges
    return F.rint(F.aggregate(c, F.lit(0.0), lambda acc, q: acc + q.cast("double"))).cast("int")


def group_children(rows: DataFrame, key: str, order: list[str], fields: list[str], out: str) -> DataFrame:
    """Ordered child lists per key. A list is one record, as long as the record is."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*order, *fields))).alias(out))


def assemble(
    main: DataFrame, atoms: DataFrame, bonds: DataFrame, key: str, atom_order: list[str], atom_fields: list[str],
    bond_fields: tuple[str, str] = ("atom1", "atom2"), status: str | None = "energy_status",
) -> DataFrame:
    """Main rows with their ordered ``atoms`` and ``bonds``.

    Main rows without atoms are left out; without bonds they stay with an empty list. Rows
    with a status other than ``ok`` are left out when the status column exists.
    """
    if status and status in main.columns:
        main = main.where(F.col(status) == "ok")
    atom_lists = group_children(atoms, key, atom_order, atom_fields, "atoms")
    bond_lists = group_children(bonds, key, list(bond_fields), [], "bonds")
    none = F.expr(f"cast(array() as {dict(bond_lists.dtypes)['bonds']})")
    joined = main.join(atom_lists, key, "inner").join(bond_lists, key, "left")
    return joined.withColumn("bonds", F.coalesce("bonds", none))


def atom_bond_records(main: DataFrame, atoms: DataFrame, bonds: DataFrame) -> DataFrame:
    """Contract rows from the three tables of an atoms-and-bonds data set.

    main: ``Zinc_id, smile, Internal_E(0K), HOMO, LUMO, HL_gap``; atoms: ``Zinc_id, atom,
    final_x, final_y, final_z, charge`` and an order column ``pos``; bonds: ``Zinc_id, atom1,
    atom2`` (from 1). Bonds are written as single.
    """
    key = "Zinc_id"
    got = assemble(main, atoms, bonds, key, ["pos"], ["atom", "final_x", "final_y", "final_z", "charge"])
    edges = F.transform("bonds", lambda b: F.struct(b["atom1"].cast("int").alias("a"), b["atom2"].cast("int").alias("b"), F.lit(1).alias("order")))
    block = molblock.build_block(
        F.col(key), F.transform("atoms", lambda a: a["atom"]),
        F.transform("atoms", lambda a: F.array(a["final_x"].cast("double"), a["final_y"].cast("double"), a["final_z"].cast("double"))),
        edges,
    )
    inside = F.forall(edges, lambda e: (e["a"] >= 1) & (e["b"] >= 1) & (e["a"] <= F.size("atoms")) & (e["b"] <= F.size("atoms")) & (e["a"] != e["b"]))
    charges = F.transform("atoms", lambda a: a["charge"])
    return got.where(inside).select(
        block.alias("mol_block"),
        F.format_string("%.8f", F.col("`Internal_E(0K)`").cast("double")).alias("Energy_Ha"),
        formal_charge(charges).alias("FormalCharge"), F.lit(1).alias("Multiplicity"),
        F.col("smile").alias("SMILES"), F.col(key).alias("SourceID"),
        fixed6(F.col("HOMO")).alias("HOMO_Ha"), fixed6(F.col("LUMO")).alias("LUMO_Ha"), fixed6(F.col("HL_gap")).alias("HL_Gap_Ha"),
        F.array_join(F.transform(charges, fixed6), " ").alias("PartialCharges"),
    )


def path_keys(path: Column | str, pattern: str = r"([^/]+)/([^/]+)\.sdf$") -> tuple[Column, Column]:
    """The two keys in a structure path: folder and file stem."""
    p = F.col(path) if isinstance(path, str) else path
    return F.regexp_extract(p, pattern, 1), F.regexp_extract(p, pattern, 2)


def summary_records(spark: SparkSession, summary: DataFrame, folder: str, sample: int | None = None, order: list[str] | None = None) -> DataFrame:
    """Contract rows of a summary table (``chembl_id, conf_id, smiles, DFT_*``) with the
    structure file of each row; rows without a file are left out. ``sample`` takes the first
    rows by ``order`` (the two ids unless given)."""
    ids = ["chembl_id", "conf_id"]
    if sample is not None:
        summary = summary.orderBy(*(order or ids)).limit(sample)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.sdf").load(folder)
    a, b = path_keys("path")
    blocks = files.select(a.alias(ids[0]), b.alias(ids[1]), block_of(unix_text(F.col("content"))).alias("mol_block"))
    got = summary.join(blocks, ids, "inner").where(molblock.atom_rows("mol_block").isNotNull())
    name = F.concat_ws("_", *ids)
    d8 = lambda c: F.format_string("%.8f", F.col(c).cast("double"))
    return got.select(
        "mol_block", d8("DFT_TOTAL_ENERGY").alias("Energy_Ha"), F.lit(0).alias("FormalCharge"), F.lit(1).alias("Multiplicity"),
        F.col("smiles").alias("SMILES"), name.alias("SourceID"), fixed6(F.col("DFT_HOMO_ENERGY")).alias("HOMO_Ha"),
        fixed6(F.col("DFT_LUMO_ENERGY")).alias("LUMO_Ha"), fixed6(F.col("DFT_HOMO_LUMO_GAP")).alias("HL_Gap_Ha"),
    )
