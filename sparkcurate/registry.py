"""Column registries of the stages and the conversion of any table to one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from .functions.columns import nan_to_null

# Columns of a molecule row, the base columns in their fixed order, then extras.
# ``cluster_id`` is wider than in the files it is compared with: clusters of all groups count on.
GRAPH = {
    "Energy_Ha": "double", "FormalCharge": "int", "Multiplicity": "int", "SMILES": "string",
    "SourceID": "string", "HOMO_Ha": "double", "LUMO_Ha": "double", "HL_Gap_Ha": "double",
    "PartialCharges": "string", "num_atoms": "int", "num_bonds": "int", "mol_block": "string",
    "energy_status": "string", "filter_status": "string", "filter_reason": "string",
    "n_fragments": "int", "CanonicalSMILES": "string", "CompoundID": "string",
    "AtropisomerKey": "string", "ICONF": "int", "Formula": "string", "dedup_status": "string",
    "dedup_reason": "string", "stereo_status": "string", "reorder_status": "string",
    "conformer_status": "string", "cluster_id": "bigint",
    "validate_status": "string", "fragment_formulas": "string", "fragment_smiles": "string", "fragment_charges": "string",
    "fragment_heavy_atoms": "string",
}
GRAPH_REQUIRED = ["mol_block", "num_atoms", "num_bonds", "Energy_Ha", "FormalCharge", "Multiplicity"]

# Columns of a geometry row.
REALSPACE = {
    "geometry_id": "string", "symbols": "string", "n_atoms": "int", "coords": "string",
    "charges": "string", "formula": "string", "charge": "int", "multiplicity": "int",
    "source_id": "string", "source_file": "string", "source_index": "int", "header": "string",
    "dedup_status": "string", "cluster_id": "bigint",
}

# Columns of a descriptor row and of a selection row.
DESCRIPTORS = {
    "CompoundID": "string", "smiles": "string", "mol_block": "string", "formula": "string",
    "nat_heavy": "int", "molwt": "double", "tpsa": "double", "energy_ha": "double",
    "scaffold": "string", "morgan_fp": "array<int>", "atom_envs": "array<array<bigint>>",
    "heavy_elements": "array<string>", "bonds": "array<string>",
}
SELECTION = {
    "CompoundID": "string", "smiles": "string", "mol_block": "string", "pass": "string",
    "tier": "string", "score": "double", "selection_order": "int",
}


def conform(df: DataFrame, registry: dict[str, str], allow_extra: bool = True) -> DataFrame:
    """Registry columns first, in order and cast; absent ones as typed nulls; extras after.

    NaN becomes null in every floating column, because the two mean the same here. A text that
    does not read as the column's type becomes null; ``unreadable`` finds such rows.
    """
    types = dict(df.dtypes)
    cols = []
    for name, kind in registry.items():
        c = F.col(f"`{name}`").try_cast(kind) if name in types else F.lit(None).cast(kind)
        if kind == "double" and name in types:
            c = nan_to_null(c)
        cols.append(c.alias(name))
    if allow_extra:
        for name, kind in df.dtypes:
            if name not in registry:
                c = F.col(f"`{name}`")
                cols.append((nan_to_null(c) if kind in ("double", "float") else c).alias(name))
    return df.select(*cols)


def unreadable(df: DataFrame, registry: dict[str, str]) -> DataFrame:
    """Rows that lose a value in ``conform``, with the columns' names in ``reject_reason``."""
    lost = [
        F.when(F.col(f"`{n}`").isNotNull() & F.col(f"`{n}`").try_cast(registry[n]).isNull(), F.lit(n))
        for n, kind in df.dtypes if n in registry and kind != registry[n]
    ]
    names = F.array_compact(F.array(*lost, F.lit(None).cast("string")))
    return df.withColumn("reject_reason", F.concat(F.lit("not readable: "), F.array_join(names, ", "))).where(F.size(names) > 0)


def missing_required(df: DataFrame, required: list[str] = GRAPH_REQUIRED) -> list[str]:
    return [c for c in required if c not in df.columns]


def schema_of(registry: dict[str, str]) -> T.StructType:
    return T.StructType.fromDDL(", ".join(f"`{k}` {v}" for k, v in registry.items()))
