"""Chemistry that needs a toolkit, behind a check for it.

Perception, canonical text, stereo and descriptors are not imitated: without the toolkit
they raise :class:`BackendUnavailable`. What the connection table itself says (counts,
bonds, charges, fragments, formulas, weights) is in :mod:`sparkcurate.functions.molblock`
and needs no toolkit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, functions as F

try:
    from rdkit import Chem
    from rdkit.Chem import Descriptors, rdFingerprintGenerator, rdMolDescriptors
    from rdkit.Chem.Scaffolds import MurckoScaffold
except ImportError:  # optional
    Chem = None

# Fingerprint width and radius, oldest toolkit release with the needed calls.
NBITS = 2048
RADIUS = 2
OLDEST = (2024, 3)


class BackendUnavailable(RuntimeError):
    """The operation needs the optional chemistry toolkit."""


def require() -> None:
    if Chem is None:
        raise BackendUnavailable("this operation needs the optional RDKit package")
    import rdkit

    if tuple(int(p) for p in rdkit.__version__.split(".")[:2]) < OLDEST:
        raise BackendUnavailable(f"RDKit {OLDEST[0]}.{OLDEST[1]:02d} or later is needed")


def _per_molecule(schema: str, fn: Callable, text: Column | str) -> Column:
    """Arrow function over SMILES text; null where the text does not parse."""
    require()

    @F.pandas_udf(schema)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for smiles in batch:
                mol = Chem.MolFromSmiles(smiles) if smiles else None
                out.append(fn(mol) if mol is not None else None)
            yield pd.Series(out, dtype=object)

    return run(text)


def canonical_smiles(smiles: Column | str, isomeric: bool = True) -> Column:
    return _per_molecule("string", lambda m: Chem.MolToSmiles(m, isomericSmiles=isomeric), smiles)


def inverted_smiles(smiles: Column | str) -> Column:
    """Canonical text with every tetrahedral centre inverted; double bonds stay."""

    def flip(m):
        m = Chem.Mol(m)
        for atom in m.GetAtoms():
            atom.InvertChirality()
        return Chem.MolToSmiles(m)

    return _per_molecule("string", flip, smiles)


def fingerprint(smiles: Column | str, chirality: bool = True) -> Column:
    """Sorted on-bits of the circular fingerprint."""
    require()

    def bits(m):
        gen = rdFingerprintGenerator.GetMorganGenerator(radius=RADIUS, fpSize=NBITS, includeChirality=chirality)
        return sorted(gen.GetFingerprint(m).GetOnBits())

    return _per_molecule("array<int>", bits, smiles)


def scaffold(smiles: Column | str) -> Column:
    """Ring scaffold text; null for acyclic molecules."""
    return _per_molecule("string", lambda m: MurckoScaffold.MurckoScaffoldSmiles(mol=m) or None, smiles)


def number(smiles: Column | str, name: str) -> Column:
    """One of MolWt, TPSA, MolLogP, NumRotatableBonds."""
    require()
    calc = getattr(Descriptors, name)
    return _per_molecule("double", lambda m: float(calc(m)), smiles)


def formula(smiles: Column | str) -> Column:
    require()
    return _per_molecule("string", lambda m: rdMolDescriptors.CalcMolFormula(Chem.AddHs(m)), smiles)


def atom_environments(smiles: Column | str) -> Column:
    """Unfolded environment ids of every heavy atom, as unsigned numbers."""
    require()

    def envs(m):
        gen = rdFingerprintGenerator.GetMorganGenerator(radius=RADIUS, includeChirality=False)
        extra = rdFingerprintGenerator.AdditionalOutput()
        extra.AllocateAtomToBits()
        gen.GetSparseFingerprint(m, additionalOutput=extra)
        per_atom = extra.GetAtomToBits()
        return [sorted(int(b) for b in per_atom[a.GetIdx()]) for a in m.GetAtoms() if a.GetAtomicNum() > 1]

    return _per_molecule("array<array<bigint>>", envs, smiles)


def reordered_block(block: Column | str) -> Column:
    """The block with its atoms in canonical order; null when it does not parse."""
    require()

    @F.pandas_udf("string")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for text in batch:
                mol = Chem.MolFromMolBlock(text, sanitize=False, removeHs=False) if text else None
                if mol is None:
                    out.append(None)
                    continue
                mol.UpdatePropertyCache(strict=False)
                ranks = list(Chem.CanonicalRankAtoms(mol, breakTies=True))
                out.append(Chem.MolToMolBlock(Chem.RenumberAtoms(mol, sorted(range(len(ranks)), key=ranks.__getitem__))))
            yield pd.Series(out, dtype=object)

    return run(block)


def soap(*_: object) -> Column:
    raise NotImplementedError("the SOAP metric is not available")
