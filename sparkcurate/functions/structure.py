"""Structure of bonded records without a toolkit: environments, fingerprints, refinement, scaffolds, canonical order.

Atoms are an array of symbols, bonds an array of structs (a, b, order) with atom numbers from 1. The
definitions are this library's own, so ids and keys compare only with each other:

* An environment of radius 0 is the id of the symbol and the number of neighbours; one of radius r + 1 is the id
  of the one of radius r and the sorted list of (bond order, environment of radius r) of the neighbours.
* Refinement repeats that step until it tells no more atoms apart.
* The scaffold is what repeated removal of end atoms leaves: rings and the chains between them. A bond of
  it is in a ring when its ends stay connected without it.
* The canonical order individualizes atoms that refinement cannot tell apart and takes the order with the
  smallest key, so two numberings of one structure get one key.

Nothing is shuffled. Environments, refinement, scaffolds and the canonical order of small records are made by
:mod:`bonded` for a batch of records at a time. Null arrays give null; records without atoms give empty arrays.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, functions as F

from . import bonded
from .columns import let

RADIUS, BITS = 2, 2048
BONDS = "array<struct<a:int,b:int,order:int>>"
# Covalent radii in Angstrom (Cordero et al. 2008), hydrogen to xenon in order of atomic number.
COVALENT_RADII = dict(zip(
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr "
    "Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe".split(),
    (0.31, 0.28, 1.28, 0.96, 0.84, 0.76, 0.71, 0.66, 0.57, 0.58, 1.66, 1.41, 1.21, 1.11, 1.07, 1.05, 1.02, 1.06, 2.03, 1.76, 1.70, 1.60,
     1.53, 1.39, 1.39, 1.32, 1.26, 1.24, 1.32, 1.22, 1.22, 1.20, 1.19, 1.20, 1.20, 1.16, 2.20, 1.95, 1.90, 1.75, 1.64, 1.54, 1.47, 1.46,
     1.42, 1.39, 1.45, 1.44, 1.42, 1.39, 1.39, 1.38, 1.39, 1.40), strict=True))
# Two atoms are bonded up to the sum of their radii and this.
SLACK = 0.45


def _batchwise(kernel: Callable[..., pa.Array], kind: str, *columns: Column) -> Column:
    """``kernel`` of the columns as Arrow arrays, a batch of records at a time."""

    @F.arrow_udf(kind)
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            yield kernel(*batch)

    return run(*columns)


def environments(symbols: Column, bonds: Column, radius: int = RADIUS) -> Column:
    """Per atom, the ids of its environments of radius 0 to ``radius``: ARRAY<ARRAY<BIGINT>>."""
    return _batchwise(partial(bonded.environments, radius=radius), "array<array<bigint>>", symbols, bonds)


def fingerprint(envs: Column, bits: int = BITS) -> Column:
    """Sorted on-bits of all environments of a record, folded."""
    return F.array_sort(F.array_distinct(F.transform(F.flatten(envs), lambda e: (e % bits).cast("int"))))


def refined_classes(symbols: Column, bonds: Column) -> Column:
    """Per atom, the first atom that refinement cannot tell from it."""
    return _batchwise(bonded.refined_classes, "array<int>", symbols, bonds)


def core_bonds(n: Column, bonds: Column) -> Column:
    """The bonds that repeated removal of end atoms leaves."""
    return _batchwise(bonded.core_bonds, BONDS, n, bonds)


def ring_bonds(n: Column, core: Column) -> Column:
    """The bonds of a core whose ends stay connected without them."""
    return _batchwise(bonded.ring_bonds, BONDS, n, core)


def scaffold(n: Column, bonds: Column) -> Column:
    """STRUCT<core, ring>: the bonds of the core and those of them in rings, in one pass."""
    return _batchwise(bonded.scaffold, f"core {BONDS}, ring {BONDS}", n, bonds)


def atoms_of(bonds: Column) -> Column:
    """Sorted numbers of the atoms that bonds touch."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(bonds, lambda e: F.array(e["a"].cast("int"), e["b"].cast("int"))))))


# -- bonds from coordinates ----------------------------------------------------


def perceived_bonds(symbols: Column, coords: Column, slack: float = SLACK) -> Column:
    """Bonds (a < b) of atoms that stand no farther apart than their covalent radii and ``slack``.

    Null for a record with a symbol outside the table, without coordinates, or with another number of them.
    Atoms are first limited to those within the largest reach along the first axis.
    """
    table = F.create_map(*[F.lit(x) for pair in COVALENT_RADII.items() for x in pair])
    apart = lambda p, q: F.sqrt(sum(((F.get(p, k) - F.get(q, k)) * (F.get(p, k) - F.get(q, k)) for k in (1, 2)), (F.get(p, 0) - F.get(q, 0)) * (F.get(p, 0) - F.get(q, 0))))

    def found(s: Column) -> Column:
        atoms = F.zip_with(s["r"], s["p"], lambda r, p: F.struct(r.alias("r"), p.alias("p")))
        placed = F.transform(atoms, lambda x, i: F.struct((i + 1).alias("i"), x["r"].alias("r"), x["p"].alias("p")))

        def of(x: Column, rest: Column, widest: Column) -> Column:
            near = F.filter(rest, lambda y: (y["i"] > x["i"]) & (F.abs(F.get(y["p"], 0) - F.get(x["p"], 0)) <= x["r"] + widest + slack))
            hit = F.filter(near, lambda y: apart(x["p"], y["p"]) <= x["r"] + y["r"] + slack)
            return F.transform(hit, lambda y: F.struct(x["i"].alias("a"), y["i"].alias("b"), F.lit(1).alias("order")))

        def all_of(t: Column) -> Column:
            return F.flatten(F.transform(t["a"], lambda x: of(x, t["a"], t["w"])))

        bonds = let(F.struct(placed.alias("a"), F.array_max(s["r"]).alias("w")), all_of)
        whole = F.forall(s["r"], lambda r: r.isNotNull()) & (F.size(s["r"]) == F.size(s["p"]))
        return F.when(whole, bonds)

    radii = F.transform(symbols, lambda x: F.element_at(table, x))
    return F.when(symbols.isNotNull() & coords.isNotNull(), let(F.struct(radii.alias("r"), coords.alias("p")), found))


def topology_differences(listed: Column, perceived: Column) -> Column:
    """STRUCT<missing, extra>: listed bonds that the coordinates do not show, and shown ones that are not listed; null without either."""
    pairs = lambda bonds: F.array_distinct(F.transform(bonds, lambda e: F.struct(
        F.least(e["a"], e["b"]).cast("int").alias("a"), F.greatest(e["a"], e["b"]).cast("int").alias("b"))))
    both = F.struct(pairs(listed).alias("l"), pairs(perceived).alias("p"))
    return F.when(listed.isNotNull() & perceived.isNotNull(), let(both, lambda s: F.struct(
        F.size(F.array_except(s["l"], s["p"])).alias("missing"), F.size(F.array_except(s["p"], s["l"])).alias("extra"))))


# -- canonical order -----------------------------------------------------------


def _refine(colours: list[int], near: list[list[tuple[int, int]]]) -> list[int]:
    while True:
        seen = [(colours[i], sorted((o, colours[j]) for j, o in near[i])) for i in range(len(near))]
        rank = {s: r for r, s in enumerate(sorted({(c, tuple(t)) for c, t in seen}))}
        new = [rank[c, tuple(t)] for c, t in seen]
        if len(rank) == len(set(colours)):
            return new
        colours = new


def _best(colours: list[int], symbols: list[str], near: list[list[tuple[int, int]]]) -> tuple[tuple, list[int]]:
    """(key, atoms in order) with the smallest key over all ways to tell equal atoms apart."""
    colours = _refine(colours, near)
    cells: dict[int, list[int]] = {}
    for i, c in enumerate(colours):
        cells.setdefault(c, []).append(i)
    open_ = [(len(v), c) for c, v in cells.items() if len(v) > 1]
    if not open_:
        order = sorted(range(len(colours)), key=colours.__getitem__)
        place = {i: k for k, i in enumerate(order, 1)}
        edges = sorted((min(place[i], place[j]), max(place[i], place[j]), o) for i in order for j, o in near[i] if i < j)
        return (tuple(symbols[i] for i in order), tuple(edges)), order
    cell = cells[min(open_)[1]]
    # Atoms with the same neighbours can be swapped, so one of them stands for all.
    twins = {tuple(sorted(near[i])): i for i in reversed(cell)}
    found = []
    for i in twins.values():
        apart = [2 * c + 1 for c in colours]
        apart[i] -= 1
        found.append(_best(apart, symbols, near))
    return min(found)


def canonical(symbols: list[str], bonds: list[tuple[int, int, int]]) -> tuple[list[int], str]:
    """(atom numbers in canonical order, identity key) of a record; fragments are ordered by their keys."""
    near: list[list[tuple[int, int]]] = [[] for _ in symbols]
    for a, b, o in bonds:
        near[a - 1].append((b - 1, o))
        near[b - 1].append((a - 1, o))
    names = {s: r for r, s in enumerate(sorted(set(symbols)))}
    left, parts = set(range(len(symbols))), []
    while left:
        stack, own = [min(left)], set()
        while stack:
            i = stack.pop()
            if i not in own:
                own.add(i)
                stack += [j for j, _ in near[i]]
        left -= own
        atoms = sorted(own)
        at = {i: k for k, i in enumerate(atoms)}
        key, order = _best([names[symbols[i]] for i in atoms], [symbols[i] for i in atoms], [[(at[j], o) for j, o in near[i]] for i in atoms])
        parts.append((key, [atoms[k] + 1 for k in order]))
    parts.sort()
    text = ".".join(",".join(s) + ";" + ",".join(f"{a}-{b}:{o}" for a, b, o in e) for (s, e), _ in parts)
    return [i for _, order in parts for i in order], text


def canonical_form(symbols: Column, bonds: Column) -> Column:
    """STRUCT<order ARRAY<INT>, key STRING> of a record: its canonical order and its identity key."""

    def forms(syms: pa.Array, edges: pa.Array) -> pa.Array:
        return pa.StructArray.from_arrays(list(bonded.canonical_forms(syms, edges, None, canonical)), names=["order", "key"])

    return _batchwise(forms, "order array<int>, key string", symbols, bonds)


def identity_key(symbols: Column, bonds: Column, order: Column | None = None) -> Column:
    """The identity key of a record; with ``order``, of the record with its atoms in that order, null where it is no order of them."""

    def keys(syms: pa.Array, edges: pa.Array, turned: pa.Array | None = None) -> pa.Array:
        return bonded.canonical_forms(syms, edges, turned, canonical)[1]

    return _batchwise(keys, "string", symbols, bonds, *([] if order is None else [order]))


def reordered(symbols: Column, bonds: Column, order: Column) -> tuple[Column, Column]:
    """(symbols, bonds) of a record with its atoms in the given order; bonds sorted."""
    place = lambda i: F.array_position(order, i.cast("int")).cast("int")
    moved = F.transform(bonds, lambda e: F.struct(
        F.least(place(e["a"]), place(e["b"])).alias("a"), F.greatest(place(e["a"]), place(e["b"])).alias("b"), e["order"].cast("int").alias("order")))
    return F.transform(order, lambda i: F.get(symbols, i - 1)), F.array_sort(moved)
