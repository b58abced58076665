"""V2000 and V3000 connection tables read and written with Column expressions.

A V2000 block counts up to 999 atoms and bonds in fixed-width fields; larger records are
written and read in the V3000 form. Every array built here belongs to one record.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from .columns import col, let

# Limits and field widths of the V2000 format.
MAX_ATOMS = 999
BOND_ORDER_NAMES = {1: "1", 2: "2", 3: "3", 4: "ar"}
CHARGE_CODES = {1: 3, 2: 2, 3: 1, 5: -1, 6: -2, 7: -3}


def _fields(line: Column) -> Column:
    return F.split(F.btrim(line, F.lit(" \t\r")), r"\s+")


def _plain_lines(lines: Column) -> Column:
    """The lines with a V3000 table turned into the same fields in V2000 order.

    Atoms and bonds become blank-separated fields; the counts line holds both counts.
    """
    inside = lambda tag: F.slice(
        lines, F.greatest(F.array_position(lines, f"M  V30 BEGIN {tag}"), F.lit(1)) + 1,
        F.greatest(F.array_position(lines, f"M  V30 END {tag}") - F.array_position(lines, f"M  V30 BEGIN {tag}") - 1, F.lit(0)),
    )
    charge = lambda v: F.regexp_extract(v, r" CHG=(-?\d+)", 1)

    def atom(f: Column) -> Column:
        return F.concat_ws(" ", F.get(f, F.lit(4)), F.get(f, F.lit(5)), F.get(f, F.lit(6)), F.get(f, F.lit(3)), F.lit("0 0"))

    def bond(f: Column) -> Column:
        return F.concat_ws(" ", F.get(f, F.lit(4)), F.get(f, F.lit(5)), F.get(f, F.lit(3)), F.lit("0"))

    counts = F.get(F.filter(lines, lambda v: v.startswith("M  V30 COUNTS ")), F.lit(0))
    charged = F.filter(F.transform(inside("ATOM"), lambda v, i: F.when(charge(v) != "", F.concat(F.lit("M  CHG  1 "), (i + 1).cast("string"), F.lit(" "), charge(v)))), lambda v: v.isNotNull())
    plain = F.concat(
        F.slice(lines, 1, 3), F.array(F.array_join(F.slice(_fields(counts), 4, 2), " ")),
        F.transform(inside("ATOM"), lambda v: atom(_fields(v))), F.transform(inside("BOND"), lambda v: bond(_fields(v))), charged,
    )
    return F.when(F.get(lines, F.lit(3)).contains("V3000"), plain).otherwise(lines)


def _with_lines(block: Column | str, body: Callable[[Column], Column]) -> Column:
    """``body`` of a struct with the lines ``l``, the declared atom count ``n`` and ``wide``: fields are not
    in fixed columns."""

    def counted(s: Column) -> Column:
        first = F.get(_fields(F.get(s["l"], F.lit(3))), F.lit(0))
        n = F.when(first.rlike(r"^[+-]?\d+$"), first.try_cast("int"))
        return let(F.struct(s["l"].alias("l"), n.alias("n"), s["wide"].alias("wide")), body)

    read = lambda lines: F.struct(_plain_lines(lines).alias("l"), F.get(lines, F.lit(3)).contains("V3000").alias("wide"))
    return let(let(F.split(col(block), "\n"), read), counted)


def atom_rows(block: Column | str) -> Column:
    """ARRAY of whitespace-split atom lines; null for a corrupt block.

    Corrupt means: fewer than four lines, an empty counts line, a count that is no
    integer, a count that is negative or runs past the text, or a short atom line.
    """

    def rows(s: Column) -> Column:
        usable = s["n"].isNotNull() & (s["n"] >= 0) & (F.size(s["l"]) >= 4 + s["n"])
        got = F.when(usable, F.transform(F.slice(s["l"], F.lit(5), F.greatest(s["n"], F.lit(0))), _fields))
        return let(got, lambda g: F.when(~F.exists(g, lambda r: F.size(r) < 4), g))

    return _with_lines(block, rows)


def _point(row: Column) -> Column:
    return F.transform(F.slice(row, 1, 3), lambda v: v.try_cast("double"))


def symbols(block: Column | str) -> Column:
    return F.transform(atom_rows(block), lambda r: F.get(r, F.lit(3)))


def coords(block: Column | str) -> Column:
    return F.transform(atom_rows(block), _point)


def atom_counts(block: Column | str, elements: list[str]) -> Column:
    """MAP of element to count for the listed elements; null for a corrupt block."""
    names = list(dict.fromkeys(elements))

    def counts(syms: Column) -> Column:
        number = lambda e: F.size(F.filter(syms, lambda s: s == e))
        return F.when(syms.isNotNull(), F.create_map(*[x for e in names for x in (F.lit(e), number(e))]))

    return let(symbols(block), counts)


def n_atoms(block: Column | str) -> Column:
    return F.size(atom_rows(block))


def bonds(block: Column | str) -> Column:
    """ARRAY<STRUCT<a,b,order>> with 1-based atom numbers, from the fixed-width bond lines."""
    def parse(s: Column) -> Column:
        def field(row: Column, k: int) -> Column:
            text = F.when(s["wide"], F.get(_fields(row), F.lit(k))).otherwise(F.trim(F.substring(row, 3 * k + 1, 3)))
            return text.try_cast("int")

        declared = field(F.get(s["l"], F.lit(3)), 1)
        rows = F.slice(s["l"], F.greatest(s["n"], F.lit(0)) + 5, F.greatest(declared, F.lit(0)))
        parsed = F.transform(
            rows, lambda r: F.struct(field(r, 0).alias("a"), field(r, 1).alias("b"), field(r, 2).alias("order"))
        )
        enough = F.size(s["l"]) >= 4 + s["n"] + declared
        broken = lambda e: e["a"].isNull() | e["b"].isNull() | e["order"].isNull()
        return let(parsed, lambda p: F.when(enough & ~F.exists(p, broken), p))

    return _with_lines(block, parse)


def formal_charges(block: Column | str) -> Column:
    """ARRAY<INT> of formal charges: ``M  CHG`` entries, else the charge codes of the atoms."""
    codes = F.create_map(*[F.lit(x) for kv in CHARGE_CODES.items() for x in kv])

    def listed(s: Column) -> Column:
        lines = F.filter(s["b"], lambda v: v.startswith("M  CHG"))
        # Fields: M CHG count, then atom and charge in turn, to the end of the line.
        tail = F.flatten(F.transform(lines, lambda v: F.slice(_fields(v), F.lit(4), F.length(v))))
        numbers = F.transform(tail, lambda v: v.try_cast("int"))

        def pick(m: Column) -> Column:
            atoms = F.filter(m["v"], lambda _, i: i % 2 == 0)
            charges = F.filter(m["v"], lambda _, i: i % 2 == 1)
            given = lambda at: F.get(charges, at - 1)
            by_list = F.transform(
                s["r"],
                lambda _, i: F.when(F.array_contains(atoms, i + 1), given(F.array_position(atoms, i + 1).cast("int"))).otherwise(0),
            )
            by_code = F.transform(s["r"], lambda r: F.coalesce(codes[F.get(r, F.lit(5)).try_cast("int")], F.lit(0)))
            return F.when(F.size(m["v"]) > 0, by_list).otherwise(by_code)

        return let(F.struct(numbers.alias("v")), pick)

    return let(F.struct(_with_lines(block, lambda s: s["l"]).alias("b"), atom_rows(block).alias("r")), listed)


def heavy_coords(block: Column | str) -> Column:
    """Coordinates without hydrogens; null for a corrupt block."""
    return F.transform(F.filter(atom_rows(block), lambda r: F.get(r, F.lit(3)) != "H"), _point)


def fragment_labels(n: Column, edges: Column) -> Column:
    """Component label of each atom: the smallest atom number it is connected to.

    Every bond merges two labels over the bounded atom array; one pass over the bonds
    is enough, because a merge relabels the whole component at once.
    """
    start = F.when(n > 0, F.sequence(F.lit(1), F.greatest(n, F.lit(1)))).otherwise(
        F.expr("cast(array() as array<int>)")
    )

    def merge(labels: Column, e: Column) -> Column:
        ends = F.struct(F.get(labels, e["a"] - 1).alias("x"), F.get(labels, e["b"] - 1).alias("y"))
        return let(
            ends,
            lambda t: F.transform(labels, lambda v: F.when(v == F.greatest(t["x"], t["y"]), F.least(t["x"], t["y"])).otherwise(v)),
        )

    return F.aggregate(edges, start, merge)


def fragment_count(labels: Column) -> Column:
    return F.size(F.array_distinct(labels))


def bond_types(syms: Column, edges: Column) -> Column:
    """Sorted ``A-B:order`` texts of all bonds, the two symbols in name order."""
    names = F.create_map(*[F.lit(x) for kv in BOND_ORDER_NAMES.items() for x in kv])

    def labels(s: Column) -> Column:
        def label(e: Column) -> Column:
            a, b = F.get(s["s"], e["a"] - 1), F.get(s["s"], e["b"] - 1)
            order = F.coalesce(names[e["order"]], e["order"].cast("string"))
            return F.concat(F.least(a, b), F.lit("-"), F.greatest(a, b), F.lit(":"), order)

        return F.array_sort(F.transform(s["e"], label))

    return let(F.struct(syms.alias("s"), edges.alias("e")), labels)


def true_zwitterion(charges: Column, edges: Column, labels: Column) -> Column:
    """True when charge is separated inside one fragment without a bond between the ends.

    A charged atom bonded to an opposite charge is a polar bond and is passed over. Of
    the others, one counts if an opposite charge sits in its fragment, or if there is
    no opposite charge in the whole record.
    """

    def found(s: Column) -> Column:
        charge_at = lambda number: F.get(s["q"], number - 1)
        idx = F.transform(s["q"], lambda q, i: F.struct(q.alias("q"), (i + 1).alias("i")))

        def counts(atom: Column) -> Column:
            bonded = F.exists(
                s["e"],
                lambda e: ((e["a"] == atom["i"]) & (charge_at(e["b"]) * atom["q"] < 0))
                | ((e["b"] == atom["i"]) & (charge_at(e["a"]) * atom["q"] < 0)),
            )
            opposite = lambda o: o["q"] * atom["q"] < 0
            own = F.get(s["l"], atom["i"] - 1)
            inside = F.exists(idx, lambda o: opposite(o) & (F.get(s["l"], o["i"] - 1) == own))
            return (atom["q"] != 0) & ~bonded & (inside | ~F.exists(idx, opposite))

        return F.exists(idx, counts)

    return let(F.struct(charges.alias("q"), edges.alias("e"), labels.alias("l")), found)


def build_block(title: Column, syms: Column, xyz: Column, edges: Column) -> Column:
    """V2000 text of atoms, coordinates and 1-based bonds, V3000 beyond its 999 entries; null when
    symbols and coordinates differ in number."""
    num = lambda v: F.lpad(F.format_string("%.4f", v.cast("double")), 10, " ")
    w3 = lambda v: F.lpad(v.cast("string"), 3, " ")

    def text(s: Column) -> Column:
        atoms = F.zip_with(
            s["s"], s["p"],
            lambda a, p: F.concat(
                num(p[0]), num(p[1]), num(p[2]), F.lit(" "), F.rpad(a, 3, " "), F.lit(" 0"), F.lit("  0" * 11)
            ),
        )
        links = F.transform(s["e"], lambda e: F.concat(w3(e["a"]), w3(e["b"]), w3(e["order"]), F.lit("  0")))
        counts = F.concat(w3(F.size(s["s"])), w3(F.size(s["e"])), F.lit("  0  0  0  0  0  0  0  0999 V2000"))
        head = F.array(title, F.lit("     sparkcurate"), F.lit(""), counts)
        fits = (F.size(s["s"]) <= MAX_ATOMS) & (F.size(s["e"]) <= MAX_ATOMS)
        v30 = lambda *parts: F.concat(F.lit("M  V30 "), *parts)
        place = lambda v: F.format_string("%.4f", v.cast("double"))
        text = lambda v: v.cast("string")
        blank = F.lit(" ")
        wide_atoms = F.transform(
            F.arrays_zip(s["s"].alias("s"), s["p"].alias("p")),
            lambda a, i: v30(text(i + 1), blank, a["s"], blank, place(a["p"][0]), blank, place(a["p"][1]), blank, place(a["p"][2]), F.lit(" 0")))
        wide_links = F.transform(s["e"], lambda e, i: v30(text(i + 1), blank, text(e["order"]), blank, text(e["a"]), blank, text(e["b"])))
        wide = F.concat(
            F.array(title, F.lit("     sparkcurate"), F.lit(""), F.lit("  0  0  0     0  0            999 V3000"), v30(F.lit("BEGIN CTAB")),
                    v30(F.lit("COUNTS "), text(F.size(s["s"])), blank, text(F.size(s["e"])), F.lit(" 0 0 0")), v30(F.lit("BEGIN ATOM"))),
            wide_atoms, F.array(v30(F.lit("END ATOM")), v30(F.lit("BEGIN BOND"))), wide_links,
            F.array(v30(F.lit("END BOND")), v30(F.lit("END CTAB")), F.lit("M  END")))
        narrow = F.concat(head, atoms, links, F.array(F.lit("M  END")))
        return F.when(F.size(s["s"]) == F.size(s["p"]), F.array_join(F.when(fits, narrow).otherwise(wide), "\n"))

    return let(F.struct(syms.alias("s"), xyz.alias("p"), edges.alias("e")), text)
