"""Element symbols and atomic numbers as Spark map literals."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Element symbols in order of atomic number, 1 to 118.
SYMBOLS = """
H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr
Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb
Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U Np Pu Am Cm Bk Cf Es Fm Md No Lr Rf
Db Sg Bh Hs Mt Ds Rg Cn Nh Fl Mc Lv Ts Og
""".split()

# Standard atomic weights of the elements that have one.
WEIGHTS = {
    "H": 1.008, "He": 4.003, "Li": 6.941, "Be": 9.012, "B": 10.812, "C": 12.011, "N": 14.007, "O": 15.999,
    "F": 18.998, "Ne": 20.180, "Na": 22.990, "Mg": 24.305, "Al": 26.982, "Si": 28.086, "P": 30.974, "S": 32.067,
    "Cl": 35.453, "Ar": 39.948, "K": 39.098, "Ca": 40.078, "Sc": 44.956, "Ti": 47.867, "V": 50.942,
    "Cr": 51.996, "Mn": 54.938, "Fe": 55.845, "Co": 58.933, "Ni": 58.693, "Cu": 63.546, "Zn": 65.39,
    "Ga": 69.723, "Ge": 72.61, "As": 74.922, "Se": 78.96, "Br": 79.904, "Kr": 83.80, "Rb": 85.468, "Sr": 87.62,
    "Y": 88.906, "Zr": 91.224, "Nb": 92.906, "Mo": 95.94, "Ru": 101.07, "Rh": 102.906, "Pd": 106.42,
    "Ag": 107.868, "Cd": 112.412, "In": 114.818, "Sn": 118.711, "Sb": 121.760, "Te": 127.60, "I": 126.904,
    "Xe": 131.29, "Cs": 132.905, "Ba": 137.328, "La": 138.906, "Ce": 140.116, "Pr": 140.908, "Nd": 144.24,
    "Sm": 150.36, "Eu": 151.964, "Gd": 157.25, "Tb": 158.925, "Dy": 162.50, "Ho": 164.930, "Er": 167.26,
    "Tm": 168.934, "Yb": 173.04, "Lu": 174.967, "Hf": 178.49, "Ta": 180.948, "W": 183.84, "Re": 186.207,
    "Os": 190.23, "Ir": 192.217, "Pt": 195.078, "Au": 196.967, "Hg": 200.59, "Tl": 204.383, "Pb": 207.2,
    "Bi": 208.980, "Th": 232.038, "Pa": 231.036, "U": 238.029,
}

# Default atom types of the energy fit.
FIT_ELEMENTS = ["C", "H", "N", "O", "S", "F", "Cl", "Br", "P", "I"]

# Elements counted as CNSO, and rare elements reported for skipped rows.
CNSO = ["C", "N", "S", "O"]
RARE = ["S", "F", "Cl", "P", "Si", "Br", "I"]


def _map(pairs) -> Column:
    flat = [F.lit(v) for kv in pairs for v in kv]
    return F.create_map(*flat)


def atomic_numbers(symbols: Column | str) -> Column:
    """ARRAY<STRING> of symbols to ARRAY<INT>; an unknown symbol gives a null entry."""
    symbols = F.col(symbols) if isinstance(symbols, str) else symbols
    table = F.array(*[F.lit(s) for s in SYMBOLS])

    def number(s: Column) -> Column:
        at = F.array_position(table, s).cast("int")
        return F.when(at > 0, at)

    return F.transform(symbols, number)


def weight_sum(symbols: Column | str) -> Column:
    """Sum of atomic weights; null when a symbol has none listed."""
    symbols = F.col(symbols) if isinstance(symbols, str) else symbols
    table = _map(WEIGHTS.items())
    return F.aggregate(symbols, F.lit(0.0), lambda acc, s: acc + table[s])


def rare_elements(symbols: Column | str) -> Column:
    """The rare elements among the symbols of a record that could not be described."""
    symbols = F.col(symbols) if isinstance(symbols, str) else symbols
    return F.array_sort(F.array_intersect(F.array_distinct(symbols), F.array(*[F.lit(s) for s in RARE])))
