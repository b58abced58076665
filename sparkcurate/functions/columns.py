"""Column expressions: null handling, text codecs, formulas, keys and set similarity.

Everything here stays inside the JVM; no function in this module uses a Python UDF.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, functions as F

# Number syntaxes accepted by the tag contract.
INT_SYNTAX = r"^\s*[+-]?\d+(_\d+)*\s*$"
FLOAT_SYNTAX = (
    r"^\s*[+-]?((\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?"
    r"|(?i:inf|infinity|nan))\s*$"
)


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with the value computed once.

    A Column used inside a lambda is computed again for every element; a lambda variable
    is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


# -- nulls ---------------------------------------------------------------------


def nan_to_null(c: Column | str) -> Column:
    """NaN and NULL mean the same missing value in this data model."""
    c = col(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def as_float(c: Column | str) -> Column:
    """Double or null; unparseable and NaN text become null."""
    return nan_to_null(col(c).cast("string").try_cast("double"))


def parses_as_int(c: Column | str) -> Column:
    return F.coalesce(col(c).rlike(INT_SYNTAX), F.lit(False))


def parses_as_float(c: Column | str) -> Column:
    return F.coalesce(col(c).rlike(FLOAT_SYNTAX), F.lit(False))


def int_value(c: Column | str) -> Column:
    return F.regexp_replace(F.trim(col(c)), "_", "").try_cast("bigint")


# -- exact decimal rounding ----------------------------------------------------


def thousandths(x: Column | str) -> Column:
    """Round a double to 1e-3 and return the integer number of thousandths.

    The rounding looks at the exact binary value (ties, which are real ties only when
    the binary value is exactly half way, go to even). ``round`` and ``bround`` work
    on the shortest decimal text instead and differ for values such as 0.7725. Away
    from a tie plain arithmetic is exact enough; near one the fraction is scaled by a
    power of two, which loses nothing, and compared in integer decimals.
    """
    x = col(x).cast("double")
    a = F.abs(x)
    scaled = a * 1000.0
    low = F.floor(scaled)
    near_tie = F.abs(scaled - low - 0.5) < 1e-4
    whole = F.floor(a)
    frac = a - whole
    shift = F.when(frac < 0.5, F.lit(2.0**63)).otherwise(F.lit(2.0**62))
    unit = F.when(frac < 0.5, F.lit(str(2**63)).cast("decimal(20,0)")).otherwise(
        F.lit(str(2**62)).cast("decimal(20,0)")
    )
    scaled_frac = (frac * shift).cast("bigint").cast("decimal(20,0)")
    milli = (scaled_frac * F.lit(1000).cast("decimal(4,0)")).cast("decimal(25,0)")
    steps = low - whole * 1000
    rest2 = (milli - steps.cast("decimal(4,0)") * unit) * F.lit(2).cast("decimal(1,0)")
    up = (rest2 > unit) | ((rest2 == unit) & (low % 2 == 1))
    tied = low + F.when(up, 1).otherwise(0)
    plain = F.floor(scaled + 0.5)
    mag = F.when(near_tie, tied).otherwise(plain).cast("bigint")
    return F.when(x < 0, -mag).otherwise(mag)


def fixed3(thousandth: Column) -> Column:
    """Integer thousandths to ``%.3f`` text; zero never carries a sign."""
    mag = F.abs(thousandth)
    return F.concat(
        F.when(thousandth < 0, F.lit("-")).otherwise(F.lit("")),
        F.floor(mag / 1000).cast("string"),
        F.lit("."),
        F.lpad((mag % 1000).cast("string"), 3, "0"),
    )


def fixed6(x: Column) -> Column:
    """``%.6f`` of the exact binary value; real ties go to even.

    The JVM rounds the shortest decimal text half up, which differs where that text ends in a 5 behind the sixth
    decimal. There the fraction is scaled by a power of two, which loses nothing, and compared in integer decimals.
    """
    x = x.cast("double")
    a = F.abs(x)
    scaled = (a % 1) * 1e6
    near_tie = F.abs(scaled % 1 - 0.5) < 1e-6 + a * 1e-9  # wider than half the spacing of doubles there

    def text(s: Column) -> Column:
        # Bits of a fraction this near to a tie end at 2**-73, of one above 2**-10 at 2**-62.
        small = s["frac"] < 2.0**-10
        bits = (s["frac"] * F.when(small, F.lit(2.0**73)).otherwise(F.lit(2.0**62))).cast("bigint").cast("decimal(20,0)")
        unit = F.when(small, F.lit(str(2**73)).cast("decimal(23,0)")).otherwise(F.lit(str(2**62)).cast("decimal(23,0)"))
        twice = (bits * F.lit(2_000_000).cast("decimal(7,0)")).cast("decimal(30,0)")
        half = ((s["low"] * 2 + 1).cast("decimal(7,0)") * unit).cast("decimal(30,0)")
        up = (twice > half) | ((twice == half) & (s["low"] % 2 == 1))
        return let(
            s["whole"] * 1_000_000 + s["low"] + F.when(up, 1).otherwise(0),
            lambda n: F.concat(F.floor(n / 1_000_000).cast("string"), F.lit("."), F.lpad((n % 1_000_000).cast("string"), 6, "0")),
        )

    # The millionths of values below 2**43 fit; above, the JVM's text stays.
    parts = F.struct(F.floor(a).alias("whole"), (a % 1).alias("frac"), F.floor(scaled).alias("low"))
    exact = F.concat(F.when(x < 0, "-").otherwise(""), let(parts, text))
    return F.when(near_tie & (a < 2.0**43), exact).otherwise(F.format_string("%.6f", x))


# -- codecs --------------------------------------------------------------------


def encode_coords(coords: Column | str) -> Column:
    """ARRAY<ARRAY<DOUBLE>> to one ``x y z`` line of six decimals per atom."""
    return F.array_join(
        F.transform(col(coords), lambda p: F.array_join(F.transform(p, fixed6), " ")), "\n"
    )


def decode_coords(text: Column | str) -> Column:
    """Inverse of :func:`encode_coords`; null when a line is not three numbers."""
    lines = F.filter(F.split(col(text), r"\r?\n"), lambda s: F.trim(s) != "")
    rows = F.transform(
        lines, lambda s: F.transform(F.split(F.trim(s), r"\s+"), lambda v: v.try_cast("double"))
    )
    bad = F.exists(rows, lambda r: (F.size(r) != 3) | F.exists(r, lambda v: v.isNull()))
    return F.when(~bad, rows)


def encode_words(values: Column | str) -> Column:
    return F.array_join(col(values), " ")


def decode_words(text: Column | str) -> Column:
    return F.filter(F.split(F.trim(col(text)), r"\s+"), lambda s: s != "")


def encode_charges(values: Column | str) -> Column:
    return F.array_join(F.transform(col(values), fixed6), " ")


def decode_charges(text: Column | str) -> Column:
    t = F.trim(col(text))
    values = F.transform(F.split(t, r"\s+"), lambda v: v.try_cast("double"))
    return F.when(t.isNotNull() & (t != ""), values)


def encode_header(header: Column | str) -> Column:
    """MAP<STRING,STRING> to JSON text with sorted keys and ``", "``/``": "`` separators."""
    pairs = F.array_sort(F.map_entries(col(header)))
    quoted = F.transform(
        pairs,
        lambda e: F.concat(json_string(e["key"]), F.lit(": "), json_string(e["value"])),
    )
    return F.concat(F.lit("{"), F.array_join(quoted, ", "), F.lit("}"))


def json_string(s: Column) -> Column:
    """A JSON string literal of ``s`` (quote, backslash and control characters escaped)."""
    body = F.to_json(F.struct(s.alias("v")))
    return F.substr(body, F.lit(6), F.length(body) - 6)


def decode_header(text: Column | str) -> Column:
    t = F.trim(col(text))
    empty = F.expr("cast(map() as map<string,string>)")
    return F.when(t.isNull() | (t == ""), empty).otherwise(F.from_json(t, "map<string,string>"))


# -- formulas and keys ---------------------------------------------------------


def hill_formula(symbols: Column | str, carbon_first_always: bool = False) -> Column:
    """Hill formula: carbon first, then hydrogen if there is carbon, the rest by name.

    ``carbon_first_always`` puts hydrogen in front even without carbon, the form used
    for fragment formulas.
    """

    def formula(syms: Column) -> Column:
        has_c = F.lit(True) if carbon_first_always else F.array_contains(syms, "C")

        def entry(s: Column) -> Column:
            rank = F.when(has_c & (s == "C"), 0).when(has_c & (s == "H"), 1).otherwise(2)
            return F.struct(rank.alias("r"), s.alias("s"), F.size(F.filter(syms, lambda t: t == s)).alias("n"))

        ordered = F.array_sort(F.transform(F.array_distinct(syms), entry))
        return F.array_join(
            F.transform(ordered, lambda e: F.concat(e["s"], F.when(e["n"] == 1, "").otherwise(e["n"].cast("string")))), ""
        )

    return let(col(symbols), formula)


def compound_key(canonical: Column | str, axis: Column | str | None = None) -> Column:
    """MD5 of the canonical text, extended by an axis key when there is one."""
    canonical = col(canonical)
    if axis is None:
        return F.md5(canonical)
    axis = col(axis)
    return F.md5(
        F.when(F.coalesce(axis, F.lit("")) == "", canonical).otherwise(F.concat_ws("|", canonical, axis))
    )


def geometry_key(
    atomic_numbers: Column | str, coords: Column | str, charge: Column | str, multiplicity: Column | str
) -> Column:
    """MD5 of the sorted ``Z:x:y:z`` atoms (three decimals) and ``|charge|multiplicity``.

    Null when shapes differ, an atom has no number or a coordinate is not finite.
    """
    def text(s: Column) -> Column:
        atoms = F.zip_with(
            s["z"], s["p"],
            lambda z, p: F.struct(
                z.cast("int").alias("z"), thousandths(p[0]).alias("a"), thousandths(p[1]).alias("b"), thousandths(p[2]).alias("c")
            ),
        )
        good = (
            (F.size(s["z"]) == F.size(s["p"]))
            & ~F.exists(s["z"], lambda z: z.isNull())
            & F.forall(s["p"], lambda p: (F.size(p) == 3) & F.forall(p, is_finite))
        )
        shown = F.transform(
            F.array_sort(atoms),
            lambda t: F.concat_ws(":", t["z"].cast("string"), fixed3(t["a"]), fixed3(t["b"]), fixed3(t["c"])),
        )
        return F.when(good, F.array_join(shown, ";"))

    whole = lambda c: F.concat(F.lit("|"), col(c).cast("bigint").cast("string"))
    body = let(F.struct(col(atomic_numbers).alias("z"), col(coords).alias("p")), text)
    return F.md5(F.concat(body, whole(charge), whole(multiplicity)))


def is_finite(x: Column) -> Column:
    return F.coalesce(
        ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)
    )


def strip_chirality(smiles: Column | str) -> Column:
    return F.regexp_replace(col(smiles), "@+", "")


# -- sets ----------------------------------------------------------------------


def tanimoto(a: Column | str, b: Column | str) -> Column:
    """Shared over joined size of two duplicate-free arrays; 0 when both are empty."""
    a, b = col(a), col(b)
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union > 0, both / union).otherwise(F.lit(0.0))


def on_bits(tokens: Column | str, nbits: int = 2048) -> Column:
    """Sorted distinct bit numbers of hashed tokens."""
    return F.array_sort(
        F.array_distinct(F.transform(col(tokens), lambda t: (feature_id(t) % nbits).cast("int")))
    )


def feature_id(token: Column | str) -> Column:
    """Unsigned 32-bit id of a feature text, as BIGINT."""
    return F.conv(F.substring(F.md5(col(token)), 1, 8), 16, 10).cast("bigint")


def words(text: Column | str) -> Column:
    return F.filter(F.split(col(text), r"\s+"), lambda s: s != "")


def neighbour_pairs(tokens: Column | str) -> Column:
    """Each adjacent token pair as ``a-b`` with its two ends sorted."""
    t = col(tokens)
    return F.when(
        F.size(t) > 1,
        F.zip_with(
            F.slice(t, F.lit(1), F.size(t) - 1),
            F.slice(t, F.lit(2), F.size(t) - 1),
            lambda a, b: F.concat_ws("-", F.least(a, b), F.greatest(a, b)),
        ),
    ).otherwise(F.expr("cast(array() as array<string>)"))


def text_list(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]) if values else F.expr("cast(array() as array<string>)")
