"""Column expressions against plain Python."""

import json
import struct
from random import Random

from pyspark.sql import functions as F

from sparkcurate.functions import columns as C, molblock
from sparkcurate.functions.elements import atomic_numbers


def one(spark, df_row, schema, col):
    return spark.createDataFrame([df_row], schema).select(col.alias("v")).first()["v"]


def test_thousandths_rounds_the_binary_value(spark):
    rng = Random(1)
    values = [0.7725, 0.7715, 0.0005, -0.0005, 0.772, 0.77249, 2.0005, 1.0015, 0.0625, 0.1875, -0.1875, 1234.5675, 0.0, -0.0, 1e-9]
    values += [rng.randint(-4_000_000, 4_000_000) / 2000 for _ in range(3000)]
    values += [rng.uniform(-3, 3) for _ in range(1000)]
    values += [struct.unpack("d", struct.pack("q", struct.unpack("q", struct.pack("d", k / 2000))[0] + s))[0] for k in range(1, 400) for s in (-1, 1)]
    got = spark.createDataFrame([(v,) for v in values], "x double").select("x", C.fixed3(C.thousandths("x")).alias("t")).collect()
    for r in got:
        assert r["t"] == f"{round(r['x'], 3) + 0.0:.3f}", r


def test_six_decimals_round_the_binary_value(spark):
    rng = Random(2)
    values = [0.0703125, -0.0703125, 5e-7, -5e-7, 1.5e-6, 0.9999995, -0.9999995, 0.0, -0.0, 1e300, -1e-300, 2.0**53 + 1]
    values += [sign * (whole + m / 128) for whole in (0, 3, 1000, 2**30 + 5) for m in range(1, 128, 2) for sign in (1, -1)]
    values += [(2 * rng.randrange(10**k) + 1) / 2e6 for k in range(1, 15) for _ in range(200)]
    values += [rng.uniform(-1, 1) * 10 ** rng.randrange(-8, 9) for _ in range(1000)]
    for r in spark.createDataFrame([(v,) for v in values], "x double").select("x", C.fixed6(F.col("x")).alias("t")).collect():
        if abs(r["x"]) < 2.0**53:
            assert r["t"] == f"{r['x']:.6f}", r


def test_geometry_key_golden(spark):
    rows = [
        ("g1", ["He", "H"], [[0.0, 0.0, 0.0], [0.772, 0.0, 0.0]], 1), ("g2", ["H", "He"], [[0.772, 0.0, 0.0], [0.0, 0.0, 0.0]], 1),
        ("low", ["He", "H"], [[0.0, 0.0, 0.0], [0.772 + 0.00049, 0.0, 0.0]], 1),
        ("off", ["He", "H"], [[0.0, 0.0, 0.0], [0.773, 0.0, 0.0]], 1),
        ("empty", [], [], 0), ("nan", ["H"], [[float("nan"), 0.0, 0.0]], 0), ("unknown", ["Xx"], [[0.0, 0.0, 0.0]], 0),
    ]
    df = spark.createDataFrame(rows, "id string, s array<string>, p array<array<double>>, q int")
    got = {r["id"]: r["k"] for r in df.select("id", C.geometry_key(atomic_numbers("s"), "p", "q", F.lit(1)).alias("k")).collect()}
    assert got["g1"] == got["g2"] == got["low"] == "98e3caa9339f0b4e832717e0921ca7d1"
    assert got["off"] != got["g1"]
    assert got["empty"] == "9b0fd3b850698317bef57fa6e71a38ba"
    assert got["nan"] is None and got["unknown"] is None


def test_hill_formula(spark):
    cases = {("C", "C", "O") + ("H",) * 6: "C2H6O", ("He", "H"): "HHe", ("Li",) * 4: "Li4", ("B", "B") + ("H",) * 6: "B2H6", (): ""}
    for syms, want in cases.items():
        assert one(spark, (list(syms),), "s array<string>", C.hill_formula("s")) == want
    assert one(spark, (["O", "H"],), "s array<string>", C.hill_formula("s", True)) == "HO"


def test_compound_key(spark):
    assert one(spark, ("CCO",), "s string", C.compound_key("s")) == "47029b0a89b677c61d67c3a1b1071f07"


def test_codecs(spark):
    assert one(spark, ("1.5 2 3\n\n4 5 6.25\n",), "s string", C.decode_coords("s")) == [[1.5, 2.0, 3.0], [4.0, 5.0, 6.25]]
    assert one(spark, ("1 2\n",), "s string", C.decode_coords("s")) is None
    assert one(spark, ("  ",), "s string", C.decode_charges("s")) is None
    header = {"b": 'x "y" \\ z', "a": "1"}
    text = one(spark, (header,), "h map<string,string>", C.encode_header("h"))
    assert text == json.dumps(header, sort_keys=True)
    assert one(spark, (text,), "s string", C.decode_header("s")) == header
    assert one(spark, (None,), "s string", C.decode_header("s")) == {}


def test_number_syntax(spark):
    for text, is_int, is_float in [("1", 1, 1), (" +1 ", 1, 1), ("1_0", 1, 1), ("1.0", 0, 1), ("nan", 0, 1), ("-inf", 0, 1), ("two", 0, 0), ("", 0, 0), ("1e5", 0, 1), (".5", 0, 1), ("_1", 0, 0)]:
        assert one(spark, (text,), "s string", C.parses_as_int("s")) == bool(is_int), text
        assert one(spark, (text,), "s string", C.parses_as_float("s")) == bool(is_float), text


def test_tanimoto(spark):
    for a, b, want in [([0, 1, 2], [2, 3], 0.25), ([1], [1], 1.0), ([1], [2], 0.0), ([], [], 0.0)]:
        assert one(spark, (a, b), "a array<int>, b array<int>", C.tanimoto("a", "b")) == want


BLOCK = "x\n\n\n  3  2  0  0  0  0  0  0  0  0999 V2000\n    0.0000    0.0000    0.0000 N   0  0\n    1.0000    0.0000    0.0000 H   0  0\n    0.0000    2.0000    0.0000 O   0  5\n  1  2  1  0\n  1  3  2  0\nM  CHG  2   1   1   3  -1\nM  END"


def test_block_fields(spark):
    assert one(spark, (BLOCK,), "b string", molblock.symbols("b")) == ["N", "H", "O"]
    assert one(spark, (BLOCK,), "b string", molblock.formal_charges("b")) == [1, 0, -1]
    assert one(spark, (BLOCK.replace("M  CHG  2   1   1   3  -1\n", ""),), "b string", molblock.formal_charges("b")) == [0, 0, -1]
    assert one(spark, (BLOCK,), "b string", molblock.heavy_coords("b")) == [[0, 0, 0], [0, 2, 0]]
    assert one(spark, (BLOCK,), "b string", molblock.bond_types(molblock.symbols("b"), molblock.bonds("b"))) == ["H-N:1", "N-O:2"]
    assert one(spark, (BLOCK,), "b string", molblock.atom_counts("b", ["N", "H", "C"])) == {"N": 1, "H": 1, "C": 0}


def test_corrupt_blocks(spark):
    bad = ["x\ny", "a\nb\nc\n\n", "a\nb\nc\nxx 2\n", "a\nb\nc\n-1 0\n", "a\nb\nc\n  9  0\n 0 0 0 C\n", "a\nb\nc\n  1  0\n 0 0\n"]
    for text in bad:
        assert one(spark, (text,), "b string", molblock.atom_counts("b", ["C"])) is None


def test_fragments_and_zwitterion(spark):
    def labels(n, edges):
        e = F.lit(None).cast("array<struct<a:int,b:int>>") if not edges else F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in edges])
        e = F.coalesce(e, F.expr("cast(array() as array<struct<a:int,b:int>>)"))
        return molblock.fragment_labels(F.lit(n), e), e

    lab, _ = labels(6, [(5, 6), (2, 4), (4, 5)])
    assert one(spark, (1,), "i int", lab) == [1, 2, 3, 2, 2, 2]
    cases = [
        ([1, -1], [(1, 2)], False),                       # bonded opposite charges
        ([1, -1], [], False),                             # two ions
        ([1, 0, -1], [(1, 2), (2, 3)], True),             # separated in one fragment
        ([1, 0], [(1, 2)], True),                         # no opposite charge anywhere
        ([0, 0], [(1, 2)], False),
    ]
    for q, edges, want in cases:
        lab, e = labels(len(q), edges)
        assert one(spark, (q,), "q array<int>", molblock.true_zwitterion(F.col("q"), e, lab)) is want, q


def test_on_bits_of_texts(spark):
    """Bits made for a batch of texts are those of the expressions."""
    from sparkcurate.functions import tokens

    texts = [None, "", "  \t\n", "a b  a\tb\x0bc\x0cd\r\né ß", "word " * 300, *(" ".join(f"w{i * k % 97}" for k in range(i)) for i in range(40))]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    rows = df.select(tokens.on_bits("text").alias("a"), C.on_bits(C.words("text")).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows) and rows[0]["a"] is None and rows[1]["a"] == []
