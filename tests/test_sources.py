"""Readers, writers and the two chains on small files."""

import json

import pytest
from pyspark.sql import functions as F

from sparkcurate import registry
from sparkcurate.chem import backend
from sparkcurate.functions import columns as C, molblock
from sparkcurate.operators import ordering
from sparkcurate.plans import convert, graph, realspace
from sparkcurate.sources import sdf, sinks, tables, xyz

HEH = "2\nProperties=species:S:1:pos:R:3 charge=1 multiplicity=1\nHe 0.0 0.0 0.0\nH 0.772 0.0 0.0\n"
CHARGED = '2\nProperties=species:S:1:pos:R:3:charge:R:1 note="a b"\nHe 0 0 0 0.3\nH 0.9 0 0 -0.3\n'
PLAIN = "2\nfree text, not pairs\nH 0 0 0\nH 0 0 0.74\n"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    d = tmp_path_factory.mktemp("xyz")
    files = {
        "a.xyz": HEH + "\n" + PLAIN, "b.xyz": "3\n\nH 0 0 0\nH 0 0 1\n", "c.xyz": HEH.replace("0.772", "0.773"),
        "d.xyz": HEH.replace("charge=1", "charge=1.5"), "e.xyz": HEH, "f.xyz": CHARGED, "g.xyz": "1\n\nXx 0 0 0\n", "n.txt": HEH,
    }
    for name, text in files.items():
        (d / name).write_text(text)
    return str(d)


def test_headers():
    assert xyz.header_of("a=1 b='x y'") == {"a": "1", "b": "x y"}
    assert xyz.header_of('a="1') == {"title": 'a="1'} and xyz.header_of("a=1 word") == {"title": "a=1 word"}
    assert xyz.header_of("  ") == {}


@pytest.mark.parametrize("text", [
    "x\n\n", "-1\n\n", "1\n", "1\n\n", "1\n\nH 0 0\n", "1\n\nH 0 0 z\n", "1\n\nH 0 0 inf\n", "1\nProperties=pos:R:3\n0 0 0\n",
    "1\nProperties=species:S:1:pos:R\nH 0 0 0\n", "1\nProperties=species:S:1:pos:R:2\nH 0 0\n", "1\nProperties=species:S:0:pos:R:3\n0 0 0\n",
])
def test_malformed_frames(text):
    with pytest.raises(xyz.FrameError):
        list(xyz.frames_of(text))


def test_large_files_line_by_line(spark, folder, tmp_path):
    """The same rows whether a file is one value or is read by lines, also cut into several splits."""
    key = lambda r: (r.source_file, -1 if r.source_index is None else r.source_index)
    want = sorted(xyz.read_xyz(spark, folder).collect(), key=key)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40")
    try:
        got = sorted(xyz.read_xyz(spark, folder, value_bytes=0).collect(), key=key)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [(*key(r), r.symbols, r.coords, r.charges, r.header, r.error) for r in got] == [(*key(r), r.symbols, r.coords, r.charges, r.header, r.error) for r in want]
    many = tmp_path / "many.xyz"
    many.write_text((HEH + PLAIN) * 700)
    (tmp_path / "bad.xyz").write_text(HEH * 1500 + "x")
    rows = xyz.read_xyz(spark, str(tmp_path), value_bytes=0).collect()
    assert sorted(r.source_index for r in rows if r.source_file == "many.xyz") == list(range(1400))
    assert [r.source_index for r in rows if r.source_file == "bad.xyz"] == [None]


@pytest.mark.parametrize(("block", "split"), [(1, "1000000"), (3, "37"), (100_000, "37")])
def test_both_readers_agree_on_the_same_bytes(spark, tmp_path, monkeypatch, block, split):
    """Blocks and splits of any size, equal names in two folders, all line ends, odd names, every kind of error."""
    frame = "2\n{}\nH 0 0 0\nHe 0 0 {}\n"
    texts = {
        "a/x.xyz": frame.format("one", 1) + frame.format("", 2), "b/x.xyz": "\n \n" + frame.format("two", 3) * 9 + "\n\n0\n\n0\nlast\n",
        "c/u.xyz": frame.format("x\u2028y", 1), "c/f.xyz": frame.format("x", 1).replace("\n", "\x0c"), "c/cr.xyz": frame.format("x", 1).replace("\n", "\r\n") * 3,
        "c/a b+c%20.xyz": frame.format("q", 5), "c/one.xyz": "1\nk=v\nH 1 2 3", "c/none.xyz": "", "c/blank.xyz": "\n\n \n", "c/ints.xyz": "3\n3\nH 1 1 1\nH 2 2 2\nH 3 3 3\n" * 5,
        "d/short.xyz": frame.format("x", 1) * 3 + "4\n\nH 0 0 0\n", "d/word.xyz": frame.format("x", 1) + "two\n" + frame.format("x", 1), "d/minus.xyz": "-1\n\n",
        "d/comment.xyz": frame.format("x", 1) + "1", "d/number.xyz": frame.format("x", 1) + frame.format("x", "nan") + "bad\n", "d/wide.xyz": frame.format("x", "1 2"), "d/end.xyz": "0\x0b",
    }
    for name, text in texts.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(text.encode())
    (tmp_path / "d/bytes.xyz").write_bytes(b"x\n1\n\xff\n")
    key = lambda r: repr((r.source_file, r.source_index, r.symbols, r.coords, r.charges, r.header, r.error))
    folders = str(tmp_path / "*")
    want = sorted(map(key, xyz.read_xyz(spark, folders).collect()))
    monkeypatch.setattr(xyz, "BLOCK_LINES", block)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        got = sorted(map(key, xyz.read_xyz(spark, folders, value_bytes=0).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == want and len(want) > 30


def test_extra_columns_are_ignored():
    got = list(xyz.frames_of("1\nProperties=species:S:1:mass:R:2:pos:R:3\nH 9 9 1 2 3\n\n\n0\n\n"))
    assert got[0][:3] == (["H"], [[1.0, 2.0, 3.0]], None) and got[1][0] == []


def test_realspace_chain(spark, folder):
    out = realspace.run(xyz.read_xyz(spark, folder), elements=["H", "He"])
    rejects = {r["source_id"]: r["source_index"] for r in out["ingest_rejects"].collect()}
    assert rejects == {"b.xyz": None, "d.xyz:0": 0, "g.xyz:0": 0}
    kept = {r["source_id"]: r["cluster_id"] for r in out["rows"].collect()}
    assert kept == {"a.xyz:0": 1, "a.xyz:1": 2, "f.xyz:0": 3}
    dups = {r["source_id"]: (r["dedup_status"], r["cluster_id"]) for r in out["dedup_rejects"].collect()}
    assert dups == {"c.xyz:0": ("near_dup", 1), "e.xyz:0": ("exact_dup", 1)}
    text = {r["source_id"]: r["frame"] for r in out["frames"].collect()}
    again = list(xyz.frames_of(text["f.xyz:0"]))[0]
    assert again[0] == ["He", "H"] and again[2] == [0.3, -0.3] and again[3]["source_file"] == "f.xyz" and "note" not in again[3]


def test_text_codecs_round_trip(spark, folder):
    rows, _ = realspace.ingest(xyz.read_xyz(spark, folder))
    back = realspace.from_text_columns(realspace.to_text_columns(rows))
    pick = lambda d: sorted(map(str, d.select("source_id", "symbols", "coords", "charges").collect()))
    assert pick(back) == pick(rows)


def test_written_titles_and_quotes(spark):
    df = spark.createDataFrame([({"title": "plain words"},), ({"k": "a b"},), ({"title": "t", "k": "v"},)], "h map<string,string>")
    got = {r["c"] for r in df.select(xyz.comment_line(F.col("h")).alias("c")).collect()}
    base = "Properties=species:S:1:pos:R:3"
    assert "plain words" in got and f'{base} k="a b"' in got and len(got) == 3


def record(name, energy="-1.5", extra=""):
    block = f"{name}\n\n\n  2  1  0  0  0  0  0  0  0  0999 V2000\n    0.0000    0.0000    0.0000 C   0  0\n    1.2000    0.0000    0.0000 O   0  0\n  1  2  2  0\nM  END"
    return f"{block}\n>  <Energy_Ha>\n{energy}\n\n> <FormalCharge>\n0\n\n>  <Multiplicity>\n1\n\n>  <SourceID>\n{name}\n\n{extra}$$$$\n"


@pytest.fixture(scope="module")
def sdf_file(tmp_path_factory):
    p = tmp_path_factory.mktemp("sdf") / "in.sdf"
    p.write_text(record("m1", extra=">  <SMILES>\nC=O\n\n>  <SMILES>\nO=C\n\n") + "broken\n$$$$\n" + record("m2", "-2.5"))
    return str(p)


def test_sdf_scan(spark, sdf_file):
    rows = sdf.read_sdf(spark, sdf_file).orderBy("row_index").collect()
    assert [r["parsed"] for r in rows] == [True, False, True]
    assert rows[0]["tags"]["SMILES"] == "O=C" and rows[1]["tags"] == {} and rows[1]["mol_block"] is None
    got = sdf.extract_rows(sdf.read_sdf(spark, sdf_file)).orderBy("SourceID").collect()
    assert [(r["SourceID"], r["Energy_Ha"], r["num_atoms"], r["num_bonds"], r["SMILES"]) for r in got] == [("m1", -1.5, 2, 1, "O=C"), ("m2", -2.5, 2, 1, None)]
    assert sdf.count_records(spark, sdf_file).first()["n"] == 3


def test_sdf_round_trip(spark, sdf_file, tmp_path):
    rows = sdf.extract_rows(sdf.read_sdf(spark, sdf_file)).drop("row_index", "batch_file")
    sinks.write_sdf(sinks.sdf_text(rows, "too small"), str(tmp_path / "out"))
    again = sdf.read_sdf(spark, str(tmp_path / "out"))
    assert {r["tags"]["reject_reason"] for r in again.collect()} == {"too small"}
    pick = lambda d: sorted(map(str, d.select("mol_block", "Energy_Ha", "SMILES").collect()))
    assert pick(sdf.extract_rows(again)) == pick(rows)


def test_batches_and_sinks(spark, tmp_path):
    df = ordering.split_batches(spark.range(25).withColumn("Energy_Ha", F.col("id").cast("double")), ["id"], 10)
    sinks.write_batches(df, str(tmp_path / "b"))
    back = tables.read_batches(spark, str(tmp_path / "b"))
    assert back.count() == 25 and back.select("batch_file").distinct().count() == 3 and back.columns[0] == "Energy_Ha"
    sinks.write_rejects(df.where("id < 3"), str(tmp_path / "r"), "02")
    sinks.write_rejects(df.where("id > 20"), str(tmp_path / "r"), "03")
    assert {(r["stage"], r["count"]) for r in spark.read.parquet(str(tmp_path / "r")).groupBy("stage").count().collect()} == {(2, 3), (3, 4)}
    sinks.write_frames(df.select(F.col("id").cast("string").alias("frame"), "batch_file", "row_index"), str(tmp_path / "f"))
    assert spark.read.text(str(tmp_path / "f")).count() == 25
    sinks.write_report(df.groupBy("batch_file").count(), str(tmp_path / "c"))
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).columns == ["batch_file", "count"]
    assert sinks.mark(spark, str(tmp_path / "m"), "rejected", 2) and not sinks.mark(spark, str(tmp_path / "m"), "flagged", 0)
    for stage in ("01", "02"):
        sinks.record_run(spark, str(tmp_path / "p"), "graph", stage, {"batch_size": 10}, {"n": 25})
    runs = spark.read.json(str(tmp_path / "p")).collect()
    assert {r["stage"] for r in runs} == {"01", "02"} and json.loads(runs[0]["params"]) == {"batch_size": 10}


def test_converter(spark):
    main = spark.createDataFrame([("z1", "CO", -1.0, 1.0, 2.0, 3.0, "ok"), ("z2", "C", -1.0, 1.0, 2.0, 3.0, "ok"), ("z3", "C", -1.0, 1.0, 2.0, 3.0, "flagged_ols"), ("z4", "O", -2.0, 1.0, 2.0, 3.0, "ok")],
                                 "Zinc_id string, smile string, `Internal_E(0K)` double, HOMO double, LUMO double, HL_gap double, energy_status string")
    atoms = spark.createDataFrame([("z1", 1, "O", 1.0, 0.0, 0.0, -0.5), ("z1", 0, "C", 0.0, 0.0, 0.0, -1.0), ("z3", 0, "C", 0.0, 0.0, 0.0, 0.0), ("z4", 0, "O", 0.0, 0.0, 0.0, 2.5)],
                                  "Zinc_id string, pos int, atom string, final_x double, final_y double, final_z double, charge double")
    bonds = spark.createDataFrame([("z1", 1, 2)], "Zinc_id string, atom1 int, atom2 int")
    got = {r["SourceID"]: r for r in convert.atom_bond_records(main, atoms, bonds).collect()}
    assert set(got) == {"z1", "z4"} and got["z1"]["FormalCharge"] == -2 and got["z4"]["FormalCharge"] == 2
    assert got["z1"]["Energy_Ha"] == "-1.00000000" and got["z1"]["PartialCharges"] == "-1.000000 -0.500000"
    assert "  1  2  1  0" in got["z1"]["mol_block"] and " C   0" in got["z1"]["mol_block"].split("\n")[4]


def test_large_record_keeps_all_atoms(spark):
    """Beyond 999 entries a block is written and read in the V3000 form."""
    main = spark.createDataFrame([("z", "C", -1.0, 1.0, 2.0, 3.0)], "Zinc_id string, smile string, `Internal_E(0K)` double, HOMO double, LUMO double, HL_gap double")
    n = 1500
    atoms = spark.createDataFrame([("z", i, "CNO"[i % 3], i * 1.0, 0.5, -0.25, 0.0) for i in range(n)],
                                  "Zinc_id string, pos int, atom string, final_x double, final_y double, final_z double, charge double")
    bonds = spark.createDataFrame([("z", i, i + 1) for i in range(1, n)], "Zinc_id string, atom1 int, atom2 int")
    got = convert.atom_bond_records(main, atoms, bonds)
    row = got.select(
        "mol_block", molblock.n_atoms("mol_block").alias("n"), F.size(molblock.bonds("mol_block")).alias("b"), molblock.symbols("mol_block").alias("s"),
        molblock.coords("mol_block").alias("p"), F.get(molblock.bonds("mol_block"), F.lit(700)).alias("e"), molblock.formal_charges("mol_block").alias("q")).first()
    assert "V3000" in row.mol_block and (row.n, row.b) == (n, n - 1)
    assert row.s == ["CNO"[i % 3] for i in range(n)] and row.p[1234] == [1234.0, 0.5, -0.25]
    assert (row.e.a, row.e.b, row.e.order) == (701, 702, 1) and row.q == [0] * n
    charged = row.mol_block.replace("M  V30 3 O 2.0000 0.5000 -0.2500 0", "M  V30 3 O 2.0000 0.5000 -0.2500 0 CHG=-1")
    q = spark.createDataFrame([(charged,)], "b string").select(molblock.formal_charges("b").alias("q")).first().q
    assert q[2] == -1 and sum(map(abs, q)) == 1


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("last", [True, False])
def test_line_ends_and_last_record(spark, tmp_path, end, last):
    body = record("a") + record("") + record("c")
    body = body if last else body.removesuffix("\n")
    (tmp_path / "x.sdf").write_bytes(body.replace("\n", end).encode())
    rows = sdf.read_sdf(spark, str(tmp_path)).orderBy("row_index").collect()
    assert len(rows) == 3 and all(r.parsed for r in rows)
    assert [r.mol_block.split("\n")[0] for r in rows] == ["a", "", "c"] and all("\r" not in r.mol_block for r in rows)
    assert [r.tags["SourceID"] for r in rows] == ["a", "", "c"] and all(r.tags["Energy_Ha"] == "-1.5" for r in rows)
    assert sdf.count_records(spark, str(tmp_path)).first().n == 3


def test_bad_values_do_not_end_the_job(spark, tmp_path):
    good = record("g")
    wide = record("w", extra=">  <FormalCharge>\n3000000000\n\n")
    (tmp_path / "a.sdf").write_bytes((good + wide).encode() + b"bad \xff\xfe bytes\n$$$$\n" + good.encode())
    rows = sdf.read_sdf(spark, str(tmp_path))
    assert sorted(r.parsed for r in rows.collect()) == [False, True, True, True]
    got = sdf.extract_rows(rows.select("mol_block", "tags", "parsed")).collect()
    assert len(got) == 3 and sum(r.FormalCharge is None for r in got) >= 1
    assert [r.reject_reason for r in sdf.wide_tags(rows).collect()] == ["FormalCharge out of range: 3000000000"]
    head = spark.createDataFrame([("1e12",), ("1",), ("nan",), ("1.5",), ("x",), ("-inf",)], "v string").select("v", F.create_map(F.lit("charge"), "v").alias("h"))
    value, reason = xyz.header_int(F.col("h"), "charge", 0)
    found = {r.v: (r.x, r.y) for r in head.select("v", value.alias("x"), reason.alias("y")).collect()}
    assert found["1"] == (1, None) and all(found[v][0] is None and found[v][1] for v in ("1e12", "nan", "1.5", "x", "-inf"))
    (tmp_path / "f.xyz").write_bytes(b"1\n\nH 0 0 0\n")
    (tmp_path / "g.xyz").write_bytes(b"1\n\xff\nH 0 0 0\n")
    got = {r.source_file: r.error for r in xyz.read_xyz(spark, str(tmp_path)).collect()}
    assert got["f.xyz"] is None and "UTF-8" in got["g.xyz"]


def test_conform_keeps_going(spark):
    df = spark.createDataFrame([("1.5", "2", "x"), ("abc", "3", "y")], "Energy_Ha string, FormalCharge string, extra string")
    rows = registry.conform(df, registry.GRAPH).collect()
    assert [r.Energy_Ha for r in rows] == [1.5, None] and rows[0].asDict().keys() >= {"AtropisomerKey", "dedup_reason", "extra"}
    assert [r.reject_reason for r in registry.unreadable(df, registry.GRAPH).collect()] == ["not readable: Energy_Ha"]


def test_summary_converter(spark, tmp_path):
    (tmp_path / "s" / "C1").mkdir(parents=True)
    (tmp_path / "s" / "C1" / "conf_00.sdf").write_text(record("x"))
    cols = "chembl_id string, conf_id string, smiles string, DFT_TOTAL_ENERGY double, DFT_HOMO_ENERGY double, DFT_LUMO_ENERGY double, DFT_HOMO_LUMO_GAP double"
    summary = spark.createDataFrame([("C1", "conf_00", "C=O", -1.0, 0.1, 0.2, 0.1), ("C1", "conf_01", "C=O", -1.0, 0.1, 0.2, 0.1)], cols)
    got = convert.summary_records(spark, summary, str(tmp_path / "s")).collect()
    assert [r["SourceID"] for r in got] == ["C1_conf_00"] and got[0]["mol_block"].endswith("M  END")
    assert convert.summary_records(spark, summary, str(tmp_path / "s"), sample=1).count() == 1


def test_graph_chain(spark, tmp_path):
    names = [f"m{i:02d}" for i in range(12)]
    text = "".join(record(n, str(-100 - 0.001 * i if i != 5 else -900), f">  <SMILES>\nC=O{i % 3}\n\n") for i, n in enumerate(names))
    (tmp_path / "in.sdf").write_text(text)
    rec = sdf.read_sdf(spark, str(tmp_path / "in.sdf")).withColumns({
        "canonical": F.element_at("tags", F.lit("SMILES")), "flat": F.element_at("tags", F.lit("SMILES")),
        "inverse": F.element_at("tags", F.lit("SMILES")), "n_radicals": F.lit(0),
    })
    out = graph.run(rec, ["row_index"], graph.Options(allowed_elements=["C", "O"], max_fragments=1))
    assert [r["SourceID"] for r in out["energy_rejects"].collect()] == ["m05"]
    kept = out["rows"].collect()
    assert len(kept) == 3 and out["conformer_rejects"].count() == 8
    # The lowest energy of each compound stays.
    assert {r["SourceID"] for r in kept} == {"m09", "m10", "m11"}
    frame = out["frames"].first()["frame"].split("\n")
    assert frame[0] == "2" and frame[1].startswith("SourceID,m") and "CNSO,2" in frame[1] and "Formula,CO" in frame[1]
    assert frame[2] == "C   0.000000  0.000000  0.000000"
    assert graph.status_funnel(out["rows"]).count() == 5


def test_recipes_and_steps():
    assert {k: o.family for k, o in graph.RECIPES.items()} == {"qm40": "QM40", "qmugs": "QMUGS"}
    listed = graph.steps(graph.Options(rmsd_threshold=0.5, preset="neutral", batch_size=7))
    assert [name for name, _ in listed] == ["contract", "split", "energy_prefilter", "chemistry_gate", "identify", "integrity", "stereo", "conformers", "extxyz"]
    settings = dict(listed)
    assert settings["split"] == {"batch_size": 7} and settings["conformers"]["rmsd_threshold"] == 0.5 and settings["chemistry_gate"]["checks"] == ["charge"]
    for name, values in listed:
        assert callable(getattr(graph, name)) and values is not None


def test_run_record_keeps_scheduler_variables(spark, tmp_path, monkeypatch):
    import json

    monkeypatch.setenv("SLURM_JOB_ID", "17")
    monkeypatch.setenv("OMP_NUM_THREADS", "2")
    monkeypatch.delenv("SLURM_NTASKS", raising=False)
    for stage in ("a", "b"):
        sinks.record_run(spark, str(tmp_path / "runs"), "p", stage, {"x": 1}, {"rows": 2})
    got = spark.read.json(str(tmp_path / "runs")).orderBy("stage").collect()
    assert [r.stage for r in got] == ["a", "b"]
    kept = json.loads(got[0].environment)
    assert kept["SLURM_JOB_ID"] == "17" and kept["OMP_NUM_THREADS"] == "2" and "SLURM_NTASKS" not in kept
    assert json.loads(got[0].argv) and got[0].cwd


@pytest.mark.skipif(backend.Chem is not None, reason="toolkit present")
def test_toolkit_is_required(spark):
    with pytest.raises(backend.BackendUnavailable):
        backend.canonical_smiles("SMILES")
    with pytest.raises(NotImplementedError):
        backend.soap()


def test_descriptor_rows(spark):
    from sparkcurate.functions.elements import rare_elements
    from sparkcurate.plans import selection

    block = record("x").split("\n>")[0]
    rows = [("a", 0, block), ("a", 1, block), ("b", 2, block.replace(" O   0", " S   0")), ("c", 3, "broken")]
    df = spark.createDataFrame(rows, "CompoundID string, no int, mol_block string").withColumns({
        "CanonicalSMILES": F.lit(None).cast("string"), "SMILES": F.lit("C=O"), "Energy_Ha": F.lit(-1.0), "morgan_fp": F.array(F.lit(1)),
        "atom_envs": F.array(F.array(F.lit(1).cast("bigint"))), "scaffold": F.lit(None).cast("string"), "tpsa": F.lit(1.0),
    })
    out, counts = selection.describe(df, ["no"], allowed=["C", "O"])
    got = out.collect()
    assert [(r["CompoundID"], r["formula"], r["nat_heavy"], r["bonds"]) for r in got] == [("a", "CO", 2, ["C-O:2"])]
    assert got[0]["molwt"] == pytest.approx(28.01) and got[0]["smiles"] == "C=O"
    assert {r["key"]: r["n"] for r in counts.collect()} == {"in": 1, "element:S": 1}
    assert df.select(rare_elements(F.array(F.lit("S"), F.lit("C"), F.lit("S"))).alias("r")).first()["r"] == ["S"]
    with pytest.raises(ValueError):
        selection.describe(df, ["no"], allowed=["Qq"])


def test_records_are_parsed_once(spark):
    """A filter on the result is not pushed below the parsing: the plan cuts each block into lines twice, for atoms and bonds."""
    good = "t\n\n\n  1  0  0  0  0  0  0  0  0  0999 V2000\n    0.0000    0.0000    0.0000 C   0  0\nM  END\n>  <Energy_Ha>\n-1.5\n\n"
    df = spark.createDataFrame([(1, good), (2, "t\n\n\n  9  0\nM  END\n"), (3, None)], "id int, value string").repartition(2)
    parsed = sdf.parse_records(df)
    got = {r.id: (r.parsed, r.num_atoms, r.num_bonds, r.mol_block is None, r.tags) for r in parsed.collect()}
    assert got == {1: (True, 1, 0, False, {"Energy_Ha": "-1.5"}), 2: (False, None, None, True, {}), 3: (False, None, None, True, {})}
    rows = sdf.extract_rows(parsed)
    assert [(r.id, r.num_atoms, r.num_bonds, r.Energy_Ha) for r in rows.collect()] == [(1, 1, 0, -1.5)]
    assert rows._jdf.queryExecution().optimizedPlan().toString().count("M  V30 COUNTS") <= 2
