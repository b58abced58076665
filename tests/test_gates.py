"""Gates, ordering, outliers, statistics on small literal tables."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sparkcurate.operators import coverage, gates, mirror, ordering, outlier, stats
from sparkcurate import session
from sparkcurate.session import lookup_join
from sparkcurate.registry import GRAPH, REALSPACE, conform, missing_required, schema_of

GOOD = {"Energy_Ha": "-500.0", "FormalCharge": "0", "Multiplicity": "1", "SMILES": "CCO", "SourceID": "a",
        "HOMO_Ha": "1", "LUMO_Ha": "1", "HL_Gap_Ha": "1", "PartialCharges": "0 0"}


def test_contract(spark):
    rows = [
        ("good", GOOD), ("missing", {k: v for k, v in GOOD.items() if k != "Energy_Ha"}),
        ("types", GOOD | {"Energy_Ha": "not_a_number", "Multiplicity": "two"}), ("zero", GOOD | {"Multiplicity": "0"}),
        ("bare", {k: GOOD[k] for k in ("Energy_Ha", "FormalCharge", "Multiplicity")}), ("optional", GOOD | {"HOMO_Ha": "x"}),
        ("wide", GOOD | {"Multiplicity": "1" + "0" * 30}),
    ]
    df = spark.createDataFrame(rows, "id string, tags map<string,string>")
    strict = {r["id"]: r for r in gates.validate_tags(df).collect()}
    assert {k for k, r in strict.items() if r["contract_status"] == "rejected"} == {"missing", "types", "zero", "optional"}
    assert strict["missing"]["errors"] == ["Energy_Ha: missing (required)"]
    assert len(strict["types"]["errors"]) == 2 and len(strict["bare"]["warnings"]) == 6
    assert strict["zero"]["errors"] == ["Multiplicity: 0 is not a positive integer"]
    lenient = {r["id"]: r for r in gates.validate_tags(df, lenient=True).collect()}
    assert lenient["missing"]["contract_status"] == "passed" and lenient["missing"]["warnings"]
    assert lenient["optional"]["contract_status"] == "rejected"
    with pytest.raises(ValueError):
        gates.stop_on_rejects(gates.validate_tags(df).where("contract_status = 'rejected'"), "contract")


def test_scalar_filter_order_and_presets(spark):
    rows = [(1, ["H", "Xe"], 2, 0, 1), (2, ["H"], 1, 2, 1), (3, ["H"], 9, 0, 3), (4, ["H", "C"], 5, 0, 1)]
    df = spark.createDataFrame(rows, "id int, symbols array<string>, n_atoms int, charge int, multiplicity int")
    out = gates.scalar_filter(df, preset="neutral_closed_shell", elements=["H", "C"], min_atoms=1, max_atoms=8, charge_range=(-1, 1))
    got = {r["id"]: (r["filter_status"], r["filter_reason"]) for r in out.collect()}
    assert got == {1: ("rejected", "forbidden_elements:Xe"), 2: ("rejected", "charge=2>1"), 3: ("rejected", "n_atoms=9>8"), 4: ("ok", "")}
    kept, rejected = gates.divide(out, F.col("filter_status") == "ok", force_keep=True)
    assert kept.count() == 4 and rejected.count() == 3


def test_parsers():
    assert gates.parse_range("-1:2") == (-1, 2) and gates.parse_elements("c, CL,h") == ["C", "Cl", "H"]
    for bad in ("2:1", "a:b", "3"):
        with pytest.raises(ValueError):
            gates.parse_range(bad)
    for bad in ("C1", "", "Abc"):
        with pytest.raises(ValueError):
            gates.parse_elements(bad)
    with pytest.raises(ValueError):
        gates.resolve_ranges("odd")
    with pytest.raises(ValueError):
        gates.guard_threshold(0.01, 0.1, 5.0, "RMSD")


def test_exclude_rules(spark):
    df = spark.createDataFrame([("x", None), ("y", "rejected"), ("z", "ok")], "id string, s string")
    ids = lambda rules: sorted(r["id"] for r in gates.exclude_rules(df, rules).collect())
    assert ids(["s=rejected"]) == ["x", "z"] and ids(["s=None"]) == ["y", "z"]
    assert ids(["nope=rejected"]) == ["x", "y", "z"] and ids(["s=rejected", "s=ok"]) == ["x", "y"]
    assert ids(["nope="]) == [] and ids([" s = rejected ", "no rule"]) == ["x", "z"]


def test_run_anomalies(spark):
    rows = spark.createDataFrame(
        [("stereo", 10, 6, 2, 1, None, None, None, None), ("filter", 9, 9, 0, 0, 2, 1, None, None), ("validate", 9, 9, 0, 0, 0, 0, 4, None), ("energy", 9, 9, 0, 0, None, None, None, 0)],
        "stage string, total long, kept long, removed long, complexes long, mol_corrupt long, topology_warning long, id_repeats long, energy_positive long")
    got = {(r.stage, r.kind, r.n) for r in gates.run_anomalies(rows).collect()}
    assert got == {("stereo", "skipped_no_smiles", 1), ("filter", "non_ok_rows_kept", 3), ("validate", "id_repeats", 4)}


def test_funnel_counts_first_failure(spark):
    df = spark.createDataFrame([(1, "bad", "bad"), (2, "ok", "bad"), (3, "ok", "ok"), (4, None, "ok")], "id int, a string, b string")
    got = gates.funnel(df, [("A", F.col("a") == "bad"), ("B", F.col("b") == "bad")]).orderBy("step").collect()
    assert [(r["rejected"], r["passed"]) for r in got] == [(1, 3), (1, 2)]


def test_zero_spread_and_known_outlier(spark):
    flat = spark.createDataFrame([(1.0, 2.0)] * 3, "x double, y double")
    assert [r["z"] for r in outlier.label_outliers(flat, ["x"], "y", check_positive=False, score="z").collect()] == [0, 0, 0]
    rng = np.random.default_rng(0)
    x = rng.integers(0, 6, size=(60, 3)).astype(float)
    y = x @ [-40.0, -0.5, -75.0] + rng.normal(size=60) * 0.01
    y[7] -= 5
    z_ref = lambda r: 0.6745 * (r - np.median(r)) / np.median(np.abs(r - np.median(r)))
    beta = np.linalg.lstsq(np.column_stack([x, np.zeros(60)]), y, rcond=None)[0]
    want = z_ref(y - np.column_stack([x, np.zeros(60)]) @ beta)
    df = spark.createDataFrame([(i, *map(float, x[i]), 0.0, float(y[i])) for i in range(60)], "i int, a double, b double, c double, d double, y double")
    got = outlier.label_outliers(df, ["a", "b", "c", "d"], "y", score="z", check_positive=False).orderBy("i").collect()
    assert np.allclose([r["z"] for r in got], want, rtol=1e-5, atol=1e-6)
    assert [r["i"] for r in got if r["energy_status"] == "flagged_ols"] == [i for i in range(60) if abs(want[i]) > 3.5]


def test_outlier_statuses(spark):
    df = spark.createDataFrame([(1.0, -1.0, False), (1.0, 5.0, False), (1.0, None, False), (1.0, -1.0, True)], "x double, y double, bad boolean")
    got = [r["s"] for r in outlier.label_outliers(df, ["x"], "y", F.col("bad"), status="s").collect()]
    assert got == ["ok", "energy_positive", "energy_missing", "mol_corrupt"]
    assert {r["s"] for r in outlier.label_outliers(df, ["x"], "y", skip=True, status="s").collect()} == {"skipped"}


def test_exact_median_narrows(spark, monkeypatch):
    monkeypatch.setattr(outlier, "SMALL_BAND", 20)
    rng = np.random.default_rng(3)
    for n, heavy in ((1001, 0), (1000, 0), (999, 400)):
        v = np.concatenate([rng.normal(size=n - heavy), np.full(heavy, 0.25)])
        df = spark.createDataFrame([(float(x),) for x in v], "v double")
        assert outlier.exact_median(df, F.col("v")) == np.median(v)
    assert outlier.exact_median(spark.createDataFrame([], "v double"), F.col("v")) is None


def test_numbering_over_slices(spark):
    rows = [(i // 50, (i * 37) % 101) for i in range(150)]
    df = spark.createDataFrame([(a, b + 1000 * i) for i, (a, b) in enumerate(rows)], "a int, b int").repartition(7)
    got = ordering.number_rows(df, ["a", "b"], "n", slices=5).orderBy("a", "b").collect()
    assert [r["n"] for r in got] == list(range(1, 151))
    tot = ordering.running_total(df, ["a", "b"], F.col("b"), "t", slices=5).orderBy("a", "b").collect()
    assert [r["t"] for r in tot] == np.cumsum([r["b"] for r in tot]).tolist()
    batches = ordering.split_batches(df, ["a", "b"], 40).groupBy("batch_file").count().orderBy("batch_file").collect()
    assert [tuple(r) for r in batches] == [("batch_0000.parquet", 40), ("batch_0001.parquet", 40), ("batch_0002.parquet", 40), ("batch_0003.parquet", 30)]


def test_keep_first_null_keys(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, None)], "i int, k string").repartition(3)
    got = {r["i"]: r["status"] for r in ordering.keep_first(df, "k", ["i"]).collect()}
    assert got == {1: "kept", 2: "kept", 3: "duplicate", 4: "kept"}


def test_representative(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "kept"), (3, "a", "kept"), (4, None, "x")], "i int, k string, s string")
    got = ordering.choose_representative(df, "k", ["i"], F.col("s") == "kept").orderBy("output_at").collect()
    assert [(r["i"], r["output_at"]["i"]) for r in got] == [(3, 1), (2, 2), (4, 4)]


@pytest.mark.parametrize("hot", [5, 1000])
def test_lookup_join_salted_equals_broadcast(spark, monkeypatch, hot):
    monkeypatch.setattr(session, "HOT_ROWS", hot)
    big = spark.createDataFrame([(i % 3, i) for i in range(60)], "k int, v int")
    small = spark.createDataFrame([(0, "a"), (1, "b")], "k int, w string")
    rows = lambda d: sorted(map(str, d.select("k", "v", "w").collect()))
    for how in ("left", "inner"):
        assert rows(lookup_join(big, small, "k", how, max_rows=0)) == rows(lookup_join(big, small, "k", how))


def test_env_frequency_and_presence(spark):
    rows = [(0, [(10, "C"), (20, "N")]), (1, [(10, "O"), (10, "O"), (30, "O")]), (2, [])]
    df = spark.createDataFrame(rows, "i long, envs array<struct<env:long,element:string>>")
    got = {r["env_id"]: (r["element"], r["n_atoms"], r["n_mols"]) for r in coverage.env_frequency(df, "envs", "i").collect()}
    assert got == {10: ("O", 3, 2), 20: ("N", 1, 1), 30: ("O", 1, 1)}
    freq = coverage.env_frequency(df, "envs", "i")
    table = {r["env_id"]: (r["kind"], r["carriers"]) for r in coverage.choice_table(df, freq, "envs", "i", "i").collect()}
    assert table == {10: ("choice", "0;1"), 20: ("forced", "0"), 30: ("forced", "1")}
    thin = {r["env_id"]: (r["carrier_id"], r["covered"]) for r in coverage.thin_coverage(df, F.col("i") == 1, "envs", "i", "i").collect()}
    assert thin == {20: (0, False), 30: (1, True)}


def test_environments_read_in_tasks_equal_those_of_the_columns(spark):
    """Odd blanks, letters beyond one byte, one order for two records, null ids; a column of arrays and a text give one result."""
    from sparkcurate.functions import columns as C
    from sparkcurate.plans import queries, selection

    texts = ["a bb ccc", "\tbb\x0bbb \n\u00e9t\u00e9\u00a0x  dddd\f", "", None, "  ", "\U0001f600\U0001f600 a verylongword a", "a", "bb a"]
    docs = spark.createDataFrame([(min(i, 6), t, "en", "s", 0) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")
    made = queries.described(docs).select("doc_id", selection.instances().alias("envs")).cache()
    rows = lambda d: sorted(map(str, d.collect()))
    table = lambda d, e: [
        rows(coverage.env_frequency(d, e, "doc_id")), rows(coverage.coverage_report(d, F.col("doc_id") > 4, e)),
        rows(coverage.thin_coverage(d, F.col("doc_id") > 4, e, "doc_id", "doc_id")),
        rows(coverage.choice_table(d, coverage.env_frequency(d, e, "doc_id"), e, "doc_id", "doc_id", 2))]
    assert table(docs, queries.ENVS) == table(made, "envs")
    cut = docs.select("doc_id", C.neighbour_pairs(C.words("text")).alias("bonds"))
    assert rows(coverage.pair_counts(docs, queries.PAIRS)) == rows(coverage.pair_counts(cut))
    assert rows(coverage.pair_coverage(docs, F.col("doc_id") > 4, queries.PAIRS)) == rows(coverage.pair_coverage(cut, F.col("doc_id") > 4))
    flat = [(r.doc_id, i, e.env, e.element) for r in made.collect() for i, e in enumerate(r.envs or [])]
    freq = {r.env_id: (r.element, r.n_atoms) for r in coverage.env_frequency(docs, queries.ENVS, "doc_id").collect()}
    assert freq == {e: (max((o, i, n) for o, i, v, n in flat if v == e)[2], sum(v == e for _, _, v, _ in flat)) for e in {v for _, _, v, _ in flat}}
    nulls = spark.createDataFrame([(1, [(None, "C"), (None, "N")]), (2, [(None, None)])], "i long, envs array<struct<env:long,element:string>>")
    assert [tuple(r) for r in coverage.env_frequency(nulls, "envs", "i").collect()] == [(None, None, 3, 2)]


def test_block_of_instances_counts_like_plain_python():
    rng = np.random.default_rng(3)
    lists = [[{"env": int(v), "element": "CNO"[v % 3]} for v in rng.integers(0, 12, int(rng.integers(0, 9)))] for _ in range(40)]
    kind = pa.list_(pa.struct([("env", pa.int64()), ("element", pa.string())]))
    batch = pa.RecordBatch.from_arrays([pa.array(rng.permutation(40)), pa.array(lists, kind)], names=["o", "x"])
    b = coverage._Block(batch.slice(3), "envs")
    want = {}
    for r in lists[3:]:
        for v in {e["env"] for e in r}:
            n, m = want.get(v, (0, 0))
            want[v] = n + sum(e["env"] == v for e in r), m + 1
    assert {v: (n, m) for v, n, m in zip(b.ids.to_pylist(), b.n_atoms.tolist(), b.n_mols.tolist())} == want


def test_histogram_edges_and_divergence(spark):
    rng = np.random.default_rng(8)
    lo, hi = -1.3, 7.7
    edges = np.linspace(lo, hi, 51)
    vals = np.concatenate([rng.uniform(lo, hi, 500), [lo, hi, float("nan")], edges[:50]])
    df = spark.createDataFrame([(float(v), bool(i % 3 == 0)) for i, v in enumerate(vals)], "x double, s boolean")
    got = [r["n"] for r in stats.histogram(df, F.col("x")).orderBy("bin").collect()]
    ok = vals[np.isfinite(vals)]
    assert got == np.histogram(ok, bins=edges)[0].tolist()
    pa = np.histogram(ok, bins=edges)[0] / len(ok)
    sel = np.array([v for i, v in enumerate(vals) if i % 3 == 0 and np.isfinite(v)])
    pb = np.histogram(sel, bins=edges)[0] / len(sel)
    pa, pb = np.maximum(pa, 1e-12), np.maximum(pb, 1e-12)
    m = (pa + pb) / 2
    want = 0.5 * np.sum(pa * np.log2(pa / m)) + 0.5 * np.sum(pb * np.log2(pb / m))
    js = {r["property"]: r["js_divergence"] for r in stats.js_divergence(df, {"x": F.col("x"), "c": F.lit(1.0)}, F.col("s")).collect()}
    assert js["x"] == pytest.approx(want, abs=1e-12) and js["c"] == 0.0
    none = stats.js_divergence(df, {"x": F.col("x")}, F.lit(False)).first()
    assert np.isnan(none["js_divergence"])
    same = stats.js_divergence(df, {"x": F.col("x")}, F.lit(True)).first()
    assert abs(same["js_divergence"]) < 1e-6


def test_mirror_labels(spark):
    rows = [(1, "f", "R", "S"), (2, "f", "S", "R"), (3, "f", "R", "S"), (4, "f", "m", "m"), (5, "g", "S", "R"), (6, "h", None, None)]
    df = spark.createDataFrame(rows, "i int, flat string, key string, inv string")
    got = {r["i"]: (r["stereo_status"], r["in_pair"]) for r in mirror.stereo_labels(df, "flat", "key", "inv", "i", remove=True).collect()}
    assert got == {1: ("kept", True), 2: ("removed_enantiomer", True), 3: ("kept", True), 4: ("kept", False), 5: ("kept", False), 6: ("skipped_no_smiles", False)}
    kept = mirror.stereo_labels(df, "flat", "key", "inv", "i").where("stereo_status = 'removed_enantiomer'")
    assert kept.isEmpty()


def test_twins_and_bands(spark):
    df = spark.createDataFrame([("C@H",), ("C@@H",), ("N",), ("O",), ("O",)], "s string")
    got = {r["skeleton"]: r["kind"] for r in stats.twin_groups(df, F.col("s"), F.col("s")).collect()}
    assert got == {"CH": "stereo", "N": "singleton", "O": "identical"}


def test_conform(spark):
    df = spark.createDataFrame([(float("nan"), "1", 2.0)], "Energy_Ha double, num_atoms string, extra double")
    out = conform(df, GRAPH)
    row = out.first()
    assert row["Energy_Ha"] is None and row["num_atoms"] == 1 and row["extra"] == 2.0
    assert out.columns == [*GRAPH, "extra"] and conform(df, GRAPH, allow_extra=False).columns == list(GRAPH)
    assert "mol_block" in missing_required(df) and [f.name for f in schema_of(REALSPACE)] == list(REALSPACE)
