"""Environment frequency, carrier tables, coverage reports and pair counts.

A record carries an array of environments ``ARRAY<STRUCT<env BIGINT, element STRING>>``,
one entry per instance. Counting never collects the carriers of a common environment:
the instances of a block of records are folded to one row per environment inside the task
(:func:`folded`), and Spark sums these rows over all blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from ..session import lookup_join, stored

# Instances that are folded at once; a record with more is a block of its own.
BLOCK_INSTANCES = 1_000_000

# Carrier bands of the coverage report.
BANDS = [(1, 1, "1"), (2, 5, "2-5"), (6, 20, "6-20"), (21, 100, "21-100"), (101, None, ">100")]


def unfold(df: DataFrame, array: Column, name: str, *keep: Column | str) -> DataFrame:
    """One row per array entry.

    The outer form with a filter behind it: for the plain one the optimizer infers a filter
    on the array and pushes it below, which computes an expensive array a second time.
    """
    return df.select(F.explode_outer(array).alias(name), *keep).where(F.col(name).isNotNull())


@dataclass(frozen=True)
class Read:
    """Environments that tasks make from a text column; ``lists`` turns an array of texts into the arrays of
    (env, element). So they need not be made and carried as columns."""

    column: str
    lists: Callable[[pa.Array], pa.Array]


Envs = str | Read


def column(envs: Envs) -> str:
    """The column that environments are read from."""
    return envs.column if isinstance(envs, Read) else envs


def _blocks(batches: Iterator[pa.RecordBatch], envs: Envs) -> Iterator[pa.RecordBatch]:
    """Runs of records with about ``BLOCK_INSTANCES`` instances, four bytes of a text counted as one."""
    for batch in batches:
        x = batch.column("x")
        sizes = pc.binary_length(x) if isinstance(envs, Read) else pc.list_value_length(x)
        ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64))
        most, lo = BLOCK_INSTANCES * (4 if isinstance(envs, Read) else 1), 0
        while lo < len(ends):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi


def _rank(values: pa.Array) -> np.ndarray:
    """Dense ranks from 0, nulls first."""
    return pc.rank(values, sort_keys="ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64) - 1


def _sorted(*keys: np.ndarray) -> np.ndarray:
    """Order by the keys, the first one first; keys are not negative."""
    wide = [int(k.max(initial=0)) + 1 for k in keys]
    if np.prod([float(w) for w in wide]) >= 2.0**62:
        return np.lexsort(keys[::-1])
    one = keys[0].astype(np.int64)
    for k, w in zip(keys[1:], wide[1:], strict=True):
        one = one * w + k
    return np.argsort(one)


class _Block:
    """The instances of a block of records, sorted by environment, order of the record and place in it."""

    def __init__(self, batch: pa.RecordBatch, envs: Envs) -> None:
        lists = envs.lists(batch.column("x")) if isinstance(envs, Read) else batch.column("x")
        lens = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = lists.flatten()
        coded = pc.struct_field(flat, "env").dictionary_encode(null_encoding="encode")
        codes = coded.indices.to_numpy(zero_copy_only=False)
        rec = np.repeat(np.arange(len(batch)), lens)
        place = np.arange(len(rec)) - np.repeat(np.cumsum(lens) - lens, lens)
        self.rank = _rank(batch.column("o"))
        at = np.empty(len(batch), np.int64)
        at[np.argsort(self.rank, kind="stable")] = np.arange(len(batch))
        order = _sorted(codes, at[rec], place)
        self.codes, self.rec = codes[order], rec[order]
        names = pc.struct_field(flat, "element").dictionary_encode()
        self.names, self.named = names.dictionary, names.indices.take(pa.array(order))
        new = np.ones(len(order), dtype=bool)
        new[1:] = self.codes[1:] != self.codes[:-1]
        self.first = np.flatnonzero(new)
        end = np.r_[self.first[1:], len(order)][: len(self.first)] - 1
        self.n_atoms = end - self.first + 1
        # Each (environment, record) once.
        pair = new.copy()
        pair[1:] |= self.rec[1:] != self.rec[:-1]
        self.pairs = np.flatnonzero(pair)
        self.n_mols = np.add.reduceat(pair.astype(np.int64), self.first) if len(order) else np.zeros(0, np.int64)
        self.ids = coded.dictionary.take(pa.array(self.codes[self.first]))
        # The last instance; among records of one order the place decides.
        if len(order) and self.rank.max() + 1 < len(batch):
            end = _sorted(codes, self.rank[rec], place)[end]
        else:
            end = order[end]
        self.end_rec, self.end_place, self.end_name = rec[end], place[end], names.indices.take(pa.array(end))

    def most(self, per_record: np.ndarray) -> np.ndarray:
        """Per environment, the largest value of its records."""
        return np.maximum.reduceat(per_record[self.rec], self.first) if len(self.first) else np.zeros(0, np.int64)

    def elements(self) -> pa.Array:
        """Per environment, its distinct elements; null ones are left out."""
        kinds, sorted_ = len(self.names), pc.array_sort_indices(self.names)  # one order in all blocks
        at = np.empty(kinds + 1, np.int64)
        at[sorted_.to_numpy()], at[kinds] = np.arange(kinds), kinds
        at = at[pc.fill_null(self.named, kinds).to_numpy(zero_copy_only=False)]
        pairs = np.unique(self.codes.astype(np.int64) * (kinds + 1) + at)
        pairs = pairs[pairs % (kinds + 1) < kinds]
        bounds = np.searchsorted(pairs // (kinds + 1), self.codes[self.first])
        return pa.ListArray.from_arrays(pa.array(np.r_[bounds, len(pairs)], pa.int32()), self.names.take(sorted_).take(pa.array(pairs % (kinds + 1))))


def _source(envs: Envs) -> Column:
    return (F.col(column(envs)).cast("string") if isinstance(envs, Read) else F.col(envs)).alias("x")


def folded(df: DataFrame, envs: Envs, order: str, carrier: str | None = None, selected: Column | None = None, elements: bool = False) -> DataFrame:
    """One row per environment of a block of records: ``env, n`` (instances), ``m`` (carriers) and ``w``, the last
    instance (order, place, element).

    With ``selected`` also ``hit`` (a carrier is selected); with ``carrier`` the orders ``lo, hi`` of the
    first and last carrier, the last carrier's ``c`` and whether it is ``covered``; with ``elements`` all ``els``.
    """
    kind = dict(df.dtypes)
    schema = f"env bigint, n bigint, m bigint, w struct<o:{kind[order]},i:int,e:string>, hit boolean"
    schema += f", lo {kind[order]}, hi {kind[order]}, c {kind[carrier]}, covered boolean" if carrier else ""
    schema += ", els array<string>" if elements else ""
    flag = F.lit(False) if selected is None else F.coalesce(selected, F.lit(False))
    rows = df.select(F.col(order).alias("o"), flag.alias("s"), *([F.col(carrier).alias("c")] if carrier else []), _source(envs))

    def fold(batch: pa.RecordBatch) -> pa.RecordBatch:
        b, o = _Block(batch, envs), batch.column("o")
        s = batch.column("s").to_numpy(zero_copy_only=False).astype(np.int64)
        last = pa.StructArray.from_arrays(
            [o.take(pa.array(b.end_rec)), pa.array(b.end_place, pa.int32()), b.names.take(b.end_name)], names=["o", "i", "e"])
        out = {"env": b.ids, "n": pa.array(b.n_atoms, pa.int64()), "m": pa.array(b.n_mols, pa.int64()), "w": last, "hit": pa.array(b.most(s) > 0)}
        if carrier:
            # Records by order, then by carrier, as the largest of both names the carrier.
            by = np.lexsort((_rank(batch.column("c")), b.rank))
            at = np.empty(len(by), np.int64)
            at[by] = np.arange(len(by))
            out |= {"lo": o.take(pa.array(b.rec[b.first])), "hi": out["w"].field(0), "c": batch.column("c").take(pa.array(by[b.most(at)])),
                    "covered": pa.array(b.most(b.rank * 2 + s) % 2 == 1)}
        if elements:
            out["els"] = b.elements()
        return pa.RecordBatch.from_arrays(list(out.values()), names=list(out))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, envs):
            yield fold(batch)

    return rows.mapInArrow(run, schema)


def env_frequency(df: DataFrame, envs: Envs = "envs", order: str = "row_index") -> DataFrame:
    """Per environment: element of its last instance, instance count, carrier count."""
    return folded(df, envs, order).groupBy(F.col("env").alias("env_id")).agg(
        F.max("w")["e"].alias("element"), F.sum("n").alias("n_atoms"), F.sum("m").alias("n_mols"),
    )


def counted(df: DataFrame, envs: Envs, row_id: str) -> DataFrame:
    """``row, env_id, n``: the distinct environments of every record with their instances, counted in the task."""

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists = envs.lists(batch.column("x")) if isinstance(envs, Read) else batch.column("x")
        lens = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = pc.struct_field(lists.flatten(), "env").dictionary_encode(null_encoding="encode")
        kinds = max(1, len(coded.dictionary))
        keys, n = np.unique(np.repeat(np.arange(len(lens)), lens) * kinds + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
        rec, code = np.divmod(keys, kinds)
        return pa.RecordBatch.from_arrays(
            [batch.column("r").take(pa.array(rec)), coded.dictionary.take(pa.array(code)), pa.array(n, pa.int64())], names=["row", "env_id", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, envs):
            yield count(batch)

    return df.select(F.col(row_id).alias("r"), _source(envs)).mapInArrow(run, f"row {dict(df.dtypes)[row_id]}, env_id bigint, n bigint")


def rarity_order() -> list[str]:
    return ["n_mols", "n_atoms", "env_id"]


def rarest(freq: DataFrame, k: int) -> DataFrame:
    """The k rarest environments."""
    return freq.orderBy(*rarity_order()).limit(k)


def carriers(df: DataFrame, envs: str, row_id: str, extra: list[str] | None = None) -> DataFrame:
    """One row per (environment, carrying record); distinct inside the record, no shuffle."""
    distinct = F.array_distinct(F.transform(F.col(envs), lambda e: e["env"]))
    return unfold(df, distinct, "env_id", row_id, *(extra or []))


def rare_carriers(df: DataFrame, envs: Envs, row_id: str, order: str, most: int) -> DataFrame:
    """``env_id, o, c``: each (environment, carrying record) of the environments that at most ``most`` records carry.

    An environment with more carriers inside one block of records has too many already; others may come in
    part, so the result is joined to the counted environments.
    """
    kind = dict(df.dtypes)

    def few(batch: pa.RecordBatch) -> pa.RecordBatch:
        b = _Block(batch, envs)
        at = np.repeat(np.arange(len(b.first)), b.n_mols)
        keep = np.repeat(b.n_mols, b.n_mols) <= most
        rec = pa.array(b.rec[b.pairs[keep]])
        return pa.RecordBatch.from_arrays(
            [b.ids.take(pa.array(at[keep])), batch.column("o").take(rec), batch.column("c").take(rec)], names=["env_id", "o", "c"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, envs):
            yield few(batch)

    rows = df.select(F.col(order).alias("o"), F.col(row_id).cast("string").alias("c"), _source(envs))
    return rows.mapInArrow(run, f"env_id bigint, o {kind[order]}, c string")


def choice_table(
    df: DataFrame, freq: DataFrame, envs: Envs, row_id: str, order: str, max_carriers: int = 10
) -> DataFrame:
    """Environments with few carriers: forced (one) or choice, and the carriers in row order.

    Only environments within ``max_carriers`` reach the collecting aggregate, so a list
    never exceeds that bound.
    """
    few = stored(freq.where(F.col("n_mols") <= max_carriers))  # the join counts it before it reads it
    # Both sides are dealt by the environment, of which none has many rows: the most a block passes on is its bound.
    lists = rare_carriers(df, envs, row_id, order, max_carriers).join(few, "env_id").groupBy("env_id").agg(
        F.first("element").alias("element"),
        F.first("n_mols").alias("n_mols"),
        F.first("n_atoms").alias("n_atoms"),
        F.array_sort(F.collect_list(F.struct("o", "c"))).alias("l"),
    )
    return lists.select(
        "env_id", "element", "n_mols", "n_atoms",
        F.when(F.col("n_mols") == 1, "forced").otherwise("choice").alias("kind"),
        F.array_join(F.transform("l", lambda x: x["c"]), ";").alias("carriers"),
    )


def element_summary(freq: DataFrame, max_carriers: int = 10) -> DataFrame:
    """Per element the number and the carrier range of its rare environments."""
    return (
        freq.where(F.col("n_mols") <= max_carriers)
        .groupBy("element")
        .agg(F.count(F.lit(1)).alias("n_envs"), F.min("n_mols").alias("min_mols"), F.max("n_mols").alias("max_mols"))
        .orderBy("min_mols", "element")
    )


def coverage_report(df: DataFrame, selected: Column, envs: Envs = "envs") -> DataFrame:
    """Pool and selected environments per element and per carrier band.

    One scan and one aggregate of folded blocks give, per environment, its carriers, whether a
    selected record has it, and its elements (sets of them, at most as many as there are elements
    in sets); the report is counted from that table.
    """
    each = folded(df.withColumn("_o", F.monotonically_increasing_id()), envs, "_o", selected=selected, elements=True)
    per_env = each.groupBy("env").agg(
        F.sum("m").alias("n"), F.max(F.col("hit").cast("int")).alias("hit"), F.array_distinct(F.flatten(F.collect_set("els"))).alias("els")
    )
    band = F.coalesce(
        *[
            F.when((F.col("n") >= lo) & (F.lit(True) if hi is None else F.col("n") <= hi), name)
            for lo, hi, name in BANDS
        ]
    )
    pair = lambda d, k: F.struct(F.lit(d).alias("dimension"), k.alias("key"))
    keys = F.concat(F.transform("els", lambda e: pair("element", e)), F.array(pair("band", band)))
    return (
        unfold(per_env, keys, "k", "hit").groupBy("k.dimension", "k.key")
        .agg(F.count(F.lit(1)).alias("n_envs_pool"), F.sum("hit").cast("long").alias("n_envs_selected"))
        .withColumn("coverage", F.col("n_envs_selected") / F.col("n_envs_pool"))
    )


def thin_coverage(df: DataFrame, selected: Column, envs: Envs, row_id: str, order: str) -> DataFrame:
    """Environments with a single carrier, that carrier, and whether it is selected."""
    return (
        folded(df, envs, order, row_id, selected)
        .groupBy(F.col("env").alias("env_id"))
        .agg(
            F.min("lo").alias("lo"), F.max("hi").alias("hi"),
            F.max("w")["e"].alias("element"),
            F.max(F.struct("hi", "c"))["c"].alias("carrier_id"),
            F.max(F.struct("hi", "covered"))["covered"].alias("covered"),
        )
        .where("lo = hi")
        .select("env_id", "element", "carrier_id", "covered")
    )


def _pairs(df: DataFrame, pairs: Envs, selected: Column) -> DataFrame:
    """Rows ``bond, n, s`` of instances and selected instances; a block of texts is folded to one row per pair."""
    if not isinstance(pairs, Read):
        return unfold(df, F.col(pairs), "bond", selected.cast("long").alias("s")).select("bond", F.lit(1).alias("n"), "s")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _blocks(batches, pairs):
            lists = pairs.lists(batch.column("x"))
            coded, lens = lists.values, pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            at, names = coded.indices.to_numpy(), coded.dictionary
            s = np.repeat(batch.column("s").to_numpy(zero_copy_only=False), lens)
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(np.bincount(at, minlength=len(names)), pa.int64()), pa.array(np.bincount(at[s], minlength=len(names)), pa.int64())],
                names=["bond", "n", "s"])

    return df.select(selected.alias("s"), _source(pairs)).mapInArrow(run, "bond string, n bigint, s bigint")


def pair_counts(df: DataFrame, pairs: Envs = "bonds") -> DataFrame:
    return _pairs(df, pairs, F.lit(False)).groupBy("bond").agg(F.sum("n").cast("long").alias("n"))


def pair_coverage(df: DataFrame, selected: Column, pairs: Envs = "bonds") -> DataFrame:
    """Pool and selected instances of every pair type."""
    return (
        _pairs(df, pairs, F.coalesce(selected, F.lit(False)))
        .groupBy("bond")
        .agg(F.sum("n").cast("long").alias("pool_count"), F.sum("s").alias("selected_count"))
        .withColumn("coverage", F.col("selected_count") / F.col("pool_count"))
    )


def element_presence(df: DataFrame, elements: str) -> DataFrame:
    """Records that contain each element, and their share in percent."""
    total = df.agg(F.count(F.lit(1)).alias("total"))
    per = (
        unfold(df, F.array_distinct(elements), "element")
        .groupBy("element")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return per.withColumn("percent", F.col("n") * 100.0 / total.scalar())
