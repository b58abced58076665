"""Geometry track: frames to rows, exact and near-duplicate identity, filter, delivery.

Rows keep their arrays between the steps; text codecs are applied at the sinks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import columns as C
from ..functions.elements import atomic_numbers
from ..functions.geometry import permuted_rmsd
from ..operators import gates
from ..operators.leader import near_dedup
from ..operators.ordering import number_rows
from ..session import checkpointed
from ..sources.xyz import comment_line, frame_text, header_int

# Default threshold and its limits; tags of a delivered frame, in order.
NEAR_DUP = 0.25
NEAR_DUP_LIMITS = (0.1, 5.0)
DELIVERY_TAGS = ["geometry_id", "charge", "multiplicity", "elements", "source_id", "source_file", "source_index"]


def ingest(frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of parsed frames.

    A file that did not parse is one reject under its bare name; a frame with a bad charge,
    multiplicity or element is a reject under ``file:index``.
    """
    charge, bad_charge = header_int(F.col("header"), "charge", 0)
    mult, bad_mult = header_int(F.col("header"), "multiplicity", 1)
    zs = atomic_numbers("symbols")
    unknown = F.filter("symbols", lambda s: ~F.array_contains(F.array(*[F.lit(x) for x in _symbols()]), s))
    reason = F.coalesce(
        F.col("error"), bad_charge, bad_mult,
        F.when(F.size(unknown) > 0, F.concat(F.lit("unknown element symbol: '"), F.get(unknown, F.lit(0)), F.lit("'"))),
    )
    df = frames.withColumns({
        "reason": reason, "charge": charge, "multiplicity": mult, "n_atoms": F.size("symbols"),
        "source_id": F.when(F.col("source_index").isNull(), F.col("source_file")).otherwise(
            F.concat_ws(":", "source_file", F.col("source_index").cast("string"))
        ),
    })
    rejects = df.where("reason is not null").select("source_id", "source_file", "source_index", "reason")
    rows = df.where("reason is null").drop("reason", "error")
    rows = rows.withColumns({
        "geometry_id": C.geometry_key(zs, "coords", "charge", "multiplicity"), "formula": C.hill_formula("symbols"),
    })
    return rows, rejects


def _symbols() -> list[str]:
    from ..functions.elements import SYMBOLS

    return SYMBOLS


def atoms_payload(symbols: str = "symbols", coords: str = "coords") -> Column:
    """ARRAY of ``[Z, x, y, z]`` for the permutation-aware RMSD."""
    return F.zip_with(
        atomic_numbers(symbols), F.col(coords),
        lambda z, p: F.array(z.cast("double"), p[0].cast("double"), p[1].cast("double"), p[2].cast("double")),
    )


def identity(
    rows: DataFrame, threshold: float = NEAR_DUP, order: tuple[str, ...] = ("source_file", "source_index"), **sizes: int
) -> DataFrame:
    """Add ``dedup_status`` (kept, exact_dup, near_dup, error), ``cluster_id`` and ``reason``.

    Keys and formulas are computed again from the geometry. Exact copies of a key are
    settled first by one aggregate; only the first copies are compared by RMSD, inside
    their (formula, charge, multiplicity) group; copies inherit the cluster of the first.
    """
    gates.guard_threshold(threshold, *NEAR_DUP_LIMITS, "near-duplicate")
    key = C.geometry_key(atomic_numbers("symbols"), "coords", "charge", "multiplicity")
    base = number_rows(rows, list(order), "_row")
    base = base.withColumns({"geometry_id": key, "formula": C.hill_formula("symbols")})
    base = checkpointed(base)
    good = base.where("geometry_id is not null")
    firsts = good.groupBy("geometry_id").agg(F.min(F.struct("_row", "source_id")).alias("f")).select(
        "geometry_id", F.col("f._row").alias("_first"), F.col("f.source_id").alias("_first_id")
    )
    marked = good.join(firsts, "geometry_id")
    survivors = marked.where("_row = _first").select(
        "_row", "formula", "charge", "multiplicity", atoms_payload().alias("_p")
    )
    near = near_dedup(
        survivors, ["formula", "charge", "multiplicity"], "_row", "_p", permuted_rmsd(), threshold, status="_s", **sizes
    ).select(F.col("_row").alias("_first"), "_s", "cluster_id", "rep_row", "rep_distance")
    near = checkpointed(near)
    reps = base.select(F.col("_row").alias("rep_row"), F.col("source_id").alias("_rep_id"))
    named = near.where("_s = 'near_dup'").join(reps, "rep_row").select("_first", "_rep_id")
    exact = F.col("_row") != F.col("_first")
    done = marked.join(near, "_first").join(named, "_first", "left")
    done = done.withColumns({
        "dedup_status": F.when(exact, "exact_dup").otherwise(F.col("_s")),
        "reason": F.when(exact, F.concat(F.lit("duplicate geometry_id "), F.col("geometry_id"), F.lit(" (first: "),
                                         F.col("_first_id"), F.lit(")")))
        .when(F.col("_s") == "near_dup",
              F.concat(F.lit("near-dup of "), F.col("_rep_id"), F.lit(" (RMSD "),
                       F.format_string("%.4f", "rep_distance"), F.lit(f" A < {threshold} A)"))),
    })
    bad = base.where("geometry_id is null").withColumns({
        "dedup_status": F.lit("error"), "cluster_id": F.lit(None).cast("bigint"), "reason": F.lit("row decode failed"),
    })
    cols = [*base.columns, "dedup_status", "cluster_id", "reason"]
    return done.select(*cols).unionByName(bad.select(*cols)).drop("_row")


def delivery(rows: DataFrame, exclude: list[str] | None = None) -> DataFrame:
    """Add ``frame``: extXYZ text with the fixed tag set; null where a row cannot be decoded."""
    kept = gates.exclude_rules(rows, exclude or [])
    text = lambda c, default: F.coalesce(F.col(c).cast("string"), F.lit(default))
    header = F.create_map(
        F.lit("geometry_id"), text("geometry_id", ""), F.lit("charge"), text("charge", "0"),
        F.lit("multiplicity"), text("multiplicity", "1"), F.lit("elements"), text("formula", ""),
        F.lit("source_id"), text("source_id", ""), F.lit("source_file"), text("source_file", ""),
        F.lit("source_index"), text("source_index", "0"),
    )
    charges = F.col("charges")
    frame = frame_text(F.col("symbols"), F.col("coords"), charges, comment_line(header, charges, DELIVERY_TAGS))
    whole = (F.size("symbols") == F.size("coords")) & (charges.isNull() | (F.size(charges) == F.size("symbols")))
    return kept.withColumn("frame", F.when(F.coalesce(whole, F.lit(False)), frame))


def to_text_columns(rows: DataFrame) -> DataFrame:
    """Array columns to the text codecs of the stored form."""
    return rows.withColumns({
        "symbols": C.encode_words("symbols"), "coords": C.encode_coords("coords"),
        "charges": F.when(F.col("charges").isNotNull(), C.encode_charges("charges")), "header": C.encode_header("header"),
    })


def from_text_columns(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "symbols": C.decode_words("symbols"), "coords": C.decode_coords("coords"),
        "charges": C.decode_charges("charges"), "header": C.decode_header("header"),
    })


def run(frames: DataFrame, threshold: float = NEAR_DUP, force_keep: bool = False, **policy) -> dict[str, DataFrame]:
    """Ingest, identity, filter and delivery; every reject set is returned beside the result."""
    rows, ingest_rejects = ingest(frames)
    labelled = checkpointed(identity(rows, threshold))
    kept, dups = gates.divide(labelled, F.col("dedup_status") == "kept", force_keep)
    filtered = gates.scalar_filter(kept.drop("reason"), **policy)
    passed, filtered_out = gates.divide(filtered, F.col("filter_status") == "ok", force_keep)
    return {
        "rows": passed, "frames": delivery(passed), "ingest_rejects": ingest_rejects,
        "dedup_rejects": dups, "filter_rejects": filtered_out,
    }
