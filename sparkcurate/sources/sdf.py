"""SDF records as rows: splittable scan, tags and blocks by Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import molblock
from ..functions.columns import as_float, int_value, let, parses_as_int

# A record ends with a line of four dollar signs; the scan cuts before them, so both line ends fit.
RECORD_END = "\n$$$$"
TAG = r"(?s)>[^\n<]*<([^>\n]+)>[^\n]*\n(.*?)(?:\n[ \t]*\n|\n?\z)"


def unix_text(content: Column) -> Column:
    """Bytes or text as valid UTF-8 with plain line ends; null when the bytes are no UTF-8."""
    return F.regexp_replace(F.try_validate_utf8(content.cast("string")), "\r\n?", "\n")


def _record(value: Column) -> Column:
    """A scanned record without the rest of the line that ended the one before.

    Only the first record of a file has no such rest; it may begin with an empty title, which shows
    by its counts line being the fourth.
    """
    text = unix_text(value)
    titled = text.rlike(r"^\n[^\n]*\n[^\n]*\n[^\n]*V[23]000")
    return F.when(titled, text).otherwise(F.regexp_replace(text, r"^[ \t]*\n", ""))


def _scan(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``batch_file, _at, _id, value`` of the records below a path; blank ones are left out.

    A record that is no valid UTF-8 has a null value.
    """
    raw = spark.read.option("lineSep", RECORD_END).text(path)
    return raw.select(
        F.col("_metadata.file_name").alias("batch_file"), F.col("_metadata.file_block_start").alias("_at"),
        F.monotonically_increasing_id().alias("_id"), _record(F.col("value")).alias("value"),
    ).where(F.col("value").isNull() | F.col("value").rlike(r"\S"))


def split_tags(record: Column | str) -> Column:
    """MAP of tag name to text; of a repeated tag the last value counts."""
    record = F.col(record) if isinstance(record, str) else record

    def last_of(s: Column) -> Column:
        pairs = F.zip_with(s["k"], s["v"], lambda k, v: F.struct(k.alias("k"), v.alias("v")))
        repeated = lambda e, i: F.array_contains(F.slice(s["k"], i + 2, F.size(s["k"])), e["k"])
        return F.map_from_entries(F.filter(pairs, lambda e, i: ~repeated(e, i)))

    found = lambda g: F.regexp_extract_all(record, F.lit(TAG), F.lit(g))
    return let(F.struct(found(1).alias("k"), found(2).alias("v")), last_of)


def block_of(record: Column | str) -> Column:
    """The connection table, cut after its ``M  END`` line."""
    record = F.col(record) if isinstance(record, str) else record
    at = F.locate("M  END", record)
    return F.when(at > 0, F.substring(record, F.lit(1), at + 5))


def parse_records(df: DataFrame, text: str = "value") -> DataFrame:
    """Add ``mol_block``, ``tags``, ``parsed``, ``num_atoms`` and ``num_bonds``; an unreadable record keeps its
    position with a null block and no tags."""
    def read(b: Column) -> Column:
        """The block and its counts; null fields for one that does not parse."""
        sizes = F.struct(b.alias("b"), molblock.n_atoms(b).alias("atoms"), F.size(molblock.bonds(b)).alias("bonds"))
        return let(sizes, lambda s: F.when((s["atoms"] >= 0) & (s["bonds"] >= 0), s))

    # Unfolded, so that a filter on the result is not pushed below it and parses every block once more.
    out = df.select("*", F.explode_outer(F.array(let(block_of(text), read))).alias("_r"))
    out = out.withColumn("parsed", F.col("_r").isNotNull())
    empty = F.expr("cast(map() as map<string,string>)")
    return (
        out.withColumn("tags", F.when(F.col("parsed"), split_tags(text)).otherwise(empty))
        .withColumns({"mol_block": F.col("_r.b"), "num_atoms": F.col("_r.atoms"), "num_bonds": F.col("_r.bonds")})
        .drop("_r")
    )


def read_sdf(spark: SparkSession, path: str) -> DataFrame:
    """Rows ``batch_file, row_index, mol_block, tags, parsed, num_atoms, num_bonds`` of SDF files.

    Large files are split at record ends. ``row_index`` (first byte of the split, number in
    the scan) orders the records of one file.
    """
    rows = _scan(spark, path)
    rows = rows.withColumn("row_index", F.struct(F.col("_at").alias("block"), F.col("_id").alias("no")))
    return parse_records(rows).drop("value", "_at", "_id")


def wide_tags(df: DataFrame) -> DataFrame:
    """Parsed records with an integer tag that does not fit its column, with ``reject_reason``."""
    tag = lambda k: F.element_at("tags", F.lit(k))
    wide = lambda k: F.when(
        parses_as_int(tag(k)) & tag(k).try_cast("double").isNotNull() & ~tag(k).try_cast("double").between(-(2.0**31), 2.0**31 - 1),
        F.concat(F.lit(f"{k} out of range: "), tag(k)))
    return df.where("parsed").withColumn("reject_reason", F.coalesce(wide("FormalCharge"), wide("Multiplicity"))).where("reject_reason IS NOT NULL")


def extract_rows(df: DataFrame) -> DataFrame:
    """Molecule rows of parsed records; missing optional tags are null, and so are integers that do
    not fit (see ``wide_tags``)."""
    tag = lambda k: F.element_at("tags", F.lit(k))
    as_int = lambda k: F.when(parses_as_int(tag(k)), int_value(tag(k))).try_cast("int")
    known = {"num_atoms", "num_bonds"} <= set(df.columns)
    counts = ["num_atoms", "num_bonds"] if known else [
        molblock.n_atoms("mol_block").alias("num_atoms"), F.size(molblock.bonds("mol_block")).alias("num_bonds")]
    return df.where("parsed").select(
        *[c for c in df.columns if c not in ("tags", "parsed", "mol_block", "num_atoms", "num_bonds")],
        "mol_block",
        as_float(tag("Energy_Ha")).alias("Energy_Ha"),
        as_int("FormalCharge").alias("FormalCharge"),
        as_int("Multiplicity").alias("Multiplicity"),
        tag("SMILES").alias("SMILES"), tag("SourceID").alias("SourceID"),
        as_float(tag("HOMO_Ha")).alias("HOMO_Ha"), as_float(tag("LUMO_Ha")).alias("LUMO_Ha"),
        as_float(tag("HL_Gap_Ha")).alias("HL_Gap_Ha"), tag("PartialCharges").alias("PartialCharges"),
        *counts,
    )


def count_records(spark: SparkSession, path: str) -> DataFrame:
    """Records per SDF file: ``file, n``."""
    return _scan(spark, path).groupBy(F.col("batch_file").alias("file")).agg(F.count(F.lit(1)).alias("n"))
