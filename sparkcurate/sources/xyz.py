"""XYZ and extXYZ text: frames as rows, errors as rows.

The atom count of a frame decides where the next one starts, and a malformed frame rejects its
whole file. Small files are one value each. Larger ones are read by many tasks: their lines are
numbered and cut into blocks; each block tells where every possible frame start in it leads to beyond the
block, so a walk over these short tables finds the starts, and frames are parsed wherever they fall. Both ways
cut lines and number errors alike.
"""

from __future__ import annotations

import itertools
import math
import re
import shlex
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import fixed6
from ..operators.ordering import number_rows
from ..session import lookup_join, stored

# Header key syntax, default columns, required widths.
NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
PLAIN_COLUMNS = [("species", 1), ("pos", 3)]
WIDTHS = {"species": 1, "pos": 3, "charge": 1}
# Files up to this size are read as one value.
VALUE_BYTES = 256_000_000
FRAMES_AT_ONCE = 1000
# Lines of a large file that one task looks at.
BLOCK_LINES = 100_000
LINE_ENDS = re.compile(r"\r\n|[\n\r]")
# Further characters that end a line of text.
MORE_ENDS = "[\x0b\x0c\x1c\x1d\x1e\x85\u2028\u2029]"
COUNT = re.compile(r"\s*[+-]?\d+(_\d+)*\s*")

FRAME = (
    "source_file string, source_index int, symbols array<string>, coords array<array<double>>, "
    "charges array<double>, header map<string,string>, error string"
)


class FrameError(ValueError):
    """A malformed frame; the message names the line."""


def header_of(line: str) -> dict[str, str]:
    """``key=value`` tokens of a comment line, else the whole line as its title."""
    text = line.strip()
    if not text:
        return {}
    try:
        parts = [t.partition("=") for t in shlex.split(text)]
    except ValueError:
        return {"title": text}
    if all(eq and NAME.fullmatch(k) for k, eq, _ in parts):
        return {k: v for k, _, v in parts}
    return {"title": text}


def columns_of(spec: str | None, at: int) -> list[tuple[str, int]]:
    """(name, width) of the per-atom columns declared by ``Properties``."""
    if spec is None:
        return PLAIN_COLUMNS
    parts = spec.split(":")
    if len(parts) % 3:
        raise FrameError(f"line {at}: the entries of Properties do not come in threes")
    cols = []
    for name, count in zip(parts[::3], parts[2::3]):
        if not NAME.fullmatch(name) or not re.fullmatch(r"\s*\+?\d+\s*", count) or int(count) < 1:
            raise FrameError(f"line {at}: bad Properties column {name!r}:{count!r}")
        if WIDTHS.get(name, int(count)) != int(count):
            raise FrameError(f"line {at}: Properties gives {name} {count} values, not {WIDTHS[name]}")
        cols.append((name, int(count)))
    if not {"species", "pos"} <= {n for n, _ in cols}:
        raise FrameError(f"line {at}: Properties lacks species or pos")
    return cols


def _number(text: str, at: int) -> float:
    try:
        v = float(text)
    except ValueError:
        raise FrameError(f"line {at}: not a number: {text!r}") from None
    if not math.isfinite(v):
        raise FrameError(f"line {at}: non-finite value {text!r}")
    return v


def lines_of(text: str) -> list[str]:
    """The lines of a text; the text after the last line end is a line unless it is empty."""
    parts = LINE_ENDS.split(text)
    return [piece for part in (parts if parts[-1] else parts[:-1]) for piece in re.split(MORE_ENDS, part)]


def frames_of(lines: str | Iterable[str]) -> Iterator[tuple[list, list, list | None, dict]]:
    """(symbols, coords, charges, header) of every frame of a text or of its lines, read one by one.

    Only the lines of one frame are held. Raises :class:`FrameError` at the first bad line.
    """
    rest = enumerate(lines_of(lines) if isinstance(lines, str) else lines, 1)
    for at, line in rest:
        if line.strip():
            yield _frame(at, line, rest)


def _frame(at: int, first: str, rest: Iterator[tuple[int, str]]) -> tuple[list, list, list | None, dict]:
    """The frame that begins with the count line ``first``; takes its other lines from ``rest``."""
    if not COUNT.fullmatch(first):
        raise FrameError(f"line {at}: no atom count in {first.strip()!r}")
    n = int(first)
    if n < 0:
        raise FrameError(f"line {at}: count {n} below zero")
    _, comment = next(rest, (0, None))
    if comment is None:
        raise FrameError(f"line {at + 1}: the comment line is missing")
    header = header_of(comment)
    columns = columns_of(header.get("Properties"), at + 1)
    # Slice of a split atom line per column.
    place, width = {}, 0
    for name, count in columns:
        place[name] = slice(width, width + count)
        width += count
    body = list(itertools.islice(rest, n))
    if len(body) < n:
        raise FrameError(f"line {at + 1 + len(body)}: the file ends, {n} atom lines expected")
    cells = [(k, line.split()) for k, line in body]
    for k, c in cells:
        if len(c) != width:
            raise FrameError(f"line {k}: {len(c)} columns, expected {width}")
    symbols = [c[place["species"]][0] for _, c in cells]
    coords = [[_number(v, k) for v in c[place["pos"]]] for k, c in cells]
    charges = [_number(c[place["charge"]][0], k) for k, c in cells] if "charge" in place else None
    return symbols, coords, charges, header


_NAMES = [part.split()[0] for part in FRAME.split(", ")]
NOT_TEXT = "not valid UTF-8"


def _file_rows(name: str, lines: str | Iterable[str] | None) -> Iterator[tuple]:
    """Frame rows of one file, at the first error one row that tells it."""
    if lines is None:
        yield (name, None, None, None, None, None, NOT_TEXT)
        return
    try:
        for i, (s, c, q, h) in enumerate(frames_of(lines)):
            yield (name, i, s, c, q, h, None)
    except FrameError as exc:
        yield (name, None, None, None, None, None, str(exc))


def _explode_texts(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for name, text in zip(pdf["source_file"], pdf["text"]):
            rows = list(_file_rows(name, text))
            out += rows[-1:] if rows and rows[-1][-1] is not None else rows
        yield pd.DataFrame(out, columns=_NAMES)


def parse_texts(df: DataFrame) -> DataFrame:
    """Frames of ``source_file, text`` rows; a bad text gives one row with ``error``."""
    return df.select("source_file", "text").mapInPandas(_explode_texts, FRAME)


def _jumps(values: list[str]) -> list[int]:
    """Per line, how far the next frame start is if a frame starts here; 0 where none can, 1 for a blank line."""
    out = []
    for v in values:
        n = int(v) if COUNT.fullmatch(v) else -1 if v.strip() else None
        out.append(1 if n is None else n + 2 if n >= 0 else 0)
    return out


def _exits(block: pd.DataFrame) -> pd.DataFrame:
    """(key, block, entry, exit, last) of a block: for each possible start, the first one beyond the block (negative: minus
    the line where no frame can start) and the last one in it. Entry -1 gives the block's first and last line."""
    block = block.sort_values("no")
    first, jump = int(block["no"].iloc[0]), _jumps(block["value"].tolist())
    size = len(jump)
    leads, last = [0] * size, [0] * size
    for i in range(size - 1, -1, -1):
        to = i + jump[i]
        if not jump[i]:
            leads[i] = -(first + i)
        elif to >= size:
            leads[i], last[i] = first + to, first + i
        else:
            leads[i], last[i] = leads[to], last[to]
    can = [i for i in range(size) if jump[i]]
    rows = [(-1, first, first + size - 1), *((first + i, leads[i], last[i]) for i in can)]
    name = (str(block["key"].iloc[0]), int(block["block"].iloc[0]))
    return pd.DataFrame([(*name, *r) for r in rows], columns=["key", "block", "entry", "exit", "last"], dtype=object)


def _walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(key, block, entry, carry): where the walk enters each block, and the start of the frame it comes from.

    Rows come sorted by key, block and entry; only the place of the walk is held. A file whose walk meets a
    line that is no start gets a row with block null and that line as entry.
    """
    key, at, carry, end, ended = None, 1, 0, 0, True
    for frame in frames:
        out = []
        for k, block, entry, leads, last in zip(frame.key, frame.block, frame.entry, frame.exit, frame["last"], strict=True):
            if k != key:
                if not ended and at <= end:
                    out.append((key, None, at, None))
                key, at, carry, end, ended = k, 1, 0, 0, False
            if ended:
                continue
            if entry == -1:
                if at <= end:  # the block before had no such start
                    out.append((key, None, at, None))
                    ended = True
                    continue
                end = last
                out.append((key, block, min(at, end + 1), carry))
            elif entry == at:
                if leads < 0:
                    out.append((key, None, -leads, None))
                    ended = True
                else:
                    at, carry = leads, last
        yield pd.DataFrame(out, columns=["key", "block", "entry", "carry"], dtype=object)
    if not ended and at <= end:
        yield pd.DataFrame([(key, None, at, None)], columns=["key", "block", "entry", "carry"], dtype=object)


def _labelled(key: tuple, block: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
    """(key, start, no, value): the lines of a block with the start of their frame; blank lines between frames are left out."""
    if block.empty or entries.empty:
        return pd.DataFrame([], columns=["key", "start", "no", "value"], dtype=object)
    block = block.sort_values("no")
    no, values, jump = block["no"].tolist(), block["value"].tolist(), _jumps(block["value"].tolist())
    starts: list = [None] * len(no)
    at = int(entries["entry"].iloc[0]) - no[0]
    starts[:at] = [int(entries["carry"].iloc[0])] * at
    while at < len(no) and jump[at]:
        if values[at].strip():
            size = min(jump[at], len(no) - at)
            starts[at : at + size] = [no[at]] * size
        at += jump[at]
    held = [(key[0], *row) for row in zip(starts, no, values, strict=True) if row[0] is not None]
    return pd.DataFrame(held, columns=["key", "start", "no", "value"], dtype=object)


def _parsed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Frames of lines that come sorted by file, frame and number; one frame is held at a time."""
    names = ["key", "start", "symbols", "coords", "charges", "header", "error", "line"]
    lines = (row for pdf in frames for row in zip(pdf["key"], pdf["start"], pdf["no"], pdf["value"], strict=True))

    def rows() -> Iterator[tuple]:
        for (key, start), own in itertools.groupby(lines, key=lambda r: r[:2]):
            rest = iter([(int(no), value) for _, _, no, value in own])
            at, first = next(rest)
            try:
                yield (key, int(start), *_frame(at, first, rest), None, None)
            except FrameError as exc:
                yield (key, int(start), None, None, None, None, str(exc), int(str(exc).split(":")[0].removeprefix("line ")))

    found = rows()
    while part := list(itertools.islice(found, FRAMES_AT_ONCE)):
        yield pd.DataFrame(part, columns=names, dtype=object)


def read_large(spark: SparkSession, paths: list[str], block_lines: int | None = None) -> DataFrame:
    """Frames of files of any size, each read by as many tasks as it has blocks of ``block_lines`` lines.

    A file is known by its whole path, so files of one name in two folders stay apart. A file with an error is
    rejected whole and gives one row that tells the first one.
    """
    block_lines = BLOCK_LINES if block_lines is None else block_lines
    raw = spark.read.text(paths).select(
        F.col("_metadata.file_path").alias("key"), F.col("_metadata.file_block_start").alias("_at"),
        F.monotonically_increasing_id().alias("_id"), F.try_validate_utf8("value").alias("value"))
    pieces = F.posexplode(F.coalesce(F.split("value", MORE_ENDS), F.array(F.lit(None).cast("string"))))
    lines = stored(raw.select("key", "_at", "_id", pieces.alias("_piece", "value")))
    not_text = lines.where("value IS NULL").select("key").distinct().withColumns({"line": F.lit(0).cast("bigint"), "error": F.lit(NOT_TEXT)})
    numbered = number_rows(lines.where("value IS NOT NULL"), ["key", "_at", "_id", "_piece"], "_no")
    numbered = stored(numbered.select("key", "_no", "value"))
    firsts = numbered.groupBy("key").agg(F.min("_no").alias("_first"))
    numbered = stored(lookup_join(numbered, firsts, "key").withColumn("no", F.col("_no") - F.col("_first") + 1).withColumn(
        "block", F.floor((F.col("no") - 1) / block_lines)).select("key", "block", "no", "value"))
    exits = numbered.groupBy("key", "block").applyInPandas(_exits, "key string, block bigint, entry bigint, exit bigint, last bigint")
    walk = stored(exits.repartition("key").sortWithinPartitions("key", "block", "entry").mapInPandas(
        _walk, "key string, block bigint, entry bigint, carry bigint"))
    labelled = numbered.groupBy("key", "block").cogroup(walk.where("block IS NOT NULL").groupBy("key", "block")).applyInPandas(
        _labelled, "key string, start bigint, no bigint, value string")
    parts = FRAME.split(", ")
    schema = "key string, start bigint, " + ", ".join(parts[2:]) + ", line bigint"
    frames = stored(labelled.repartition("key", "start").sortWithinPartitions("key", "start", "no").mapInPandas(_parsed, schema))
    no_start = walk.where("block IS NULL").join(numbered.select("key", F.col("no").alias("entry"), "value"), ["key", "entry"]).select(
        "key", F.col("entry").alias("line"), F.udf(_no_start)("entry", "value").alias("error"))  # one row per bad file
    errors = not_text.unionByName(no_start).unionByName(frames.where("error IS NOT NULL").select("key", "line", "error"))
    errors = stored(errors.groupBy("key").agg(F.min(F.struct("line", "error"))["error"].alias("error")))
    good = stored(number_rows(frames.drop("error", "line").join(errors.select("key"), "key", "left_anti"), ["key", "start"], "_no"))
    firsts = good.groupBy("key").agg(F.min("_no").alias("_first"))
    rows = lookup_join(good, firsts, "key").withColumn("source_index", (F.col("_no") - F.col("_first")).cast("int"))
    name = F.element_at(F.split(F.url_decode(F.replace(F.col("key"), F.lit("+"), F.lit("%2B"))), "/"), -1).alias("source_file")
    out = [p.split(" ", 1) for p in parts]
    rows = rows.select(name, *[c for c, _ in out[1:-1]], F.lit(None).cast("string").alias("error"))
    bad = errors.select(name, *[F.lit(None).cast(t).alias(c) for c, t in out[1:-1]], "error")
    return rows.unionByName(bad)


def _no_start(line: int, value: str) -> str:
    try:
        _frame(int(line), value, iter(()))
    except FrameError as exc:
        return str(exc)
    raise AssertionError(value)


def read_xyz(spark: SparkSession, path: str, pattern: str = "*.xyz", value_bytes: int = VALUE_BYTES) -> DataFrame:
    """All frames below ``path``. Order columns: ``source_file, source_index``.

    Files up to ``value_bytes`` are read as one value each, without a shuffle; larger ones by many tasks
    (``read_large``). Rows and errors are the same.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    small = parse_texts(
        files.where(F.col("length") <= value_bytes).select(
            F.element_at(F.split("path", "/"), -1).alias("source_file"),
            F.try_validate_utf8(F.col("content").cast("string")).alias("text"),
        )
    )
    large = [r.path for r in files.where(F.col("length") > value_bytes).select("path").collect()]  # names only
    return small.unionByName(read_large(spark, large)) if large else small


def frame_text(symbols: Column, coords: Column, charges: Column | None, comment: Column) -> Column:
    """One frame: atom count, comment, one line of six decimals per atom; ends in a newline."""
    point = lambda p: F.array_join(F.transform(p, fixed6), " ")
    plain = F.zip_with(symbols, coords, lambda s, p: F.concat(s, F.lit(" "), point(p)))
    lines = plain
    if charges is not None:
        charged = F.zip_with(plain, charges, lambda s, q: F.concat(s, F.lit(" "), fixed6(q)))
        lines = F.when(charges.isNull(), plain).otherwise(charged)
    return F.concat(
        F.array_join(F.concat(F.array(F.size(symbols).cast("string"), comment), lines), "\n"), F.lit("\n")
    )


def comment_line(header: Column, charges: Column | None = None, order: list[str] | None = None) -> Column:
    """Comment of a frame: a bare title as it is, else ``Properties`` and quoted pairs.

    ``Properties`` always describes the written columns. Pairs follow ``order`` when given,
    else their order in the map; a value with white space is quoted.
    """
    has_q = charges.isNotNull() if charges is not None else F.lit(False)
    props = F.when(has_q, "Properties=species:S:1:pos:R:3:charge:R:1").otherwise("Properties=species:S:1:pos:R:3")
    quoted = lambda v: F.when(v.rlike(r"\s"), F.concat(F.lit('"'), v, F.lit('"'))).otherwise(v)
    if order is None:
        entries = F.filter(F.map_entries(header), lambda e: e["key"] != "Properties")
    else:
        entries = F.array(*[F.struct(F.lit(k).alias("key"), F.element_at(header, F.lit(k)).alias("value")) for k in order])
    pairs = F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), quoted(e["value"])))
    title = F.element_at(header, F.lit("title"))
    bare = (F.size(header) == 1) & (F.coalesce(title, F.lit("")) != "") & ~has_q
    return F.when(bare, title).otherwise(F.array_join(F.concat(F.array(props), pairs), " "))


def header_int(header: Column, key: str, default: int) -> tuple[Column, Column]:
    """(value, reason): the default when the key is absent; ``1.0`` counts as an integer."""
    raw = F.element_at(header, F.lit(key))
    num = F.trim(raw).try_cast("double")
    quoted = F.concat(F.lit("'"), raw, F.lit("'"))
    whole = num.isNotNull() & (num % 1 == 0)  # false for NaN and the infinities
    fits = num.between(-(2.0**31), 2.0**31 - 1)
    value = F.when(raw.isNull(), F.lit(default)).when(whole & fits, num.try_cast("int"))
    reason = (
        F.when(raw.isNotNull() & num.isNull(), F.concat(F.lit(f"non-numeric {key} in header: "), quoted))
        .when(raw.isNotNull() & ~F.coalesce(whole, F.lit(False)), F.concat(F.lit(f"non-integer {key} in header: "), quoted))
        .when(raw.isNotNull() & ~fits, F.concat(F.lit(f"{key} in header out of range: "), quoted))
    )
    return value, reason

