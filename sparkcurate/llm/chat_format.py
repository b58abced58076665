"""Chat formatting in budgeted windows with loss masks.

A conversation becomes windows of whole turns. The running sum of the turns' tokens decides where a
window ends: it takes turns while the budget holds. Every window begins with the conversation's
system turn, then repeats the last turns of the window before, as many as fit in the history budget
and leave room for the next turn. So no window is above the budget but one that holds a single new turn,
which with the system turn alone is above it; such a window repeats nothing else. Repeated turns are
masked: only the first time an assistant text appears does it count for the loss.

Template, per turn: ``### role:``, a line end, the text, ``</turn>``, a line end. Control strings inside
roles and texts are escaped with a backslash (``ESCAPES``), so they never appear raw and
reading back gives the exact turns.

Rows are dealt by conversation and sorted by turn; a task streams them and holds one window, never a
conversation. Tokens are counted as words plus a fixed part per turn, or by ``count``.

Edge cases: a null text or role is empty text; a null turn number comes first; rows with equal numbers
are ordered by role and text, and equal rows are all kept. A null conv_id is a conversation. Other
columns are ignored. An empty table gives no windows.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import table

BUDGET, HISTORY, TURN_TOKENS = 512, 128, 4
OPEN, CLOSE = "###", "</turn>"
# Escape letters; the backslash comes first when writing.
ESCAPES = [("\\", "\\"), (OPEN, "h"), (CLOSE, "t")]
ROLE_ESCAPES = [*ESCAPES, (":", "c"), ("\n", "n")]
_BACK = {letter: raw for raw, letter in ROLE_ESCAPES}
_TURN = re.compile(r"### ([^:\n]*):\n(.*?)</turn>\n", re.DOTALL)
WINDOWS = "conv_id bigint, window bigint, text string, repeated int, loss array<struct<start:int,end:int>>"


def escape(text: str, table: list[tuple[str, str]] = ESCAPES) -> str:
    for raw, letter in table:
        text = text.replace(raw, "\\" + letter)
    return text


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: _BACK[m[1]], text, flags=re.DOTALL)


def word_tokens(text: str) -> int:
    return len(text.split()) + TURN_TOKENS


class _Window:
    """The window being filled: turns as (role, text, tokens), of which the first ``repeated`` are masked."""

    def __init__(self, turns: list[tuple], repeated: int) -> None:
        self.turns, self.repeated = turns, repeated
        self.sums = [0]
        for t in turns:
            self.sums.append(self.sums[-1] + t[2])

    def add(self, turn: tuple) -> None:
        self.turns.append(turn)
        self.sums.append(self.sums[-1] + turn[2])

    def history(self, limit: int, after: int) -> list[tuple]:
        """The last turns that together stay within ``limit``, not reaching before turn ``after``."""
        first = len(self.turns)
        while first > after and self.sums[-1] - self.sums[first - 1] <= limit:
            first -= 1
        return self.turns[first:]

    def written(self) -> tuple[str, list[dict]]:
        out, at, loss = [], 0, []
        for k, (role, text, _) in enumerate(self.turns):
            head, body = f"{OPEN} {escape(role, ROLE_ESCAPES)}:\n", escape(text)
            if role == "assistant" and k >= self.repeated:
                loss.append({"start": at + len(head), "end": at + len(head) + len(body)})
            out += [head, body, CLOSE + "\n"]
            at += len(head) + len(body) + len(CLOSE) + 1
        return "".join(out), loss


def format_windows(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, count: Callable[[str], int] = word_tokens
) -> DataFrame:
    """Windows (conv_id, window, text, repeated, loss) of ``turns`` (conv_id, turn, role, text).

    ``repeated``: how many leading turns are repeats. ``loss``: spans of the text, in code points.
    The windows of a conversation come in order in one partition.
    """
    rows = turns.select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, window, number, system, begun = None, None, 0, None, False
        out: list[tuple] = []

        def flush() -> None:
            nonlocal number
            if window is not None and len(window.turns) > window.repeated:
                text, loss = window.written()
                out.append((conv, number, text, window.repeated, loss))
                number += 1

        for frame in frames:
            for c, role, text in zip(frame.conv_id, frame.role, frame.text, strict=True):
                c = None if pd.isna(c) else int(c)
                turn = (role, text, count(text))
                if not begun or c != conv:
                    flush()
                    conv, number, begun = c, 0, True
                    system = turn if role == "system" else None
                    window = _Window([], 0)
                elif len(window.turns) > window.repeated and window.sums[-1] + turn[2] > budget:
                    flush()
                    kept = [system] if system else []
                    room = budget - turn[2] - sum(t[2] for t in kept)
                    kept += window.history(min(history, room), len(kept) if window.turns[:1] == kept else 0)
                    window = _Window(kept, len(kept))
                window.add(turn)
            if out:
                yield _frame(out)
                out.clear()
        flush()
        if out:
            yield _frame(out)

    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").mapInPandas(run, WINDOWS)


def _frame(rows: list[tuple]) -> pd.DataFrame:
    cols = list(zip(*rows, strict=True))
    return pd.DataFrame({
        "conv_id": pd.array(list(cols[0]), dtype="Int64"), "window": cols[1], "text": cols[2], "repeated": cols[3], "loss": cols[4]})


def read_turns(text: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a window, unescaped."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]


def read_back(windows: DataFrame) -> DataFrame:
    """Digests of each conversation, read from its windows alone."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        conv, begun = None, False
        turns = loss = None
        n, chars, size = 0, 0, 0
        out: list[tuple] = []

        def flush() -> None:
            if begun:
                out.append((conv, n, turns.hexdigest(), chars, loss.hexdigest(), size))

        for frame in frames:
            for c, text, repeated, spans in zip(frame.conv_id, frame.text, frame.repeated, frame.loss, strict=True):
                c = None if pd.isna(c) else int(c)
                if not begun or c != conv:
                    flush()
                    conv, begun, n, chars, size = c, True, 0, 0, 0
                    turns, loss = hashlib.sha256(), hashlib.sha256()
                for role, said in read_turns(text)[repeated:]:
                    turns.update(f"{role}\n{said}\n".encode())
                    n += 1
                for s in spans:
                    said = unescape(text[s["start"] : s["end"]])
                    loss.update(said.encode())
                    chars += len(said)
                size += len(text)
            if out:
                yield _digests(out)
                out.clear()
        flush()
        if out:
            yield _digests(out)

    return windows.mapInPandas(
        run, "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint")


def _digests(rows: list[tuple]) -> pd.DataFrame:
    names = ("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars")
    out = pd.DataFrame(dict(zip(names, zip(*rows, strict=True), strict=True)))
    out["conv_id"] = pd.array([r[0] for r in rows], dtype="Int64")
    return out


def op8_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn int, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("int").alias("turn"), "role", "text")
    return read_back(format_windows(rows.unionAll(extra)))


QUERIES = {"op8_chat_windows": op8_chat_windows}
ORACLES: dict[str, str] = {}
