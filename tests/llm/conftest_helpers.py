"""Plain-Python versions shared by the tests of this folder."""

import re
from zlib import crc32

from pyspark.sql import types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingle_sets(text, k):
    words = (text or "").encode().lower().split()
    if len(words) < k:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1))


def lower(text):
    """A-Z as a-z and nothing else."""
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text):
    return WORD.findall(lower(text))


def fold(doc_id, parts):
    return crc32(b"" if doc_id is None else str(doc_id).encode()) % parts


DOCS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
])


def prose(rng, n, vocabulary=None):
    vocabulary = vocabulary or ["alpha", "Beta", "gamma,", "délta", "epsilon.", "zeta", "eta", "theta;", "iota", "kappa", "Lambda", "mu", "nu", "xi", "omicron"]
    out = []
    for _ in range(n):
        out.append(rng.choice(vocabulary) + rng.choice(["", "", "s", str(rng.randrange(90))]))
        out.append(rng.choice([" ", " ", " ", "\n", "  "]))
    return "".join(out).strip()


def awkward(rng):
    """Rows with nulls, empty and long texts, ties, repeated rows, near copies and control characters."""
    base = prose(rng, 120)
    words = base.split()
    near = [" ".join([*words[: i * 7], "changed", *words[i * 7 + 1 :]]) for i in range(1, 6)]
    texts = [None, "", " \n\t ", "one", "two words", "a b c", "a b c d", "A B C D", base, base, base.upper(), *near,
             prose(rng, 3000), "x" * 5000, "é ñ \x0b\x0c tail", *(prose(rng, rng.randrange(5, 80)) for _ in range(40))]
    rows = [(i, t, "en", f"s{i % 4}" if i % 7 else None, 0) for i, t in enumerate(texts)]
    rows += [rows[8], rows[8], (9001, None, None, None, None), (9002, "", None, "s1", None)]
    return rows
