"""Secret scans through a trigram inverted index.

1. Each rule's regular expression is turned into a Boolean query over trigrams: an OR of ANDs of
   trigrams that every match must contain, derived from the parsed expression (``trigram_query``).
2. The index holds, per trigram of the queries, the documents whose lower-cased text has it
   (``postings``): other trigrams can never be asked for.
3. Postings are intersected per alternative of a query (counted per document), which gives the
   candidates; only these are verified by the expression. Rules without a mandatory trigram
   scan every text.

Positions are code points, the end exclusive. A match is the leftmost, non-overlapping one of its
rule, then checked for the least length of its value. All steps are DataFrame functions.

Edge cases: null and empty texts have no spans. Repeated rows are scanned each; rows with equal doc_id
share their candidates, which are verified per row. Rows with a null doc_id skip the index and are
scanned by every rule. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.columns import let
from ..session import checkpointed, lookup_join
from .common import table

_SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"
MAX_ALTERNATIVES = 64
SMALL_CLASS = 8  # a class of so many characters is written out


@dataclass(frozen=True)
class Rule:
    """kind; expression; group whose length counts (0: the match); least length of it."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base rules, in order.
BASE = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),  # runs are maximal, so a run below 24 is no match
]
# Public formats of further credentials.
MORE = [
    Rule("github", r"(?:ghp|gho|ghu|ghs|ghr)_[A-Za-z0-9]{36,}"),
    Rule("github_pat", r"github_pat_[A-Za-z0-9_]{22,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", r"-----BEGIN (?:RSA |EC |DSA |OPENSSH |PGP )?PRIVATE KEY"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"(?:sk|rk)_live_[0-9A-Za-z]{16,}"),
    Rule("npm", r"npm_[A-Za-z0-9]{36}"),
    Rule("bearer", r"(?i:bearer\x20+([A-Za-z0-9._~+/-]+=*))", 1, 20),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\x00-\x20:/@]{1,64}:([^\x00-\x20/@]{3,64})@", 1, 3),
    Rule("uuid_key", r"\b[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}\b"),
]
RULES = BASE + MORE


def _expand(items: list, budget: int = MAX_ALTERNATIVES) -> list[list[str]]:
    """Alternatives of a parsed sequence; each is a list of literal runs between unknown parts."""
    out = [[""]]

    def times(parts: list[list[str]]) -> None:
        nonlocal out
        if len(out) * len(parts) > budget:
            parts = [["", ""]]  # too many alternatives: an unknown part, which asks for less
        out = [[*a[:-1], a[-1] + b[0], *b[1:]] for a in out for b in parts]

    gap = [["", ""]]
    for op, arg in items:
        if op is sre.LITERAL:
            times([[chr(arg).lower()]])
        elif op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= SMALL_CLASS:
            times([[c] for c in dict.fromkeys(chr(x).lower() for _, x in arg)])
        elif op is sre.SUBPATTERN:
            times(_expand(list(arg[3]), budget))
        elif op is sre.BRANCH:
            times([x for branch in arg[1] for x in _expand(list(branch), budget)])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT) and arg[:2] == (0, 1):
            times([[""], *_expand(list(arg[2]), budget)])
        elif op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT) and arg[0] >= 1:
            inner = _expand(list(arg[2]), budget)
            times(inner)
            if arg[:2] != (1, 1):
                times(gap)
        elif op is sre.AT:
            continue
        else:
            times(gap)
    return out


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """OR over ANDs of lower-case trigrams that a match must contain; None when it can do without any."""
    found = []
    for runs in _expand(list(parser.parse(pattern))):
        grams = frozenset(run[i : i + 3] for run in runs for i in range(len(run) - 2))
        if not grams:
            return None
        found.append(grams)
    # An alternative that asks for all of another one and more adds nothing.
    return [q for q in dict.fromkeys(found) if not any(p < q for p in found)]


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """(gram, doc_id): the index over the trigrams that queries can ask for, built from whole texts."""
    lowered = F.lower(F.col("text").cast("string"))
    has = let(lowered, lambda t: F.filter(F.array(*[F.lit(g) for g in grams]), lambda g: F.contains(t, g)))
    return docs.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.explode(has).alias("gram")).select("gram", "doc_id")


def candidates(index: DataFrame, queries: dict[int, list[frozenset[str]]]) -> DataFrame:
    """(doc_id, rules): documents whose trigrams satisfy the query of a rule; at most one row per document."""
    seen = index.groupBy("doc_id").agg(F.collect_set("gram").alias("grams"))  # at most all trigrams of the rules

    def met(alternatives: list[frozenset[str]]) -> Column:
        out = F.lit(False)
        for q in alternatives:
            out = out | (F.size(F.array_except(F.array(*[F.lit(g) for g in sorted(q)]), F.col("grams"))) == 0)
        return out

    rules = F.filter(F.array(*[F.when(met(q), F.lit(r)) for r, q in queries.items()]), lambda r: r.isNotNull())
    return seen.select("doc_id", rules.alias("rules")).where(F.size("rules") > 0)


def spans(text: Column, rule: Rule, rank: int) -> Column:
    """The spans of one rule: gaps and matches alternate, so their lengths give the positions."""
    pattern = F.lit(rule.pattern)
    parts = F.struct(
        F.split(text, rule.pattern, -1).alias("gaps"), F.regexp_extract_all(text, pattern, F.lit(0)).alias("found"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("value"))

    def walk(p: Column) -> Column:
        def step(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.length(F.get(p["gaps"], i))
            end = start + F.length(F.get(p["found"], i))
            span = F.struct(start.alias("start"), F.lit(rank).alias("rank"), end.alias("end"), F.lit(rule.kind).alias("kind"))
            good = F.length(F.get(p["value"], i)) >= rule.least
            return F.struct(end.alias("at"), F.when(good, F.array_append(acc["hits"], span)).otherwise(acc["hits"]).alias("hits"))

        start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("hits"))
        return F.aggregate(F.sequence(F.lit(0), F.size(p["found"]) - 1), start, step, lambda a: a["hits"])

    return F.when(text.rlike(rule.pattern), let(parts, walk)).otherwise(F.array().cast(_SPANS))


def find(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """(doc_id, spans) of every row: spans sorted by start, then in the order of the rules."""
    queries = {i: trigram_query(r.pattern) for i, r in enumerate(rules)}
    asked = {i: q for i, q in queries.items() if q is not None}
    docs = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    if asked:
        grams = sorted({g for q in asked.values() for a in q for g in a})
        hits = checkpointed(candidates(postings(docs, grams), asked))  # read twice: counted, then joined
        docs = lookup_join(docs, hits, "doc_id", "left")
        everything = F.array(*[F.lit(i) for i in asked])
        docs = docs.withColumn("rules", F.when(F.col("doc_id").isNull(), everything).otherwise(F.coalesce("rules", F.array().cast("array<int>"))))
    none = F.array().cast(_SPANS)
    found = []
    for i, rule in enumerate(rules):
        own = spans(F.col("text"), rule, i)
        found.append(own if queries[i] is None else F.when(F.array_contains("rules", i), own).otherwise(none))
    return docs.select("doc_id", F.array_sort(F.concat(*found)).alias("spans"))


def written(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op9_secret_trigram_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count(rank: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("bigint")

    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    return find(table(spark, sf_dir, "documents")).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans"))


QUERIES = {"op9_secret_trigram_index": op9_secret_trigram_index}
ORACLES: dict[str, str] = {}
