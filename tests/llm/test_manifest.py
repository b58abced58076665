from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from conftest_helpers import fold, lower
from sparkcurate.llm import manifest as M


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def grown(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 8]) for i in range(0, len(below), 8)])
    return levels


def way(levels, at):
    out = []
    for nodes in levels[:-1]:
        run = nodes[at // 8 * 8 : at // 8 * 8 + 8]
        out.append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
        at //= 8
    return out


def plain(rows):
    """Per row: digests and version, from whole trees in plain Python."""
    langs = {}
    for i, text, lang, source, n_chars in rows:
        new = leaf(i, source, lang, n_chars, lower(text)) if fold(i, 3) == 0 and text is not None else None
        langs.setdefault(lang, []).append((i, leaf(i, source, lang, n_chars, text), new))
    order = sorted(langs, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        langs[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[lang] = grown([r[1] for r in langs[lang]])
    top = grown([trees[x][-1][0] for x in order])
    root, out = top[-1][0], []
    for k, lang in enumerate(order):
        for at, (i, old, new) in enumerate(langs[lang]):
            steps = way(trees[lang], at) + way(top, k)
            node = new or old
            for b, a in steps:
                node = h(b, node, a)
            out.append((i, old, trees[lang][-1][0], root, h(*(b + a for b, a in steps)), node, node == root, len(steps) if new and new != old else 0))
    return sorted(out, key=repr)


def answers(df):
    return sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256, r.folded_root, r.verified, r.n_copied) for r in df.collect()), key=repr)


def test_query(spark, folder, rows):
    got = answers(M.op12_merkle_manifest(spark, folder))
    assert got == plain(rows) and any(not r[6] for r in got) and any(r[6] for r in got)


@pytest.mark.parametrize("counts", [{"a": 9001, None: 1, "ä": 4096, "Z": 4097}, {"a": 8}, {None: 1}, {"b": 65, "a": 1}, {f"l{i}": 2 for i in range(70)}])
def test_trees_of_many_blocks_and_languages(spark, counts):
    rows = [(7 * i % 9999 if i % 50 else 5, f"Text {i}", lang, None, i) for lang, n in counts.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = docs.withColumns({c: F.lit("x") for c in ("leaf", "tree", "pos", "n", "block", "path", "root")})
    found = M.manifest(docs, fold_rule(), M.lowered(F.col("text"))).withColumn("n_copied", F.size("copied_nodes"))
    assert answers(found) == plain(rows)
    made = found.where("n_copied > 0").first()
    assert made is None or made.copied_nodes[-1:] == [made.folded_root]


def fold_rule():
    from sparkcurate.llm.common import fold as rule
    return rule(F.col("doc_id"), 3) == 0


def test_nulls_repeats_and_no_rows(spark, none):
    rows = [(None, None, None, None, None), (None, "A", None, None, 3), (3, "", "x", "s", None), (3, "", "x", "s", None), (3, "B", "x", "s", None), (9, "Long " * 50_000, "x", "", 1)]
    docs = spark.createDataFrame(rows, none.schema)
    rule, text = fold_rule(), M.lowered(F.col("text"))
    assert answers(M.manifest(docs, rule, text).withColumn("n_copied", F.size("copied_nodes"))) == plain(rows)
    assert M.manifest(none, rule, text).count() == 0
