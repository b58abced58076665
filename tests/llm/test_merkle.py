import hashlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sparkcurate.llm import merkle


def pieces(text):
    return {line[i : i + merkle.PIECE] for line in text.split("\n") for i in range(0, len(line), merkle.PIECE)}


def likeness(a, b):
    a, b = pieces(a), pieces(b)
    return 2 * len(a & b) / (len(a) + len(b)) if a or b else 1.0


def brute(rows):
    """(doc_id, n_chars, edited hash, near_edited, near_next) by plain loops; the next id's smallest text is the neighbour."""
    texts = {}
    for i, t, *_ in rows:
        texts.setdefault(i, []).append(t or "")
    order = sorted(texts, reverse=True)
    after = dict(zip(order, [*order[1:], order[0]], strict=True))
    out = []
    for i, own in texts.items():
        need = max(len(t) for t in own) // 3
        head = min(texts[after[i]], key=lambda t: (t[:need], t))
        for t in own:
            n = len(t) // 3
            edit = t[: len(t) - n] + head[:n]
            out.append((i, len(t), hashlib.sha256(edit.encode()).hexdigest(), round(likeness(t, edit), 9), round(likeness(t, head), 9)))
    return Counter(out)


def test_against_brute_force(spark, folder, rows):
    got = merkle.op1_merkle_fingerprint(spark, folder).collect()
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, round(r.near_edited, 9), round(r.near_next, 9)) for r in got) == brute(rows)
    by_text, by_id = {}, {}
    for i, t, *_ in rows:
        by_id[i] = t or ""
    for r in got:
        by_text.setdefault(by_id[r.doc_id], set()).add(r.fingerprint)
    assert all(len(v) == 1 for v in by_text.values())
    assert len({f for v in by_text.values() for f in v}) == len(by_text)
    assert all("\r" not in r.fingerprint for r in got)


@pytest.mark.parametrize("partitions", ["1", "5"])
def test_order_of_ids(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        docs = spark.createDataFrame([(i, "t") for i in (5, 1, 9, None, 7, 9)], "doc_id bigint, text string")
        got = {r.doc_id: r.next_id for r in merkle._id_order(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {9: 7, 7: 5, 5: 1, 1: None, None: 9}


def test_edits_are_located(spark):
    lines = [f"line number {i} of the text" for i in range(40)]
    other = lines[:]
    other[17] = "changed"
    df = spark.createDataFrame([("\n".join(lines), "\n".join(other))], "a string, b string")
    a, b = merkle.tree(F.col("a")), merkle.tree(F.col("b"))
    row = df.select(merkle.changed_paragraphs(a, b).alias("x"), merkle.changed_paragraphs(a, a).alias("y"), a.alias("t")).first()
    assert row.x == [17] and row.y == []
    assert 1 < len(row.t.sections) < 40 and len(row.t.paragraphs) == 40
    assert row.t.paragraphs[0] == hashlib.sha256(lines[0].encode()).hexdigest()


def test_single_and_empty(spark, none):
    one = merkle.with_neighbours(spark.createDataFrame([(1, "abc")], "doc_id bigint, text string")).collect()
    assert [(r.doc_id, r.text, r.next_head) for r in one] == [(1, "abc", "a")]
    assert merkle.with_neighbours(none).collect() == []


def test_clashing_columns(docs, rows):
    odd = docs.withColumn("need", F.lit(1)).withColumn("part", F.lit(2)).withColumn("next", F.lit(3)).withColumn("head", F.lit(4))
    assert merkle.with_neighbours(odd).count() == len(rows)
