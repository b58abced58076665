import hashlib
import random

from pyspark.sql import functions as F

from sparkcurate.llm import chat_format as C

SAID = ["", "###", "####", "#####", "</turn>", "</</turn>turn>", "\\", "\\h", "\\\\###\\", "### user:\nhi</turn>\n", "\n", "é\U0001f600", "a: b", "\\### Assistant: </turn> ok"]


def test_escapes_are_reversible():
    rng = random.Random(1)
    for _ in range(500):
        text = "".join(rng.choice(SAID) for _ in range(rng.randrange(6)))
        for table in (C.ESCAPES, C.ROLE_ESCAPES):
            coded = C.escape(text, table)
            assert C.unescape(coded) == text and "###" not in coded and "</turn>" not in coded


def conversations():
    rng = random.Random(2)
    rows = []
    for c in [*range(25), None]:
        n = rng.randrange(1, 40)
        for t in range(n):
            role = "system" if t == 0 and rng.random() < 0.5 else rng.choice(["user", "assistant", "assistant", "tool: x\ny", None])
            text = None if rng.random() < 0.1 else " ".join(rng.choice([*SAID, "word", "more words"]) for _ in range(rng.choice([0, 1, 5, 40, 700])))
            rows.append((c, t if rng.random() < 0.9 else 1, role, text))
    rows += rows[5:8]
    return rows


def by_conversation(rows):
    out = {}
    for c, t, role, text in rows:
        out.setdefault(c, []).append((t, role or "", text or ""))
    # Spark orders text by its UTF-8 bytes.
    return {c: sorted(v, key=lambda x: (x[0], x[1].encode(), x[2].encode())) for c, v in out.items()}


def test_digests(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string").withColumn("window", F.lit(1)).withColumn("loss", F.lit("x"))
    windows = C.format_windows(df)
    got = {r.conv_id: r for r in C.read_back(windows).collect()}
    want = by_conversation(rows)
    size = {r.conv_id: r.n for r in windows.groupBy("conv_id").agg(F.sum(F.length("text")).alias("n")).collect()}
    assert got.keys() == want.keys()
    for c, turns in want.items():
        said = "".join(x for _, role, x in turns if role == "assistant")
        r = got[c]
        assert r.n_turns == len(turns) and r.loss_chars == len(said) and r.formatted_chars == size[c]
        assert r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert r.turns_sha256 == hashlib.sha256("".join(f"{role}\n{x}\n" for _, role, x in turns).encode()).hexdigest()


def test_windows(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    want = by_conversation(rows)
    for c, turns in want.items():
        at = 0
        own = df.where(F.col("conv_id").eqNullSafe(F.lit(c)))
        for w in sorted(C.format_windows(own).collect(), key=lambda r: r.window):
            found = C.read_turns(w.text)
            fresh = found[w.repeated :]
            assert fresh and fresh == [t[1:] for t in turns[at : at + len(fresh)]]
            cost = [C.word_tokens(x) for _, x in found]
            system = turns[0][1] == "system" and w.window > 0
            if system:
                assert found[0] == turns[0][1:]
            history = found[system : w.repeated]
            assert history == [t[1:] for t in turns[at - len(history) : at]]
            assert sum(cost[system : w.repeated]) <= C.HISTORY
            assert sum(cost) <= C.BUDGET or (len(fresh) == 1 and not history)
            at += len(fresh)
        assert at == len(turns)
        if c is not None and c > 4:
            break


def test_history_gives_way_to_the_next_turn(spark):
    """Turns of up to 480 tokens: a window is above the budget only when the system turn and one turn are."""
    rng = random.Random(6)
    rows = []
    for c in range(12):
        rows += [(c, 0, "system", " ".join(["s"] * rng.choice([5, 60])))]
        rows += [(c, t, rng.choice(["user", "assistant"]), " ".join(["w"] * rng.choice([20, 90, 476, 440]))) for t in range(1, 30)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn int, role string, text string")
    above = repeats = 0
    for w in C.format_windows(df).collect():
        cost = [C.word_tokens(x) for _, x in C.read_turns(w.text)]
        above += sum(cost) > C.BUDGET
        repeats += w.repeated > 1
        assert sum(cost) <= C.BUDGET or (len(cost) == 2 and w.repeated == 1)
    assert above and repeats


def test_query_and_empty(spark, tmp_path):
    spark.createDataFrame([], "conv_id bigint, turn int, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    (r,) = C.op8_chat_windows(spark, str(tmp_path)).collect()
    said = "\\### Assistant: </turn> ok"
    assert (r.conv_id, r.n_turns, r.loss_chars) == (-7, 2, len(said)) and r.loss_sha256 == hashlib.sha256(said.encode()).hexdigest()
