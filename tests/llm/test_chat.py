import hashlib

import pytest
from pyspark.sql import functions as F

from strutwise.llm import chat as C

ODD = ["\\", "\\\\<s>", "<\\s>", "a</s", "<<SYS>>x<</SYS>>", "[[INST]]", "[/INST", "\n\n", "", "</s>\\", "\\n", None, "[INST]</s><s>" * 3, "😀é ﬁ", "x " * 20_000]
ROLES = ["system", "user", "assi\nst\\[INST]", "assistant", None]
SCHEMA = "conv_id long, turn long, role string, text string"


def sha(s: str) -> str:
    return hashlib.sha256(s.encode()).hexdigest()


def check(turns, windows):
    got = {r.conv_id: r for r in C.digests(windows).collect()}
    by = {}
    for c, t, r, x in turns:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    assert got.keys() == by.keys()
    for c, own in by.items():
        own.sort(key=lambda v: (v[0], v[1], v[2].encode(), v[3].encode()))
        loss = "".join(x for _, _, r, x in own if r == "assistant")
        g = got[c]
        assert (g.n_turns, g.turns_sha256, g.loss_chars, g.loss_sha256) == (len(own), sha("".join(f"{r}\n{x}\n" for _, _, r, x in own)), len(loss), sha(loss))


@pytest.mark.parametrize("budget,history", [(20, 8), (1024, 128), (7, 0)])
def test_round_trip_of_control_strings(spark, budget, history):
    turns = [(i, k, r, x) for i, x in enumerate(ODD) for k, r in enumerate(ROLES)]
    check(turns, C.chat_windows(spark.createDataFrame(turns, SCHEMA), budget, history))


def test_nulls_ties_and_repeated_rows(spark):
    turns = [(None, 0, "user", "a"), (None, 0, "user", "a"), (1, None, "user", "b"), (1, None, "assistant", "c"), (1, 5000, "assistant", "d"), (1, -3, None, None), (2, 0, "assistant", "only")] * 2
    df = spark.createDataFrame(turns, SCHEMA).withColumn("pos", F.lit("x")).withColumn("before", F.lit(1)).withColumn("window", F.lit(2))
    check(turns, C.chat_windows(df, 30, 10))


def test_windows_keep_to_the_budget(spark):
    turns = [(c, k, "system" if k == 0 and c % 2 else ("user", "assistant")[k % 2], "word " * ((c * 7 + k * 13) % 40 + 1)) for c in range(6) for k in range(3000 if c == 0 else 60)]
    windows = C.chat_windows(spark.createDataFrame(turns, SCHEMA), 200, 50)
    check(turns, windows)
    assert windows.where("n_tokens > 200").count() == 0 == windows.where("over_budget").count()
    later = windows.where("window > 0 and conv_id % 2 = 1").select(C.parsed(F.col("formatted")).alias("t"), "n_repeated").collect()
    assert later and all(r.t[0].role == "system" and r.n_repeated >= 1 for r in later)
    assert windows.where("n_repeated > 1").count() > 0
    # repeated turns are those just before the window's first new one
    texts = {(c, k): x for c, k, _, x in turns}
    for r in windows.where("conv_id = 2").select("window", "n_repeated", C.parsed(F.col("formatted")).alias("t")).collect():
        assert [t.text for t in r.t[: r.n_repeated]] == [texts[2, r.window - r.n_repeated + k] for k in range(r.n_repeated)]


def brute(turns, budget, history, count):
    """Window starts and what each repeats: one conversation's turns, in order, with their tokens."""
    before = [sum(count[:k]) for k in range(len(count))]
    system = count[0] if turns[0][2] == "system" else 0
    out, k = [], 0
    while k < len(turns):
        h, held = 0, 0
        if k:
            allowed = min(history, max(0, budget - system - count[k]))
            while k - h - 1 >= (1 if system else 0) and held + count[k - h - 1] <= allowed:
                h, held = h + 1, held + count[k - h - 1]
        space = budget - (system + held if k else 0)
        end, used = k + 1, count[k]
        section = before[k] // (C.SECTION * budget)
        while end < len(turns) and used + count[end] <= space and before[end] // (C.SECTION * budget) == section:
            end, used = end + 1, used + count[end]
        out.append((k, [t[3] for t in turns[k - h : end]], h + bool(system and k), used + (system + held if k else 0)))
        k = end
    return out


def check_windows(spark, turns, budget, history):
    df = spark.createDataFrame(turns, SCHEMA)
    windows = C.chat_windows(df, budget, history)
    check(turns, windows)
    marked = df.select("*", *C._piece(F.col("role"), F.col("text"))).withColumn("n", C.token_count(F.col("piece"))).collect()
    by = {}
    for r in sorted(marked, key=lambda r: (r.conv_id, r.turn)):
        by.setdefault(r.conv_id, []).append(((r.conv_id, r.turn, r.role, r.text), r.n))
    want = {(c, k): (x, h, n) for c, own in by.items() for k, x, h, n in brute([t for t, _ in own], budget, history, [n for _, n in own])}
    rows = windows.select("conv_id", "window", C.parsed(F.col("formatted")).alias("t"), "n_repeated", "n_tokens", "over_budget").collect()
    system = {c: own[0][0][2] == "system" for c, own in by.items()}
    got = {(r.conv_id, r.window): ([t.text for t in r.t][1 if system[r.conv_id] and r.window else 0 :], r.n_repeated, r.n_tokens) for r in rows}
    assert got == want
    assert all(r.over_budget == (r.n_tokens > budget) and (not r.over_budget or len(r.t) - r.n_repeated == 1) for r in rows)
    return rows


def test_windows_are_filled_and_history_reaches_over_several_turns(spark):
    sizes = [420, 10, 80, 440, 20]
    turns = [(1, k, ("user", "assistant")[k % 2], "wor " * n) for k, n in enumerate(sizes)]
    assert len(check_windows(spark, turns, 1024, 128)) == 1
    second = [r for r in check_windows(spark, turns, 580, 128) if r.window > 0]
    assert [r.n_repeated for r in second] == [2, 0]


@pytest.mark.parametrize("step", [1, 2000])
def test_turn_numbers_make_no_difference(spark, step):
    turns = [(1, (1020 + k) * step, ("user", "assistant")[k % 2], "wor " * 8) for k in range(10)]
    assert len(check_windows(spark, turns, 1024, 128)) == 1


@pytest.mark.parametrize("budget,history", [(90, 45), (200, 0), (33, 64)])
def test_windows_against_brute_force(spark, monkeypatch, budget, history):
    monkeypatch.setattr(C, "SECTION", 4)
    turns = [(c, k, "system" if k == 0 and c % 2 else ("user", "assistant")[k % 2], "wor " * ((c * 7 + k * k * 13) % 23 + 60 * (k % 17 == 3))) for c in range(8) for k in range(400 if c < 2 else c)]
    rows = check_windows(spark, [t for t in turns], budget, history)
    assert any(r.over_budget for r in rows) == (budget < 200) and (history != 45 or any(r.n_repeated > 2 for r in rows))


def test_given_counts(spark):
    turns = [(1, k, "user", "x") for k in range(10)]
    df = spark.createDataFrame(turns, SCHEMA)
    assert C.chat_windows(df, 1024, 0, tokens=F.lit(500)).count() == 5 and C.chat_windows(df, 1024, 0).count() == 1


def test_estimated_tokens_are_near_the_vocabularys(spark, sf):
    from tokenizers import Tokenizer

    from strutwise.llm.tokenio import tokenizer_path

    rows = spark.read.parquet(f"{sf}/conversations.parquet").where("text <> ''").select("text", C.token_count(F.col("text")).alias("n")).collect()
    real = [len(e.ids) for e in Tokenizer.from_file(tokenizer_path()).encode_batch([r.text for r in rows], add_special_tokens=False)]
    assert 0.9 < sum(r.n for r in rows) / sum(real) < 1.2


def test_clashing_columns(spark):
    turns = [(1, k, ("user", "assistant")[k % 2], "wor " * 9) for k in range(30)]
    df = spark.createDataFrame(turns, SCHEMA)
    names = ["pos", "before", "window", "k", "new", "uid", "tokens", "head", "section", "at", "own", "piece", "lead", "loss", "size", "given", "place", "part", "__z", "__c", "like", "start"]
    wide = df.select("*", *[F.lit(f"own {c}").alias(c) for c in names])
    assert sorted(C.chat_windows(wide, 100, 30).collect()) == sorted(C.chat_windows(df, 100, 30).collect())


def test_a_long_turn_is_whole_and_flagged(spark):
    turns = [(1, 0, "user", "w " * 5000), (1, 1, "assistant", "ok")]
    windows = C.chat_windows(spark.createDataFrame(turns, SCHEMA), 100, 10)
    check(turns, windows)
    assert windows.where("over_budget").count() == 1


def test_empty(spark):
    assert C.chat_windows(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query(spark, sf):
    text = "</s>[INST] ok [/INST]"
    turns = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    turns += [(-1, 0, "user", text), (-1, 1, "assistant", text)]
    check(turns, C.chat_windows(spark.createDataFrame(turns, SCHEMA)))
    got = {r.conv_id: r for r in C.op1_chat_windows(spark, sf).collect()}
    assert got[-1].loss_sha256 == sha(text) and got.keys() == {t[0] for t in turns}


def test_main_path_has_no_python(spark, sf):
    plan = C.op1_chat_windows(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
