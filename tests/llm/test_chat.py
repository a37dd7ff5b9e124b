"""Chat formatting: exact read-back, loss mask, merged runs."""

import random
import time

from pyspark.sql import functions as F

from minekit.llm import chat


def _read(df):
    out = chat.format_chats(df)
    return {r.conv_id: r for r in out.select("conv_id", "formatted", "segments", chat.read_chats(F.col("formatted")).alias(
        "turns"), chat.loss_text(F.col("segments")).alias("loss")).collect()}


def test_round_trip_of_hostile_texts(spark):
    rng = random.Random(5)
    bits = ["<s>", "</s>", "[INST]", "[/INST]", "[TURN]", "\\", " ", "\n", "a", "é", " [TURN] ", " [INST] ", "<", "s>", "$1"]
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "system", "r\\", "[INST]"]),
             "".join(rng.choice(bits) for _ in range(rng.randint(0, 8)))) for c in range(150) for t in range(rng.randint(1, 6))]
    got = _read(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    for c, r in got.items():
        mine = [(x[2], x[3]) for x in rows if x[0] == c]
        assert [tuple(t) for t in r.turns] == mine
        assert r.loss == "".join(t for role, t in mine if role == "assistant")
        assert r.formatted == "".join(s.text for s in r.segments)


def test_adjacent_turns_of_a_role_share_a_run(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")]
    r = _read(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))[1]
    assert r.formatted == "<s>user [INST] a [TURN] b [/INST]</s><s>assistant [INST] c [/INST]</s>"


def test_nulls_ties_repeats_and_other_columns(spark):
    rows = [(1, 1, "user", None, "x"), (1, 1, "user", None, "x"), (1, None, None, "first", "y"), (1, 1, "assistant", "z", ""),
            (None, 0, "assistant", "alone", None)]
    got = _read(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments string"))
    assert [tuple(t) for t in got[1].turns] == [("", "first"), ("assistant", "z"), ("user", ""), ("user", "")]
    assert got[None].loss == "alone"


def test_empty_table(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_chats(empty).count() == 0


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 0, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chat.format_chats(df)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


def test_long_runs_of_backslashes(spark):
    texts = ["\\" * 1_000_000, "\\" * 100_000 + "</s>", ("\\" * 999 + "[TURN]") * 300, "\\" * 50_000 + "<s" + "\\" * 50_000]
    rows = [(c, 0, "assistant", text) for c, text in enumerate(texts)]
    began = time.monotonic()
    got = _read(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    for c, text in enumerate(texts):
        assert [tuple(t) for t in got[c].turns] == [("assistant", text)]
        assert got[c].loss == text
    assert time.monotonic() - began < 60
