"""Chat windows: equal to SQL on whole tables, reversible for any text, within the budget."""

import random

import pytest
from pyspark.sql import functions as F

from llm.conftest import ODD
from millrace.llm import chat
from millrace.llm.queries import QUERIES
from oracle import connect, difference

SCHEMA = "conv_id long, turn long, role string, text string, window string, loss int"


def test_query_equals_sql(spark, sf):
    query = QUERIES["op1_chat_format"]
    assert difference(query.run(spark, sf), connect(sf), query.sql) is None


def learnt_and_said(rows):
    said, learnt = [], []
    for r in sorted(rows, key=lambda r: r["window"]):
        said += [(t["role"], t["text"]) for t in r["turns"][r["repeated"]:]]
        learnt += r["learnt"]
    return said, learnt


def formatted(spark, turns, **settings):
    return chat.windows(turns, **settings).withColumns({
        "turns": chat.read_back(F.col("formatted")),
        "learnt": chat.under_mask(F.col("formatted"), F.col("loss"))}).collect()


@pytest.mark.parametrize("budget, history", [(60, 20), (60, 50), (40, 0), (12, 4)])
def test_random_conversations(spark, budget, history):
    draw = random.Random(budget + history)
    tricky = [*chat.CONTROL, "<\\|turn|>", "<\\\\s>", "\\", "\n", "<", "[/", "ok", "é", " ", "<|turn|", "|end|>"]
    turns, wanted = [], {}
    for conv in range(30):
        for turn in range(draw.randint(1, 25)):
            role = "system" if turn == 0 and conv % 3 else draw.choice(["user", "assistant", "system"])
            text = "".join(draw.choices(tricky, k=draw.randint(0, 9)))
            turns.append((conv, turn, role, text, "x", 0))
            wanted.setdefault(conv, []).append((role, text))
    draw.shuffle(turns)
    rows = formatted(spark, spark.createDataFrame(turns, SCHEMA), budget=budget, history=history)
    by = {}
    for r in rows:
        by.setdefault(r["conv_id"], []).append(r)
        whole = [(t["role"], t["text"]) for t in r["turns"]]
        conversation = wanted[r["conv_id"]]
        retained = conversation[0][0] == "system"
        if retained:
            assert whole[0] == conversation[0]
        # After the system turn a window is one stretch of the conversation.
        rest = whole[1:] if retained else whole
        assert any(conversation[i:i + len(rest)] == rest for i in range(len(conversation)))
        assert r["over_budget"] == (r["tokens"] > budget)
        if r["over_budget"]:
            assert r["own"] - (r["repeated"] == 0 and retained) <= 1
        for mark in chat.CONTROL:
            inside = r["formatted"].count(mark)
            assert inside == (len(whole) if mark in (chat.BEGIN, chat.END) else 0)
    for conv, conversation in wanted.items():
        said, learnt = learnt_and_said(by[conv])
        assert said == conversation
        assert learnt == [t for role, t in conversation if role == "assistant" and t]


def test_history_is_as_long_as_allowed(spark):
    turns = [(1, i, "user", "word " * 6, "", 0) for i in range(12)]  # eleven tokens each
    rows = formatted(spark, spark.createDataFrame(turns, SCHEMA), budget=60, history=25)
    later = sorted(rows, key=lambda r: r["window"])[1:]
    assert all(r["tokens"] <= 60 for r in rows)
    assert {r["repeated"] for r in later} == {2}


def test_odd_texts(spark):
    turns = [(i, 0, "assistant", t, "", 0) for i, t in enumerate(ODD)]
    turns += [(100, 0, "system", "alone", "", 0), (None, 1, "user", "no key", "", 0), (None, 2, None, None, "", 0),
              (101, 1, "user", "twice", "", 0), (101, 1, "user", "twice", "", 0), (102, None, "a\n<|end|>[\\1", "x", "", 0)]
    rows = formatted(spark, spark.createDataFrame(turns, SCHEMA))
    by = {r["conv_id"]: r for r in rows}
    assert len(by) == len(rows) == len(ODD) + 4
    for i, t in enumerate(ODD):
        assert [tuple(x) for x in by[i]["turns"]] == [("assistant", t or "")]
    assert [tuple(x) for x in by[100]["turns"]] == [("system", "alone")] and by[100]["own"] == 1
    assert [tuple(x) for x in by[None]["turns"]] == [("user", "no key"), ("", "")]
    assert len(by[101]["turns"]) == 2
    assert by[102]["turns"][0]["role"] == "a\n<|end|>[\\1"
    assert chat.windows(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark, sf):
    plan = QUERIES["op1_chat_format"].run(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))
