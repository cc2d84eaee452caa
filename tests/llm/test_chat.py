import random

import pytest
from pyspark.sql import functions as F

from tickloom.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, block string, rows int"
PIECES = ["### ", ":\n", "<next>", "</turn>\n", "\\", "\\b", "\\h", "#", "<", "é", "🙂", "", "plain", "\n", "user"]


def hostile(n=300):
    pick = random.Random(5)
    rows = []
    for k in range(n):
        role = pick.choice(["user", "assistant", "assistant", "sys:tem", "a\\<#:\nb", None])
        rows.append((pick.choice([1, 2, 3, None]), pick.choice([k, k, 7, None]), role, pick.choice([None, "".join(pick.choices(PIECES, k=5))]), "x", 1))
    return rows


def plain(rows):
    out = {}
    order = lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for r in sorted(rows, key=order):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


@pytest.mark.parametrize("block", [1, 3, 64, 100000])
def test_what_was_said_is_read_back(spark, block):
    rows = hostile()
    chats = chat.format_chats(spark.createDataFrame(rows, SCHEMA), block_turns=block)
    read = chats.select("*", chat.read_turns(F.col("text")).alias("turns"), chat.read_loss(F.col("text"), F.col("loss")).alias("trained"))
    got = {r.conv_id: r for r in read.collect()}
    want = plain(rows)
    assert got.keys() == want.keys()
    for conv, turns in want.items():
        r = got[conv]
        assert [tuple(t) for t in r.turns] == turns
        said = [t for role, t in turns if role == "assistant"]
        assert r.trained == "".join(said)
        # the spans in code points say the same as those in bytes
        spans = [r.text[s.start : s.start + s.length] for s in r.loss]
        assert [x.replace("\\h", "#").replace("\\l", "<").replace("\\b", "\\") for x in spans] == said
        runs = sum(1 for k, t in enumerate(turns) if k == 0 or turns[k - 1][0] != t[0])
        assert r.text.count("</turn>\n") == runs and r.text.count("<next>") == len(turns) - runs


def test_same_role_turns_are_merged(spark):
    rows = [(1, 0, "user", "a", "", 0), (1, 1, "user", "b", "", 0), (1, 2, "assistant", "c", "", 0)]
    text = chat.format_chats(spark.createDataFrame(rows, SCHEMA)).first().text
    assert text == "### user:\na<next>b</turn>\n### assistant:\nc</turn>\n"


def test_no_turns(spark):
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_no_python_in_the_plan(spark):
    chats = chat.format_chats(spark.createDataFrame([(1, 0, "user", "a", "", 0)], SCHEMA))
    plan = chats._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
