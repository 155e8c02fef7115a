import hashlib
import random

import pytest
from pyspark.sql import functions as F

from callcredit.llm import chat

PARTS = ["</s>", "[INST]", "[/INST]", "<s>", "\\", "\n", "[", "<", "/", "INST]", "s>", "é", "word ", "$1", ""]


def read(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id bigint, turn bigint, role string, text string, turns string")
    return {r.conv_id: r for r in chat.read_back(chat.format_chats(df)).collect()}


def test_every_turn_comes_back(spark):
    rng = random.Random(2)
    rows = []
    for c in range(60):
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", "system", None, "a[INST]\n"]), "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 8)))))
    rows += [(c, t, "assistant", None) for c, t in ((100, 0), (100, 1))] + [(None, 0, "user", "hi"), (101, None, "user", "first"), (101, 0, "user", "tie b"), (101, 0, "user", "tie a")]
    got = read(spark, rows)
    by = {}
    for c, t, r, x in rows:
        by.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    for c, turns in by.items():
        turns.sort()
        assert [(t.role, t.text) for t in got[c].turns] == [(r, x) for *_, r, x in turns]
        assert got[c].loss_text == "".join(x for *_, r, x in turns if r == "assistant")
        for s in got[c].loss_spans:
            assert 0 <= s.start <= s.end <= len(got[c].formatted)


def test_merged_turns_share_a_block(spark):
    got = read(spark, [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")])[1]
    assert got.formatted == "[INST]user[/INST]a<s>b</s>[INST]assistant[/INST]c</s>"
    assert [got.formatted[s.start:s.end] for s in got.loss_spans] == ["c"]


def test_long_conversation_offsets(spark):
    n = 1000
    got = read(spark, [(1, t, "assistant" if t % 3 else "user", f"text {t} " * (t % 5)) for t in range(n)])[1]
    assert len(got.turns) == n
    want = "".join(f"text {t} " * (t % 5) for t in range(n) if t % 3)
    assert hashlib.sha256(got.loss_text.encode()).hexdigest() == hashlib.sha256(want.encode()).hexdigest()


def test_empty_table_and_expressions_only(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert chat.format_chats(df).count() == 0
    plan = chat.read_back(chat.format_chats(df))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("n", [1, 2, 255, 256, 257, 1025])
def test_sums_before(spark, n):
    xs = [i % 7 for i in range(n)]
    got = spark.range(1).select(chat._sums_before(F.lit(xs)).alias("s")).first().s
    assert got == [sum(xs[:i]) for i in range(n)]
