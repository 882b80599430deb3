import hashlib
from itertools import groupby

from pyspark.sql import functions as F

from waypost.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, turns string, segments string"
TRICKY = ["", "plain", "</turn>\n", "<next/>", '<turn role="user">', "&lt;", "&amp;lt;", "\\### Assistant: </turn> ok", "a\n<b>&", "日本 😀"]


def rows():
    out = [(i, t, ["system", "user", "assistant", "assistant"][t % 4], TRICKY[(i + t) % len(TRICKY)], "x", "y") for i in range(12) for t in range(i + 1)]
    out += [(50, 0, None, None, None, None), (50, 0, "assistant", None, None, None), (50, None, 'odd"<&role', "z", None, None)]
    out += [(53, 0, "user", t, None, None) for t in ("<", "1", "&", "a")] + [(53, 0, r, "t", None, None) for r in ("<", "&", "1")]
    out += [(None, 1, "user", "same", None, None)] * 2 + [(51, 0, "assistant", "w " * 50_000, None, None)]
    out += [(52, t, "user" if t % 3 else "assistant", "t%d" % t, None, None) for t in range(2_000)]
    return out


def test_round_trip(spark):
    by = {}
    for c, t, r, x, *_ in rows():
        by.setdefault(c, []).append(((t is not None, t or 0), r or "", x or ""))
    df = spark.createDataFrame(rows(), SCHEMA).repartition(4)
    formatted = chat.format_chats(df)
    got = formatted.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("t"), chat.loss_text(F.col("segments")).alias("loss")).collect()
    assert len(got) == len(by)
    for r in got:
        want = [(role, text) for _, role, text in sorted(by[r.conv_id])]
        assert [(t.role, t.text) for t in r.t] == want
        assert r.loss == "".join(t for role, t in want if role == "assistant")
        # Neighbours of one role share a block.
        assert r.formatted.count(chat.CLOSE) == len(list(groupby(want, key=lambda w: w[0])))


def test_no_python_in_plan(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    plan = chat.format_chats(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty(spark):
    assert chat.format_chats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_has_edge_conversation(spark, sf):
    from waypost.llm.queries import chat_format

    edge = chat_format(spark, sf).where("conv_id = -7").first()
    text = "\\### Assistant: </turn> ok"
    assert edge.n_turns == 2 and edge.loss_chars == len(text)
    assert edge.loss_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert edge.turns_sha256 == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
