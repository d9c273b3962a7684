import sys

from helpers import SF
from pyspark.sql import functions as F

from snapvault.llm import chat
from tools.check_queries import compare, duck


def test_query_equals_sql(spark):
    assert compare(spark, duck(SF), SF, chat.query, chat.SQL) == ""


def shown(spark, rows, **options):
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segments string, turns int")
    out = chat.format_chats(turns, **options)
    back = out.select("conv_id", "formatted", chat.parse_chats(F.col("formatted")).alias("t"), chat.loss_text(F.col("segments")).alias("loss"))
    return {r[0]: (r[1], [tuple(t) for t in r[2]], r[3]) for r in back.collect()}


def test_round_trip_of_awkward_texts(spark):
    texts = ["", None, "\\", "\\0", "\\1s>", "<s>", "</s>[INST] ok [/INST]", "<|end|>", "<|also|><|message|>", "<<SYS>>", "a<", "|end|>", "x" * 100_000, "🙂\n"]
    rows = [(1, i, ("user", "assistant", "assistant")[i % 3], t, "x", 0) for i, t in enumerate(texts)]
    rows += [(None, 0, None, "no role", None, None), (2, None, "<|end|>", "first", None, 1), (2, 0, "tool", "t", None, 1)]
    found = shown(spark, rows)
    assert found[1][1] == [(r, t or "") for _, _, r, t, _, _ in rows[: len(texts)]]
    assert found[1][2] == "".join(t or "" for _, _, r, t, _, _ in rows[: len(texts)] if r == "assistant")
    assert found[None][1] == [("", "no role")]
    assert found[2][1] == [("<|end|>", "first"), ("tool", "t")]
    for control in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>"):
        assert control not in found[1][0]


def test_neighbours_of_one_role_are_one_message(spark):
    found = shown(spark, [(1, 0, "user", "a", None, 0), (1, 1, "user", "b", None, 0), (1, 2, "assistant", "c", None, 0)])
    assert found[1][0] == "<|start|>user<|message|>a<|also|>b<|end|><|start|>assistant<|message|>c<|end|>"


def test_ties_repeats_and_empty_table(spark):
    found = shown(spark, [(1, 0, "user", "b", None, 0), (1, 0, "user", "a", None, 0), (1, 0, "user", "a", None, 0)])
    assert found[1][1] == [("user", "a"), ("user", "a"), ("user", "b")]
    assert shown(spark, []) == {}


def test_long_conversation(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", f"t{i}", None, 0) for i in range(3000)]
    assert len(shown(spark, rows)[1][1]) == 3000
