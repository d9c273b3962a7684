"""Chat formatting: conversations as marked text with a loss mask, in Spark expressions only.

Turns of a conversation are collected as structs and sorted; neighbours of one role become one message whose parts
stay apart by a marker; the message pieces are joined. Everything is linear in the length of a conversation.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

START, MESSAGE, ALSO, END = "<|start|>", "<|message|>", "<|also|>", "<|end|>"
# Control strings of this template and of others in use. Each begins with "<" or "[".
CONTROLS = (
    START, MESSAGE, ALSO, END,
    "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>",
    "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>",
)
ESCAPE = "\\"
_CODES = {"<": f"{ESCAPE}1", "[": f"{ESCAPE}2"}


def _replace(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def escape(text: Column) -> Column:
    """``text`` without any control string: the escape character and each control string's first letter are coded."""
    coded = _replace(text, ESCAPE, f"{ESCAPE}0")
    return reduce(lambda t, c: _replace(t, c, _CODES[c[0]] + c[1:]), CONTROLS, coded)


def unescape(text: Column) -> Column:
    """The inverse of :func:`escape`; an escaped text has a code digit after each escape character."""
    opened = reduce(lambda t, c: _replace(t, _CODES[c], c), _CODES, text)
    return _replace(opened, f"{ESCAPE}0", ESCAPE)


def format_chats(
    turns: DataFrame,
    *,
    conversation: str = "conv_id",
    order: str = "turn",
    role: str = "role",
    text: str = "text",
    loss_roles: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row a conversation: id, ``formatted`` and ``segments``, the same text in pieces with the loss mask.

    Null text or role: empty. Null order: before all others; ties go by role, then by text. A null conversation is one
    of its own. Repeated rows are repeated turns. Other columns are left out. An empty table gives no rows.
    """
    turn = F.struct(
        F.col(f"`{order}`").alias("o"),
        F.coalesce(F.col(f"`{role}`").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )
    grouped = turns.select(F.col(f"`{conversation}`").alias(conversation), turn.alias("t"))
    grouped = grouped.groupBy(conversation).agg(F.sort_array(F.collect_list("t")).alias("turns"))
    size = F.size("turns")
    starts = F.filter(
        F.sequence(F.lit(0), size - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"]),
    )
    grouped = grouped.withColumn("starts", starts)
    runs = F.transform(
        "starts",
        lambda s, k: F.struct(
            F.get("turns", s)["role"].alias("role"),
            F.transform(
                F.slice("turns", s + 1, F.coalesce(F.get("starts", k + 1), size) - s), lambda t: t["text"]
            ).alias("texts"),
        ),
    )
    grouped = grouped.select(conversation, runs.alias("runs"))
    segments = F.flatten(F.transform("runs", lambda r: _message(r, loss_roles)))
    made = grouped.select(conversation, segments.alias("segments"))
    joined = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return made.select(conversation, joined.alias("formatted"), "segments")


def _segment(text: Column, loss: Column | bool) -> Column:
    return F.struct(text.alias("text"), (F.lit(loss) if isinstance(loss, bool) else loss).alias("loss"))


def _message(run: Column, loss_roles: tuple[str, ...]) -> Column:
    head = F.concat(F.lit(START), escape(run["role"]), F.lit(MESSAGE))
    loss = run["role"].isin(*loss_roles) if loss_roles else F.lit(False)
    parts = F.transform(
        run["texts"],
        lambda t, j: F.when(j == 0, F.array(_segment(escape(t), loss))).otherwise(
            F.array(_segment(F.lit(ALSO), False), _segment(escape(t), loss))
        ),
    )
    return F.concat(F.array(_segment(head, False)), F.flatten(parts), F.array(_segment(F.lit(END), False)))


def parse_chats(formatted: Column) -> Column:
    """The turns of a formatted conversation: an array of structs ``role``, ``text``; the way back."""
    messages = F.filter(F.split(formatted, r"<\|end\|>"), lambda m: m != "")
    return F.flatten(
        F.transform(
            messages,
            lambda m: F.transform(
                F.split(F.substring_index(m, MESSAGE, -1), r"<\|also\|>"),
                lambda t: F.struct(
                    unescape(F.replace(F.substring_index(m, MESSAGE, 1), F.lit(START), F.lit(""))).alias("role"),
                    unescape(t).alias("text"),
                ),
            ),
        )
    )


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def query(spark, sf_dir):
    from snapvault.llm.common import read

    probe = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame(
        [(-7, 0, "user", probe), (-7, 1, "assistant", probe)], "conv_id long, turn long, role string, text string"
    )
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    chats = format_chats(turns).select(
        "conv_id", "formatted", parse_chats(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss")
    )
    told = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def _sql_escape(column):
    out = f"replace({column}, '\\', '\\0')"
    for control in CONTROLS:
        out = f"replace({out}, '{control}', '{_CODES[control[0]]}{control[1:]}')"
    return out


_FRAME = len(START) + len(MESSAGE) + len(END)
SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
m AS (SELECT *, lag(role) OVER w IS DISTINCT FROM role AS opens, row_number() OVER w AS place FROM t
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY place) AS told,
  coalesce(string_agg(text, '' ORDER BY place) FILTER (WHERE role = 'assistant'), '') AS loss,
  sum(length({_sql_escape("text")}) + CASE WHEN opens THEN {_FRAME} + length({_sql_escape("role")}) ELSE {len(ALSO)} END)
    AS formatted_chars FROM m GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars FROM g
"""
