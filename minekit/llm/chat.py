"""Chat formatting with Spark expressions only.

Turns of a conversation are collected as structs, sorted by (turn, role,
text), adjacent turns of one role become one run, and the runs are
concatenated:

    <s>ROLE [INST] TEXT [TURN] TEXT [/INST]</s>

Control strings inside a role or a text get one backslash more in front
(``\\</s>``), also where backslashes stand there already, so removing one
restores the text.  Every live control string follows a space, ``]`` or the
beginning, never a backslash.

``segments`` is the loss mask: the formatted string cut into pieces, each
with a flag that says whether loss is taken on it.  Only the assistant's
(escaped) texts are under the mask, each in a piece of its own.

Defined cases: a null text or role is empty; rows with equal turn are ordered
by role and text, and repeated rows stay repeated; a null turn comes first; a
null conv_id is a conversation like any other; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The template's control strings (fixed values of this format).
CONTROL = ["<s>", "</s>", "[INST]", "[/INST]", "[TURN]"]
_ANY = r"(?:<s>|</s>|\[INST\]|\[/INST\]|\[TURN\])"
#: A match begins where a run of backslashes does and takes it whole, so no run is
#: read twice and a text of backslashes alone takes linear time.
_RUN = r"(?<!\\)"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"{_RUN}(\\*+{_ANY})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"{_RUN}\\(\\*+{_ANY})", "$1")


def format_chats(turns: DataFrame) -> DataFrame:
    """``conv_id, formatted, segments`` from rows ``conv_id, turn, role, text``."""
    rows = turns.select("conv_id", F.struct(
        "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")).alias("t"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    # positions (from 0) where a run of one role begins, then the runs
    chats = chats.withColumn("starts", F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda i: (i == 0) | (F.get("turns", i)["role"] != F.get("turns", i - 1)["role"])))
    chats = chats.withColumn("runs", F.transform("starts", lambda s, k: F.struct(
        F.get("turns", s)["role"].alias("role"),
        F.transform(F.slice("turns", s + 1, F.coalesce(F.get("starts", k + 1), F.size("turns")) - s),
                    lambda t: escape(t["text"])).alias("texts"))))

    def piece(text: Column, loss: Column) -> Column:
        return F.struct(text.alias("text"), loss.alias("loss"))

    no = F.lit(False)
    chats = chats.withColumn("segments", F.flatten(F.transform("runs", lambda r: F.concat(
        F.array(piece(F.concat(F.lit("<s>"), escape(r["role"]), F.lit(" [INST] ")), no)),
        F.flatten(F.transform(r["texts"], lambda t, i: F.array(
            piece(F.when(i == 0, F.lit("")).otherwise(F.lit(" [TURN] ")), no),
            piece(t, r["role"] == LOSS_ROLE)))),
        F.array(piece(F.lit(" [/INST]</s>"), no))))))
    return chats.select("conv_id", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
                        "segments")


def read_chats(formatted: Column) -> Column:
    """The turns ``array<struct<role, text>>`` of a formatted conversation."""
    runs = F.filter(F.split(formatted, r"(?<!\\)</s>", -1), lambda r: r != "")

    def turns(run: Column) -> Column:
        head = F.split(run, r" \[INST\] ", 2)
        role = unescape(F.substr(F.get(head, F.lit(0)), F.lit(4)))
        body = F.get(head, F.lit(1))
        body = F.left(body, F.length(body) - len(" [/INST]"))
        return F.transform(F.split(body, r" \[TURN\] ", -1),
                           lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(runs, turns))


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped piece by piece, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
