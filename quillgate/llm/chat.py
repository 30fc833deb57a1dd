"""Chat formatting with Spark expressions only.

    [INST]role[/INST]text<s>text</s>[INST]role[/INST]text</s>

A block names its role, holds the texts of adjacent turns of that role with
``<s>`` between them, and ends with ``</s>``.  The four control strings never
occur inside a role or a text: there a backslash is set after their first
character, one more than were there before, so reading back takes one away.
Texts are otherwise kept to the character.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE, PART, END = "[INST]", "[/INST]", "<s>", "</s>"
_ESCAPE = r"([\[<])(\\*)(/?INST\]|/?s>)"
_UNESCAPE = r"([\[<])\\(\\*)(/?INST\]|/?s>)"
#: turns that are put together before they meet the rest of a conversation
TURNS_PER_CHUNK = 64


def escape(text: Column) -> Column:
    return F.regexp_replace(text, _ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, _UNESCAPE, "$1$2$3")


def format_conversations(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted.

    Turns are ordered by turn number (null first), then role, then text, so
    equal and repeated rows have one defined order; each row is a turn.  Null
    texts and roles count as empty.  A null conv_id is a conversation of its
    own.  An empty table gives no rows.

    Turns are gathered in chunks of neighbouring turn numbers first, each
    merged and written as text, and the few chunks joined in order afterwards:
    where one chunk ends and the next begins with the same role, its block
    goes on.
    """
    rows = turns.select(
        F.col(conv_id).alias("conv_id"), F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"),
    ).withColumn("chunk", F.floor(F.col("turn") / TURNS_PER_CHUNK))
    chunks = rows.groupBy("conv_id", "chunk").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    chunks = chunks.select("conv_id", "chunk", F.col("t")[0]["role"].alias("first"), F.element_at("t", -1)["role"].alias("last"),
                           _body(F.col("t")).alias("body"))
    whole = chunks.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("chunk", "first", "last", "body"))).alias("t"))

    def join(x: Column, i: Column) -> Column:
        return F.concat(_lead(F.col("t"), x["first"], i, "last"), x["body"])

    return whole.select("conv_id", F.concat(F.array_join(F.transform("t", join), ""), F.lit(END)).alias("formatted"))


def _lead(turns: Column, role: Column, i: Column, last: str) -> Column:
    """What stands before turn ``i``: a part sign if its role goes on."""
    header = F.concat(F.lit(OPEN), escape(role), F.lit(CLOSE))
    return (
        F.when(i == 0, header)
        .when(F.get(turns, i - 1)[last] == role, F.lit(PART))
        .otherwise(F.concat(F.lit(END), header))
    )


def _body(turns: Column) -> Column:
    """Sorted turns as text, without the header of the first one."""

    def one(x: Column, i: Column) -> Column:
        return F.concat(F.when(i == 0, F.lit("")).otherwise(_lead(turns, x["role"], i, "role")), escape(x["text"]))

    return F.array_join(F.transform(turns, one), "")


def read_back(formatted: Column) -> Column:
    """The turns of a formatted conversation: array of (role, text)."""
    blocks = F.slice(F.split(formatted, END), 1, F.size(F.split(formatted, END)) - 1)

    def turns(block: Column) -> Column:
        at = F.instr(block, CLOSE)
        role = unescape(F.substr(block, F.lit(len(OPEN) + 1), at - len(OPEN) - 1))
        parts = F.split(F.substr(block, at + len(CLOSE)), PART)
        return F.transform(parts, lambda p: F.struct(role.alias("role"), unescape(p).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def with_loss_mask(formatted: DataFrame, trained: str = "assistant") -> DataFrame:
    """Adds ``turns`` and ``loss_text``: what lies under the loss mask, which
    covers the texts of the trained role and nothing else."""
    turns = formatted.withColumn("turns", read_back(F.col("formatted")))
    mine = F.transform(F.filter("turns", lambda t: t["role"] == trained), lambda t: t["text"])
    return turns.withColumn("loss_text", F.array_join(mine, ""))
