"""Chat formatting by prefix-target expansion (DataFrame functions only).

Every assistant turn becomes an example of its own: all turns before it as context, and only its text
under the loss mask. Turns after the last reply, or a conversation without a reply, give one more example
of context alone with an empty mask, so that no turn is lost.

A turn is written ``<s>[INST]role[/INST]text</s>``. Control strings inside a role or text get a backslash
behind their first character, after every backslash has been doubled; ``unescape`` undoes both.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

OPEN, HEAD, END = "<s>[INST]", "[/INST]", "</s>"


def escape(text: Column) -> Column:
    doubled = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, r"([<\[])(/?s>|/?INST\])", r"$1\\$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def examples(turns: DataFrame) -> DataFrame:
    """(conv_id, example, formatted, loss_start, loss_chars) from (conv_id, turn, role, text).

    ``loss_start`` counts code points from 0. Rows of a conversation are ordered by turn, ties by role
    and text, a null turn first; null roles and texts are empty; null conv_ids form one conversation;
    repeated rows are repeated turns. A conversation is one row here because its last example holds all of
    it; conversations are what the work is spread by. Other columns are ignored.
    """
    empty = F.lit("")
    turn = F.struct(
        "turn", F.coalesce(F.col("role"), empty).alias("role"), escape(F.coalesce(F.col("text"), empty)).alias("body")
    )
    whole = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    marked = whole.select(
        "conv_id", "turns",
        F.transform("turns", lambda t: F.concat(F.lit(OPEN), escape(t["role"]), F.lit(HEAD), t["body"], F.lit(END)))
        .alias("parts"),
    )
    last = F.size("turns") - 1
    targets = F.filter(
        F.sequence(F.lit(0), last), lambda i: (F.get("turns", i)["role"] == "assistant") | (i == last)
    )
    rows = marked.select("conv_id", "turns", "parts", F.posexplode(targets).alias("example", "at"))
    reply = F.get("turns", F.col("at"))
    chars = F.when(reply["role"] == "assistant", F.length(reply["body"])).otherwise(0)
    return rows.select(
        "conv_id", "example", F.array_join(F.slice("parts", F.lit(1), F.col("at") + 1), "").alias("formatted"),
        chars.alias("loss_chars"),
    ).withColumn("loss_start", F.length("formatted") - len(END) - F.col("loss_chars"))


def read_back(formatted: Column) -> Column:
    """The turns of an example, from its text: array of (role, text)."""
    marked = F.slice(F.split(formatted, END), F.lit(1), F.size(F.split(formatted, END)) - 1)
    return F.transform(
        marked,
        lambda t: F.struct(
            unescape(F.substring_index(F.substr(t, F.lit(len(OPEN) + 1)), HEAD, 1)).alias("role"),
            unescape(F.substr(t, F.instr(t, HEAD) + len(HEAD))).alias("text"),
        ),
    )


def loss_text(formatted: Column, start: Column, chars: Column) -> Column:
    """The text under the mask, as it was before it was escaped."""
    return unescape(F.substr(formatted, start + 1, chars))
