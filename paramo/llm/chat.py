"""Operator 2, chat formatting with a loss mask.

The turns of a conversation are collected as structs, sorted, and adjacent
turns of one role are merged into a block by array aggregation (slices between
the places where the role changes).  Template::

    <turn ROLE>\\n TEXT [<+> TEXT ...] </turn>\\n

``<+>`` parts the texts of merged turns.  In roles and texts ``\\``, ``<`` and
``>`` are written ``\\b``, ``\\l`` and ``\\g``, so no text can hold a control
string, and :func:`unescaped` undoes it.  The loss mask lists the spans of
the trained role's texts, in code points of the formatted string.

Main path: Spark expressions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paramo.llm.common import let, pick, pieces_at, running

ESCAPES = (("\\", "\\b"), ("<", "\\l"), (">", "\\g"))


def escaped(text: Column) -> Column:
    for raw, mark in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(mark))
    return text


def unescaped(text: Column) -> Column:
    """Undoes :func:`escaped`: every backslash in it begins one of the three marks."""
    for raw, mark in reversed(ESCAPES):
        text = F.replace(text, F.lit(mark), F.lit(raw))
    return text


def _merged(turns: Column) -> Column:
    """Blocks ``(role, parts)`` from sorted ``(.., role, text)`` structs: adjacent turns of one role share a block.

    The places where the role changes are the blocks' ends, and a block's
    texts the slice between two of them, so each turn is touched once."""
    def blocks(t: Column) -> Column:
        places = F.when(F.size(t) > 0, F.sequence(F.lit(1), F.size(t))).otherwise(F.array().cast("array<int>"))
        firsts = F.filter(places, lambda i: (i == 1) | (F.get(t, i - 1)["role"] != F.get(t, i - 2)["role"]))

        def block(starts: Column) -> Column:
            def one(first: Column, k: Column) -> Column:
                after = F.coalesce(F.get(starts, k + 1), F.size(t) + 1)
                return F.struct(F.get(t, first - 1)["role"].alias("role"), F.transform(F.slice(t, first, after - first), lambda x: x["text"]).alias("parts"))

            return F.transform(starts, one)

        return let(firsts, block)

    return let(turns, blocks)


def format_chats(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
                 trained: str = "assistant") -> DataFrame:
    """``(conv, formatted, loss)``: the formatted conversation and the array of ``(start, end)`` spans under loss, end exclusive.

    Turns go by number, then null numbers, then role and text: ties and
    repeated rows have one order.  Null text and null role count as empty;
    rows with a null conversation id form one conversation.  An empty table
    gives an empty result.  Other columns are not read.  A conversation is one
    string, so it has to fit a row; its turns are collected in one group, and
    the work is about in proportion to their number and length."""
    cells = pick(rows, conv=conv, turn=turn, role=role, text=text)
    one = F.struct(F.col("turn").isNull().alias("last"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = cells.groupBy("conv").agg(F.sort_array(F.collect_list(one)).alias("turns"))
    blocks = chats.select("conv", _merged(F.col("turns")).alias("blocks"))
    # what is written, in order: a head before each block's first text and a joint before its others, the text, and a tail after the last one
    def written(b: Column) -> Column:
        head = F.concat(F.lit("<turn "), escaped(b["role"]), F.lit(">\n"))
        return F.transform(b["parts"], lambda t, i: F.struct(F.when(i == 0, head).otherwise(F.lit("<+>")).alias("before"), escaped(t).alias("text"),
                                                             F.when(i == F.size(b["parts"]) - 1, F.lit("</turn>\n")).otherwise(F.lit("")).alias("after"), (b["role"] == trained).alias("trained")))

    def told(pieces: Column) -> Column:
        formatted = F.array_join(F.transform(pieces, lambda p: F.concat(p["before"], p["text"], p["after"])), "")
        starts = running(F.transform(pieces, lambda p: F.length(p["before"]) + F.length(p["text"]) + F.length(p["after"])))
        spans = F.zip_with(pieces, starts, lambda p, at: F.struct(p["trained"].alias("trained"), (at + F.length(p["before"])).alias("start"), (at + F.length(p["before"]) + F.length(p["text"])).alias("end")))
        loss = F.transform(F.filter(spans, lambda s: s["trained"]), lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
        return F.struct(formatted.alias("formatted"), loss.alias("loss"))

    done = blocks.select("conv", let(F.flatten(F.transform("blocks", written)), told).alias("t"))
    return done.select(F.col("conv").alias(conv), "t.formatted", "t.loss")


def parsed_turns(formatted: Column) -> Column:
    """The turns ``(role, text)`` read back from a formatted conversation, merged ones apart again."""
    blocks = F.split(formatted, "</turn>\n", -1)
    blocks = F.slice(blocks, F.lit(1), F.size(blocks) - 1)

    def turns(block: Column) -> Column:
        cut = F.split(block, ">\n", 2)
        who = unescaped(F.substr(F.element_at(cut, 1), F.lit(len("<turn ") + 1)))
        return F.transform(F.split(F.element_at(cut, 2), "<\\+>", -1), lambda t: F.struct(who.alias("role"), unescaped(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def masked_text(formatted: Column, loss: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(F.transform(pieces_at(formatted, loss), unescaped), "")
