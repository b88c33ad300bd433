"""Chat formatting with DataFrame expressions only.

The turns of a conversation are collected as structs, sorted, merged where neighbours have one role,
and concatenated to one text. Where a turn's text will lie is a running sum over its conversation. The
template:

    <|start|>ROLE<|text|>TEXT<|end|>                       a block of one turn
    <|start|>ROLE<|text|>TEXT<|next|>TEXT<|end|>           neighbours of one role, merged

Inside texts and roles the control strings of this and of other common templates are escaped: a
``~1`` goes behind their first character, and ``~`` itself becomes ``~0``. Taking both back restores
every text exactly. No escaped text holds a control string.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START, TEXT, NEXT, END = "<|start|>", "<|text|>", "<|next|>", "<|end|>"
#: Where a control string begins, in this template and in others that models know.
CONTROL = r"(<|\[)(?=\||/?s>|</?SYS>>|</SYS>>|/?INST\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("~"), F.lit("~0")), F.lit(CONTROL), F.lit("$1~1"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("~1"), F.lit("")), F.lit("~0"), F.lit("~"))


def joined(parts: Column) -> Column:
    return F.concat_ws("", parts)


def format_conversations(rows: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans.

    ``rows`` has conv_id, turn, role, text. Order: turn (null first), then role, then text; repeated
    rows stay. Null roles and texts count as empty; rows with a null conv_id form one conversation.
    ``loss_spans`` are the start and length, in code points of ``formatted``, of each text of
    ``loss_role``; they hold no control string. One shuffle, on conv_id: the result is one value per
    conversation, so a conversation must fit in a row; the work grows in proportion to its turns.
    """
    empty = F.lit("")
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    plain = rows.select("conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    before = F.lag("role").over(order)
    marked = plain.withColumns({"first": before.isNull(), "fresh": before.isNull() | (before != F.col("role"))})
    marked = marked.withColumns({"said_by": escape(F.col("role")), "said": escape(F.col("text"))})
    # code points between the text before and this one
    opening = len(START) + F.length("said_by") + len(TEXT) + F.when(F.col("first"), 0).otherwise(len(END))
    size = F.length("said") + F.when(F.col("fresh"), opening).otherwise(len(NEXT))
    placed = marked.withColumn("size", size.cast("bigint")).withColumn(
        "start", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.length("said")
    )
    turn = F.struct("start", "fresh", "said_by", "said", (F.col("role") == loss_role).alias("counts"))
    turns = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))

    def whole(turns: Column) -> Column:
        numbers = F.sequence(F.lit(0), F.size(turns) - 1)
        begins = F.filter(numbers, lambda i: F.get(turns, i)["fresh"])
        blocks = let(begins, lambda starts: F.transform(starts, lambda i, k: block_text(turns, starts, i, k)))
        span = lambda t: F.struct(t["start"].alias("start"), F.length(t["said"]).cast("long").alias("length"))
        spans = F.transform(F.filter(turns, lambda t: t["counts"]), span)
        return F.struct(joined(blocks).alias("formatted"), spans.alias("loss_spans"))

    return turns.select("conv_id", let(F.col("turns"), whole).alias("w")).select("conv_id", "w.formatted", "w.loss_spans")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, which is worked out once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def block_text(turns: Column, starts: Column, i: Column, k: Column) -> Column:
    """The turns from number i to the next block's start, merged to one block."""
    until = F.coalesce(F.get(starts, k + 1), F.size(turns))
    said = F.transform(F.slice(turns, i + 1, until - i), lambda t: t["said"])
    return F.concat(F.lit(START), F.get(turns, i)["said_by"], F.lit(TEXT), F.array_join(said, NEXT), F.lit(END))


#: Code points of a piece that spans are cut from, so that none is counted from the text's beginning.
PIECE = 4096


def cut_spans(text: Column, spans: Column) -> Column:
    """What each span (start, length) of ``text`` holds."""
    def cut(pieces: Column, s: Column) -> Column:
        first, last = F.floor(s["start"] / PIECE), F.floor((s["start"] + s["length"]) / PIECE)
        near = F.array_join(F.slice(pieces, (first + 1).cast("int"), (last - first + 1).cast("int")), "")
        return F.substring(near, (s["start"] % PIECE + 1).cast("int"), s["length"].cast("int"))

    pieces = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    return let(pieces, lambda p: F.transform(spans, lambda s: cut(p, s)))


def parse_conversations(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (role, text, in order, as they were before merging) and loss_text, read back."""
    def parse_block(block: Column) -> Column:
        role = F.substring_index(block, TEXT, 1)
        body = F.substring(block, F.length(role) + F.lit(len(TEXT) + 1), F.length(block))
        body = F.substring_index(body, END, 1)
        return F.transform(F.split(body, r"<\|next\|>", -1), lambda t: F.struct(unescape(role).alias("role"), unescape(t).alias("text")))

    blocks = F.slice(F.split("formatted", r"<\|start\|>", -1), 2, 1 << 30)
    masked = F.transform(cut_spans(F.col("formatted"), F.col("loss_spans")), unescape)
    return formatted.select("conv_id", F.flatten(F.transform(blocks, parse_block)).alias("turns"), joined(masked).alias("loss_text"),
                            F.length("formatted").cast("long").alias("formatted_chars"))


def chat_digest(rows: DataFrame) -> DataFrame:
    """What op3 returns: sizes and hashes of the turns and of the masked text, as read back."""
    read = parse_conversations(format_conversations(rows))
    turns = joined(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


PROBE = "</s>[INST] ok [/INST]"


def with_probe(rows: DataFrame) -> DataFrame:
    """``rows`` and conversation -1, whose two turns hold control strings."""
    probe = rows.sparkSession.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"),
    )
    columns = [F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), F.col("role"), F.col("text")]
    return rows.select(*columns).unionByName(probe)
