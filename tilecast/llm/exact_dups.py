"""Exact copies by progressive refinement: length, then a hash of the prefix, then a hash of the whole text.

Texts are equal when they are identical without white space (``[\\x20\\x09-\\x0D]``). The first scan
gives each text's length and prefix hash, counted together: a length met once has one prefix only.
Texts that share both with another one are hashed whole, in a second scan. No text is shuffled: the
surviving groups reach that scan as a bitmap of a fixed size, in which a stranger's bit costs one
hash too many and nothing else. All of it is DataFrame functions.

A null text is an empty one, and all texts without a character are copies of each other. Of equal
texts the row with the most code points stays, then the smallest doc_id (null after all others); rows
that repeat both are told apart by their place in a written table, so one row of each group stays.
A very long text is a value like any other. An empty table gives no row. Columns of ``docs`` travel in
one struct, so none can clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilecast.llm.text import whole_text
from tilecast.session import materialize

PREFIX = 64
#: Bits of the map of surviving groups. The map has at most BITS / 64 rows, whatever the input.
BITS = 1 << 24
#: A group is hot from so many rows, and from one row in so many of all: at most HOT_SHARE groups are.
HOT_ROWS, HOT_SHARE = 10_000, 1 << 15
WHITE = " \t\n\v\f\r"


def normalised(text: Column) -> Column:
    """The text without white space."""
    for c in WHITE:
        text = F.replace(text, F.lit(c))
    return text


def _keyed(docs: DataFrame, *columns: Column) -> DataFrame:
    """``columns``, the text without white space, its length and its prefix's hash."""
    return docs.select(*columns, normalised(whole_text()).alias("norm")).withColumns(
        {"length": F.length("norm"), "prefix": F.xxhash64(F.substring("norm", 1, PREFIX))}
    )


def surviving_groups(docs: DataFrame) -> DataFrame:
    """(length, prefix) that two texts or more share. Counts per task are shuffled, so no group is hot."""
    return _keyed(docs).groupBy("length", "prefix").agg(F.count("*").alias("n")).filter("n > 1")


def _spot(length: Column, prefix: Column) -> Column:
    return F.pmod(F.xxhash64(length, prefix), F.lit(BITS))


def survivors_map(groups: DataFrame) -> DataFrame:
    """``word``, ``bits``: a bitmap of the groups, at most BITS / 64 rows."""
    spots = groups.select(_spot(F.col("length"), F.col("prefix")).alias("spot"))
    bit = F.expr("shiftleft(1L, cast(spot & 63 as int))")
    return spots.groupBy(F.shiftright("spot", 6).alias("word")).agg(F.bit_or(bit).alias("bits"))


def hashed_survivors(docs: DataFrame, keep: list[Column]) -> DataFrame:
    """Each row's columns ``keep`` in the struct ``row``, its keys, and the hash of a surviving text.

    ``hash`` is null where the length and the prefix alone tell the text from all others.
    """
    marks = survivors_map(surviving_groups(docs))
    n_chars = F.length(whole_text()).alias("n_chars")
    rows = _keyed(docs, F.struct(*keep).alias("row"), F.col("doc_id"), n_chars)
    spot = _spot(F.col("length"), F.col("prefix"))
    rows = rows.withColumns({"word": F.shiftright(spot, 6), "place": F.pmod(spot, F.lit(64)).cast("int")})
    alive = F.expr("shiftright(coalesce(bits, 0L), place) & 1L") == 1
    return rows.join(F.broadcast(marks), "word", "left").select(
        "row",
        "doc_id",
        "n_chars",
        "length",
        "prefix",
        F.when(alive, F.sha2(F.col("norm").cast("binary"), 256)).alias("hash"),
        F.monotonically_increasing_id().alias("at"),
    )


def exact_duplicates(docs: DataFrame, keep: list[Column] | None = None) -> DataFrame:
    """``row`` (a struct of ``keep``, all columns by default), keep_id, group_size, kept, hash.

    ``hash`` is the SHA-256 of the text without white space where it was needed, else null. ``row``
    crosses one shuffle with the decisions, so name few columns; groups that hold many rows are a
    bounded number and broadcast.
    """
    rows = materialize(hashed_survivors(docs, keep or [F.col(c) for c in docs.columns]), "hashed")
    key = ["length", "prefix", "hash"]
    order = F.struct(-F.col("n_chars"), F.col("doc_id").isNull(), F.col("doc_id"), F.col("at"))
    hashed = rows.filter(F.col("hash").isNotNull())
    groups = hashed.groupBy(*key).agg(F.count("*").alias("group_size"), F.min(order).alias("best"))
    groups = groups.select(
        F.col("hash").alias("group_hash"),
        "group_size",
        F.col("best")["doc_id"].alias("keep_id"),
        F.col("best")["at"].alias("keep_at"),
    ).filter("group_size > 1")
    groups = materialize(groups, "copies")

    n = rows.agg(F.count("*").alias("n")).scalar()
    hot = F.col("group_size") > F.greatest(F.lit(HOT_ROWS), F.floor(n / HOT_SHARE))
    of_hot = groups.filter(hot).select(*[F.col(c).alias(f"hot_{c}") for c in groups.columns])
    marked = rows.join(F.broadcast(of_hot), F.col("hash") == F.col("hot_group_hash"), "left")

    # Rows of hot groups and rows without a hash need no second join: their keys go to random places.
    lone = F.concat(F.lit("-"), F.col("at").cast("string"))
    cold_hash = F.when(F.col("hash").isNotNull() & F.col("hot_group_hash").isNull(), F.col("hash")).otherwise(lone)
    marked = marked.withColumn("cold_hash", cold_hash).join(
        groups.filter(~hot), F.col("cold_hash") == F.col("group_hash"), "left"
    )
    size = F.coalesce("group_size", "hot_group_size")
    return marked.select(
        "row",
        F.when(size.isNull(), F.col("doc_id")).otherwise(F.coalesce("keep_id", "hot_keep_id")).alias("keep_id"),
        F.coalesce(size, F.lit(1)).alias("group_size"),
        F.coalesce(F.col("at") == F.coalesce("keep_at", "hot_keep_at"), F.lit(True)).alias("kept"),
        "hash",
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """One row of each group of equal texts, with the columns of ``docs``. Writes the rows once on the way."""
    return exact_duplicates(docs).filter("kept").select("row.*").select(*docs.columns)


def copies_digest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept and the hash of its text without white space.

    The result wants the hash of every text, also of those that the refinement needs none of.
    """
    whole = F.sha2(normalised(whole_text()).cast("binary"), 256).alias("text_sha256")
    found = exact_duplicates(docs, [F.col("doc_id"), whole])
    return found.select("row.doc_id", "keep_id", "group_size", "kept", "row.text_sha256")
