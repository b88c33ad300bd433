"""I-Match fingerprints with DataFrame expressions only.

The lexicon holds the terms whose document frequency lies in a band of shares of all documents (a
band of inverse document frequency). A text's distinct lexicon terms are sorted and hashed once for
each of several random subsets of the lexicon. Equal texts have equal fingerprints; the share of
equal subset hashes is the likeness of two texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tilecast.session import materialize

#: The lexicon falls into so many random subsets by the terms' hashes: every term is in one.
SUBSETS, DIGITS = 16, 8
GAP = "-" * DIGITS
#: The band: at least this share of all documents has the term, and at most that one.
LEAST_SHARE, MOST_SHARE = 0.0005, 0.01
#: Documents whose neighbours are found together, about, and blocks of them, at most.
BLOCK_ROWS, MOST_BLOCKS = 1000, 1024
#: A lexicon of up to so many terms is broadcast, about 100 bytes each.
BROADCAST_TERMS = 500_000


def terms(text: Column) -> Column:
    """Distinct lower-case runs of letters and digits, behind the empty string."""
    return F.array_distinct(F.concat(F.array(F.lit("")), F.split(F.lower(text), r"[^\p{L}\p{N}]+")))


def lexicon(texts: DataFrame, least: float = LEAST_SHARE, most: float = MOST_SHARE) -> DataFrame:
    """term, code: the terms of ``texts.text`` inside the band and their hash.

    Each takes at least ``least`` of the documents, so there are at most (mean distinct terms of a
    text) / ``least`` of them, whatever the number of texts.
    """
    n = texts.count()
    counted = texts.select(F.explode(terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    inside = (F.col("df") >= least * n) & (F.col("df") <= max(1.0, most * n))
    return counted.filter((F.col("term") != "") & inside).select("term", F.xxhash64("term").alias("code"))


def add_fingerprint(rows: DataFrame, codes: str, alone: str, name: str) -> DataFrame:
    """``rows`` with ``name``: eight hex digits per lexicon subset, or dashes where none of its terms is there.

    A text with no term of any subset has its column ``alone`` instead, a hash of the whole text
    behind ``=``. Each step is a projection of its own, so that none is worked out twice.
    """
    ordered = rows.withColumn("ordered", F.sort_array(F.array_distinct(codes)))

    def subset(k: int) -> Column:
        chosen = F.filter("ordered", lambda c: F.pmod(c, F.lit(SUBSETS)) == k)
        return F.xxhash64(chosen, F.lit(k)).alias(f"h{k}"), F.size(chosen).alias(f"n{k}")

    hashed = ordered.withColumn("hashes", F.array(*[F.struct(*(c.alias(v) for c, v in zip(subset(k), "hn", strict=True))) for k in range(SUBSETS)]))
    def digits(x: Column) -> Column:
        return F.when(x["n"] == 0, GAP).otherwise(F.substring(F.lpad(F.lower(F.hex(x["h"])), 16, "0"), 1, DIGITS))

    text = hashed.withColumn(name, F.array_join(F.transform("hashes", digits), ""))
    return text.withColumn(name, F.when(F.col(name) == GAP * SUBSETS, F.col(alone)).otherwise(F.col(name))).drop("ordered", "hashes")


def likeness(a: Column, b: Column) -> Column:
    """Share of equal subset hashes, among the subsets that either text has terms in (0 to 1)."""
    parts = [(F.substring(a, 1 + DIGITS * k, DIGITS), F.substring(b, 1 + DIGITS * k, DIGITS)) for k in range(SUBSETS)]
    used = sum((F.when((x != GAP) | (y != GAP), 1).otherwise(0) for x, y in parts), F.lit(0))
    same = sum((F.when((x == y) & (x != GAP), 1).otherwise(0) for x, y in parts), F.lit(0))
    both = ~a.startswith("=") & ~b.startswith("=")
    return F.when(a == b, 1.0).when(both & (used > 0), same / used).otherwise(0.0)


def add_block(docs: DataFrame) -> DataFrame:
    """``docs`` with ``hash``, of the text, and ``block``, which ascends with (doc_id, hash): about BLOCK_ROWS rows each.

    Blocks end at quantiles of doc_id, one array of at most MOST_BLOCKS numbers, so neither far nor close
    ids make a large one. An id that several quantiles fall on has as many blocks, which its rows are
    dealt to by ranges of the hash, and so are rows without an id, which come first.
    """
    n, nulls = docs.agg(F.count("*"), F.count_if(F.col("doc_id").isNull())).first()
    count, spare = (min(MOST_BLOCKS, -(-rows // BLOCK_ROWS)) for rows in (n, nulls))
    shares = [k / count for k in range(count)] or [0.0]
    (found,) = docs.agg(F.percentile_approx("doc_id", shares, max(10_000, 20 * count))).first()
    limits = F.array(*[F.lit(int(x)) for x in found or []]).cast("array<bigint>")
    below = F.size(F.filter(limits, lambda x: x < F.col("doc_id")))
    equal = F.size(F.filter(limits, lambda x: x == F.col("doc_id")))
    share = F.col("hash") / 2.0**64 + 0.5  # of all hashes, from 0 up to 1
    nth = F.least(F.floor(share * F.col("equal")), F.col("equal") - 1)
    own = F.col("below") + F.when(F.col("equal") > 0, nth + 1).otherwise(0)
    block = F.when(F.col("doc_id").isNull(), F.least(F.floor(share * spare), F.lit(spare - 1)) - spare).otherwise(own)
    hashed = docs.withColumn("hash", F.xxhash64("text")).withColumns({"below": below, "equal": equal})
    return hashed.withColumn("block", block.cast("bigint")).drop("below", "equal")


def next_of_each(rows: DataFrame, order: list[str], value: str) -> tuple[DataFrame, DataFrame]:
    """``rows`` with ``place`` (from 1, in the block) and ``next``, the following row's ``value``.

    In two frames: all rows but the last of each block, which find the next inside their block, and
    the last ones, which are joined with the first row of the next block (the last block's with the
    first one's). ``value`` is never null. One shuffle on block; what crosses blocks is a row each.
    """
    inside = Window.partitionBy("block").orderBy(*order)
    seen = rows.withColumns({"place": F.row_number().over(inside), "next": F.lead(value).over(inside)})
    first = seen.filter("place = 1").select(F.col("block").alias("next_block"), F.col(value).alias("first_value"))
    blocks = rows.groupBy("block").agg(F.count("*").alias("n"))
    first_block = blocks.agg(F.min("block").alias("b")).first().b
    follow = blocks.select("block", F.coalesce(F.lead("block").over(Window.orderBy("block")), F.lit(first_block)).alias("next_block"))
    last = (
        seen.filter("next is null").drop("next").join(follow, "block").join(first, "next_block")
        .withColumnRenamed("first_value", "next").drop("next_block")
    )
    return seen.filter("next is not null"), last


def imatch(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likenesses.

    The edited text has its last floor(n / 2) code points replaced by the first as many of the next
    document's text, by doc_id; the last document is followed by the first. Null texts are empty,
    null ids come first, repeated ids follow one another by a hash of the text. An empty table gives no
    rows. Only doc_id and text are read, so no other column can clash.
    The texts are shuffled once, on blocks of ids; terms and fingerprints of a text are made where it
    is then. Terms are shuffled for their document frequency, and with a lexicon too
    large to broadcast to meet it.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    known = materialize(lexicon(texts), "lexicon")
    small = known.count() <= BROADCAST_TERMS

    def with_codes(rows: DataFrame) -> DataFrame:
        """The terms in the lexicon with their codes, and the empty term, which stands for its text."""
        if small:
            stand_in = known.sparkSession.range(1).select(F.lit("").alias("term"), F.lit(None).cast("bigint").alias("code"))
            return rows.join(F.broadcast(known.unionByName(stand_in)), "term")
        # the empty term is in every text: each one goes to a place of its own
        spread = rows.withColumn("key", F.when(F.col("term") == "", F.concat_ws("-", F.lit(""), F.col("block").cast("string"), F.col("place").cast("string"))).otherwise(F.col("term")))
        found = spread.join(known.withColumnRenamed("term", "key"), "key", "left")
        return found.filter((F.col("term") == "") | F.col("code").isNotNull()).drop("key")

    def marked(rows: DataFrame) -> DataFrame:
        n = F.length("text")
        half = F.floor(n / 2).cast("int")
        edited = F.concat(F.substring("text", F.lit(1), n - half), F.substring("next", F.lit(1), half))
        alone = lambda c: F.concat(F.lit("="), F.lower(F.hex(F.xxhash64(c))))
        held = F.struct(
            "doc_id", n.cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            alone("text").alias("alone"), alone("edited").alias("edited_alone"),
        )
        both = rows.withColumn("edited", edited).select(
            "block", "place", F.posexplode(F.array("text", "edited")).alias("side", "body"), held.alias("held")
        )
        each = both.select("block", "place", "side", "held", F.explode(terms(F.col("body"))).alias("term"))
        # the empty term comes once a side; the text's other columns travel with that row only
        narrow = each.select("block", "place", "side", "term", F.when((F.col("term") == "") & (F.col("side") == 0), F.col("held")).alias("held"))
        side = lambda k: F.collect_list(F.when(F.col("side") == k, F.col("code")))
        found = with_codes(narrow).groupBy("block", "place").agg(
            F.first("held", ignorenulls=True).alias("held"), side(0).alias("codes"), side(1).alias("edited_codes")
        )
        flat = found.select("block", "place", "held.*", "codes", "edited_codes")
        both = add_fingerprint(flat, "codes", "alone", "fingerprint")
        both = add_fingerprint(both, "edited_codes", "edited_alone", "edited_fingerprint")
        return both.drop("codes", "edited_codes", "alone", "edited_alone")

    parts = next_of_each(add_block(texts), ["doc_id", "hash", "text"], "text")
    prints = materialize(marked(parts[0]).unionByName(marked(parts[1])), "fingerprints").withColumnRenamed("place", "rank")
    near = [
        part.select(
            "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
            likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
            likeness(F.col("fingerprint"), F.col("next")).alias("near_next"),
        )
        for part in next_of_each(prints, ["rank"], "fingerprint")
    ]
    return near[0].unionByName(near[1])
