"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

Documents with equal shingle sets form a class, which its smallest doc_id stands for. Sketches of
classes are cut into bands; classes that agree on a band meet in a bucket. First each bucket's
members are checked against its smallest member, on full sets. Buckets whose members are not in one
component after that are taken up again, in blocks: all pairs of members of different components are
compared on full sets, through the lists of members that each shingle of the block has. Only links
that join components leave a block, so no group writes all its pairs.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.llm.shingles import bands, shingle_set, sketches
from tilecast.llm.text import with_columns_after
from tilecast.session import materialize

#: 51 bands of 5 values: at a similarity of 0.8 no band agrees in 2 of 10**9 pairs.
BANDS, HEIGHT = 51, 5
#: Members of a bucket compared in one task at a time.
BLOCK = 1024
#: Entries of shingles' member lists looked at in one go, about.
ENTRIES = 1 << 21


def add_sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, set_key (binary; null without words) and bands of every row."""
    def work(texts, given):
        sets = [shingle_set(t, words) for t in texts.to_pylist()]
        rows = bands(sketches(sets, BANDS * HEIGHT), BANDS, HEIGHT)
        keys = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets]
        return {
            "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
            "set_key": pa.array(keys, pa.binary()),
            "bands": pa.array(list(rows), pa.list_(pa.int64())),
        }

    found = with_columns_after(docs, work, "n_shingles long, set_key binary, bands array<bigint>", keep=["doc_id"])
    return found.select("row.doc_id", "n_shingles", "set_key", "bands")


def add_sets(docs: DataFrame, words: int) -> DataFrame:
    """doc, shingles (sorted 64-bit numbers as binary) and marks (the hashes of its bands, likewise) of every row."""
    def work(texts, given):
        sets = [shingle_set(t, words) for t in texts.to_pylist()]
        rows = bands(sketches(sets, BANDS * HEIGHT), BANDS, HEIGHT)
        return {
            "shingles": pa.array([s.tobytes() for s in sets], pa.binary()),
            "marks": pa.array([r.tobytes() for r in rows], pa.binary()),
        }

    found = with_columns_after(docs, work, "shingles binary, marks binary", keep=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc"), "shingles", "marks")


def shared(a: np.ndarray, b: np.ndarray) -> int:
    """The size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    spot = np.searchsorted(b, a)
    return int((b[np.minimum(spot, len(b) - 1)] == a).sum()) if len(a) else 0


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    both = shared(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets have the similarity."""
    left = sets.select(F.col("doc").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc").alias("b"), F.col("shingles").alias("y"))

    def check(batches):
        for batch in batches:
            keep = [
                linked(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent)
                for x, y in zip(batch.column("x"), batch.column("y"), strict=True)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(check, "a long, b long")


def overlaps(sets: list[np.ndarray]):
    """A function that counts, for the set in place x, the elements it shares with every set; 0 for those up to x."""
    limits = np.cumsum([0, *(len(s) for s in sets)])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")  # equal elements together, in the order of their sets
    ranked = flat[order]
    lasts = np.flatnonzero(np.append(ranked[1:] != ranked[:-1], True))
    owner = np.repeat(np.arange(len(sets)), np.diff(limits))[order]
    first, later = np.empty(len(flat), np.int64), np.empty(len(flat), np.int64)
    first[order] = np.arange(1, len(flat) + 1)
    later[order] = np.repeat(lasts, np.diff(lasts, prepend=-1)) - np.arange(len(flat))
    step = max(1, ENTRIES // len(sets))

    def count(x: int) -> np.ndarray:
        out = np.zeros(len(sets), np.int64)
        for lo in range(limits[x], limits[x + 1], step):
            part = slice(lo, min(lo + step, limits[x + 1]))
            n = later[part]
            spots = np.repeat(first[part] - np.cumsum(n) + n, n) + np.arange(n.sum())
            out += np.bincount(owner[spots], minlength=len(sets))
        return out

    return count


def block_links(percent: int):
    """For one block of a bucket: links between members of different components, a spanning set of them."""
    def find(table: pa.Table) -> pa.Table:
        band = table.column("k")[0].as_py()
        cross = table.column("i")[0].as_py() != table.column("j")[0].as_py()
        docs = table.column("doc").to_numpy()
        part = table.column("chunk").to_numpy()
        component = table.column("component").to_numpy().copy()
        sets = [np.frombuffer(x.as_py(), np.uint64) for x in table.column("shingles")]
        marks = np.frombuffer(b"".join(x.as_py() for x in table.column("marks")), np.int64).reshape(len(docs), -1)
        sizes = np.array([len(s) for s in sets])
        # a document with several texts is here with all of them, though one alone may be in the bucket
        _, spot, rows = np.unique(docs, return_inverse=True, return_counts=True)
        single = rows[spot] == 1
        count, found = overlaps(sets), []
        for x in range(len(docs) - 1):
            rest = slice(x + 1, None)
            may = component[rest] != component[x]
            may &= 100 * np.minimum(sizes[rest], sizes[x]) >= percent * np.maximum(sizes[rest], sizes[x])
            if cross:
                may &= part[rest] != part[x]
            if band and single[x] and may.any():  # a pair is looked at in the first band that it shares
                at = np.flatnonzero(may & single[rest])
                may[at[(marks[at + x + 1, :band] == marks[x, :band]).any(1)]] = False
            if not may.any():
                continue
            both = count(x)[rest]
            may &= 100 * both >= percent * (sizes[rest] + sizes[x] - both)
            for y in (np.flatnonzero(may) + x + 1).tolist():
                low, high = sorted((component[x], component[y]))
                if low != high:
                    component[component == high] = low
                    found.append((min(docs[x], docs[y]), max(docs[x], docs[y])))
        return pa.table({"a": pa.array([f[0] for f in found], pa.int64()), "b": pa.array([f[1] for f in found], pa.int64())})

    return find


def components(links: DataFrame, name: str) -> DataFrame:
    """doc, component (the smallest doc reachable) of every doc in ``links`` (a, b).

    Alternates two steps until nothing changes: every node ties its larger neighbours to its smallest
    one, then every node ties its smaller neighbours, and itself, to the smallest. Each step is
    written, which cuts the lineage. Stars stay small: an edge is a row, never a list per node.
    """
    def tie(edges: DataFrame, smaller: bool) -> DataFrame:
        # (u, v): v is a neighbour of u
        least = edges.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        joined = edges.join(least, "u")
        if smaller:
            tied = joined.select(F.col("v").alias("p"), F.col("m").alias("q")).unionByName(least.select(F.col("u").alias("p"), F.col("m").alias("q")))
        else:
            tied = joined.filter("v > u").select(F.col("v").alias("p"), F.col("m").alias("q"))
        return tied.filter("p <> q").distinct()

    def mark(edges: DataFrame) -> tuple:
        return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("p", "q"))).first())

    edges = materialize(links.select(F.greatest("a", "b").alias("p"), F.least("a", "b").alias("q")).filter("p <> q").distinct(), name)
    seen = mark(edges)
    while True:
        both = edges.select(F.col("p").alias("u"), F.col("q").alias("v")).unionByName(edges.select(F.col("q").alias("u"), F.col("p").alias("v")))
        wide = materialize(tie(both, smaller=False), name)
        edges = materialize(tie(wide.select(F.col("p").alias("u"), F.col("q").alias("v")), smaller=True), name)
        now = mark(edges)
        if now == seen:
            break
        seen = now
    tops = edges.select(F.col("q").alias("doc")).distinct().withColumn("component", F.col("doc"))
    return edges.select(F.col("p").alias("doc"), F.col("q").alias("component")).unionByName(tops)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, class_id, component_id, kept of every row of ``docs``.

    Documents are linked when their sets of ``words``-word shingles have a Jaccard similarity of
    ``percent`` / 100 or more. ``class_id`` is the smallest doc_id with an equal set, ``component_id``
    the smallest doc_id reachable over links; ``kept`` says that it is the document's own. A text
    without words (or null) is linked with nothing. Rows that share a doc_id are one document, whose
    texts are all its own. A row with a null doc_id has no class and stays. Empty table: no rows.

    The texts are read once for sketches, and once more for the sets of those documents that meet
    another one in a bucket.
    """
    plain = docs.select("doc_id", "text")
    known = materialize(add_sketches(plain, words), "sketches")
    usable = known.filter(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    classes = materialize(usable.groupBy("set_key").agg(F.min("doc_id").alias("class_id")), "classes")
    heads = usable.join(classes.select("set_key", F.col("class_id").alias("doc_id")), ["set_key", "doc_id"], "left_semi")
    rows = heads.select(F.col("doc_id").alias("doc"), F.posexplode("bands").alias("k", "band"))
    full = rows.groupBy("band").agg(F.min("doc").alias("leader"), F.count("*").alias("size"), F.bit_xor(F.xxhash64("doc")).alias("sign"))
    members = materialize(rows.join(full.filter("size > 1"), "band"), "members")
    met = members.select(F.col("doc").alias("doc_id")).distinct()
    sets = materialize(add_sets(plain.join(met, "doc_id", "left_semi"), words), "sets")

    stars = members.filter("doc <> leader").select(F.col("leader").alias("a"), F.col("doc").alias("b")).distinct()
    links = materialize(verify(stars, sets, percent), "links")
    first = materialize(components(links, "star-components"), "first")

    labelled = members.join(first, "doc", "left").withColumn("component", F.coalesce("component", "doc"))
    labelled = materialize(labelled, "labelled")
    torn = labelled.groupBy("band", "k", "size", "sign").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low <> high")
    # buckets with the same members are one; its first band is the one that counts
    torn = torn.groupBy("size", "sign").agg(F.min_by("band", "k").alias("band"))
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    open_rows = labelled.join(torn.select("band"), "band").withColumns(
        {"chunk": F.pmod(F.xxhash64("doc"), parts).cast("int"), "other": F.explode(F.sequence(F.lit(0), parts - 1))}
    )
    blocks = open_rows.select(
        "band", "k", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "doc", "component"
    ).join(sets, "doc")
    more = blocks.groupBy("band", "i", "j").applyInArrow(block_links(percent), "a long, b long")
    links = links.unionByName(materialize(more, "more-links"))
    joined = components(links, "components")

    out = known.join(classes, "set_key", "left").join(joined.select(F.col("doc").alias("class_id"), "component"), "class_id", "left")
    component = F.coalesce("component", "class_id", "doc_id")
    return out.select(
        "doc_id", "n_shingles", "class_id", component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def duplicate_digest(docs: DataFrame) -> DataFrame:
    """What op8 returns: two-word shingles."""
    return near_duplicates(docs, words=2).select("doc_id", "n_shingles", "component_id", "kept")


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` but those whose document has a smaller near-duplicate.

    Texts without a word are linked with nothing and stay, as do rows without an id; rows that repeat a
    doc_id go or stay together.
    """
    gone = near_duplicates(docs, words, percent).filter(~F.col("kept")).select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
