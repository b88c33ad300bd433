"""Rows that every text operator must stand: nulls, empty and very long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "row string, given int, score double, kept string, block int, ids string, host string, component_id int"
)
ODD = [
    (1, None, None, None),
    (2, "", "en", "a"),
    (3, " \n\t ", "en", "a"),
    (4, "!!! ??? 123", "de", None),
    (5, "a", "fr", "b"),
    (6, "many words again and again " * 6000, "en", "a"),
    (7, "x" * 40_000, None, "a"),
    (8, "The same text, twice.\nThe same line\nThe same line", "en", "a"),
    (8, "The same text, twice.\nThe same line\nThe same line", "en", "a"),
    (9, "The same text, twice.\nThe same line\nThe same line", "en", "b"),
    (None, "no id at all", "en", "a"),
    (12, "It's ~1 <|start|> we'll 　 Ünïcode ǅ ½ ́ é😀 'S 're're  \x0b\x0c end ", "de", "c"),
    (-5, "negative id", "es", "c"),
]


def odd_documents(spark):
    rows = [(d, t, la, s, None if t is None else len(t), "r", 1, 0.5, "k", 7, "i", "h", 3) for d, t, la, s in ODD]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def no_documents(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, sf="0.001"):
    return spark.read.parquet(f"/root/testdata/sf{sf}/documents.parquet")


def ids_of(rows):
    return sorted((r.doc_id for r in rows), key=lambda d: (d is not None, d or 0))


ODD_IDS = sorted((r[0] for r in ODD), key=lambda d: (d is not None, d or 0))
