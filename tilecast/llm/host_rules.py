"""Quality rules judged per host.

Every document is measured by a few rules. The failures of each rule are counted per host (the
column ``source``), the hosts' rates are shrunk towards each other by a beta prior whose moments are
those of the hosts themselves, and a host with a shrunk rate over the limit is rejected with all its
documents.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilecast.llm.text import with_columns_after
from tilecast.session import materialize

SPACES, SYMBOLS = b" \t\n\x0b\x0c\r", b"#*$%&|<>"
MEASURES = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"
RULES = ("too_short", "repetitive", "symbol_heavy", "repeated_lines")
#: A host is rejected when a shrunk failure rate is over this.
LIMIT = 0.5
#: Bounds of the prior's weight, counted in documents.
LEAST_WEIGHT, MOST_WEIGHT = 2.0, 1000.0


def repeated_words(words: list[bytes]) -> int:
    """Words inside a window of three that occurs twice or more in the text."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    width = len(number)
    pairs = ids[:-1] * width + ids[1:]
    if width > 2_000_000:
        _, pairs = np.unique(pairs, return_inverse=True)
    windows = pairs[:-1] * width + ids[2:]
    order = np.argsort(windows, kind="stable")
    equal = windows[order][1:] == windows[order][:-1]
    twice = np.zeros(n - 2, bool)
    twice[order[1:][equal]] = True
    twice[order[:-1][equal]] = True
    inside = np.zeros(n, bool)
    inside[:-2] |= twice
    inside[1:-1] |= twice
    inside[2:] |= twice
    return int(inside.sum())


def measure(text: str) -> tuple[int, ...]:
    """The measures of MEASURES, in that order, of one whole text."""
    raw = text.encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip(SPACES)]
    spaces = len(raw) - len(raw.translate(None, SPACES))
    symbols = len(raw) - len(raw.translate(None, SYMBOLS))
    return len(words), len(text) - spaces, symbols, len(lines), len(lines) - len(set(lines)), repeated_words(words)


def add_measures(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Rows as ``row``, with the measures of each whole text (null: none)."""
    def work(texts, given):
        columns = np.array([measure(t) for t in texts.to_pylist()], np.int64).reshape(len(texts), 6).T
        return {part.split()[0]: pa.array(column) for part, column in zip(MEASURES.split(", "), columns, strict=True)}

    return with_columns_after(docs, work, MEASURES, keep=keep)


def rule_failures() -> dict[str, Column]:
    return {
        "too_short": F.col("n_words") < 50,
        "repetitive": 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
        "symbol_heavy": 10 * F.col("n_symbols") > 3 * F.col("word_chars"),
        "repeated_lines": 10 * F.col("n_dup_lines") > 5 * F.col("n_lines"),
    }


def host_verdicts(measured: DataFrame, limit: float = LIMIT) -> DataFrame:
    """host, host_rate (the largest shrunk rate of its rules), host_kept; one row per host.

    The prior of a rule has the mean and variance that the hosts' raw rates have, and a weight between
    LEAST_WEIGHT and MOST_WEIGHT documents. A null source is a host of its own.
    """
    failures = rule_failures()
    hosts = materialize(
        measured.groupBy(F.col("row.source").alias("host")).agg(
            F.count("*").alias("n"), *[F.sum(c.cast("long")).alias(r) for r, c in failures.items()]
        ),
        "hosts",
    )
    moments = hosts.agg(*[f(F.col(r) / F.col("n")).alias(f"{k}_{r}") for r in RULES for k, f in (("mean", F.avg), ("var", F.var_pop))]).first()

    def shrunk(rule: str) -> Column:
        mean, var = float(moments[f"mean_{rule}"] or 0), float(moments[f"var_{rule}"] or 0)
        weight = MOST_WEIGHT if var <= 0 else min(max(mean * (1 - mean) / var - 1, LEAST_WEIGHT), MOST_WEIGHT)
        return (F.col(rule) + weight * mean) / (F.col("n") + weight)

    rate = F.greatest(*[shrunk(r) for r in RULES])
    return hosts.select("host", rate.alias("host_rate"), (rate <= limit).alias("host_kept"))


def judge(docs: DataFrame, keep: list[str] | None = None, limit: float = LIMIT) -> DataFrame:
    """Rows as ``row``, with the measures, base_failed, host_rate and kept.

    The texts are read twice, once for the hosts' counts and once to measure and judge; only counts
    are shuffled, combined per task first, so a host with a third of all rows is one row a task. The
    hosts' verdicts are joined without a hint: broadcast while small, else with skewed hosts split.
    Empty table: no rows.
    """
    verdicts = host_verdicts(add_measures(docs, ["source"]), limit)
    measured = add_measures(docs, keep or docs.columns)
    failures = rule_failures()
    joined = measured.join(verdicts, F.col("row.source").eqNullSafe(F.col("host")), "left")
    base = (failures["too_short"] | failures["repetitive"]).alias("base_failed")
    return joined.select("row", *[c for c in measured.columns if c != "row"], base, "host_rate", "host_kept").withColumn(
        "kept", ~F.col("base_failed") & F.coalesce("host_kept", F.lit(True))
    )


def quality_rules(docs: DataFrame) -> DataFrame:
    """What op5 returns, for every row of ``docs``.

    Null and empty texts have no words and fail; rows without a host are one host together. Repeated
    rows count each, in their host's rates, too, and get the same verdict; very long texts are measured
    whole. An empty table gives no rows. Rows travel in a struct, so no column can clash.
    """
    found = judge(docs, ["doc_id", "source"])
    return found.select(
        "row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def keep_quality(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns; odd rows as in ``quality_rules``."""
    return judge(docs).filter("kept").select("row.*")
