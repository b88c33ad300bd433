"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence's probability is a logistic function of its words; the
bag's is the noisy-or of its sentences: 1 - prod(1 - p). The weights are learned from the documents'
labels alone, and then tell which sentences offend.

Features are whole words and their first three, four and five letters, so that inflected and
compound forms of a stem share weight.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.llm.text import bounded_sample, fold, with_columns_after

PREFIXES = (3, 4, 5)
SENTENCE = re.compile(r"[^.!?\n]+")
#: ASCII bytes that are no letters become gaps, sentence ends line feeds.
GAPS = bytes(
    10 if c in b".!?\n" else c if c >= 128 or chr(c).isalpha() else 32 for c in range(256)
)


def sentences(text: str) -> list[list[str]]:
    """The lower-case words of each sentence that has one."""
    lines = text.lower().encode().translate(GAPS).split(b"\n")
    return [words for line in lines if (words := line.decode().split())]


def features_of(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in PREFIXES if len(word) > k)]


@dataclass
class ToxicityModel:
    weights: dict[str, float]
    bias: float

    def __post_init__(self):
        self.known: dict[str, float] = {}

    def weight(self, word: str) -> float:
        value = self.known.get(word)
        if value is None:
            if len(self.known) > 500_000:
                self.known.clear()
            value = self.known[word] = sum(self.weights.get(f, 0.0) for f in features_of(word))
        return value

    def sentence_logit(self, words: list[str]) -> float:
        """Each feature counts once in a sentence."""
        if not any(self.weight(w) for w in words):
            return self.bias
        return self.bias + sum(self.weights.get(f, 0.0) for f in {f for w in words for f in features_of(w)})

    def score(self, text: str) -> float:
        """Noisy-or over all sentences; 0 without words."""
        bags = sentences(text)
        if any(self.weight(w) for w in {w for bag in bags for w in bag}):
            logits = np.array([self.sentence_logit(bag) for bag in bags])
            return float(1 - np.exp(-np.logaddexp(0, logits).sum()))
        return float(-np.expm1(-len(bags) * np.logaddexp(0, self.bias)))

    def offending(self, text: str, threshold: float = 0.5) -> list[tuple[int, int, float]]:
        """Start, end (code points) and probability of the sentences at or over ``threshold``."""
        out = []
        for m in SENTENCE.finditer(text):
            for words in sentences(m[0]):
                p = float(1 / (1 + np.exp(-np.clip(self.sentence_logit(words), -50, 50))))
                if p >= threshold:
                    out.append((m.start(), m.end(), p))
        return out


def fit_bags(bags: list[list[list[int]]], plain: np.ndarray, y: np.ndarray, weight: np.ndarray, width: int,
             l1: float = 2e-4, steps: int = 400) -> tuple[np.ndarray, float]:
    """Noisy-or maximum likelihood with an L1 penalty, by proximal Adam steps.

    ``bags``: the sentences of each document that have features, as feature numbers; ``plain``: how
    many other sentences it has.
    """
    doc = np.array([d for d, b in enumerate(bags) for _ in b], np.int64)
    lines = [s for b in bags for s in b]
    row = np.repeat(np.arange(len(lines)), [len(s) for s in lines])
    col = np.array([f for s in lines for f in s], np.int64)
    w, b = np.zeros(width), -4.0
    m, v, mb, vb = np.zeros(width), np.zeros(width), 0.0, 0.0
    weight = weight / weight.sum()
    for t in range(1, steps + 1):
        z = b + np.bincount(row, w[col], len(lines))
        soft = np.bincount(doc, np.logaddexp(0, z), len(bags)) + plain * np.logaddexp(0, b)
        odds = 1 / np.expm1(np.clip(soft, 1e-9, 50))
        pull = weight * np.where(y > 0, odds, -1.0)
        push = pull[doc] / (1 + np.exp(-z))
        g = np.bincount(col, push[row], width)
        gb = push.sum() + (pull * plain).sum() / (1 + np.exp(-b))
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        mb, vb = 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb * gb
        rate = 0.1 * min(1.0, 3 * (1 - t / (steps + 1)))
        step = rate / (np.sqrt(v / (1 - 0.99**t)) + 1e-4)
        w = w + step * m / (1 - 0.9**t)
        w = np.sign(w) * np.maximum(np.abs(w) - step * l1, 0)
        b += rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-4)
    return w, b


def fit_toxicity(docs: DataFrame, labels: DataFrame, per_label: int = 6000, most_features: int = 4096) -> ToxicityModel:
    """Learn from about ``per_label`` documents (the documented bound) of each label.

    ``labels`` has doc_id and toxic; rows with a null label are left out. The sample's ids are few and
    are sent to the scan of ``docs``. Features are the ``most_features`` whose document frequencies
    differ most between the labels; only these reach the driver.
    """
    from tilecast.session import materialize

    marked = labels.filter(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    counts = {r.toxic: r["count"] for r in marked.groupBy("toxic").count().collect()}
    if len(counts) < 2:
        return ToxicityModel({}, -30.0 if counts.get(0) or not counts else 0.0)
    picked = bounded_sample(marked, F.col("toxic"), F.col("doc_id"), per_label).select("doc_id", "toxic")
    texts = docs.filter(F.col("text").isNotNull()).select("doc_id", "text")
    sample = materialize(texts.join(F.broadcast(picked), "doc_id").select("text", "toxic"), "toxic-sample")

    def count_features(batches):
        seen = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = {w for bag in sentences(text) for w in bag}
                seen[y].update({f for w in words for f in features_of(w)})
        for y, counter in seen.items():
            names = list(counter)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()), pa.array([y] * len(names), pa.int32()),
                 pa.array(list(counter.values()), pa.int64())], ["feature", "toxic", "n"])

    sizes = {r.toxic: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n0, n1 = max(1, sizes.get(0, 0)), max(1, sizes.get(1, 0))
    at = lambda y: F.sum(F.when(F.col("toxic") == y, F.col("n")).otherwise(0))
    table = sample.mapInArrow(count_features, "feature string, toxic int, n long").groupBy("feature").agg(at(0).alias("d0"), at(1).alias("d1"))
    share = (F.col("d0") + F.col("d1") + 1) / float(n0 + n1 + 2)
    z = (F.col("d1") / n1 - F.col("d0") / n0) / F.sqrt(share * (1 - share) * (1 / n0 + 1 / n1))
    best = table.filter("d1 >= 3").withColumn("z", z).filter("z > 3").orderBy(F.desc("z"), "feature").limit(most_features)
    names = [r.feature for r in best.select("feature").collect()]
    index = docs.sparkSession.sparkContext.broadcast({f: i for i, f in enumerate(names)})

    def encode(batches):
        number = index.value
        for batch in batches:
            rows = []
            for text in batch.column("text").to_pylist():
                bags = sentences(text)
                hits = [sorted({number[f] for w in bag for f in features_of(w) if f in number}) for bag in bags]
                rows.append(([h for h in hits if h], sum(not h for h in hits)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("toxic"), pa.array([r[0] for r in rows], pa.list_(pa.list_(pa.int32()))),
                 pa.array([r[1] for r in rows], pa.int64())], ["toxic", "bags", "plain"])

    got = sample.mapInArrow(encode, "toxic int, bags array<array<int>>, plain long").collect()
    got.sort(key=lambda r: (r.toxic, r.plain, r.bags))
    y = np.array([r.toxic for r in got])
    weight = np.where(y > 0, counts[1] / n1, counts[0] / n0).astype(float)
    w, b = fit_bags([r.bags for r in got], np.array([r.plain for r in got], float), y, weight, len(names))
    return ToxicityModel({f: float(v) for f, v in zip(names, w, strict=True) if v}, float(b))


def score_toxicity(docs: DataFrame, model: ToxicityModel, threshold: float = 0.5, keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` (all columns or those of ``keep``) as ``row``, with ``score`` and the offending sentences.

    ``offending`` holds start, end (code points) and probability of each sentence at or over
    ``threshold``. Null and empty texts score 0. The model is at most a few thousand weights.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(texts, given):
        model, scores, found = shared.value, [], []
        for text in texts.to_pylist():
            scores.append(model.score(text))
            # a bag at or over one half may still have no such sentence, a bag far below has none
            spans = model.offending(text, threshold) if scores[-1] >= threshold else []
            found.append([{"start": a, "end": b, "score": p} for a, b, p in spans])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        return {"score": pa.array(scores, pa.float64()), "offending": pa.array(found, kind)}

    return with_columns_after(docs, work, "score double,offending array<struct<start:bigint,end:bigint,score:double>>", keep=keep)


def detect(docs: DataFrame, labels: DataFrame, per_label: int = 6000) -> DataFrame:
    """doc_id, held_out, score, predicted, n_offending of every row of ``docs``.

    Null, empty and letterless texts have no sentence and the score of none; a very long text is scored
    by all its sentences. Repeated rows are scored each. An empty table gives no rows, and without
    labelled rows every score is that of a model that knows nothing. No other column than doc_id and
    text is read, so none can clash.
    """
    model = fit_toxicity(docs, labels.filter(fold("doc_id", 5) != 0), per_label)
    found = score_toxicity(docs, model, keep=["doc_id"]).select("row.doc_id", "score", F.size("offending").cast("bigint").alias("n_offending"))
    return found.select(
        "doc_id",
        (fold("doc_id", 5) == 0).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
        "n_offending",
    )
