"""Language identification in two levels: the family first, then the language inside the family.

Both levels are one-versus-one linear support vector machines over hashed letter trigrams. A text is
one unit vector: the square roots of its trigram frequencies.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.llm.text import bounded_sample, fold, utf8, with_columns_after

#: Languages that are close relatives. A language not named is a family by itself.
FAMILIES = {
    "germanic": ("da", "de", "en", "nl", "no", "sv"),
    "romance": ("ca", "es", "fr", "it", "pt", "ro"),
    "slavic": ("bg", "cs", "pl", "ru", "sk", "uk"),
}
UNKNOWN = "und"
WIDTH_BITS = 12
#: Letters by their number, any other ASCII byte as a gap; bytes of longer code points as they are.
LETTERS = np.arange(256, dtype=np.uint32)
LETTERS[:128] = 0
LETTERS[97:123] = np.arange(1, 27)
LETTERS[65:91] = np.arange(1, 27)


def trigram_vectors(texts: pa.Array) -> np.ndarray:
    """One row of 2**WIDTH_BITS square-rooted trigram frequencies per text; zeros without trigrams.

    A gap stands before and after every text, so that no window reaches into a neighbour.
    """
    data, at = utf8(texts)
    n = len(at) - 1
    letters = np.zeros(len(data) + n + 1, np.uint32)
    spot_of = np.arange(len(data)) + np.repeat(np.arange(1, n + 1), np.diff(at))
    letters[spot_of] = LETTERS[data]
    mixed = (letters[spot_of - 1] << 16) | (letters[spot_of] << 8) | letters[spot_of + 1]
    spots = (mixed * np.uint32(2654435761)) >> np.uint32(32 - WIDTH_BITS)
    out = np.zeros((n, 1 << WIDTH_BITS), np.float32)
    gaps = mixed == 0
    for i in range(n):
        lo, hi = at[i], at[i + 1]
        if lo == hi:
            continue
        here = spots[lo:hi][~gaps[lo:hi]]
        counts = np.bincount(here, minlength=1 << WIDTH_BITS)
        out[i] = np.sqrt(counts / max(1, len(here)))
    return out


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, epochs: int = 30) -> np.ndarray:
    """Weights, then the intercept, of an L1-loss linear SVM by dual coordinate descent; y is -1 or 1."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)]).astype(np.float64)
    norms = (x * x).sum(1)
    limits = np.where(y > 0, cost * len(y) / max(1, 2 * (y > 0).sum()), cost * len(y) / max(1, 2 * (y < 0).sum()))
    w, alpha, rng = np.zeros(x.shape[1]), np.zeros(len(x)), np.random.default_rng(7)
    for _ in range(epochs):
        moved = 0.0
        for i in rng.permutation(len(x)):
            slope = y[i] * (x[i] @ w) - 1
            new = min(max(alpha[i] - slope / norms[i], 0.0), limits[i])
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-3:
            break
    return w


@dataclass
class Level:
    """One-versus-one machines between ``names``; a row is won by the most pairwise wins."""

    names: list[str]
    pairs: list[tuple[int, int]]
    weights: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, labels: np.ndarray, names: list[str]) -> Level:
        pairs = list(combinations(range(len(names)), 2))
        weights = [np.zeros((x.shape[1] + 1, 0))]
        for a, b in pairs:
            use = (labels == names[a]) | (labels == names[b])
            weights.append(fit_svm(x[use], np.where(labels[use] == names[a], 1.0, -1.0))[:, None])
        return cls(names, pairs, np.hstack(weights))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The winner's index, and how sure its closest pairwise win was (0.5 to 1; 1 without rivals)."""
        # doubles, rounded: which rows share a matrix product must not show in a row's result
        margins = np.round(x.astype(np.float64) @ self.weights[:-1] + self.weights[-1], 9)
        wins = np.zeros((len(x), len(self.names)))
        for k, (a, b) in enumerate(self.pairs):
            sure = 1 / (1 + np.exp(-np.clip(3 * margins[:, k], -30, 30)))
            wins[:, a] += (margins[:, k] > 0) + 0.01 * sure
            wins[:, b] += (margins[:, k] <= 0) + 0.01 * (1 - sure)
        best, surety = wins.argmax(1), np.ones(len(x))
        for k, (a, b) in enumerate(self.pairs):
            sure = 1 / (1 + np.exp(-np.clip(3 * margins[:, k], -30, 30)))
            surety = np.where(best == a, np.minimum(surety, sure), surety)
            surety = np.where(best == b, np.minimum(surety, 1 - sure), surety)
        return best, surety


@dataclass
class LanguageModel:
    families: Level
    inside: dict[str, Level]

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        lang, score = np.full(len(x), UNKNOWN, object), np.zeros(len(x))
        if not self.families.names:
            return lang, score
        family, sure = self.families.predict(x)
        for k, name in enumerate(self.families.names):
            rows = family == k
            if rows.any():
                level = self.inside[name]
                best, closer = level.predict(x[rows])
                lang[rows] = np.array(level.names, object)[best]
                score[rows] = sure[rows] * closer
        return lang, score


def fit_languages(
    train: DataFrame, per_language: int = 600, families: dict | None = None, most_languages: int = 64, most_rows: int = 20_000
) -> LanguageModel:
    """Fit on about ``per_language`` rows (the documented bound) of every language of ``train``.

    ``train`` has text, lang and doc_id; rows without lang or text are left out, doc_id only picks the
    sample. Executors make the vectors; the driver gets 8 KB for each sampled row, however long its
    text is, and with many languages fewer rows of each, ``most_rows`` in all. There is a machine for
    every pair of families and of languages in one, so more than ``most_languages`` languages fail.
    Repeated rows are rows of their own. Without a row to learn from, every text is unknown.
    """
    rows = train.filter(F.col("text").isNotNull()).select("doc_id", "text", "lang")
    n = rows.select("lang").filter(F.col("lang").isNotNull()).distinct().limit(most_languages + 1).count()
    if n > most_languages:
        raise ValueError(f"over {most_languages} languages: raise most_languages if the driver can hold their machines")
    sample = bounded_sample(rows, F.col("lang"), F.col("doc_id"), min(per_language, most_rows // max(n, 1)))

    def vectors(batches):
        for batch in batches:
            x = trigram_vectors(batch.column("text")).astype(np.float16)
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang"), pa.array([r.tobytes() for r in x], pa.binary())], ["lang", "x"]
            )

    got = sorted((r.lang, bytes(r.x)) for r in sample.select("lang", "text").mapInArrow(vectors, "lang string, x binary").collect())
    labels = np.array([g[0] for g in got], object)
    x = np.array([np.frombuffer(g[1], np.float16) for g in got], np.float32).reshape(len(got), 1 << WIDTH_BITS)
    home = {lang: name for name, members in (families or FAMILIES).items() for lang in members}
    of = np.array([home.get(v, v) for v in labels], object)
    names = sorted(set(of))
    inside = {f: Level.fit(x[of == f], labels[of == f], sorted(set(labels[of == f]))) for f in names}
    return LanguageModel(Level.fit(x, of, names), inside)


def predict_languages(docs: DataFrame, model: LanguageModel, keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` (all columns or those of ``keep``) as the struct ``row``, with ``lang_pred`` and ``score``.

    A text that is null or has no letter gets ``und`` and 0, and so does every text if nothing was
    learned. Equal texts get equal answers wherever they lie; a very long text is one vector like any
    other; rows that repeat are answered each; of equal votes the name that sorts first wins. Columns of
    ``docs`` travel in ``row``, so none can clash; an empty table gives no rows. The model is a few
    vectors of fixed width per pair of languages; nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(texts, given):
        lettered = np.asarray(given.field("lettered").to_numpy(zero_copy_only=False), bool)
        lang, score = np.full(len(texts), UNKNOWN, object), np.zeros(len(texts))
        for lo in range(0, len(texts), 256):
            part = slice(lo, lo + 256)
            lang[part], score[part] = shared.value.predict(trigram_vectors(texts.slice(lo, 256)))
        lang[~lettered], score[~lettered] = UNKNOWN, 0.0
        return {"lang_pred": pa.array(lang, pa.string()), "score": pa.array(score, pa.float64())}

    lettered = {"lettered": F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))}
    return with_columns_after(docs, work, "lang_pred string, score double", lettered, keep)


def training_rows(docs: DataFrame) -> DataFrame:
    """The rows that labels may be learned from: crc32 of doc_id modulo 4 is not 2."""
    return docs.filter(fold("doc_id", 4) != 2)


def identify(docs: DataFrame, per_language: int = 600) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs``; odd rows as in ``predict_languages``."""
    found = predict_languages(docs, fit_languages(training_rows(docs), per_language), ["doc_id"])
    held = (fold("doc_id", 4) == 2).alias("held_out")
    return found.select("row.doc_id", "lang_pred", "score").select("doc_id", held, "lang_pred", "score")


def keep_identified(docs: DataFrame, per_language: int = 600, min_score: float = 0.25) -> DataFrame:
    """Rows of ``docs`` with a language: not ``und``, and a score of ``min_score`` or more.

    A winner of all its pairs has at least 0.5 in either level, so the default rejects texts without a
    letter and those whose pairwise votes go in a circle, no more.
    """
    found = predict_languages(docs, fit_languages(training_rows(docs), per_language))
    return found.filter((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= min_score)).select("row.*")
