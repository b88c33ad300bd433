import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.common import ODD_IDS, documents, ids_of, no_documents, odd_documents
from tilecast.llm import language_id


def test_held_out_rows_are_told_apart(spark):
    docs = documents(spark)
    found = language_id.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert set(found.held_out) == {True, False}
    held = found[found.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert found.score.between(0, 1).all()


def test_labels_of_held_out_rows_do_not_matter(spark):
    docs = documents(spark)
    spoiled = docs.withColumn("lang", F.when(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2, "xx").otherwise(F.col("lang")))
    assert "xx" not in set(language_id.identify(spoiled).toPandas().lang_pred)


def test_odd_rows(spark):
    rows = language_id.identify(odd_documents(spark)).collect()
    assert ids_of(rows) == ODD_IDS
    by_id = {r.doc_id: r for r in rows}
    assert all(by_id[k].lang_pred == "und" and by_id[k].score == 0 for k in (1, 2, 3, 4))
    assert by_id[8].lang_pred in ("en", "de", "fr", "es")
    kept = language_id.keep_identified(odd_documents(spark))
    assert kept.columns == odd_documents(spark).columns
    assert not {1, 2, 3, 4} & {r.doc_id for r in kept.collect()}


def test_no_rows_and_no_labels(spark):
    assert language_id.identify(no_documents(spark)).count() == 0
    bare = odd_documents(spark).withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in language_id.identify(bare).collect()} == {"und"}


def test_one_language_alone(spark):
    rows = language_id.identify(documents(spark).withColumn("lang", F.lit("en"))).collect()
    assert {r.lang_pred for r in rows} == {"en"}


def test_svm_separates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(200, 5)).astype(np.float32)
    y = np.where(x @ np.array([1, -2, 0, 1, 3.0]) + 0.5 > 0, 1.0, -1.0)
    w = language_id.fit_svm(x, y)
    assert (np.sign(x @ w[:-1] + w[-1]) == y).mean() > 0.97


def test_equal_texts_get_equal_answers(spark):
    """In any order and partitioning, beside any neighbours: the answer is the text's own."""
    alone = language_id.trigram_vectors(pa.array(["a"]))
    assert (alone[0] == language_id.trigram_vectors(pa.array(["zz", "a", "qq"]))[1]).all()
    model = language_id.fit_languages(language_id.training_rows(documents(spark)))
    rows = [(i, t) for i, t in enumerate(["de", "un", "a", "no la", "the end", "el", "x"] * 60 + [r.text for r in documents(spark).limit(60).collect()])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    answers = {}
    for shuffled in (docs.coalesce(1), docs.repartition(7), docs.orderBy(F.xxhash64("doc_id", F.lit(3)))):
        for r in language_id.predict_languages(shuffled, model).collect():
            assert answers.setdefault(r.row.text, (r.lang_pred, r.score)) == (r.lang_pred, r.score)
    with pytest.raises(ValueError, match="over 2 languages"):
        language_id.fit_languages(documents(spark), most_languages=2)


def test_vectors_by_hand():
    text = "Hé, the the! 9x"
    spots = {}
    data = [0, *(language_id.LETTERS[b] for b in text.encode()), 0]
    for a, b, c in zip(data, data[1:], data[2:]):
        if a or b or c:
            spot = (((int(a) << 16) | (int(b) << 8) | int(c)) * 2654435761 % 2**32) >> (32 - language_id.WIDTH_BITS)
            spots[spot] = spots.get(spot, 0) + 1
    vector = language_id.trigram_vectors(pa.array([text]))[0]
    total = sum(spots.values())
    assert {i: round(float(v), 6) for i, v in enumerate(vector) if v} == {i: round((n / total) ** 0.5, 6) for i, n in spots.items()}
