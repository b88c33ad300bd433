import numpy as np

from tests.llm.common import ODD_IDS, documents, ids_of, no_documents, odd_documents
from tilecast.llm import toxicity
from tilecast.llm.toxicity import ToxicityModel

MODEL = ToxicityModel({"idiot": 9.0, "lowe*": 7.0}, -6.0)


def by_hand(text):
    keep = 1.0
    for bag in toxicity.sentences(text):
        z = -6.0 + sum(MODEL.weights.get(f, 0) for f in {f for w in bag for f in toxicity.features_of(w)})
        keep *= 1 - 1 / (1 + np.exp(-z))
    return 1 - keep


def test_noisy_or_of_sentences():
    for text in ("", "Nice day. Fine!", "You idiot! Go.\nAll good.", "Loweisch und lowe. Ja", "idiot idiot"):
        assert abs(MODEL.score(text) - by_hand(text)) < 1e-9
    assert MODEL.score("") == 0


def test_offending_sentences_are_located():
    text = "Ä first one. Then you idiot came! And went\nLoweien there"
    spans = MODEL.offending(text)
    assert [text[a:b].strip() for a, b, _ in spans] == ["Then you idiot came", "Loweien there"]


def test_bags_are_learned_from_document_labels():
    rng = np.random.default_rng(3)
    bags, y = [], []
    for i in range(300):
        bad = i % 2 == 0
        bags.append([sorted({int(f) for f in rng.integers(1, 20, 3)}) for _ in range(5)] + ([[0, 5]] if bad else []))
        y.append(int(bad))
    w, b = toxicity.fit_bags(bags, np.zeros(300), np.array(y), np.ones(300), 20)
    assert w[0] > 3 and np.abs(w[1:]).max() < w[0] / 2 and b < -2


def test_held_out_documents(spark):
    docs, labels = documents(spark, "0.01"), spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    found = toxicity.detect(docs, labels).join(labels, "doc_id").toPandas()
    assert (found.predicted == (found.score >= 0.5)).all()
    english = found[found.held_out]
    assert (english.predicted == english.toxic).mean() > 0.9


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, 1), (7, None), (None, 1), (99, 0), (6, 1)], "doc_id long, toxic int")
    rows = toxicity.detect(odd_documents(spark), labels).collect()
    assert ids_of(rows) == ODD_IDS
    assert all(r.score == 0 and r.predicted == 0 for r in rows if r.doc_id in (1, 2, 3))
    none = labels.limit(0)
    assert {r.predicted for r in toxicity.detect(odd_documents(spark), none).collect()} == {0}
    assert toxicity.detect(no_documents(spark), labels).count() == 0
