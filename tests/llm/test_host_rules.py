import re

from tests.check_oracle import connect, difference
from tests.llm.common import ODD_IDS, ids_of, no_documents, odd_documents
from tilecast.llm import host_rules
from tilecast.llm.queries import ORACLE, QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(text):
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {p for i, w in enumerate(windows) if windows.count(w) > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(inside))


def test_measures_by_hand():
    for text in ("", "a", "a b c a b c", "x y x y x y x y", "l\nl\n\n \nl", "#*$ % é é |<>", "a b c d\x0ba b c\x0c", "one two three four"):
        assert host_rules.measure(text) == by_hand(text)


def test_sql(spark):
    got = QUERIES["op5_host_rules"](spark, "/root/testdata/sf0.001").toPandas()
    assert difference(got, connect("/root/testdata/sf0.001").execute(ORACLE["op5_host_rules"]).df()) is None


def test_a_bad_host_takes_its_documents_along(spark):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, good, "fine") for i in range(50)] + [(100 + i, "too short", "bad") for i in range(50)] + [(200, good, "bad"), (300, good, "new")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in host_rules.quality_rules(docs).collect()}
    assert found[0].kept and not found[100].kept and found[100].base_failed
    assert not found[200].kept and not found[200].base_failed
    assert found[300].kept
    assert {r.doc_id for r in host_rules.keep_quality(docs).collect()} == {*range(50), 300}


def test_odd_rows(spark):
    rows = host_rules.quality_rules(odd_documents(spark)).collect()
    assert ids_of(rows) == ODD_IDS
    assert all(r.n_words == 0 and r.base_failed and not r.kept for r in rows if r.doc_id in (1, 2, 3))
    assert host_rules.keep_quality(odd_documents(spark)).columns == odd_documents(spark).columns
    assert host_rules.quality_rules(no_documents(spark)).count() == 0
