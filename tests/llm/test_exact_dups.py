import hashlib
from collections import defaultdict

import pytest

from tests.llm.common import ODD, ODD_IDS, documents, ids_of, no_documents, odd_documents
from tilecast.llm import exact_dups

WHITE = str.maketrans("", "", exact_dups.WHITE)


def by_brute_force(rows):
    """rows: (doc_id, text); one (doc_id, keep_id, group_size, kept, sha256) each, sorted."""
    groups = defaultdict(list)
    for d, t in rows:
        groups[(t or "").translate(WHITE)].append((-len(t or ""), d is None, d or 0, d))
    out = []
    for norm, members in groups.items():
        members.sort()
        for k, m in enumerate(members):
            out.append((m[3], members[0][3], len(members), k == 0, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def digest(docs):
    return sorted((tuple(r) for r in exact_dups.copies_digest(docs).collect()), key=str)


def test_documents_against_brute_force(spark):
    docs = documents(spark)
    assert digest(docs) == by_brute_force([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("bits", [64, 1 << 24])
def test_near_misses_at_any_size_of_the_map(spark, monkeypatch, bits):
    """Equal lengths, equal prefixes, equal both, copies that differ in white space; a map of 64 bits is full."""
    monkeypatch.setattr(exact_dups, "BITS", bits)
    head = "h" * 100
    rows = [(i, head + f"{i % 7:03d}") for i in range(50)] + [(100 + i, f"{i % 5}" * (1 + i % 9)) for i in range(90)]
    rows += [(300, " a\tb"), (301, "a b\n\v\f\r "), (302, "ab"), (303, "a　b"), (304, "a\u0085b"), (305, "a\x1cb")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert digest(docs) == by_brute_force(rows)


def test_only_survivors_are_hashed(spark):
    rows = [(1, "alone"), (2, "x" * 100 + "a"), (3, "x" * 100 + "b"), (4, "pair"), (5, "p air"), (6, "four")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.row.doc_id: r for r in exact_dups.exact_duplicates(docs).collect()}
    assert {d for d, r in found.items() if r.hash} == {2, 3, 4, 5}
    assert {d for d, r in found.items() if not r.kept} == {4}


def test_hot_groups_take_the_other_join(spark, monkeypatch):
    monkeypatch.setattr(exact_dups, "HOT_ROWS", 5)
    rows = [(i, "hot" if i % 3 == 0 else f"t{i // 4}") for i in range(200)]
    assert digest(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == by_brute_force(rows)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    assert digest(docs) == by_brute_force([(r[0], r[1]) for r in ODD])
    assert ids_of(exact_dups.copies_digest(docs).collect()) == ODD_IDS
    kept = exact_dups.drop_copies(docs)
    assert kept.columns == docs.columns
    # 1, 2 and 3 hold no character, 3 is the longest; one row of 8 stays for both of 8 and for 9
    assert ids_of(kept.collect()) == [None, *sorted({d for d in ODD_IDS if d is not None} - {1, 2, 9})]
    assert exact_dups.copies_digest(no_documents(spark)).count() == 0


def test_one_row_of_repeated_rows_stays(spark):
    docs = spark.createDataFrame([(8, "same"), (8, "same"), (None, "same"), (9, "s a m e")], "doc_id long, text string")
    assert [tuple(r) for r in exact_dups.drop_copies(docs).collect()] == [(9, "s a m e")]
    docs = docs.filter("doc_id = 8")
    assert exact_dups.drop_copies(docs).count() == 1


def test_no_python_in_the_plan(spark):
    plan = exact_dups.copies_digest(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
