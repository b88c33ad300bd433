import hashlib
import re
from collections import Counter

import xxhash

from tests.llm.common import ODD, ODD_IDS, documents, ids_of, no_documents, odd_documents
from tilecast.llm import fingerprints


def edited_texts(rows):
    """rows: (doc_id, text), null ids first; the edited text of each."""
    signed = lambda t: (xxhash.xxh64_intdigest(t, seed=42) + 2**63) % 2**64  # noqa: E731  Spark's xxhash64, from its smallest
    rows = sorted(((d, t or "") for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, signed(r[1])))
    out = []
    for k, (d, t) in enumerate(rows):
        half = len(t) // 2
        out.append((d, t, t[: len(t) - half] + rows[(k + 1) % len(rows)][1][:half]))
    return out


def check(found, rows):
    want = Counter((d, len(t), hashlib.sha256(e.encode()).hexdigest()) for d, t, e in edited_texts(rows))
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in found) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)


def test_edited_texts_and_likeness(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "BLOCK_ROWS", 7)  # many blocks
    docs = documents(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = fingerprints.imatch(docs).collect()
    check(found, rows)
    by_id = {r.doc_id: r for r in found}
    of_text = {}
    for d, t in rows:
        assert of_text.setdefault(t, by_id[d].fingerprint) == by_id[d].fingerprint
    following = sorted(by_id)
    for k, d in enumerate(following):
        same = by_id[d].fingerprint == by_id[following[(k + 1) % len(following)]].fingerprint
        assert (by_id[d].near_next == 1.0) == same


def prints_by_hand(text, lexicon):
    """The fingerprint: eight hex digits a subset, of the hash of its sorted terms' codes."""
    words = {w for w in re.split(r"[\W_]+", text.lower()) if w in lexicon}
    codes = sorted(lexicon[w] for w in words)
    parts = [[c for c in codes if c % fingerprints.SUBSETS == k] for k in range(fingerprints.SUBSETS)]
    return parts


def test_fingerprints_and_likeness_by_hand(spark):
    """Subsets agree exactly where the terms in them do, and every lexicon term is in one of them."""
    docs = documents(spark)
    lexicon = {r.term: r.code for r in fingerprints.lexicon(docs.select("text")).collect()}
    assert {c % fingerprints.SUBSETS for c in lexicon.values()} == set(range(fingerprints.SUBSETS))
    found = {r.doc_id: r for r in fingerprints.imatch(docs).collect()}
    rows = edited_texts([(r.doc_id, r.text) for r in docs.collect()])
    hands = {d: (prints_by_hand(t, lexicon), prints_by_hand(e, lexicon)) for d, t, e in rows}
    digits = fingerprints.DIGITS

    def alike(a, b, x, y):
        if a == b and (any(a) or x == y):
            return 1.0
        used = sum(bool(p or q) for p, q in zip(a, b, strict=True))
        return sum(p == q != [] for p, q in zip(a, b, strict=True)) / used if used and any(a) and any(b) else 0.0

    for k, (d, t, e) in enumerate(rows):
        own, edited = hands[d]
        if any(own):
            cut = [found[d].fingerprint[digits * i : digits * (i + 1)] for i in range(fingerprints.SUBSETS)]
            assert [c == fingerprints.GAP for c in cut] == [not p for p in own]
        else:
            assert found[d].fingerprint.startswith("=")
        after = rows[(k + 1) % len(rows)]
        assert abs(found[d].near_edited - alike(own, edited, t, e)) < 1e-9
        assert abs(found[d].near_next - alike(own, hands[after[0]][0], t, after[1])) < 1e-9


def test_a_large_lexicon_is_shuffled(spark, monkeypatch):
    key = lambda r: (r.doc_id is not None, r.doc_id or 0, r.fingerprint)
    small = sorted(fingerprints.imatch(documents(spark)).collect(), key=key)
    monkeypatch.setattr(fingerprints, "BROADCAST_TERMS", 0)
    assert sorted(fingerprints.imatch(documents(spark)).collect(), key=key) == small


def test_ids_of_any_range(spark, monkeypatch):
    """Hashed ids, both ends of 64 bits, one far id, all ids null, one id for all."""
    monkeypatch.setattr(fingerprints, "BLOCK_ROWS", 4)
    texts = [f"text number {i:03d} of these" + " and more" * (i % 5) for i in range(40)]
    ends = [-(2**63), 2**63 - 1]
    for ids in ([hash((i, "x")) for i in range(38)] + ends, [*range(39), 10**15], [None] * 40, [5] * 40):
        rows = list(zip(ids, texts, strict=True))
        docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
        found = fingerprints.imatch(docs).collect()
        check(found, rows)
        placed = fingerprints.add_block(docs)
        assert max(r["count"] for r in placed.groupBy("block").count().collect()) <= 12


def test_lexicon_is_the_band(spark):
    texts = documents(spark)
    counts = Counter(w for r in texts.collect() for w in set(re.findall(r"[^\W_]+", r.text.lower())))
    n = texts.count()
    want = {w for w, c in counts.items() if 0.02 * n <= c <= 0.1 * n}
    got = {r.term for r in fingerprints.lexicon(texts.select("text"), 0.02, 0.1).collect()}
    assert got == want


def test_odd_rows(spark):
    found = fingerprints.imatch(odd_documents(spark)).collect()
    assert ids_of(found) == ODD_IDS
    check(found, [(d, t) for d, t, _, _ in ODD])
    prints = [r.fingerprint for r in found if r.doc_id in (8, 9)]
    assert len(set(prints)) == 1


def test_no_rows_and_one_row(spark):
    assert fingerprints.imatch(no_documents(spark)).count() == 0
    one = odd_documents(spark).filter("doc_id = 5")
    row = fingerprints.imatch(one).collect()[0]
    assert (row.n_chars, row.near_next) == (1, 1.0)
