import numpy as np
import pytest

from tests.llm.common import ODD_IDS, documents, ids_of, no_documents, odd_documents
from tilecast.llm import near_dups
from tilecast.llm.shingles import FAR, shingle_set, sketches


def sets_of(text, size):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()


def by_brute_force(rows, size, percent=80):
    """rows: (doc_id, text), all pairs; the smallest id reachable."""
    sets, top = [(d, sets_of(t, size)) for d, t in rows], {d: d for d, _ in rows}
    while True:
        changed = False
        for i, (a, x) in enumerate(sets):
            for b, y in sets[i + 1 :]:
                if x and y and top[a] != top[b] and 100 * len(x & y) >= percent * len(x | y):
                    top[a] = top[b] = min(top[a], top[b])
                    changed = True
        if not changed:
            return top


def chain(spark, n=40, length=100, step=6):
    """Texts of which neighbours are alike and distant ones are not, and near misses of all."""
    words = [f"w{i}" for i in range(length + n * step)]
    rows = [(i, " ".join(words[i * step : i * step + length])) for i in range(n)]
    base = [f"b{i}" for i in range(100)]
    for i in range(60):  # like the base in about 0.7 to 0.9
        rng = np.random.default_rng(i)
        text = list(base)
        for k in rng.choice(100, 3 + i % 8, replace=False):
            text[k] = f"e{i}_{k}"
        rows.append((1000 + i, " ".join(text)))
    return rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def test_documents_against_brute_force(spark):
    docs = documents(spark)
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    for size in (2, 5):
        want = by_brute_force(rows, size)
        found = near_dups.near_duplicates(docs, size).collect()
        assert {r.doc_id: r.component_id for r in found} == want
        assert {r.doc_id: r.n_shingles for r in found} == {d: len(sets_of(t, size)) for d, t in rows}
        assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_chains_and_near_misses_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", 8)
    rows, docs = chain(spark)
    found = near_dups.near_duplicates(docs, 2).collect()
    assert {r.doc_id: r.component_id for r in found} == by_brute_force(rows, 2)


@pytest.mark.parametrize("apart", [256, 1])
def test_pair_of_one_bucket_led_by_a_stranger(spark, monkeypatch, apart):
    """The sketches of 1, 2 and 3 agree in band 7 alone; elsewhere their last bytes are equal (256) or not (1)."""
    def planted(sets, size):
        rows = np.array([np.arange(size) * 100_000 + apart * len(s) for s in sets], np.int64).reshape(len(sets), size)
        rows[:, 35:40] = 7
        return rows

    monkeypatch.setattr(near_dups, "sketches", planted)
    pair = [f"w{i}" for i in range(100)]
    rows = [(1, " ".join(f"s{i}" for i in range(95))), (2, " ".join(pair)), (3, " ".join([*pair, "more"]))]
    found = near_dups.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 2).collect()
    assert {r.doc_id: r.component_id for r in found} == {1: 1, 2: 2, 3: 2}


def test_overlaps_by_brute_force(monkeypatch):
    monkeypatch.setattr(near_dups, "ENTRIES", 40)  # several goes
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 60, n)).astype(np.uint64) for n in (30, 0, 1, 50, 8, 90, 20)]
    count = near_dups.overlaps(sets)
    for x, a in enumerate(sets):
        assert count(x).tolist() == [len(np.intersect1d(a, b)) if y > x else 0 for y, b in enumerate(sets)]


def test_odd_rows(spark):
    found = near_dups.near_duplicates(odd_documents(spark), 2).collect()
    assert ids_of(found) == ODD_IDS
    by_id = {r.doc_id: r for r in found}
    assert (by_id[9].component_id, by_id[9].kept, by_id[8].kept) == (8, False, True)
    assert all(by_id[k].n_shingles == 0 and by_id[k].component_id == k and by_id[k].kept for k in (1, 2, 3))
    assert by_id[5].n_shingles == 1 and by_id[None].component_id is None and by_id[None].kept
    kept = near_dups.keep_first(odd_documents(spark), 2)
    assert kept.columns == odd_documents(spark).columns
    assert ids_of(kept.collect()) == [d for d in ODD_IDS if d != 9]
    assert near_dups.near_duplicates(no_documents(spark)).count() == 0


def test_sketches_fill_and_estimate():
    a = shingle_set(" ".join(f"w{i}" for i in range(1000)), 1)
    b = shingle_set(" ".join(f"w{i}" for i in range(200, 1200)), 1)
    tiny = shingle_set("one", 1)
    rows = sketches([a, b, tiny, a[:0]], 255)
    assert (rows[:3] < FAR).all() and (rows[3] == FAR).all()
    assert abs((rows[0] == rows[1]).mean() - 800 / 1200) < 0.12
    assert (rows[0] == sketches([a], 255)[0]).all()


def test_components_of_a_long_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400)], "a long, b long")
    found = {r.doc: r.component for r in near_dups.components(links, "path").collect()}
    assert found == {**dict.fromkeys(range(201), 0), 400: 400, 500: 400}
