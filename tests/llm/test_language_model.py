import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.llm.common import ODD_IDS, documents, ids_of, no_documents, odd_documents
from tilecast.llm import language_model, recurrent
from tilecast.llm.text import fold
from tilecast.session import materialize

LAYOUT = recurrent.Layout([0, 2, 5], 3)


def model(seed=0):
    rng = np.random.default_rng(seed)
    p = recurrent.initial(LAYOUT, np.arange(8.0), 6)
    return {k: (v + rng.normal(0, 0.3, v.shape)).astype(np.float64) for k, v in p.items()}


def log_likelihood(p, text):
    """One token at a time, straight from the definition."""
    of, h, x, total, n = LAYOUT.class_of(), np.zeros(6), LAYOUT.symbols, 0.0, 6
    for y in text:
        a = p["into"][x]
        g = 1 / (1 + np.exp(-(a[: 2 * n] + h @ p["back"][:, : 2 * n])))
        new = np.tanh(a[2 * n :] + (g[n:] * h) @ p["back"][:, 2 * n :])
        h = (1 - g[:n]) * new + g[:n] * h
        e = np.exp(h @ p["class_w"] + p["class_b"])
        total += np.log(e[of[y]] / e.sum())
        if of[y] < 2:
            lo, hi = LAYOUT.limits[of[y]], LAYOUT.limits[of[y] + 1]
            e = np.exp(h @ p["word_w"][:, lo:hi] + p["word_b"][lo:hi])
            total += np.log(e[y - lo] / e.sum())
        x = y
    return total


def test_state_is_carried_over_windows():
    rng = np.random.default_rng(2)
    texts = [rng.integers(0, 8, n) for n in (1, 31, 32, 33, 100, 0, 65)]
    got = recurrent.score(model(), LAYOUT, texts, width=3)
    assert np.allclose(got, [log_likelihood(model(), t) for t in texts], atol=1e-4)


def test_next_symbol_probabilities_sum_to_one():
    p = model()
    before = [3, 1, 7]
    base = log_likelihood(p, before)
    assert sum(np.exp(log_likelihood(p, [*before, y]) - base) for y in range(8)) == pytest.approx(1)


def test_gradients_by_differences():
    """Of the log-likelihood of windows in which texts end and begin, with states carried in as constants."""
    rng = np.random.default_rng(6)
    p = model()
    texts = [rng.integers(0, 8, n) for n in (5, 9, 3, 12)]
    lanes = recurrent.lane_texts(texts, 2)
    (x, y, of, begins), = recurrent.windows(texts, lanes, LAYOUT.symbols)
    h0 = rng.normal(0, 0.5, (2, 6))
    first = begins.copy()
    first[0] = False  # as if the first texts went on from before
    t, b = np.nonzero(of >= 0)

    def total(q):
        states = recurrent.forward(q, x, first, h0).astype(np.float64)
        return recurrent.log_likelihoods(q, LAYOUT, LAYOUT.class_of(), states[t, b], y[t, b]).sum()

    grad, kept = {k: np.zeros_like(v) for k, v in p.items()}, []
    states = recurrent.forward(p, x, first, h0, kept)
    _, d = recurrent.log_likelihoods(p, LAYOUT, LAYOUT.class_of(), states[t, b], y[t, b], grad)
    outer = np.zeros_like(states)
    outer[t, b] = d
    into = recurrent.backward(p, grad, kept, outer, first)
    np.add.at(grad["into"], x.reshape(-1), into.reshape(-1, 18))
    for k, v in p.items():
        for at in [tuple(rng.integers(0, n) for n in v.shape) for _ in range(12)]:
            up, down = ({**p, k: v.copy()} for _ in range(2))
            up[k][at] += 1e-2
            down[k][at] -= 1e-2
            assert -(total(up) - total(down)) / 2e-2 == pytest.approx(grad[k][at], abs=2e-2), (k, at)


def test_lanes_do_not_depend_on_the_order_of_texts():
    rng = np.random.default_rng(8)
    texts = [rng.integers(0, 8, n) for n in rng.integers(0, 60, 50)]
    p = recurrent.initial(LAYOUT, np.ones(8), 6)
    a, seen = recurrent.train(p, LAYOUT, texts)
    b, _ = recurrent.train(p, LAYOUT, texts[::-1])
    assert all((a[k] == b[k]).all() for k in p) and seen == sum(map(len, texts))


@pytest.mark.parametrize("partitions", [1, 4, 16])
def test_training_helps_held_out_texts_however_they_lie(spark, monkeypatch, partitions):
    """Above the base, and above the untrained model, also where one task holds all long texts."""
    docs = documents(spark, "0.01").repartition(partitions)
    monkeypatch.setattr(language_model, "materialize", lambda df, name: materialize(df.coalesce(partitions) if name == "streams" else df, name))

    def per_token(rounds):
        rows = language_model.score_texts(docs, fold("doc_id", 7) == 2, rounds=rounds).filter("held_out")
        return rows.agg(F.sum("score") / F.sum("n_tokens"), F.sum("base_score") / F.sum("n_tokens")).first()

    untrained, _ = per_token(0)
    trained, base = per_token(language_model.ROUNDS)
    print(f"log10 a held-out token in {partitions} partitions: {trained:.3f}, untrained {untrained:.3f}, base {base:.3f}")
    assert trained > untrained + 0.005 and trained > base


def test_windows_of_many_lanes_take_few_calls():
    """What Python does grows with lanes and windows, not with their product."""
    texts = [np.zeros(20 * recurrent.WINDOW, np.uint16)] * 400
    lanes, calls = recurrent.lane_texts(texts, 400), Counter()
    sys.setprofile(lambda frame, event, arg: calls.update([event]))
    try:
        n = sum(1 for _ in recurrent.windows(texts, lanes, LAYOUT.symbols))
    finally:
        sys.setprofile(None)
    assert n == 20 and calls["call"] + calls["c_call"] < 400 * 20


def test_windows_hold_every_token_once():
    rng = np.random.default_rng(12)
    texts = [rng.integers(0, 8, n) for n in (40, 0, 3, 64, 1, 7, 0, 33, 32)]
    seen = [[] for _ in texts]
    for x, y, of, begins in recurrent.windows(texts, recurrent.lane_texts(texts, 3), LAYOUT.symbols):
        for b in range(x.shape[1]):
            for t in np.flatnonzero(of[:, b] >= 0).tolist():
                i = of[t, b]
                assert begins[t, b] == (not seen[i]) and x[t, b] == (seen[i][-1] if seen[i] else LAYOUT.symbols)
                seen[i].append(int(y[t, b]))
        assert (x[of < 0] == LAYOUT.symbols).all() and not begins[of < 0].any()
    assert seen == [t.tolist() for t in texts]
    assert not list(recurrent.windows([], [], 8)) and not list(recurrent.windows(texts[1:2], [[0]], 8))


def test_large_weights_leave_no_range():
    rng = np.random.default_rng(13)
    p = {k: (v * 300).astype(np.float32) for k, v in model().items()}
    h, y = rng.uniform(-1, 1, (200, 6)).astype(np.float32), rng.integers(0, 8, 200)
    got, slopes = recurrent.log_likelihoods(p, LAYOUT, LAYOUT.class_of(), h, y, {k: np.zeros_like(v) for k, v in p.items()})
    exact = recurrent.log_likelihoods({k: v.astype(np.float64) for k, v in p.items()}, LAYOUT, LAYOUT.class_of(), h.astype(np.float64), y)
    assert np.isfinite(slopes).all() and exact.min() < -100 and np.allclose(got, exact, rtol=1e-3, atol=1e-2)


def test_rows_are_added_to_their_places():
    rng = np.random.default_rng(14)
    at, rows = np.append(rng.integers(0, 9, 300), [9, 11, 11]), rng.normal(size=(303, 4))
    found, total = np.ones((12, 4)), np.ones((12, 4))
    recurrent.add_rows(found, at, rows)
    np.add.at(total, at, rows)
    assert np.allclose(found, total)


def test_first_step_follows_the_clipped_mean_slope():
    p = model()
    text = np.random.default_rng(15).integers(0, 8, 20)
    lanes = recurrent.lane_texts([text], 1)
    (x, y, _, begins), = recurrent.windows([text], lanes, LAYOUT.symbols)
    grad, kept = {k: np.zeros_like(v) for k, v in p.items()}, []
    states = recurrent.forward(p, x, begins, np.zeros((1, 6)), kept)
    _, d = recurrent.log_likelihoods(p, LAYOUT, LAYOUT.class_of(), states[:, 0], y[:, 0], grad)
    into = recurrent.backward(p, grad, kept, d[:, None], begins)
    np.add.at(grad["into"], x.reshape(-1), into.reshape(-1, 18))
    found, seen = recurrent.train(p, LAYOUT, [text], rate=0.01)
    assert seen == 20
    for k, v in p.items():
        q = np.clip(grad[k] / 20, -0.1, 0.1)
        assert np.allclose(found[k], v - 0.01 * q / (abs(q) + 1e-6), atol=1e-6), k


def test_words_are_split_at_ascii_white_space():
    chars = ["a", "B", " ", "\t", "\n", "\x0b", "\x0c", "\r", "\x1c", "\x1f", "\x85", "\xa0", "\u2003", "\u00c9", "\u65e5", "\0"]
    rng = np.random.default_rng(16)
    texts = ["", " ", "A", *("".join(rng.choice(chars, n)) for n in rng.integers(0, 40, 300))]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    at = 0
    for piece in language_model.pieces([batch], 100):
        words, codes, ends = language_model.split_words(piece.column("text"))
        assert len(set(words)) == len(words) and list(dict.fromkeys(codes.tolist())) == list(range(len(words)))
        for lo, hi in zip([0, *ends[:-1].tolist()], ends.tolist()):
            assert [words[k] for k in codes[lo:hi]] == texts[at].encode().lower().split()
            at += 1
    assert at == len(texts)


@pytest.mark.parametrize("most_words, most_tokens", [(5, 1000), (60, 25), (1000, 10_000)])
def test_blocks_read_back_as_the_texts(spark, monkeypatch, most_words, most_tokens):
    monkeypatch.setattr(language_model, "BLOCK_WORDS", most_words)
    monkeypatch.setattr(language_model, "BLOCK_TOKENS", most_tokens)
    rng = np.random.default_rng(17)
    rows = [(d, " ".join(f"W{w}" for w in rng.zipf(1.5, n) % 90)) for d, n in enumerate(rng.integers(0, 30, 120).tolist())]
    docs = spark.createDataFrame([*rows, (500, None), (501, "  ")], "doc_id long, text string").repartition(2)
    found = language_model.to_blocks(docs, F.col("doc_id") % 3 == 0).collect()
    words, counts = {}, Counter()
    for r in sorted((r for r in found if r.radix >= 0), key=lambda r: (r.block, r.radix)):
        hashes, _, n = language_model.opened(r.words)
        words.setdefault(r.block, []).extend(hashes.view(np.int64).tolist())
        counts.update(dict(zip(hashes.view(np.int64).tolist(), n.tolist())))
    texts, expected = {d: [*(t or "").lower().encode().split(), b""] for d, t in [*rows, (500, ""), (501, "")]}, Counter()
    got = {r.doc_id: [words[r.block][k] for k in np.frombuffer(r.tokens, f"<u{r.width}")] for r in found if r.radix < 0}
    assert got == {d: [language_model._signed(w) for w in t] for d, t in texts.items()}
    for d, t in texts.items():
        expected.update(language_model._signed(w) for w in t if d % 3)
    assert +counts == expected


def test_training_raises_the_likelihood():
    rng = np.random.default_rng(4)
    texts = [np.tile([0, 3, 6], 20)[k : k + 50] for k in rng.integers(0, 3, 60)]
    p = recurrent.initial(LAYOUT, np.ones(8), 6)
    before = recurrent.score(p, LAYOUT, texts).sum()
    for _ in range(8):
        p, seen = recurrent.train(p, LAYOUT, texts, rate=0.02, width=8)
    assert seen == sum(map(len, texts))
    assert recurrent.score(p, LAYOUT, texts).sum() > before / 2


def test_counts_and_base_by_brute_force(spark, monkeypatch):
    monkeypatch.setattr(language_model, "BLOCK_WORDS", 3000)  # many blocks
    monkeypatch.setattr(language_model, "FAN", 3)  # summed in several levels
    monkeypatch.setattr(language_model, "SALT", 2)
    monkeypatch.setattr(language_model, "RADIX_BYTES", 20_000)  # more radixes
    docs = documents(spark).repartition(7)
    texts = {r.doc_id: [*r.text.encode().lower().split(), b""] for r in docs.collect()}
    held = {d: zlib.crc32(str(d).encode()) % 7 == 2 for d in texts}
    c = Counter(w for d, t in texts.items() if not held[d] for w in t)
    n, v = sum(c.values()), len(c)
    found = language_model.score_digest(docs).collect()
    assert {r.doc_id for r in found} == set(texts)
    for r in found:
        t = texts[r.doc_id]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(t), sum(c[w] > 0 for w in t), n)
        assert r.base_score == pytest.approx(sum(np.log10((c[w] + 1) / (n + v + 1)) for w in t), rel=1e-9)
    assert sum(r.score for r in found) > sum(r.base_score for r in found)


def test_copies_fill_blocks_of_few_tokens(spark, monkeypatch):
    monkeypatch.setattr(language_model, "BLOCK_TOKENS", 50)
    rows = [(d, "the same seven words in every text") for d in range(40)] + [(99, "long " * 70)]  # 8 tokens each, then 71
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = language_model.to_blocks(docs, F.lit(False)).collect()
    tokens = Counter()
    for r in found:
        if r.tokens is not None:
            tokens[r.block] += len(r.tokens) // r.width
    assert sorted(tokens.values()) == [32, *[48] * 6, 71]
    assert sum(int(language_model.opened(r.words)[2].sum()) for r in found if r.radix >= 0) == 40 * 8 + 71


def test_rounds_take_every_training_document(spark):
    rows = [(d if d else None, d % 5 == 1, -float(d)) for d in range(300)]
    streams = spark.createDataFrame(rows, "doc_id long, held_out boolean, base_score double")
    taken = [r.doc_id for turn in range(language_model.ROUNDS) for r in language_model.turn_rows(streams, turn, language_model.SHARE).collect()]
    assert sorted(taken, key=lambda d: d or 0) == [d for d, out, _ in rows if not out]


def test_odd_rows(spark):
    found = language_model.score_digest(odd_documents(spark)).collect()
    assert ids_of(found) == ODD_IDS
    assert all(np.isfinite(r.score) and r.score <= 0 for r in found)
    assert {r.n_tokens for r in found if r.doc_id in (1, 2, 3)} == {1}
    assert language_model.score_digest(no_documents(spark)).count() == 0
