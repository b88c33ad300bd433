import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.common import ODD, documents, no_documents, odd_documents
from tilecast.llm import packing

FILE = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(FILE)


def used(plan):
    total = Counter()
    for key, times in plan:
        assert times > 0 and sum(key) <= 128
        for n in key:
            total[n] += times
    return total


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 128), st.integers(1, 1000), max_size=40))
def test_a_plan_uses_every_length(histogram):
    plan = packing.plan_sequences(histogram, 128, 32)
    assert used(plan) == Counter(histogram)
    lengths, firsts, many, bases, offsets = packing.slots(plan)
    assert (np.lexsort((firsts, lengths)) == np.arange(len(lengths))).all()


def test_plans_are_tight():
    rng = np.random.default_rng(1)
    lengths = np.minimum(rng.lognormal(6, 1, 20_000).astype(int) + 1, 4096)
    plan = packing.plan_sequences(Counter(lengths.tolist()))
    assert sum(t for _, t in plan) <= 1.005 * np.ceil(lengths.sum() / 4096)


def test_nnls_is_optimal():
    rng = np.random.default_rng(2)
    a, b = rng.random((12, 30)), rng.random(12)
    x = packing.nnls(a, b)
    slope = a.T @ (b - a @ x)
    assert (x >= 0).all() and slope.max() < 1e-6 and np.abs(slope[x > 0]).max(initial=0) < 1e-6


def check(docs, rows, sequence=4096):
    found = packing.pack(docs, FILE, sequence, with_ids=True).collect()
    wanted = Counter()
    for d, t in rows:
        ids = [*PLAIN.encode(t or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), sequence):
            part = np.array(ids[k : k + sequence], "<u4").tobytes()
            wanted[(d, k // sequence, k, len(part) // 4, zlib.crc32(part), part)] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in found) == wanted
    filled = {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert max(filled.values()) <= sequence
    return len(filled), sum(filled.values())


@pytest.mark.parametrize("sequence", [4096, 256])
def test_documents(spark, sequence):
    docs = documents(spark)
    n, tokens = check(docs, [(r.doc_id, r.text) for r in docs.collect()], sequence)
    assert n <= 1.02 * tokens / sequence + 1


def test_odd_rows(spark):
    check(odd_documents(spark), [(d, t) for d, t, _, _ in ODD])
    assert packing.packing_digest(no_documents(spark), FILE).count() == 0
