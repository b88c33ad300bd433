import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tests.llm.common import ODD, documents, no_documents, odd_documents
from tilecast.llm import alignment
from tilecast.llm.queries import PIECES, RANKS
from tilecast.llm.text import ship

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PIECES)
LETTERS = [*range(33, 127), *range(161, 173), *range(174, 256)]
OTHERS = [c for c in range(256) if c not in LETTERS]
BYTE = {chr(c): c for c in LETTERS} | {chr(256 + i): c for i, c in enumerate(OTHERS)}


def bytes_of_b(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def groups_of(text):
    """[(ids of A, ids of B)] of one text, by walking both sequences."""
    if not text:
        return []
    sides = []
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    for ids, spell in ((a, lambda i: bytes(BYTE[c] for c in A.id_to_token(i))), (b, bytes_of_b)):
        spelled = [spell(i) for i in ids]
        if b"".join(spelled) != (" " + text).encode():
            return []
        sides.append((ids, np.cumsum([len(s) for s in spelled]).tolist()))
    common = set(sides[0][1]) & set(sides[1][1])
    out = []
    for ids, ends in sides:
        cut, now = [], []
        for i, e in zip(ids, ends, strict=True):
            now.append(i)
            if e in common:
                cut.append(now)
                now = []
        out.append(cut)
    return list(zip(*out, strict=True))


def by_brute_force(rows):
    each = [(d, groups_of(t)) for d, t in rows]
    links = [Counter((x, y) for a, b in groups for x in a for y in b) for _, groups in each]
    count = Counter(p for found in links for p in found)
    most = Counter()
    for (a, _), n in count.items():
        most[a] = max(most[a], n)
    out = []
    for (d, groups), found in zip(each, links, strict=True):
        spelled = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
        out.append((
            d, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(found.values()),
            sum(n for p, n in found.items() if count[p] == most[p[0]]), sum(n * count[p] for p, n in found.items()),
            hashlib.sha256(spelled.encode()).hexdigest() if groups else "",
        ))
    return sorted(out, key=str), count, most


def found(docs):
    return sorted((tuple(r) for r in alignment.aligned(docs, RANKS, PIECES).collect()), key=str)


@pytest.fixture(autouse=True)
def shipped(spark):
    ship(spark)


def test_documents_against_brute_force(spark):
    docs = documents(spark)
    assert found(docs) == by_brute_force([(r.doc_id, r.text) for r in docs.collect()])[0]


def test_odd_rows(spark):
    assert found(odd_documents(spark)) == by_brute_force([r[:2] for r in ODD])[0]
    assert found(no_documents(spark)) == []


def small(monkeypatch):
    """Small blocks and fans, so that merges have several levels."""
    for name, value in {"RECORDS": 40, "DOCUMENTS": 3, "FAN": 3, "SALT": 2}.items():
        monkeypatch.setattr(alignment, name, value)


TRICKY = [
    "a  b", " a", "a ", "a \n b", "x\n y", "x\n  y", "\t", "   ", "a b c", "a 　 b", "▁ a", "a▁b", "<s> </s> <unk>",
    "<|endoftext|> x", "<0x41> A", "it's we'll 's 're", "é😀 naïve Ünïcode ǅ ½ ́", "日本語のテキスト 中文 文本", "\x00 \x1c \x85 z",
    "1234567890 12,345.67", "....... ---- ====", "word " * 50, "a" * 3000, "ab " * 2 + "  " + "c d",
]


def test_tricky_texts_in_small_blocks(spark, monkeypatch):
    small(monkeypatch)
    rows = list(enumerate([*TRICKY, None, "", *TRICKY[:5], *[f"common word number {i % 7}" for i in range(60)]]))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(9)
    want, count, most = by_brute_force(rows)
    assert found(docs) == want
    table = alignment.pair_table(docs, RANKS, PIECES).collect()
    assert {(r.a, r.b): r.n_docs for r in table} == dict(count)
    assert all(r.best == (r.n_docs == most[r.a]) for r in table)


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\tab.'s1é▁"), st.characters(codec="utf-8")), max_size=25))
def test_any_text_is_cut_as_by_the_libraries(text):
    import pyarrow as pa

    both = alignment.tokenizers(RANKS, PIECES)
    for _, ((a, _), (b, _)) in alignment.encoded(pa.array([text]), both):
        assert a.tolist() == A.encode(" " + text, add_special_tokens=False).ids
        assert b.tolist() == B.encode(text)


def test_wide_groups_and_small_frames(monkeypatch):
    """Groups linked through their distinct ids, and runs of several frames, say the same."""
    import pyarrow as pa

    both = alignment.tokenizers(RANKS, PIECES)
    text = pa.array(["é😀 naïve 日本語のテキスト " * 3 + "aaaaaaaaaaaaaaaaaaaaaaaaaa" + "\U0001f469\u200d\U0001f680" * 9])
    (_, ((a, n_a), (b, n_b))), = alignment.encoded(text, both)
    plain = alignment.Linked(both, a, n_a, b, n_b)
    monkeypatch.setattr(alignment, "WIDE", 1)
    wide = alignment.Linked(both, a, n_a, b, n_b)
    assert plain.pairs.tolist() == wide.pairs.tolist() and plain.times.tolist() == wide.times.tolist()
    assert plain.times.sum() == plain.n_links[0] and plain.times.max() > 1
    monkeypatch.setattr(alignment, "FRAME", 2)
    block = alignment.Block(7, both.bits)
    block.add(pa.array([5]), np.zeros((4, 1), np.int64), [""], [(np.zeros(1, np.int64), plain)])
    rows = block.rows().to_pylist()
    assert rows[0]["radix"] == -1 and rows[0]["docs"][0]["doc_id"] == 5
    keys = [k for r in rows[1:] for f in r["pairs"] for k in alignment.open_pairs(f)[0].tolist()]
    times = [t for r in rows[1:] for f in r["records"] for t in alignment.unpacked(f, 2)[1].tolist()]
    assert sorted(zip(keys, times, strict=True)) == list(zip(plain.pairs.tolist(), plain.times.tolist(), strict=True))


def test_merge_and_maxima_against_counting():
    rng = np.random.default_rng(2)
    runs, total = [], Counter()
    for _ in range(17):
        keys = np.unique(rng.integers(0, 4000, rng.integers(1, 900)))
        counts = rng.integers(1, 9, len(keys))
        total.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
        runs.append([alignment.pair_frame(keys[i : i + 50], counts[i : i + 50]) for i in range(0, len(keys), 50)])
    parts = list(alignment.with_best(alignment.merge(runs), 6))
    keys, counts, best = (np.concatenate(c).tolist() for c in zip(*parts, strict=True))
    assert keys == sorted(total) and dict(zip(keys, counts, strict=True)) == dict(total)
    most = Counter()
    for k, n in total.items():
        most[k >> 6] = max(most[k >> 6], n)
    assert best == [int(total[k] == most[k >> 6]) for k in keys]
    assert list(alignment.merge([])) == []
