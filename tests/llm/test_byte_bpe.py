import base64
import hashlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.common import ODD_IDS, documents, ids_of, no_documents, odd_documents
from tilecast.llm import byte_bpe
from tilecast.llm.text import utf8

FILE = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(FILE, "rb"))}
WANTED = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
OWN = byte_bpe.rank_file(FILE)


def encode(texts):
    return [np.frombuffer(ids, OWN.kind).tolist() for ids in OWN.encode(*utf8(pa.array(texts, pa.string())))]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text() | st.text("'srtvelmd aZ1½ \n\t 　.!ñé日😀́", max_size=30), max_size=5))
def test_ids_are_tiktokens(texts):
    found = encode(texts)
    assert found == [WANTED.encode_ordinary(t) for t in texts]
    assert [OWN.decode(np.array(ids, np.int64)) for ids in found] == [t.encode() for t in texts]


def test_every_code_point_class():
    texts = ["".join(f"a{chr(c)}1" for c in range(lo, lo + 256) if not 0xD800 <= c < 0xE000) for lo in range(0, 0x30000, 256)]
    unlike = [k for k, (a, b) in enumerate(zip(encode(texts), map(WANTED.encode_ordinary, texts), strict=True)) if a != b]
    assert not unlike


def test_long_slices():
    texts = ["x" * 30_000, "ab" * 20_000, " " * 5000 + "end", "é" * 9999]
    assert encode(texts) == [WANTED.encode_ordinary(t) for t in texts]


def test_documents(spark):
    docs = documents(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in byte_bpe.bpe_digest(docs, FILE).collect():
        ids = WANTED.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows(spark):
    rows = byte_bpe.bpe_digest(odd_documents(spark), FILE).collect()
    assert ids_of(rows) == ODD_IDS
    assert all(r.n_tokens == 0 for r in rows if r.doc_id in (1, 2))
    assert byte_bpe.bpe_digest(no_documents(spark), FILE).count() == 0
