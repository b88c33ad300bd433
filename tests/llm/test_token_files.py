import ast
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.common import ODD, documents, no_documents, odd_documents
from tilecast.llm import token_files
from tilecast.llm.tokens import WordEncoder, word_encoder

FILE = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(FILE)


def ids_of_text(text):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, 1]


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300)))
def test_ranks_round_trip(ranks):
    control, data = token_files.encode_ranks(np.array(ranks, np.uint32))
    assert token_files.decode_ranks(control, data, len(ranks)).tolist() == ranks
    assert len(control) == -(-len(ranks) // 4)


@settings(max_examples=300, deadline=None)
@given(st.text() | st.text("aé' ́ ​\n\t\x0b\x1c<|endoftext|>½٣A.,!?%Z<|ENDOFTEXT|>\u0331H", max_size=40))
def test_words_give_the_ids_of_the_text(text):
    ids, counts = word_encoder(FILE).encode_with(pa.array([text, "", text]), 1)
    assert ids.tolist() == [*ids_of_text(text), 1, *ids_of_text(text)]
    assert counts.sum() == len(ids) and counts[1] == 1


def test_words_of_the_documents_give_the_ids_of_the_library(spark):
    """Every distinct word of a larger table, in its own and in odd spellings, in small runs and through a full cache."""
    words = sorted({w for r in documents(spark, "0.01").collect() for w in (r.text or "").split()})
    words = words[::3] + [w.upper() for w in words[::50]] + [w + "?!" for w in words[::50]] + [w + "'s" for w in words[::90]]
    encoder = WordEncoder(FILE)
    encoder.cache.most = 300_000
    plain = [f.ids for f in PLAIN.encode_batch_fast(words, add_special_tokens=False)]
    for lo in range(0, len(words), 2000):
        part, want = words[lo : lo + 2000], plain[lo : lo + 2000]
        ids, counts = encoder.encode(pa.array(part))
        assert ids.tolist() == [i for x in want for i in x] and counts.tolist() == [len(x) for x in want]


def check(docs, rows, **options):
    found = token_files.token_digest(docs, FILE, **options).collect()
    want = sorted(((d, ids_of_text(t)) for d, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    start, out = 0, []
    for d, ids in want:
        out.append((d, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    key = lambda r: r[1]
    assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in found), key=key) == out


def test_documents_come_back(spark, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_IDS", 5000)  # many blocks
    docs = documents(spark)
    check(docs, [(r.doc_id, r.text) for r in docs.collect()])


def test_odd_rows(spark):
    check(odd_documents(spark), [(d, t) for d, t, _, _ in ODD])
    assert token_files.token_digest(no_documents(spark), FILE).count() == 0


def test_ids_are_in_the_blocks(spark):
    docs = odd_documents(spark).filter("doc_id = 12")
    rows = token_files.read_blocks(token_files.write_blocks(token_files.encode_documents(docs, FILE))).collect()
    assert np.frombuffer(rows[0].ids, "<u4").tolist() == ids_of_text(next(t for d, t, _, _ in ODD if d == 12))


READER = """
import sys
import numpy as np
from tilecast.llm import token_files
from tilecast.session import local_session
spark = local_session("2", 2)
rows = token_files.read_blocks(spark.read.parquet(sys.argv[1])).orderBy("start").collect()
print([(r.doc_id, np.frombuffer(r.ids, "<u4").tolist()) for r in rows])
"""


def test_another_session_reads_the_files(spark, tmp_path):
    rows = [(3, "one two, three"), (1, None), (None, "four")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    token_files.write_blocks(token_files.encode_documents(docs, FILE)).write.parquet(f"{tmp_path}/blocks")
    root = Path(__file__).resolve().parents[2]
    done = subprocess.run([sys.executable, "-c", READER, f"{tmp_path}/blocks"], cwd=root, capture_output=True, text=True, timeout=300, check=True)
    assert ast.literal_eval(done.stdout.strip().splitlines()[-1]) == [(d, ids_of_text(t)) for d, t in (rows[2], rows[1], rows[0])]


def test_many_documents_of_one_id_are_spread(spark):
    docs = spark.range(4000).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("text "), (F.col("id") % 9).cast("string")).alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        table = token_files.write_blocks(token_files.encode_documents(docs, FILE))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert table.filter("shard >= 0").select("shard").distinct().count() > 1
    assert token_files.read_blocks(table).agg(F.count("*"), F.countDistinct("start")).first()[:] == (4000, 4000)
