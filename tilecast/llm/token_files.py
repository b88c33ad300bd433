"""Token ids as compact binary blocks.

Ids are renumbered by falling frequency, so that the commonest 256 take one byte. A block holds many
documents: a control stream with two bits per id (its byte length less one, four ids to a byte) and,
apart from it, a data stream with the little-endian bytes of the ranks. Decoding looks every control
byte up in a table of four lengths, and gathers the data bytes in one numpy pass.

Blocks are rows of a Parquet table, in order of (shard, block): Parquet is only the container, since
Spark commits it safely when tasks are lost or repeated and reads it from any store. The row of shard -1
holds the id of every rank, so the table alone is enough to read the documents back.

Null texts are empty and hold the end id alone, as do texts without a token; a very long text is a block
of its own. Documents lie in ascending doc_id, null first, those of one doc_id by a hash of their ids;
repeated rows are documents each. An empty table has no documents. Only doc_id and text are read, so no
other column can clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tilecast.llm.text import with_columns_after
from tilecast.llm.tokens import word_encoder
from tilecast.session import materialize

#: Ids in a block, about; a longer document is a block of its own.
BLOCK_IDS = 250_000
#: The four byte lengths that each control byte stands for.
LENGTHS = ((np.arange(256)[:, None] >> np.arange(0, 8, 2)) & 3).astype(np.uint8) + 1
#: The shard that is the table of ranks.
DICTIONARY = -1
BLOCKS = "shard int, block int, n_ids long, doc_ids binary, null_ids binary, counts binary, control binary, data binary"


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data streams of unsigned 32-bit ranks."""
    ranks = ranks.astype("<u4")
    more = (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    padded = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    padded[: len(ranks)] = more
    quads = padded.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    used = np.arange(4) <= more[:, None]
    return control.astype(np.uint8).tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    lengths = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    begins = np.cumsum(lengths, dtype=np.int64) - lengths
    padded = np.frombuffer(data + b"\0\0\0", np.uint8)
    out = np.zeros(n, np.uint32)
    for k in range(4):
        byte = padded[begins + k].astype(np.uint32) << np.uint32(8 * k)
        out |= np.where(lengths > k, byte, 0).astype(np.uint32)
    return out


def encode_documents(docs: DataFrame, file: str, end: int = 1) -> DataFrame:
    """doc_id, ids (binary, little-endian, two or four bytes by the vocabulary's size), width in bytes.

    Whole texts, nulls as empty, ``end`` appended to each.
    """
    def work(texts, given):
        encoder = word_encoder(file)
        ids, counts = encoder.encode_with(texts, end)
        width = encoder.kind.itemsize
        ends = np.concatenate([[0], np.cumsum(counts * width)]).astype(np.int64)
        whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(counts), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
        return {"ids": whole.cast(pa.binary()), "width": pa.array(np.full(len(counts), width, np.int32))}

    return with_columns_after(docs, work, "ids binary, width int", keep=["doc_id"]).select("row.doc_id", "ids", "width")


def rank_table(encoded: DataFrame) -> np.ndarray:
    """All ids by falling frequency over the whole table (ties: the smaller id first).

    Counted per task with numpy, then summed by Spark; what reaches the driver is one row per id of
    the vocabulary, a fixed number.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for ids, width in zip(batch.column("ids"), batch.column("width").to_pylist(), strict=True):
                part = np.bincount(np.frombuffer(ids.as_py(), f"<u{width}"))
                if len(part) > len(total):
                    total = np.concatenate([total, np.zeros(len(part) - len(total), np.int64)])
                total[: len(part)] += part
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen], pa.int64())], ["id", "n"])

    counts = encoded.select("ids", "width").mapInArrow(count, "id long, n long").groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    return counts.sort_values(["n", "id"], ascending=[False, True])["id"].to_numpy(np.int64)


def write_blocks(encoded: DataFrame, name: str = "token-blocks") -> DataFrame:
    """Write all documents as blocks, and the id of each rank; the table read back.

    One shuffle, by ranges of doc_id, and of a hash and the row's place where many rows share one.
    Shards follow the ranges' order.
    """
    by_rank = rank_table(encoded)
    ranks = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    ranks[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, shard, block = shared.value, TaskContext.get().partitionId(), 0
        docs: list[int] = []
        nulls: list[int] = []
        parts: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            control, data = encode_ranks(ranks[np.concatenate(parts)])
            row = [shard, block, held, np.array(docs, "<i8").tobytes(), np.array(nulls, np.uint8).tobytes(),
                   np.array([len(p) for p in parts], "<u4").tobytes(), control, data]
            kinds = [pa.int32(), pa.int32(), pa.int64(), *[pa.binary()] * 5]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(row, kinds, strict=True)], names)

        names = ["shard", "block", "n_ids", "doc_ids", "null_ids", "counts", "control", "data"]
        for batch in batches:
            for doc, ids, width in zip(batch.column("doc_id").to_pylist(), batch.column("ids"), batch.column("width").to_pylist(), strict=True):
                part = np.frombuffer(ids.as_py(), f"<u{width}")
                if parts and held + len(part) > BLOCK_IDS:
                    yield flush()
                    docs, nulls, parts, held, block = [], [], [], 0, block + 1
                docs.append(doc or 0)
                nulls.append(doc is None)
                parts.append(part)
                held += len(part)
        if parts:
            yield flush()

    order = ["doc_id", "hash", "at"]
    placed = encoded.withColumns({"hash": F.xxhash64("ids"), "at": F.monotonically_increasing_id()})
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    nothing = bytearray()
    row = [(DICTIONARY, 0, 0, *[nothing] * 4, bytearray(by_rank.astype("<u4").tobytes()))]
    dictionary = encoded.sparkSession.createDataFrame(row, BLOCKS)
    return materialize(ordered.mapInArrow(pack, BLOCKS).unionByName(dictionary), name)


def read_blocks(table: DataFrame, with_ids: bool = True) -> DataFrame:
    """Every document, read from the table that ``write_blocks`` wrote alone.

    doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if wanted, ids (binary,
    unsigned 32-bit).
    """
    blocks = table.filter(F.col("shard") != DICTIONARY)
    held = table.filter(F.col("shard") == DICTIONARY).select("data").first()  # one id per rank
    shared = table.sparkSession.sparkContext.broadcast(np.frombuffer(held["data"], "<u4"))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = np.frombuffer(row["counts"], "<u4").astype(np.int64)
                ids = shared.value[decode_ranks(row["control"], row["data"], int(counts.sum()))].astype("<u4")
                ends = np.cumsum(counts)
                raw = [ids[e - c : e].tobytes() for e, c in zip(ends, counts, strict=True)]
                doc = pa.array(np.frombuffer(row["doc_ids"], "<i8"), pa.int64(), mask=np.frombuffer(row["null_ids"], np.uint8) > 0)
                n = len(raw)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["shard"]] * n, pa.int32()), pa.array([row["block"]] * n, pa.int32()), doc,
                     pa.array(ends - counts, pa.int64()), pa.array(raw if with_ids else [None] * n, pa.binary()), pa.array(counts, pa.int64()),
                     pa.array([zlib.crc32(r) for r in raw], pa.int64())],
                    ["shard", "block", "doc_id", "inside", "ids", "n_tokens", "ids_crc32"])

    found = blocks.mapInArrow(unpack, "shard int, block int, doc_id long, inside long, ids binary, n_tokens long, ids_crc32 long")
    # ids before a block: those of earlier shards (one row a shard), and of earlier blocks of its own
    sizes = blocks.select("shard", "block", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = shards.select("shard", (F.sum("n").over(Window.orderBy("shard")) - F.col("n")).alias("shard_start"))
    inside = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begins = sizes.select("shard", "block", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("earlier")).join(before, "shard")
    starts = begins.select("shard", "block", (F.col("shard_start") + F.col("earlier")).alias("block_start"))
    return found.join(starts, ["shard", "block"]).select(
        "doc_id", (F.col("block_start") + F.col("inside")).alias("start"), "ids", "n_tokens", "ids_crc32"
    )


def token_digest(docs: DataFrame, file: str) -> DataFrame:
    """What op6 returns: encode, write the blocks, read them back."""
    encoded = materialize(encode_documents(docs, file), "token-ids")
    return read_blocks(write_blocks(encoded), with_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")
