"""Scoring whole texts with a gated recurrent language model learned from the corpus.

Counts of all words over all training documents give the base score, choose the commonest words as
the model's symbols, and give every other word its probability inside its group (by its last
letters). The recurrent model predicts symbols: a word's probability is that of its class, times its
own inside the class. Training runs where the data is: each task trains by truncated
backpropagation on its share of the round's training documents, and the weights are averaged. The
rounds together take every training document once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.llm import recurrent
from tilecast.llm.text import fold
from tilecast.llm.words import packed, unpacked
from tilecast.session import delete_tables, materialize, recorded


def _signed(word: bytes) -> int:
    """A word's 64-bit hash, which stands for it in all counts."""
    h = xxhash.xxh64_intdigest(word)
    return h - (1 << 64) if h >= 1 << 63 else h


#: Words with a symbol of their own, output classes of them, and groups of the other words.
HEADS, HEAD_CLASSES, GROUPS, HIDDEN = 1500, 24, 32, 24
#: Each round of training takes one in so many training documents, others every round: all are taken.
SHARE = ROUNDS = 2
#: Distinct words in a block of documents: their numbers then take two bytes.
BLOCK_WORDS = 65_000
#: Tokens in a block of documents, so that copies, which bring no new words, don't fill one without end.
BLOCK_TOKENS = 4_000_000
#: The word that ends every text; no word is empty.
END = b""
END_HASH = _signed(END)
#: Runs of words summed at once, and runs that meet the sums of their radix in one task, about.
FAN = SALT = 128
#: Text bytes for each radix that words are dealt to by their hash, and the most bits of a radix.
RADIX_BYTES, MOST_BITS = 64_000_000, 12
#: What a row of a block is, unless it is the run of a radix.
DOCUMENT = -1
TOKENS = "block long, radix int, doc_id long, held_out boolean, width int, tokens binary, words binary"


def to_blocks(docs: DataFrame, held_out, bits: int = 4) -> DataFrame:
    """Whole texts as numbers of words, in blocks of documents with a dictionary each.

    Rows of radix DOCUMENT have ``tokens`` (unsigned, of ``width`` bytes). Rows of the other radixes, the
    upper ``bits`` of a hash, have its ``words`` in the order of their numbers, which is that of their
    hashes: hashes, groups, and counts in training documents. A block closes before its dictionary outgrows two-byte numbers or its tokens
    outgrow BLOCK_TOKENS; a document with more than that is a block of its own.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), held_out.alias("held_out"))
    names = [c.split()[0] for c in TOKENS.split(", ")]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, number, held, size = TaskContext.get().partitionId() << 32, {END: 0}, [], 0

        def flush() -> pa.RecordBatch:
            width = 2 if len(number) <= 1 << 16 else 4
            learned = [ids for _, out, ids in held if not out]
            counts = np.bincount(np.concatenate(learned), minlength=len(number)) if learned else np.zeros(len(number), np.int64)
            hashes = np.fromiter(map(xxhash.xxh64_intdigest, number), np.uint64, len(number))
            kins = np.fromiter((zlib.crc32(w[-2:]) % GROUPS for w in number), np.int64, len(number))
            order = np.argsort(hashes)
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            radix = (hashes[order] >> np.uint64(64 - bits)).astype(np.int64)
            rows = [(block, DOCUMENT, d, o, width, rank[ids].astype(f"<u{width}").tobytes(), None) for d, o, ids in held]
            for r in np.unique(radix).tolist():
                own = order[slice(*np.searchsorted(radix, [r, r + 1]))]
                rows.append((block, r, None, None, None, None, closed(hashes[own], kins[own], counts[own])))
            columns = list(zip(*rows, strict=True))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

        for batch in pieces(batches):
            while batch.num_rows:
                words, codes, ends = split_words(batch.column("text"))
                at = np.fromiter(map(number.get, words, repeat(-1)), np.int32, len(words))
                new = np.cumsum(at < 0)
                # codes go by first places, so the highest so far counts the distinct words so far
                grown = np.append(0, new)[np.maximum.accumulate(np.append(0, codes + 1))[ends]]
                tokens = ends + np.arange(1, len(ends) + 1)
                over = (size + tokens > BLOCK_TOKENS) | (len(number) + grown > BLOCK_WORDS)
                fit = int(over.argmax()) if over.any() else len(ends)
                if not fit and not held:
                    fit = 1
                if fit:
                    n_new = int(grown[fit - 1])
                    at[at < 0] = len(number) + np.arange(int(new[-1]) if len(new) else 0)
                    fresh = [words[k] for k in np.flatnonzero(np.diff(new, prepend=0)).tolist()[:n_new]]
                    number.update(zip(fresh, range(len(number), len(number) + n_new), strict=True))
                    ids = np.insert(at[codes[: ends[fit - 1]]], ends[:fit], number[END])
                    docs, outs = (batch.column(c)[:fit].to_pylist() for c in ("doc_id", "held_out"))
                    held.extend(zip(docs, outs, np.split(ids, tokens[: fit - 1]), strict=True))
                    size += len(ids)
                if fit < len(ends):
                    yield flush()
                    block, number, held, size = block + 1, {END: 0}, [], 0
                batch = batch.slice(fit)
        if held:
            yield flush()

    return rows.mapInArrow(run, TOKENS)


def pieces(batches: Iterator[pa.RecordBatch], most: int = 500_000) -> Iterator[pa.RecordBatch]:
    """Rows of each batch with up to about ``most`` bytes of text together, so that what is split anew where a block ends stays small."""
    for batch in batches:
        part = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(), dtype=np.int64) // most
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            yield batch.slice(lo, hi - lo)


def split_words(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct words of all texts, in the order of their first places; the place of each word among
    them; and where each text's words end."""
    split = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    coded = pc.dictionary_encode(split.flatten())
    words = coded.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
    codes, ends = coded.indices.to_numpy(), np.cumsum(pc.list_value_length(split).to_numpy())
    if b"" in words:  # before and behind white space
        none = words.index(b"")
        there = codes != none
        ends = np.append(0, np.cumsum(there))[ends]
        codes = codes[there]
        codes = codes - (codes > none)
        del words[none]
    return words, codes, ends


def closed(hashes: np.ndarray, kins: np.ndarray, counts: np.ndarray) -> bytes:
    """Words in ascending order, their hashes as differences."""
    return packed(np.diff(hashes, prepend=np.uint64(0)), kins, counts)


def opened(words: bytes) -> list[np.ndarray]:
    """Hashes, groups and counts."""
    hashes, kins, counts = unpacked(words, 3)
    return [np.cumsum(hashes.view(np.uint64)), kins, counts]


def summed(runs: list[bytes]) -> list[np.ndarray]:
    """The distinct words of all runs, ascending: hashes, groups, and counts added up."""
    hashes, kins, counts = (np.concatenate(c) for c in zip(*(opened(r) for r in runs), strict=True))
    order = np.argsort(hashes, kind="stable")
    hashes, kins, counts = hashes[order], kins[order], counts[order]
    first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
    return [hashes[first], kins[first], np.add.reduceat(counts, first)]


def word_counts(blocks: DataFrame, n_blocks: int) -> DataFrame:
    """radix, words: the whole corpus's words of each radix. FAN runs are summed at a time."""
    def add(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        whole = closed(*summed(table["words"].to_pylist()))
        return pa.table([[key[0].as_py()], [key[1].as_py()], [whole]], schema=pa.schema([("radix", pa.int32()), ("run", pa.int64()), ("words", pa.binary())]))

    level = blocks.filter("radix >= 0").select("radix", F.col("block").alias("run"), "words")
    while n_blocks > 1:
        n_blocks = -(-n_blocks // FAN)
        level = level.withColumn("run", F.pmod(F.xxhash64("run"), F.lit(n_blocks)))
        level = materialize(level.groupBy("radix", "run").applyInArrow(add, "radix int, run bigint, words binary"), "words")
    return level.select("radix", "words")


def frequencies(counts: DataFrame) -> tuple[list[tuple[int, int]], np.ndarray, np.ndarray, int, int]:
    """Head words with their counts, commonest first; tokens and distinct words of each group without
    them; all tokens and distinct words. Each radix sends its commonest words and a row per group."""
    def common(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for words in batch.column("words").to_pylist():
                hashes, kins, n = opened(words)
                hashes = hashes.view(np.int64)
                best = np.lexsort((hashes, -n))[:HEADS]
                best = np.union1d(best[n[best] > 0], np.flatnonzero(hashes == END_HASH))
                of = np.bincount(kins, n, GROUPS).astype(np.int64), np.bincount(kins, n > 0, GROUPS).astype(np.int64)
                columns = [
                    [*hashes[best].tolist(), *[None] * GROUPS], [*kins[best].tolist(), *range(GROUPS)],
                    [*n[best].tolist(), *of[0].tolist()], [*[None] * len(best), *of[1].tolist()],
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["word", "kin", "n", "v"])

    found = materialize(counts.mapInArrow(common, "word bigint, kin bigint, n bigint, v bigint"), "frequencies")
    words = found.filter("word is not null")
    top = words.filter(F.col("word") != END_HASH).orderBy(F.desc("n"), "word").limit(HEADS - 1)
    chosen = [(r.word, r.kin, r.n) for r in top.unionByName(words.filter(F.col("word") == END_HASH)).collect()]
    groups = found.filter("word is null").groupBy("kin").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect()
    tokens, distinct = np.zeros(GROUPS, np.int64), np.zeros(GROUPS, np.int64)
    for r in groups:
        tokens[r.kin], distinct[r.kin] = r.n, r.v
    total, known = int(tokens.sum()), int(distinct.sum())
    for _, kin, n in chosen:
        tokens[kin] -= n
        distinct[kin] -= n > 0
    heads = sorted(((w, n) for w, _, n in chosen), key=lambda r: (-r[1], r[0])) or [(END_HASH, 0)]
    return heads, tokens, distinct, total, known


def to_streams(docs: DataFrame, held_out) -> tuple[DataFrame, recurrent.Layout, np.ndarray, int]:
    """Every document as symbols, with what does not depend on the recurrent model.

    doc_id, held_out, n_tokens, n_known, base_score, group_score (log10 of the words inside their
    groups), stream (two-byte symbols). Also the layout, the symbols' counts and the number of
    training tokens. Words cross the shuffles packed, a row per block and radix: to be counted there, to
    meet the counts of all blocks again, and back to their block as counts alone.
    """
    size = docs.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    bits = min(MOST_BITS, max(4, int(size // RADIX_BYTES).bit_length()))
    with recorded() as written:
        blocks = materialize(to_blocks(docs, held_out, bits), "word-blocks")
        n_blocks = blocks.filter("radix >= 0").select("block").distinct().count()
        counts = word_counts(blocks, n_blocks + 1)
        heads, tokens, distinct, total, known = frequencies(counts)
        streams, layout, symbols = _streams(blocks, counts, n_blocks, heads, tokens, distinct, total, known)
        streams = materialize(streams, "streams")
        last = written.pop()
        delete_tables(docs.sparkSession, written)
        written.append(last)
    return streams, layout, symbols, total


def _streams(blocks, counts, n_blocks, heads, tokens, distinct, total, known) -> tuple[DataFrame, recurrent.Layout, np.ndarray]:
    symbols = np.concatenate([[n for _, n in heads], tokens]).astype(np.float64)
    inside = symbols + np.concatenate([np.zeros(len(heads)), distinct]) + 1
    mass = np.cumsum(np.sqrt(symbols[: len(heads)] + 1))
    cuts = np.searchsorted(mass, np.linspace(0, mass[-1], HEAD_CLASSES + 1)[1:-1])
    layout = recurrent.Layout(sorted({0, *(int(c) for c in cuts), len(heads)}), GROUPS)
    head_words = np.array([w for w, _ in heads], np.int64)
    place = np.argsort(head_words)

    salts = max(1, -(-n_blocks // SALT))
    salt = F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt")
    own = blocks.filter("radix >= 0").select("block", "radix", salt, "words")
    spread = counts.select("radix", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "words")

    def answer(key: tuple[pa.Scalar, ...], mine: pa.Table, all_: pa.Table) -> pa.Table:
        found = []
        if mine.num_rows:
            hashes, kins, n = opened(all_["words"][0].as_py())
            spot = np.minimum(np.searchsorted(head_words[place], hashes.view(np.int64)), len(place) - 1)
            head = head_words[place][spot] == hashes.view(np.int64)
            symbol = np.where(head, place[spot], len(heads) + kins)
            for words in mine["words"].to_pylist():
                at = np.searchsorted(hashes, opened(words)[0])
                found.append(packed(n[at], symbol[at]))
        return pa.table([mine["block"].combine_chunks(), mine["radix"].combine_chunks(), pa.array(found, pa.binary())], names=["block", "radix", "known"])

    answers = own.groupBy("radix", "salt").cogroup(spread.groupBy("radix", "salt")).applyInArrow(answer, "block long, radix int, known binary")

    def build(key: tuple[pa.Scalar, ...], left: pa.Table, right: pa.Table) -> pa.Table:
        in_order = right.sort_by("radix")["known"].to_pylist()  # ascending radixes are ascending numbers
        c, symbol = (np.concatenate(x) for x in zip(*(unpacked(k, 2) for k in in_order), strict=True))
        base = np.log10((c + 1) / (total + known + 1))
        rare = np.where(symbol < len(heads), 0.0, np.log10((c + 1) / inside[symbol]))
        out = []
        for doc, held, width, numbers in zip(*(left[k].to_pylist() for k in ("doc_id", "held_out", "width", "tokens")), strict=True):
            ids = np.frombuffer(numbers, f"<u{width}").astype(np.int64)
            out.append((doc, held, len(ids), int((c[ids] > 0).sum()), float(base[ids].sum()), float(rare[ids].sum()), symbol[ids].astype("<u2").tobytes()))
        kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary()]
        return pa.table({n: pa.array([r[k] for r in out], kind) for k, (n, kind) in enumerate(zip(names, kinds, strict=True))})

    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, group_score double, stream binary"
    names = [c.split()[0] for c in schema.split(", ")]
    texts = blocks.filter(F.col("radix") == DOCUMENT).select("block", "doc_id", "held_out", "width", "tokens")
    return texts.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(build, schema), layout, symbols


def gathered(batches: Iterator[pa.RecordBatch], most: int = 8_000_000) -> Iterator[pa.Table]:
    """Batches together, up to about ``most`` bytes of streams: many texts side by side take fewer steps."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.column("stream").nbytes
        if size >= most:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


def turn_rows(streams: DataFrame, turn: int, share: int) -> DataFrame:
    """The training documents of round ``turn``: one in ``share``, each in one of ``share`` rounds."""
    spot = F.pmod(F.xxhash64("doc_id", "base_score"), F.lit(share))
    return streams.filter((~F.col("held_out")) & (spot == turn % share))


def train_round(streams: DataFrame, layout: recurrent.Layout, weights: dict[str, np.ndarray], turn: int, share: int) -> dict[str, np.ndarray]:
    """The mean of the weights that the tasks reach from ``weights``, each by its tokens.

    The model has a fixed size. Spark averages its parts, so no task or driver sees the weights of all tasks.
    """
    sample = turn_rows(streams, turn, share).select("stream")
    shared = streams.sparkSession.sparkContext.broadcast((weights, layout))
    names = list(weights)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, layout = shared.value
        p, seen = weights, 0
        for table in gathered(batches):
            texts = [np.frombuffer(s.as_py(), "<u2") for s in table.column("stream")]
            if texts:
                p, n = recurrent.train(p, layout, texts)
                seen += n
        if seen:
            flat = np.concatenate([p[k].reshape(-1) for k in names])
            for lo in range(0, len(flat), 4096):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lo], pa.int64()), pa.array([flat[lo : lo + 4096]], pa.list_(pa.float32())), pa.array([seen], pa.int64())],
                    ["lo", "part", "seen"])

    parts = sample.mapInArrow(fit, "lo long, part array<float>, seen long")
    each = parts.select("lo", "seen", F.posexplode("part").alias("k", "v"))
    mean = each.groupBy((F.col("lo") + F.col("k")).alias("at")).agg((F.sum(F.col("v").cast("double") * F.col("seen")) / F.sum("seen")).alias("v"))
    got = mean.toPandas().sort_values("at")
    if not len(got):
        return weights
    flat, out, lo = got["v"].to_numpy(np.float32), {}, 0
    for k in names:
        out[k] = flat[lo : lo + weights[k].size].reshape(weights[k].shape)
        lo += weights[k].size
    return out


def score_texts(docs: DataFrame, held_out=None, share: int = SHARE, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row of ``docs``.

    Repeated rows are scored each; an empty table gives no rows; without a training document all words
    are unseen and the model is as it began. Only doc_id and text are read, so no other column can clash.

    ``held_out`` is the column of documents not to learn from. Null texts are empty: one token, the
    end. Scores are log10 probabilities of whole texts, however long. Words never seen in training
    share one unseen word of their group, as they share one in the base score.
    """
    held_out = F.lit(False) if held_out is None else held_out
    streams, layout, counts, total = to_streams(docs, held_out)
    weights = recurrent.initial(layout, counts, HIDDEN)
    for turn in range(rounds):
        weights = train_round(streams, layout, weights, turn, share)
    shared = docs.sparkSession.sparkContext.broadcast((weights, layout))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, layout = shared.value
        for table in gathered(batches):
            texts = [np.frombuffer(s.as_py(), "<u2") for s in table.column("stream")]
            logs = recurrent.score(weights, layout, texts) / np.log(10)
            whole = pc.add(table.column("group_score"), pa.chunked_array([pa.array(logs, pa.float64())]))
            yield from table.select(kept).append_column("score", whole).combine_chunks().to_batches()

    kept = ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]
    out = streams.select(*kept, "group_score", "stream").mapInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"
    )
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(total).cast("bigint").alias("train_tokens"), "base_score", "score")


def score_digest(docs: DataFrame) -> DataFrame:
    """What op9 returns: learned from documents whose crc32 modulo 7 is not 2."""
    return score_texts(docs, fold("doc_id", 7) == 2)
