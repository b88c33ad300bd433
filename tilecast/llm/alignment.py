"""Cross-tokenizer alignment, with the corpus-wide counts of linked id pairs by external spill counting.

A text is cut by both tokenizers. Byte offsets where a token of either ends cut both sequences into
groups, and each token of A is linked with each token of B in its group. How many documents hold an id
pair linked is counted over the whole corpus, in four steps:

1. Documents are gathered into blocks. A block's records, (pair, document, times), are sorted by pair,
   dealt to radixes by the id of side A, and written as a run each: zstd frames of ascending pairs with
   their number of documents, and beside them frames of the documents. A pair that is in every document
   is one entry of a run, so no id is hot.
2. Runs of a radix are merged by their pairs, ``FAN`` at a time, until one run is left. The merge holds
   one open frame of every run; a heap of the frames' last pairs tells how far all of them are complete.
3. Pairs come out side-major, so all partners of an id of A follow one another, and the largest count
   among them is known when the next id begins.
4. Blocks' runs meet the counts of their radix, about ``SALT`` runs in a task, and each one streams back
   what it adds to its documents; these sums are added up per block.

A merged run holds at most the pairs of ids that a radix can have, whatever the corpus; a block is
bounded by ``RECORDS`` and ``DOCUMENTS``. Texts null, empty, or whose tokens' bytes are not the text's
have no tokens. Rows that repeat a document are documents of their own. Very long texts are cut whole; a
group of very many tokens is linked through its distinct ids. Only doc_id and text are read, so no other
column can clash. An empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.llm.text import claim, runs, utf8, whole_text
from tilecast.llm.words import WordIds, distinct, packed, ranges, sums, unpacked
from tilecast.session import materialize

#: A block closes at so many records or documents; its records are dealt to 2^RADIX_BITS radixes.
RECORDS, DOCUMENTS, SLOT_BITS, RADIX_BITS = 1 << 21, 1 << 14, 15, 6
#: Pairs in a frame; runs merged at once; runs that meet the counts of their radix in one task, about.
FRAME, FAN, SALT = 1 << 14, 128, 128
#: A group with more links than this is linked through its distinct ids.
WIDE = 4096
#: Where the byte-level tokenizer cuts before it merges: a fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

DOC = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string"
SPILL = f"block bigint, radix int, pairs array<binary>, records array<binary>, docs array<struct<{DOC.replace(' ', ':').replace(',:', ',')}>>"


class Spelling:
    """The bytes of every number: of token ids, or of decimals."""

    def __init__(self, spelled: list[bytes]):
        self.sizes = np.array([len(s) for s in spelled], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.flat = np.frombuffer(b"".join(spelled), np.uint8)

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return self.flat[ranges(self.starts[ids], self.sizes[ids])]


class Tokenizers:
    """Both tokenizers with their caches of words, and the bytes of their ids."""

    def __init__(self, ranks_file: str, pieces_file: str):
        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        b = sentencepiece.SentencePieceProcessor(model_file=pieces_file)
        of_a = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            of_a[rank] = token
        n = b.get_piece_size()
        of_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(b.id_to_piece(list(range(n))))]
        self.encoders = (
            lambda texts: flattened([a.encode_ordinary(" " + t) for t in texts]),
            lambda texts: flattened(b.encode(texts, num_threads=1)),
        )
        self.spellings = (Spelling(of_a), Spelling(of_b))
        self.bits = tuple((len(s.sizes) - 1).bit_length() for s in self.spellings)
        self.decimals = Spelling([b"%d," % i for i in range(max(len(of_a), len(of_b)))])
        self.caches = tuple(WordIds(e) for e in self.encoders)

    def by_words(self, words: list[str], at: np.ndarray, counts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Each side's ids, and their number per text, of texts that are words with single spaces between them."""
        out = []
        for cache in self.caches:
            ids, sizes = cache.gather(cache.numbers(words)[at])
            out.append((ids.astype(np.int64), sums(sizes, counts)))
        return out

    def whole(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """The same for any texts, encoded as they are."""
        return [encode(texts) for encode in self.encoders]


def flattened(lists: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    sizes = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter(chain.from_iterable(lists), np.int64, int(sizes.sum())), sizes


@lru_cache(2)
def tokenizers(ranks_file: str, pieces_file: str) -> Tokenizers:
    return Tokenizers(ranks_file, pieces_file)


def clean(word: str) -> bool:
    """Whether a word between single spaces is cut as it is alone: both sides cut before a space that
    stands between two other characters."""
    return bool(word) and not word[0].isspace() and not word[-1].isspace()


def encoded(texts: pa.Array, both: Tokenizers) -> Iterator[tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """Rows of ``texts``, all but the empty ones in one or two goes, and each side's ids of them."""
    words, at, counts = distinct(pc.split_pattern(texts, " "))
    fine = np.fromiter(map(clean, words), bool, len(words))
    plain = sums(~fine[at], counts) == 0
    if plain.any():
        used = np.flatnonzero(fine)  # a word is looked up once for the whole run
        place = np.cumsum(fine) - 1
        mine = np.repeat(plain, counts)
        yield np.flatnonzero(plain), both.by_words([words[i] for i in used.tolist()], place[at[mine]], counts[plain])
    rest = np.flatnonzero(~plain & (pc.binary_length(texts).to_numpy(zero_copy_only=False) > 0))
    if len(rest):
        yield rest, both.whole(texts.take(pa.array(rest)).to_pylist())


def pick(ids: np.ndarray, counts: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return ids[np.repeat(keep, counts)], counts[keep]


def spelled_right(texts: pa.Array, spelling: Spelling, ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Whether each text's tokens spell a space and the text."""
    data, at = utf8(texts)
    sizes = np.diff(at) + 1
    right = sums(spelling.sizes[ids], counts) == sizes
    want = np.full(sizes.sum(), ord(" "), np.uint8)
    inside = np.ones(len(want), bool)
    inside[np.cumsum(sizes) - sizes] = False
    want[inside] = data
    want = want[np.repeat(right, sizes)]
    wrong = spelling.spell(pick(ids, counts, right)[0]) != want
    right[np.flatnonzero(right)[sums(wrong, sizes[right]) > 0]] = False
    return right


class Linked:
    """Texts as cut by both sides: per text n_a, n_b, n_groups, n_links, the hash of its groups, and its pairs.

    ``pairs`` are (id of A << bits of B | id of B), with the text they are in and how many times.
    """

    def __init__(self, both: Tokenizers, a: np.ndarray, n_a: np.ndarray, b: np.ndarray, n_b: np.ndarray):
        self.n_a, self.n_b = n_a, n_b
        ends_a, ends_b = (np.cumsum(s.sizes[x]) for s, x in zip(both.spellings, (a, b), strict=True))
        mark = np.zeros((2, (ends_a[-1] if len(ends_a) else 0) + 1), bool)
        mark[0, ends_a] = mark[1, ends_b] = True
        cut_a, cut_b = mark[1, ends_a], mark[0, ends_b]  # tokens that end a group
        group_a, group_b = np.cumsum(cut_a) - cut_a, np.cumsum(cut_b) - cut_b
        n = int(cut_a.sum())
        size_a, size_b = np.bincount(group_a, minlength=n), np.bincount(group_b, minlength=n)
        text_a = np.repeat(np.arange(len(n_a)), n_a)
        self.n_groups = np.bincount(text_a[cut_a], minlength=len(n_a))
        self.n_links = sums(size_a * size_b, self.n_groups)

        start_b, end_a = np.cumsum(size_b) - size_b, np.cumsum(size_a)
        spot_a, spot_b = np.arange(len(a)) + start_b[group_a], np.arange(len(b)) + end_a[group_b]
        numbers, signs = np.zeros(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        numbers[spot_a], numbers[spot_b] = a, b
        signs[spot_a[cut_a]], signs[spot_b[cut_b]] = ord("|"), ord(";")
        text = both.decimals.spell(numbers)
        sizes = both.decimals.sizes[numbers]
        text[np.cumsum(sizes) - 1] = signs
        ends = np.cumsum(sums(sizes, n_a + n_b))
        whole = memoryview(text)
        self.sha256 = [hashlib.sha256(whole[lo : hi - 1]).hexdigest() for lo, hi in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=True)]

        wide = size_a * size_b > WIDE
        reps = np.where(wide, 0, size_b)[group_a]
        of_a = np.repeat(np.arange(len(a)), reps)
        of_b = ranges(start_b[group_a], reps)
        bits_b = both.bits[1]
        width = sum(both.bits)
        keys = [(text_a[of_a] << width) | (a[of_a] << bits_b) | b[of_b]]
        times = [np.ones(len(of_a), np.int64)]
        for g in np.flatnonzero(wide).tolist():
            ids_a, in_a = np.unique(a[end_a[g] - size_a[g] : end_a[g]], return_counts=True)
            ids_b, in_b = np.unique(b[start_b[g] : start_b[g] + size_b[g]], return_counts=True)
            of_text = text_a[end_a[g] - 1] << width
            keys.append((of_text | (ids_a[:, None] << bits_b) | ids_b).ravel())
            times.append(np.outer(in_a, in_b).ravel())
        if len(keys) > 1:
            key, many = np.concatenate(keys), np.concatenate(times)
            order = np.argsort(key, kind="stable")
            key, many = key[order], many[order]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            self.times = np.add.reduceat(many, first)
        else:
            key = np.sort(keys[0])
            first = np.flatnonzero(np.diff(key, prepend=-1))
            self.times = np.diff(first, append=len(key))
        self.texts, self.pairs = key[first] >> width, key[first] & ((1 << width) - 1)


def pair_frame(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Ascending pairs as their differences, and what belongs to each."""
    return packed(np.diff(keys, prepend=0), *columns)


def open_pairs(frame: bytes, columns: int = 1) -> list[np.ndarray]:
    keys, *rest = unpacked(frame, 1 + columns)
    return [np.cumsum(keys), *rest]


class Block:
    """Documents and records of one block, until it is written."""

    def __init__(self, number: int, bits: tuple[int, int]):
        self.number, self.bits = number, bits
        self.ids: list[pa.Array] = []
        self.counts: list[np.ndarray] = []
        self.hashes: list[str] = []
        self.records: list[tuple[np.ndarray, ...]] = []
        self.documents = self.held = 0

    def add(self, ids: pa.Array, counts: np.ndarray, hashes: list[str], linked: Iterable[tuple[np.ndarray, Linked]]) -> None:
        for rows, found in linked:
            self.records.append((found.pairs, rows[found.texts] + self.documents, found.times))
            self.held += len(found.pairs)
        self.ids.append(ids)
        self.counts.append(counts)
        self.hashes += hashes
        self.documents += len(ids)

    def rows(self) -> pa.RecordBatch:
        """The block's documents, as radix -1, and a run for every radix that it has records of."""
        names = [c.split()[0] for c in DOC.split(", ")]
        counts = np.concatenate(self.counts, 1)
        docs = pa.StructArray.from_arrays([pa.concat_arrays(self.ids), *map(pa.array, counts), pa.array(self.hashes, pa.string())], names)
        pairs, slots, times = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (list(zip(*self.records, strict=True)) or [(), (), ()]))
        width, bits_b = sum(self.bits), self.bits[1]
        radix = (pairs >> bits_b) & ((1 << RADIX_BITS) - 1)
        key = (((radix << width) | pairs) << SLOT_BITS) | slots
        often = np.flatnonzero(times > 1)
        often, many = key[often], times[often]
        key.sort()
        times = np.ones(len(key), np.int64)
        times[np.searchsorted(key, often)] = many
        slots, pairs = key & ((1 << SLOT_BITS) - 1), key >> SLOT_BITS
        first = np.flatnonzero(np.diff(pairs, prepend=-1))
        pairs, found = pairs[first], np.diff(first, append=len(pairs))
        radix = pairs >> width
        pairs &= (1 << width) - 1
        of = {"block": [self.number], "radix": [-1], "pairs": [[]], "records": [[]]}
        for r in np.unique(radix).tolist():
            lo, hi = np.searchsorted(radix, [r, r + 1]).tolist()
            cuts = [*range(lo, hi, FRAME), hi]
            of["block"].append(self.number)
            of["radix"].append(r)
            of["pairs"].append([pair_frame(pairs[x:y], found[x:y]) for x, y in zip(cuts, cuts[1:])])
            ends = np.append(first, len(key))
            of["records"].append([packed(slots[ends[x] : ends[y]], times[ends[x] : ends[y]]) for x, y in zip(cuts, cuts[1:])])
        frames = pa.list_(pa.binary())
        lists = pa.ListArray.from_arrays(pa.array([0] + [len(docs)] * len(of["block"]), pa.int32()), docs)
        columns = [pa.array(of["block"], pa.int64()), pa.array(of["radix"], pa.int32()), pa.array(of["pairs"], frames), pa.array(of["records"], frames), lists]
        return pa.RecordBatch.from_arrays(columns, ["block", "radix", "pairs", "records", "docs"])


def spill(docs: DataFrame, ranks_file: str, pieces_file: str) -> DataFrame:
    """Blocks' documents and runs, written: block, radix (-1: documents), pairs, records, docs."""
    most_records, most_documents = RECORDS, DOCUMENTS

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        claim("alignment", tokenizers.cache_clear)
        both = tokenizers(ranks_file, pieces_file)
        number = TaskContext.get().partitionId() << 32
        block = Block(number, both.bits)
        for batch in batches:
            text = batch.column("text")
            for lo, hi in runs(text):
                some = text.slice(lo, hi - lo)
                counts, hashes, linked = np.zeros((4, len(some)), np.int64), [""] * len(some), []
                for rows, ((a, n_a), (b, n_b)) in encoded(some, both):
                    cut = some.take(pa.array(rows))
                    right = spelled_right(cut, both.spellings[0], a, n_a) & spelled_right(cut, both.spellings[1], b, n_b)
                    rows = rows[right]
                    found = Linked(both, *pick(a, n_a, right), *pick(b, n_b, right))
                    counts[:, rows] = found.n_a, found.n_b, found.n_groups, found.n_links
                    for r, h in zip(rows.tolist(), found.sha256, strict=True):
                        hashes[r] = h
                    linked.append((rows, found))
                block.add(batch.column("doc_id").slice(lo, hi - lo), counts, hashes, linked)
                if block.held >= most_records or block.documents >= most_documents:
                    yield block.rows()
                    number += 1
                    block = Block(number, both.bits)
        if block.documents:
            yield block.rows()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return materialize(rows.mapInArrow(work, SPILL), "spill")


def merge(found: list[Iterable[bytes]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Ascending pairs of all runs with their counts added, a stretch at a time."""
    streams, held, heap = [iter(f) for f in found], {}, []

    def advance(i: int) -> None:
        frame = next(streams[i], None)
        if frame is None:
            held.pop(i, None)
        else:
            held[i] = open_pairs(frame)
            heapq.heappush(heap, (int(held[i][0][-1]), i))

    for i in range(len(streams)):
        advance(i)
    while heap:
        bound = heap[0][0]  # up to here every run's open frame is complete
        keys, counts = [], []
        for i, (k, c) in held.items():
            n = int(np.searchsorted(k, bound, "right"))
            keys.append(k[:n])
            counts.append(c[:n])
            held[i] = (k[n:], c[n:])
        while heap and heap[0][0] == bound:
            advance(heapq.heappop(heap)[1])
        key, count = np.concatenate(keys), np.concatenate(counts)
        order = np.argsort(key, kind="stable")
        key, count = key[order], count[order]
        first = np.flatnonzero(np.diff(key, prepend=-1))
        yield key[first], np.add.reduceat(count, first)


def with_best(merged: Iterable[tuple[np.ndarray, np.ndarray]], bits_b: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Pairs, counts, and whether a count is the largest of its id of A, whole ids at a time."""
    key = count = np.zeros(0, np.int64)
    for more in chain(merged, [None]):
        if more is None:
            cut = len(key)
        else:
            key, count = np.concatenate([key, more[0]]), np.concatenate([count, more[1]])
            cut = int(np.searchsorted(key, (key[-1] >> bits_b) << bits_b))  # the last id may go on
        if cut:
            side = key[:cut] >> bits_b
            first = np.flatnonzero(np.diff(side, prepend=-1))
            most = np.repeat(np.maximum.reduceat(count[:cut], first), np.diff(first, append=cut))
            yield key[:cut], count[:cut], (count[:cut] == most).astype(np.int64)
            key, count = key[cut:], count[cut:]


def counted(spilled: DataFrame, n_blocks: int, bits: tuple[int, int]) -> DataFrame:
    """radix, pairs: frames of pairs, their number of documents, and whether that is their id's largest."""
    level = spilled.filter("radix >= 0").select("radix", F.col("block").alias("run"), "pairs")

    def merged(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        frames = [pair_frame(k, c) for k, c in merge(table["pairs"].to_pylist())]
        return pa.table([[key[0].as_py()], [key[1].as_py()], [frames]], schema=pa.schema([("radix", pa.int32()), ("run", pa.int64()), ("pairs", pa.list_(pa.binary()))]))

    def last(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        frames = [pair_frame(*c) for c in with_best(merge(table["pairs"].to_pylist()), bits[1])]
        return pa.table([[key[0].as_py()], [frames]], schema=pa.schema([("radix", pa.int32()), ("pairs", pa.list_(pa.binary()))]))

    while n_blocks > FAN:
        n_blocks = -(-n_blocks // FAN)
        level = level.withColumn("run", F.pmod(F.xxhash64("run"), F.lit(n_blocks)))
        level = materialize(level.groupBy("radix", "run").applyInArrow(merged, "radix int, run bigint, pairs array<binary>"), "merged")
    return materialize(level.groupBy("radix").applyInArrow(last, "radix int, pairs array<binary>"), "counts")


def added(spilled: DataFrame, counts: DataFrame, n_blocks: int) -> DataFrame:
    """block, adds: what a run adds to the n_best and the count_sum of its block's documents."""
    salts = -(-n_blocks // SALT)
    salt = F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt")
    rows = spilled.filter("radix >= 0").select("block", "radix", salt, "pairs", "records")
    known = counts.select("radix", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"), "pairs")

    def back(key: tuple[pa.Scalar, ...], mine: pa.Table, known: pa.Table) -> pa.Table:
        parts = [open_pairs(f, 2) for f in known["pairs"][0].as_py()] if mine.num_rows else []
        pairs, count, best = (np.concatenate(c) for c in zip(*parts, strict=True)) if parts else [np.zeros(0, np.int64)] * 3
        adds = []
        for frames, records in zip(mine["pairs"], mine["records"], strict=True):
            sums_of = np.zeros((2, 1 << SLOT_BITS), np.int64)
            for frame, record in zip(frames.as_py(), records.as_py(), strict=True):
                ours, n = open_pairs(frame)
                slots, times = unpacked(record, 2)
                at = np.repeat(np.searchsorted(pairs, ours), n)
                np.add.at(sums_of[0], slots, times * best[at])
                np.add.at(sums_of[1], slots, times * count[at])
            end = int(np.flatnonzero(sums_of[1])[-1]) + 1
            adds.append(packed(*sums_of[:, :end]))
        return pa.table([mine["block"].combine_chunks(), pa.array(adds, pa.binary())], names=["block", "adds"])

    return rows.groupBy("radix", "salt").cogroup(known.groupBy("radix", "salt")).applyInArrow(back, "block bigint, adds binary")


RESULT = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def aligned(docs: DataFrame, ranks_file: str, pieces_file: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    Side A is a byte-level BPE by its file of ranks, side B a BPE of pieces with byte fallback; both see
    a space before the text.
    """
    spilled = spill(docs, ranks_file, pieces_file)
    n_blocks = spilled.filter("radix = -1").count()
    if not n_blocks:
        return docs.sparkSession.createDataFrame([], RESULT)
    counts = counted(spilled, n_blocks, tokenizers(ranks_file, pieces_file).bits)
    of_docs = spilled.filter("radix = -1").select("block", "docs")

    def finished(key: tuple[pa.Scalar, ...], of_block: pa.Table, adds: pa.Table) -> pa.Table:
        docs = of_block["docs"].combine_chunks().flatten()
        total = np.zeros((2, len(docs)), np.int64)
        for frame in adds["adds"].to_pylist():
            more = unpacked(frame, 2)
            for k in (0, 1):
                total[k, : len(more[k])] += more[k]
        names = [c.split()[0] for c in RESULT.split(", ")]
        given = {"n_best": pa.array(total[0]), "count_sum": pa.array(total[1])}
        return pa.table([given[n] if n in given else docs.field(n) for n in names], names=names)

    adds = added(spilled, counts, n_blocks)
    return of_docs.groupBy("block").cogroup(adds.groupBy("block")).applyInArrow(finished, RESULT)


def pair_table(docs: DataFrame, ranks_file: str, pieces_file: str) -> DataFrame:
    """The corpus's table of linked ids: a, b, n_docs, best (whether no other b is linked with a in more documents)."""
    spilled = spill(docs, ranks_file, pieces_file)
    bits = tokenizers(ranks_file, pieces_file).bits
    counts = counted(spilled, spilled.filter("radix = -1").count(), bits)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for frames in batch.column("pairs"):
                for frame in frames.as_py():
                    keys, n, best = open_pairs(frame, 2)
                    columns = [keys >> bits[1], keys & ((1 << bits[1]) - 1), n, best.astype(bool)]
                    yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), ["a", "b", "n_docs", "best"])

    return counts.mapInArrow(rows, "a bigint, b bigint, n_docs bigint, best boolean")
