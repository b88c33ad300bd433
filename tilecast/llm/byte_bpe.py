"""Byte-level BPE with a pre-tokenizer in array operations.

The pre-tokenizer is a small automaton. Code points become classes by one table lookup, classes and
what follows them become symbols, and each symbol is a function from states to states. Composition of
functions is associative, so the state before every code point comes from one prefix scan over the
numbers of the functions, whose products are in a table. State and symbol tell where tokens begin. No
regular expression is run over a text.

The slices between boundaries are merged pair by pair, lowest rank first, behind a cache. Decoding
gathers the bytes of all ids by the offsets that the vocabulary keeps.
"""

from __future__ import annotations

import base64
from functools import cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tilecast.llm.text import utf8, with_columns_after

CACHED_SLICES, LONG_SLICE = 400_000, 200
LETTER, NUMBER, OTHER, SPACE = range(4)
#: What a code point is to the automaton: as a letter, number or other; the blank before a run; white
#: space with more of it behind; a last white space that stands alone; an apostrophe before one or two
#: letters of a contraction.
LETTERS, NUMBERS, OTHERS, BLANK, MORE_SPACE, LAST_SPACE, SHORT, LONG = range(8)
#: States: between tokens, in a run of letters, numbers or others, behind a run's blank, in white
#: space, one or two letters before a contraction ends.
FREE, IN_LETTERS, IN_NUMBERS, IN_OTHERS, AFTER_BLANK, IN_SPACE, ONE_LEFT, TWO_LEFT = range(8)


def step(state: int, symbol: int) -> tuple[int, bool]:
    """The next state, and whether a token begins at the symbol."""
    if symbol == LETTERS:
        if state == TWO_LEFT:
            return ONE_LEFT, False
        if state == ONE_LEFT:
            return FREE, False
        return IN_LETTERS, state not in (IN_LETTERS, AFTER_BLANK)
    if symbol == NUMBERS:
        return IN_NUMBERS, state not in (IN_NUMBERS, AFTER_BLANK)
    if symbol in (OTHERS, SHORT, LONG):
        if state in (IN_OTHERS, AFTER_BLANK) or symbol == OTHERS:
            return IN_OTHERS, state not in (IN_OTHERS, AFTER_BLANK)
        return (ONE_LEFT if symbol == SHORT else TWO_LEFT), True
    if symbol == BLANK:
        return AFTER_BLANK, True
    if symbol == MORE_SPACE:
        return IN_SPACE, state != IN_SPACE
    return FREE, True


@cache
def automaton() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The number of each symbol's function (then of those at a text's first code point), the table of
    products, each function's value at FREE, and whether a token begins, by state and symbol."""
    plain = [tuple(step(q, s)[0] for q in range(8)) for s in range(8)]
    first = [(f[FREE],) * 8 for f in plain]
    known = list(dict.fromkeys(plain + first))
    number = {f: i for i, f in enumerate(known)}
    todo = list(known)
    while todo:
        f = todo.pop()
        for g in list(known):
            for h in (tuple(g[q] for q in f), tuple(f[q] for q in g)):
                if h not in number:
                    number[h] = len(known)
                    known.append(h)
                    todo.append(h)
    assert len(known) <= 256
    product = np.array([[number[tuple(g[q] for q in f)] for g in known] for f in known], np.uint8)
    begins = np.array([[step(q, s)[1] for s in range(8)] for q in range(8)])
    return (np.array([number[f] for f in plain + first], np.uint8), product.ravel(), np.array([f[FREE] for f in known], np.uint8), begins)


def scan(functions: np.ndarray, product: np.ndarray, size: int) -> np.ndarray:
    """The number of the composition of all functions up to each place, itself included."""
    n = len(functions)
    if n < 2:
        return functions
    times = lambda a, b: product[a.astype(np.uint16) * np.uint16(size) + b]
    even, odd = functions[0 : n - n % 2 : 2], functions[1::2]
    pairs = scan(times(even, odd), product, size)
    out = np.empty_like(functions)
    out[0] = functions[0]
    out[1::2] = pairs
    out[2::2] = times(pairs[: len(out[2::2])], functions[2::2])
    return out


@cache
def classes() -> np.ndarray:
    """The class of every code point, from the Unicode properties."""
    table = np.full(0x110000, OTHER, np.uint8)
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    points = np.frombuffer(every.encode("utf-32-le"), np.uint32)
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\p{White_Space}+")):
        for m in regex.finditer(pattern, every):
            table[points[m.start() : m.end()]] = kind
    return table


def boundaries(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Byte positions in ``data`` where tokens begin; ``at`` are the texts' limits in bytes."""
    if not len(data):
        return np.zeros(0, np.int64)
    lead = np.flatnonzero((data & 0xC0) != 0x80)
    points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), np.uint32)
    n = len(points)
    first, last = np.zeros(n, bool), np.zeros(n, bool)
    limits = np.searchsorted(lead, at)
    full = limits[:-1] < limits[1:]
    first[limits[:-1][full]] = True
    last[limits[1:][full] - 1] = True
    kinds = classes()[points]
    symbols = np.array([LETTERS, NUMBERS, OTHERS, LAST_SPACE], np.uint8)[kinds]
    space = kinds == SPACE
    more = np.append(space[1:], True) | last
    symbols[space & more] = MORE_SPACE
    symbols[space & ~more & (points == 32)] = BLANK
    quotes = np.flatnonzero((points == 39) & ~last)
    if len(quotes):
        one = points[quotes + 1]
        two = np.where(last[quotes + 1], 0, points[np.minimum(quotes + 2, n - 1)])
        symbols[quotes[np.isin(one, [ord(c) for c in "stmd"])]] = SHORT
        long = ((one == ord("r")) | (one == ord("v"))) & (two == ord("e")) | (one == ord("l")) & (two == ord("l"))
        symbols[quotes[long]] = LONG
    numbers, product, at_free, begins = automaton()
    states = at_free[scan(numbers[symbols + np.where(first, np.uint8(8), np.uint8(0))], product, len(at_free))]
    before = np.concatenate([np.zeros(1, np.uint8), states[:-1]])
    before[first] = FREE
    return lead[begins[before, symbols]]


class RankFile:
    """A vocabulary of byte strings by rank, with the cache of the slices merged so far."""

    def __init__(self, file: str):
        with open(file, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.kind = np.dtype("<u2" if max(self.ranks.values()) < 1 << 16 else "<u4")
        size = max(self.ranks.values()) + 1
        strings = [b""] * size
        for string, rank in self.ranks.items():
            strings[rank] = string
        self.blob = np.frombuffer(b"".join(strings), np.uint8)
        self.lengths = np.array([len(s) for s in strings], np.int64)
        self.offsets = np.cumsum(self.lengths) - self.lengths
        self.merged = _Merged(self)

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one slice: adjacent parts join, lowest rank first, the left one at ties."""
        ranks = self.ranks
        if piece in ranks:
            return [ranks[piece]]
        n = len(piece)
        ends, before = list(range(1, n + 1)), list(range(-1, n - 1))  # of the part that begins at each place
        alive = [True] * n
        queue = [(r, i, i + 1, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i : i + 2])) is not None]
        heapify(queue)
        while queue:
            _, i, middle, end = heappop(queue)
            if not alive[i] or ends[i] != middle or ends[middle] != end:
                continue
            alive[middle], ends[i] = False, end
            if end < n:
                before[end] = i
                if (r := ranks.get(piece[i : ends[end]])) is not None:
                    heappush(queue, (r, i, end, ends[end]))
            j = before[i]
            if j >= 0 and (r := ranks.get(piece[j:end])) is not None:
                heappush(queue, (r, j, i, end))
        return [ranks[piece[i : ends[i]]] for i in range(n) if alive[i]]

    def encode(self, data: np.ndarray, at: np.ndarray) -> list[bytes]:
        """The ids of each text, as bytes of ``kind``."""
        if len(self.merged) > CACHED_SLICES:
            self.merged.clear()
        begins = boundaries(data, at)
        raw = data.tobytes()
        limits = np.append(begins, len(data)).tolist()
        found = [self.merged[raw[a:b]] for a, b in zip(limits, limits[1:], strict=False)]
        cuts = np.searchsorted(begins, at).tolist()
        return [b"".join(found[a:b]) for a, b in zip(cuts, cuts[1:], strict=False)]

    def decode(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        total = np.cumsum(lengths)
        shift = np.repeat(self.offsets[ids] - (total - lengths), lengths)
        return self.blob[shift + np.arange(len(shift))].tobytes()


class _Merged(dict):
    def __init__(self, owner: RankFile):
        self.owner = owner

    def __missing__(self, piece: bytes) -> bytes:
        ids = np.array(self.owner.merge(piece), self.owner.kind).tobytes()
        if len(piece) <= LONG_SLICE:
            self[piece] = ids
        return ids


@cache
def rank_file(file: str) -> RankFile:
    return RankFile(file)


def encode_bpe(docs: DataFrame, file: str, keep: list[str] | None = None) -> DataFrame:
    """Rows as ``row``, with ``ids`` (binary, little-endian unsigned 32-bit) of each whole text.

    A null or empty text has no ids. Special tokens' strings are ordinary text. Nothing is shuffled.
    """
    def work(texts, given):
        ranks = rank_file(file)
        found = ranks.encode(*utf8(texts))
        return {"ids": pa.array([np.frombuffer(ids, ranks.kind).astype("<u4").tobytes() for ids in found], pa.binary())}

    return with_columns_after(docs, work, "ids binary", keep=keep)


def decode_bpe(encoded: DataFrame, file: str) -> DataFrame:
    """Rows of ``encode_bpe`` with ``decoded``, the bytes of their ids."""
    row = encoded.schema["row"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            ranks = rank_file(file)
            raw = [ranks.decode(np.frombuffer(x.as_py(), "<u4")) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("row"), batch.column("ids"), pa.array(raw, pa.binary())], ["row", "ids", "decoded"])

    return encoded.mapInArrow(run, f"row {row}, ids binary, decoded binary")


def bpe_digest(docs: DataFrame, file: str) -> DataFrame:
    """What op7 returns: encode, decode, and hash both.

    Null and empty texts have no ids and decode to nothing; very long texts are encoded whole; repeated
    rows are rows of their own; an empty table gives no rows. Rows travel in a struct, so no column can clash.
    """
    read = decode_bpe(encode_bpe(docs, file, ["doc_id"]), file)
    return read.select(
        "row.doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


