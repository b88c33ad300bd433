"""Token ids of a run of texts through the distinct words in it, with Arrow and numpy around one cache."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard

#: Bytes that a cache may hold, about; then it starts again from the words of the run at hand.
CACHE_BYTES = 40_000_000
#: What a word costs in a dictionary besides its text: two objects, a slot, two numbers.
ENTRY = 150


class WordIds:
    """Numbers words, and holds the ids of each one in one long array.

    ``encode`` gives the ids of a list of words one after another, and how many each has.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], kind=np.uint32, most: int = CACHE_BYTES):
        self.encode, self.kind, self.most = encode, np.dtype(kind), most
        self._clear()

    def _clear(self) -> None:
        self.number: dict[str, int] = {}
        self.starts, self.ids, self.n, self.used, self.size = np.zeros(1024, np.int64), np.zeros(4096, self.kind), 0, 0, 0

    def numbers(self, words: list[str]) -> np.ndarray:
        """The number of each of ``words``, distinct ones; valid until the next call."""
        if self.size > self.most:
            self._clear()
        get = self.number.get
        at = np.fromiter((get(w, -1) for w in words), np.int64, len(words))
        new = np.flatnonzero(at < 0)
        if len(new):
            at[new] = np.arange(self.n, self.n + len(new))
            self._add([words[i] for i in new.tolist()])
        return at

    def _add(self, words: list[str]) -> None:
        flat, sizes = self.encode(words)
        self.starts = _room(self.starts, self.n + len(words) + 1)
        self.ids = _room(self.ids, self.used + len(flat))
        self.ids[self.used : self.used + len(flat)] = flat
        self.starts[self.n : self.n + len(words) + 1] = self.used + np.concatenate([[0], np.cumsum(sizes)])
        self.number.update(zip(words, range(self.n, self.n + len(words)), strict=True))
        self.n, self.used = self.n + len(words), self.used + len(flat)
        self.size += sum(map(len, words)) + ENTRY * len(words) + flat.nbytes

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the numbered words one after another, and how many each has."""
        first = self.starts[numbers]
        counts = self.starts[numbers + 1] - first
        return self.ids[ranges(first, counts)], counts


def _room(a: np.ndarray, size: int) -> np.ndarray:
    return a if len(a) >= size else np.concatenate([a, np.zeros(max(len(a), size - len(a)), a.dtype)])


def ranges(first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... ``counts[0]`` numbers, then those of the next range."""
    ends = np.cumsum(counts)
    if not len(ends) or not ends[-1]:
        return np.zeros(0, np.int64)
    return np.arange(ends[-1]) + np.repeat(first - ends + counts, counts)


def distinct(split: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Of a list array of words: the distinct ones, the place of each word among them, and words per row."""
    counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = pc.dictionary_encode(split.flatten())
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), counts


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of each row's values, rows of ``counts`` values one after another."""
    total = np.concatenate([[0], np.cumsum(values)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def packed(*columns: np.ndarray) -> bytes:
    """Integer columns of one length as a zstd frame."""
    return zstandard.compress(b"".join(c.astype("<u8").tobytes() for c in columns), 1)


def unpacked(frame: bytes, n: int) -> list[np.ndarray]:
    """The ``n`` columns of a frame, as signed 64-bit integers."""
    flat = np.frombuffer(zstandard.decompress(frame), "<u8").astype(np.int64)
    return list(flat.reshape(n, -1))
