"""Shingle sets as sorted 64-bit numbers, and fast similarity sketches of them."""

from __future__ import annotations

import numpy as np
import xxhash

from tilecast.llm.text import claim

CACHED_WORDS = 200_000
FAR = np.iinfo(np.int64).max


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _Hashes()


def shingle_set(text: str, size: int) -> np.ndarray:
    """The distinct shingles of ``size`` words, ascending; with fewer words the whole sequence is one.

    Words are runs without ASCII white space, A-Z in lower case.
    """
    claim("shingles", _HASHES.clear)
    if len(_HASHES) > CACHED_WORDS:
        _HASHES.clear()
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    one = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    width = min(size, len(words))
    with np.errstate(over="ignore"):
        out = np.full(len(one) - width + 1, np.uint64(width))
        for k in range(width):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + one[k : len(one) - width + 1 + k])
    return np.unique(out)


def sketches(sets: list[np.ndarray], size: int) -> np.ndarray:
    """A row of ``size`` values per set, by rounds of hashed bin placement; empty sets keep FAR.

    In round i < size every element goes to a hashed bin, in round size + j all go to bin j, and each
    bin keeps its smallest (round, hash). Rounds end for a set once its bins are full, which the
    second kind of round guarantees by round 2 * size. Two sets agree in a bin with a probability of
    their Jaccard similarity, and the share of agreeing bins is concentrated around it.
    """
    out = np.full((len(sets), size), FAR, np.int64)
    flat = out.reshape(-1)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    x = np.concatenate(sets) if len(owner) else np.zeros(0, np.uint64)
    for i in range(2 * size):
        if not len(x):
            break
        with np.errstate(over="ignore"):
            h = mix(x + np.uint64(i + 1) * np.uint64(0x9E3779B97F4A7C15))
        spot = (h >> np.uint64(40)).astype(np.int64) % size if i < size else np.full(len(x), i - size)
        value = (np.int64(i) << 32) | (h & np.uint64(0xFFFFFFFF)).astype(np.int64)
        np.minimum.at(flat, owner * size + spot, value)
        if i < 8 or i % 8 == 0 or i >= size:
            open_sets = (out == FAR).any(1)
            stay = open_sets[owner]
            x, owner = x[stay], owner[stay]
    return out


def bands(rows: np.ndarray, count: int, height: int) -> np.ndarray:
    """``count`` 64-bit hashes per sketch, each of ``height`` values of its own and the band's number."""
    with np.errstate(over="ignore"):
        out = np.tile(np.arange(1, count + 1, dtype=np.uint64), (len(rows), 1))
        for k in range(height):
            out = mix(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, k : count * height : height].astype(np.uint64))
    return out.astype(np.int64)
