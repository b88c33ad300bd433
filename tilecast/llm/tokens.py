"""Token ids of whole texts by a public tokenizer file, through a cache of the words seen."""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tiktoken
from tokenizers import Tokenizer

from tilecast.llm.text import claim
from tilecast.llm.words import WordIds, distinct, ranges, sums

#: How the vocabulary spells the end of a word: a fixed value. Here a zero byte stands for it.
END = "</w>"
#: Letters that lower one for one and that no normalisation joins with a neighbour, then ASCII signs. The
#: tokenizer always cuts between the two, and takes the letters for one word.
PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-įı-ňŊ-ſ]+)([!-/:-@\\[-`{-~]*)")

_OPEN: dict[str, WordEncoder] = {}


def byte_letters() -> dict[str, int]:
    """The characters that byte-level vocabularies write bytes as."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class WordEncoder:
    """Ids of texts, numbers of ``kind``.

    Only for tokenizers that drop white space and mark word ends, where the ids of a text are the ids
    of its words one after another. Plain words are merged by the same merges in the same order, all
    new ones of a run in one call; any other word is given to the tokenizer itself.
    """

    def __init__(self, file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(file)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.merger, self.id_of_rank, self.ends = self._merger()
        self.signs: dict[str, list[int]] = {"": []}
        self.cache = WordIds(self._new_words, self.kind)

    def _merger(self) -> tuple[tiktoken.Encoding, np.ndarray, np.ndarray]:
        """The vocabulary as ranks of bytes: ids ascend as merges do, single bytes and word ends first."""
        letters = byte_letters()
        vocab = self.tokenizer.get_vocab(with_added_tokens=False)
        spelled = {}
        for token, i in sorted(vocab.items(), key=lambda x: x[1]):
            body = token.removesuffix(END)
            if all(c in letters for c in body):
                spelled[bytes(letters[c] for c in body) + b"\0" * (body != token)] = i
        first = [bytes([b]) for b in range(256)] + [bytes([b, 0]) for b in range(256)]
        tokens = [*first, *(t for t in spelled if t not in set(first))]
        merger = tiktoken.Encoding("words", pat_str="[^\0]+\0", mergeable_ranks={t: r for r, t in enumerate(tokens)}, special_tokens={})
        id_of_rank = np.array([spelled.get(t, 0) for t in tokens], self.kind)
        return merger, id_of_rank, np.array([t.endswith(b"\0") for t in tokens])

    def _plain(self, cores: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not cores:
            return np.zeros(0, self.kind), np.zeros(0, np.int64)
        ranks = np.array(self.merger.encode_ordinary("\0".join(cores).lower() + "\0"), np.int64)
        return self.id_of_rank[ranks], np.diff(np.flatnonzero(self.ends[ranks]), prepend=-1)

    def _by_library(self, words: list[str]) -> list[list[int]]:
        return [f.ids for f in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)] if words else []

    def _new_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = list(map(PLAIN.fullmatch, words))
        plain = [m.groups() for m in found if m]
        unknown = list({s for _, s in plain}.difference(self.signs))
        self.signs.update(zip(unknown, self._by_library(unknown), strict=True))
        others = self._by_library([w for w, m in zip(words, found, strict=True) if not m])
        # what a word is made of: ids of its letters and of its signs, or its own ids and nothing
        used = list({s for _, s in plain})
        lists = [*(self.signs[s] for s in used), *others]
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        flat = np.fromiter((i for x in lists for i in x), self.kind, int(sizes.sum()))
        cores, core_sizes = self._plain([c for c, _ in plain])
        pool, pool_sizes = np.concatenate([cores, flat]), np.concatenate([core_sizes, sizes])
        starts = np.cumsum(pool_sizes) - pool_sizes
        place = {s: len(plain) + i for i, s in enumerate(used)}
        made_of = np.full((len(words), 2), -1, np.int64)
        is_plain = np.fromiter((m is not None for m in found), bool, len(found))
        made_of[is_plain, 0] = np.arange(len(plain))
        made_of[is_plain, 1] = [place[s] for _, s in plain]
        made_of[~is_plain, 0] = len(plain) + len(used) + np.arange(len(others))
        parts = made_of.ravel()
        counts = np.where(parts < 0, 0, pool_sizes[parts])
        return pool[ranges(starts[parts], counts)], counts.reshape(-1, 2).sum(1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each has."""
        # cut at ASCII white space: the tokenizer drops it, and no normalisation crosses it
        words, at, counts = distinct(pc.ascii_split_whitespace(pc.fill_null(texts, "")))
        ids, sizes = self.cache.gather(self.cache.numbers(words)[at])
        return ids, sums(sizes, counts)

    def encode_with(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """The same with the id ``end`` after each text."""
        ids, counts = self.encode(texts)
        out = np.full(len(ids) + len(counts), end, self.kind)
        inside = np.ones(len(out), bool)
        inside[np.cumsum(counts + 1) - 1] = False
        out[inside] = ids
        return out, counts + 1


def word_encoder(file: str) -> WordEncoder:
    """One encoder per worker process and file."""
    claim("tokens", _OPEN.clear)
    if file not in _OPEN:
        _OPEN[file] = WordEncoder(file)
    return _OPEN[file]
