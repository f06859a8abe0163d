"""Ids of many texts from the ids of their distinct words, each encoded once."""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa

ENCODE_BYTES = 1 << 20  # words given to a tokenizer at once


class KnownWords:
    """Words encoded so far by one or more tokenizers; each gives the ids of every word of a list."""

    def __init__(self, *encoders: Callable[[list[str]], list[list[int]]]):
        self.encoders = encoders
        self.number: dict[str, int] = {}
        # Per tokenizer the ids of all words, one after the other, and where each word ends.
        self.ids = [np.zeros(0, np.int32) for _ in encoders]
        self.ends = [np.zeros(1, np.int64) for _ in encoders]

    def ids_of(self, split: pa.ListArray | pa.LargeListArray) -> list[list[np.ndarray]]:
        """Per tokenizer, the ids of the words of each list, one after the other."""
        if not len(split):
            return [[] for _ in self.encoders]
        coded = split.flatten().dictionary_encode()
        words, cuts = coded.dictionary.to_pylist(), split.offsets.to_numpy()
        numbers = [self.number.get(w, -1) for w in words]
        if new := [w for w, n in zip(words, numbers) if n < 0]:
            self._learn(new)
            numbers = [self.number[w] if n < 0 else n for w, n in zip(words, numbers)]
        known = np.array(numbers, np.int64)[coded.indices.to_numpy()]
        return [self._gather(ids, ends, known, cuts - cuts[0]) for ids, ends in zip(self.ids, self.ends)]

    @staticmethod
    def _gather(ids: np.ndarray, ends: np.ndarray, known: np.ndarray, cuts: np.ndarray) -> list[np.ndarray]:
        begin = ends[known]
        n = ends[known + 1] - begin
        upto = np.concatenate([[0], np.cumsum(n)])
        place = np.arange(upto[-1]) + np.repeat(begin - upto[:-1], n)
        flat, borders = ids[place], upto[cuts].tolist()
        return [flat[a:b] for a, b in zip(borders, borders[1:])]

    def _learn(self, words: list[str]) -> None:
        """Have the tokenizers encode words, a portion at a time."""
        size = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 16) // ENCODE_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(size)) + 1).tolist(), len(words)]
        for i, j in zip(cuts, cuts[1:]):
            self.number.update(zip(words[i:j], range(len(self.number), len(self.number) + j - i)))
            for side, encode in enumerate(self.encoders):
                ids = encode(words[i:j])
                lengths = np.fromiter(map(len, ids), np.int64, len(ids))
                self.ends[side] = np.concatenate([self.ends[side], self.ends[side][-1] + np.cumsum(lengths)])
                self.ids[side] = np.concatenate([self.ids[side], np.fromiter(chain.from_iterable(ids), np.int32, lengths.sum())])
