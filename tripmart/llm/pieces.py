"""Remembered values of the pieces of texts between separators, looked up with numpy.

Vocabulary work on prose repeats the same pieces over and over. ``PieceMemo`` hashes
all pieces of a slice of texts at once (64 bits over the bytes), sorts the distinct
ones against those known and calls ``learn`` for the new ones only. The memory is bounded:
beyond ``most`` pieces it starts anew.
"""

from __future__ import annotations

from collections.abc import Callable
from itertools import chain

import numpy as np
import pandas as pd

from tripmart.llm.shingles import hash_runs, joined


def _distinct(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct values, sorted; first place of each; which of them each value is): a hash table looks at all, only the distinct are sorted."""
    which, values = pd.factorize(hashes)
    first = np.empty(len(values), np.int64)
    first[which[::-1]] = np.arange(len(hashes))[::-1]
    order = np.argsort(values)
    rank = np.empty(len(values), np.int64)
    rank[order] = np.arange(len(values))
    return values[order], first[order], rank[which]


class PieceMemo:
    """``learn(pieces)`` gives one list of numbers of type ``dtype`` for each piece; pieces lie
    between the bytes ``separators``."""

    def __init__(self, learn: Callable[[list[str]], list], dtype: str, separators: bytes = b"\n ", most: int = 1_200_000):
        self.learn, self.dtype, self.most = learn, np.dtype(dtype), most
        self.after = separators[:1]
        self.cut = np.zeros(256, dtype=bool)
        self.cut[list(separators)] = True
        self._clear()

    def _clear(self) -> None:
        self.known = np.empty(0, np.uint64)
        self.offset = np.empty(0, np.int64)
        self.size = np.empty(0, np.int64)
        self.pool = np.empty(1 << 16, self.dtype)
        self.used = 0

    def _add(self, hashes: np.ndarray, pieces: list[str]) -> None:
        if len(self.known) + len(pieces) > self.most:
            self._clear()
        values = self.learn(pieces)
        size = np.fromiter(map(len, values), np.int64, len(values))
        flat = np.fromiter(chain.from_iterable(values), self.dtype, int(size.sum()))
        while self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.empty_like(self.pool)])
        self.pool[self.used:self.used + len(flat)] = flat
        at = self.used + np.cumsum(size) - size
        self.used += len(flat)
        place = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, place, hashes)
        self.offset = np.insert(self.offset, place, at)
        self.size = np.insert(self.size, place, size)

    def lookup(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(values of all pieces of all texts in order, first value of each text with the total at the end)."""
        raw, first = joined(texts, self.after)
        starts, ends, hashes = hash_runs(raw, self.cut)
        if not len(starts):
            return np.empty(0, self.dtype), np.zeros(len(texts) + 1, np.int64)
        distinct, where, which = _distinct(hashes)
        place = np.searchsorted(self.known, distinct)
        known = np.zeros(len(distinct), dtype=bool)
        inside = place < len(self.known)
        known[inside] = self.known[place[inside]] == distinct[inside]
        if not known.all():
            data, new = raw.tobytes(), np.flatnonzero(~known)
            cuts = zip(starts[where[new]].tolist(), ends[where[new]].tolist())
            before = len(self.known)
            self._add(distinct[new], [data[a:b].decode("utf-8", "surrogatepass") for a, b in cuts])
            if before and len(self.known) == len(new):  # it started anew: the others have to be learnt again
                old = np.flatnonzero(known)
                cuts = zip(starts[where[old]].tolist(), ends[where[old]].tolist())
                if len(old):
                    self.most, most = 2**62, self.most
                    self._add(distinct[old], [data[a:b].decode("utf-8", "surrogatepass") for a, b in cuts])
                    self.most = most
            place = np.searchsorted(self.known, distinct)
        size = self.size[place][which]
        end = np.cumsum(size)
        at = np.repeat(self.offset[place][which] - (end - size), size) + np.arange(end[-1])
        return self.pool[at], np.concatenate([[0], end])[np.searchsorted(starts, first)]
