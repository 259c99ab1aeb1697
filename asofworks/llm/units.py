"""Token ids of text units, kept within a worker by the units' hashes.

Texts are cut at places where a tokenizer never joins what stands on both
sides; the ids of a text are then those of its units in order.  Units repeat
often, so each is given to the tokenizer once per worker.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd


class UnitCache:
    """Ids by unit hash.  It is emptied when it holds over limit bytes (of ids, and of 24 for each unit's entry).

    What a call adds, one block of texts, comes on top of that.  Ids never
    depend on what it holds.  ids[0] is set aside for the caller, say for an
    end id.
    """

    def __init__(self, limit: int = 1 << 25, aside: int = 0) -> None:
        self.limit, self.aside = limit, aside
        self._clear()

    def size(self) -> int:
        """Bytes in use: ids (their array may be up to twice as long), and for each unit its key, place and length."""
        return 4 * self.used + 24 * len(self.keys)

    def _clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.start = np.zeros(0, np.int64)
        self.length = np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, np.int32), 1
        self.ids[0] = self.aside

    def _add(self, keys: np.ndarray, flat: np.ndarray, length: np.ndarray) -> None:
        if self.used + len(flat) > len(self.ids):
            grown = np.zeros(max(2 * len(self.ids), self.used + len(flat)), np.int32)
            grown[: self.used] = self.ids[: self.used]
            self.ids = grown
        self.ids[self.used : self.used + len(flat)] = flat
        start = self.used + np.concatenate([[0], np.cumsum(length)[:-1]])
        self.used += len(flat)
        order = np.argsort(keys)
        at = np.searchsorted(self.keys, keys[order])
        self.keys = np.insert(self.keys, at, keys[order])
        self.start = np.insert(self.start, at, start[order])
        self.length = np.insert(self.length, at, length[order])

    def slots(self, keys: np.ndarray, encode: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        """(start, length) within ids for each key; encode(k) gives flat ids and lengths of the occurrences k."""
        if not len(keys):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        codes, unique = pd.factorize(keys)
        first = np.empty(len(unique), np.int64)
        first[codes[::-1]] = np.arange(len(keys))[::-1]
        if self.size() > self.limit:
            self._clear()
        order = np.argsort(unique)
        at = np.searchsorted(self.keys, unique[order])
        have = np.zeros(len(unique), bool)
        inside = at < len(self.keys)
        have[inside] = self.keys[at[inside]] == unique[order][inside]
        new = order[~have]
        if len(new):
            self._add(unique[new], *encode(first[new]))
        place = np.searchsorted(self.keys, unique[order])
        slot = np.empty(len(unique), np.int64)
        slot[order] = place
        slot = slot[codes]
        return self.start[slot], self.length[slot]


def gather(source: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The runs source[start : start + length], one after another."""
    total = int(length.sum())
    before = np.concatenate([[0], np.cumsum(length)[:-1]]) if len(length) else length
    return source[np.repeat(start - before, length) + np.arange(total)]
