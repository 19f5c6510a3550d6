"""Values per distinct word, kept by a worker from batch to batch."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np

from qualityforge.llm import kernel as K

# Distinct words a worker remembers; beyond that it starts afresh with the next slice.
LIMIT = 1_500_000
_SHARED: dict[str, tuple[object, WordCache]] = {}


class WordCache:
    """Rows of a fixed width by word hash, computed once for a word: ``make(list of words)``."""

    def __init__(self, make: Callable[[list[bytes]], np.ndarray], limit: int = LIMIT):
        self.make, self.limit = make, limit
        self.clear()

    def clear(self) -> None:
        self.hashes, self.rows = np.zeros(0, np.uint64), None

    @classmethod
    def shared(cls, name: str, model: object, make: Callable[[list[bytes]], np.ndarray]) -> WordCache:
        """The worker's cache for ``model``; another model of that name replaces it."""
        held = _SHARED.get(name)
        if held is None or held[0] is not model:
            held = _SHARED[name] = (model, cls(make))
        return held[1]

    def unique(self, words: K.Words) -> tuple[np.ndarray, np.ndarray]:
        """Values of the slice's distinct words, and each word's place among them."""
        if len(self.hashes) > self.limit:
            self.clear()
        distinct, one, place = K.unique_words(words)
        at = np.searchsorted(self.hashes, distinct)
        known = np.zeros(len(distinct), bool)
        inside = at < len(self.hashes)
        known[inside] = self.hashes[at[inside]] == distinct[inside]
        new = np.flatnonzero(~known)
        if len(new) or self.rows is None:
            made = self.make([words.text(i) for i in one[new]])
            if self.rows is None:
                self.rows = made[:0]
            out = np.empty((len(distinct), *made.shape[1:]), made.dtype)
            out[known] = self.rows[at[known]]
            out[new] = made
            self.hashes = np.insert(self.hashes, at[new], distinct[new])
            self.rows = np.insert(self.rows, at[new], made, axis=0)
        else:
            out = self.rows[at]
        return out, place

    def values(self, words: K.Words) -> np.ndarray:
        """One value (or row) per word of the slice."""
        out, place = self.unique(words)
        return out[place]
