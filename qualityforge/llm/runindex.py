"""Run-length index of a small collection of byte strings, and matching statistics from it.

The Burrows-Wheeler transform of the strings (each with a terminator of its own) is kept
as runs of equal bytes with the suffix positions of both ends of every run. The longest
match of a position with its neighbour in suffix order needs a comparison only where
a run begins or ends; along the text, every other value is its left neighbour's minus
one, because both suffixes then lose the same byte. So the statistics of a repetitive
collection take as many comparisons as there are runs.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

# Symbols packed into the first sort key: seven of nine bits.
FIRST, BITS = 7, 9


@dataclass
class RunIndex:
    """``symbols`` and ``lengths`` of the runs of the transform (symbol 0: the start of a
    string), ``heads`` and ``tails`` the suffix positions at their ends; ``text`` is byte + 1
    or 0 for a terminator, ``stop`` the terminator of each position's string, and
    ``ranks`` the classes of suffixes that agree in their first so many symbols."""

    text: np.ndarray
    stop: np.ndarray
    starts: np.ndarray
    symbols: np.ndarray
    lengths: np.ndarray
    heads: np.ndarray
    tails: np.ndarray
    ranks: list[tuple[int, np.ndarray]]


def _joined(strings: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sizes = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(sizes + 1) - 1
    text = np.zeros(int(ends[-1]) + 1, np.int64)
    inside = np.ones(len(text), bool)
    inside[ends] = False
    text[inside] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int64) + 1
    return text, np.repeat(ends, sizes + 1), ends - sizes


def _suffixes(text: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, list[tuple[int, np.ndarray]]]:
    """Suffix order by sorting on known prefix classes, several of them at a time."""
    n, here = len(text), np.arange(len(text))
    # Symbols after a terminator count as terminators.
    key, alive, padded = text.copy(), text > 0, np.append(text, np.zeros(FIRST, np.int64))
    for t in range(1, FIRST):
        symbol = np.where(alive, padded[t : n + t], 0)
        key, alive = (key << BITS) | symbol, symbol > 0
    order = np.argsort(key)
    fresh = np.ones(n, bool)
    fresh[1:] = key[order[1:]] != key[order[:-1]]
    # Terminators come first, in the order of their strings, and differ from one another.
    strings = int((text == 0).sum())
    order[:strings].sort()
    fresh[:strings] = True
    first = np.maximum.accumulate(np.where(fresh, here, 0))
    rank = np.empty(n, np.int64)
    rank[order] = first
    ranks, depth, bits = [(FIRST, rank.astype(np.int32))], FIRST, max(1, int(n - 1).bit_length())
    ways = 3 if 3 * bits <= 63 else 2
    while True:
        last = np.ones(n, bool)
        last[:-1] = fresh[1:]
        open_ = np.flatnonzero(~(fresh & last))
        if not len(open_):
            return order, ranks
        p = order[open_]
        key = rank[p]
        for w in range(1, ways):
            key = (key << bits) | rank[np.minimum(p + w * depth, stop[p])]
        by = np.argsort(key)
        p, key = p[by], key[by]
        order[open_] = p
        new = np.ones(len(p), bool)
        new[1:] = key[1:] != key[:-1]
        fresh[open_] = new
        rank[p] = open_[np.maximum.accumulate(np.where(new, np.arange(len(p)), 0))]
        depth *= ways
        ranks.append((depth, rank.astype(np.int32)))


def build(strings: list[bytes]) -> RunIndex:
    text, stop, starts = _joined(strings)
    order, ranks = _suffixes(text, stop)
    before = text[order - 1]
    before[np.isin(order, starts)] = 0
    head = np.ones(len(text), bool)
    # Starts of strings differ from one another.
    head[1:] = (before[1:] != before[:-1]) | (before[1:] == 0)
    at = np.flatnonzero(head)
    lengths = np.diff(np.append(at, len(text)))
    return RunIndex(text, stop, starts, before[at], lengths, order[at], order[at + lengths - 1], ranks)


def _agree(index: RunIndex, x: np.ndarray, y: np.ndarray, least: int) -> np.ndarray:
    """Length of the longest common prefix of suffixes, by classes of falling depth; 0 for
    some that are shorter than ``least``."""
    sure = [rank for depth, rank in index.ranks if depth <= least]
    if sure:
        worth = np.flatnonzero(sure[-1][x] == sure[-1][y])
        out = np.zeros(len(x), np.int64)
        out[worth] = _agree(index, x[worth], y[worth], 0)
        return out
    x, y, total, last = x.copy(), y.copy(), np.zeros(len(x), np.int64), len(index.text) - 1
    for depth, rank in reversed(index.ranks):
        for _ in range(2):
            same = (rank[x] == rank[y]) & (x + depth <= index.stop[x]) & (y + depth <= index.stop[y])
            if not same.any():
                break
            step = np.where(same, depth, 0)
            x, y, total = x + step, y + step, total + step
    for _ in range(FIRST):
        same = (index.text[x] == index.text[y]) & (index.text[x] > 0)
        x, y, total = np.minimum(x + same, last), np.minimum(y + same, last), total + same
    return total


def _streamed(n: int, at: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Values at some positions; each other position has its left neighbour's minus one."""
    known = np.zeros(n, np.int64)
    known[at] = values
    mark = np.full(n, -1)
    mark[at] = at
    mark = np.maximum.accumulate(mark)
    return np.maximum(known[mark] - (np.arange(n) - mark), 0)


def matching_statistics(index: RunIndex, least: int = 0) -> np.ndarray:
    """For every position, the length of its longest match that starts anywhere else.

    Matches end with their strings; positions of terminators have 0. Matches shorter
    than ``least`` may be given as shorter than they are, which saves comparisons.
    """
    met = np.append(0, _agree(index, index.heads[1:], index.tails[:-1], least))
    n = len(index.text)
    out = np.maximum(_streamed(n, index.heads, met), _streamed(n, index.tails, np.append(met[1:], 0)))
    return np.where(index.text > 0, out, 0)
