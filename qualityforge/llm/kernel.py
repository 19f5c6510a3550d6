"""Vectorised text helpers used inside Arrow tasks.

Texts are handled as one byte buffer per slice of a batch, so a task's memory
follows the slice (``SLICE`` bytes, or one document if that is longer) and not
the partition. Words are maximal runs of bytes outside ``\\x20 \\x09-\\x0D``.
"""

from __future__ import annotations

import os
import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE = 2 << 20
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (murmur finaliser)."""
    x = x.astype(U, copy=True)
    x ^= x >> U(33)
    x *= U(0xFF51AFD7ED558CCD)
    x ^= x >> U(33)
    x *= U(0xC4CEB9FE1A85EC53)
    x ^= x >> U(33)
    return x


_BYTE = mix(np.arange(1, 257, dtype=U) * U(0x9E3779B97F4A7C15)) | U(1)
_PLACE = mix(np.arange(1, 65537, dtype=U) * U(0xD1B54A32D192ED03))
_STEP = mix(np.arange(1, 65, dtype=U) * U(0x8CB92BA72F3D8DD7)) | U(1)


def runs_hash(values: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hash of consecutive runs of bytes; ``lengths`` sum to ``len(values)``."""
    out = np.zeros(len(lengths), U)
    full = np.flatnonzero(lengths)
    if len(full):
        n = lengths[full]
        begin = np.cumsum(n) - n
        place = np.arange(len(values), dtype=np.int64) - np.repeat(begin, n)
        weight = _PLACE[place & 0xFFFF]
        if n.max() > 0x10000:
            weight = weight * ((place >> 16).astype(U) * U(2) + U(1))
        out[full] = np.add.reduceat(_BYTE[values] * weight, begin)
    return mix(out ^ mix(lengths.astype(U)))


@dataclass
class Slice:
    """Some documents of a batch: rows ``first:last``, their bytes and offsets."""

    first: int
    last: int
    data: np.ndarray
    offsets: np.ndarray

    def per_doc(self, flags: np.ndarray) -> np.ndarray:
        """Number of flagged bytes in each document."""
        return count_between(flags, self.offsets)


def count_between(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return np.diff(total[offsets])


def slices(texts: pa.Array | pa.ChunkedArray, limit: int = SLICE) -> Iterator[Slice]:
    """Cut a column of texts (null counts as empty) into slices of whole documents."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    n = len(texts)
    if not n:
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + n + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), n)
        yield Slice(first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


@dataclass
class Words:
    """Words of a slice: byte spans, hashes and the index of each document's first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def doc_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def text(self, i: int) -> bytes:
        return self.data[self.starts[i] : self.ends[i]].tobytes()


def split_words(data: np.ndarray, offsets: np.ndarray) -> Words:
    solid = ~SPACE[data]
    left, right = np.empty(len(data), bool), np.empty(len(data), bool)
    if len(data):
        left[0] = right[-1] = True
        left[1:] = ~solid[:-1]
        right[:-1] = ~solid[1:]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        left[inner] = True
        right[inner - 1] = True
    starts = np.flatnonzero(solid & left)
    ends = np.flatnonzero(solid & right) + 1
    return Words(data, starts, ends, runs_hash(data[solid], ends - starts), np.searchsorted(starts, offsets))


def window_hashes(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every ``k``-word window inside a document, and its first word's index."""
    n = len(hashes)
    if n < k:
        return np.zeros(0, U), np.zeros(0, np.int64)
    total = hashes[: n - k + 1] * _STEP[0]
    for j in range(1, k):
        total = total + hashes[j : n - k + 1 + j] * _STEP[j]
    end = np.repeat(first[1:], np.diff(first))[: n - k + 1]
    at = np.flatnonzero(np.arange(n - k + 1) + k <= end)
    return mix(total[at]), at


def unique_words(words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes, the index of one word of each, and each word's place among them."""
    return np.unique(words.hashes, return_index=True, return_inverse=True)


def ragged(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``values[s:s+n]`` of all pairs, one after another."""
    total = int(lengths.sum())
    if not total:
        return values[:0]
    shift = starts - (np.cumsum(lengths) - lengths)
    return values[np.arange(total) + np.repeat(shift, lengths)]


def task(fn: Callable, *args) -> Callable:
    """``fn(batches, *args)`` for ``mapInArrow``; workers look in this package's folder too."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    module, name = fn.__module__, fn.__name__

    def run(batches):
        import importlib
        import sys as worker_sys

        if root not in worker_sys.path:
            worker_sys.path.append(root)
        return getattr(importlib.import_module(module), name)(batches, *args)

    return run


def table_task(fn: Callable, *args) -> Callable:
    """``fn(table, *args)`` for ``applyInArrow`` on groups."""
    call = task(fn, *args)

    def run(table):
        return call(table)

    return run


def pair_task(fn: Callable, *args) -> Callable:
    """``fn(left, right, *args)`` for ``applyInArrow`` on two grouped frames."""
    call = task(_both, fn.__module__, fn.__name__, args)

    def run(left, right):
        return call((left, right))

    return run


def _both(tables, module: str, name: str, args: tuple):
    import importlib

    return getattr(importlib.import_module(module), name)(*tables, *args)


assert sys.byteorder == "little"
