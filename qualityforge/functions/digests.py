"""Keyed uniforms of many rows at once: MD5 over arrays of short texts.

A draw's text is a constant head, the key and a constant tail, so that for keys of
one length all texts have one layout, and a step of MD5 is a few array operations.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa

_TURNS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
# The first word of the state is ready after this many of the 64 steps.
_STEPS = 61
# Texts of at most so many bytes fill one block.
_BLOCK = 55
# Rows hashed together, so that steps outweigh calls and arrays stay in the cache.
_ROWS = 16384


def _first_words(words: Sequence, n: int) -> np.ndarray:
    """First digest word of ``n`` blocks, given as 16 arrays or common numbers."""
    a, b, c, d = (np.full(n, x, np.uint32) for x in _START)
    f, t = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(_STEPS):
        kind = i >> 4
        if kind == 0:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif kind == 1:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif kind == 2:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
        word = words[((i, 5 * i + 1, 3 * i + 5, 7 * i)[kind]) & 15]
        f += a
        if isinstance(word, int):
            f += np.uint32((word + _SINES[i]) & 0xFFFFFFFF)
        else:
            f += word
            f += np.uint32(_SINES[i])
        turn = _TURNS[kind][i & 3]
        np.left_shift(f, np.uint32(turn), out=t)
        f >>= np.uint32(32 - turn)
        f |= t
        f += b
        a, b, c, d, f = d, f, b, c, a
    return b + np.uint32(_START[0])


def _words(head: bytes, key: np.ndarray, tail: bytes) -> list:
    """The words of the padded texts; ``key`` has a row per byte."""
    at, size = len(head), len(head) + len(key) + len(tail)
    block = head + bytes(len(key)) + tail + b"\x80" + bytes(_BLOCK - size) + (8 * size).to_bytes(8, "little")
    words: list = [int.from_bytes(block[i : i + 4], "little") for i in range(0, 64, 4)]
    for i, byte in enumerate(key, at):
        words[i >> 2] = byte << np.uint32(8 * (i & 3)) | np.uint32(words[i >> 2]) if isinstance(words[i >> 2], int) else words[i >> 2] | byte << np.uint32(8 * (i & 3))
    return words


def _numbers(head: bytes, key: np.ndarray, tail: bytes) -> np.ndarray:
    """The first 32 bits of the MD5 of every text, as doubles."""
    if len(head) + len(key) + len(tail) > _BLOCK:
        texts = (head + column.tobytes() + tail for column in key.T.astype(np.uint8))
        return np.array([int.from_bytes(hashlib.md5(text).digest()[:4], "big") for text in texts], np.float64)
    return _first_words(_words(head, key, tail), key.shape[1]).byteswap().astype(np.float64)


def uniforms(keys: pa.Array, frames: Sequence[tuple[str, str]]) -> pa.Array:
    """For every key the uniforms of all ``frames`` (text before and behind the key), as a list."""
    keys = keys.cast(pa.large_binary())
    begin = np.frombuffer(keys.buffers()[1], np.int64)[keys.offset : keys.offset + len(keys) + 1]
    data = np.frombuffer(keys.buffers()[2] or b"", np.uint8)
    size = np.diff(begin)
    out = np.empty((len(keys), len(frames)))
    for length in np.unique(size).tolist():
        rows = np.flatnonzero(size == length)
        for first in range(0, len(rows), _ROWS):
            part = rows[first : first + _ROWS]
            key = data[begin[part] + np.arange(length)[:, None]].astype(np.uint32)
            for i, (head, tail) in enumerate(frames):
                out[part, i] = (_numbers(head.encode(), key, tail.encode()) + 0.5) / 2.0**32
    ends = np.arange(len(keys) + 1, dtype=np.int32) * len(frames)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))
