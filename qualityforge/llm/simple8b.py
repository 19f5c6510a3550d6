"""Token ids in Simple-8b blocks, written and read by Spark.

A block holds ``BLOCK`` ids (the last of a segment fewer) in 64-bit words. The low
four bits of a word are its selector: 1 to 14 say how many ids of what width fill
the other 60 bits, 0 is an escape for an id of more than 60 bits, whose value
stands in the segment's list of escapes. Words are little-endian; the index of
every block's first word makes blocks independent, so all are packed and
unpacked side by side.

A table row is one segment: consecutive documents in key order, their keys and
lengths, words, block index and escapes. ``part`` numbers the ranges of keys,
``rel`` is the number of ids of the same part before the segment.
"""

from __future__ import annotations

import os
import zlib

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from qualityforge import runtime
from qualityforge.llm import kernel as K
from qualityforge.llm.wordcache import WordCache

BLOCK = 256
ESCAPE = 0
# Ids per word and bits per id, of selectors 1 to 14.
COUNT = np.array([0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTH = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
_TAKES = np.maximum(COUNT, 1)
_U4, _U1 = np.uint64(4), np.uint64(1)


_NARROWEST = np.searchsorted(WIDTH[1:], np.maximum(np.arange(65), 1)).astype(np.uint8) + 1
_SMALL = _NARROWEST[np.frexp(np.arange(1 << 16, dtype=np.float64))[1]]


def _narrowest(ids: np.ndarray) -> np.ndarray:
    """The first selector wide enough for each id; 15 if none is."""
    if ids.max() < 1 << 16:
        return _SMALL[ids]
    # Rounding to double may add a bit, which only costs room.
    return _NARROWEST[np.minimum(np.frexp(ids.astype(np.float64))[1], 64)]


def _choose(ids: np.ndarray) -> np.ndarray:
    """For every place the selector that packs most ids from there on, in rows of one block."""
    rows = -(-len(ids) // BLOCK)
    need = np.zeros((rows, BLOCK + int(COUNT.max())), np.uint8)
    flat = np.zeros(rows * BLOCK, np.uint8)
    flat[: len(ids)] = _narrowest(ids)
    need[:, :BLOCK] = flat.reshape(rows, BLOCK)
    # Widest need of the next c ids, by doubling; past the block's end nothing is needed.
    power, size, powers = need, 1, {1: need}
    while 2 * size <= COUNT.max():
        power = np.maximum(power[:, :-size], power[:, size:])
        size *= 2
        powers[size] = power
    chosen = np.where(need[:, :BLOCK] <= 14, 14, ESCAPE).astype(np.uint8)
    for selector in range(13, 0, -1):
        count = int(COUNT[selector])
        half = 1 << (count.bit_length() - 1)
        widest = np.maximum(powers[half][:, :BLOCK], powers[half][:, count - half : count - half + BLOCK])
        chosen[widest <= selector] = selector
    return chosen.ravel()[: len(ids)]


def pack(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, index of every block's first word, escapes) of unsigned 64-bit ids."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint64)
    chosen = _choose(ids)
    begin = np.arange(0, n, BLOCK)
    stop = np.minimum(begin + BLOCK, n)
    leads = np.zeros(n, bool)
    at = begin
    while len(at):
        leads[at] = True
        at = at + _TAKES[chosen[at]]
        live = at < stop
        at, stop = at[live], stop[live]
    place = np.flatnonzero(leads)
    selector = chosen[place]
    take = np.diff(np.append(place, n))
    words = selector.astype(np.uint64)
    for s in np.unique(selector):
        if s == ESCAPE:
            continue
        which = np.flatnonzero(selector == s)
        value = np.zeros(len(which), np.uint64)
        for j in range(int(COUNT[s])):
            inside = take[which] > j
            if inside.all():
                value |= ids[place[which] + j] << np.uint64(WIDTH[s] * j)
            else:
                value[inside] |= ids[place[which[inside]] + j] << np.uint64(WIDTH[s] * j)
        words[which] |= value << _U4
    return words, np.searchsorted(place, begin).astype(np.uint32), ids[place[selector == ESCAPE]]


def unpack(words: np.ndarray, blocks: np.ndarray, escapes: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` ids of a segment."""
    out = np.zeros(n, np.uint64)
    if not n:
        return out
    selector = (words & np.uint64(15)).astype(np.int64)
    holds = np.where(selector == ESCAPE, 1, COUNT[np.minimum(selector, 14)])
    before = np.cumsum(holds) - holds
    block = np.repeat(np.arange(len(blocks)), np.diff(np.append(blocks.astype(np.int64), len(words))))
    begin = block * BLOCK + before - before[blocks.astype(np.int64)][block]
    end = np.minimum((block + 1) * BLOCK, n)
    out[begin[selector == ESCAPE]] = escapes
    payload = words >> _U4
    for s in np.unique(selector):
        if s == ESCAPE:
            continue
        which = np.flatnonzero(selector == s)
        mask = (_U1 << np.uint64(WIDTH[s])) - _U1
        for j in range(int(COUNT[s])):
            inside = which[begin[which] + j < end[which]]
            if not len(inside):
                break
            out[begin[inside] + j] = (payload[inside] >> np.uint64(WIDTH[s] * j)) & mask
    return out


# A word that is letters followed by closing marks splits between the two.
_LETTERS_THEN_MARKS = regex.compile(r"(\p{L}+)([.,;:!?*$%&#|()\-\"]*)")


class _Tokenizer:
    """Ids by word, from a tokenizer that never joins across blanks.

    Equal words are encoded once. Plain letter runs are encoded many to a call
    and cut after each word-final token; when their number disagrees, and for
    all other words, each is encoded on its own.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        vocabulary = self.encoder.get_vocab(with_added_tokens=True)
        self.final = np.zeros(max(vocabulary.values()) + 1, bool)
        self.final[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.cache = WordCache(self._place)
        self._reset()

    def _reset(self):
        self.pool, self.used = np.zeros(1 << 20, np.uint32), 0
        self.cache.clear()

    def _singly(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.encoder.encode_batch_fast(texts, add_special_tokens=False)]

    def _runs(self, runs: list[str], many: int = 2000) -> list[list[int]]:
        out = []
        for i in range(0, len(runs), many):
            part = runs[i : i + many]
            ids = np.array(self._singly([" ".join(part)])[0], np.int64)
            cuts = np.flatnonzero(self.final[ids]) + 1
            if len(cuts) == len(part) and cuts[-1] == len(ids):
                out += np.split(ids, cuts[:-1])
            else:
                out += self._singly(part)
        return out

    def _place(self, words: list[bytes]) -> np.ndarray:
        """Store the ids of new words; their begin and number in the pool."""
        runs: dict[str, int] = {}
        rest: dict[str, int] = {}
        parts = []
        for word in words:
            text = word.lower().decode("utf-8")
            found = _LETTERS_THEN_MARKS.fullmatch(text)
            if found:
                run, marks = found.groups()
                parts.append((runs.setdefault(run, len(runs)), rest.setdefault(marks, len(rest)) if marks else -1))
            else:
                parts.append((-1, rest.setdefault(word.decode("utf-8"), len(rest))))
        of_run, of_rest = self._runs(list(runs)), self._singly(list(rest))
        of_run, of_rest = [np.asarray(x, np.uint32) for x in of_run], [np.asarray(x, np.uint32) for x in of_rest]
        sizes = np.array([(len(of_run[a]) if a >= 0 else 0) + (len(of_rest[b]) if b >= 0 else 0) for a, b in parts], np.int64)
        pieces = [x for a, b in parts for x in ((of_run[a],) if a >= 0 else ()) + ((of_rest[b],) if b >= 0 else ())]
        flat = np.concatenate(pieces) if pieces else np.zeros(0, np.uint32)
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(max(len(self.pool), len(flat)), np.uint32)])
        self.pool[self.used : self.used + len(flat)] = flat
        begin = self.used + np.cumsum(sizes) - sizes
        self.used += len(flat)
        return np.column_stack([begin, sizes])

    def encode(self, s: K.Slice) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents of a slice, and how many each has."""
        if len(self.cache.hashes) > self.cache.limit:
            self._reset()
        words = K.split_words(s.data, s.offsets)
        spans = self.cache.values(words)
        total = np.concatenate([[0], np.cumsum(spans[:, 1])])
        return K.ragged(self.pool, spans[:, 0], spans[:, 1]), np.diff(total[words.first])


_OPEN: dict[str, _Tokenizer] = {}


def _tokenizer(path: str) -> _Tokenizer:
    if path not in _OPEN:
        _OPEN[path] = _Tokenizer(path)
    return _OPEN[path]


def with_end(ids: np.ndarray, sizes: np.ndarray, end_id: int) -> np.ndarray:
    """Append ``end_id`` to every document."""
    return np.insert(ids, np.cumsum(sizes), end_id)


def _encode(batches, path: str, end_id: int):
    from pyspark import TaskContext

    part, rel, segment = TaskContext.get().partitionId(), 0, 0
    tokenizer = _tokenizer(path)
    for batch in batches:
        for s in K.slices(batch.column("text")):
            ids, sizes = tokenizer.encode(s)
            ids, sizes = with_end(ids, sizes, end_id), sizes + 1
            words, blocks, escapes = pack(ids)
            keys = batch.column("key").slice(s.first, s.last - s.first)
            offsets = pa.array([0, len(keys)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part], pa.int32()),
                    pa.array([segment], pa.int32()),
                    pa.array([rel], pa.int64()),
                    pa.array([len(ids)], pa.int64()),
                    pa.ListArray.from_arrays(offsets, keys.combine_chunks() if isinstance(keys, pa.ChunkedArray) else pa.concat_arrays([keys])),
                    pa.ListArray.from_arrays(offsets, pa.array(sizes, pa.int64())),
                    pa.array([words.tobytes()], pa.binary()),
                    pa.array([blocks.tobytes()], pa.binary()),
                    pa.array([escapes.tobytes()], pa.binary()),
                ],
                names=["part", "segment", "rel", "n_ids", "keys", "lengths", "words", "blocks", "escapes"],
            )
            rel += len(ids)
            segment += 1


_SCHEMA = "part int, segment int, rel bigint, n_ids bigint, keys array<bigint>, lengths array<bigint>, words binary, blocks binary, escapes binary"


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> None:
    """Encode whole texts in ascending key order and write them as segments.

    ``tokenizer`` is the path of its file on every worker. Null text counts as
    empty and has the end id only; null keys come first; rows that repeat a key
    follow one another. Only ranges of keys are shuffled, so a hot value of any
    other column changes nothing.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.repartitionByRange(parts, "key").sortWithinPartitions("key")
    ordered.mapInArrow(K.task(_encode, tokenizer, end_id), _SCHEMA).write.option("compression", "none").parquet(folder)


def _decode(batches):
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(
                np.frombuffer(row["words"], np.uint64), np.frombuffer(row["blocks"], np.uint32), np.frombuffer(row["escapes"], np.uint64), row["n_ids"]
            ).astype("<u4")
            sizes = np.array(row["lengths"], np.int64)
            begin = np.cumsum(sizes) - sizes
            raw = memoryview(ids).cast("B")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["keys"], pa.int64()),
                    pa.array(row["base"] + row["rel"] + begin),
                    pa.array(sizes),
                    pa.array([zlib.crc32(raw[4 * a : 4 * (a + n)]) for a, n in zip(begin.tolist(), sizes.tolist())], pa.int64()),
                ],
                names=["key", "start", "n_tokens", "ids_crc32"],
            )


def read_ids(spark, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every document, from the written segments."""
    segments = spark.read.schema(_SCHEMA).parquet(folder)
    sizes = segments.groupBy("part").agg(F.sum("n_ids").alias("n"))
    base = sizes.select("part", (F.sum("n").over(W.orderBy("part")) - F.col("n")).alias("base"))
    # One row per written range of keys.
    placed = segments.join(F.broadcast(base), "part")
    return placed.mapInArrow(K.task(_decode), "key bigint, start bigint, n_tokens bigint, ids_crc32 bigint").withColumnRenamed("key", key)


def token_table(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write to the shared folder and read back."""
    folder = runtime.scratch_path(docs.sparkSession, "token-ids")
    write_ids(docs, folder, tokenizer, end_id, key, text)
    return read_ids(docs.sparkSession, folder, key)
