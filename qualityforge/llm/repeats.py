"""Passages that occur twice: run-length indexes over the windows that can repeat.

A window of LENGTH bytes repeats if it starts anywhere else as well. Every window is
named after the least hash among its ANCHOR-byte substrings, so equal windows have one
name; consecutive windows named after the same place form a stretch. Names that occur once are done with
after one count. Equal stretches are merged, those met twice repeat whole; different
stretches of a name go to an index (`runindex`), a bounded number of bytes at a time,
whose matching statistics tell which windows match. A name with more bytes of
different stretches than one index may hold has its windows counted by digest instead:
the same answer, with nothing that grows in one task.

Texts are written once, bucketed by slabs of consecutive documents, and every later step
over them brings its few numbers to the slabs, so that texts are not shuffled.
"""

from __future__ import annotations

import hashlib
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualityforge import runtime
from qualityforge.llm import kernel as K
from qualityforge.llm import runindex
from qualityforge.llm.staging import staged

LENGTH, ANCHOR = 200, 100
# Bytes of texts in a slab, of stretches in an index, and of the different stretches
# of one name that still go to an index.
SLAB, INDEX, HOT = 16 << 20, 1 << 18, 1 << 20

U = np.uint64
_BYTE = K.mix(np.arange(1, 257, dtype=U) * U(0xA0761D6478BD642F))
_BASE = 0x9E3779B97F4A7C15
_powers: list[np.ndarray] = [np.ones(1, U), np.ones(1, U)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2 ** 64."""
    if len(_powers[0]) < n:
        for i, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            steps = np.full(n, base, U)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(values)
    rows = np.append(values, np.full(-n % width, np.iinfo(values.dtype).max, values.dtype)).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def stretches(s: K.Slice, length: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(per document, windows, name): how many stretches each document of a slice has, and
    for each one its number of windows and its name. A stretch ends where the first
    substring with the least hash leaves the window, so no two of its windows are equal."""
    sizes = np.diff(s.offsets)
    windows = np.maximum(sizes - length + 1, 0)
    if not windows.any():
        return np.zeros(len(sizes), np.int64), np.zeros(0, np.int64), np.zeros(0, U)
    n = len(s.data)
    up, down = _power_tables(n + 1)
    total = np.append(U(0), np.cumsum(_BYTE[s.data] * up[:n], dtype=U))
    hashes = K.mix((total[anchor:] - total[:-anchor]) * down[: n - anchor + 1])
    least = sliding_min(hashes, length - anchor + 1)
    # The least substring is the window's first one.
    leaves = K.ragged(least == hashes[: len(least)], s.offsets[:-1], windows)
    least = K.ragged(least, s.offsets[:-1], windows)
    doc = np.repeat(np.arange(len(sizes)), windows)
    fresh = np.ones(len(least), bool)
    fresh[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | leaves[:-1]
    at = np.flatnonzero(fresh)
    return np.bincount(doc[at], minlength=len(sizes)), np.diff(np.append(at, len(least))), least[at]


# ---------------------------------------------------------------- inside tasks


def _scan(batches, length: int, anchor: int, slab: int):
    """Documents with their slab, place and stretches."""
    from pyspark import TaskContext

    number, filled, idx = TaskContext.get().partitionId() << 24, 0, 0
    for batch in batches:
        for s in K.slices(batch.column("text")):
            per, windows, names = stretches(s, length, anchor)
            ends, m = pa.array(np.append(0, np.cumsum(per)), pa.int32()), s.last - s.first
            rows = batch.slice(s.first, m)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(m, number), pa.int64()),
                    pa.array(np.arange(idx, idx + m), pa.int32()),
                    rows.column("key"),
                    rows.column("text"),
                    pa.ListArray.from_arrays(ends, pa.array(windows, pa.int32())),
                    pa.ListArray.from_arrays(ends, pa.array(names.view(np.int64))),
                ],
                names=["slab", "idx", "key", "text", "windows", "names"],
            )
            filled, idx = filled + len(s.data), idx + m
            if filled >= slab:
                number, filled, idx = number + 1, 0, 0


class _Texts:
    """Documents of a slab: one buffer with their bytes and the row of each document's number."""

    def __init__(self, table: pa.Table):
        self.table = table
        n = table.num_rows
        chunks = table.column("text").chunks
        texts = chunks[0] if len(chunks) == 1 else pa.concat_arrays(chunks) if chunks else pa.array([], pa.binary())
        self.offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
        self.raw = memoryview(texts.buffers()[2]) if n and texts.buffers()[2] is not None else memoryview(b"")
        self.row = np.empty(n, np.int64)
        self.row[table.column("idx").to_numpy()] = np.arange(n)

    def bytes(self, rows: np.ndarray, low: np.ndarray, size: np.ndarray):
        begin = self.offsets[rows] + low
        return [self.raw[b : b + n] for b, n in zip(begin.tolist(), size.tolist())]


def _numbers(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(c).to_numpy() for c in names]


_STRETCHES = pa.schema([("slab", pa.int64()), ("idx", pa.int32()), ("low", pa.int64()), ("windows", pa.int32()), ("name", pa.int64()), ("digest", pa.int64())])


def _name_stretches(texts: pa.Table, hits: pa.Table, length: int) -> pa.Table:
    """Digest every stretch whose name occurs again."""
    idx, nth = _numbers(hits, "idx", "nth")
    if not len(idx):
        return _STRETCHES.empty_table()
    docs = _Texts(texts)
    per = texts.column("windows").combine_chunks()
    counts = pc.list_value_length(per).to_numpy(zero_copy_only=False)
    windows = pc.list_flatten(per).to_numpy(zero_copy_only=False).astype(np.int64)
    names = pc.list_flatten(texts.column("names").combine_chunks()).to_numpy(zero_copy_only=False)
    rows, first = docs.row[idx], np.cumsum(counts) - counts
    low = np.cumsum(windows) - windows
    at = first[rows] + nth
    n, begin = windows[at], low[at] - low[first[rows]]
    digests = [hashlib.blake2b(b, digest_size=8).digest() for b in docs.bytes(rows, begin, n + length - 1)]
    columns = [hits.column("slab"), idx, begin, n, names[at], np.frombuffer(b"".join(digests), "<i8")]
    return pa.table([c if isinstance(c, pa.ChunkedArray) else pa.array(c, t) for c, t in zip(columns, _STRETCHES.types)], schema=_STRETCHES)


def _cut(texts: pa.Table, wanted: pa.Table, length: int) -> pa.Table:
    """The bytes of stretches."""
    idx, low, n = _numbers(wanted, "idx", "low", "windows")
    docs = _Texts(texts)
    pieces = [bytes(b) for b in docs.bytes(docs.row[idx], low, n + length - 1)]
    return pa.table({"name": wanted.column("name"), "digest": wanted.column("digest"), "piece": pa.array(pieces, pa.binary())})


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last place of every run of set flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edges[::2], edges[1::2] - 1


def _indexed(pieces: pa.Table, length: int) -> pa.Table:
    """Windows of different stretches that match elsewhere among them: (name, digest, first, last)."""
    index = runindex.build(pieces.column("piece").to_pylist())
    first, last = _runs(runindex.matching_statistics(index, length) >= length)
    # A match ends with its string, and so does a run of them.
    owner = np.searchsorted(index.starts, first, "right") - 1
    shift = index.starts[owner]
    return pa.table(
        {
            "name": pieces.column("name").take(pa.array(owner)),
            "digest": pieces.column("digest").take(pa.array(owner)),
            "first": pa.array(first - shift, pa.int32()),
            "last": pa.array(last - shift, pa.int32()),
        }
    )


def _windows(batches, length: int):
    """Digests of all windows of stretches."""
    for batch in batches:
        for name, digest, piece in zip(*[batch.column(c).to_pylist() for c in ("name", "digest", "piece")]):
            n = len(piece) - length + 1
            found = [hashlib.blake2b(piece[i : i + length], digest_size=16).digest() for i in range(n)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * n, pa.int64()), pa.array([digest] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(found, pa.binary())],
                names=["name", "digest", "first", "window"],
            )


def _removed(texts: pa.Table, spans: pa.Table) -> pa.Table:
    """Merge the spans of every document and keep the other bytes."""
    docs, n = _Texts(texts), texts.num_rows
    idx, begin, end = _numbers(spans, "idx", "begin", "end")
    owner = docs.row[idx]
    begin, end = docs.offsets[owner] + begin, docs.offsets[owner] + end
    by = np.argsort(begin)
    owner, begin, reach = owner[by], begin[by], np.maximum.accumulate(end[by])
    fresh = np.ones(len(by), bool)
    fresh[1:] = (begin[1:] > reach[:-1]) | (owner[1:] != owner[:-1])
    # A span reaches as far as the last one before the next that starts afresh.
    first, last, owner = begin[fresh], reach[np.append(fresh[1:], True)] if len(by) else begin, owner[fresh]
    sizes = np.diff(docs.offsets)
    gone = np.bincount(owner, last - first, minlength=n).astype(np.int64)
    # Between the spans of all documents lies what is kept.
    base, top = int(docs.offsets[0]), int(docs.offsets[-1])
    kept = b"".join([docs.raw[a:b] for a, b in zip([base, *last.tolist()], [*first.tolist(), top])])
    left = pa.py_buffer(np.append(0, np.cumsum(sizes - gone)).astype(np.int32))
    shift = docs.offsets[owner]
    ends = pa.array(np.append(0, np.cumsum(np.bincount(owner, minlength=n))), pa.int32())
    pairs = pa.StructArray.from_arrays([pa.array(first - shift, pa.int64()), pa.array(last - shift, pa.int64())], names=["begin", "end"])
    return pa.table(
        {
            "key": texts.column("key"),
            "n_bytes": pa.array(sizes, pa.int64()),
            "n_removed": pa.array(gone, pa.int64()),
            "spans": pa.ListArray.from_arrays(ends, pairs),
            "kept": pa.Array.from_buffers(pa.binary(), n, [None, left, pa.py_buffer(kept)]),
        }
    )


# ------------------------------------------------------------------ on the cluster


def _with_slabs(texts: DataFrame, rows: DataFrame, fn, schema: str, *args) -> DataFrame:
    """``fn(texts, rows)`` for every slab; only ``rows`` are shuffled."""
    # Columns of their own, as the rows stem from the same texts.
    rows = rows.select(*[F.col(c).alias(c) for c in rows.columns])
    return texts.groupBy("slab").cogroup(rows.groupBy("slab")).applyInArrow(K.pair_task(fn, *args), schema)


def write_slabs(docs: DataFrame, key: str, text: str, length: int, anchor: int, slab: int = SLAB) -> DataFrame:
    """Documents with their stretches, bucketed by slab in the shared folder.

    Rows get a slab and a place in it, so keys need not be unique or present.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("text"))
    schema = f"slab bigint, idx int, key {rows.schema['key'].dataType.simpleString()}, text binary, windows array<int>, names array<bigint>"
    found = rows.mapInArrow(K.task(_scan, length, anchor, slab), schema)
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(rows.rdd.getNumPartitions(), 20_000))
    name = f"text_slabs_{uuid.uuid4().hex}"
    path = runtime.scratch_path(spark, "text-slabs")
    found.write.option("path", path).option("compression", "zstd").bucketBy(buckets, "slab").saveAsTable(name)
    return spark.table(name)


def repeated_windows(texts: DataFrame, length: int, index: int = INDEX, hot: int = HOT) -> DataFrame:
    """(slab, idx, begin, end): bytes covered by repeated windows; spans may overlap."""
    spark = texts.sparkSession
    each = texts.select("slab", "idx", F.posexplode("names").alias("nth", "name"))
    # Written first: a join of two shuffled sides splits hot names, one that shares the
    # count's shuffle does not.
    again = staged(each.groupBy("name").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("name"), "stretch-again")
    hits = each.join(again, "name", "left_semi").select("slab", "idx", "nth")
    found = _with_slabs(texts, hits, _name_stretches, "slab bigint, idx int, low bigint, windows int, name bigint, digest bigint", length)
    found = staged(found, "stretches")

    # Equal stretches as one, with the first of them.
    place = F.struct("slab", "idx", "low", "windows")
    distinct = staged(found.groupBy("name", "digest").agg(F.count(F.lit(1)).alias("c"), F.min(place).alias("at")), "stretch-kinds")
    whole = distinct.filter("c > 1").select("name", "digest", F.lit(0).alias("first"), (F.col("at.windows") - 1).alias("last"))
    size = F.sum(F.col("at.windows") + (length - 1)).alias("bytes")
    names = staged(distinct.groupBy("name").agg(F.count(F.lit(1)).alias("kinds"), size).filter("kinds > 1"), "stretch-names")
    total = names.filter(F.col("bytes") <= hot).agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    several = distinct.join(names.select("name", (F.col("bytes") > hot).alias("hot")), "name").select("at.*", "name", "digest", "hot")

    def cut(rows: DataFrame) -> DataFrame:
        return _with_slabs(texts, rows.drop("hot"), _cut, "name bigint, digest bigint, piece binary", length)

    marks = "name bigint, digest bigint, first int, last int"
    pieces = cut(several.filter("not hot")).withColumn("bucket", F.pmod(F.xxhash64("name"), F.lit(total // index + 1)))
    indexed = pieces.groupBy("bucket").applyInArrow(K.table_task(_indexed, length), marks)
    every = whole.unionByName(indexed)
    if not names.filter(F.col("bytes") > hot).isEmpty():
        windows = cut(several.filter("hot")).mapInArrow(K.task(_windows, length), "name bigint, digest bigint, first int, window binary")
        windows = staged(windows, "stretch-windows")
        twice = staged(windows.groupBy("window").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("window"), "windows-again")
        every = every.unionByName(windows.join(twice, "window", "left_semi").select("name", "digest", "first", F.col("first").alias("last")))
    every = staged(every, "stretch-marks")
    spans = found.join(every, ["name", "digest"])
    return spans.select("slab", "idx", (F.col("low") + F.col("first")).alias("begin"), (F.col("low") + F.col("last") + length).alias("end"))


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, anchor: int = ANCHOR, slab: int = SLAB, index: int = INDEX, hot: int = HOT
) -> DataFrame:
    """(key, n_bytes, n_removed, spans, kept) of every row.

    A byte of the UTF-8 text goes if a string of ``length`` bytes that covers it starts
    anywhere else too, in the same text or another one; strings are judged on the input
    and do not cross documents. ``spans`` are the maximal removed (begin, end) in
    bytes, ``kept`` the other bytes (binary, as a cut can fall inside a character).
    Null counts as empty; empty and short texts stay as they are. Keys may be null or
    repeat: every row is a document, and equal rows remove each other's passages. An
    empty table gives no rows; other columns are not read. ``anchor`` (below ``length``),
    ``slab``, ``index`` and ``hot`` steer the work and not the result.
    """
    if not 0 < anchor <= length:
        raise ValueError("an anchor lies inside a window")
    texts = write_slabs(docs, key, text, length, anchor, slab)
    spans = repeated_windows(texts, length, index, hot)
    kind = texts.schema["key"].dataType.simpleString()
    out = _with_slabs(texts.select("slab", "idx", "key", "text"), spans, _removed, f"key {kind}, n_bytes bigint, n_removed bigint, spans array<struct<begin:bigint,end:bigint>>, kept binary")
    return out.withColumnRenamed("key", key)
