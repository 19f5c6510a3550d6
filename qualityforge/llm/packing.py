"""Best-fit packing of documents into sequences, with conflicts.

A bin holds at most ``capacity`` tokens, and no two documents of one source or of
one duplicate cluster. Documents are dealt by hash into shards of about
``SHARD_DOCS``, so hot sources spread evenly and a task's memory is bounded;
each shard packs its documents from the largest to the smallest.

Bins are ordered by what is left of them. For a piece, the search starts at the
smallest residual that fits and goes on to its successors until a bin's bitmaps
of sources and clusters have no bit in common with the piece: the tightest
compatible bin. Bins of equal residual and equal bitmaps are checked once.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualityforge import runtime
from qualityforge.llm.staging import staged

CAPACITY = 2048
SHARD_DOCS = 2048


class Bins:
    """Open bins by residual, then by bitmaps."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.residuals: list[int] = []
        self.open: dict[int, dict[tuple[int, int], list[int]]] = {}
        self.count = 0

    def _put(self, bin_id: int, residual: int, sources: int, clusters: int) -> None:
        if residual <= 0:
            return
        if residual not in self.open:
            insort(self.residuals, residual)
            self.open[residual] = {}
        self.open[residual].setdefault((sources, clusters), []).append(bin_id)

    def _take(self, residual: int, bitmaps: tuple[int, int]) -> int:
        """The longest waiting of equal bins."""
        same = self.open[residual]
        bin_id = same[bitmaps].pop(0)
        if not same[bitmaps]:
            del same[bitmaps]
            if not same:
                del self.open[residual]
                del self.residuals[bisect_left(self.residuals, residual)]
        return bin_id

    def add(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Place a piece; its bin and the tokens before it there."""
        for at in range(bisect_left(self.residuals, size), len(self.residuals)):
            residual = self.residuals[at]
            for bitmaps in self.open[residual]:
                if not bitmaps[0] & source and not bitmaps[1] & cluster:
                    bin_id = self._take(residual, bitmaps)
                    self._put(bin_id, residual - size, bitmaps[0] | source, bitmaps[1] | cluster)
                    return bin_id, self.capacity - residual
        self.count += 1
        self._put(self.count - 1, self.capacity - size, source, cluster)
        return self.count - 1, 0


def pack_shard(sizes: Sequence[int], sources: Sequence[int], clusters: Sequence[int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """(document, piece, start, tokens, bin, offset) for documents in the order given.

    A document longer than a bin first fills bins of its own; its rest is packed
    like any other, largest pieces first. Cluster -1 means no duplicate in the shard.
    """
    bins, out, rests = Bins(capacity), [], []
    for doc, size in enumerate(sizes):
        whole = size // capacity
        for piece in range(whole):
            out.append((doc, piece, piece * capacity, capacity, bins.count, 0))
            bins.count += 1
        if size % capacity:
            rests.append((-(size % capacity), doc, whole))
    for negative, doc, piece in sorted(rests):
        cluster = 1 << clusters[doc] if clusters[doc] >= 0 else 0
        bin_id, offset = bins.add(-negative, 1 << sources[doc], cluster)
        out.append((doc, piece, piece * capacity, -negative, bin_id, offset))
    return out


_OUT = "_key bigint, piece int, start bigint, n_tokens bigint, bin_id bigint, offset bigint"


def _packer(capacity: int):
    def shard(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["_key", "_source", "_cluster", "n_tokens"], kind="stable", na_position="first")
        sources = pd.factorize(part["_source"])[0]
        names, of = np.unique(part["_cluster"].to_numpy(str), return_inverse=True)
        repeated = np.bincount(of, minlength=len(names)) > 1
        number = np.where(repeated, np.cumsum(repeated) - 1, -1)[of]
        rows = pack_shard(part["n_tokens"].tolist(), sources.tolist(), number.tolist(), capacity)
        doc, piece, start, size, bin_id, offset = np.array(rows, np.int64).reshape(-1, 6).T
        return pd.DataFrame(
            {
                "_key": part["_key"].to_numpy()[doc],
                "piece": piece.astype(np.int32),
                "start": start,
                "n_tokens": size,
                "bin_id": (int(part["_shard"].iloc[0]) << 32) + bin_id,
                "offset": offset,
            }
        )

    return shard


def dealt(rows: DataFrame, shard_docs: int) -> DataFrame:
    """Add ``_shard``: shards of about ``shard_docs`` rows by hash of ``_key``.

    Rows without a key, and those of a key that alone would fill a shard, are dealt one by
    one instead, so no key decides how much one task packs.
    """
    shards = max(1, -(-rows.count() // shard_docs))
    counts = rows.groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).filter((F.col("_n") >= shard_docs) | F.col("_key").isNull())
    hot = runtime.checked_broadcast(runtime.pin(counts.select(F.col("_key").alias("_hot"), F.lit(True).alias("_alone"))))
    told = rows.withColumn("_row", F.monotonically_increasing_id()).join(hot, F.col("_key").eqNullSafe(F.col("_hot")), "left")
    by = F.when(F.col("_alone"), F.xxhash64("_row", F.lit(11))).otherwise(F.xxhash64("_key", F.lit(11)))
    return told.withColumn("_shard", F.pmod(by, F.lit(shards))).drop("_row", "_hot", "_alone")


def pack_documents(
    docs: DataFrame, capacity: int = CAPACITY, shard_docs: int = SHARD_DOCS, key: str = "doc_id", source: str = "source", cluster: str = "cluster", tokens: str = "n_tokens"
) -> DataFrame:
    """(key, piece, start, n_tokens, bin_id, offset): which tokens of a document lie where in which bin.

    Documents without tokens get one row with no bin. Null sources are one
    source, null clusters are in no cluster, null tokens count as 0. Rows that
    repeat a key are documents of their own. A null key stays null. A shard holds about
    ``shard_docs`` rows, whatever their keys. Other columns are not read; an empty table gives no
    rows. Ties in size go by key.
    """
    if capacity < 1:
        raise ValueError("a bin holds at least one token")
    rows = docs.select(
        F.col(key).cast("bigint").alias("_key"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_source"),
        F.coalesce(F.col(cluster).cast("string"), F.concat(F.lit("alone:"), F.coalesce(F.col(key).cast("string"), F.uuid()))).alias("_cluster"),
        F.coalesce(F.col(tokens), F.lit(0)).cast("bigint").alias("n_tokens"),
    )
    # Sizes are counted once, and a lost executor finds the same rows again.
    rows = staged(rows, "packing-rows")
    packed = dealt(rows.filter("n_tokens > 0"), shard_docs).groupBy("_shard").applyInPandas(_packer(capacity), _OUT)
    empty = rows.filter("n_tokens <= 0").selectExpr(
        "_key", "0 as piece", "0L as start", "0L as n_tokens", "cast(null as bigint) as bin_id", "cast(null as bigint) as offset"
    )
    return packed.unionByName(empty).withColumnRenamed("_key", key)
