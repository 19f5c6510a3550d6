"""Ordered scans inside groups that stay balanced when one group is huge.

Both scans (previous value, strict prefix maximum) are plain window functions
while every group fits a task: one shuffle and one sort on the group key. Groups
of at least ``Skew.rows`` rows are cut into consecutive buckets of the order
columns by Spark's own range partitioning, so the cuts follow the very order that
the window sorts by, whatever the types, collations, NULLs and time zones. The
window then runs per (group, bucket), and a carry from the preceding buckets,
computed on one row per bucket, closes the seams. Results are the same either way.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from qualityforge import runtime

# More buckets than this pay only where they would otherwise be hot themselves:
# each costs a task, a file and a row of carry.
MOST_BUCKETS = 256


@dataclass(frozen=True)
class Skew:
    """How hot groups are found: groups of at least ``rows`` rows are cut, into buckets of
    about half of that, or larger ones where these would be more than ``MOST_BUCKETS``.

    ``enabled=False`` skips the probe when group sizes are bounded by
    construction; ``known`` reuses an earlier probe (of the same or more rows).
    """

    enabled: bool = True
    rows: int = runtime.HOT_ROWS
    known: DataFrame | None = None

    def __post_init__(self):
        if self.rows < 2:
            raise ValueError("a task must be allowed two rows of a group")

    def probe(self, df: DataFrame, group: list[str]) -> DataFrame | None:
        """(h, n): hash and rows of each hot group; None if there is none."""
        if not self.enabled:
            return None
        if self.known is not None:
            return self.known
        hot = runtime.hot_groups(df, group, self.rows)
        return None if hot.isEmpty() else hot


@dataclass
class _Series:
    """Rows of ordinary groups, and rows of hot groups with their bucket ``__b``."""

    plain: DataFrame
    hot: DataFrame | None
    group: list[str]
    order: list[str]

    def window(self, *more: str):
        return W.partitionBy(*self.group, *more).orderBy(*self.order)

    @property
    def along(self):
        """The buckets of a group, one row each."""
        return W.partitionBy(*self.group).orderBy("__b")


def _buckets(n: int, rows: int) -> int:
    """Buckets for ``n`` rows of hot groups: of half of ``rows``, at most MOST_BUCKETS, but never
    of more than half of what is too heavy for one task."""
    wanted = math.ceil(2 * n / rows)
    return max(2, min(wanted, max(MOST_BUCKETS, math.ceil(2 * n / runtime.HOT_ROWS))))


def _series(df: DataFrame, group: list[str], order: list[str], value: str, skew: Skew) -> _Series:
    """Split ``df`` (plus ``__g*`` and ``__v``) into ordinary and hot groups.

    Buckets hold about half of ``skew.rows``, or more where `_buckets` says so; rows
    equal in all order columns share one. The bucketed rows are pinned, because range cuts come from a sample
    and must be the same for the rows and for their carry.
    """
    names = [f"__g{i}" for i in range(len(group))]
    df = df.select("*", *[F.expr(g).alias(n) for g, n in zip(group, names)], F.expr(value).alias("__v"))
    hot = skew.probe(df, names)
    if hot is None:
        return _Series(df, None, names, list(order))
    tagged = df.withColumn("__gh", F.xxhash64(*names))
    keys = runtime.checked_broadcast(hot.select(F.col("h").alias("__gh")))
    parts = _buckets(hot.agg(F.sum("n")).first()[0], skew.rows)
    heavy = tagged.join(keys, "__gh", "left_semi").repartitionByRange(parts, "__gh", *order)
    heavy = runtime.pin(heavy.withColumn("__b", F.spark_partition_id()))
    return _Series(tagged.join(keys, "__gh", "left_anti"), heavy, names, list(order))


def _attach_carry(rows: DataFrame, carry: DataFrame, s: _Series) -> DataFrame:
    """Left join of one carry row per hot bucket."""
    keys = [*s.group, "__b"]
    side = runtime.checked_broadcast(carry.select([F.col(k).alias(f"__r{k}") for k in keys] + ["__carry"]))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__r{k}"))
    return rows.join(side, same, "left")


def with_previous(
    df: DataFrame,
    group: list[str],
    order: list[str],
    value: str,
    out: str = "previous",
    skew: Skew = Skew(),
) -> DataFrame:
    """``df`` plus the value of the preceding row of its group (NULL for the first).

    ``order`` should end in a unique column: ties are otherwise arbitrary.
    """
    s = _series(df, group, order, value, skew)
    columns = [*df.columns, out]
    result = s.plain.withColumn(out, F.lag("__v").over(s.window())).select(*columns)
    if s.hot is None:
        return result
    w = s.window("__b")
    last = s.hot.withColumn("__more", F.lead(F.lit(True)).over(w)).filter("__more is null")
    carry = runtime.pin(last.withColumn("__carry", F.lag("__v").over(s.along)).select(*s.group, "__b", "__carry"))
    rows = s.hot.withColumn(out, F.lag("__v").over(w)).withColumn("__first", F.row_number().over(w) == 1)
    rows = _attach_carry(rows, carry, s).withColumn(out, F.when(F.col("__first"), F.col("__carry")).otherwise(F.col(out)))
    return result.unionByName(rows.select(*columns))


def not_increasing(
    df: DataFrame, group: list[str], order: list[str], value: str, skew: Skew = Skew()
) -> DataFrame:
    """Rows whose value does not exceed the preceding row's (NULL never counts)."""
    flagged = with_previous(df, group, order, value, "__prev", skew)
    return flagged.filter(F.expr(value) <= F.col("__prev")).drop("__prev")


def _peaks(rows: DataFrame, w) -> DataFrame:
    """Add the number of NULLs so far, and the highest (that number, value) before each row."""
    rows = rows.withColumn("__seg", F.count_if(F.col("__v").isNull()).over(w.rowsBetween(W.unboundedPreceding, W.currentRow)))
    return rows.withColumn("__m", F.max(F.struct("__seg", "__v")).over(w.rowsBetween(W.unboundedPreceding, -1)))


def strict_prefix_maxima(
    df: DataFrame, group: list[str], order: list[str], value: str, skew: Skew = Skew()
) -> DataFrame:
    """Rows exceeding every earlier row of their group since the last NULL.

    This is the fixpoint of removing `not_increasing` rows until none is left:
    a prefix maximum never has a larger predecessor, and any other survivor
    would have an earlier maximum at least as large, so the series would not be
    strictly increasing. NULL rows always stay and act as a barrier.
    """
    s = _series(df, group, order, value, skew)
    v, m = F.col("__v"), F.col("__m")
    # Segments only grow, so the maximum of (segment, value) belongs to the
    # current segment unless a NULL has just opened a new one.
    local = v.isNull() | m.isNull() | (m["__seg"] < F.col("__seg")) | m["__v"].isNull() | (v > m["__v"])
    result = _peaks(s.plain, s.window()).filter(local).select(*df.columns)
    if s.hot is None:
        return result
    rows = _peaks(s.hot, s.window("__b"))
    ends = (
        rows.groupBy(*s.group, "__b")
        .agg(F.max(F.struct("__seg", "__v")).alias("t"))
        .withColumn("__end", F.sum("t.__seg").over(s.along.rowsBetween(W.unboundedPreceding, W.currentRow)))
    )
    running = W.partitionBy(*s.group, "__end").orderBy("__b").rowsBetween(W.unboundedPreceding, W.currentRow)
    ends = ends.withColumn("__peak", F.max("t.__v").over(running))
    carry = runtime.pin(ends.withColumn("__carry", F.lag("__peak").over(s.along)).select(*s.group, "__b", "__carry"))
    rows, c = _attach_carry(rows, carry, s), F.col("__carry")
    kept = rows.filter(local & (v.isNull() | (F.col("__seg") > 0) | c.isNull() | (v > c)))
    return result.unionByName(kept.select(*df.columns))
