"""Filter a set of related tables down to rows that meet every rule."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualityforge import runtime
from qualityforge.operators.constraints import Tables, analysis_error, violation_ledger
from qualityforge.operators.ordered import strict_prefix_maxima
from qualityforge.operators.rules import MonotonicRule, Rule


def compliant_parent(rules: Sequence[Rule], tables: Tables, parent: str, key: str) -> DataFrame:
    """Parent rows that violate nothing, closed under the monotonic rule.

    Order matters: the first monotonic check sees the unfiltered series, then
    violators of all rules leave together, and because a removal exposes new
    neighbours the monotonic check repeats until nothing falls out. That loop is
    one strict-prefix-maximum scan over the survivors.
    """
    active = [r for r in rules if r.in_filter and analysis_error(r, tables) is None]
    series = [r for r in active if isinstance(r, MonotonicRule)]
    if len(series) > 1 or any(r.table != parent for r in series):
        raise ValueError("the closure supports one monotonic rule, on the parent table")
    parent_df, hot = tables[parent], None
    if series:
        # One probe serves both scans: groups only shrink in between.
        r = series[0]
        hot = r.skew.probe(parent_df.filter(r.where) if r.where else parent_df, list(r.group))
        r = replace(r, skew=replace(r.skew, enabled=hot is not None, known=hot))
        active = [r if isinstance(a, MonotonicRule) else a for a in active]
    # Removed ids are few as a rule: written once, then broadcast if their size
    # allows, so that the parent itself is not shuffled.
    bad = runtime.pin(violation_ledger(active, tables, distinct=False).select(F.col("entity_id").alias(key)).distinct())
    kept = parent_df.join(runtime.checked_broadcast(bad), key, "left_anti").select(parent_df.columns)
    if not series:
        return kept
    if hot is not None:
        # Hot and ordinary groups are read apart: compute the survivors once.
        kept = runtime.pin(kept)
    if r.where is None:
        return strict_prefix_maxima(kept, list(r.group), list(r.order), r.value, r.skew)
    inside = strict_prefix_maxima(kept.filter(r.where), list(r.group), list(r.order), r.value, r.skew)
    return inside.unionByName(kept.filter(~F.coalesce(F.expr(r.where), F.lit(False))))


def filter_compliant(
    rules: Sequence[Rule],
    tables: Tables,
    parent: str,
    key: str,
    children: Sequence[str] = (),
    drop: Sequence[str] = (),
    stage: bool = True,
) -> dict[str, DataFrame]:
    """Compliant parent and the child rows of kept parents.

    ``stage`` writes the surviving parent once to the shared folder, so that the
    parent and all children agree and the plan is not recomputed per child.
    """
    kept = compliant_parent(rules, tables, parent, key)
    if stage and children:
        kept = runtime.pin(kept)
    return {parent: kept.drop(*drop), **restrict_children({c: tables[c] for c in children}, kept, key)}


def write_compliant(
    rules: Sequence[Rule],
    tables: Tables,
    parent: str,
    key: str,
    children: Sequence[str],
    path: str,
    copy: Sequence[str] = (),
    drop: Sequence[str] = (),
) -> DataFrame:
    """Write the compliant set under ``path`` and return (table, rows) as read back.

    The parent is written first and read back for the child joins, so a lost
    executor never forces the rule evaluation to run again.
    """
    base = path.rstrip("/") or "."
    spark = tables[parent].sparkSession
    compliant_parent(rules, tables, parent, key).drop(*drop).write.mode("overwrite").parquet(f"{base}/{parent}")
    ids = spark.read.parquet(f"{base}/{parent}").select(key)
    for c, rows in restrict_children({c: tables[c] for c in children}, ids, key).items():
        rows.write.mode("overwrite").parquet(f"{base}/{c}")
    for c in copy:
        if c in tables:
            tables[c].write.mode("overwrite").parquet(f"{base}/{c}")
    written = [parent, *children, *[c for c in copy if c in tables]]
    counts = [
        spark.read.parquet(f"{base}/{t}").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("table"), "rows")
        for t in written
    ]
    out = counts[0]
    for c in counts[1:]:
        out = out.unionByName(c)
    return out


# A Bloom filter takes a power of two of bits, at least EIGHT times its ids and at most MOST_BITS (8 MB).
EIGHT, MOST_BITS, PROBES = 8, 1 << 26, 3


def _bits(key: Column, bits: int) -> list[Column]:
    """Places of a key in a filter of ``bits`` bits."""
    return [F.xxhash64(key, F.lit(i)).bitwiseAND(bits - 1) for i in range(PROBES)]


def bloom_filter(ids: DataFrame, key: str, n: int) -> tuple[DataFrame, int] | None:
    """(one row with the filter's words, number of bits) for ``n`` ids; None if they are
    too many for a filter of bounded size.

    Bits are OR-ed inside the tasks, then by word; a filter is at most 8 MB whatever the
    number of ids.
    """
    bits = 1 << max(6, (n * EIGHT - 1).bit_length())
    if bits > MOST_BITS:
        return None
    spark = ids.sparkSession
    set_ = ids.select(F.explode(F.array(*_bits(F.col(key), bits))).alias("b"))
    word, mask = F.shiftright("b", 6), F.expr("shiftleft(1L, cast(b & 63 as int))")
    words = set_.groupBy(word.alias("w")).agg(F.bit_or(mask).alias("m"))
    every = spark.range(bits >> 6).withColumnRenamed("id", "w").join(words, "w", "left")
    # A bounded number of words.
    rows = every.agg(F.array_sort(F.collect_list(F.struct("w", F.coalesce("m", F.lit(0).cast("long")).alias("m")))).alias("words"))
    return runtime.pin(rows.select(F.col("words.m").alias("words"))), bits


def might_contain(key: str, found: tuple[DataFrame, int]) -> Column:
    """Whether a key may be among the filter's ids; never false for one that is."""
    words, bits = found
    row = words.scalar()
    hit = lambda b: F.getbit(F.element_at(row, (F.shiftright(b, 6) + 1).cast("int")), b.bitwiseAND(63).cast("int")) == 1
    return reduce(lambda a, b: a & b, [hit(b) for b in _bits(F.col(key), bits)])


def lost_ids(children: Mapping[str, DataFrame], kept: DataFrame, key: str) -> DataFrame:
    """Distinct keys of child rows whose parent is not kept: removed ones and orphans.

    One aggregation over the stacked keys of all tables; keys are combined inside the
    tasks, and no other column is read.
    """
    stacked = kept.select(F.col(key).alias("k"), F.lit(True).alias("kept"))
    for df in children.values():
        stacked = stacked.union(df.select(F.col(key).alias("k"), F.lit(False)))
    found = stacked.filter("k is not null").groupBy("k").agg(F.bool_or("kept").alias("kept"))
    return runtime.pin(found.filter("not kept").select(F.col("k").alias(key)))


def restrict_children(
    children: Mapping[str, DataFrame], kept: DataFrame, key: str, max_rows: int = runtime.BROADCAST_MAX_ROWS, bloom: bool = True, keep_null: bool = False
) -> dict[str, DataFrame]:
    """Child rows whose parent is among ``kept``; rows with a NULL key go, unless ``keep_null``.

    Keys without a kept parent are few as a rule: up to ``max_rows`` of them, of
    checked size, are broadcast and the children are not shuffled. Beyond that the
    smaller side is asked through a Bloom filter first: rows that cannot have
    lost their parent stay where they are, or rows that cannot have one go, and only
    the others are shuffled. When both sides are too many for a filter of bounded
    size, rows and ids are shuffled.
    """
    if not children:
        return {}
    lost = lost_ids(children, kept, key)
    if runtime.fits_broadcast(lost, max_rows):
        side = F.broadcast(lost)
        # An anti join keeps rows with a NULL key.
        rows = {n: df if keep_null else df.filter(F.col(key).isNotNull()) for n, df in children.items()}
        return {n: df.join(side, key, "left_anti").select(df.columns) for n, df in rows.items()}
    ids = kept.select(key)
    n_lost, n_kept = lost.count(), ids.count()
    found = bloom_filter(lost if n_lost < n_kept else ids, key, min(n_lost, n_kept)) if bloom else None
    out = {}
    for n, df in children.items():
        rows = df.filter(F.col(key).isNotNull())
        asked = might_contain(key, found) if found else F.lit(True)
        if found is None:
            out[n] = rows.join(ids, key, "left_semi").select(df.columns)
        elif n_lost < n_kept:
            out[n] = rows.filter(~asked).unionByName(rows.filter(asked).join(lost, key, "left_anti").select(df.columns))
        else:
            out[n] = rows.filter(asked).join(ids, key, "left_semi").select(df.columns)
        if keep_null:
            out[n] = out[n].unionByName(df.filter(F.col(key).isNull()))
    return out
