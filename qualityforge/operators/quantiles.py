"""Exact quantiles in two scans: a mergeable sketch, then one count inside its bounds.

The first scan keeps a KLL sketch per column and task. Sketches are merged in two
steps, a bounded number of groups and then one, so that no task receives as many
sketches as there are tasks. The sketch says between which two values each wanted
quantile lies, with a margin beyond its error. The second scan counts rows below, between
and inside these spans, and the distinct values inside, combined map-side; a few
percent of the rows are left, written once, and ranked exactly. Where the sketch
missed a quantile after all, its column is narrowed by counting in bins, scan by
scan. What reaches the driver is a few rows per wanted quantile.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from fractions import Fraction
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from qualityforge import runtime

BINS = 4096
# A bin with at most this many values is finished by counting distinct values.
FINISH = 50_000
# Size of a sketch, its margin in shares of the rows (about twice its error), and the
# groups in which sketches are merged first.
SKETCH, MARGIN, GROUPS = 2048, 0.005, 64


@dataclass
class _Wanted:
    name: str
    prob: float
    rank: int
    low: float
    high: float
    size: int

    @property
    def done(self) -> bool:
        return self.low == self.high


@dataclass(frozen=True)
class ColumnStats:
    """``rows`` that were kept, ``n`` values among them (not NULL), and of these mean, sample
    deviation (None below two values), bounds, and for each wanted share the two
    values between which its quantile is expected (None without a sketch)."""

    rows: int
    n: int
    mean: float | None
    std: float | None
    low: float | None
    high: float | None
    spans: dict[float, tuple[float, float]] | None = None

    @property
    def finite(self) -> bool:
        return self.n > 0 and math.isfinite(self.high - self.low)


def rank_of(prob: float, n: int) -> int:
    """1-based rank of the discrete quantile: the smallest k with k/n >= prob."""
    return max(1, math.ceil(Fraction(str(prob)) * n))


# ------------------------------------------------------------------ first scan


def _merged(parts: Sequence[tuple[int, float, float]]) -> tuple[float | None, float | None]:
    """Mean and sample deviation from (n, mean, variance) of parts."""
    n, mean, square = 0, 0.0, 0.0
    for k, m, v in parts:
        if k:
            step, n = m - mean, n + k
            mean += step * k / n
            square += v * k + step * step * k * (n - k) / n
    return (mean if n else None), (math.sqrt(square / (n - 1)) if n > 1 else None)


def column_stats(
    df: DataFrame, values: Mapping[str, Column], probs: Sequence[float] = (), keep: Mapping[str, Column] | None = None,
    sketch: int = SKETCH, margin: float = MARGIN, plain: Sequence[str] = (),
) -> dict[str, ColumnStats]:
    """Statistics of several numeric expressions of one table, from one scan.

    ``keep`` restricts a value to the rows where its condition holds. With ``probs``
    every value but the ``plain`` ones is sketched as well, and ``spans`` bound its
    quantiles.
    """
    sketched = [bool(probs) and n not in plain for n in values]
    kept = {n: (keep or {}).get(n, F.lit(True)) for n in values}
    columns = {n: F.when(kept[n], v.cast("double")) for n, v in values.items()}
    aggs = []
    for i, (n, v) in enumerate(columns.items()):
        parts = [F.count_if(kept[n]), F.count(v), F.avg(v), F.var_pop(v), F.min(v), F.max(v)]
        aggs += [p.alias(f"{c}{i}") for c, p in zip("rnavlh", parts)]
        if sketched[i]:
            aggs.append(F.kll_sketch_agg_double(v, sketch).alias(f"s{i}"))
    grouped = df.groupBy(F.pmod(F.spark_partition_id(), F.lit(GROUPS)).alias("part")).agg(*aggs)
    ends = [(min(max(p - margin, 0.0), 1.0), max(min(p + margin, 1.0), 0.0)) for p in probs]
    once = []
    for i in range(len(columns)):
        # At most GROUPS rows.
        moments = F.collect_list(F.struct(F.col(f"n{i}").alias("n"), F.col(f"a{i}").alias("a"), F.col(f"v{i}").alias("v")))
        once += [F.sum(f"r{i}").alias(f"r{i}"), F.sum(f"n{i}").alias(f"n{i}"), F.min(f"l{i}").alias(f"l{i}"), F.max(f"h{i}").alias(f"h{i}"), moments.alias(f"m{i}")]
        if sketched[i]:
            merged = F.kll_merge_agg_double(F.when(F.col(f"n{i}") > 0, F.col(f"s{i}")), sketch)
            at = F.kll_sketch_get_quantile_double(merged, F.array(*[F.lit(float(e)) for pair in ends for e in pair]))
            once.append(F.when(F.sum(f"n{i}") > 0, at).alias(f"q{i}"))
    row = grouped.agg(*once).first()
    out = {}
    for i, n in enumerate(columns):
        mean, std = _merged([(m["n"], m["a"], m["v"]) for m in row[f"m{i}"]])
        found = row[f"q{i}"] if sketched[i] else None
        spans = None if found is None else {p: (found[2 * j], found[2 * j + 1]) for j, p in enumerate(probs)}
        out[n] = ColumnStats(row[f"r{i}"] or 0, row[f"n{i}"] or 0, mean, std, row[f"l{i}"], row[f"h{i}"], spans)
    return out


# ----------------------------------------------------------------- second scan


def _disjoint(spans: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    out: list[tuple[float, float]] = []
    for low, high in sorted(spans):
        if out and low <= out[-1][1]:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def _counted(df: DataFrame, values: Mapping[str, Column], spans: Mapping[str, list[tuple[float, float]]]) -> DataFrame:
    """(c, zone, v, w): rows by column and zone. Zone 2 i is what lies below span i and above
    the one before, without values; zone 2 i + 1 is span i, by value. One scan."""
    # Values, then zones, then pairs: each computed once a row, and by generated code.
    read = df.select(*[v.cast("double").alias(f"v{c}") for c, v in enumerate(values.values())])
    zones = []
    for c, name in enumerate(values):
        v = F.col(f"v{c}")
        zone = F.lit(2 * len(spans[name]))
        for i, (low, high) in reversed(list(enumerate(spans[name]))):
            inside = (v >= F.lit(low)) & (v <= F.lit(high))
            zone = F.when(v < F.lit(low), 2 * i).when(inside, 2 * i + 1).otherwise(zone)
        zones.append(F.when(v.isNotNull(), zone).alias(f"zone{c}"))
    placed = read.select("*", *zones)
    own = lambda c: F.when(F.col(f"zone{c}") % 2 == 1, F.col(f"v{c}"))
    items = [F.struct(F.lit(c).alias("c"), F.col(f"zone{c}").alias("zone"), own(c).alias("v")) for c in range(len(values))]
    found = placed.select(F.inline(F.array(*items))).filter("zone is not null")
    return found.groupBy("c", "zone", "v").agg(F.count(F.lit(1)).alias("w"))


def _is_any(pairs: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, pairs)


def _narrow(frames: Mapping[str, DataFrame], wanted: list[_Wanted], finish: int) -> None:
    """One pass over (v, w) frames, values with their numbers of rows, that narrows every
    unfinished quantile."""
    spans = sorted({(w.name, w.low, w.high, w.size <= finish) for w in wanted})
    number = {s[:3]: i for i, s in enumerate(spans)}
    branches = []
    for name, df in frames.items():
        v, span, part = F.col("v"), F.lit(None).cast("int"), F.lit(None).cast("double")
        mine = [(i, s) for i, s in enumerate(spans) if s[0] == name]
        for i, (_, low, high, small) in mine:
            # Bins follow the order of the values; a small span counts each
            # value. Spans of one column do not overlap.
            share = F.least((v - F.lit(low)) / (F.lit(high) - F.lit(low)) * BINS, F.lit(float(BINS - 1)))
            inside = v.between(F.lit(low), F.lit(high))
            span = F.when(inside, F.lit(i)).otherwise(span)
            part = F.when(inside, v if small else F.floor(share).cast("double")).otherwise(part)
        reach = v.between(F.lit(min(s[1] for _, s in mine)), F.lit(max(s[2] for _, s in mine)))
        # One branch per column: together they read what one shared scan would.
        branches.append(df.filter(reach).select(span.alias("span"), part.alias("part"), "v", "w"))
    along = W.partitionBy("span").orderBy("part").rowsBetween(W.unboundedPreceding, W.currentRow)
    counted = (
        reduce(DataFrame.unionByName, branches)
        .filter(F.col("span").isNotNull())
        .groupBy("span", "part")
        .agg(F.sum("w").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))
        .withColumn("upto", F.sum("n").over(along))
    )
    holds = [
        (F.col("span") == number[(w.name, w.low, w.high)])
        & (F.col("upto") >= w.rank)
        & (F.col("upto") - F.col("n") < w.rank)
        for w in wanted
    ]
    found = counted.filter(_is_any(holds)).collect()
    for w in wanted:
        span = number[(w.name, w.low, w.high)]
        row = next(r for r in found if r["span"] == span and r["upto"] - r["n"] < w.rank <= r["upto"])
        w.rank -= row["upto"] - row["n"]
        w.low, w.high, w.size = row["low"], row["high"], row["n"]


def _finished(frames: Mapping[str, DataFrame], wanted: list[_Wanted], finish: int) -> None:
    while open_ := [w for w in wanted if not w.done]:
        names = {w.name for w in open_}
        _narrow({n: f for n, f in frames.items() if n in names}, open_, finish)


def exact_quantiles(
    df: DataFrame,
    values: Mapping[str, Column],
    probs: Sequence[float],
    stats: Mapping[str, ColumnStats] | None = None,
    finish: int = FINISH,
) -> dict[str, list[float] | None]:
    """Discrete quantiles of several numeric expressions of one table.

    NULLs are ignored; a column without values gives None, one with a NaN or an
    infinity gives NaN for all. ``stats`` passes what `column_stats` found for the same
    values and ``probs``, saving the first scan.
    """
    stats = stats or column_stats(df, values, probs)
    wanted = [_Wanted(n, p, rank_of(p, stats[n].n), stats[n].low, stats[n].high, stats[n].n) for n in values if stats[n].finite for p in probs]
    sketched = [w for w in wanted if not w.done and stats[w.name].spans]
    if sketched:
        names = [n for n in values if n in {w.name for w in sketched}]
        spans = {n: _disjoint(list(stats[n].spans.values())) for n in names}
        counted = runtime.pin(_counted(df, {n: values[n] for n in names}, spans))
        # A few zones per column.
        rows = {(r["c"], r["zone"]): r["w"] for r in counted.groupBy("c", "zone").agg(F.sum("w").alias("w")).collect()}
        inside = []
        for w in sketched:
            c = names.index(w.name)
            for i, (low, high) in enumerate(spans[w.name]):
                before = sum(rows.get((c, z), 0) for z in range(2 * i + 1))
                held = rows.get((c, 2 * i + 1), 0)
                if before < w.rank <= before + held:
                    w.rank, w.low, w.high, w.size = w.rank - before, low, high, held
                    inside.append(w)
        small = {n: counted.filter((F.col("c") == c) & F.col("v").isNotNull()).select("v", "w") for c, n in enumerate(names)}
        _finished(small, inside, finish)
    _finished({n: df.select(v.cast("double").alias("v"), F.lit(1).cast("long").alias("w")) for n, v in values.items()}, wanted, finish)
    found = {(w.name, w.prob): w.low for w in wanted}
    return {n: [found.get((n, p), math.nan) for p in probs] if stats[n].n > 0 else None for n in values}
