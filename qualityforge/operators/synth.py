"""Operators for rule-constrained synthetic tables.

They work on one row per entity group with small array columns (a handful of
items, steps or points each) and expand to the final tables at the end, so
generation needs no shuffle at all.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qualityforge.functions.keyed import Keyed
from qualityforge.functions.scalars import clamp, let, round_half_up, round_to_step


def entity_ids(spark: SparkSession, n: int, name: str, partitions: int | None = None) -> DataFrame:
    """Ids 0 .. n-1 produced on the executors."""
    return spark.range(0, n, 1, partitions or spark.sparkContext.defaultParallelism).withColumnRenamed("id", name)


def spread(ids: DataFrame, key: str, partitions: int | None = None) -> DataFrame:
    """Deal a narrow frame of ids into ``partitions`` (default: one per core).

    Generation costs far more per row than moving an id, and a few files of ids
    would otherwise occupy a few cores.
    """
    return ids.repartition(partitions or ids.sparkSession.sparkContext.defaultParallelism, key)


def retry_until(
    attempt: Callable[[Column], Column], accept: Callable[[Column], Column], tries: int, fallback: Column, null_type: str, first: Column | None = None
) -> Column:
    """The first accepted ``attempt(i)`` for i in 0 .. tries-1, else ``fallback``.

    Later attempts are not evaluated once one is accepted. The first stands alone, as an
    aggregate copies what it has found in every step; ``first`` may give it in a cheaper way.
    """

    def accepted(made: Column) -> Column:
        return let(made, lambda a: F.when(accept(a), a))

    found = [accepted(attempt(F.lit(0)) if first is None else first)] if tries > 0 else []
    if tries > 1:
        start = F.lit(None).cast(null_type)
        found.append(F.aggregate(F.sequence(F.lit(1), F.lit(tries - 1)), start, lambda acc, i: F.coalesce(acc, accepted(attempt(i)))))
    return F.coalesce(*found, fallback)


def running_budget(items: Column, amount: str, cap: str, low: float, budget: float, digits: int, item_type: str) -> Column:
    """Clip the ``amount`` of each struct in order and keep the total in budget.

    Each amount is limited to [low, cap], then to what is left; items whose rest
    is not above ``low`` are dropped. Amounts are rounded on output, while the
    budget is charged unrounded. ``item_type`` is the DDL of the result struct
    (same fields as the items).
    """
    start = F.struct(
        F.lit(0.0).alias("used"),
        F.lit(None).cast(f"array<{item_type}>").alias("kept"),
    )

    def step(acc: Column, x: Column) -> Column:
        allowed = F.least(clamp(x[amount], low, x[cap]), F.lit(float(budget)) - acc["used"])
        return let(
            allowed,
            lambda a: F.when(
                a > low,
                F.struct(
                    (acc["used"] + a).alias("used"),
                    F.concat(
                        F.coalesce(acc["kept"], F.array().cast(f"array<{item_type}>")),
                        F.array(x.withField(amount, round_half_up(a, digits)).cast(item_type)),
                    ).alias("kept"),
                ),
            ).otherwise(acc),
        )

    return F.coalesce(F.aggregate(items, start, step, lambda acc: acc["kept"]), F.array().cast(f"array<{item_type}>"))


def argmax_item(items: Column, by: str) -> Column:
    """The struct with the largest ``by``; the first one wins ties."""
    return F.aggregate(items, F.element_at(items, 1), lambda best, x: F.when(x[by] > best[by], x).otherwise(best))


def total_of(items: Column, amount: str) -> Column:
    """Sum of a struct field, in order."""
    return F.aggregate(items, F.lit(0.0), lambda s, x: s + x[amount])


def range_lookup(df: DataFrame, key: str, ranges: Mapping[str, Sequence[float]], default: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Add one column per name with the range of ``key``, or the default's."""
    values = F.coalesce(
        F.create_map(*[c for k, r in ranges.items() for c in (F.lit(k), F.array(*[F.lit(float(x)) for x in r]))])[F.col(key)]
        if ranges
        else F.lit(None).cast("array<double>"),
        F.array(*[F.lit(float(x)) for x in default]),
    )
    out = df.withColumn("__range", values)
    for i, n in enumerate(names):
        out = out.withColumn(n, F.col("__range")[i])
    return out.drop("__range")


def mixture_value(k: Keyed, stream: str, common: Sequence[float], low: Column, high: Column, ratio: float, step: float, index: Column | int = 0) -> Column:
    """With probability ``ratio`` one of the common values inside [low, high]
    (any value of the range if none is), otherwise a value of the range rounded
    to ``step``, which may leave the range by rounding."""
    listed = F.filter(F.array(*[F.lit(float(v)) for v in common]), lambda v: v.between(low, high))
    free = low + k.uniform(stream + "/free", index) * (high - low)
    chosen = let(
        listed,
        lambda c: F.coalesce(F.get(c, k.pick(stream + "/pick", F.size(c), index)), free),
    )
    return F.when(k.uniform(stream + "/mode", index) < ratio, chosen).otherwise(round_to_step(free, step))


def ordered_points(k: Keyed, stream: str, center: Column, n: Column, spacing: tuple[float, float], jitter: float, low: float, high: float, fallback_back: float, fallback_step: float) -> Column:
    """A sorted series of distinct rounded points around ``center``.

    Points start half the extent before the centre, are spaced by one draw from
    ``spacing`` and jittered. If fewer than two distinct points remain, equally
    spaced points replace them.
    """
    gap = k.between(stream + "/gap", *spacing)
    idx = F.sequence(F.lit(0), n - 1)

    def points(p: Column) -> Column:
        start = F.greatest(F.lit(float(low)), p["c"] - F.floor((p["n"] - 1) / 2.0 * p["gap"]))
        return F.transform(
            idx,
            lambda i: round_half_up(
                clamp(start + i * p["gap"] + k.normal(stream + "/jitter", i) * jitter, float(low), float(high))
            ),
        )

    drawn = let(F.struct(center.alias("c"), n.alias("n"), gap.alias("gap")), lambda p: F.sort_array(F.array_distinct(points(p))))
    base = F.greatest(F.lit(float(low)), center - fallback_back)
    even = F.transform(idx, lambda i: F.least(F.lit(float(high)), base + i * fallback_step))
    return let(drawn, lambda s: F.when(F.size(s) < 2, even).otherwise(s))


def monotone_repair(values: Column, bump: Callable[[Column], Column], high: float, strict: bool = False) -> Column:
    """Make a series increase: a value not above its predecessor becomes the
    predecessor times ``bump(position)``, at most ``high``.

    The cap can leave a plateau at ``high``; ``strict`` cuts the series there.
    """
    empty = F.array().cast("array<double>")

    def step(acc: Column, x: Column) -> Column:
        prev = F.element_at(acc, -1)
        return F.when(F.size(acc) == 0, F.array(x)).otherwise(
            F.concat(
                acc,
                F.array(F.when(x <= prev, F.least(prev * bump(F.size(acc)), F.lit(float(high)))).otherwise(x)),
            )
        )

    fixed = F.aggregate(values, empty, step)
    if not strict:
        return fixed
    return let(
        fixed,
        lambda s: F.filter(s, lambda v, i: (i == 0) | (v > F.get(s, i - 1))),
    )


def other_candidate(k: Keyed, stream: str, candidates: Sequence[int], used: Column) -> Column:
    """One unused candidate at random, NULL if all are used."""
    free = F.array_except(F.array(*[F.lit(c) for c in candidates]), used)
    return let(free, lambda f: F.get(f, k.pick(stream, F.size(f))))


def _positions(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1))


def fan_out(groups: DataFrame, group_id: str, points: str, child_arrays: Mapping[str, str], sample_id: str, base: int, block: int, parent_columns: Sequence[str] = (), count: str | None = None) -> dict[str, DataFrame]:
    """Expand grouped rows to a parent table and its child tables.

    Element i of the ``points`` array becomes a parent row with id
    ``base + group * block + i``; every element of each child array is repeated
    for each parent row. Only narrow operations, so no shuffle. ``count`` may
    name a column with the number of points, so that reading a child table from
    a staged frame leaves the points alone.
    """
    ident = (F.lit(base) + F.col(group_id) * F.lit(block) + F.col("pos")).cast("long").alias(sample_id)
    # Outer generators, then a test on the generated column: a plain explode
    # would let the optimizer infer "array not empty" and push the expression
    # that builds the array down through every stage that feeds it.
    expanded = groups.select(group_id, *parent_columns, F.posexplode_outer(points).alias("pos", "point"))
    out = {
        "parent": expanded.filter(F.col("pos").isNotNull()).select(ident, group_id, *parent_columns, "point.*")
    }
    for name, arr in child_arrays.items():
        positions = _positions(F.col(count) if count else F.size(points))
        out[name] = (
            groups.select(group_id, arr, F.explode_outer(positions).alias("pos"))
            .filter(F.col("pos").isNotNull())
            .select(group_id, "pos", F.explode_outer(arr).alias("item"))
            .filter(F.col("item").isNotNull())
            .select(ident, group_id, "item.*")
        )
    return out
