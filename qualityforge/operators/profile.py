"""Profile queries: what a table looks like, for reading before trusting it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualityforge import runtime

from qualityforge.functions.scalars import log10_or_null, named_or_id
from qualityforge.operators.quantiles import column_stats, exact_quantiles


def _share(counts: DataFrame, total: DataFrame, digits: int | None) -> DataFrame:
    """Add the percentage of the grand total, a scalar subquery over the source
    (a global window would pull every category into one task)."""
    pct = F.col("cnt") * F.lit(100.0) / total.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.withColumn("pct", pct if digits is None else F.round(pct, digits))


def row_count(df: DataFrame, alias: str = "cnt") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(alias))


def freq_share(df: DataFrame, column: str, digits: int | None = 2, top: int | None = None) -> DataFrame:
    """(column, cnt, pct), most frequent first, ties by value."""
    out = _share(df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt")), df, digits)
    out = out.orderBy(F.desc("cnt"), F.col(column))
    return out if top is None else out.limit(top)


def named_distribution(
    df: DataFrame,
    id_column: str,
    dictionary: DataFrame | None,
    dict_id: str = "id",
    dict_name: str = "name",
    alias: str = "category",
    digits: int | None = 2,
) -> DataFrame:
    """Distribution by dictionary name, by id where the name is missing.

    Rows are counted per id first, so the dictionary joins a handful of rows and
    never the fact table.
    """
    counts = df.groupBy(F.col(id_column).alias("__id")).agg(F.count(F.lit(1)).alias("__n"))
    if dictionary is None:
        named = counts.withColumn(alias, F.col("__id").cast("string"))
    else:
        names = dictionary.select(F.col(dict_id).alias("__did"), F.col(dict_name).alias("__name"))
        named = counts.join(names, F.col("__id") == F.col("__did"), "left")
        named = named.withColumn(alias, named_or_id(F.col("__name"), F.col("__id")))
    out = named.groupBy(alias).agg(F.sum("__n").alias("cnt"))
    return _share(out, df, digits).orderBy(F.desc("cnt"), F.col(alias))


def group_size_histogram(df: DataFrame, key: str, alias: str = "group_size") -> DataFrame:
    """How many keys have 1, 2, 3, ... rows."""
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias(alias))
    return sizes.groupBy(alias).agg(F.count(F.lit(1)).alias("cnt")).orderBy(alias)


def profile_columns(
    df: DataFrame, columns: Sequence[str], log10_mean: bool = False, accuracy: int | None = None
) -> DataFrame:
    """Min, max, mean and median of several columns, one row each, from shared
    scans. ``accuracy`` takes the median from a sketch in one scan instead of counting."""
    spark = df.sparkSession
    values = {f"v{i}": F.col(c).cast("double") for i, c in enumerate(columns)}
    if accuracy is None:
        logs = {f"l{i}": log10_or_null(v) for i, v in enumerate(values.values())} if log10_mean else {}
        stats = column_stats(df, values | logs, [0.5], plain=list(logs))
        medians = {n: q and q[0] for n, q in exact_quantiles(df, values, [0.5], stats).items()}
        rows = [
            (c, stats[n].low, stats[n].high, stats[n].mean, medians[n], stats[f"l{i}"].mean if log10_mean else None)
            for i, (c, n) in enumerate(zip(columns, values))
        ]
    else:
        aggs = [F.array(F.min(v), F.max(v), F.avg(v), F.percentile_approx(v, 0.5, accuracy), F.avg(log10_or_null(v))).alias(n) for n, v in values.items()]
        found = df.agg(*aggs).first()
        rows = [(c, *found[n]) for c, n in zip(columns, values)]
    out = spark.createDataFrame(
        rows, "column string, min double, max double, avg double, median double, avg_log10 double"
    )
    return out if log10_mean else out.drop("avg_log10")


def numeric_summary(
    df: DataFrame, column: str, log10_mean: bool = False, accuracy: int | None = None
) -> DataFrame:
    """One row: min, max, avg, median (and the mean of log10 over positives)."""
    return profile_columns(df, [column], log10_mean, accuracy).drop("column")


def two_way_counts(df: DataFrame, first: str, second: str) -> DataFrame:
    """Counts per pair, first ascending and second descending."""
    return df.groupBy(first, second).agg(F.count(F.lit(1)).alias("cnt")).orderBy(F.col(first), F.desc(second))


def primary_by_key(
    parent: DataFrame,
    parent_key: str,
    values: dict[str, Column],
    child: DataFrame,
    child_key: str,
    category: str,
    rank: str,
) -> DataFrame:
    """Per key: sums and row count of parent ``values`` and the child's leading
    category (largest ``rank``, ties by category, NULL rank last).

    Both tables are stacked and aggregated once per key. Each side is combined
    before the shuffle, so neither a heavy parent key nor a heavy child key
    reaches one task row by row, as it would with a ranked join.
    """
    lead = F.struct(F.col(rank).isNull().alias("u"), (-F.col(rank)).alias("r"), F.col(category).alias("c"))
    left = parent.select(
        F.col(parent_key).alias("__k"),
        *[v.alias(f"s_{n}") for n, v in values.items()],
        *[F.when(v.isNotNull(), 1).otherwise(0).cast("long").alias(f"n_{n}") for n, v in values.items()],
        F.lit(1).cast("long").alias("rows"),
    )
    right = child.select(F.col(child_key).alias("__k"), lead.alias("lead"))
    return (
        left.unionByName(right, allowMissingColumns=True)
        .filter(F.col("__k").isNotNull())
        .groupBy("__k")
        .agg(
            *[F.sum(f"s_{n}").alias(f"s_{n}") for n in values],
            *[F.sum(f"n_{n}").alias(f"n_{n}") for n in values],
            F.sum("rows").alias("rows"),
            F.min("lead").alias("lead"),
        )
        .filter((F.col("rows") > 0) & F.col("lead").isNotNull())
        .withColumn("category", F.col("lead.c"))
    )


def windowed_top_category(
    parent: DataFrame,
    parent_key: str,
    value: str,
    window: tuple[str, object, object],
    child: DataFrame,
    child_key: str,
    category: str,
    rank: str,
    top: int | None = None,
) -> DataFrame:
    """Mean value (and log10 mean) by leading child category, for parent rows
    whose window column lies in [low, high]; highest mean first."""
    column, low, high = window
    scope = parent.filter(F.col(column).between(low, high))
    v = F.col(value)
    per_key = primary_by_key(
        scope, parent_key, {"value": v, "log": log10_or_null(v)}, child, child_key, category, rank
    )
    mean = lambda n: F.try_divide(F.sum(f"s_{n}"), F.sum(f"n_{n}"))
    out = (
        per_key.groupBy(F.col("category").alias(category))
        .agg(mean("value").alias("avg_value"), mean("log").alias("avg_log10"), F.sum("rows").alias("cnt"))
        .orderBy(F.desc("avg_value"), F.col(category))
    )
    return out if top is None else out.limit(top)


# --------------------------------------------------------------- a whole profile


def stacked_pairs(df: DataFrame, items: Sequence[tuple[int, Column, str | None]]) -> DataFrame:
    """(d, category): a row of ``df`` as one pair for every (number, category, condition)
    whose condition it meets; all from one scan. A condition they share is a filter."""
    one = len({where for *_, where in items}) == 1
    if one and items[0][2]:
        df = df.filter(items[0][2])
    pairs = []
    for d, category, where in items:
        pair = F.struct(F.lit(d).alias("d"), category.cast("string").alias("category"))
        pairs.append(F.when(F.expr(where), pair) if where and not one else pair)
    # Without an absent pair there is nothing to leave out, which generated code does not do.
    return df.select(F.inline(F.array(*pairs) if one else F.array_compact(F.array(*pairs))))


@dataclass(frozen=True)
class Shares:
    """Rows by category of ``expr``; ``dictionary`` = (table, id column, name column)."""

    name: str
    table: str
    expr: str
    dictionary: tuple[str, str, str] | None = None


@dataclass(frozen=True)
class GroupSizes:
    """How many keys have 1, 2, 3, ... rows; rows without a key count as one key."""

    name: str
    table: str
    key: str


@dataclass(frozen=True)
class Summary:
    """Bounds, mean and median of a column, with the mean of log10 of positive values."""

    name: str
    table: str
    column: str
    log10: bool = False


@dataclass(frozen=True)
class Leading:
    """Mean of ``value`` by leading child category, see `windowed_top_category`."""

    name: str
    parent: str
    key: str
    value: str
    window: tuple[str, object, object]
    child: str
    child_key: str
    category: str
    rank: str


Statistic = Shares | GroupSizes | Summary | Leading
PROFILE_COLUMNS = "statistic string, item string, measure string, value double"


def _long(df: DataFrame, statistic: Column, item: Column, measures: Mapping[str, Column]) -> DataFrame:
    rows = F.array(*[F.struct(F.lit(m).alias("measure"), v.cast("double").alias("value")) for m, v in measures.items()])
    return df.select(statistic.alias("statistic"), item.cast("string").alias("item"), F.inline(rows))


def counted_statistics(items: Sequence[Shares | GroupSizes], tables: Mapping[str, DataFrame], digits: int = 2) -> DataFrame:
    """(statistic, item, measure, value) with measures ``cnt`` and ``pct`` of distributions,
    ``cnt`` of group sizes and of the rows of each table (statistic ``rows``).

    All of it is one aggregation: every table is scanned once and contributes its
    (statistic, category) pairs, which are combined map side and shuffled once. A
    second, small one counts group sizes and adds up categories with one name.
    """
    names = [i.name for i in items]
    of: dict[str, list[int]] = {}
    for d, i in enumerate(items):
        of.setdefault(i.table, []).append(d)
    stacked = []
    for t, (table, own) in enumerate(of.items()):
        # Rows of the table, under a number after those of the items.
        pairs = [(d, F.expr(items[d].expr) if isinstance(items[d], Shares) else F.expr(items[d].key), None) for d in own]
        stacked.append(stacked_pairs(tables[table], [*pairs, (len(items) + t, F.lit(table), None)]))
    counts = reduce(DataFrame.unionByName, stacked).groupBy("d", "category").agg(F.count(F.lit(1)).alias("n"))
    sizes = F.col("d").isin([d for d, i in enumerate(items) if isinstance(i, GroupSizes)] or [-1])
    item = F.when(sizes, F.col("n").cast("string")).otherwise(F.col("category"))
    counts = counts.groupBy("d", item.alias("item")).agg(F.sum(F.when(sizes, 1).otherwise(F.col("n"))).alias("n"))
    coded = [(d, *i.dictionary) for d, i in enumerate(items) if isinstance(i, Shares) and i.dictionary and i.dictionary[0] in tables]
    if coded:
        named = [tables[t].select(F.lit(d).alias("d"), F.col(k).cast("string").alias("item"), F.col(n).alias("name")) for d, t, k, n in coded]
        counts = counts.join(reduce(DataFrame.unionByName, named), ["d", "item"], "left")
        counts = counts.groupBy("d", named_or_id(F.col("name"), F.col("item")).alias("item")).agg(F.sum("n").alias("n"))
    counts = runtime.pin(counts)
    label = F.element_at(F.array(*[F.lit(n) for n in [*names, *["rows"] * len(of)]]), F.col("d") + 1)
    # One row per statistic.
    totals = counts.groupBy("d").agg(F.sum("n").alias("total"))
    joined = counts.join(F.broadcast(totals), "d").withColumn("share", F.round(F.col("n") * 100.0 / F.col("total"), digits))
    shares = F.col("d").isin([d for d, i in enumerate(items) if isinstance(i, Shares)] or [-1])
    return _long(joined, label, F.col("item"), {"cnt": F.col("n"), "pct": F.when(shares, F.col("share"))}).filter("value is not null")


def profile_tables(items: Sequence[Statistic], tables: Mapping[str, DataFrame], accuracy: int | None = None) -> DataFrame:
    """Every statistic as rows (statistic, item, measure, value); counts as `counted_statistics`.

    A NULL category has item NULL. Statistics of tables that are missing are left out.
    The kinds are computed at the same time: one scan a table for all counts, two for
    all summaries, one stacked aggregation for each `Leading`.
    """
    have = lambda *names: all(n in tables for n in names)
    counted = [i for i in items if isinstance(i, Shares | GroupSizes) and have(i.table)]
    of: dict[str, list[Summary]] = {}
    for i in items:
        if isinstance(i, Summary) and have(i.table):
            of.setdefault(i.table, []).append(i)

    def summaries(table: str, own: list[Summary]) -> DataFrame:
        found = profile_columns(tables[table], [i.column for i in own], True, accuracy)
        logs = F.col("column").isin([i.column for i in own if i.log10])
        label = reduce(lambda a, i: F.when(F.col("column") == i.column, i.name).otherwise(a), own, F.lit(None))
        measures = {m: F.col(m) for m in ("min", "max", "avg", "median")} | {"avg_log10": F.when(logs, F.col("avg_log10"))}
        return _long(found, label, F.col("column"), measures).filter("value is not null")

    def leading(i: Leading) -> DataFrame:
        found = windowed_top_category(tables[i.parent], i.key, i.value, i.window, tables[i.child], i.child_key, i.category, i.rank)
        return _long(found, F.lit(i.name), F.col(i.category), {"avg": F.col("avg_value"), "avg_log10": F.col("avg_log10"), "cnt": F.col("cnt")})

    tasks = [lambda: counted_statistics(counted, tables)] if counted else []
    tasks += [lambda t=t, own=own: summaries(t, own) for t, own in of.items()]
    tasks += [lambda i=i: leading(i) for i in items if isinstance(i, Leading) and have(i.parent, i.child)]
    if not tasks:
        return next(iter(tables.values())).sparkSession.createDataFrame([], PROFILE_COLUMNS)
    spark = next(iter(tables.values())).sparkSession
    return reduce(DataFrame.unionByName, runtime.together(spark, tasks))
