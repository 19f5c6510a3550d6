"""How closely one population of tables matches another.

Three kinds of dimensions, each scored in [0, 1]:

* `Categorical` - Jensen-Shannon similarity of category shares,
* `Numeric`     - distance of quantile vectors, means and spreads,
* `Joint`       - agreement of a per-category mean on both sides.

Shares and scores are DataFrames throughout, so a category column may have any
number of values. All categorical dimensions of a table together cost one scan per
side; its numeric dimensions share two.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qualityforge import runtime
from qualityforge.functions.scalars import grade, log10_or_null, named_or_id
from qualityforge.operators.profile import primary_by_key, stacked_pairs
from qualityforge.operators.quantiles import column_stats, exact_quantiles

PROBS = (0.05, 0.10, 0.25, 0.50, 0.75, 0.90, 0.95)
_STATS = ("Count", "Mean", "Std", "Min", "P5", "P10", "P25", "P50", "P75", "P90", "P95", "Max")
UNKNOWN = "(unknown)"
# Grade of a dimension whose values hold a NaN or an infinity.
NOT_SCORED = "NOT SCORED"


@dataclass(frozen=True)
class Categorical:
    """``expr`` (SQL, read as text) over ``table`` rows meeting ``where``;
    ``dictionary`` = (table, id column, name column) replaces ids by names."""

    name: str
    table: str
    expr: str
    weight: float = 1.0
    where: str | None = None
    dictionary: tuple[str, str, str] | None = None


@dataclass(frozen=True)
class Numeric:
    name: str
    table: str
    expr: str
    weight: float = 1.0
    where: str | None = None


@dataclass(frozen=True)
class Joint:
    """Mean log10 of ``value`` by the leading child ``category`` (largest
    ``rank``) over parent rows with ``window_column`` in [low, high]."""

    name: str
    parent: str
    parent_key: str
    value: str
    window_column: str
    low: object
    high: object
    child: str
    child_key: str
    category: str
    rank: str
    weight: float = 1.0
    min_support: int = 3


Dimension = Categorical | Numeric | Joint
Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class FidelityReport:
    """summary(dimension, score, weight, weighted_score, grade) and the detail
    rows behind it."""

    summary: DataFrame
    categorical: DataFrame
    numerical: DataFrame
    correlation: DataFrame
    overall: DataFrame


# --------------------------------------------------------------- categorical


def _category_counts(dims: Sequence[Categorical], real: Tables, gen: Tables) -> DataFrame:
    """(d, category, rn, gn): rows per dimension number and category on each side.

    Each table of a side is scanned once: a row becomes one (dimension, category) pair
    for every dimension it belongs to. All pairs are combined map side and meet in a
    single shuffle of category counts.
    """
    of: dict[str, list[tuple[int, Categorical]]] = {}
    for i, d in enumerate(dims):
        of.setdefault(d.table, []).append((i, d))
    branches = []
    for side, tables in ((1, real), (0, gen)):
        for table, own in of.items():
            stacked = stacked_pairs(tables[table], [(i, F.expr(d.expr), d.where) for i, d in own])
            branches.append(stacked.select("d", "category", F.lit(side).cast("long").alias("rn"), F.lit(1 - side).cast("long").alias("gn")))
    total = lambda df: df.groupBy("d", "category").agg(F.sum("rn").alias("rn"), F.sum("gn").alias("gn"))
    counts = total(reduce(DataFrame.unionByName, branches))
    coded = [(i, *d.dictionary) for i, d in enumerate(dims) if d.dictionary and d.dictionary[0] in gen]
    if not coded:
        return counts
    # Names join the counts, not the rows, and may merge ids.
    names = reduce(
        DataFrame.unionByName,
        [
            gen[table].select(F.lit(i).alias("d"), F.col(key).cast("string").alias("category"), F.col(name).alias("name"))
            for i, table, key, name in coded
        ],
    )
    named = counts.join(names, ["d", "category"], "left")
    return total(named.select("d", named_or_id(F.col("name"), F.col("category")).alias("category"), "rn", "gn"))


def jsd_detail(dims: Sequence[Categorical], real: Tables, gen: Tables) -> DataFrame:
    """(dimension, category, p, q): shares of each category on both sides, over
    the union of categories. NULL is a category of its own. Dictionaries are
    taken from ``gen`` for both sides."""
    pairs = _category_counts(dims, real, gen)
    # One row per dimension, so the broadcast is bounded by the dimension list.
    totals = pairs.groupBy("d").agg(F.sum("rn").alias("rt"), F.sum("gn").alias("gt"))
    share = lambda n, t: F.when(F.col(t) > 0, F.col(n) / F.col(t)).otherwise(F.lit(0.0))
    label = F.element_at(F.array(*[F.lit(d.name) for d in dims]), F.col("d") + 1)
    return pairs.join(F.broadcast(totals), "d").select(
        label.alias("dimension"), "category", share("rn", "rt").alias("p"), share("gn", "gt").alias("q")
    )


def jsd_score(detail: DataFrame) -> DataFrame:
    """(dimension, jsd, score) with score = 1 - JSD / ln 2."""
    p, q = F.col("p"), F.col("q")
    m = (p + q) / 2
    term = lambda x: F.when(x > 0, F.lit(0.5) * x * F.ln(x / m)).otherwise(0.0)
    return (
        detail.groupBy("dimension")
        .agg(F.sum(term(p) + term(q)).alias("jsd"))
        .withColumn("score", 1 - F.col("jsd") / math.log(2))
    )


def categorical_report(detail: DataFrame) -> DataFrame:
    """Detail in percent, ready for the report table."""
    return detail.select(
        "dimension",
        F.coalesce("category", F.lit(UNKNOWN)).alias("category"),
        (F.col("p") * 100).alias("real_pct"),
        (F.col("q") * 100).alias("gen_pct"),
        (F.col("q") * 100 - F.col("p") * 100).alias("diff_pct"),
    )


# ------------------------------------------------------------------- numeric


def _by_table(dims: Sequence[Numeric]) -> dict[str, list[Numeric]]:
    out: dict[str, list[Numeric]] = {}
    for d in dims:
        out.setdefault(d.table, []).append(d)
    return out


def _moments(d: Numeric) -> tuple[Column, list[Column]]:
    keep = F.expr(d.where) if d.where else F.lit(True)
    v = F.when(keep, F.expr(d.expr).cast("double"))
    spread = F.coalesce(F.stddev_samp(v), F.lit(1.0))
    return v, [F.count_if(keep).cast("double"), F.avg(v), spread, F.min(v), F.max(v)]


def _sketched_stats(dims: Sequence[Numeric], tables: Tables, accuracy: int) -> DataFrame:
    """(dimension, stats array in _STATS order): one aggregate per table."""
    frames = []
    for table, group in _by_table(dims).items():
        aggs = []
        for i, d in enumerate(group):
            v, m = _moments(d)
            pcts = F.percentile_approx(v, list(PROBS), accuracy)
            aggs.append(F.concat(F.array(*m[:4]), pcts, F.array(m[4])).alias(f"s{i}"))
        rows = [F.struct(F.lit(d.name).alias("dimension"), F.col(f"s{i}").alias("s")) for i, d in enumerate(group)]
        frames.append(tables[table].agg(*aggs).select(F.inline(F.array(*rows))))
    return reduce(DataFrame.unionByName, frames)


def _counted_stats(dims: Sequence[Numeric], tables: Tables) -> DataFrame:
    """The same rows with exact quantiles; a few numbers per dimension pass
    through the driver."""

    def table_rows(table: str, group: list[Numeric]) -> list[tuple]:
        values = {f"v{i}": F.expr(d.expr).cast("double") for i, d in enumerate(group)}
        keep = {f"v{i}": F.expr(d.where) for i, d in enumerate(group) if d.where}
        stats = column_stats(tables[table], values, PROBS, keep)
        kept = {n: F.when(keep[n], v) if n in keep else v for n, v in values.items()}
        quantiles = exact_quantiles(tables[table], kept, PROBS, stats)
        rows = []
        for i, d in enumerate(group):
            s, q = stats[f"v{i}"], quantiles[f"v{i}"]
            spread = 1.0 if s.std is None else s.std
            rows.append((d.name, None if q is None else [float(s.rows), s.mean, spread, s.low, *q, s.high]))
        return rows

    spark = SparkSession.active()
    parts = runtime.together(spark, [partial(table_rows, t, g) for t, g in _by_table(dims).items()])
    return spark.createDataFrame([r for p in parts for r in p], "dimension string, s array<double>")


def _numeric_stats(dims: Sequence[Numeric], tables: Tables, accuracy: int | None) -> DataFrame:
    return _counted_stats(dims, tables) if accuracy is None else _sketched_stats(dims, tables, accuracy)


def quantile_stats(dims: Sequence[Numeric], real: Tables, gen: Tables, accuracy: int | None = None) -> DataFrame:
    """(dimension, r, g): the statistics vectors of both sides.

    Quantiles are exact by default, from two scans a table. An ``accuracy`` (for
    example 10000) takes them from a sketch in a single scan instead, which suits
    inputs of up to some ten thousand partitions.

    An empty population has no quantiles and fails the stage with the name of
    the dimension.
    """
    both = [partial(_numeric_stats, dims, tables, accuracy) for tables in (real, gen)]
    r, g = runtime.together(SparkSession.active(), both)
    sides = r.withColumn("side", F.lit("r")).unionByName(g.withColumn("side", F.lit("g")))
    pick = lambda s: F.max(F.when(F.col("side") == s, F.col("s")))
    out = sides.groupBy("dimension").agg(pick("r").alias("r"), pick("g").alias("g"))
    fail = F.raise_error(F.concat(F.lit("fidelity dimension has no values on one side: "), F.col("dimension")))
    full = lambda c: F.when(F.col(c).isNull(), fail.cast("array<double>")).otherwise(F.col(c))
    return out.select("dimension", full("r").alias("r"), full("g").alias("g"))


def quantile_score(stats: DataFrame) -> DataFrame:
    """(dimension, pct_rmse, mean_diff, std_ratio, score) from statistics vectors.
    A dimension whose values hold a NaN or an infinity has no score."""
    at = lambda side, stat: F.element_at(F.col(side), _STATS.index(stat) + 1)
    span = F.greatest(F.abs(at("r", "Max") - at("r", "Min")), F.lit(1e-10))
    first, n = _STATS.index("P5") + 1, len(PROBS)
    sq = F.zip_with(
        F.slice("g", first, n), F.slice("r", first, n), lambda a, b: ((a - b) / F.col("span")) * ((a - b) / F.col("span"))
    )
    rs, gs = at("r", "Std"), at("g", "Std")
    ratio = F.when(rs > 1e-10, F.least(rs, gs) / F.greatest(rs, gs)).otherwise(F.lit(1.0))
    near = lambda c: 1 - F.least(F.col(c) * 3, F.lit(1.0))
    odd = F.exists(F.concat("r", "g"), lambda x: F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.greatest(F.lit(0.0), 0.6 * near("pct_rmse") + 0.2 * near("mean_diff") + 0.2 * F.col("std_ratio"))
    return (
        stats.withColumn("span", span)
        .withColumn("odd", odd)
        .withColumn("pct_rmse", F.sqrt(F.aggregate(sq, F.lit(0.0), lambda a, x: a + x) / n))
        .withColumn("mean_diff", F.abs(at("g", "Mean") - at("r", "Mean")) / F.col("span"))
        .withColumn("std_ratio", ratio)
        .select(
            "dimension",
            "pct_rmse",
            "mean_diff",
            "std_ratio",
            F.when(~F.col("odd"), whole).alias("score"),
        )
    )


def numerical_report(stats: DataFrame) -> DataFrame:
    """(dimension, statistic, real_value, gen_value, diff), 14 rows a dimension."""
    row = lambda name, a, b: F.struct(
        F.lit(name).alias("statistic"), a.alias("real_value"), b.alias("gen_value"), (b - a).alias("diff")
    )
    rows = [row(n, F.element_at("r", i + 1), F.element_at("g", i + 1)) for i, n in enumerate(_STATS)]
    vectors = stats.select("dimension", F.inline(F.array(*rows)))
    scored = quantile_score(stats)
    derived = [row(n, F.col(c), F.col(c)) for n, c in (("Pct_RMSE", "pct_rmse"), ("Std_Ratio", "std_ratio"))]
    return vectors.unionByName(scored.select("dimension", F.inline(F.array(*derived))))


# --------------------------------------------------------------------- joint


def joint_key_mean(dim: Joint, tables: Tables) -> DataFrame:
    """(element, mean): mean log10 value per leading category, with support."""
    value = F.col(dim.value).cast("double")
    scope = tables[dim.parent].filter(
        F.col(dim.window_column).between(F.lit(dim.low), F.lit(dim.high)) & (value > 0)
    )
    scope = scope.withColumn("__key", F.col(dim.parent_key).cast("long"))
    child = tables[dim.child].withColumn("__key", F.col(dim.child_key).cast("long"))
    per_key = primary_by_key(scope, "__key", {"log": log10_or_null(value)}, child, "__key", dim.category, dim.rank)
    return (
        per_key.groupBy(F.col("category").alias("element"))
        .agg((F.sum("s_log") / F.sum("n_log")).alias("mean"), F.sum("rows").alias("support"))
        .filter(F.col("support") >= dim.min_support)
        .select("element", "mean")
    )


def joint_pairs(real: DataFrame, gen: DataFrame) -> DataFrame:
    """(element, x, y) for keys found on both sides (NULL matches NULL)."""
    both = real.select("element", F.col("mean").alias("x"), F.lit(None).cast("double").alias("y")).unionByName(
        gen.select("element", F.lit(None).cast("double").alias("x"), F.col("mean").alias("y"))
    )
    return (
        both.groupBy("element")
        .agg(F.max("x").alias("x"), F.max("y").alias("y"))
        .filter(F.col("x").isNotNull() & F.col("y").isNotNull())
    )


def joint_score(pairs: DataFrame) -> DataFrame:
    """One row (n, pearson, rmse, score); 0.5 without a common key."""
    x, y = F.col("x"), F.col("y")
    sums = pairs.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(x).alias("sx"),
        F.sum(y).alias("sy"),
        F.sum(x * y).alias("sxy"),
        F.sum(x * x).alias("sxx"),
        F.sum(y * y).alias("syy"),
        F.greatest(F.max(x) - F.min(x), F.lit(1.0)).alias("span"),
        F.avg((x - y) * (x - y)).alias("mse"),
    )
    n = F.col("n")
    spread = (n * F.col("sxx") - F.col("sx") * F.col("sx")) * (n * F.col("syy") - F.col("sy") * F.col("sy"))
    return (
        sums.withColumn("den", F.sqrt(F.greatest(spread, F.lit(0.0))))
        .withColumn(
            "pearson",
            F.when((n < 2) | (F.col("den") < 1e-10), F.lit(0.0)).otherwise(
                (n * F.col("sxy") - F.col("sx") * F.col("sy")) / F.col("den")
            ),
        )
        .withColumn("rmse", F.sqrt("mse") / F.col("span"))
        .withColumn(
            "score",
            F.when(n == 0, F.lit(0.5)).otherwise(
                0.5 * F.greatest(F.lit(0.0), (F.col("pearson") + 1) / 2)
                + 0.5 * F.greatest(F.lit(0.0), 1 - F.col("rmse") * 2)
            ),
        )
        .select("n", "pearson", "rmse", "score")
    )


# ------------------------------------------------------------------- overall


def summarise(scores: DataFrame, weights: Sequence[Dimension]) -> DataFrame:
    """Add weight, weighted score and grade to (dimension, score) rows."""
    listed = F.array(
        *[F.struct(F.lit(d.name).alias("dimension"), F.lit(float(d.weight)).alias("weight")) for d in weights]
    )
    table = SparkSession.active().range(1).select(F.inline(listed))
    # A categorical dimension without a row is empty on both sides: identical.
    # Any other dimension must have come with a score.
    categories = [d.name for d in weights if isinstance(d, Categorical)]
    lost = F.raise_error(F.concat(F.lit("fidelity dimension without a score: "), F.col("dimension"))).cast("double")
    score = F.when(F.col("found"), F.col("score")).when(F.col("dimension").isin(categories), 1.0).otherwise(lost)
    return (
        table.join(scores.withColumn("found", F.lit(True)), "dimension", "left")
        .select("dimension", score.alias("score"), "weight")
        .withColumn("weighted_score", F.col("score") * F.col("weight"))
        .withColumn("grade", F.when(F.col("score").isNull(), NOT_SCORED).otherwise(grade(F.col("score"))))
    )


def overall_score(summary: DataFrame) -> DataFrame:
    """One row (overall_score, overall_grade): the weighted mean of the dimensions that have a score."""
    summary = summary.filter("score is not null")
    total = F.coalesce(F.try_divide(F.sum(F.col("score") * F.col("weight")), F.sum("weight")), F.lit(0.0))
    return summary.agg(total.alias("overall_score")).withColumn("overall_grade", grade(F.col("overall_score")))


def score_fidelity(
    dims: Sequence[Dimension], real: Tables, gen: Tables, accuracy: int | None = None, stage: bool = True
) -> FidelityReport:
    """Score every dimension.

    The details feed both the scores and their own report tables, so they are
    written once to the shared folder (``stage=False`` keeps them lazy). The
    three kinds of dimensions are computed at the same time.
    """
    spark = SparkSession.active()
    cats = [d for d in dims if isinstance(d, Categorical)]
    nums = [d for d in dims if isinstance(d, Numeric)]
    joints = [d for d in dims if isinstance(d, Joint)]
    keep = runtime.pin if stage else (lambda df: df)
    empty = lambda ddl: spark.createDataFrame([], ddl)

    def joint_detail(d: Joint) -> DataFrame:
        return keep(joint_pairs(joint_key_mean(d, real), joint_key_mean(d, gen)))

    tasks = [lambda: keep(jsd_detail(cats, real, gen)) if cats else None]
    tasks.append(lambda: quantile_stats(nums, real, gen, accuracy) if nums else None)
    tasks += [partial(joint_detail, d) for d in joints]
    detail, stats, *pairs = runtime.together(spark, tasks)

    scores = []
    categorical = empty("dimension string, category string, real_pct double, gen_pct double, diff_pct double")
    if cats:
        scores.append(jsd_score(detail).select("dimension", "score"))
        categorical = categorical_report(detail)
    numerical = empty("dimension string, statistic string, real_value double, gen_value double, diff double")
    if nums:
        scores.append(quantile_score(stats).select("dimension", "score"))
        numerical = numerical_report(stats)
    correlation = empty("element string, real_mean double, gen_mean double, diff double")
    for d, p in zip(joints, pairs):
        scores.append(joint_score(p).select(F.lit(d.name).alias("dimension"), "score"))
        rows = p.select(
            F.col("element").cast("string").alias("element"),
            F.col("x").alias("real_mean"),
            F.col("y").alias("gen_mean"),
            (F.col("y") - F.col("x")).alias("diff"),
        )
        correlation = correlation.unionByName(rows)

    summary = summarise(reduce(DataFrame.unionByName, scores), dims)
    return FidelityReport(summary, categorical, numerical, correlation, overall_score(summary))
