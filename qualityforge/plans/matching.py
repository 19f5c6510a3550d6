"""Registered queries: fidelity of one population against another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualityforge.operators import fidelity as fid
from qualityforge.plans.registry import Lake, query, rounded

# Real population: before the cut date (customers: below the balance cut).
CUT, BALANCE = "1997-07-01", 4500

CATEGORICAL = [
    fid.Categorical("Return Flag", "lineitem", "l_returnflag", 0.2),
    # Categories found on one side only, and one NULL category.
    fid.Categorical("Ship Year", "lineitem", "year(l_shipdate)", 0.1),
    fid.Categorical("Priority", "orders", "nullif(o_orderpriority, '5-LOW')", 0.1, where="o_orderstatus <> 'P'"),
    fid.Categorical("Nation", "customer", "c_nationkey", 0.15, dictionary=("nation", "n_nationkey", "n_name")),
]
NUMERIC = [
    fid.Numeric("Price", "lineitem", "l_extendedprice", 0.2),
    fid.Numeric("log10(Total)", "orders", "CASE WHEN o_totalprice > 0 THEN log10(o_totalprice) END", 0.1, "o_totalprice > 0"),
    fid.Numeric("Quantity", "lineitem", "l_quantity", 0.05),
]
JOINT = fid.Joint(
    "Supplier-Total Correlation", "orders", "o_orderkey", "o_totalprice", "o_totalprice", 20000, 400000,
    "lineitem", "l_orderkey", "l_suppkey", "l_extendedprice", 0.1, 3,
)
ALL = [*CATEGORICAL, *NUMERIC, JOINT]


def _sides(lake: Lake) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    cut = F.lit(CUT).cast("timestamp_ntz")
    conditions = {
        "lineitem": F.col("l_shipdate") < cut,
        "orders": F.col("o_orderdate") < cut,
        "customer": F.col("c_acctbal") < BALANCE,
    }
    real = {n: lake.table(n).filter(c) for n, c in conditions.items()}
    gen = {n: lake.table(n).filter(~c) for n, c in conditions.items()}
    for side in (real, gen):
        side["nation"] = lake.nation
    return real, gen


def _joint_sides(lake: Lake) -> tuple[dict[str, DataFrame], dict[str, DataFrame]]:
    real, gen = _sides(lake)
    # Lines follow their order, whenever they were shipped.
    return {**real, "lineitem": lake.lineitem}, {**gen, "lineitem": lake.lineitem}


_IS_REAL = {
    "lineitem": f"l_shipdate < TIMESTAMP '{CUT}'",
    "orders": f"o_orderdate < TIMESTAMP '{CUT}'",
    "customer": f"c_acctbal < {BALANCE}",
}
_SQL_CATEGORY = {
    "Return Flag": "SELECT l_returnflag AS category, {real} AS is_real FROM lineitem",
    "Ship Year": "SELECT CAST(year(l_shipdate) AS VARCHAR) AS category, {real} AS is_real FROM lineitem",
    "Priority": "SELECT nullif(o_orderpriority, '5-LOW') AS category, {real} AS is_real FROM orders WHERE o_orderstatus <> 'P'",
    "Nation": "SELECT coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS category, {real} AS is_real FROM customer"
    " LEFT JOIN nation ON c_nationkey = n_nationkey",
}
_SQL_PAIRS = " UNION ALL ".join(
    f"SELECT '{d.name}' AS dimension, category, count(*) FILTER (WHERE is_real) * 1.0::DOUBLE"
    " / sum(count(*) FILTER (WHERE is_real)) OVER () AS p, count(*) FILTER (WHERE NOT is_real) * 1.0::DOUBLE"
    " / sum(count(*) FILTER (WHERE NOT is_real)) OVER () AS q"
    f" FROM ({_SQL_CATEGORY[d.name].format(real=_IS_REAL[d.table])}) GROUP BY category"
    for d in CATEGORICAL
)
_SQL_JSD = (
    "SELECT dimension, sum(CASE WHEN p > 0 THEN 0.5::DOUBLE * p * ln(p / ((p + q) / 2)) ELSE 0 END"
    " + CASE WHEN q > 0 THEN 0.5::DOUBLE * q * ln(q / ((p + q) / 2)) ELSE 0 END) AS jsd"
    f" FROM ({_SQL_PAIRS}) GROUP BY dimension"
)

_SQL_VALUE = {
    "Price": "SELECT l_extendedprice AS v, {real} AS is_real FROM lineitem",
    "log10(Total)": "SELECT log10(o_totalprice) AS v, {real} AS is_real FROM orders WHERE o_totalprice > 0",
    "Quantity": "SELECT l_quantity AS v, {real} AS is_real FROM lineitem",
}
_SQL_STATS = " UNION ALL ".join(
    f"SELECT '{d.name}' AS dimension, is_real, CAST(count(*) AS DOUBLE) AS n, avg(v) AS mean,"
    " coalesce(stddev_samp(v), 1.0::DOUBLE) AS std, min(v) AS lo,"
    f" quantile_disc(v, [{', '.join(map(str, fid.PROBS))}]) AS qs, max(v) AS hi"
    f" FROM ({_SQL_VALUE[d.name].format(real=_IS_REAL[d.table])}) GROUP BY is_real"
    for d in NUMERIC
)
_SQL_QUANTILE = (
    f"WITH st AS ({_SQL_STATS}), pr AS (SELECT r.dimension, r.n AS rn, g.n AS gn, r.mean AS rmean, g.mean AS gmean,"
    " r.std AS rstd, g.std AS gstd, r.lo AS rlo, g.lo AS glo, r.hi AS rhi, g.hi AS ghi, r.qs AS rq, g.qs AS gq,"
    " greatest(abs(r.hi - r.lo), 1e-10) AS span FROM st r JOIN st g ON r.dimension = g.dimension AND r.is_real"
    " AND NOT g.is_real), sc AS (SELECT *, sqrt(list_sum(list_transform(range(1, 8),"
    " lambda i: ((gq[i] - rq[i]) / span) ** 2)) / 7) AS pct_rmse, abs(gmean - rmean) / span AS mean_diff,"
    " CASE WHEN rstd > 1e-10 THEN least(rstd, gstd) / greatest(rstd, gstd) ELSE 1.0 END AS std_ratio FROM pr)"
)
_SQL_QUANTILE_SCORE = (
    "greatest(0, 0.6::DOUBLE * (1 - least(pct_rmse * 3, 1)) + 0.2::DOUBLE * (1 - least(mean_diff * 3, 1))"
    " + 0.2::DOUBLE * std_ratio)"
)


def _sql_means(side: str) -> str:
    return (
        "SELECT l_suppkey AS element, avg(log10(o_totalprice)) AS mean FROM orders JOIN (SELECT l_orderkey, l_suppkey,"
        " row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_suppkey) AS rn FROM lineitem)"
        f" ON o_orderkey = l_orderkey AND rn = 1 WHERE o_totalprice BETWEEN 20000 AND 400000 AND {side}"
        f" (o_orderdate < TIMESTAMP '{CUT}') GROUP BY l_suppkey HAVING count(*) >= 3"
    )


_SQL_JOINT = f"SELECT r.element, r.mean AS x, g.mean AS y FROM ({_sql_means('')}) r JOIN ({_sql_means('NOT')}) g ON r.element = g.element"
_SQL_JOINT_SCORE = (
    "SELECT n, pearson, rmse, CASE WHEN n = 0 THEN 0.5 ELSE 0.5::DOUBLE * greatest(0, (pearson + 1) / 2)"
    " + 0.5::DOUBLE * greatest(0, 1 - rmse * 2) END AS score FROM (SELECT count(*) AS n, corr(x, y) AS pearson,"
    f" sqrt(avg((x - y) ** 2)) / greatest(max(x) - min(x), 1) AS rmse FROM ({_SQL_JOINT}))"
)
_WEIGHTS = " UNION ALL ".join(f"SELECT '{d.name}' AS dimension, {d.weight}::DOUBLE AS weight" for d in ALL)
_SQL_SCORES = (
    f"SELECT dimension, 1 - jsd / ln(2) AS score FROM ({_SQL_JSD}) UNION ALL"
    f" SELECT * FROM ({_SQL_QUANTILE} SELECT dimension, {_SQL_QUANTILE_SCORE} AS score FROM sc) UNION ALL"
    f" SELECT '{JOINT.name}', score FROM ({_SQL_JOINT_SCORE})"
)
_GRADE = "CASE WHEN {s} >= 0.90 THEN 'EXCELLENT' WHEN {s} >= 0.75 THEN 'GOOD' WHEN {s} >= 0.60 THEN 'FAIR' ELSE 'POOR' END"


@query(
    "jsd_detail",
    "SELECT dimension, coalesce(category, '(unknown)') AS category, round(p * 100, 6) AS real_pct,"
    f" round(q * 100, 6) AS gen_pct, round(q * 100 - p * 100, 6) AS diff_pct FROM ({_SQL_PAIRS})",
)
def jsd_detail(lake: Lake) -> DataFrame:
    return rounded(fid.categorical_report(fid.jsd_detail(CATEGORICAL, *_sides(lake))))


@query("jsd_score", f"SELECT dimension, round(jsd, 6) AS jsd, round(1 - jsd / ln(2), 6) AS score FROM ({_SQL_JSD})")
def jsd_score(lake: Lake) -> DataFrame:
    return rounded(fid.jsd_score(fid.jsd_detail(CATEGORICAL, *_sides(lake))))


def _sql_quantile_detail() -> str:
    rows = [("Count", "rn", "gn"), ("Mean", "rmean", "gmean"), ("Std", "rstd", "gstd"), ("Min", "rlo", "glo")]
    labels = ("P5", "P10", "P25", "P50", "P75", "P90", "P95")
    rows += [(n, f"rq[{i}]", f"gq[{i}]") for i, n in enumerate(labels, 1)]
    rows += [("Max", "rhi", "ghi"), ("Pct_RMSE", "pct_rmse", "pct_rmse"), ("Std_Ratio", "std_ratio", "std_ratio")]
    parts = [
        f"SELECT dimension, '{n}' AS statistic, round({a}, 4) AS real_value, round({b}, 4) AS gen_value,"
        f" round({b} - {a}, 4) AS diff FROM sc"
        for n, a, b in rows
    ]
    return f"{_SQL_QUANTILE} {' UNION ALL '.join(parts)}"


@query("quantile_detail", _sql_quantile_detail())
def quantile_detail(lake: Lake) -> DataFrame:
    return rounded(fid.numerical_report(fid.quantile_stats(NUMERIC, *_sides(lake))), 4)


@query(
    "quantile_score",
    f"{_SQL_QUANTILE} SELECT dimension, round(pct_rmse, 6) AS pct_rmse, round(mean_diff, 6) AS mean_diff,"
    f" round(std_ratio, 6) AS std_ratio, round({_SQL_QUANTILE_SCORE}, 6) AS score FROM sc",
)
def quantile_score(lake: Lake) -> DataFrame:
    return rounded(fid.quantile_score(fid.quantile_stats(NUMERIC, *_sides(lake))))


@query("joint_pairs", f"SELECT element, round(x, 6) AS x, round(y, 6) AS y FROM ({_SQL_JOINT})")
def joint_pairs(lake: Lake) -> DataFrame:
    real, gen = _joint_sides(lake)
    return rounded(fid.joint_pairs(fid.joint_key_mean(JOINT, real), fid.joint_key_mean(JOINT, gen)))


@query(
    "joint_corr",
    f"SELECT n, round(pearson, 6) AS pearson, round(rmse, 6) AS rmse, round(score, 6) AS score FROM ({_SQL_JOINT_SCORE})",
)
def joint_corr(lake: Lake) -> DataFrame:
    real, gen = _joint_sides(lake)
    return rounded(fid.joint_score(fid.joint_pairs(fid.joint_key_mean(JOINT, real), fid.joint_key_mean(JOINT, gen))))


def _scores(lake: Lake) -> DataFrame:
    sides, joint = _sides(lake), _joint_sides(lake)
    pairs = fid.joint_pairs(fid.joint_key_mean(JOINT, joint[0]), fid.joint_key_mean(JOINT, joint[1]))
    return (
        fid.jsd_score(fid.jsd_detail(CATEGORICAL, *sides)).select("dimension", "score")
        .unionByName(fid.quantile_score(fid.quantile_stats(NUMERIC, *sides)).select("dimension", "score"))
        .unionByName(fid.joint_score(pairs).select(F.lit(JOINT.name).alias("dimension"), "score"))
    )


@query(
    "fidelity_summary",
    "SELECT dimension, round(score, 6) AS score, weight, round(score * weight, 6) AS weighted_score,"
    f" {_GRADE.format(s='score')} AS grade FROM ({_SQL_SCORES}) JOIN ({_WEIGHTS}) USING (dimension)",
)
def fidelity_summary(lake: Lake) -> DataFrame:
    return rounded(fid.summarise(_scores(lake), ALL))


@query(
    "fidelity_grade",
    f"SELECT round(s, 6) AS overall_score, {_GRADE.format(s='s')} AS overall_grade FROM (SELECT sum(score * weight)"
    f" / sum(weight) AS s FROM ({_SQL_SCORES}) JOIN ({_WEIGHTS}) USING (dimension))",
)
def fidelity_grade(lake: Lake) -> DataFrame:
    return rounded(fid.overall_score(fid.summarise(_scores(lake), ALL)))
