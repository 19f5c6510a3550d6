"""Registered queries: the preset's functions on tables shaped like its own.

Orders stand for samples and lines for dopants, sintering steps and phases. The tables
are built by expressions that mean the same in Spark and in the reference SQL, with
NULLs, unknown ids, orphans and values on both sides of every limit.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualityforge import runtime
from qualityforge.operators import fidelity as fid
from qualityforge.operators.constraints import evaluate, violation_ledger
from qualityforge.plans import matching as M
from qualityforge.plans.quality import ORDER_RULES, ORDER_TABLES, _sql_report
from qualityforge.plans.registry import Lake, query, rounded
from qualityforge.presets import zirconia as Z
from qualityforge.sources import reports

_STAR = {
    "material_samples": (
        "orders", "o_orderkey % 17 <> 0", {
            "sample_id": "o_orderkey",
            "reference": "concat('order ', o_orderkey)",
            "material_source_and_purity": "o_orderpriority",
            "synthesis_method_id": "CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey % 11 AS INT) END",
            "processing_route_id": "CAST(o_custkey % 21 AS INT)",
            "operating_temperature": "CAST(280 + o_orderkey % 1140 AS DOUBLE)",
            "conductivity": "CASE WHEN o_orderkey % 29 <> 0 THEN o_totalprice / 400000 - 0.01 END",
            "recipe_group_id": "o_custkey",
        },
    ),
    "sample_dopants": (
        "lineitem", "l_linenumber <= 4", {
            "sample_id": "l_orderkey",
            "dopant_element": "CASE l_suppkey % 6 WHEN 0 THEN 'Sc' WHEN 1 THEN 'Y' WHEN 2 THEN 'Ce' WHEN 3 THEN 'Ca' WHEN 4 THEN 'Yb' END",
            "dopant_ionic_radius": "l_tax + 1",
            "dopant_valence": "CAST(2 + l_partkey % 3 AS INT)",
            "dopant_molar_fraction": "l_discount * 2",
        },
    ),
    "sintering_steps": (
        "lineitem", "l_linenumber <= 2", {
            "sample_id": "l_orderkey",
            "step_order": "CAST(l_linenumber AS INT)",
            "sintering_temperature": "l_extendedprice / 50",
            "sintering_duration": "l_quantity",
        },
    ),
    "sample_crystal_phases": (
        "lineitem", "l_linenumber <= 2", {
            "sample_id": "l_orderkey",
            "crystal_id": "CAST(1 + l_partkey % 7 AS INT)",
            "is_major_phase": "CASE WHEN l_suppkey % 9 <> 0 THEN l_linenumber = 1 END",
        },
    ),
}


def _star(lake: Lake) -> dict[str, DataFrame]:
    out = {t: lake.table(src).filter(where).selectExpr(*[f"{e} AS {c}" for c, e in cols.items()]) for t, (src, where, cols) in _STAR.items()}
    return out | Z.dictionaries(lake.spark)


def _values(rows: list[tuple], columns: str) -> str:
    text = ", ".join("(" + ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in r) + ")" for r in rows)
    return f"(SELECT * FROM (VALUES {text}) AS d({columns}))"


_WITH = "WITH " + ", ".join(
    [f"{t} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in cols.items())} FROM {src} WHERE {where})" for t, (src, where, cols) in _STAR.items()]
    + [
        f"synthesis_method_dict AS {_values(list(enumerate(Z.SYNTHESIS_METHODS, 1)), 'id, name')}",
        f"processing_route_dict AS {_values(list(enumerate(Z.PROCESSING_ROUTES, 1)), 'id, name')}",
        f"crystal_structure_dict AS {_values(Z.CRYSTAL_STRUCTURES, 'id, code, full_name')}",
    ]
)

# -------------------------------------------------------------------- profile


def _sql_shares(name: str, rows: str) -> str:
    """Counts and shares of a query (item)."""
    counted = f"SELECT item, count(*) AS n, sum(count(*)) OVER () AS total FROM ({rows}) GROUP BY item"
    return (
        f"SELECT '{name}' AS statistic, item, unnest(['cnt', 'pct']) AS measure,"
        f" unnest([n::DOUBLE, round(n * 100.0::DOUBLE / total, 2)]) AS value FROM ({counted})"
    )


def _sql_named(column: str, table: str) -> str:
    return f"SELECT coalesce(name, {column}::VARCHAR) AS item FROM material_samples LEFT JOIN {table} ON {column} = id"


def _sql_summary(name: str, column: str, log10: bool) -> str:
    measures = {"min": f"min({column})", "max": f"max({column})", "avg": f"avg({column})", "median": f"quantile_disc({column}, 0.5)"}
    if log10:
        measures["avg_log10"] = f"avg(CASE WHEN {column} > 0 THEN log10({column}) END)"
    return (
        f"SELECT '{name}' AS statistic, '{column}' AS item, unnest([{', '.join(repr(m) for m in measures)}]) AS measure,"
        f" unnest([{', '.join(measures.values())}]) AS value FROM material_samples"
    )


_SQL_PROFILE = " UNION ALL ".join(
    [
        f"SELECT 'rows' AS statistic, '{t}' AS item, 'cnt' AS measure, count(*)::DOUBLE AS value FROM {t}"
        for t in ("sample_dopants", "material_samples", "sample_crystal_phases")
    ]
    + [
        _sql_shares("Dopant element frequency", "SELECT dopant_element AS item FROM sample_dopants"),
        "SELECT 'Dopant count per sample', n::VARCHAR, 'cnt', count(*)::DOUBLE FROM (SELECT count(*) AS n FROM sample_dopants GROUP BY sample_id) GROUP BY n",
        _sql_shares("Synthesis method distribution", _sql_named("synthesis_method_id", "synthesis_method_dict")),
        _sql_shares("Processing route distribution", _sql_named("processing_route_id", "processing_route_dict")),
        _sql_summary("Conductivity statistics", "conductivity", True),
        _sql_summary("Operating temperature statistics", "operating_temperature", False),
        "SELECT 'Average conductivity by primary dopant', dopant_element, unnest(['avg', 'avg_log10', 'cnt']),"
        " unnest([avg(conductivity), avg(CASE WHEN conductivity > 0 THEN log10(conductivity) END), count(*)::DOUBLE])"
        " FROM material_samples JOIN (SELECT sample_id, dopant_element, row_number() OVER (PARTITION BY sample_id"
        " ORDER BY dopant_molar_fraction DESC, dopant_element NULLS FIRST) AS rn FROM sample_dopants) d USING (sample_id)"
        " WHERE rn = 1 AND operating_temperature BETWEEN 750 AND 850 GROUP BY dopant_element",
        _sql_shares("Crystal phase distribution", "SELECT coalesce(crystal_id::VARCHAR, '-') || ':' || coalesce(is_major_phase::VARCHAR, '-') AS item FROM sample_crystal_phases"),
    ]
)


@query("preset_profile", f"{_WITH} SELECT statistic, item, measure, round(value, 6) AS value FROM ({_SQL_PROFILE}) WHERE value IS NOT NULL")
def preset_profile(lake: Lake) -> DataFrame:
    return rounded(Z.profile(_star(lake)))


# ----------------------------------------------------------------- constraints

_CAPS = " OR ".join(f"(dopant_element = '{e}' AND dopant_molar_fraction > {c})" for e, c in Z.SOLUBILITY_LIMITS.items())
_DOPED = "(SELECT sample_id, round(sum(dopant_molar_fraction), 6) AS total FROM sample_dopants GROUP BY sample_id)"
_SQL_BAD = {
    "HC-1": "SELECT count(*) FROM material_samples WHERE conductivity <= 0",
    "HC-2a": "SELECT count(*) FROM sample_dopants WHERE dopant_molar_fraction <= 0",
    "HC-2b": f"SELECT count(*) FROM sample_dopants WHERE {_CAPS}",
    "HC-3": f"SELECT count(*) FROM {_DOPED} WHERE total > {Z.TOTAL_FRACTION_LIMIT}",
    "HC-4": "SELECT count(*) FROM (SELECT 1 FROM sample_dopants GROUP BY sample_id HAVING sum(CASE WHEN dopant_valence IN (2, 3) THEN 1 ELSE 0 END) = 0)",
    "HC-5": "SELECT count(*) FROM (SELECT 1 FROM sample_crystal_phases GROUP BY sample_id HAVING sum(is_major_phase::INT) <> 1)",
    **{
        f"HC-6{c}": f"SELECT count(*) FROM (SELECT DISTINCT sample_id FROM {t} WHERE sample_id NOT IN (SELECT sample_id FROM material_samples))"
        for c, t in zip("abc", Z.CHILDREN)
    },
    "HC-7": "SELECT count(*) FROM (SELECT conductivity, lag(conductivity) OVER (PARTITION BY recipe_group_id"
    " ORDER BY operating_temperature, sample_id) AS prev FROM material_samples) WHERE conductivity <= prev",
    "HC-8": f"SELECT count(*) FROM {_DOPED} JOIN (SELECT sample_id, count(code) AS n, count(*) FILTER (code = 'c' AND is_major_phase) AS cubic,"
    " count(*) FILTER (code = 'm' AND is_major_phase) AS mono FROM sample_crystal_phases LEFT JOIN crystal_structure_dict ON crystal_id = id"
    f" GROUP BY sample_id) USING (sample_id) WHERE n = 1 AND ((total < {Z.LOW_DOPING} AND cubic > 0) OR (total > {Z.HIGH_DOPING} AND mono > 0))",
    "HC-9": "SELECT count(*) FROM material_samples WHERE conductivity < 1e-8 OR conductivity > 1",
    "HC-10": "SELECT count(*) FROM material_samples WHERE operating_temperature < 300 OR operating_temperature > 1400",
}
_SQL_ALL = {
    **dict.fromkeys(_SQL_BAD, "SELECT count(*) FROM material_samples"),
    **dict.fromkeys(("HC-2a", "HC-2b"), "SELECT count(*) FROM sample_dopants"),
    **{f"HC-6{c}": f"SELECT count(DISTINCT sample_id) FROM {t}" for c, t in zip("abc", Z.CHILDREN)},
}


def _sql_results(bad: dict[str, str], total: dict[str, str]) -> str:
    parts = [f"SELECT '{c}' AS constraint_code, ({total[c]}) AS total_checked, ({bad[c]}) AS violation_count" for c in bad]
    return (
        f"{_WITH} SELECT constraint_code, violation_count = 0 AS passed, total_checked, violation_count,"
        f" round((total_checked - violation_count) * 100.0::DOUBLE / total_checked, 6) AS pass_rate FROM ({' UNION ALL '.join(parts)})"
    )


@query("preset_constraints", _sql_results(_SQL_BAD, _SQL_ALL))
def preset_constraints(lake: Lake) -> DataFrame:
    """All thirteen hard constraints, most of them broken somewhere."""
    return rounded(Z.validate(_star(lake)).drop("constraint_name", "status"))


@query(
    "preset_series",
    f"{_WITH}, f AS (SELECT sample_id, coalesce(string_agg(dopant_element || ':' || dopant_molar_fraction, ',' ORDER BY dopant_element || ':' || dopant_molar_fraction), '') AS f"
    " FROM sample_dopants GROUP BY sample_id) SELECT sample_id AS entity_id, 'HC-7' AS code FROM (SELECT sample_id, conductivity, lag(conductivity) OVER"
    " (PARTITION BY synthesis_method_id, processing_route_id, f ORDER BY operating_temperature, sample_id) AS prev FROM material_samples JOIN f USING (sample_id))"
    " WHERE conductivity <= prev",
)
def preset_series(lake: Lake) -> DataFrame:
    """Falling conductivity within series that only equal dopants, method and route tell."""
    star = _star(lake)
    tables, rule, _ = Z.resolve_series({**star, Z.PARENT: star[Z.PARENT].drop("recipe_group_id")})
    return violation_ledger([rule], tables)


_SQL_DECLARED = {
    "PK-samples": ("SELECT count(DISTINCT sample_id) FROM material_samples", "SELECT count(*) FROM (SELECT 1 FROM material_samples GROUP BY sample_id HAVING count(*) > 1)"),
    "PK-phases": (
        "SELECT count(*) FROM (SELECT DISTINCT sample_id, crystal_id FROM sample_crystal_phases)",
        "SELECT count(*) FROM (SELECT 1 FROM sample_crystal_phases GROUP BY sample_id, crystal_id HAVING count(*) > 1)",
    ),
    "LEN-element": ("SELECT count(*) FROM sample_dopants", "SELECT count(*) FROM sample_dopants WHERE length(dopant_element) > 10"),
    **{f"NN-{t}": (f"SELECT count(*) FROM {t}", f"SELECT count(*) FROM {t} WHERE sample_id IS NULL") for t in Z.CHILDREN},
    **{
        f"FK-{c}": (f"SELECT count(DISTINCT {c}) FROM {t}", f"SELECT count(*) FROM (SELECT DISTINCT {c} FROM {t} WHERE {c} NOT IN (SELECT id FROM {d}))")
        for t, c, d in [
            ("material_samples", "synthesis_method_id", "synthesis_method_dict"),
            ("material_samples", "processing_route_id", "processing_route_dict"),
            ("sample_crystal_phases", "crystal_id", "crystal_structure_dict"),
        ]
    },
}


@query("preset_declared_rules", _sql_results({c: b for c, (_, b) in _SQL_DECLARED.items()}, {c: t for c, (t, _) in _SQL_DECLARED.items()}))
def preset_declared_rules(lake: Lake) -> DataFrame:
    return rounded(evaluate(Z.schema_constraints(), _star(lake)).drop("constraint_name", "status"))


@query(
    "preset_normalised",
    f"{_WITH} SELECT sample_id, m.id AS synthesis_method_id, r.id AS processing_route_id FROM (SELECT sample_id,"
    " (SELECT name FROM synthesis_method_dict WHERE id = synthesis_method_id) AS method,"
    " (SELECT lower(name) FROM processing_route_dict WHERE id = processing_route_id) AS route FROM material_samples)"
    " LEFT JOIN synthesis_method_dict m ON m.name = method LEFT JOIN processing_route_dict r ON r.name = route",
)
def preset_normalised(lake: Lake) -> DataFrame:
    """Flat samples with names, routes in lower case, back to dictionary ids; a name that
    the dictionary does not hold has none."""
    star = _star(lake)
    names = {d: star[d].select("id", F.col("name").alias(n)) for d, n in (("synthesis_method_dict", "synthesis_method"), ("processing_route_dict", "processing_route"))}
    flat = star[Z.PARENT].join(F.broadcast(names["synthesis_method_dict"]), F.col("synthesis_method_id") == F.col("id"), "left").drop("id", "synthesis_method_id")
    flat = flat.join(F.broadcast(names["processing_route_dict"]), F.col("processing_route_id") == F.col("id"), "left").drop("id", "processing_route_id")
    flat = flat.withColumn("processing_route", F.lower("processing_route"))
    out = Z.normalise_flat({**star, Z.PARENT: flat}, star)[Z.PARENT]
    return out.select("sample_id", "synthesis_method_id", "processing_route_id")


# --------------------------------------------------------------- report tables

_JOINT = replace(M.JOINT, child="all_lines")
_META = dict(database_name="orders", total_count=7, sampled_count=5, sample_ratio=0.5, run_at="2024-01-01 00:00:00")
_written: dict[tuple[str, str], str] = {}


def _report_base(lake: Lake) -> str:
    """A constraint and a fidelity run of the orders, written once per session and folder.

    The constraint run is written twice under one id, as after a retry.
    """
    place = (lake.spark.sparkContext.applicationId, lake.base)
    if place not in _written:
        base = runtime.scratch_path(lake.spark, "report-tables")
        found = evaluate(ORDER_RULES, lake.tables(ORDER_TABLES))
        for _ in range(2):
            reports.append_constraint_report(found, reports.RunMeta(run_id=1, **_META), base)
        sides = M._sides(lake)
        for side, whole in zip(sides, M._joint_sides(lake)):
            side["all_lines"] = whole["lineitem"]
        scored = fid.score_fidelity([*M.CATEGORICAL, *M.NUMERIC, _JOINT], *sides)
        reports.append_fidelity_report(scored, reports.RunMeta(run_id=2, **_META), base)
        _written[place] = base
    return _written[place]


def _stored(lake: Lake, table: str, digits: int = 6) -> DataFrame:
    return rounded(reports.read_reports(lake.spark, _report_base(lake), table), digits)


_RUN = ", 'orders' AS database_name, 7::BIGINT AS total_count, 5::BIGINT AS sampled_count, 0.5::DOUBLE AS sample_ratio, '2024-01-01 00:00:00' AS run_at"


@query(
    "report_runs",
    f"SELECT 1::BIGINT AS run_id, 'HARD_CONSTRAINT' AS run_type, bool_and(pass_rate >= 100) AS passed, round(min(pass_rate), 6) AS overall_score,"
    f" NULL::VARCHAR AS overall_grade{_RUN} FROM ({_sql_report([r.code for r in ORDER_RULES])}) UNION ALL"
    f" SELECT 2::BIGINT, 'FIDELITY', NULL, round(s, 6), {M._GRADE.format(s='s')}{_RUN} FROM (SELECT sum(score * weight)"
    f" / sum(weight) AS s FROM ({M._SQL_SCORES}) JOIN ({M._WEIGHTS}) USING (dimension))",
)
def report_runs(lake: Lake) -> DataFrame:
    return _stored(lake, "validation_run")


@query("report_constraints", f"SELECT 1::BIGINT AS run_id, * EXCLUDE (status) FROM ({_sql_report([r.code for r in ORDER_RULES])})")
def report_constraints(lake: Lake) -> DataFrame:
    return _stored(lake, "hard_constraint_result")


@query(
    "report_summary",
    "SELECT 2::BIGINT AS run_id, dimension, round(score, 6) AS score, weight, round(score * weight, 6) AS weighted_score,"
    f" {M._GRADE.format(s='score')} AS grade FROM ({M._SQL_SCORES}) JOIN ({M._WEIGHTS}) USING (dimension)",
)
def report_summary(lake: Lake) -> DataFrame:
    return _stored(lake, "fidelity_summary")


@query(
    "report_categories",
    "SELECT 2::BIGINT AS run_id, dimension, coalesce(category, '(unknown)') AS category, round(p * 100, 6) AS real_pct,"
    f" round(q * 100, 6) AS gen_pct, round(q * 100 - p * 100, 6) AS diff_pct FROM ({M._SQL_PAIRS})",
)
def report_categories(lake: Lake) -> DataFrame:
    return _stored(lake, "fidelity_categorical")


@query("report_numbers", f"SELECT 2::BIGINT AS run_id, * FROM ({M._sql_quantile_detail()})")
def report_numbers(lake: Lake) -> DataFrame:
    return _stored(lake, "fidelity_numerical", 4)


@query(
    "report_correlations",
    "SELECT 2::BIGINT AS run_id, element::VARCHAR AS element, round(x, 6) AS real_log10_conductivity, round(y, 6) AS gen_log10_conductivity,"
    f" round(y - x, 6) AS diff FROM ({M._SQL_JOINT})",
)
def report_correlations(lake: Lake) -> DataFrame:
    return _stored(lake, "fidelity_correlation")
