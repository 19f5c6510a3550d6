"""Score functions reproduce the published scores from the published details."""

from __future__ import annotations

import golden_values as G
import pytest
from pyspark.sql import functions as F

from qualityforge.operators import fidelity as fid
from qualityforge.operators.constraints import run_verdict

RUNS = ["compliant", "raw"]
TOL = 1e-12


def _categorical(spark, run):
    rows = [
        (dim, None if c == "(unknown)" else c, r / 100, g / 100)
        for (rn, dim), cats in G.CATEGORICAL.items() if rn == run for c, r, g in cats
    ]
    return spark.createDataFrame(rows, "dimension string, category string, p double, q double")


def _numerical(spark, run):
    rows = [
        (dim, [v[s][0] for s in fid._STATS], [v[s][1] for s in fid._STATS])
        for (rn, dim), v in G.NUMERICAL.items() if rn == run
    ]
    return spark.createDataFrame(rows, "dimension string, r array<double>, g array<double>")


def _pairs(spark, run):
    return spark.createDataFrame(G.CORRELATION[run], "element string, x double, y double")


@pytest.mark.parametrize("run", RUNS)
def test_categorical_scores(spark, run):
    got = {r["dimension"]: r["score"] for r in fid.jsd_score(_categorical(spark, run)).collect()}
    assert len(got) == 4
    for dim, score in got.items():
        assert score == pytest.approx(G.SUMMARY[(run, dim)][0], abs=TOL)


@pytest.mark.parametrize("run", RUNS)
def test_numerical_scores(spark, run):
    rows = fid.quantile_score(_numerical(spark, run)).collect()
    assert len(rows) == 4
    for r in rows:
        stats = G.NUMERICAL[(run, r["dimension"])]
        assert r["score"] == pytest.approx(G.SUMMARY[(run, r["dimension"])][0], abs=TOL)
        assert r["pct_rmse"] == pytest.approx(stats["Pct_RMSE"][0], abs=TOL)
        assert r["std_ratio"] == pytest.approx(stats["Std_Ratio"][0], abs=TOL)


@pytest.mark.parametrize("run", RUNS)
def test_joint_score(spark, run):
    row = fid.joint_score(_pairs(spark, run)).first()
    assert row["n"] == 9
    assert row["pearson"] == pytest.approx(0.40616, abs=1e-4)
    assert row["rmse"] == pytest.approx(0.34861, abs=1e-4)
    assert row["score"] == pytest.approx(G.SUMMARY[(run, "Dopant-Conductivity Correlation")][0], abs=TOL)


@pytest.mark.parametrize("run", RUNS)
def test_overall(spark, run):
    scores = (
        fid.jsd_score(_categorical(spark, run)).select("dimension", "score")
        .unionByName(fid.quantile_score(_numerical(spark, run)).select("dimension", "score"))
        .unionByName(
            fid.joint_score(_pairs(spark, run)).select(F.lit("Dopant-Conductivity Correlation").alias("dimension"), "score")
        )
    )
    from qualityforge.presets.zirconia import fidelity_dimensions

    summary = fid.summarise(scores, fidelity_dimensions())
    for r in summary.collect():
        score, weight, grade = G.SUMMARY[(run, r["dimension"])]
        assert (r["weight"], r["grade"]) == (weight, grade)
        assert r["weighted_score"] == pytest.approx(score * weight, abs=TOL)
    row = fid.overall_score(summary).first()
    assert row["overall_score"] == pytest.approx(G.OVERALL[run][0], abs=TOL)
    assert row["overall_grade"] == G.OVERALL[run][1]


def test_pass_rates_and_verdict(spark):
    rows = [(t, v, (t - v) * 100.0 / t) for t, v, _ in G.PASS_RATES]
    for (_, _, rate), (_, _, want) in zip(rows, G.PASS_RATES):
        assert rate == pytest.approx(want, abs=TOL)
    df = spark.createDataFrame(rows, "total_checked long, violation_count long, pass_rate double")
    assert tuple(run_verdict(df).first()) == (False, pytest.approx(99.99335867962093, abs=TOL))
    assert tuple(run_verdict(df.filter("violation_count = 0")).first()) == (True, 100.0)
    assert tuple(run_verdict(df.limit(0)).first()) == (True, 100.0)
