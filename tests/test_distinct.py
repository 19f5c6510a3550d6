"""Distinct-count sketches: estimates, unions, and storage by run."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from qualityforge.operators import distinct as D
from qualityforge.sources import reports


def _estimates(sketches) -> dict:
    return {r["item"]: (r["n_rows"], r["n_distinct"]) for r in D.estimated(sketches).collect()}


def test_estimates_within_the_stated_error(spark):
    df = spark.range(0, 300_000, 1, 8).select("id", (F.col("id") % 20_000).alias("k"), F.when(F.col("id") % 2 == 0, F.lit("x")).alias("s"))
    found = _estimates(D.distinct_sketches(df, ["id", "k", "s"]))
    for item, rows, exact in (("id", 300_000, 300_000), ("k", 300_000, 20_000), ("s", 150_000, 1)):
        assert found[item][0] == rows
        assert abs(found[item][1] - exact) <= D.stated_error() * exact


def test_unions_do_not_count_shared_values_twice(spark):
    # Runs overlap by half; one holds a third of the rows under one value.
    one = spark.range(0, 40_000).select("id")
    two = spark.range(20_000, 60_000).select("id").union(spark.range(30_000).select(F.lit(7).cast("bigint")))
    parts = D.distinct_sketches(one, ["id"]).union(D.distinct_sketches(two, ["id"]))
    rows, count = _estimates(D.united(parts))["id"]
    assert rows == 110_000
    assert abs(count - 60_000) <= D.stated_error() * 60_000
    whole = _estimates(D.distinct_sketches(one.union(two), ["id"]))["id"]
    assert abs(whole[1] - count) <= D.stated_error() * 60_000


def test_sketches_of_different_sizes_unite(spark):
    df = spark.range(50_000)
    parts = D.distinct_sketches(df, ["id"], lg_k=10).union(D.distinct_sketches(df, ["id"], lg_k=14))
    assert abs(_estimates(D.united(parts))["id"][1] - 50_000) <= D.stated_error(10) * 50_000


def test_groups_nulls_and_empty_tables(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", "x", None), ("b", None, None), (None, "y", 2), (None, "y", 2)], "g string, v string, n int")
    got = {(r["g"], r["item"]): (r["n_rows"], r["n_distinct"]) for r in D.estimated(D.distinct_sketches(df, ["v", "n"], ["g"])).collect()}
    assert got == {
        ("a", "v"): (1, 1), ("a", "n"): (1, 1), ("b", "v"): (0, 0), ("b", "n"): (0, 0), (None, "v"): (2, 1), (None, "n"): (2, 1),
    }
    assert _estimates(D.distinct_sketches(df.limit(0), ["v"])) == {"v": (0, 0)}
    assert D.distinct_sketches(df.limit(0), ["v"], ["g"]).count() == 0


def test_one_scan_and_one_small_shuffle(spark):
    plan = D.distinct_sketches(spark.range(100).withColumn("k", F.col("id") % 3), ["id", "k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (") == 1
    assert plan.count("Exchange ") == 1 and "SinglePartition" in plan


def test_stored_runs_replace_and_select(spark, tmp_path):
    base = str(tmp_path)
    meta = lambda run: reports.RunMeta("lake", 0, 0, run_id=run)
    reports.append_distinct(D.distinct_sketches(spark.range(0, 9_000), ["id"]), meta(1), base)
    reports.append_distinct(D.distinct_sketches(spark.range(0, 1_000), ["id"]), meta(1), base)
    reports.append_distinct(D.distinct_sketches(spark.range(500, 2_000), ["id"]), meta(2), base)
    found = reports.distinct_across(spark, base).first()
    # The later attempt of run 1 stands in place of the first.
    assert found["n_rows"] == 2_500
    assert found["n_distinct"] == pytest.approx(2_000, rel=D.stated_error())
    assert reports.distinct_across(spark, base, [2]).first()["n_rows"] == 1_500
    assert reports.distinct_across(spark, str(tmp_path / "none")).count() == 0
