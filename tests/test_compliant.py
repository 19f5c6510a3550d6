"""The compliant filter against the loop it replaces."""

from __future__ import annotations

import random

from pyspark.sql import Window as W
from pyspark.sql import functions as F
from test_constraints import zirconia

from qualityforge.operators.compliant import MOST_BITS, bloom_filter, might_contain, restrict_children
from qualityforge.presets import zirconia as Z


def random_tables(spark, seed, n=400):
    rng = random.Random(seed)
    samples, dopants, phases, sintering = [], [], [], []
    for i in range(1, n + 1):
        c = rng.choice([None, 0.0, 1.0, 1.2, *[round(rng.uniform(0.01, 1), 2)] * 8])
        samples.append((i, rng.randrange(n // 6), float(rng.randrange(290, 1000)), c))
        for _ in range(rng.choice([0, 1, 1, 2])):
            dopants.append((i, rng.choice(["Y", "Sc", "Ti"]), rng.choice([3, 3, 3, 4]), round(rng.uniform(0.0, 0.2), 4)))
        phases.append((i, rng.choice([1, 1, 2, 3]), rng.random() < 0.95))
        sintering.append((i,))
    dopants.append((n + 5, "Ti", 4, 0.1))  # an orphan that violates
    return zirconia(spark, samples, dopants, sintering, phases)


def by_loop(tables):
    """First pass over the unfiltered tables, then monotonic passes to the end."""
    bad = Z.validate_with_ledger(tables).ledger.filter("code NOT LIKE 'HC-6%'").select("entity_id").distinct()
    bad = {r[0] for r in bad.collect()}
    kept = tables["material_samples"].filter(~F.col("sample_id").isin(list(bad)))
    w = W.partitionBy("recipe_group_id").orderBy("operating_temperature", "sample_id")
    while True:
        flagged = kept.withColumn("p", F.lag("conductivity").over(w)).filter("conductivity <= p")
        ids = [r["sample_id"] for r in flagged.collect()]
        if not ids:
            return {r["sample_id"] for r in kept.collect()}
        kept = kept.filter(~F.col("sample_id").isin(ids))


def test_equals_loop_and_is_idempotent(spark):
    for seed in (1, 2):
        tables = random_tables(spark, seed)
        out = Z.compliant(tables)
        ids = {r["sample_id"] for r in out["material_samples"].collect()}
        assert ids == by_loop(tables)
        assert out["material_samples"].columns == tables["material_samples"].columns
        again = Z.compliant({**tables, **out})
        assert {r["sample_id"] for r in again["material_samples"].collect()} == ids
        report = Z.validate({**tables, **out}).collect()
        assert all(r["passed"] for r in report), report
        for child in Z.CHILDREN:
            want = {r["sample_id"] for r in tables[child].collect()} & ids
            assert {r["sample_id"] for r in out[child].collect()} == want


def test_first_pass_sees_the_unfiltered_series(spark):
    samples = [(1, 1, 500.0, 0.1), (2, 1, 600.0, 2.0), (3, 1, 700.0, 0.3)]
    out = Z.compliant(zirconia(spark, samples))
    assert [r["sample_id"] for r in out["material_samples"].collect()] == [1]


def test_fingerprint_series_keep_samples_without_dopants(spark):
    samples = [(1, 0, 500.0, 0.5), (2, 0, 600.0, 0.4), (3, 0, 700.0, 0.1), (4, 0, 800.0, 0.05)]
    tables = zirconia(spark, samples, [(1, "Y", 3, 0.1), (2, "Y", 3, 0.1)])
    tables["material_samples"] = tables["material_samples"].drop("recipe_group_id")
    out = Z.compliant(tables)["material_samples"]
    assert sorted(r["sample_id"] for r in out.collect()) == [1, 3, 4]
    assert out.columns == tables["material_samples"].columns


def test_write_and_read_back(spark, tmp_path):
    tables = random_tables(spark, 3, 200)
    counts = {r["table"]: r["rows"] for r in Z.save_compliant(tables, str(tmp_path) + "/").collect()}
    assert counts["material_samples"] == len(by_loop(tables))
    assert counts["processing_route_dict"] == 19
    stored = spark.read.parquet(f"{tmp_path}/sample_dopants")
    assert stored.count() == counts["sample_dopants"]
    assert stored.join(spark.read.parquet(f"{tmp_path}/material_samples"), "sample_id", "left_anti").count() == 0


def test_restrict_children_does_not_duplicate(spark):
    ids = spark.createDataFrame([(1,), (1,), (2,)], "k long")
    child = spark.createDataFrame([(1, "a"), (3, "b")], "k long, v string")
    assert [tuple(r) for r in restrict_children({"c": child}, ids, "k")["c"].collect()] == [(1, "a")]


def test_children_by_every_route(spark):
    rng = random.Random(5)
    kept = spark.createDataFrame([(i,) for i in range(0, 900) if i % 5] + [(None,)], "k bigint")
    rows = [(rng.choice([None, rng.randrange(1100)]), n, "x") for n in range(4000)]
    child = spark.createDataFrame(rows, "k bigint, n int, kept string")
    want = sorted(n for k, n, _ in rows if k is not None and k < 900 and k % 5)
    few = kept.filter("k < 100")
    want_few = sorted(n for k, n, _ in rows if k is not None and k < 100 and k % 5)
    for ids, expected in ((kept, want), (few, want_few)):
        for rows_, bloom in ((100_000, True), (0, True), (0, False)):
            got = restrict_children({"a": child, "b": child.filter("n < 50")}, ids, "k", max_rows=rows_, bloom=bloom)
            assert got["a"].columns == child.columns
            assert sorted(r["n"] for r in got["a"].collect()) == expected
            assert sorted(r["n"] for r in got["b"].collect()) == [n for n in expected if n < 50]
    none = restrict_children({"a": child}, kept.limit(0), "k")
    assert none["a"].count() == 0 and restrict_children({}, kept, "k") == {}


def test_bloom_filter_never_misses_and_is_bounded(spark):
    ids = spark.range(0, 30_000, 3).withColumnRenamed("id", "k")
    found = bloom_filter(ids, "k", 10_000)
    every = spark.range(30_000).withColumnRenamed("id", "k").select("k", might_contain("k", found).alias("hit"))
    assert every.filter("k % 3 = 0 and not hit").count() == 0
    assert every.filter("k % 3 <> 0 and hit").count() < 0.1 * 20_000
    assert bloom_filter(ids, "k", MOST_BITS) is None


def test_children_are_not_shuffled_when_few_ids_are_lost(spark):
    kept = spark.range(5, 5000).withColumnRenamed("id", "k")
    child = spark.range(20_000).selectExpr("id % 5000 AS k", "id AS n")
    plan = restrict_children({"a": child}, kept, "k")["a"]._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan and "Exchange hashpartitioning" not in plan and "SortMergeJoin" not in plan
    # Behind a filter only the rows that may have lost their parent move.
    plan = restrict_children({"a": child}, kept, "k", max_rows=0)["a"]._jdf.queryExecution().executedPlan().toString()
    assert "Union" in plan and plan.count("getbit") >= 2
