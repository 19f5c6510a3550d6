"""Keyed draws and the preset generator."""

from __future__ import annotations

import golden_values
import pytest
from pyspark.sql import functions as F

from qualityforge.functions.keyed import Draws, Keyed
from qualityforge.functions.scalars import round_half_up, round_to_step
from qualityforge.operators import synth
from qualityforge.presets import zirconia as Z
from qualityforge.presets import zirconia_recipes as G

N = 20_000


@pytest.fixture(scope="module")
def ids(spark):
    return spark.range(0, N, 1, 8).withColumnRenamed("id", "g")


@pytest.mark.parametrize("source", ["md5", "xxhash64"])
def test_moments(spark, ids, source):
    k = Keyed(("g",), 3, source)
    row = ids.agg(
        F.avg(k.uniform("u")).alias("um"), F.var_samp(k.uniform("u")).alias("uv"),
        F.avg(k.normal("n")).alias("nm"), F.var_samp(k.normal("n")).alias("nv"),
        F.avg(k.gamma("g", 2.5)).alias("gm"), F.var_samp(k.gamma("g", 2.5)).alias("gv"),
        F.avg(k.gamma("s", 0.6)).alias("sm"),
        F.avg(k.beta("b", 3, 4)).alias("bm"), F.var_samp(k.beta("b", 3, 4)).alias("bv"),
        F.avg(k.beta("r", 2.5, 0.7)).alias("rm"),
        F.corr(k.uniform("u"), k.uniform("v")).alias("c1"), F.corr(k.uniform("u", 0), k.uniform("u", 1)).alias("c2"),
    ).first()
    assert row["um"] == pytest.approx(0.5, abs=0.01) and row["uv"] == pytest.approx(1 / 12, abs=0.003)
    assert row["nm"] == pytest.approx(0, abs=0.03) and row["nv"] == pytest.approx(1, abs=0.05)
    assert row["gm"] == pytest.approx(2.5, abs=0.06) and row["gv"] == pytest.approx(2.5, abs=0.2)
    assert row["sm"] == pytest.approx(0.6, abs=0.03)
    assert row["bm"] == pytest.approx(3 / 7, abs=0.01) and row["bv"] == pytest.approx(12 / (49 * 8), abs=0.003)
    assert row["rm"] == pytest.approx(2.5 / 3.2, abs=0.01)
    assert abs(row["c1"]) < 0.03 and abs(row["c2"]) < 0.03


def test_choice_and_sampling_without_replacement(spark, ids):
    k = Keyed(("g",), 1, "xxhash64")
    items = [("a", 5.0), ("b", 3.0), ("c", 2.0)]
    shares = {r[0]: r[1] / N for r in ids.groupBy(k.choice("c", items)).count().collect()}
    assert shares == {"a": pytest.approx(0.5, abs=0.02), "b": pytest.approx(0.3, abs=0.02), "c": pytest.approx(0.2, abs=0.02)}
    arr = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(w).alias("w")) for n, w in items])
    drawn = ids.select(F.array_join(F.transform(k.sample_without_replacement("s", arr, "w", 2), lambda x: x["n"]), "").alias("s"))
    pairs = {r["s"]: r["count"] / N for r in drawn.groupBy("s").count().collect()}
    # Sequential law: P(ab) = .5 * 3/5, P(ba) = .3 * 5/7, ...
    assert pairs["ab"] == pytest.approx(0.5 * 3 / 5, abs=0.02)
    assert pairs["ba"] == pytest.approx(0.3 * 5 / 7, abs=0.02)
    assert pairs["cb"] == pytest.approx(0.2 * 3 / 8, abs=0.02)
    assert all(len(set(p)) == 2 for p in pairs)


def test_rounding(spark):
    df = spark.createDataFrame([(0.00005,), (0.12345,), (-2.5,)], "x double")
    assert [r[0] for r in df.select(round_half_up(F.col("x"), 4)).collect()] == [0.0001, 0.1235, -2.5]
    assert spark.range(1).select(round_to_step(F.lit(3.2), 10), round_to_step(F.lit(15.0), 10)).first()[:] == (0.0, 20.0)


def test_repair_budget_and_retry(spark):
    df = spark.createDataFrame([([0.2, 0.9, 0.5, 1.2, 0.3],)], "s array<double>")
    fixed = df.select(synth.monotone_repair(F.col("s"), lambda i: F.lit(1.05), 1.0)).first()[0]
    assert fixed == pytest.approx([0.2, 0.9, 0.945, 1.2, 1.0])
    capped = spark.createDataFrame([([0.99, 0.9, 0.8],)], "s array<double>")
    assert capped.select(synth.monotone_repair(F.col("s"), lambda i: F.lit(1.05), 1.0)).first()[0] == [0.99, 1.0, 1.0]
    assert capped.select(synth.monotone_repair(F.col("s"), lambda i: F.lit(1.05), 1.0, True)).first()[0] == [0.99, 1.0]

    items = spark.createDataFrame([([(0.5, 0.2), (0.00001, 0.1), (0.4, 0.09), (0.3, 0.3)],)], "a array<struct<f:double,cap:double>>")
    kept = items.select(synth.running_budget(F.col("a"), "f", "cap", 0.001, 0.30, 4, "struct<f:double,cap:double>")).first()[0]
    # The second amount is lifted to the minimum and then not above it.
    assert [r["f"] for r in kept] == [0.2, 0.09, 0.01]

    never = synth.retry_until(lambda i: i.cast("double"), lambda x: x > 100, 5, F.lit(-1.0), "double")
    third = synth.retry_until(lambda i: i.cast("double"), lambda x: x >= 3, 50, F.lit(-1.0), "double")
    assert spark.range(1).select(never, third).first()[:] == (-1.0, 3.0)


def test_fan_out_of_empty_arrays(spark):
    rows = [(0, [(1.0,), (2.0,)], [("a",)]), (1, [(3.0,)], []), (2, [], [("b",)])]
    df = spark.createDataFrame(rows, "g long, p array<struct<v:double>>, c array<struct<t:string>>")
    out = synth.fan_out(df, "g", "p", {"c": "c"}, "id", 100, 8)
    assert sorted(tuple(r) for r in out["parent"].collect()) == [(100, 0, 1.0), (101, 0, 2.0), (108, 1, 3.0)]
    assert sorted(tuple(r) for r in out["c"].collect()) == [(100, 0, "a"), (101, 0, "a")]


@pytest.fixture(scope="module")
def generated(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("gen"))
    ids = synth.entity_ids(spark, N, "recipe_group_id", 8)
    G.write_generated(G.recipe_groups(ids), base, base + "/staged")
    return {n: spark.read.parquet(f"{base}/{n}") for n in (Z.PARENT, *Z.CHILDREN, *Z.DICTIONARIES)}


def test_only_the_plateau_violates(generated):
    rows = {r["constraint_code"]: r for r in Z.validate(generated).collect()}
    assert len(rows) == 13
    for code, r in rows.items():
        assert r["passed"] or code == "HC-7", r
    tables, rule, _ = Z.resolve_series(generated)
    from qualityforge.operators.constraints import monotonic_violations

    bad = monotonic_violations(rule, tables[Z.PARENT])
    assert bad.filter("conductivity < 1.0").count() == 0
    assert rows["HC-7"]["violation_count"] / rows["HC-7"]["total_checked"] < 0.0005


def test_marginals_match_the_published_population(spark, generated):
    """Shares within sampling error of the published generated data."""
    published = {}
    for (run, dim), rows in golden_values.CATEGORICAL.items():
        if run == "raw":
            published[dim] = {c: g / 100 for c, _, g in rows if g > 0}
    dims = [d for d in Z.fidelity_dimensions() if d.name in published]
    from qualityforge.operators.fidelity import jsd_detail

    got: dict[str, dict] = {}
    for r in jsd_detail(dims, generated, generated).collect():
        got.setdefault(r["dimension"], {})[r["category"]] = r["q"]
    for dim, shares in published.items():
        assert set(got[dim]) <= set(shares)
        for c, share in shares.items():
            assert got[dim].get(c, 0.0) == pytest.approx(share, abs=0.012), (dim, c)


def test_numeric_population_matches(generated):
    want = {d: v for (run, d), v in golden_values.NUMERICAL.items() if run == "raw"}
    s, d, t = generated[Z.PARENT], generated["sample_dopants"], generated["sintering_steps"]
    row = s.agg(
        F.avg("operating_temperature"), F.stddev_samp("operating_temperature"), F.avg(F.log10("conductivity")),
        F.stddev_samp(F.log10("conductivity")),
    ).first()
    assert row[0] == pytest.approx(want["Operating Temperature"]["Mean"][1], abs=4)
    assert row[1] == pytest.approx(want["Operating Temperature"]["Std"][1], abs=4)
    assert row[2] == pytest.approx(want["log10(Conductivity)"]["Mean"][1], abs=0.05)
    assert row[3] == pytest.approx(want["log10(Conductivity)"]["Std"][1], abs=0.05)
    assert d.agg(F.avg("dopant_molar_fraction")).first()[0] == pytest.approx(
        want["Dopant Molar Fraction"]["Mean"][1], abs=0.0015
    )
    assert t.agg(F.avg("sintering_temperature")).first()[0] == pytest.approx(want["Sintering Temperature"]["Mean"][1], abs=3)
    n, groups = s.count(), s.select("recipe_group_id").distinct().count()
    assert groups == N and n / groups == pytest.approx(4.07, abs=0.03)
    assert d.count() / n == pytest.approx(190974012 / 113968301, abs=0.02)
    assert t.count() / n == pytest.approx(114967369 / 113968301, abs=0.01)


def test_structure(generated):
    s = generated[Z.PARENT]
    assert s.filter("recipe_group_id != floor((sample_id - 10000001) / 8)").count() == 0
    rf = s.filter("processing_route_id = 11").select("sample_id")
    assert rf.count() > 0 and generated["sintering_steps"].join(rf, "sample_id", "left_semi").count() == 0
    texts = s.select("material_source_and_purity").distinct()
    known = r"^(Commercial |Zirconium |Self-prepared ).*\.$"
    assert texts.filter(~F.col("material_source_and_purity").rlike(known)).count() == 0
    assert s.filter("operating_temperature <> round(operating_temperature)").count() == 0


def test_independent_of_partitioning(spark):
    def rows(parts):
        ids = synth.entity_ids(spark, 300, "recipe_group_id", parts)
        return {n: sorted(map(str, df.collect())) for n, df in G.expand(G.recipe_groups(ids)).items()}

    assert rows(1) == rows(7)


def test_strict_series_pass_everything(spark):
    tables = {**G.generate(spark, 3000, partitions=4, strict=True), **Z.dictionaries(spark)}
    assert all(r["passed"] for r in Z.validate(tables).collect())


def test_a_draw_hashes_the_places_that_are_not_null(spark):
    df = spark.createDataFrame([(5, "a", 2), (None, "b", None), (7, None, 3)], "k long, s string, i int")
    text = F.concat_ws(":", F.lit("3"), F.lit("x"), F.col("k").cast("string"), F.col("s"), F.col("i").cast("string"), F.lit("4"))
    plain = (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") + 0.5) / 2.0**32
    k = Keyed(("k", "s"), 3)
    drawn = df.select(plain.alias("a"), k.uniform("x", F.col("i"), 4).alias("b"), k._uniforms("x", 5, F.col("i"))[4].alias("c"))
    assert all(r["a"] == r["b"] == r["c"] for r in drawn.collect())
    plan = drawn._jdf.queryExecution().analyzed().toString()
    assert plan.count("concat_ws") == 1


def test_wide_draws_use_every_core(spark, tmp_path):
    from qualityforge.plans import generation, registry

    spark.range(40).selectExpr("id as c_custkey").coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    out = generation.keyed_wide(registry.Lake(spark, str(tmp_path)))
    assert "Exchange hashpartitioning(c_custkey" in out._jdf.queryExecution().executedPlan().toString()


def test_children_of_a_recipe_need_no_conductivity(spark):
    tables = G.expand(G.recipe_groups(spark.range(3).withColumnRenamed("id", "recipe_group_id")))
    for name in ("sample_dopants", "sintering_steps", "sample_crystal_phases"):
        assert "cond/" not in tables[name]._jdf.queryExecution().optimizedPlan().toString()


def test_draws_ahead_equal_those_hashed_one_by_one(spark):
    rows = [(5, "a"), (None, "b"), (-7, None), (10**17, "ä" * 3), (None, None), (3, "x" * 60), (5, "a")]
    df = spark.createDataFrame(rows, "k long, s string").withColumn("i", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2), F.lit(None).cast("int"))))
    k = Keyed(("k", "s"), 3)
    plan = {"one": [Draws("u"), Draws("x", first=1, indices=2), Draws("p", parts=3)], "two": [Draws("n/r", indices=2), Draws("n/a")]}
    held, ahead = k.ahead(df, plan)
    items = F.array(*[F.struct(F.lit(n).alias("n"), F.lit(w).alias("w")) for n, w in (("a", 5.0), ("b", 3.0), ("c", 2.0))])

    def drawn(k):
        i = F.col("i")
        return {
            "u": k.uniform("u"), "u1": k.uniform("u", 1), "ui": k.uniform("u", i), "x": k.uniform("x", 2), "xi": k.uniform("x", i),
            "up": k.uniform("u", 0, 1), "p": k.uniform("p", 0, 2), "p3": k.uniform("p", 0, 3), "pi": k.uniform("p", i, i), "bare": k.uniform("p"),
            "few": k._uniforms("p", 2, i), "many": k._uniforms("p", 4, 0), "n": k.normal("n", i), "c": k.choice("u", [("a", 1.0), ("b", 1.0)]),
            "sample": k.sample_without_replacement("p", items, "w", 2, i), "none": k.sample_without_replacement("p", F.filter(items, lambda x: x["w"] > 9), "w", 2),
            "o": k.drawing_order("p", [("a", 5.0), ("b", 3.0), ("c", 2.0)]),
        }

    one, all_ = (out.select("k", "s", "i", *[c.alias(n) for n, c in drawn(d).items()]) for out, d in ((df, k), (held, ahead)))
    assert sorted(map(str, one.collect())) == sorted(map(str, all_.collect()))
    assert one.filter(F.col("o")[0]["v"] != F.col("sample")[0]["n"]).filter("i = 0").count() == 0
    assert spark.createDataFrame([], "k long, s string").transform(lambda e: k.ahead(e, plan)[0]).count() == 0


def test_a_recipe_hashes_its_common_draws_in_batches(spark):
    groups = G.recipe_groups(spark.range(3).withColumnRenamed("id", "recipe_group_id"), source="md5")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "ArrowEvalPython" in plan(groups) and "md5(" not in plan(groups.select("recipe_group_id", "synthesis_method_id", "processing_route_id"))
    dopants = plan(G.expand(groups)["sample_dopants"])
    assert "_dopant_draws" in dopants and "_conductivity_draws" not in dopants


def test_an_accepted_attempt_is_not_carried_through_the_others(spark):
    found = synth.retry_until(lambda i: F.array(i), lambda a: a[0] >= F.col("id"), 3, F.array(F.lit(-1)), "array<int>")
    assert [r[0] for r in spark.range(5).select(found).collect()] == [[0], [1], [2], [-1], [-1]]
    text = spark.range(1).select(found)._jdf.queryExecution().analyzed().toString()
    assert "sequence(1, 2" in text and "sequence(0" not in text
    assert spark.range(1).select(synth.retry_until(lambda i: i, lambda a: a >= 0, 1, F.lit(-1), "int")).first()[0] == 0
