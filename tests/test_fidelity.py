"""Edge cases of the scores and a comparison with plain Python."""

from __future__ import annotations

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from qualityforge.functions.scalars import grade
from qualityforge.operators import fidelity as fid
from qualityforge.operators.quantiles import column_stats, exact_quantiles, rank_of


def _cats(spark, values):
    return {"t": spark.createDataFrame([(v,) for v in values], "c string")}


CAT = [fid.Categorical("dim", "t", "c")]


def _jsd(spark, real, gen):
    detail = fid.jsd_detail(CAT, _cats(spark, real), _cats(spark, gen))
    rows = fid.jsd_score(detail).collect()
    return detail, rows[0]["score"] if rows else None


def test_identical_and_disjoint(spark):
    assert _jsd(spark, ["a", "b", "b"], ["b", "a", "b"])[1] == pytest.approx(1.0)
    assert _jsd(spark, ["a", "a"], ["b"])[1] == pytest.approx(0.0)


def test_null_is_its_own_category(spark):
    detail, score = _jsd(spark, [None, "(unknown)", "x", "x"], ["x", "x", "y", None])
    got = {r["category"]: (r["p"], r["q"]) for r in detail.collect()}
    assert got == {None: (0.25, 0.25), "(unknown)": (0.25, 0.0), "x": (0.5, 0.5), "y": (0.0, 0.25)}
    assert 0 < score < 1
    shown = [r["category"] for r in fid.categorical_report(detail).collect()]
    assert shown.count("(unknown)") == 2


def test_empty_sides(spark):
    assert _jsd(spark, ["a", "b"], [])[1] == pytest.approx(0.5)
    none = fid.jsd_score(fid.jsd_detail(CAT, _cats(spark, []), _cats(spark, [])))
    row = fid.summarise(none.select("dimension", "score"), CAT).first()
    assert (row["score"], row["grade"]) == (1.0, "EXCELLENT")


def test_dictionary_names_merge_and_fall_back(spark):
    dims = [fid.Categorical("d", "t", "c", dictionary=("names", "id", "name"))]
    names = spark.createDataFrame([(1, "one"), (2, "one"), (3, None)], "id int, name string")
    sides = [{"t": spark.createDataFrame([(i,) for i in ids], "c int"), "names": names} for ids in ([1, 2, 3, 9], [1, 3])]
    got = {r["category"]: (r["p"], r["q"]) for r in fid.jsd_detail(dims, *sides).collect()}
    assert got == {"one": (0.5, 0.5), "3": (0.25, 0.5), "9": (0.25, 0.0)}


def _nums(spark, values):
    return {"t": spark.createDataFrame([(v,) for v in values], "x double")}


NUM = [fid.Numeric("dim", "t", "x")]


@pytest.mark.parametrize("accuracy", [None, 10_000])
def test_one_row_and_constant_populations(spark, accuracy):
    one = fid.quantile_stats(NUM, _nums(spark, [2.0]), _nums(spark, [2.0]), accuracy)
    assert one.first()["r"][:4] == [1.0, 2.0, 1.0, 2.0]  # missing spread becomes 1
    assert fid.quantile_score(one).first()["score"] == pytest.approx(1.0)
    flat = fid.quantile_stats(NUM, _nums(spark, [2.0, 2.0]), _nums(spark, [2.0, 2.0, 2.0]), accuracy)
    assert fid.quantile_score(flat).first()["std_ratio"] == 1.0


def test_count_includes_nulls_without_a_condition(spark):
    plain = fid.quantile_stats(NUM, _nums(spark, [1.0, None, 3.0]), _nums(spark, [1.0]))
    assert plain.first()["r"][0] == 3.0
    dims = [fid.Numeric("dim", "t", "log10(x)", where="x > 0")]
    positive = fid.quantile_stats(dims, _nums(spark, [10.0, 100.0, None, -5.0]), _nums(spark, [10.0]))
    assert positive.first()["r"][0] == 2.0


@pytest.mark.parametrize("accuracy", [None, 10_000])
def test_empty_population_fails_with_its_name(spark, accuracy):
    with pytest.raises(Exception, match="dim"):
        fid.quantile_stats(NUM, _nums(spark, []), _nums(spark, [1.0]), accuracy).collect()


def _joint(spark, pairs):
    return fid.joint_score(spark.createDataFrame(pairs, "element string, x double, y double")).first()


def test_joint_edges(spark):
    assert _joint(spark, [])["score"] == 0.5
    single = _joint(spark, [("a", -1.0, -1.0)])
    assert (single["pearson"], single["score"]) == (0.0, 0.75)
    assert _joint(spark, [("a", 1.0, 1.0), ("b", 2.0, 2.0)])["score"] == pytest.approx(1.0)
    assert _joint(spark, [("a", 1.0, 5.0), ("b", 1.0, 6.0)])["pearson"] == 0.0


def test_joint_support_ties_and_null_rank(spark):
    parent = spark.createDataFrame([(i, 800.0, 10.0 ** (-i)) for i in range(1, 6)] + [(6, 800.0, 0.0)], "k long, t double, y double")
    child = spark.createDataFrame(
        [(1, "A", 0.1), (1, "B", 0.2), (2, "B", 0.1), (2, "A", 0.1), (3, "A", None), (3, "B", 0.01), (4, "A", 0.3), (5, "A", 0.3)],
        "k int, e string, f double",
    )
    dim = fid.Joint("j", "p", "k", "y", "t", 700, 900, "c", "k", "e", "f", min_support=3)
    got = {r["element"]: r["mean"] for r in fid.joint_key_mean(dim, {"p": parent, "c": child}).collect()}
    # Leaders: 1 B, 2 A (tie by name), 3 B (NULL last), 4 A, 5 A; B has support 2.
    assert got == {"A": pytest.approx((-2 - 4 - 5) / 3)}


def test_grades(spark):
    df = spark.createDataFrame([(0.9,), (0.75,), (0.6,), (0.5999,)], "s double")
    assert [r[0] for r in df.select(grade(F.col("s"))).collect()] == ["EXCELLENT", "GOOD", "FAIR", "POOR"]


def test_exact_quantiles(spark):
    rng = random.Random(5)
    data = {
        "uniform": [rng.uniform(-3, 9) for _ in range(5000)],
        "outlier": [rng.gauss(0, 1e-3) for _ in range(4999)] + [1e12],
        "ties": [float(rng.choice([1, 1, 1, 2, 7])) for _ in range(5000)],
        "nulls": [None if rng.random() < 0.9 else rng.random() for _ in range(5000)],
        "none": [None] * 5000,
    }
    schema = ", ".join(f"{n} double" for n in data)
    df = spark.createDataFrame(list(zip(*data.values())), schema).repartition(6)
    probs = [0.001, 0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 1.0]
    for finish in (50_000, 3):  # few and many rounds
        got = exact_quantiles(df, {n: F.col(n) for n in data}, probs, finish=finish)
        for n, values in data.items():
            kept = sorted(v for v in values if v is not None)
            want = [kept[rank_of(p, len(kept)) - 1] for p in probs] if kept else None
            assert got[n] == want, (n, finish)


def test_a_sketch_that_misses_does_not_show(spark):
    rng = random.Random(6)
    data = [(rng.gauss(0, 1), float(rng.randrange(40))) for _ in range(6000)]
    df = spark.createDataFrame(data, "a double, b double").repartition(8)
    values, probs = {n: F.col(n) for n in "ab"}, [0.01, 0.3, 0.5, 0.99]
    want = {n: [sorted(r[i] for r in data)[rank_of(p, 6000) - 1] for p in probs] for i, n in enumerate("ab")}
    for sketch, margin in ((8, 0.0), (8, 0.02), (200, 0.0), (2048, 0.6)):
        stats = column_stats(df, values, probs, sketch=sketch, margin=margin)
        assert exact_quantiles(df, values, probs, stats, finish=100) == want
    assert stats["b"].mean == pytest.approx(statistics.fmean(r[1] for r in data), rel=1e-12)
    assert stats["a"].std == pytest.approx(statistics.stdev(r[0] for r in data), rel=1e-12)


def counted_reads(spark, df):
    """The frame, and how often each of its rows has been read since."""
    rows, reads = df.count(), spark.sparkContext.accumulator(0)

    def through(batches):
        for b in batches:
            reads.add(b.num_rows)
            yield b

    return df.mapInArrow(through, df.schema), lambda: reads.value / rows


def test_numeric_dimensions_share_two_scans(spark):
    rng = random.Random(7)
    df = spark.createDataFrame([(rng.random(), rng.gauss(5, 9), float(i % 7)) for i in range(5000)], "a double, b double, c double")
    seen, times = counted_reads(spark, df.repartition(4))
    got = exact_quantiles(seen, {n: F.col(n) for n in "abc"}, fid.PROBS)
    assert times() == 2 and got["c"] == [0.0, 0.0, 1.0, 3.0, 5.0, 6.0, 6.0]


def test_categorical_dimensions_share_one_scan(spark):
    rows = [(str(i % 3), i % 5, None if i % 4 else "x") for i in range(900)]
    seen, times = counted_reads(spark, spark.createDataFrame(rows, "a string, b int, c string"))
    dims = [fid.Categorical("a", "t", "a"), fid.Categorical("b", "t", "b", where="b > 1"), fid.Categorical("c", "t", "c")]
    other = {"t": spark.createDataFrame(rows[:100], "a string, b int, c string")}
    detail = fid.jsd_detail(dims, {"t": seen}, other)
    got = {(r["dimension"], r["category"]): r["p"] for r in fid.runtime.pin(detail).collect()}
    assert times() == 1
    assert got[("b", "2")] == pytest.approx(1 / 3) and ("b", "1") not in got and got[("c", None)] == 0.75


def test_score_against_python(spark):
    rng = random.Random(1)
    a, b = [rng.gauss(0, 1) for _ in range(800)], [rng.gauss(0.3, 1.4) for _ in range(500)]

    def q(v, p):
        return sorted(v)[rank_of(p, len(v)) - 1]

    span = max(a) - min(a)
    rmse = math.sqrt(sum(((q(b, p) - q(a, p)) / span) ** 2 for p in fid.PROBS) / len(fid.PROBS))
    md = abs(statistics.fmean(b) - statistics.fmean(a)) / span
    sr = min(statistics.stdev(a), statistics.stdev(b)) / max(statistics.stdev(a), statistics.stdev(b))
    want = max(0, 0.6 * (1 - min(3 * rmse, 1)) + 0.2 * (1 - min(3 * md, 1)) + 0.2 * sr)
    stats = fid.quantile_stats(NUM, _nums(spark, a), _nums(spark, b))
    assert fid.quantile_score(stats).first()["score"] == pytest.approx(want, abs=1e-12)


def test_values_that_are_not_finite_leave_the_other_dimensions(spark):
    from qualityforge.operators import fidelity as V

    rows = [(float(i), float("nan") if i == 3 else float(i), float("inf") if i == 4 else 1.0 * i) for i in range(50)]
    t = {"t": spark.createDataFrame(rows, "a double, b double, c double")}
    dims = [V.Numeric(n, "t", n) for n in ("a", "b", "c")]
    report = V.score_fidelity(dims, t, t)
    got = {r["dimension"]: (r["score"], r["grade"]) for r in report.summary.collect()}
    assert got["b"] == got["c"] == (None, V.NOT_SCORED)
    assert got["a"][0] == 1.0 and report.overall.first()["overall_score"] == 1.0


def test_a_lost_dimension_raises(spark):
    from qualityforge.operators import fidelity as V

    scores = spark.createDataFrame([("a", 0.5)], "dimension string, score double")
    dims = [V.Numeric("a", "t", "a"), V.Numeric("misspelt", "t", "a")]
    with pytest.raises(Exception, match="misspelt"):
        V.summarise(scores, dims).collect()


def test_stacked_values_need_no_interpreted_function(spark):
    from qualityforge.operators.profile import stacked_pairs
    from qualityforge.operators.quantiles import _counted

    df = spark.createDataFrame([(1.0, "a"), (2.0, "b"), (2.0, None), (9.0, "a"), (None, "a"), (float("nan"), "b")], "x double, k string")
    plan = lambda out: out._jdf.queryExecution().optimizedPlan().toString()
    counted = _counted(df, {"x": F.expr("CASE WHEN x > 0 THEN x END"), "y": F.col("x") * 2}, {"x": [(2.0, 3.0), (8.0, 8.5)], "y": [(18.0, 18.0)]})
    assert "lambda" not in plan(counted)
    rows = {(r["c"], r["zone"], str(r["v"])): r["w"] for r in counted.collect()}
    assert rows == {(0, 0, "None"): 1, (0, 1, "2.0"): 2, (0, 4, "None"): 2, (1, 0, "None"): 3, (1, 1, "18.0"): 1, (1, 2, "None"): 1}
    stacked = stacked_pairs(df, [(0, F.col("k"), None), (1, F.col("x") > 1, None)])
    assert "lambda" not in plan(stacked)
    assert sorted(map(str, stacked.collect())) == sorted(
        f"Row(d={d}, category={c!r})"
        for d, c in [*((0, k) for k in ("a", "b", None, "a", "a", "b")), *((1, x) for x in ("false", "true", "true", "true", None, "true"))]
    )
