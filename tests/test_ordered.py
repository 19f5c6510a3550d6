"""Ordered scans against plain Python, on the plain and on the split path."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from qualityforge import runtime
from qualityforge.operators import ordered
from qualityforge.operators.ordered import Skew, not_increasing, strict_prefix_maxima, with_previous

PLAIN = Skew(enabled=False)
SPLIT = Skew(rows=120)


def loop_survivors(rows):
    """Remove rows not above their predecessor until none is left."""
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    kept = []
    for series in groups.values():
        series = sorted(series, key=lambda r: (r[2], r[0]))
        while True:
            bad = {
                b[0] for a, b in zip(series, series[1:]) if a[3] is not None and b[3] is not None and b[3] <= a[3]
            }
            if not bad:
                break
            series = [r for r in series if r[0] not in bad]
        kept += [r[0] for r in series]
    return sorted(kept)


def previous(rows):
    out, groups = {}, {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    for series in groups.values():
        series = sorted(series, key=lambda r: (r[2], r[0]))
        for a, b in zip([None, *series], series):
            out[b[0]] = a[3] if a else None
    return out


def make(seed, n=4000, groups=400, tie=False, increasing=False):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        # A third of all rows in one group, another tenth in the NULL group.
        u = rng.random()
        g = 7 if u < 0.34 else None if u < 0.44 else rng.randrange(groups)
        x = float(rng.choice([1, 2, 5, 5, 5, 5, 9])) if tie else round(rng.uniform(0, 1000), 1)
        y = None if rng.random() < 0.02 else round((i if increasing else 0) * 0.01 + rng.uniform(0, 5), 2)
        rows.append((i, g, x, y))
    rng.shuffle(rows)
    return rows


CASES = [dict(seed=1), dict(seed=2, tie=True), dict(seed=3, increasing=True), dict(seed=4, groups=3)]


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("skew", [PLAIN, SPLIT], ids=["plain", "split"])
def test_scans(spark, case, skew):
    rows = make(**case)
    df = spark.createDataFrame(rows, "id long, g int, x double, y double").repartition(5)
    got = {r["id"]: r["previous"] for r in with_previous(df, ["g"], ["x", "id"], "y", skew=skew).collect()}
    assert got == previous(rows)
    kept = [r["id"] for r in strict_prefix_maxima(df, ["g"], ["x", "id"], "y", skew).collect()]
    assert sorted(kept) == loop_survivors(rows)


def test_split_path_is_taken_and_bounded(spark):
    from qualityforge.operators.ordered import _series

    rows = make(5, n=6000, tie=True)
    df = spark.createDataFrame(rows, "id long, g int, x double, y double")
    hot = runtime.hot_groups(df, ["g"], 300)
    assert sorted(r["n"] for r in hot.collect()) == sorted(sum(r[1] == g for r in rows) for g in (7, None))
    # One x value holds 4/7 of the hot group, so only the tie-breaker can split it.
    for limit in (200, 600):
        s = _series(df, ["g"], ["x", "id"], "y", Skew(rows=limit))
        sizes = s.hot.groupBy("__g0", "__b").count().agg(F.max("count")).first()[0]
        assert sizes <= limit
        assert s.plain.groupBy("g").count().agg(F.max("count")).first()[0] < limit


KINDS = {
    "ntz": "TIMESTAMP_NTZ '2024-03-09 20:00:00' + make_dt_interval(0, 0, i)",
    "collated": "CONCAT(IF(id % 2 = 0, 'Key', 'kEY'), LPAD(CAST(i AS STRING), 4, '0')) COLLATE UTF8_LCASE",
    "prefix": "CONCAT('order-000000000000000000-', LPAD(CAST(i AS STRING), 6, '0'))",
    "wide": "4611686018427387904 + i",
    "flag": "i % 2 = 0",
    "missing": "IF(i % 5 = 0, NULL, i)",
    "decimal": "CAST(i AS DECIMAL(38, 10)) / 7",
    "binary": "CAST(CONCAT('prefixprefix', LPAD(CAST(i AS STRING), 6, '0')) AS BINARY)",
}


@pytest.fixture
def new_york(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    yield spark
    spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("kind", sorted(KINDS))
def test_split_equals_plain_for_any_order_type(new_york, kind):
    rng = random.Random(11)
    rows = [(i, 1, rng.randrange(900), rng.choice([None, 1.0]) and round(rng.uniform(0, 9), 2)) for i in range(4000)]
    df = new_york.createDataFrame(rows, "id long, g int, i int, y double").withColumn("o", F.expr(KINDS[kind]))
    split = Skew(rows=400)
    for order in (["o", "id"], ["o", "i", "id"]):
        a, b = (with_previous(df, ["g"], order, "y", skew=k).select("id", "previous") for k in (PLAIN, split))
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    a, b = (strict_prefix_maxima(df, ["g"], ["o", "id"], "y", k).select("id") for k in (PLAIN, split))
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_integer_date_and_string_order_columns(spark):
    rows = make(6, n=2000)
    df = spark.createDataFrame(rows, "id long, g int, x double, y double")
    want = previous([(i, g, int(x), y) for i, g, x, y in rows])
    base = df.withColumn("i", F.floor("x").cast("int"))
    kinds = {
        "i": F.col("i"),
        "d": F.date_add(F.lit("2020-01-01").cast("date"), F.col("i")),
        "t": F.timestamp_add("HOUR", F.col("i"), F.lit("2020-01-01").cast("timestamp_ntz")),
        "s": F.lpad(F.col("i").cast("string"), 6, "0"),
    }
    for name, c in kinds.items():
        out = with_previous(base.withColumn("o", c), ["g"], ["o", "id"], "y", skew=SPLIT)
        assert {r["id"]: r["previous"] for r in out.collect()} == want, name


@pytest.mark.parametrize(
    "series,one_pass,fixpoint",
    [
        ([5, 3, 4], [3], [5]),
        ([5, None, 3], [], [5, None, 3]),
        ([0.2, 1.0, 1.0], [1.0], [0.2, 1.0]),
        ([1, 2, 3], [], [1, 2, 3]),
        ([None, None], [], [None, None]),
    ],
)
def test_hand_made_series(spark, series, one_pass, fixpoint):
    rows = [(i, 1, float(i), None if v is None else float(v)) for i, v in enumerate(series)]
    df = spark.createDataFrame(rows, "id long, g int, x double, y double")
    flagged = [r["y"] for r in not_increasing(df, ["g"], ["x", "id"], "y").orderBy("id").collect()]
    assert flagged == one_pass
    kept = [r["y"] for r in strict_prefix_maxima(df, ["g"], ["x", "id"], "y").orderBy("id").collect()]
    assert kept == fixpoint


def test_buckets_stay_few_while_they_are_not_hot_themselves(spark, monkeypatch):
    rows = [(i, 7, float(i % 50), float(i * 7 % 1000)) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, g long, x double, v double").repartition(4)
    skew = Skew(rows=2)
    cut = ordered._series(df, ["g"], ["x", "id"], "v", skew).hot
    assert 1 < cut.select("__b").distinct().count() <= cut.rdd.getNumPartitions() <= ordered.MOST_BUCKETS
    assert {r["id"]: r["previous"] for r in with_previous(df, ["g"], ["x", "id"], "v", skew=skew).collect()} == previous(rows)
    assert sorted(r["id"] for r in strict_prefix_maxima(df, ["g"], ["x", "id"], "v", skew).collect()) == loop_survivors(rows)
    # Buckets that would be hot are cut further, whatever their number.
    monkeypatch.setattr(runtime, "HOT_ROWS", 10)
    assert ordered._buckets(3000, 2) == 600
