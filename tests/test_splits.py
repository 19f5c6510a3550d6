"""Planned splits: every row in exactly one, whatever the key looks like."""

from __future__ import annotations

import random
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualityforge.sources import splits
from qualityforge.sources.sync import JdbcSource

KEYS = {
    "dense": lambda r, i: i,
    "sparse": lambda r, i: i**4 * 1_000_003,
    "negative": lambda r, i: i * 7 - 10_000_000_000,
    "extremes": lambda r, i: [-(2**62), 2**62, i][i % 3],
    "skewed": lambda r, i: 5 if i % 3 == 0 else r.randrange(10**12),
    "nulls": lambda r, i: None if i % 4 == 0 else r.randrange(1000),
    "first is hot": lambda r, i: -1 if i % 5 == 0 else i,
    "last is hot": lambda r, i: 10**9 if i % 5 == 0 else i,
    "one value": lambda r, i: 7,
    "none": lambda r, i: None,
}


def view(spark, keys, extra=None):
    name = f"t_{uuid.uuid4().hex}"
    spark.createDataFrame([(k, i, (extra or keys)[i]) for i, k in enumerate(keys)], "k bigint, id bigint, other bigint").createOrReplaceTempView(name)
    return name


def held(spark, name, parts):
    """How many splits take each row, and the rows each split takes."""
    took = [F.coalesce(F.expr(p.predicate), F.lit(False)).cast("int") for p in parts]
    row = spark.table(name).select(sum(took, F.lit(0)).alias("n"), F.array(*took).alias("t"))
    return [r["n"] for r in row.collect()], [sum(r["t"][i] for r in row.collect()) for i in range(len(parts))]


@pytest.mark.parametrize("kind", KEYS)
def test_every_row_is_in_exactly_one_split(spark, kind):
    rng = random.Random(2)
    keys = [KEYS[kind](rng, i) for i in range(600)]
    name = view(spark, keys)
    parts = splits.split_by_key(spark.sql, name, "k", 50)
    times, sizes = held(spark, name, parts)
    assert set(times) == {1} and sizes == [p.rows for p in parts] and sum(sizes) == 600
    # Only a single value, or rows without a key, can fill a split beyond what is wanted.
    often = max([keys.count(k) for k in set(keys) if k is not None], default=0)
    missing = keys.count(None)
    assert max(sizes) <= max(50, often) + missing
    if kind in ("dense", "sparse", "negative"):
        assert 12 <= len(parts) <= 24


def test_rows_that_arrive_later_are_read_too(spark):
    parts = splits.split_by_key(spark.sql, view(spark, list(range(100, 200))), "k", 10)
    later = view(spark, [None, -5, 99, 200, 10**12, 150])
    assert set(held(spark, later, parts)[0]) == {1}


def test_the_first_usable_key_is_taken(spark):
    bad, good = [1] * 500, list(range(500))
    name = view(spark, bad, good)
    parts = splits.plan_splits(spark.sql, name, ["k", "other"], 50)
    assert len(parts) >= 10 and all("other" in p.predicate for p in parts)
    assert splits.plan_splits(spark.sql, name, ["k"], 500) == [splits.Split("1 = 1", 500)]
    for keys in (["k"], []):
        with pytest.raises(splits.NoUsableKey, match="500 rows"):
            splits.plan_splits(spark.sql, name, keys, 50)
    with pytest.raises(splits.NoUsableKey):
        splits.plan_splits(spark.sql, view(spark, [None] * 500), ["k"], 50)
    assert splits.plan_splits(spark.sql, view(spark, [None] * 5), ["k"], 50) == [splits.Split("1 = 1", 5)]


def test_candidates_are_whole_numbers(spark):
    schema = T.StructType.fromDDL("a string, b int, c double, d bigint, e smallint, f date")
    assert splits.key_candidates(schema) == ["b", "d", "e"]
    assert JdbcSource("jdbc:x", {}).rows_per_split == splits.ROWS_PER_SPLIT


def test_few_questions_are_asked(spark):
    asked = []
    name = view(spark, [i**3 for i in range(2000)])
    parts = splits.split_by_key(lambda q: asked.append(q) or spark.sql(q), name, "k", 50)
    assert len(parts) >= 40 and len(asked) <= 10
