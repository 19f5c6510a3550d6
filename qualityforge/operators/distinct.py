"""Distinct counts that can be added up: sketches stored per run and united across runs.

An exact distinct count shuffles every value and cannot be combined with that of
another day. A HyperLogLog sketch of a column is a few kilobytes whatever the table
holds, is built map side in one scan for all columns, and the union of sketches is
the sketch of the union.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A sketch has 2 ** LG_K registers; Spark allows 4 to 21.
LG_K = 14
SKETCH_COLUMNS = ("item", "n_rows", "sketch")


def stated_error(lg_k: int = LG_K) -> float:
    """Relative error that an estimate stays below with a probability of 99.7 %."""
    return 3 * 1.04 / 2 ** (lg_k / 2)


def distinct_sketches(df: DataFrame, columns: Sequence[str], by: Sequence[str] = (), lg_k: int = LG_K) -> DataFrame:
    """(by..., item, n_rows, sketch): a row per column, and per group if ``by`` names any.

    ``n_rows`` counts rows in which the column is not NULL; NULL is no value. Values
    are told apart as text, so a column may have any type that casts to a string. An
    empty table gives empty sketches, or no rows if ``by`` names groups.
    """
    value = lambda c: F.col(c).cast("string")
    aggs = [a for i, c in enumerate(columns) for a in (F.count(value(c)).alias(f"__n{i}"), F.hll_sketch_agg(value(c), lg_k).alias(f"__s{i}"))]
    found = df.groupBy(*by).agg(*aggs)
    items = [F.struct(F.lit(c).alias("item"), F.col(f"__n{i}").alias("n_rows"), F.col(f"__s{i}").alias("sketch")) for i, c in enumerate(columns)]
    return found.select(*by, F.inline(F.array(*items)))


def united(sketches: DataFrame, by: Sequence[str] = ("item",)) -> DataFrame:
    """(by..., n_rows, sketch) of all rows of equal ``by``; sketches of different sizes
    unite at the size of the smallest."""
    return sketches.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), F.hll_union_agg("sketch", F.lit(True)).alias("sketch"))


def estimated(sketches: DataFrame) -> DataFrame:
    """``sketches`` with ``n_distinct``, the estimate, in place of the sketch."""
    return sketches.withColumn("n_distinct", F.hll_sketch_estimate("sketch")).drop("sketch")
