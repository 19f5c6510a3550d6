"""The physical plans are the intended ones."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as entry
from qualityforge.operators import rules as R
from qualityforge.operators.constraints import _Entity, metric_rows
from qualityforge.operators.ordered import Skew, strict_prefix_maxima, with_previous
from qualityforge.plans.quality import ORDER_RULES, ORDER_TABLES
from qualityforge.plans.registry import QUERIES, Lake
from qualityforge.presets import zirconia_recipes as G

BASE = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(text: str) -> list[str]:
    return re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", text)


@pytest.fixture(scope="module")
def lake(spark):
    return Lake(spark, BASE)


def test_row_rules_are_one_map_side_aggregate(lake):
    rules = [r for r in ORDER_RULES if isinstance(r, R.RowRule) and r.table == "lineitem"]
    text = plan(metric_rows(rules, lake.tables(["lineitem"])))
    assert text.count("FileScan") == 1
    assert set(shuffles(text)) == {"SinglePartition"}
    assert "ReadSchema: struct<l_quantity:double,l_discount:double,l_returnflag:string>" in text


def test_keyed_rules_share_one_shuffle_and_one_scan_per_table(lake):
    keyed = [r for r in ORDER_RULES if isinstance(r, R.KeyedRule)]
    text = plan(_Entity(keyed, lake.tables(ORDER_TABLES)).frame())
    assert text.count("FileScan") == 3
    assert text.count("hashpartitioning(k0") == 1
    assert "SortMergeJoin" not in text and "CartesianProduct" not in text
    assert text.index("partial_sum") > text.index("hashpartitioning(k0")  # combined before the shuffle


def test_filter_reaches_the_scan(lake):
    df = metric_rows([ORDER_RULES[0]], {"lineitem": lake.lineitem.filter("l_quantity > 10")})
    text = plan(df)
    assert "GreaterThan(l_quantity,10.0)" in text
    assert "l_comment" not in text and "l_partkey" not in text


def test_plain_scan_is_one_shuffle_and_one_sort(lake):
    for df in (
        with_previous(lake.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", skew=Skew(enabled=False)),
        strict_prefix_maxima(lake.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice", Skew(enabled=False)),
    ):
        text = plan(df)
        assert shuffles(text) == ["hashpartitioning"]
        assert len(re.findall(r"\bSort \[", text)) == 1


def test_generation_does_not_shuffle(spark):
    for df in G.expand(G.recipe_groups(spark.range(0, 10).withColumnRenamed("id", "recipe_group_id"))).values():
        text = plan(df)
        assert not shuffles(text) and "Python" not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_rows_and_no_cross_joins(spark, name):
    text = plan(QUERIES[name](spark, BASE))
    assert not re.search(r"EvalPython|MapInPandas|MapInArrow|FlatMapGroups|CartesianProduct", text)
    for m in re.findall(r"BroadcastNestedLoopJoin.*", text):
        raise AssertionError(m)


def test_all_counts_of_a_profile_are_one_scan_a_table(lake, monkeypatch):
    from qualityforge.operators import profile as P

    monkeypatch.setattr(P.runtime, "pin", lambda df: df)
    items = [P.Shares("flag", "lineitem", "l_returnflag"), P.GroupSizes("lines", "lineitem", "l_orderkey"), P.Shares("status", "orders", "o_orderstatus")]
    counts = P.counted_statistics(items, lake.tables(["lineitem", "orders"]))
    text = plan(counts.filter("measure = 'cnt'"))
    # The counts are written once; unwritten, as here, they are read for shares and for totals.
    assert text.count("FileScan") == 4 and "ReadSchema: struct<l_orderkey:bigint,l_returnflag:string>" in text
    assert "partial_count(1)" in text
