"""Cascades over declared keys: order, cycles, NULLs and orphans."""

from __future__ import annotations

import pytest

from qualityforge.operators.graph import ForeignKey as Key
from qualityforge.operators.graph import cascade, graph_sample, levels


def test_parents_come_first_and_cycles_stand_together():
    keys = [Key("c", "b", "b", "id"), Key("b", "a", "a", "id"), Key("d", "d", "d", "id"), Key("x", "y", "y", "id"), Key("y", "x", "x", "id"), Key("x", "c", "c", "id")]
    order = levels(["x", "y", "c", "b", "a", "d"], keys)
    assert [sorted(g) for g in order if g != ["d"]] == [["a"], ["b"], ["c"], ["x", "y"]]
    assert ["d"] in order


def ids(df):
    return sorted(r[0] for r in df.collect())


@pytest.fixture()
def tables(spark):
    return {
        "a": spark.createDataFrame([(i,) for i in range(6)], "id int"),
        "b": spark.createDataFrame([(10, 0), (11, 1), (12, 2), (13, None), (14, 99)], "id int, a int"),
        "c": spark.createDataFrame([(20, 10), (21, 11), (22, 13), (23, 14), (24, None)], "id int, b int"),
        "free": spark.createDataFrame([(1,)], "id int"),
    }


def test_rows_follow_what_they_refer_to(spark, tables):
    keys = [Key("b", "a", "a", "id"), Key("c", "b", "b", "id")]
    out = cascade(tables, keys, {"a": tables["a"].filter("id <> 1")})
    # An orphan (14) goes, a NULL reference (13, 24) stays.
    assert ids(out["b"]) == [10, 12, 13] and ids(out["c"]) == [20, 22, 24]
    assert out["free"] is tables["free"] and out["b"].columns == ["id", "a"]
    needed = [Key("b", "a", "a", "id", required=True), keys[1]]
    out = cascade(tables, needed, {"a": tables["a"].filter("id <> 1")})
    assert ids(out["b"]) == [10, 12] and ids(out["c"]) == [20, 24]
    # Nothing above what is reduced changes.
    out = cascade(tables, keys, {"c": tables["c"].limit(0)})
    assert out["a"] is tables["a"] and out["b"] is tables["b"] and ids(out["c"]) == []
    assert ids(graph_sample(tables, keys, "a", "id", 1.0)["b"]) == [10, 11, 12, 13]


def test_cycles_are_followed_to_the_end_or_refused(spark):
    chain = spark.createDataFrame([(i, i - 1 if i % 10 else None) for i in range(40)], "id int, up int")
    keys = [Key("t", "up", "t", "id")]
    out = cascade({"t": chain}, keys, {"t": chain.filter("id not in (3, 27)")})
    assert ids(out["t"]) == [i for i in range(40) if not 3 <= i <= 9 and not 27 <= i <= 29]
    two = {"x": spark.createDataFrame([(1, 5), (2, 6)], "id int, y int"), "y": spark.createDataFrame([(5, 2), (6, 1), (7, None)], "id int, x int")}
    both = [Key("x", "y", "y", "id"), Key("y", "x", "x", "id")]
    out = cascade(two, both, {"x": two["x"].filter("id = 1")})
    assert ids(out["x"]) == [] and ids(out["y"]) == [7]
    with pytest.raises(ValueError, match="cycle"):
        cascade(two, both, {"x": two["x"]}, cycles=False)


def test_a_cycle_keeps_what_a_repeated_key_still_backs(spark, monkeypatch):
    from qualityforge.operators import graph

    rows = [(1, None, 0), (1, 9, 1), (2, 1, 2), (3, 2, 3), (4, 5, 4), (5, 4, 5), (None, 3, 6), (6, None, 7), (7, 6, 8)]
    t = spark.createDataFrame(rows, "id int, up int, n int")
    of = lambda df: sorted(r["n"] for r in df.collect())
    monkeypatch.setattr(graph, "restrict_children", None)
    keys = [Key("t", "up", "t", "id")]
    # 9 never was there, but the other row of 1 stays; 4 and 5 hold each other.
    assert of(cascade({"t": t}, keys, {"t": t.filter("n <> 7")})["t"]) == [0, 2, 3, 4, 5, 6]
    assert of(cascade({"t": t}, keys, {"t": t.filter("n <> 0")})["t"]) == [4, 5, 7, 8]
    needed = [Key("t", "up", "t", "id", required=True)]
    assert of(cascade({"t": t}, needed, {"t": t})["t"]) == [4, 5]


def test_a_long_chain_ends(spark):
    t = spark.createDataFrame([(i, i - 1 if i else None) for i in range(25)], "id int, up int")
    assert ids(cascade({"t": t}, [Key("t", "up", "t", "id")], {"t": t.filter("id <> 3")})["t"]) == [0, 1, 2]
