"""Whitening against exact fractions and numpy."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from qualityforge.llm import queries, whitening

SCHEMA = "vec_id bigint, embedding array<float>, n bigint, k string, component int"


def plain(rows, components=16):
    """The definition: exact covariances of the different grid vectors, then eigh."""
    rows = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    grid = [(i, tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)) for i, v in rows]
    fit = sorted({x for _, x in grid})
    n, dims = len(fit), len(fit[0])
    sums = [sum(x[i] for x in fit) for i in range(dims)]
    cov = [[sum(Fraction(n * x[i] - sums[i], n) * Fraction(n * x[j] - sums[j], n) for x in fit) / n for j in range(dims)] for i in range(dims)]
    matrix = np.array([[float(c) for c in row] for row in cov])
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    out = []
    for i, x in grid:
        centre = np.array([float(Fraction(n * a - s, n)) for a, s in zip(x, sums)])
        far = sum((n * a - s) ** 2 for a, s in zip(x, sums))
        out.append((i, far, centre @ vectors / np.sqrt(values)))
    return n, values / np.trace(matrix), out


def check(got, rows):
    n, shares, want = plain(rows)
    k = len(shares)
    assert len(got) == len(want) * k
    by = {}
    for r in got:
        by.setdefault((r.vec_id, r.deviation), {}).setdefault(r.component, []).append(r)
    signs = None
    for i, far, values in want:
        mine = by[i, far]
        assert sorted(mine) == list(range(1, k + 1)) and {r.n for own in mine.values() for r in own} == {n}
        w = np.array([mine[c][0].whitened for c in range(1, k + 1)])
        if signs is None:
            signs = np.sign(w * values)
        assert np.allclose(w, values * np.where(signs == 0, 1, signs), atol=1e-8)
        assert np.allclose([mine[c][0].explained for c in range(1, k + 1)], shares, rtol=1e-9)
    assert {r.identity_error for r in got} != {None} and max(r.identity_error for r in got) < 1e-8


def test_equals_the_definition(spark):
    rng = random.Random(1)
    rows = [(i, [rng.gauss(0, 1 + d) for d in range(6)]) for i in range(80)]
    rows += [(i, rows[i % 3][1]) for i in range(80, 200)]  # a vector with most of all rows
    got = whitening.whiten(spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA).repartition(7)).collect()
    check(got, rows)


def test_odd_rows(spark):
    rng = random.Random(2)
    good = [(i, [rng.uniform(-1, 1) for _ in range(3)]) for i in range(20)] + [(None, [0.5, 0.25, -0.5]), (None, [0.5, 0.25, -0.5]), (3, [0.0, 0.0, 0.0])]
    bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [float("inf"), 1.0, 2.0]), (105, [1.0]), (None, None)]
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in good + bad], SCHEMA)
    got = whitening.whiten(frame).collect()
    assert len(got) == 3 * len(good)
    n, shares, want = plain(good)
    assert sorted({(-1 if i is None else i, far) for i, far, _ in want}) == sorted({(-1 if r.vec_id is None else r.vec_id, r.deviation) for r in got})
    assert {r.n for r in got} == {n} and got[0].identity_error < 1e-9
    for nothing in (frame.limit(0), frame.filter("vec_id in (100, 101, 102)")):
        empty = whitening.whiten(nothing)
        assert empty.count() == 0 and empty.columns == whitening.whiten(frame).columns


def test_without_variance(spark):
    one = whitening.whiten(spark.createDataFrame([(1, [1.0, 2.0], 0, "", 0), (2, [1.0, 2.0], 0, "", 0)], SCHEMA)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 4
    flat = whitening.whiten(spark.createDataFrame([(i, [float(i), 3.0], 0, "", 0) for i in range(5)], SCHEMA)).collect()
    second = [r for r in flat if r.component == 2]
    assert [r.whitened for r in second] == [None] * 5 and flat[0].identity_error < 1e-12


def test_entries_beyond_the_grid_are_refused(spark):
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e30], 0, "", 0)], SCHEMA))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(-(2**60), 2**60) | st.integers(-(2**40), 2**40) | st.integers(-99, 99), min_size=4, max_size=4), min_size=1, max_size=5))
def test_sums_of_squares_are_exact(rows):
    assert whitening.squares(np.array(rows, np.int64)) == [sum(v * v for v in r) for r in rows]


def test_covariances_are_exact(spark):
    rng = random.Random(4)
    big = [[rng.randrange(-(2**52), 2**52), rng.randrange(9)] for _ in range(30)]
    rows = spark.createDataFrame([(bytearray(np.array(x, "<i8").tobytes()),) for x in big], "x binary").repartition(4)
    sums = [sum(x[i] for x in big) for i in range(2)]
    got = whitening.covariance(rows, 30, tuple(sums))
    for i in range(2):
        for j in range(2):
            exact = Fraction(sum((30 * x[i] - sums[i]) * (30 * x[j] - sums[j]) for x in big), 30**3)
            assert got[i, j] == float(exact)


def test_the_query_equals_the_definition_on_the_given_vectors(spark):
    base = "/root/testdata/sf0.001"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{base}/embeddings.parquet").collect()]
    n, shares, want = _fast(rows)
    got = queries.QUERIES["op12_embedding_whitening"](spark, base).collect()
    assert len(got) == 16 * len(rows) and {r.n for r in got} == {n}
    values = {(r.vec_id, r.component): r for r in got}
    signs = np.sign([values[want[0][0], c].whitened * want[0][2][c - 1] for c in range(1, 17)])
    for i, far, w in want:
        assert values[i, 1].deviation == far
        assert np.allclose([values[i, c].whitened for c in range(1, 17)], signs * w, atol=1e-6)
    assert np.allclose([values[want[0][0], c].explained for c in range(1, 17)], shares, rtol=1e-9)
    assert got[0].identity_error < 1e-9


def _fast(rows):
    """`plain` with Python integers in numpy."""
    grid = [(i, np.floor(64 * np.array(v, np.float32).astype(float)).astype(int) + 1_000_000) for i, v in rows]
    fit = np.array(sorted({tuple(x.tolist()) for _, x in grid}), object)
    n, sums = len(fit), fit.sum(0)
    d = fit * n - sums
    exact = d.T @ d
    matrix = np.array([[int(c) / n**3 for c in row] for row in exact])
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    out = [(i, int(((x.astype(object) * n - sums) ** 2).sum()), ((x * n - sums.astype(int)) / n) @ vectors / np.sqrt(values)) for i, x in grid]
    return n, values / np.trace(matrix), out
