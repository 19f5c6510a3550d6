"""Whitening of embeddings by polarisation: covariances from variances of sums.

Vectors are put on an integer grid, so everything up to the covariance matrix is
exact. With D = n * x - S for a vector x of the fit list (n different vectors, sums
S by dimension), tasks aggregate the squares of D_i and of D_i + D_j over all vectors,
for every dimension and every pair; a cross-covariance is half the difference of the
variance of the sum and the two variances. What reaches the driver is one number
per pair of dimensions, whatever the number of vectors; ``eigh`` of that matrix
gives the components.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualityforge.llm import kernel as K
from qualityforge.llm.staging import staged

COMPONENTS, SCALE, OFFSET = 16, 64, 1_000_000
# Bits of the lower part of a number that is squared in two parts, and the vectors
# squared together: sums of products of two parts then stay within 64 bits.
LIMB, ROWS = 25, 4096


@dataclass(frozen=True)
class Whitening:
    """A fitted basis: ``n`` vectors with ``sums`` by dimension; unit ``components`` (a
    column each) by falling ``eigenvalues``, ``explained`` their shares of the total
    variance, ``identity_error`` the largest entry of the whitened fit list's covariance
    minus the identity (None where nothing varies)."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    eigenvalues: np.ndarray
    explained: tuple[float | None, ...]
    identity_error: float | None = None

    def projection(self) -> np.ndarray:
        """Divides by the deviation; components without variance give NaN."""
        sure = self.eigenvalues > len(self.sums) * np.finfo(float).eps * max(self.eigenvalues.max(initial=0.0), 0.0)
        return self.components / np.sqrt(np.where(sure, self.eigenvalues, np.nan))


# ---------------------------------------------------------------- inside tasks


def _grid(batches, scale: int, offset: int):
    """Keeps rows with a vector of finite entries; the vector as 64-bit integers."""
    for batch in batches:
        vectors = batch.column(batch.num_columns - 1)
        found = pa.compute.is_valid(vectors).to_numpy(zero_copy_only=False)
        sizes = np.where(found, pa.compute.list_value_length(vectors).fill_null(0).to_numpy(zero_copy_only=False), 0)
        entries = pa.compute.list_flatten(vectors)
        values = entries.to_numpy(zero_copy_only=False).astype(float) if len(entries) else np.zeros(0)
        ends = np.cumsum(sizes, dtype=np.int64)
        # A null entry arrives as NaN.
        bad = K.count_between(~np.isfinite(values), np.concatenate([[0], ends])) > 0
        keep = found & ~bad & (sizes > 0)
        placed = np.floor(values * scale)
        if (np.abs(placed[np.isfinite(placed)]) >= 2.0**62).any():
            raise ValueError("an entry is too large for the integer grid")
        whole = np.where(np.isfinite(placed), placed, 0).astype("<i8") + offset
        raw = whole.tobytes()
        out = [raw[8 * (e - s) : 8 * e] for k, e, s in zip(keep, ends.tolist(), sizes.tolist()) if k]
        kept = batch.filter(pa.array(keep))
        yield pa.RecordBatch.from_arrays([*kept.columns[:-1], pa.array(out, pa.binary())], names=batch.schema.names)


def _vectors(batch: pa.RecordBatch, dims: int) -> np.ndarray:
    rows = batch.column(batch.num_columns - 1).to_pylist()
    return np.frombuffer(b"".join(rows), "<i8").reshape(len(rows), dims)


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """n * x - S; as Python integers where 64 bits do not suffice."""
    reach = n * int(max(abs(int(x.max())), abs(int(x.min())))) + int(np.abs(sums).max()) if x.size else 0
    if reach >= 2**61:
        return x.astype(object) * n - sums.astype(object)
    return x * np.int64(n) - sums.astype(np.int64)


def squares(values: np.ndarray) -> list[int]:
    """Exact sums of squares over the last axis (at most ROWS long) of a 2-d array."""
    if not values.size:
        return [0] * values.shape[0]
    most = max(abs(int(values.max())), abs(int(values.min())))
    if values.dtype == object or most >= 1 << 2 * LIMB:
        return [sum(int(v) ** 2 for v in row) for row in values]
    if most < 1 << LIMB:
        return np.einsum("ij,ij->i", values, values).tolist()
    high, low = values >> LIMB, values & ((1 << LIMB) - 1)
    parts = [np.einsum("ij,ij->i", a, b).tolist() for a, b in ((high, high), (high, low), (low, low))]
    return [(a << 2 * LIMB) + (b << LIMB + 1) + c for a, b, c in zip(*parts)]


def _sums(batches, dims: int):
    n, total = 0, [0] * dims
    for batch in batches:
        x = _vectors(batch, dims)
        for at in range(0, len(x), ROWS):
            part = x[at : at + ROWS]
            # Split, so that entries of any size add up within 64 bits.
            high, low = (part >> 31).sum(0).tolist(), (part & 0x7FFFFFFF).sum(0).tolist()
            total = [t + (h << 31) + v for t, h, v in zip(total, high, low)]
        n += len(x)
    if n:
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(dims), pa.int32()), pa.array([n] * dims, pa.int64()), pa.array(map(Decimal, total), pa.decimal128(38, 0))],
            names=["i", "n", "s"],
        )


def _polarised(batches, n: int, sums: tuple[int, ...]):
    """Sums of squares of D_i (i = j) and of D_i + D_j (i < j), a row a pair and task."""
    dims, seen = len(sums), False
    total = [[0] * (dims - i) for i in range(dims)]
    for batch in batches:
        x = _vectors(batch, dims)
        for at in range(0, len(x), ROWS):
            d = np.ascontiguousarray(_centred(x[at : at + ROWS], n, np.array(sums, object)).T)
            own, seen = squares(d), True
            for i in range(dims):
                found = [own[i], *squares(d[i] + d[i + 1 :])]
                total[i] = [a + b for a, b in zip(total[i], found)]
    if seen:
        pairs = [(i, i + k, Decimal(v)) for i, row in enumerate(total) for k, v in enumerate(row)]
        i, j, v = zip(*pairs)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(v, pa.decimal128(38, 0))], names=["i", "j", "q"])


def _projected(x: np.ndarray, fit: Whitening) -> tuple[np.ndarray, np.ndarray]:
    d = _centred(x, fit.n, np.array(fit.sums, object))
    return d, (d.astype(float) / fit.n) @ fit.projection()


def _products(batches, fit: Whitening):
    """Sums of products of whitened components over the vectors of a task."""
    k, n = fit.components.shape[1], 0
    total, means = np.zeros((k, k)), np.zeros(k)
    for batch in batches:
        w = _projected(_vectors(batch, len(fit.sums)), fit)[1]
        total, means, n = total + w.T @ w, means + w.sum(0), n + len(w)
    if n:
        i, j = np.divmod(np.arange(k * k), k)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel()), pa.array(np.where(i == j, means[i], 0.0))], names=["i", "j", "p", "m"])


def _apply(batches, fit: Whitening):
    for batch in batches:
        d, w = _projected(_vectors(batch, len(fit.sums)), fit)
        far = [v if v < 2**63 else None for at in range(0, len(d), ROWS) for v in squares(d[at : at + ROWS])]
        ends = pa.array(np.arange(len(w) + 1) * w.shape[1], pa.int32())
        flat = pa.array(w.ravel(), mask=np.isnan(w.ravel()))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(far, pa.int64()), pa.ListArray.from_arrays(ends, flat)],
            names=[*batch.schema.names[:-1], "deviation", "whitened"],
        )


# ------------------------------------------------------------------ on the cluster


def on_grid(df: DataFrame, key: str | None, vector: str, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """([k,] x): floor(scale * entry) + offset as little-endian 64-bit integers, a row for
    every vector that is not null or empty and holds no null or non-finite entry."""
    columns = [F.col(key).alias("k")] if key else []
    rows = df.select(*columns, F.col(vector).cast("array<double>").alias("x"))
    schema = "".join(f"k {f.dataType.simpleString()}, " for f in rows.schema.fields[:-1]) + "x binary"
    return rows.filter("x is not null").mapInArrow(K.task(_grid, scale, offset), schema)


def covariance(fit: DataFrame, n: int, sums: tuple[int, ...]) -> np.ndarray:
    """The covariance matrix (divisor n) of the vectors ``x`` of a frame, each entry
    rounded once from its exact value."""
    rows = fit.mapInArrow(K.task(_polarised, n, sums), "i int, j int, q decimal(38,0)")
    # One number for each pair of dimensions.
    found = {(r.i, r.j): int(r.q) for r in rows.groupBy("i", "j").agg(F.sum("q").alias("q")).collect()}
    out = np.empty((len(sums), len(sums)))
    for (i, j), q in found.items():
        cross = q if i == j else (q - found[i, i] - found[j, j]) // 2
        out[i, j] = out[j, i] = cross / n**3
    return out


def fit_whitening(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> Whitening | None:
    """Fit on the different grid vectors of ``df``; None without any.

    The dimension is the commonest length (of equally common ones the longest);
    vectors of another length do not take part. Repeated vectors count once and are
    merged inside the tasks before they are shuffled.
    """
    fit = staged(on_grid(df, None, vector, scale, offset).distinct(), "whitening-fit")
    common = fit.groupBy(F.octet_length("x").alias("b")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("b")).first()
    if common is None:
        return None
    dims = common.b // 8
    fit = fit.filter(F.octet_length("x") == common.b)
    sums = fit.mapInArrow(K.task(_sums, dims), "i int, n bigint, s decimal(38,0)").groupBy("i").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    n, totals = sums[0].n, tuple(int(r.s) for r in sorted(sums, key=lambda r: r.i))
    matrix = covariance(fit, n, totals)
    values, vectors = np.linalg.eigh(matrix)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    # One sign for all rows: the largest entry is positive.
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(0), np.arange(vectors.shape[1])])
    trace = float(np.trace(matrix))
    shares = tuple(max(float(v), 0.0) / trace if trace > 0 else None for v in values)
    out = Whitening(n, totals, vectors, values, shares)
    return Whitening(n, totals, vectors, values, shares, _identity_error(fit, out))


def _identity_error(fit: DataFrame, basis: Whitening) -> float | None:
    rows = fit.mapInArrow(K.task(_products, basis), "i int, j int, p double, m double")
    found = rows.groupBy("i", "j").agg(F.sum("p").alias("p"), F.sum("m").alias("m")).collect()
    mean = {r.i: r.m / basis.n for r in found if r.i == r.j}
    errors = [abs(r.p / basis.n - mean[r.i] * mean[r.j] - (r.i == r.j)) for r in found]
    return max((e for e in errors if e == e), default=None)


def whiten(df: DataFrame, key: str = "vec_id", vector: str = "embedding", components: int = COMPONENTS, scale: int = SCALE, offset: int = OFFSET) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error): a row for every
    usable vector and component.

    Left out are null and empty vectors, vectors with a null or non-finite entry, and
    those of another than the commonest length. Repeated vectors weigh once in the fit
    and are all returned; keys may be null or repeat. ``deviation`` is the exact sum of
    (n * x - S) ** 2 over the dimensions, null beyond 64 bits. Components without
    variance have ``whitened`` null (all of them if there is one vector only, with
    ``explained`` and ``identity_error`` null as well). Vectors of fewer dimensions than
    ``components`` have as many components as dimensions. An empty table gives no rows;
    columns other than key and vector are not read. An entry of 2 ** 62 or more on the
    grid raises an error.
    """
    fit = fit_whitening(df, vector, components, scale, offset)
    rows = on_grid(df, key, vector, scale, offset)
    kind = rows.schema["k"].dataType.simpleString()
    if fit is None:
        return df.sparkSession.createDataFrame([], f"`{key}` {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")
    rows = rows.filter(F.octet_length("x") == 8 * len(fit.sums))
    placed = rows.mapInArrow(K.task(_apply, fit), f"k {kind}, deviation bigint, whitened array<double>")
    shares = F.array(*[F.lit(s).cast("double") for s in fit.explained])
    return placed.select("k", "deviation", F.posexplode("whitened").alias("p", "whitened")).select(
        F.col("k").alias(key),
        (F.col("p") + 1).alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(shares, F.col("p") + 1).alias("explained"),
        F.lit(fit.identity_error).cast("double").alias("identity_error"),
    )
