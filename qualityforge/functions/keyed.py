"""Random columns that are pure functions of (seed, key, stream, index).

The same key draws the same value whatever the partitioning, cluster size or
retry history, so generated tables are reproducible and samples are stable.

Two sources: ``md5`` gives values any SQL engine can recompute (32 bits per
draw), ``xxhash64`` is the fast one for bulk generation (53 bits per draw).
"""

from __future__ import annotations

import math
import os
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualityforge.functions.scalars import let

_TWO32 = float(2**32)
_TWO53 = float(2**53)
# Marsaglia-Tsang accepts over 95 % of proposals: all of these fail with 1e-333.
_GAMMA_TRIES = 256
# Integer shapes up to this are drawn from as many uniforms, larger ones by rejection.
_ORDER_STATISTICS = 64


class Draws(NamedTuple):
    """Uniforms of a stream for ``indices`` indices from ``first`` on, each with ``parts`` parts (0: draws without a part)."""

    stream: str
    first: int = 0
    indices: int = 1
    parts: int = 0

    def places(self) -> list[tuple[int, ...]]:
        every = range(self.first, self.first + self.indices)
        return [(i, j) for i in every for j in range(self.parts)] if self.parts else [(i,) for i in every]


@dataclass(frozen=True)
class Keyed:
    """Draws for the row identified by ``keys`` (columns or names)."""

    keys: tuple
    seed: int = 0
    source: str = "md5"
    # Stream -> column of draws made ahead, their place in it, what they are.
    _held: Mapping[str, tuple[str, int, Draws]] = field(default_factory=dict, compare=False, repr=False)

    def _cols(self) -> list[Column]:
        return [k if isinstance(k, Column) else F.col(k) for k in self.keys]

    def uniform(self, stream: str, index: Column | int = 0, part: Column | int | None = None) -> Column:
        """Uniform in the open interval (0, 1). A draw that needs several gives
        each its ``part``, hashed on its own, so that no two draws overlap."""
        places = [x if isinstance(x, Column) else F.lit(x) for x in (index, part) if x is not None]
        if self.source == "xxhash64":
            h = F.xxhash64(F.lit(self.seed), F.lit(stream), *self._cols(), *[p.cast("long") for p in places])
            return (F.shiftrightunsigned(h, 11) + 0.5) / _TWO53
        hashed = _from_md5(self._text(stream, *[x for x in (index, part) if x is not None]))
        if stream not in self._held:
            return hashed
        column, at, held = self._held[stream]
        if bool(held.parts) != (part is not None):
            return hashed
        inside, place = [], at
        for x, low, n, step in ((index, held.first, held.indices, held.parts or 1), (part, 0, held.parts, 1)):
            if x is None:
                continue
            if isinstance(x, Column):
                inside.append(x.between(low, low + n - 1))
                x = x.cast("int")
            elif not low <= x < low + n:
                return hashed
            place = place + (x - low) * step
        found = F.get(F.col(column), place if isinstance(place, Column) else F.lit(place))
        return F.when(reduce(Column.__and__, inside), found).otherwise(hashed) if inside else found

    def ahead(self, df: DataFrame, plan: Mapping[str, Sequence[Draws]]) -> tuple[DataFrame, Keyed]:
        """``df`` with columns of uniforms, and these draws reading the planned ones from them.

        A column is computed by the ``digests`` of whole batches, and only if something
        that is kept reads it. Draws outside of the plan are hashed one at a time, with
        the same values. ``xxhash64`` needs no draws ahead.
        """
        if self.source != "md5":
            return df, self
        key = F.concat(F.lit(""), *[_place(c) for c in self._cols()])
        columns, held = {}, dict(self._held)
        for name, draws in plan.items():
            frames: list[tuple[str, str]] = []
            for d in draws:
                held[d.stream] = (name, len(frames), d)
                frames += [(f"{self.seed}:{d.stream}", "".join(f":{x}" for x in p)) for p in d.places()]
            columns[name] = F.arrow_udf(_uniforms(frames), "array<double>")(key)
        return df.withColumns(columns), replace(self, _held=held)

    def _text(self, stream: str, *places: Column | int) -> Column:
        """Seed, stream, keys and places between colons, without those that are NULL.

        The same text as from ``concat_ws``, which costs twice as much inside a lambda.
        """
        return F.concat(F.lit(f"{self.seed}:{stream}"), *[_place(x) for x in (*self._cols(), *places)])

    def _parts(self, stream: str, index: Column | int, body: Callable[[Callable[[Column], Column]], Column]) -> Column:
        """``body`` of a function that gives the uniform of a part, which is not NULL; what all
        parts have in common is put together once."""
        if self.source == "xxhash64":
            return body(lambda j: self.uniform(stream, index, j))
        return let(
            F.concat(self._text(stream, index), F.lit(":")),
            lambda common: body(lambda j: _from_md5(F.concat(common, j.cast("string")))),
        )

    def between(self, stream: str, low, high, index: Column | int = 0) -> Column:
        low = low if isinstance(low, Column) else F.lit(float(low))
        high = high if isinstance(high, Column) else F.lit(float(high))
        return low + self.uniform(stream, index) * (high - low)

    def pick(self, stream: str, size: Column | int, index: Column | int = 0) -> Column:
        """Integer in 0 .. size-1."""
        n = size if isinstance(size, Column) else F.lit(size)
        return F.floor(self.uniform(stream, index) * n).cast("int")

    def normal(self, stream: str, index: Column | int = 0, part: Column | int | None = None) -> Column:
        """Standard normal (Box-Muller on two uniforms)."""
        return F.sqrt(-2.0 * F.ln(self.uniform(stream + "/r", index, part))) * F.cos(
            2.0 * math.pi * self.uniform(stream + "/a", index, part)
        )

    def _uniforms(self, stream: str, n: Column | int, index: Column | int) -> Column:
        n = n if isinstance(n, Column) else F.lit(n)
        hashed = self._parts(stream, index, lambda uniform: F.transform(F.sequence(F.lit(0), n - 1), uniform))
        if stream not in self._held:
            return hashed
        column, at, held = self._held[stream]
        i = index if isinstance(index, Column) else F.lit(index)
        inside = i.between(held.first, held.first + held.indices - 1) & n.between(1, held.parts)
        return F.when(inside, F.slice(F.col(column), (i.cast("int") - held.first) * held.parts + (at + 1), n)).otherwise(hashed)

    def beta_int(self, stream: str, a: Column | int, b: Column | int, index: Column | int = 0) -> Column:
        """Beta(a, b) for integers: the a-th smallest of a + b - 1 uniforms."""
        a = a if isinstance(a, Column) else F.lit(a)
        return F.element_at(F.sort_array(self._uniforms(stream, a + b - 1, index)), a)

    def gamma(self, stream: str, shape: float, index: int = 0) -> Column:
        """Gamma(shape, 1): a sum of exponentials for small integers, otherwise
        the first accepted Marsaglia-Tsang proposal of a fixed keyed sequence."""
        if shape <= 0:
            raise ValueError(f"shape must be positive, got {shape}")
        if float(shape).is_integer() and shape <= _ORDER_STATISTICS:
            logs = F.transform(self._uniforms(stream, int(shape), index), F.ln)
            return -F.aggregate(logs, F.lit(0.0), lambda s, x: s + x)
        if shape < 1:
            return self.gamma(stream, shape + 1, index) * F.pow(self.uniform(stream + "/s", index), 1.0 / shape)
        d = shape - 1.0 / 3.0
        c = 1.0 / math.sqrt(9.0 * d)

        def proposal(j: Column) -> Column:
            x, u = self.normal(stream + "/x", index, j), self.uniform(stream + "/u", index, j)
            return let(
                F.struct(x.alias("x"), F.ln(u).alias("lu")),
                lambda t: let(
                    1 + c * t["x"],
                    lambda w: F.when(
                        (w > 0)
                        & (t["lu"] < 0.5 * t["x"] * t["x"] + d * (1 - w * w * w + 3 * F.ln(F.greatest(w, F.lit(1e-300))))),
                        d * w * w * w,
                    ),
                ),
            )

        # A proposal is computed only while none has been accepted.
        found = F.aggregate(
            F.sequence(F.lit(0), F.lit(_GAMMA_TRIES - 1)),
            F.lit(None).cast("double"),
            lambda done, j: F.when(done.isNotNull(), done).otherwise(proposal(j)),
        )
        return F.coalesce(found, F.raise_error(F.lit("no gamma proposal was accepted")).cast("double"))

    def beta(self, stream: str, a: float, b: float, index: int = 0) -> Column:
        """Beta(a, b) for any positive shapes."""
        if float(a).is_integer() and float(b).is_integer() and a + b <= _ORDER_STATISTICS:
            return self.beta_int(stream, int(a), int(b), index)
        x, y = self.gamma(stream + "/a", a, index), self.gamma(stream + "/b", b, index)
        return let(F.struct(x.alias("x"), y.alias("y")), lambda t: t["x"] / (t["x"] + t["y"]))

    def choice(self, stream: str, items: Sequence[tuple[object, float]], index: Column | int = 0) -> Column:
        u = self.uniform(stream, index)
        if type(index) is int and stream in self._held and (index,) in self._held[stream][2].places():
            return weighted_choice(u, items)
        return let(u, lambda u: weighted_choice(u, items))

    def drawing_order(self, stream: str, items: Sequence[tuple[object, float]], index: int = 0) -> Column:
        """Structs (k, v) of all ``items`` (value, weight) in the order of `sample_without_replacement`.

        A column of its own is sorted in generated code, where a lambda would copy every struct.
        """
        keyed = [F.struct((-F.ln(self.uniform(stream, index, i)) / F.lit(w)).alias("k"), F.lit(v).alias("v")) for i, (v, w) in enumerate(items)]
        return F.sort_array(F.array(*keyed))

    def sample_without_replacement(
        self, stream: str, items: Column, weight: str, n: Column | int, index: Column | int = 0
    ) -> Column:
        """``n`` distinct elements of an array of structs, drawn by their
        ``weight`` field: exponential keys -ln(u)/w in ascending order follow the
        same law as drawing one after the other."""
        n = n if isinstance(n, Column) else F.lit(n)

        def keys(uniform: Callable[[Column], Column]) -> Column:
            return F.transform(items, lambda x, i: F.struct((-F.ln(uniform(i)) / x[weight]).alias("k"), x.alias("v")))

        if stream in self._held:
            keyed = let(self._uniforms(stream, F.size(items), index), lambda us: keys(lambda i: F.get(us, i)))
        else:
            keyed = self._parts(stream, index, keys)
        return F.transform(F.slice(F.sort_array(keyed), F.lit(1), n), lambda t: t["v"])


def _place(x: Column | int) -> Column:
    """A key or place behind its colon; nothing for NULL."""
    return F.lit(f":{x}") if type(x) is int else F.coalesce(F.concat(F.lit(":"), x.cast("string")), F.lit(""))


def _uniforms(frames: list[tuple[str, str]]) -> Callable:
    """``digests.uniforms`` of ``frames`` for workers, which look in this package's folder too."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

    def run(keys: pa.Array) -> pa.Array:
        import sys as worker_sys

        if root not in worker_sys.path:
            worker_sys.path.append(root)
        from qualityforge.functions import digests

        return digests.uniforms(keys, frames)

    return run


def _from_md5(text: Column) -> Column:
    return (F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long") + 0.5) / _TWO32


def cumulative(items: Sequence[tuple[object, float]]) -> list[float]:
    """Running sums of the weights."""
    out, acc = [], 0.0
    for _, w in items:
        acc += w
        out.append(acc)
    return out


def weighted_choice(u: Column, items: Sequence[tuple[object, float]]) -> Column:
    """Item selected by a uniform ``u``; weights need not sum to one.

    ``u`` appears once per item, so pass a column (or use `Keyed.choice`).
    """
    bounds = cumulative(items)
    r = u * bounds[-1]
    out = None
    for (value, _), bound in zip(items[:-1], bounds[:-1]):
        out = F.when(r <= bound, F.lit(value)) if out is None else out.when(r <= bound, F.lit(value))
    last = F.lit(items[-1][0])
    return last if out is None else out.otherwise(last)
