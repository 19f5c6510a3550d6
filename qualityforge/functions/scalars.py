"""Scalar column helpers (all built-in expressions, no UDFs)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def clamp(x: Column, low, high) -> Column:
    """``x`` limited to [low, high]."""
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def round_half_up(x: Column, digits: int = 0) -> Column:
    """Nearest multiple of 10^-digits, halves towards +infinity."""
    f = float(10**digits)
    return F.floor(x * f + 0.5).cast("double") / f


def round_to_step(x: Column, step: float) -> Column:
    """Nearest multiple of ``step``, halves towards +infinity."""
    return F.floor(x / float(step) + 0.5).cast("double") * float(step)


def log10_or_null(x: Column) -> Column:
    """log10 for positive values, NULL otherwise."""
    return F.when(x > 0, F.log10(x))


def grade(score: Column) -> Column:
    """EXCELLENT from 0.90, GOOD from 0.75, FAIR from 0.60, else POOR."""
    return (
        F.when(score >= 0.90, "EXCELLENT").when(score >= 0.75, "GOOD").when(score >= 0.60, "FAIR").otherwise("POOR")
    )


def named_or_id(name: Column, key: Column) -> Column:
    """Dictionary name, falling back to the id as text."""
    return F.coalesce(name, key.cast("string"))


def block_of(key: Column, base: int, block: int) -> Column:
    """Group number of ids numbered ``base + group * block + position``."""
    x, wide = key.cast("long") - F.lit(base), "decimal(20,0)"
    # An exact multiple divides exactly; doubles would lose ids beyond 2**53.
    return ((x - F.pmod(x, F.lit(block))).cast(wide) / F.lit(block).cast(wide)).cast("long")


def has_column(df: DataFrame, name: str) -> bool:
    """Case-insensitive column presence."""
    return name.lower() in {c.lower() for c in df.columns}


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times inside ``body``."""
    return F.element_at(F.transform(F.array(value), body), 1)
