"""Non-overlapping predicates for reading a table in parallel, planned from counts.

Bounds are not guessed from the smallest and largest key: rows are counted by ranges of
the key where the table lives, ranges with too many rows are counted again more
finely, and neighbours are put together until a split is full. So dense stretches
of a key get many splits and gaps none. What comes back is a few numbers per
split; a table that no key divides is refused instead of being read by one task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Runs a query where the table lives.
Ask = Callable[[str], DataFrame]

ROWS_PER_SPLIT = 1_000_000
# Ranges counted for each split that is wanted, and at most at a time.
FINER, MOST_RANGES = 4, 100_000
# A split may hold so many times the wanted rows where one key value is that frequent.
UNEVEN = 4


class NoUsableKey(ValueError):
    """No key divides a large table."""


@dataclass(frozen=True)
class Split:
    """Rows meeting ``predicate``; ``rows`` were counted when it was planned."""

    predicate: str
    rows: int


@dataclass(frozen=True)
class _Range:
    low: int
    high: int
    rows: int


def _counted(ask: Ask, table: str, key: str, span: _Range, ranges: int) -> list[_Range]:
    """Rows of equal ranges of the key inside ``span``, with the keys that occur."""
    width = max(1, math.ceil((span.high - span.low + 1) / ranges))
    # Rounding keeps the order, so ranges never overlap.
    part = f"FLOOR(({key} * 1.0 - {span.low}) / {width})"
    rows = ask(
        f"SELECT {part} AS part, COUNT(*) AS n, MIN({key}) AS low, MAX({key}) AS high FROM {table}"
        f" WHERE {key} >= {span.low} AND {key} <= {span.high} GROUP BY {part}"
    )
    return sorted((_Range(int(r[2]), int(r[3]), int(r[1])) for r in rows.collect()), key=lambda r: r.low)


def _refined(ask: Ask, table: str, key: str, span: _Range, wanted: int) -> list[_Range]:
    """Ranges of at most ``wanted`` rows, or of a single key value."""
    if span.rows <= wanted or span.low == span.high:
        return [span]
    ranges = min(MOST_RANGES, max(16, FINER * math.ceil(span.rows / wanted)))
    return [r for part in _counted(ask, table, key, span, ranges) for r in _refined(ask, table, key, part, wanted)]


def split_by_key(ask: Ask, table: str, key: str, wanted: int = ROWS_PER_SPLIT) -> list[Split]:
    """Splits of about ``wanted`` rows by ranges of an integer key, in its order.

    Every row meets exactly one predicate: the first split also takes rows whose key is
    NULL or below all counted ones, the last one those above, so rows that arrive between
    planning and reading are read as well.
    """
    n, filled, low, high = ask(f"SELECT COUNT(*) AS n, COUNT({key}) AS filled, MIN({key}) AS low, MAX({key}) AS high FROM {table}").first()
    missing = int(n) - int(filled)
    if not filled:
        return [Split("1 = 1", int(n))]
    full: list[_Range] = []
    for r in _refined(ask, table, key, _Range(int(low), int(high), int(filled)), wanted):
        held = full[-1].rows + (missing if len(full) == 1 else 0) if full else 0
        if full and held + r.rows <= wanted:
            full[-1] = _Range(full[-1].low, r.high, full[-1].rows + r.rows)
        else:
            full.append(r)
    out = []
    for i, r in enumerate(full):
        bounds = [f"{key} >= {r.low}"] if i else []
        if i + 1 < len(full):
            bounds.append(f"{key} < {full[i + 1].low}")
        text = " AND ".join(bounds) or "1 = 1"
        out.append(Split(text if i or text == "1 = 1" else f"{text} OR {key} IS NULL", r.rows + (0 if i else missing)))
    return out


def key_candidates(schema: T.StructType) -> list[str]:
    """Columns that can be split by ranges: whole numbers, in the table's order."""
    return [f.name for f in schema.fields if isinstance(f.dataType, T.IntegralType)]


def plan_splits(ask: Ask, table: str, keys: Sequence[str], wanted: int = ROWS_PER_SPLIT, uneven: int = UNEVEN) -> list[Split]:
    """Splits by the first of ``keys`` that divides the table evenly enough.

    A table of at most ``wanted`` rows is one split. A larger one is refused if none of
    its keys keeps every split within ``uneven`` times ``wanted`` rows.
    """
    total = int(ask(f"SELECT COUNT(*) AS n FROM {table}").first()[0])
    if total <= wanted:
        return [Split("1 = 1", total)]
    worst = {}
    for key in keys:
        splits = split_by_key(ask, table, key, wanted)
        worst[key] = max(s.rows for s in splits)
        if worst[key] <= uneven * wanted:
            return splits
    raise NoUsableKey(f"{table} has {total} rows and no key that divides them; largest split by key: {worst}")
