"""Declarative data-quality rules.

A rule names a table, columns and a violation condition written as a Spark SQL
expression; it never touches data. `qualityforge.operators.constraints` turns a
list of rules into as few passes as possible:

* `RowRule`      - condition on one row,
* `KeyedRule`    - condition on aggregates of one or more tables per key,
* `MonotonicRule`- a value must strictly increase inside an ordered group.

A condition that evaluates to NULL is not a violation.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from qualityforge.operators.ordered import Skew


@dataclass(frozen=True)
class RowRule:
    """``violates`` is checked on each row of ``table``; ``key`` names the
    affected entity in the ledger."""

    code: str
    name: str
    table: str
    key: str
    violates: str
    scope: str | None = None
    in_filter: bool = True


@dataclass(frozen=True)
class Measure:
    """One aggregate per key: ``how`` is sum, max, min or count_if."""

    how: str
    expr: str


@dataclass(frozen=True)
class Lookup:
    """Left join of a dictionary: its columns become visible to measures under
    ``prefix`` + name, plus ``prefix`` + ``found`` (boolean)."""

    table: str
    on: str
    key: str
    columns: tuple[str, ...]
    prefix: str = "dict_"


@dataclass(frozen=True)
class KeyedInput:
    """What one table contributes per key."""

    table: str
    keys: tuple[str, ...]
    measures: Mapping[str, Measure] = field(default_factory=dict)
    lookup: Lookup | None = None


@dataclass(frozen=True)
class KeyedRule:
    """Condition over per-key aggregates.

    Rules with the same ``entity`` are computed together in one aggregation, so
    key columns of one entity must mean the same thing. ``violates`` refers to a
    measure as ``{name}`` and to the presence of a key in a table as
    ``{has_<table>}``. ``requires`` lists tables the key must occur in;
    ``null_key`` says whether a NULL key can violate.
    """

    code: str
    name: str
    entity: str
    inputs: tuple[KeyedInput, ...]
    violates: str
    scope: str
    requires: tuple[str, ...] = ()
    null_key: bool = True
    in_filter: bool = True


@dataclass(frozen=True)
class MonotonicRule:
    """``value`` must strictly increase along ``order`` inside ``group``.

    ``order`` should end in a unique column. Rows failing ``where`` take no part.
    """

    code: str
    name: str
    table: str
    key: str
    group: tuple[str, ...]
    order: tuple[str, ...]
    value: str
    where: str | None = None
    scope: str | None = None
    skew: Skew = Skew()
    in_filter: bool = True


Rule = RowRule | KeyedRule | MonotonicRule


def _literal(v) -> str:
    if isinstance(v, str):
        return "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, float):
        return f"{v!r}D"
    return repr(v)


# ---------------------------------------------------------------- row rules


def row_predicate(code, name, table, key, violates, **kw) -> RowRule:
    """Any violation condition on a single row."""
    return RowRule(code, name, table, key, violates, **kw)


def row_range(code, name, table, key, column, low, high, **kw) -> RowRule:
    """``column`` must lie in [low, high]."""
    lo, hi = _literal(low), _literal(high)
    return RowRule(code, name, table, key, f"`{column}` < {lo} OR `{column}` > {hi}", **kw)


def category_cap(code, name, table, key, category, column, caps: Mapping[str, float], **kw) -> RowRule:
    """``column`` must not exceed the cap of its category; others are free."""
    arms = " ".join(f"WHEN {_literal(c)} THEN `{column}` > {_literal(cap)}" for c, cap in caps.items())
    return RowRule(code, name, table, key, f"CASE `{category}` {arms} ELSE false END", **kw)


def not_null(code, name, table, key, column, **kw) -> RowRule:
    return RowRule(code, name, table, key, f"`{column}` IS NULL", **kw)


def in_domain(code, name, table, key, column, values: Sequence, **kw) -> RowRule:
    """``column`` must take one of ``values``."""
    return RowRule(code, name, table, key, f"`{column}` NOT IN ({', '.join(map(_literal, values))})", **kw)


def max_length(code, name, table, key, column, length: int, **kw) -> RowRule:
    """A string of at most ``length`` characters."""
    return RowRule(code, name, table, key, f"char_length(`{column}`) > {int(length)}", **kw)


# -------------------------------------------------------------- keyed rules


def _one_table(code, name, table, key, measures, violates, scope, entity, kw) -> KeyedRule:
    part = KeyedInput(table, (key,), measures)
    return KeyedRule(code, name, entity or f"{table}.{key}", (part,), violates, scope or table, (table,), **kw)


def _sum_of(total: str, scale: int | None) -> str:
    # Sums of rounded decimals held as doubles depend on addition order, so
    # boundaries are compared after rounding. scale=None compares plain sums.
    return total if scale is None else f"round({total}, {scale})"


def group_sum_cap(code, name, table, key, column, cap, scope=None, entity=None, scale: int | None = 6, **kw) -> KeyedRule:
    """The sum of ``column`` per key must not exceed ``cap``."""
    m = {"total": Measure("sum", f"`{column}`")}
    return _one_table(code, name, table, key, m, f"{_sum_of('{total}', scale)} > {_literal(cap)}", scope, entity, kw)


def group_at_least_one(code, name, table, key, condition, scope=None, entity=None, **kw) -> KeyedRule:
    """Each key present needs at least one row meeting ``condition``."""
    m = {"hits": Measure("count_if", condition)}
    return _one_table(code, name, table, key, m, "{hits} = 0", scope, entity, kw)


def group_exactly_one(code, name, table, key, flag, scope=None, entity=None, **kw) -> KeyedRule:
    """The 0/1 ``flag`` must sum to 1 per key (all-NULL flags do not violate)."""
    m = {"flags": Measure("sum", f"CAST({flag} AS INT)")}
    return _one_table(code, name, table, key, m, "{flags} != 1", scope, entity, kw)


def foreign_key(code, name, child, child_key, parent, parent_key, entity=None, **kw) -> KeyedRule:
    """Every distinct child key must occur in the parent.

    A NULL child key counts as one orphan but not in the denominator.
    """
    kw.setdefault("in_filter", False)
    return KeyedRule(
        code,
        name,
        entity or f"{parent}.{parent_key}",
        (KeyedInput(child, (child_key,)), KeyedInput(parent, (parent_key,))),
        f"{{is_null_key}} OR NOT {{has_{parent}}}",
        f"keys:{child}",
        (child,),
        **kw,
    )


def unique_key(code, name, table, keys: Sequence[str], **kw) -> KeyedRule:
    """No key (simple or composite) may occur twice; counts offending keys."""
    keys = tuple(keys)
    kw.setdefault("in_filter", False)
    kw.setdefault("null_key", False)
    part = KeyedInput(table, keys, {"rows": Measure("count_if", "true")})
    return KeyedRule(code, name, f"{table}.{'+'.join(keys)}", (part,), "{rows} > 1", f"keys:{table}", (table,), **kw)


def cross_table_coupling(code, name, entity, inputs: Sequence[KeyedInput], violates, scope, **kw) -> KeyedRule:
    """A condition over aggregates of several tables joined on their key."""
    kw.setdefault("null_key", False)
    return KeyedRule(code, name, entity, tuple(inputs), violates, scope, tuple(i.table for i in inputs), **kw)
