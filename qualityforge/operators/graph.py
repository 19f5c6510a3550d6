"""Tables tied by foreign keys: reducing one reduces all that refer to it.

Declared keys form a graph. Tables are handled parents first; a row goes when the row it
refers to has gone. Keys that form a cycle (a table that refers to itself, or two that
refer to each other) are repeated until nothing more falls out.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualityforge import runtime
from qualityforge.operators.compliant import restrict_children
from qualityforge.operators.sampling import key_hash_sample

Tables = Mapping[str, DataFrame]


@dataclass(frozen=True)
class ForeignKey:
    """``child.column`` refers to ``parent.key``. A NULL column refers to nothing and keeps
    its row, unless the key is ``required``."""

    child: str
    column: str
    parent: str
    key: str
    required: bool = False


def levels(names: Sequence[str], keys: Sequence[ForeignKey]) -> list[list[str]]:
    """Tables parents first; those on a common cycle stand together."""
    parents = {n: {k.parent for k in keys if k.child == n and k.parent in names} for n in names}
    reach = {n: set(parents[n]) for n in names}
    for via in names:
        for n in names:
            if via in reach[n]:
                reach[n] |= reach[via]
    out: list[list[str]] = []
    left = list(names)
    while left:
        group = next([m for m in left if m == n or (m in reach[n] and n in reach[m])] for n in left if all(p not in left or n in reach[p] for p in reach[n]))
        out.append(group)
        left = [n for n in left if n not in group]
    return out


def _followed(rows: DataFrame, key: ForeignKey, parent: DataFrame) -> DataFrame:
    ids = parent.select(F.col(key.key).alias(key.column))
    return restrict_children({key.child: rows}, ids, key.column, keep_null=not key.required)[key.child]


def cascade(tables: Tables, keys: Sequence[ForeignKey], kept: Tables, cycles: bool = True) -> dict[str, DataFrame]:
    """All ``tables`` after those in ``kept`` have been reduced to the given rows.

    A row of a table that refers, directly or through others, to a row that is gone (or was
    never there) goes too. Tables that refer to no reduced one are returned as they are.
    With ``cycles=False`` a cycle among the declared keys is refused.
    """
    known = [k for k in keys if k.child in tables and k.parent in tables]
    out, reduced = {**tables, **kept}, set(kept)
    for group in levels(list(tables), known):
        own = [k for k in known if k.child in group]
        inner = [k for k in own if k.parent in group]
        if inner and not cycles:
            raise ValueError(f"foreign keys form a cycle over {', '.join(group)}")
        for k in own:
            if k.parent in reduced and k not in inner:
                out[k.child] = _followed(out[k.child], k, out[k.parent])
                reduced.add(k.child)
        if inner and any(n in reduced for n in group):
            out.update(_settled({n: out[n] for n in group}, inner))
            reduced.update(group)
        for n in group:
            # Read again by every table below.
            if n in reduced and any(k.parent == n for k in known):
                out[n] = runtime.pin(out[n])
    return out


def _settled(tables: dict[str, DataFrame], keys: Sequence[ForeignKey]) -> dict[str, DataFrame]:
    """Apply keys within a cycle until no table loses a row.

    Rows are numbered and written once. A round asks only for the references to keys that the
    last one lost, by a shuffle unless these are few, so that what reaches the driver does not
    grow with the tables.
    """
    rows = {n: runtime.pin(df.withColumn("__row", F.monotonically_increasing_id())) for n, df in tables.items()}
    ids = {k: rows[k.parent].select(F.col(k.key).alias("__to")) for k in keys}
    refs = {k: rows[k.child].select("__row", F.col(k.column).alias("__to")) for k in keys}
    # A key that several rows have is lost with the last of them.
    repeated = {k: not ids[k].filter("__to is not null").groupBy("__to").count().filter("count > 1").isEmpty() for k in keys}
    gone: dict[str, list[DataFrame]] = {n: [] for n in tables}

    def left(n: str, some: DataFrame) -> DataFrame:
        for past in gone[n]:
            some = some.join(past.hint("merge"), "__row", "left_anti")
        return some

    def lose(hits: dict[ForeignKey, DataFrame]) -> dict[str, DataFrame]:
        new = {}
        for n in {k.child for k in hits}:
            found = [hit for k, hit in hits.items() if k.child == n]
            # With one key within the cycle a row's reference is lost only once.
            once = sum(k.child == n for k in keys) == 1
            some = reduce(DataFrame.union, found)
            some = runtime.pin(some if once else left(n, some.distinct()))
            if not some.isEmpty():
                new[n] = some
        for n, some in new.items():
            # Long chains would otherwise make long plans.
            gone[n].append(some)
            if len(gone[n]) > 8:
                gone[n] = [runtime.pin(reduce(DataFrame.union, gone[n]))]
        return new

    def first(k: ForeignKey) -> DataFrame:
        orphans = refs[k].filter("__to is not null").join(ids[k].distinct().hint("merge"), "__to", "left_anti").select("__row")
        return orphans.union(refs[k].filter("__to is null").select("__row")) if k.required else orphans

    new = lose({k: first(k) for k in keys})
    while new:
        hits = {}
        for k in keys:
            if k.parent in new:
                lost = rows[k.parent].join(new[k.parent].hint("merge"), "__row", "left_semi").select(F.col(k.key).alias("__to")).filter("__to is not null")
                if repeated[k]:
                    lost = lost.distinct()
                    same = rows[k.parent].select("__row", F.col(k.key).alias("__to")).join(lost.hint("merge"), "__to", "left_semi")
                    lost = lost.join(left(k.parent, same).select("__to").hint("merge"), "__to", "left_anti")
                lost = runtime.pin(lost)
                side = F.broadcast(lost) if runtime.fits_broadcast(lost) else lost.hint("merge")
                hits[k] = refs[k].join(side, "__to", "left_semi").select("__row")
        new = lose(hits)
    return {n: left(n, df).drop("__row") for n, df in rows.items()}


def graph_sample(tables: Tables, keys: Sequence[ForeignKey], root: str, column: str, ratio: float, seed: int = 0) -> dict[str, DataFrame]:
    """A sample of ``root`` by the values of ``column`` and what refers to it, at any depth;
    no sampled row refers to a row outside the sample."""
    return cascade(tables, keys, {root: key_hash_sample(tables[root], column, ratio, seed)})
