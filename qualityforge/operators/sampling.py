"""Samples that keep related tables consistent."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualityforge.functions.keyed import Keyed


def check_ratio(ratio: float) -> float:
    if not 0 < ratio <= 1:
        raise ValueError(f"sample ratio must be in (0, 1], got {ratio}")
    return ratio


def bernoulli_sample(df: DataFrame, ratio: float, seed: int = 0) -> DataFrame:
    """Rows kept independently; depends on partitioning, like `DataFrame.sample`."""
    return df if check_ratio(ratio) == 1 else df.sample(False, ratio, seed)


def in_sample(key: str | Column, ratio: float, seed: int = 0) -> Column:
    """True for a stable ``ratio`` of the key values, whatever the partitioning."""
    return Keyed((key,), seed).uniform("sample") < check_ratio(ratio)


def key_hash_sample(df: DataFrame, key: str, ratio: float, seed: int = 0) -> DataFrame:
    """All rows of a stable share of the keys (keeps groups whole)."""
    return df if ratio == 1 else df.filter(in_sample(key, ratio, seed))


def referential_sample(
    tables: Mapping[str, DataFrame], parent: str, key: str, children: Sequence[str], ratio: float, seed: int = 0
) -> dict[str, DataFrame]:
    """A key sample of the parent with exactly the child rows of kept parents.

    The sample condition depends on the key alone, so children apply it to
    their own scan and only the sampled share is shuffled for the semi join
    that drops orphans.
    """
    kept = key_hash_sample(tables[parent], key, ratio, seed)
    out = {parent: kept}
    for c in children:
        near = key_hash_sample(tables[c], key, ratio, seed)
        out[c] = near.join(kept.select(key), key, "left_semi").select(tables[c].columns)
    return out
