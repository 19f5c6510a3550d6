"""Named queries over a folder of Parquet tables, each with the ANSI SQL that
must give the same rows. Queries always read whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Lake:
    """Tables of one folder by attribute: ``lake.orders``."""

    spark: SparkSession
    base: str
    _open: dict[str, DataFrame] = field(default_factory=dict)

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.table(name)

    def table(self, name: str) -> DataFrame:
        if name not in self._open:
            self._open[name] = self.spark.read.parquet(f"{self.base.rstrip('/')}/{name}.parquet")
        return self._open[name]

    def tables(self, names: Iterable[str]) -> dict[str, DataFrame]:
        return {n: self.table(n) for n in names}


QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(lake)`` under ``name``; ``sql`` is its reference query."""

    def wrap(fn: Callable[[Lake], DataFrame]):
        QUERIES[name] = lambda spark, base: fn(Lake(spark, base))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that summation order does not show."""
    return df.select(
        *[
            F.round(F.col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else F.col(f.name)
            for f in df.schema.fields
        ]
    )
