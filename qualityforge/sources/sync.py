"""Copy relational tables into a Parquet lake and verify what arrived."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from qualityforge.sources.splits import ROWS_PER_SPLIT, Ask, key_candidates, plan_splits
from qualityforge.sources.tables import table_path

Reader = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class JdbcSource:
    """JDBC reader. Tables listed in ``split`` (table -> (column, low, high)) are
    read by ``partitions`` parallel range queries. Others are split by counted ranges of
    a key, the columns of ``keys`` (table -> columns) or else any whole number of the
    table, into about ``rows_per_split`` rows a task; a larger table that no
    key divides is refused."""

    url: str
    properties: Mapping[str, str]
    split: Mapping[str, tuple[str, int, int]] | None = None
    partitions: int = 32
    keys: Mapping[str, Sequence[str]] | None = None
    rows_per_split: int = ROWS_PER_SPLIT

    def options(self, table: str) -> dict[str, str]:
        out = {**self.properties, "url": self.url, "dbtable": table}
        bounds = (self.split or {}).get(table)
        if bounds:
            column, low, high = bounds
            out |= {
                "partitionColumn": column,
                "lowerBound": str(low),
                "upperBound": str(high),
                "numPartitions": str(self.partitions),
            }
        return out

    def ask(self, spark: SparkSession) -> Ask:
        """Runs a query in the database."""
        options = {**self.properties, "url": self.url}
        return lambda query: spark.read.format("jdbc").options(**options, query=query).load()

    def __call__(self, spark: SparkSession, table: str) -> DataFrame:
        whole = spark.read.format("jdbc").options(**self.options(table))
        if table in (self.split or {}):
            return whole.load()
        keys = (self.keys or {}).get(table) or key_candidates(whole.load().schema)
        splits = plan_splits(self.ask(spark), table, keys, self.rows_per_split)
        return spark.read.jdbc(self.url, table, predicates=[s.predicate for s in splits], properties=dict(self.properties))


@dataclass(frozen=True)
class ParquetSource:
    """Reads ``<base>/<table>`` plus a suffix such as ``.parquet``."""

    base: str
    suffix: str = ""

    def __call__(self, spark: SparkSession, table: str) -> DataFrame:
        return spark.read.parquet(table_path(self.base, table + self.suffix))


def sync_tables(spark: SparkSession, reader: Reader, names: Sequence[str], out: str) -> DataFrame:
    """Overwrite ``out/<table>`` for each table, in order.

    Returns (table, source_rows, rows, ok): the source is counted while it is
    copied, ``rows`` from the written files. The first failing table stops the
    run.
    """
    rows = []
    for name in names:
        df, path, seen = reader(spark, name), table_path(out, name), Observation()
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
        arrived = spark.read.parquet(path).agg(F.count(F.lit(1))).first()[0]
        rows.append((name, seen.get["n"], arrived, seen.get["n"] == arrived))
    return spark.createDataFrame(rows, "table string, source_rows long, rows long, ok boolean")
