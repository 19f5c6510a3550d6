"""Append-only report tables of validation runs, published whole.

A run writes its rows of every table into a partition of its own (``attempt``) and is
then published by one row of the manifest. Readers join the manifest, so they see
all tables of a run or none of them, and a failed or repeated run leaves nothing
behind that counts: the last published attempt of a run id and type replaces
earlier ones. Data files are never changed, and writers need no lock.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualityforge.operators.constraints import run_verdict
from qualityforge.operators.distinct import estimated, united
from qualityforge.operators.fidelity import FidelityReport, overall_score
from qualityforge.sources.tables import load_optional, table_path


def _schema(ddl: str) -> T.StructType:
    names = {"long": T.LongType(), "string": T.StringType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "binary": T.BinaryType()}
    return T.StructType([T.StructField(n, names[t]) for n, t in (c.split() for c in ddl.split(","))])


# The published report contract (counts widened to BIGINT).
REPORT_TABLES: dict[str, T.StructType] = {
    "validation_run": _schema(
        "run_id long,run_type string,database_name string,total_count long,sampled_count long,"
        "sample_ratio double,passed boolean,overall_score double,overall_grade string,run_at string"
    ),
    "hard_constraint_result": _schema(
        "run_id long,constraint_code string,constraint_name string,passed boolean,"
        "total_checked long,violation_count long,pass_rate double"
    ),
    "fidelity_summary": _schema(
        "run_id long,dimension string,score double,weight double,weighted_score double,grade string"
    ),
    "fidelity_categorical": _schema(
        "run_id long,dimension string,category string,real_pct double,gen_pct double,diff_pct double"
    ),
    "fidelity_numerical": _schema(
        "run_id long,dimension string,statistic string,real_value double,gen_value double,diff double"
    ),
    "fidelity_correlation": _schema(
        "run_id long,element string,real_log10_conductivity double,gen_log10_conductivity double,diff double"
    ),
}


@dataclass(frozen=True)
class RunMeta:
    """What was checked. ``run_id`` defaults to the epoch milliseconds."""

    database_name: str
    total_count: int
    sampled_count: int
    sample_ratio: float = 1.0
    run_id: int | None = None
    run_at: str | None = None

    def stamped(self) -> "RunMeta":
        now = time.time()
        return RunMeta(
            self.database_name,
            self.total_count,
            self.sampled_count,
            self.sample_ratio,
            self.run_id if self.run_id is not None else int(now * 1000),
            self.run_at or datetime.fromtimestamp(now).strftime("%Y-%m-%d %H:%M:%S"),
        )


# Statistics of a profile run, besides the published tables.
PROFILE_TABLE, DISTINCT_TABLE = "profile_statistic", "distinct_sketch"
_TABLES = REPORT_TABLES | {
    PROFILE_TABLE: _schema("run_id long,statistic string,item string,measure string,value double"),
    DISTINCT_TABLE: _schema("run_id long,item string,n_rows long,sketch binary"),
}
MANIFEST, ATTEMPT = "_manifest", "attempt"
_MANIFEST_SCHEMA = _schema("run_id long,run_type string,attempt string,published_at double")


def _write(df: DataFrame, path: str) -> None:
    df.write.mode("errorifexists").parquet(path)


@dataclass(frozen=True)
class _Attempt:
    """One try to write a run."""

    spark: SparkSession
    base: str
    meta: RunMeta
    run_type: str
    name: str

    def _path(self, table: str) -> str:
        return table_path(self.base, table, f"{ATTEMPT}={self.name}")

    def stage(self, table: str, rows: DataFrame) -> DataFrame:
        """Write the rows of a table, unseen until the run is published; returns them as stored."""
        schema = _TABLES[table]
        rows = rows.withColumn("run_id", F.lit(self.meta.run_id))
        _write(rows.select(*[F.col(f.name).cast(f.dataType) for f in schema.fields]), self._path(table))
        return self.spark.read.schema(schema).parquet(self._path(table))

    def publish(self) -> int:
        row = [(self.meta.run_id, self.run_type, self.name, time.time())]
        self.spark.createDataFrame(row, _MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(table_path(self.base, MANIFEST))
        return self.meta.run_id


def _publish(
    spark: SparkSession, base: str, meta: RunMeta, run_type: str, tables: Mapping[str, DataFrame], verdict: Callable[[Mapping[str, DataFrame]], DataFrame]
) -> int:
    """Write all tables of a run and its run row, which is derived from them as stored,
    then publish them together. Any failure leaves the run unpublished."""
    run = _Attempt(spark, base, meta, run_type, f"a{uuid.uuid4().hex}")
    stored = {name: run.stage(name, rows) for name, rows in tables.items()}
    run.stage("validation_run", _run_row(verdict(stored), meta, run_type))
    return run.publish()


def published(spark: SparkSession, base: str) -> DataFrame:
    """(attempt, run_id, run_type) of the runs that count, one each."""
    seen = load_optional(spark, table_path(base, MANIFEST), _MANIFEST_SCHEMA)
    if seen is None:
        return spark.createDataFrame([], "attempt string, run_id long, run_type string")
    last = F.max(F.struct("published_at", "attempt")).alias("last")
    return seen.groupBy("run_id", "run_type").agg(last).select(F.col("last.attempt").alias(ATTEMPT), "run_id", "run_type")


def read_reports(spark: SparkSession, base: str, table: str) -> DataFrame:
    """Rows of a report table over all published runs."""
    schema = _TABLES[table]
    files = load_optional(spark, table_path(base, table))
    if files is None:
        return spark.createDataFrame([], schema)
    runs = published(spark, base).select(F.col(ATTEMPT).alias("__attempt"))
    # Attempts are partitions: those that do not count are not read.
    kept = files.join(runs, F.col(ATTEMPT) == F.col("__attempt"), "left_semi")
    return kept.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def _run_row(verdict: DataFrame, meta: RunMeta, run_type: str) -> DataFrame:
    return verdict.select(
        F.lit(meta.run_id).alias("run_id"),
        F.lit(run_type).alias("run_type"),
        F.lit(meta.database_name).alias("database_name"),
        F.lit(meta.total_count).alias("total_count"),
        F.lit(meta.sampled_count).alias("sampled_count"),
        F.lit(meta.sample_ratio).alias("sample_ratio"),
        "passed",
        "overall_score",
        "overall_grade",
        F.lit(meta.run_at).alias("run_at"),
    )


def append_constraint_report(results: DataFrame, meta: RunMeta, base: str) -> int:
    """Append one constraint run; returns its run id. Failures surface, and rules are
    evaluated once."""

    def verdict(stored: Mapping[str, DataFrame]) -> DataFrame:
        return run_verdict(stored["hard_constraint_result"]).withColumn("overall_grade", F.lit(None).cast("string"))

    return _publish(results.sparkSession, base, meta.stamped(), "HARD_CONSTRAINT", {"hard_constraint_result": results}, verdict)


def append_fidelity_report(report: FidelityReport, meta: RunMeta, base: str) -> int:
    """Append one fidelity run; returns its run id. Failures surface."""
    renamed = {"real_mean": "real_log10_conductivity", "gen_mean": "gen_log10_conductivity"}
    tables = {
        "fidelity_summary": report.summary,
        "fidelity_categorical": report.categorical,
        "fidelity_numerical": report.numerical,
        "fidelity_correlation": report.correlation.withColumnsRenamed(renamed),
    }

    def verdict(stored: Mapping[str, DataFrame]) -> DataFrame:
        return overall_score(stored["fidelity_summary"]).withColumn("passed", F.lit(None).cast("boolean"))

    return _publish(report.summary.sparkSession, base, meta.stamped(), "FIDELITY", tables, verdict)


def _append_unjudged(rows: DataFrame, table: str, meta: RunMeta, run_type: str, base: str) -> int:
    """A run of one table that has neither verdict nor score."""
    empty = "passed boolean, overall_score double, overall_grade string"

    def verdict(_: Mapping[str, DataFrame]) -> DataFrame:
        return rows.sparkSession.createDataFrame([(None, None, None)], empty)

    return _publish(rows.sparkSession, base, meta.stamped(), run_type, {table: rows}, verdict)


def append_profile(statistics: DataFrame, meta: RunMeta, base: str) -> int:
    """Append one profile run (statistic, item, measure, value); returns its run id."""
    return _append_unjudged(statistics, PROFILE_TABLE, meta, "PROFILE", base)


def append_distinct(sketches: DataFrame, meta: RunMeta, base: str) -> int:
    """Append the distinct-count sketches (item, n_rows, sketch) of one run; returns its run id."""
    return _append_unjudged(sketches, DISTINCT_TABLE, meta, "DISTINCT", base)


def distinct_across(spark: SparkSession, base: str, run_ids: Sequence[int] | None = None) -> DataFrame:
    """(item, n_rows, n_distinct) over the published runs, or those of ``run_ids``: how
    many values a column had in all of them together, without reading their tables again."""
    stored = read_reports(spark, base, DISTINCT_TABLE)
    if run_ids is not None:
        stored = stored.filter(F.col("run_id").isin(list(run_ids)))
    return estimated(united(stored))


def read_exported(spark: SparkSession, path: str, table: str) -> DataFrame:
    """A report table exported as tab-separated text with a header."""
    return spark.read.csv(path, sep="\t", header=True, schema=REPORT_TABLES[table])
