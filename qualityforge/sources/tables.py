"""Reading, registering and writing tables in a Parquet lake or the catalog."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def table_path(base: str | None, *parts: str) -> str:
    """Join path parts; trailing slashes go, an empty base means '.'."""
    root = (base or "").strip()
    while len(root) > 1 and root.endswith("/"):
        root = root[:-1]
    return "/".join([root or ".", *parts])


def quote(text: str) -> str:
    """Escape a text for a single-quoted SQL literal."""
    return text.replace("\\", "\\\\").replace("'", "\\'")


def load(spark: SparkSession, source: str, schema: T.StructType | None = None) -> DataFrame:
    """A catalog table (``db.table``) or a Parquet path.

    With ``schema`` only its columns are visible, cast to the declared types, so
    physical extras stay hidden and never reach the scan.
    """
    df = spark.read.parquet(source) if "/" in source else spark.table(source)
    return conform(df, schema) if schema else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to a declared schema."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def load_optional(spark: SparkSession, source: str, schema: T.StructType | None = None) -> DataFrame | None:
    """`load`, or None if the table or path does not exist."""
    exists = _path_exists(spark, source) if "/" in source else spark.catalog.tableExists(source)
    return load(spark, source, schema) if exists else None


def load_tables(spark: SparkSession, base: str, names: Sequence[str], optional: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Tables by name from a folder or a database; missing optional ones are left out."""
    at = (lambda n: f"{base.rstrip('/')}/{n}") if "/" in base else (lambda n: f"{base}.{n}")
    out = {n: load(spark, at(n)) for n in names}
    for n in optional:
        df = load_optional(spark, at(n))
        if df is not None:
            out[n] = df
    return out


def ensure_database(spark: SparkSession, name: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def register_external(spark: SparkSession, table: str, schema: T.StructType, path: str, replace: bool = False) -> None:
    """Declare an external Parquet table at ``path``."""
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({cols}) USING parquet LOCATION '{quote(path)}'")


def write_rows(spark: SparkSession, rows: Sequence[tuple], schema: str | T.StructType, path: str) -> None:
    """Overwrite a small fixed table (a dictionary) given as rows."""
    spark.createDataFrame(list(rows), schema).coalesce(1).write.mode("overwrite").parquet(path)


def save_external(df: DataFrame, table: str, path: str) -> None:
    """Overwrite a table whose files live at ``path``."""
    df.write.mode("overwrite").option("path", path).format("parquet").saveAsTable(table)


def write_tables(tables: Mapping[str, DataFrame], base: str, mode: str = "overwrite") -> None:
    for name, df in tables.items():
        df.write.mode(mode).parquet(table_path(base, name))
