"""Session-level helpers shared by the operators.

Three concerns live here because every operator needs the same answer:

* where intermediate results may be written so that any executor can be lost,
* how a side of a join earns a broadcast hint (its size is checked first),
* which group keys are too heavy for one task.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A group of at least this many rows is too heavy for one task.
HOT_ROWS = 1_000_000

BROADCAST_MAX_ROWS = 100_000
BROADCAST_MAX_BYTES = 64 << 20


def local_session(app: str = "qualityforge", cores: str | int = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A local run without that setting gets a private folder; a cluster without
    it is refused, because a machine-local folder would lose data there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="qualityforge-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a staged table inside the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def pin(df: DataFrame) -> DataFrame:
    """Write ``df`` once (reliable checkpoint) so later readers see one version."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """True when ``df`` is small in rows and in text size. One aggregate: a
    limit would first gather that many rows of every partition in one task."""
    width = sum((F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) for c in df.columns), F.lit(16))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(width.cast("long")).alias("b")).first()
    return row["n"] <= max_rows and (row["b"] or 0) <= max_bytes


def checked_broadcast(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Hint a broadcast if the size check passes; otherwise leave ``df`` alone.

    Without the hint the join is a shuffle join whose heavy keys are split by
    adaptive execution.
    """
    return F.broadcast(df) if fits_broadcast(df, max_rows) else df


def hot_groups(df: DataFrame, keys: list[str], rows: int = HOT_ROWS) -> DataFrame:
    """(h, n): hash and exact row count of every group with at least ``rows`` rows.

    One pass over the key columns, counted inside the tasks before the shuffle.
    Two groups sharing a hash are counted as one, which only routes them alike.
    """
    hashed = df.select(F.xxhash64(*[F.expr(k) for k in keys]).alias("h"))
    return pin(hashed.groupBy("h").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= rows))


def together(spark: SparkSession, tasks: Sequence[Callable[[], object]]) -> list:
    """Run independent driver-side steps at the same time, so that their jobs
    share the cluster instead of waiting for one another."""
    if len(tasks) < 2:
        return [t() for t in tasks]
    with ThreadPoolExecutor(len(tasks)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(t)) for t in tasks]]
