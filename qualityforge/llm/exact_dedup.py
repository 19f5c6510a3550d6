"""Exact duplicates, skew-safe: local, salted and global combining on full content.

A group of equal texts may hold any share of all rows. Spark's partial
aggregation first merges equal texts inside each task, salted groups merge next,
and only their winners meet globally. All three steps group by (digest, content),
so two different texts with one digest never merge. The way back to the rows
joins on the digest; contents are compared again only for digests that hold more
than one text (none, with SHA-256).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qualityforge import runtime
from qualityforge.llm.staging import staged

SALTS = 16
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: str = "text") -> Column:
    """Null as empty, A-Z lower-cased; nothing else changes."""
    return F.translate(F.coalesce(F.col(text), F.lit("")), _UPPER, _LOWER)


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(F.encode(content, "UTF-8"), 256))


def _contents(docs: DataFrame, key: str, text: str, digest) -> DataFrame:
    rows = docs.select(F.col(key).alias("_id"), normalised(text).alias("_content"))
    return rows.withColumn("_digest", digest(F.col("_content")))


def winners(docs: DataFrame, key: str = "doc_id", text: str = "text", digest=sha256, salts: int = SALTS) -> DataFrame:
    """One row per different text: (_digest, _content, keep_id, group_size)."""
    salted = (
        _contents(docs, key, text, digest)
        .groupBy("_digest", F.pmod(F.xxhash64("_id"), F.lit(salts)).alias("_salt"), "_content")
        .agg(F.max("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )
    # By digest alone, so that the number of texts on a digest needs no further shuffle.
    return (
        salted.repartition("_digest")
        .groupBy("_digest", "_content")
        .agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    )


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", digest=sha256, salts: int = SALTS) -> DataFrame:
    """(key, keep_id, group_size, kept, digest) of every row.

    The row with the largest key of equal texts stays. Null text counts as empty,
    and the empty text is a text like others. Rows that repeat a key each count in
    group_size, and all rows with the winning key are kept. A null key wins only
    in a group of null keys. Other columns are not read; an empty table gives no
    rows.
    """
    found = winners(docs, key, text, digest, salts)
    best = staged(
        found.groupBy("_digest").agg(
            F.count(F.lit(1)).alias("_texts"), F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size")
        ),
        "exact-winners",
    )
    rows = _contents(docs, key, text, digest)
    out = ["_id", "_digest", "keep_id", "group_size"]
    joined = rows.drop("_content").join(best.filter("_texts = 1"), "_digest").select(*out)
    shared = best.filter("_texts > 1").select("_digest")
    if not shared.isEmpty():
        joined = joined.unionByName(
            rows.join(shared, "_digest", "left_semi").join(found.join(shared, "_digest", "left_semi"), ["_digest", "_content"]).select(*out)
        )
    return joined.select(
        F.col("_id").alias(key),
        "keep_id",
        "group_size",
        F.col("_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("_digest").alias("digest"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every group of equal texts, with its columns unchanged: a row with the largest key.

    Of rows that repeat both key and text any one stays. Column names that start
    with ``_exact_`` are taken.
    """
    marked = docs.withColumns({"_exact_key": F.col(key), "_exact_digest": sha256(normalised(text))})
    lost = exact_groups(docs, key, text).filter(~F.col("kept")).select(F.col(key).alias("_exact_k"), F.col("digest").alias("_exact_d"))
    lost = runtime.checked_broadcast(runtime.pin(lost.distinct()))
    left = marked.join(lost, F.col("_exact_key").eqNullSafe(F.col("_exact_k")) & (F.col("_exact_digest") == F.col("_exact_d")), "left_anti")
    pairs = marked.groupBy("_exact_key", "_exact_digest").agg(F.count(F.lit(1)).alias("_exact_n")).filter("_exact_n > 1")
    twice = runtime.pin(pairs.select(F.col("_exact_key").alias("_exact_k"), F.col("_exact_digest").alias("_exact_d")))
    if not twice.isEmpty():
        again = F.col("_exact_key").eqNullSafe(F.col("_exact_k")) & (F.col("_exact_digest") == F.col("_exact_d"))
        once = left.join(twice, again, "left_semi").dropDuplicates(["_exact_key", "_exact_digest"])
        left = left.join(twice, again, "left_anti").unionByName(once)
    return left.drop("_exact_key", "_exact_digest")
