"""Connected components of a table of links, by contraction.

In every round each node is merged into the first neighbour (or itself) by id or,
in every second round, by hash, and links are rewritten to the merged nodes.
Random order makes long chains shrink by a constant factor a round. Only minima per node are
aggregated, which combines before the shuffle, so a node with very many links is
no hot key. Every round is written to the shared folder: a written table also
carries no inferred constraints, which would make the plans of later rounds grow.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualityforge import runtime
from qualityforge.llm.staging import staged


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component) for every node of a link; the component is its smallest id.

    Links are undirected; repeated links and loops are allowed, rows with a null
    end are ignored.
    """
    edges = staged(links.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a is not null and b is not null").distinct(), "edges")
    labels = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct().withColumn("root", F.col("id"))
    edges, round_ = edges.filter("a <> b"), 0
    while not edges.isEmpty():
        # The order of the ids themselves merges stars around their smallest node at
        # once; random orders in between see to chains.
        own, other = (F.col("a"), F.col("b")) if round_ % 2 == 0 else (F.xxhash64("a", F.lit(round_)), F.xxhash64("b", F.lit(round_)))
        best = edges.union(edges.select("b", "a")).groupBy("a").agg(F.min_by("b", other).alias("b"), F.min(other).alias("h"))
        step = staged(best.select(F.col("a").alias("node"), F.when(own < F.col("h"), F.col("a")).otherwise(F.col("b")).alias("into")), "steps")
        side = runtime.checked_broadcast(step)
        labels = labels.join(side.withColumnRenamed("node", "root"), "root", "left").select("id", F.coalesce("into", "root").alias("root"))
        moved = edges.join(side.select(F.col("node").alias("a"), F.col("into").alias("_a")), "a")
        moved = moved.join(side.select(F.col("node").alias("b"), F.col("into").alias("_b")), "b")
        edges = staged(moved.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")).filter("a <> b").distinct(), "edges")
        round_ += 1
    labels = staged(labels, "labels")
    smallest = labels.groupBy("root").agg(F.min("id").alias("component"))
    return staged(labels.join(smallest, "root").select("id", "component"), "components")


def joined(known: DataFrame, more: DataFrame) -> DataFrame:
    """(id, component) after further links (a, b) are added to ``known`` components.

    Only the components that the new links touch are worked on.
    """
    name = known.select("id", "component")
    first = name.select(F.col("id").alias("a"), F.col("component").alias("_a"))
    second = name.select(F.col("id").alias("b"), F.col("component").alias("_b"))
    ends = more.select("a", "b").join(first, "a", "left").join(second, "b", "left")
    ends = staged(ends.select("a", "b", F.coalesce("_a", "a").alias("_a"), F.coalesce("_b", "b").alias("_b")), "joined")
    merged = components(ends, "_a", "_b").select(F.col("id").alias("component"), F.col("component").alias("_into"))
    fresh = ends.selectExpr("a as id", "_a as component").union(ends.select("b", "_b")).distinct()
    every = name.union(fresh).distinct()
    return staged(every.join(merged, "component", "left").select("id", F.coalesce("_into", "component").alias("component")), "components")
