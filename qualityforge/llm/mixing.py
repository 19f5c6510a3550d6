"""Mix sources to target weights: budgets down a domain-language-source tree.

Every node gets a share of its parent's tokens in proportion to its weight. A
node that cannot use its share (its capacity is its tokens times the allowed
epochs) leaves the shortage to its siblings first; only what no sibling can use
stays with the parent, whose own capacity already says so to the level above.
Hence one pass from the root settles all levels, exactly, in integers.

A leaf's tokens are then the prefix of an endless stream: epoch after epoch, each
a seeded order of the leaf's documents. Whole epochs are a count per document;
the last, partial one is cut by running sums over two levels of hash buckets, so
that no task orders more than 1/65536 of a leaf.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from qualityforge import runtime
from qualityforge.llm.staging import staged

@dataclass(frozen=True)
class Mix:
    """Levels from the root down, integer weights (from 1) by level and name, 1 if
    not listed; the budget is ``parts / of`` of all tokens; ``epochs`` is how
    often a token may be used."""

    levels: tuple[str, ...]
    weights: Mapping[str, Mapping[str, int]]
    epochs: int = 4
    parts: int = 1
    of: int = 1
    seed: int = 17

    def __post_init__(self):
        if self.epochs < 1 or min([1, *(w for level in self.weights.values() for w in level.values())]) < 1:
            raise ValueError("epochs and weights start at 1")


WORD = r"[^\x20\x09-\x0D]+"
_WIDE = "decimal(38,0)"


def count_words(text: str = "text") -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def weight_of(names: Column, weights: Mapping[str, int], default: int = 1) -> Column:
    """Integer weight of a name; names that are not listed get ``default``."""
    out = F.lit(default)
    for name, weight in weights.items():
        out = F.when(names == name, weight).otherwise(out)
    return out.cast("long")


def _share(nodes: DataFrame, parents: list[str], name: str) -> DataFrame:
    """Add ``got`` to siblings (``parents``) with capacity ``cap``, weight ``w`` and their parent's ``total``.

    Siblings fill up in order of capacity per weight: one is full if its share of
    what the fuller ones left exceeds its capacity. The rest divides by weight,
    rounded down; the units lost by rounding go to the largest remainders.
    """
    family = W.partitionBy(*(parents or [F.lit(0)]))
    by_need = family.orderBy(F.col("cap").cast("double") / F.col("w"), name)
    before = by_need.rowsBetween(W.unboundedPreceding, -1)
    after = by_need.rowsBetween(0, W.unboundedFollowing)

    def wide(c: str) -> Column:
        return F.col(c).cast(_WIDE)

    n = nodes.withColumn("_total", F.least("total", F.sum("cap").over(family)))
    n = n.withColumn("_left", F.col("_total") - F.coalesce(F.sum("cap").over(before), F.lit(0))).withColumn("_w", F.sum("w").over(after))
    n = n.withColumn("_full", wide("cap") * wide("_w") <= wide("_left") * wide("w"))
    # Full siblings form a prefix of the order.
    n = n.withColumn("_full", F.min("_full").over(by_need.rowsBetween(W.unboundedPreceding, 0)))
    n = n.withColumn("_left", F.col("_total") - F.coalesce(F.sum(F.when(F.col("_full"), F.col("cap"))).over(family), F.lit(0)))
    n = n.withColumn("_w", F.sum(F.when(~F.col("_full"), F.col("w"))).over(family))
    n = n.withColumn("_floor", F.expr(f"if(_full, cap, cast(cast(_left as {_WIDE}) * cast(w as {_WIDE}) div cast(_w as {_WIDE}) as bigint))"))
    n = n.withColumn("_part", F.when(~F.col("_full"), wide("_left") * wide("w") - wide("_floor") * wide("_w")))
    n = n.withColumn("_units", F.col("_total") - F.sum("_floor").over(family))
    n = n.withColumn("_rank", F.row_number().over(family.orderBy("_full", F.col("_part").desc_nulls_last(), name)))
    return n.withColumn("got", F.col("_floor") + F.when(F.col("_rank") <= F.col("_units"), 1).otherwise(0))


def budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves`` (levels..., tokens) with ``budget``, the tokens each leaf gives."""
    above = None
    for depth, level in enumerate(mix.levels):
        parents = list(mix.levels[:depth])
        nodes = leaves.groupBy(*parents, level).agg((F.sum("tokens") * mix.epochs).alias("cap"), F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("w", weight_of(F.col(level), mix.weights.get(level, {})))
        if above is None:
            corpus = F.sum("tokens").over(W.partitionBy(F.lit(0)))
            nodes = nodes.withColumn("total", F.floor(corpus * mix.parts / mix.of).cast("long"))
        else:
            nodes = nodes.join(above, parents)
        above = _share(nodes, parents, level).select(*parents, level, F.col("got").alias("total"))
    return leaves.join(above.withColumnRenamed("total", "budget"), list(mix.levels))


def _cut(docs: DataFrame, leaf: list[str], bucket: str) -> DataFrame:
    """Per leaf the bucket in which ``rest`` tokens end, and the tokens still wanted from it."""
    sums = docs.groupBy(*leaf, "rest", bucket).agg(F.sum("n_tokens").alias("_sum"))
    before = F.sum("_sum").over(W.partitionBy(*leaf).orderBy(bucket)) - F.col("_sum")
    return (
        sums.withColumn("_before", before)
        .filter("_before <= rest and rest < _before + _sum")
        .select(*leaf, F.col(bucket).alias(f"cut{bucket}"), (F.col("rest") - F.col("_before")).alias(f"rest{bucket}"))
    )


def mix_sources(docs: DataFrame, mix: Mix, key: str = "doc_id") -> DataFrame:
    """How many tokens of every document the mixture takes.

    ``docs`` has the key, the level columns and ``n_tokens``. Returned for every
    row: key, levels, n_tokens, budget of the leaf, full_epochs, last_tokens
    (taken in the unfinished epoch: all, none, or for the document in which the
    budget ends a part) and used_tokens. A null level counts as the empty name,
    null tokens as 0. Rows that repeat a key follow one another in the seeded
    order in any order. A leaf without tokens gets no budget. Other columns are
    not read; an empty table gives no rows.
    """
    leaf = list(mix.levels)
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in leaf]
    sizes = staged(docs.select(F.col(key).alias("_id"), *names, F.coalesce(F.col("n_tokens"), F.lit(0)).cast("long").alias("n_tokens")), "mix-sizes")
    shares = budgets(sizes.groupBy(*leaf).agg(F.sum("n_tokens").alias("tokens")), mix)
    shares = runtime.pin(
        shares.select(
            *leaf,
            "budget",
            F.when(F.col("tokens") > 0, F.expr("budget div tokens")).otherwise(0).alias("full_epochs"),
            F.when(F.col("tokens") > 0, F.col("budget") % F.col("tokens")).otherwise(0).alias("rest"),
        )
    )
    seeded = F.md5(F.concat_ws(":", F.lit(str(mix.seed)), F.col("full_epochs").cast("string"), F.col("_id").cast("string")))
    order = sizes.join(runtime.checked_broadcast(shares), leaf).withColumn("_order", seeded)
    order = order.withColumn("_1", F.substring("_order", 1, 2)).withColumn("_2", F.substring("_order", 3, 2))
    first = runtime.pin(_cut(order, leaf, "_1"))
    inside = order.join(runtime.checked_broadcast(first), leaf).filter("_1 = cut_1").withColumn("rest", F.col("rest_1"))
    cuts = runtime.pin(_cut(inside, leaf, "_2").join(first, leaf))
    placed = order.join(runtime.checked_broadcast(cuts), leaf, "left").withColumn("_side", F.substring("_order", 1, 4))
    placed = placed.withColumn("_cut", F.concat("cut_1", "cut_2"))
    apart = placed.filter("_cut is null or _side <> _cut").withColumn(
        "last_tokens", F.when(F.col("_side") < F.col("_cut"), F.col("n_tokens")).otherwise(0)
    )
    running = F.sum("n_tokens").over(W.partitionBy(*leaf).orderBy("_order", "_id").rowsBetween(W.unboundedPreceding, 0)) - F.col("n_tokens")
    cut = placed.filter("_side = _cut").withColumn(
        "last_tokens", F.greatest(F.lit(0), F.least(F.col("n_tokens"), F.col("rest_2") - running))
    )
    out = [F.col("_id").alias(key), *leaf, "n_tokens", "budget", "full_epochs", "last_tokens"]
    return (
        apart.select(*out)
        .unionByName(cut.select(*out))
        .withColumn("used_tokens", F.col("full_epochs") * F.col("n_tokens") + F.col("last_tokens"))
    )


def mixed_rows(docs: DataFrame, sizes: DataFrame, mix: Mix, key: str = "doc_id") -> DataFrame:
    """``docs`` as the mixture uses them: a row for each epoch that takes tokens of it.

    Columns are unchanged. Documents are not cut: the one in which a leaf's budget
    ends comes whole. Rows that repeat a key come as often as the one used most;
    rows with a null key are left out.
    """
    plan = mix_sources(sizes, mix, key).filter("used_tokens > 0")
    copies = plan.withColumn("_mix_copies", F.col("full_epochs") + F.when(F.col("last_tokens") > 0, 1).otherwise(0))
    copies = copies.groupBy(F.col(key).alias("_mix_key")).agg(F.max("_mix_copies").alias("_mix_copies"))
    joined = docs.join(copies, F.col(key) == F.col("_mix_key"))
    return joined.withColumn("_mix_epoch", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int")))).drop("_mix_key", "_mix_copies", "_mix_epoch")
