"""Turn a flat source into dictionaries plus fact tables, and group digests."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from qualityforge import runtime


def build_dictionary(df: DataFrame, column: str, id_name: str = "id", name: str = "name") -> DataFrame:
    """(id, name): distinct non-NULL values with dense ids from 1 in name order.

    Sorting is a range partitioning. Each partition numbers its own rows and is
    shifted by the sizes of the partitions before it, so no task sees all names;
    the shift table has one row per partition.
    """
    ordered = (
        df.select(F.col(column).alias(name))
        .filter(F.col(name).isNotNull())
        .distinct()
        .orderBy(name)
        .withColumn("__m", F.monotonically_increasing_id())
    )
    # Numbering must not change between the two uses below.
    numbered = runtime.pin(
        ordered.select(name, F.shiftright("__m", 33).alias("__p"), F.col("__m").bitwiseAND(F.lit((1 << 33) - 1)).alias("__i"))
    )
    sizes = numbered.groupBy("__p").agg(F.count(F.lit(1)).alias("__n"))
    before = W.orderBy("__p").rowsBetween(W.unboundedPreceding, -1)
    shift = sizes.select("__p", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__s"))
    return numbered.join(F.broadcast(shift), "__p").select(
        (F.col("__s") + F.col("__i") + 1).alias(id_name), F.col(name)
    )


def dictionary_rows(spark, names: Sequence[str], id_name: str = "id", name: str = "name") -> DataFrame:
    """A fixed dictionary numbered from 1 in the order given."""
    return spark.createDataFrame(list(enumerate(names, 1)), f"{id_name} int, {name} string")


def encode(
    df: DataFrame,
    columns: Mapping[str, tuple[DataFrame, str]],
    id_name: str = "id",
    name: str = "name",
    collation: str | None = None,
) -> DataFrame:
    """Replace text columns by dictionary ids: {text column: (dictionary, new
    column)}. Unmatched and NULL names become a NULL id; no row is lost.

    ``collation`` (for example ``UTF8_LCASE``) compares the way a
    case-insensitive source database would.
    """
    out = df
    for i, (column, (dictionary, target)) in enumerate(columns.items()):
        side = dictionary.select(F.col(id_name).alias(target), F.col(name).alias(f"__n{i}"))
        left, right = F.col(column), F.col(f"__n{i}")
        if collation:
            left, right = F.collate(left, collation), F.collate(right, collation)
        out = out.join(runtime.checked_broadcast(side), left == right, "left").drop(f"__n{i}", column)
    return out


def copy_columns(df: DataFrame, columns: Sequence[str], defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Column-list copy, filling NULL or missing columns from ``defaults``."""
    defaults = defaults or {}
    cols = []
    for c in columns:
        if c in df.columns:
            cols.append(F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) if c in defaults else F.col(c))
        else:
            cols.append(F.lit(defaults[c]).alias(c))
    return df.select(*cols)


def _item_text(items: Sequence[str]) -> Column:
    """An item as one text, NULL if any part is."""
    return F.concat(*[p for i, c in enumerate(items) for p in ([F.lit(":")] if i else []) + [F.col(c).cast("string")]])


def group_fingerprint(df: DataFrame, key: str, items: Sequence[str], prefix: str = "fp") -> DataFrame:
    """Per key, an order-free digest of its multiset of items.

    Two keys get the same digest when they hold the same items equally often:
    the item count and four sums of independent 24-bit hash pieces (which do not
    overflow below 5e11 items a key). Unlike a sorted list it is a plain sum, so
    a key with any number of rows combines map side and needs constant memory.
    Items with a NULL part are ignored.
    """
    text = _item_text(items)
    lanes = []
    for salt in (1, 2):
        h = F.when(text.isNotNull(), F.xxhash64(F.lit(salt), text))
        lanes += [F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << 24) - 1)) for shift in (40, 8)]
    return df.groupBy(key).agg(
        F.count(text).alias(f"{prefix}_n"),
        *[F.coalesce(F.sum(x), F.lit(0)).alias(c) for x, c in zip(lanes, fingerprint_columns(prefix)[1:])],
    )


def fingerprint_columns(prefix: str = "fp") -> list[str]:
    """The digest columns of `group_fingerprint`."""
    return [f"{prefix}_{c}" for c in "nabcd"]


def multiset_groups(df: DataFrame, key: str, items: Sequence[str], name: str = "fp", digest: Callable[..., DataFrame] = group_fingerprint) -> DataFrame:
    """(key, name): per key, the smallest key that holds the same items equally often.

    The digest only routes: keys of one digest are compared with the first of them item by
    item, as counted items and not as lists, so a key with any number of rows is split
    like any other. Keys that differ from the first in spite of their digest are compared
    among themselves in the next round; there is none unless digests collide. Items
    with a NULL part are ignored, and keys without items are alike; NULL keys are left out.
    """
    rows = df.filter(F.col(key).isNotNull())
    counted = rows.select(F.col(key).alias("k"), _item_text(items).alias("item")).filter("item is not null")
    counted = runtime.pin(counted.groupBy("k", "item").agg(F.count(F.lit(1)).alias("c")))
    marks = digest(rows, key, items).withColumnRenamed(key, "k")
    lanes = [c for c in marks.columns if c != "k"]
    kinds = counted.groupBy("k").agg(F.count(F.lit(1)).alias("m"))
    left = runtime.pin(marks.join(kinds, "k", "left").select("k", *lanes, F.coalesce("m", F.lit(0)).alias("m")))
    theirs = counted.withColumnRenamed("k", "rep")
    done = None
    while True:
        first = left.groupBy(*lanes).agg(F.min("k").alias("rep"), F.min_by("m", "k").alias("rep_m"))
        named = left.join(runtime.checked_broadcast(first), lanes)
        others = named.filter((F.col("k") != F.col("rep")) & (F.col("m") == F.col("rep_m"))).select("k", "rep")
        met = others.join(counted, "k").join(theirs, ["rep", "item", "c"]).groupBy("k").agg(F.count(F.lit(1)).alias("met"))
        equal = (F.col("m") == F.col("rep_m")) & (F.coalesce("met", F.lit(0)) == F.col("m"))
        judged = runtime.pin(named.join(met, "k", "left").withColumn("same", (F.col("k") == F.col("rep")) | equal))
        same = judged.filter("same").select(F.col("k").alias(key), F.col("rep").alias(name))
        done = same if done is None else done.unionByName(same)
        left = judged.filter("not same").select("k", *lanes, "m")
        if left.isEmpty():
            return done


def decodable(df: DataFrame, key: str, base: int, marker: tuple[str, str] | None = None) -> bool:
    """True when there are rows and every id is at least ``base`` (and every
    ``marker`` column, if present, has its value): ids then encode their group."""
    cond = F.col(key) >= F.lit(base)
    if marker and marker[0].lower() in {c.lower() for c in df.columns}:
        cond = cond & (F.col(marker[0]) == F.lit(marker[1]))
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(cond).alias("m")).first()
    return row["n"] > 0 and row["n"] == row["m"]
