"""Registered queries: sources, sinks, sampling and normalising."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qualityforge import runtime
from qualityforge.operators import distinct, graph, normalize, sampling
from qualityforge.operators.constraints import evaluate
from qualityforge.plans.quality import ORDER_RULES, ORDER_TABLES, _sql_report
from qualityforge.plans.registry import Lake, query, rounded
from qualityforge.sources import reports, splits, sync, tables as tab

SYNCED = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _sql_uniform(stream: str, key: str, index: str = "0", seed: int = 0) -> str:
    """The keyed uniform of `Keyed.uniform` in SQL."""
    text = f"'{seed}:{stream}:' || {key} || ':' || {index}"
    return f"((('0x' || substr(md5({text}), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296.0::DOUBLE)"


@query(
    "sync_tables",
    " UNION ALL ".join(
        f"SELECT '{t}' AS \"table\", count(*) AS source_rows, count(*) AS rows, true AS ok FROM {t}" for t in SYNCED
    ),
)
def sync_tables(lake: Lake) -> DataFrame:
    out = runtime.scratch_path(lake.spark, "synced")
    return sync.sync_tables(lake.spark, sync.ParquetSource(lake.base, ".parquet"), SYNCED, out)


_SPARSE_KEY = "CASE WHEN l_linenumber = 7 THEN NULL WHEN l_orderkey % 3 = 0 THEN 42 ELSE l_orderkey * l_orderkey * 1000 END"


@query(
    "split_scan",
    "SELECT l_returnflag, count(*) AS rows, count(*) AS once, round(sum(l_quantity), 4) AS quantity, true AS even FROM lineitem GROUP BY l_returnflag",
)
def split_scan(lake: Lake) -> DataFrame:
    """Lines read by splits of a key that is missing in some rows, one value in a third of
    them and sparse in the others: every row comes in exactly one split, and no split but
    that of the frequent value is too large."""
    view = f"lines_{uuid.uuid4().hex}"
    lake.lineitem.select(F.expr(_SPARSE_KEY).alias("k"), "l_returnflag", "l_quantity").createOrReplaceTempView(view)
    total = lake.lineitem.count()
    wanted = max(1, total // 12)
    parts = splits.split_by_key(lake.spark.sql, view, "k", wanted)
    rows = lake.spark.table(view)
    held = sum((F.when(F.expr(f"coalesce({p.predicate}, false)"), 1).otherwise(0) for p in parts), F.lit(0))
    # The smallest key is the frequent one, and rows without a key go with it.
    fits = len(parts) > 5 and all(p.rows <= wanted for p in parts[1:])
    out = rows.withColumn("held", held).groupBy("l_returnflag")
    return rounded(
        out.agg(
            F.count(F.lit(1)).alias("rows"), F.count_if(F.col("held") == 1).alias("once"), F.sum("l_quantity").alias("quantity"), F.lit(fits).alias("even")
        ), 4,
    )


@query(
    "optional_load",
    "SELECT 'region' AS name, (SELECT count(*) FROM region) AS rows UNION ALL SELECT 'no_such_table', NULL",
)
def optional_load(lake: Lake) -> DataFrame:
    parts = []
    for name in ("region", "no_such_table"):
        df = tab.load_optional(lake.spark, f"{lake.base}/{name}.parquet")
        rows = F.lit(None).cast("long") if df is None else df.agg(F.count(F.lit(1)).alias("n")).scalar()
        parts.append(lake.spark.range(1).select(F.lit(name).alias("name"), rows.alias("rows")))
    return parts[0].unionByName(parts[1])


@query(
    "schema_projection",
    "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey,"
    " round(o_totalprice, 2) AS o_totalprice FROM orders",
)
def schema_projection(lake: Lake) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("o_orderkey", T.LongType()),
            T.StructField("o_custkey", T.StringType()),
            T.StructField("o_totalprice", T.DoubleType()),
        ]
    )
    return rounded(tab.load(lake.spark, f"{lake.base}/orders.parquet", schema), 2)


@query("external_table", "SELECT c_mktsegment, count(*) AS cnt FROM customer GROUP BY c_mktsegment")
def external_table(lake: Lake) -> DataFrame:
    """Write to a location, declare it as an external table, query by name."""
    path = runtime.scratch_path(lake.spark, "customer")
    name = f"customer_{uuid.uuid4().hex[:8]}"
    df = lake.customer
    df.write.mode("overwrite").parquet(path)
    tab.register_external(lake.spark, name, df.schema, path)
    return tab.load(lake.spark, name).groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("cnt"))


@query("report_append", _sql_report([r.code for r in ORDER_RULES]).replace(", CASE WHEN violation_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status", ""))
def report_append(lake: Lake) -> DataFrame:
    """Append a constraint run to the report tables and read it back."""
    base = runtime.scratch_path(lake.spark, "reports")
    found = evaluate(ORDER_RULES, lake.tables(ORDER_TABLES))
    run = reports.append_constraint_report(found, reports.RunMeta("orders", 0, 0), base)
    stored = reports.read_reports(lake.spark, base, "hard_constraint_result").filter(F.col("run_id") == run)
    return rounded(stored.drop("run_id"))


@query(
    "key_hash_sample",
    f"SELECT o_orderkey, o_custkey FROM orders WHERE {_sql_uniform('sample', 'o_orderkey')} < 0.25",
)
def key_hash_sample(lake: Lake) -> DataFrame:
    return sampling.key_hash_sample(lake.orders, "o_orderkey", 0.25).select("o_orderkey", "o_custkey")


@query(
    "referential_sample",
    "SELECT l_orderkey AS o_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_orderkey IN"
    f" (SELECT o_orderkey FROM orders WHERE {_sql_uniform('sample', 'o_orderkey')} < 0.25)",
)
def referential_sample(lake: Lake) -> DataFrame:
    both = {"orders": lake.orders, "lineitem": lake.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")}
    out = sampling.referential_sample(both, "orders", "o_orderkey", ["lineitem"], 0.25)
    return out["lineitem"].select("o_orderkey", "l_linenumber", "l_quantity")


STAR_KEYS = [
    graph.ForeignKey("nation", "n_regionkey", "region", "r_regionkey"),
    graph.ForeignKey("customer", "c_nationkey", "nation", "n_nationkey"),
    graph.ForeignKey("supplier", "s_nationkey", "nation", "n_nationkey"),
    graph.ForeignKey("orders", "o_custkey", "customer", "c_custkey"),
    graph.ForeignKey("lineitem", "l_orderkey", "orders", "o_orderkey"),
    graph.ForeignKey("lineitem", "l_suppkey", "supplier", "s_suppkey"),
]
_GRAPH = ("region", "nation", "customer", "supplier", "orders", "lineitem")
_SQL_LINES = "SELECT l_orderkey, l_suppkey, l_linenumber, l_extendedprice FROM lineitem"


@query(
    "cascade_over_keys",
    "WITH n AS (SELECT * FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region WHERE r_name = 'ASIA')),"
    " c AS (SELECT * FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM n)), s AS (SELECT * FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM n)),"
    " o AS (SELECT * FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c))"
    f" {_SQL_LINES} WHERE l_orderkey IN (SELECT o_orderkey FROM o) AND l_suppkey IN (SELECT s_suppkey FROM s)",
)
def cascade_over_keys(lake: Lake) -> DataFrame:
    """Lines left after one region goes: two ways down, over four and three levels."""
    tables = lake.tables(_GRAPH)
    out = graph.cascade(tables, STAR_KEYS, {"region": lake.region.filter("r_name <> 'ASIA'")})
    return out["lineitem"].select("l_orderkey", "l_suppkey", "l_linenumber", "l_extendedprice")


@query(
    "graph_sample",
    f"WITH c AS (SELECT c_custkey FROM customer WHERE {_sql_uniform('sample', 'c_nationkey')} < 0.4), o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c))"
    " SELECT 'customer' AS name, c_custkey AS id FROM c UNION ALL SELECT 'orders', o_orderkey FROM o"
    " UNION ALL SELECT 'lineitem', l_orderkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM o) UNION ALL SELECT 'supplier', s_suppkey FROM supplier",
)
def graph_sample(lake: Lake) -> DataFrame:
    """Whole nations of customers with all their orders and lines; suppliers do not depend on them."""
    out = graph.graph_sample(lake.tables(_GRAPH), STAR_KEYS, "customer", "c_nationkey", 0.4)
    parts = [out[t].select(F.lit(t).alias("name"), F.col(k).alias("id")) for t, k in (("customer", "c_custkey"), ("orders", "o_orderkey"), ("lineitem", "l_orderkey"), ("supplier", "s_suppkey"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query(
    "cascade_in_a_cycle",
    "SELECT o_orderkey, previous FROM (SELECT o_orderkey, lag(o_orderkey) OVER w AS previous,"
    " max(CASE WHEN o_orderkey % 5 = 0 THEN 1 ELSE 0 END) OVER w AS gone FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderkey)) WHERE gone = 0",
)
def cascade_in_a_cycle(lake: Lake) -> DataFrame:
    """Orders refer to the customer's previous one: what follows a removed order goes too."""
    w = W.partitionBy("o_custkey").orderBy("o_orderkey")
    orders = lake.orders.select("o_orderkey", F.lag("o_orderkey").over(w).alias("previous"))
    keys = [graph.ForeignKey("orders", "previous", "orders", "o_orderkey")]
    return graph.cascade({"orders": orders}, keys, {"orders": orders.filter("o_orderkey % 5 <> 0")})["orders"]


# What holds for any correct sample: all drawn rows are rows of the table, none
# comes twice, and each tenth of the keys gives its share within six deviations.
@query(
    "bernoulli_sample",
    "SELECT o_orderkey % 10 AS slice, count(*) AS rows, count(*) AS known, true AS once, true AS near FROM orders GROUP BY 1",
)
def bernoulli_sample(lake: Lake) -> DataFrame:
    drawn = sampling.bernoulli_sample(lake.orders, 0.1, seed=7).groupBy("o_orderkey", "o_totalprice").agg(F.count(F.lit(1)).alias("times"))
    both = lake.orders.select("o_orderkey", "o_totalprice", F.lit(1).alias("here")).join(drawn, ["o_orderkey", "o_totalprice"], "full")
    rows, taken = F.count(F.lit(1)), F.count("times")
    spread = 6 * F.sqrt(rows * 0.1 * 0.9)
    return both.groupBy((F.col("o_orderkey") % 10).alias("slice")).agg(
        rows.alias("rows"),
        F.count("here").alias("known"),
        (F.coalesce(F.max("times"), F.lit(1)) == 1).alias("once"),
        (F.abs(taken - rows * 0.1) <= spread).alias("near"),
    )


_SQL_SEGMENTS = (
    "SELECT row_number() OVER (ORDER BY c_mktsegment) AS id, c_mktsegment AS name FROM"
    " (SELECT DISTINCT c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL)"
)


@query("dictionary_build", _SQL_SEGMENTS)
def dictionary_build(lake: Lake) -> DataFrame:
    return normalize.build_dictionary(lake.customer, "c_mktsegment")


@query(
    "dictionary_build_large",
    "SELECT row_number() OVER (ORDER BY c_name) AS id, c_name AS name FROM (SELECT DISTINCT c_name FROM customer)",
)
def dictionary_build_large(lake: Lake) -> DataFrame:
    return normalize.build_dictionary(lake.customer, "c_name")


@query(
    "dictionary_encode",
    f"SELECT c_custkey, d.id AS segment_id FROM customer LEFT JOIN ({_SQL_SEGMENTS}) d"
    " ON c_mktsegment = d.name AND d.name <> 'MACHINERY'",
)
def dictionary_encode(lake: Lake) -> DataFrame:
    # A dictionary that lacks one name: its rows get a NULL id.
    names = normalize.build_dictionary(lake.customer, "c_mktsegment").filter("name <> 'MACHINERY'")
    return normalize.encode(lake.customer, {"c_mktsegment": (names, "segment_id")}).select("c_custkey", "segment_id")


@query(
    "copy_with_defaults",
    "SELECT event_id, coalesce(nullif(event_type, 'error'), 'n/a') AS event_type, 1 AS version FROM events",
)
def copy_with_defaults(lake: Lake) -> DataFrame:
    events = lake.events.withColumn("event_type", F.expr("nullif(event_type, 'error')"))
    return normalize.copy_columns(events, ["event_id", "event_type", "version"], {"event_type": "n/a", "version": 1})


# ------------------------------------------- distinct counts over stored runs

_DISTINCT = ("l_orderkey", "l_partkey", "l_suppkey", "l_shipdate")


@query(
    "distinct_across_runs",
    " UNION ALL ".join(
        f"SELECT '{c}' AS item, count({c}) AS n_rows, count(DISTINCT {c}) AS n_exact, true AS within_stated_error FROM lineitem" for c in _DISTINCT
    ),
)
def distinct_across_runs(lake: Lake) -> DataFrame:
    """Each return flag is a run of its own, the first one repeated; the union of the stored
    sketches estimates the whole table, held against its exact counts."""
    base = runtime.scratch_path(lake.spark, "distinct-runs")
    for run, flag in enumerate(["A", "A", "N", "R"]):
        part = lake.lineitem.filter(F.col("l_returnflag") == flag)
        sketches = distinct.distinct_sketches(part, _DISTINCT)
        reports.append_distinct(sketches, reports.RunMeta("lineitem", 0, 0, run_id=max(run, 1)), base)
    exact = lake.lineitem.agg(*[F.count_distinct(c).alias(c) for c in _DISTINCT])
    exact = exact.select(F.inline(F.array(*[F.struct(F.lit(c).alias("item"), F.col(c).alias("n_exact")) for c in _DISTINCT])))
    found = reports.distinct_across(lake.spark, base).join(exact, "item")
    near = F.abs(F.col("n_distinct") - F.col("n_exact")) <= distinct.stated_error() * F.col("n_exact")
    return found.select("item", "n_rows", "n_exact", near.alias("within_stated_error"))
