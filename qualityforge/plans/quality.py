"""Registered queries: constraints, filtering and profiling."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualityforge import runtime
from qualityforge.functions.scalars import block_of
from qualityforge.operators import profile, rules as R
from qualityforge.operators.compliant import compliant_parent, filter_compliant, restrict_children
from qualityforge.operators.constraints import evaluate, run_verdict, violation_ledger
from qualityforge.operators.normalize import fingerprint_columns, group_fingerprint, multiset_groups
from qualityforge.operators.ordered import Skew, not_increasing, strict_prefix_maxima, with_previous
from qualityforge.plans.registry import Lake, query, rounded

# ------------------------------------------------------------------ the rules

ORDER_SERIES = R.MonotonicRule(
    "MON-1", "order totals increase per customer", "orders", "o_orderkey",
    ("o_custkey",), ("o_orderdate", "o_orderkey"), "o_totalprice",
)
COUPLING = R.cross_table_coupling(
    "CPL-1", "small urgent building orders, huge machinery orders", "order",
    [
        R.KeyedInput("lineitem", ("l_orderkey",), {"qty": R.Measure("sum", "`l_quantity`")}),
        R.KeyedInput(
            "orders", ("o_orderkey",),
            {
                "building": R.Measure("count_if", "seg_c_mktsegment = 'BUILDING' AND o_orderpriority = '1-URGENT'"),
                "machinery": R.Measure("count_if", "seg_c_mktsegment = 'MACHINERY'"),
                "customers": R.Measure("count_if", "seg_found"),
            },
            R.Lookup("customer", "o_custkey", "c_custkey", ("c_mktsegment",), "seg_"),
        ),
    ],
    "({qty} < 60 AND {customers} = 1 AND {building} > 0) OR ({qty} > 180 AND {customers} = 1 AND {machinery} > 0)",
    "orders",
)
ROW_RULES = [
    R.row_predicate("ROW-1", "quantity positive", "lineitem", "l_orderkey", "l_quantity <= 0"),
    R.row_range("ROW-2", "discount within [0, 0.08]", "lineitem", "l_orderkey", "l_discount", 0.0, 0.08),
    R.category_cap(
        "ROW-3", "quantity cap by return flag", "lineitem", "l_orderkey", "l_returnflag", "l_quantity",
        {"A": 45.0, "R": 48.0},
    ),
    R.row_range("ROW-4", "order total within [5000, 450000]", "orders", "o_orderkey", "o_totalprice", 5000.0, 450000.0),
]
GROUP_RULES = [
    R.group_sum_cap("GRP-1", "order quantity at most 200", "lineitem", "l_orderkey", "l_quantity", 200.0, "orders", "order"),
    R.group_at_least_one(
        "GRP-2", "an A or R line per order", "lineitem", "l_orderkey", "l_returnflag IN ('A', 'R')", "orders", "order"
    ),
    R.group_exactly_one("GRP-3", "exactly one first line", "lineitem", "l_orderkey", "l_linenumber = 1", "orders", "order"),
]
KEY_RULES = [R.foreign_key("FK-1", "lines belong to orders", "lineitem", "l_orderkey", "orders", "o_orderkey", entity="order")]
ORDER_RULES: list[R.Rule] = [*ROW_RULES, *GROUP_RULES, *KEY_RULES, ORDER_SERIES, COUPLING]
ORDER_TABLES = ("orders", "lineitem", "customer")

# ------------------------------------------------- SQL building blocks (oracle)

_SQL_IDS = {
    "ROW-1": "SELECT l_orderkey AS id FROM lineitem WHERE l_quantity <= 0",
    "ROW-2": "SELECT l_orderkey AS id FROM lineitem WHERE l_discount < 0 OR l_discount > 0.08::DOUBLE",
    "ROW-3": "SELECT l_orderkey AS id FROM lineitem WHERE (l_returnflag = 'A' AND l_quantity > 45)"
    " OR (l_returnflag = 'R' AND l_quantity > 48)",
    "ROW-4": "SELECT o_orderkey AS id FROM orders WHERE o_totalprice < 5000 OR o_totalprice > 450000",
    "GRP-1": "SELECT l_orderkey AS id FROM lineitem GROUP BY l_orderkey HAVING sum(l_quantity) > 200",
    "GRP-2": "SELECT l_orderkey AS id FROM lineitem GROUP BY l_orderkey"
    " HAVING sum(CASE WHEN l_returnflag IN ('A', 'R') THEN 1 ELSE 0 END) = 0",
    "GRP-3": "SELECT l_orderkey AS id FROM lineitem GROUP BY l_orderkey"
    " HAVING sum(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END) <> 1",
    "FK-1": "SELECT DISTINCT l_orderkey AS id FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"
    " WHERE o_orderkey IS NULL",
    "MON-1": "SELECT o_orderkey AS id FROM (SELECT o_orderkey, o_totalprice, lag(o_totalprice) OVER"
    " (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev FROM orders) WHERE o_totalprice <= prev",
    "CPL-1": "SELECT q.k AS id FROM (SELECT l_orderkey AS k, sum(l_quantity) AS qty FROM lineitem GROUP BY l_orderkey) q"
    " JOIN (SELECT o_orderkey AS k, count(*) AS n,"
    " max(CASE WHEN c_mktsegment = 'BUILDING' AND o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END) AS b,"
    " max(CASE WHEN c_mktsegment = 'MACHINERY' THEN 1 ELSE 0 END) AS m"
    " FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY o_orderkey) s ON q.k = s.k"
    " WHERE (qty < 60 AND n = 1 AND b = 1) OR (qty > 180 AND n = 1 AND m = 1)",
}
_SQL_TOTALS = {
    **dict.fromkeys(["ROW-1", "ROW-2", "ROW-3"], "SELECT count(*) FROM lineitem"),
    **dict.fromkeys(["ROW-4", "GRP-1", "GRP-2", "GRP-3", "MON-1", "CPL-1"], "SELECT count(*) FROM orders"),
    "FK-1": "SELECT count(DISTINCT l_orderkey) FROM lineitem",
}


def _sql_report(codes: list[str]) -> str:
    names = {r.code: r.name for r in ORDER_RULES}
    parts = [
        f"SELECT '{c}' AS constraint_code, '{names[c]}' AS constraint_name, ({_SQL_TOTALS[c]}) AS total_checked,"
        f" (SELECT count(*) FROM ({_SQL_IDS[c]})) AS violation_count"
        for c in codes
    ]
    return (
        "SELECT constraint_code, constraint_name, violation_count = 0 AS passed, total_checked, violation_count,"
        " round((total_checked - violation_count) * 100.0::DOUBLE / total_checked, 6) AS pass_rate,"
        " CASE WHEN violation_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status"
        f" FROM ({' UNION ALL '.join(parts)})"
    )


def _sql_ledger(codes: list[str]) -> str:
    return " UNION ".join(f"SELECT DISTINCT id AS entity_id, '{c}' AS code FROM ({_SQL_IDS[c]})" for c in codes)


_FILTER_CODES = [r.code for r in ORDER_RULES if r.in_filter]
_SQL_SURVIVORS = (
    f"WITH bad AS (SELECT DISTINCT entity_id FROM ({_sql_ledger(_FILTER_CODES)})),"
    " kept AS (SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT entity_id FROM bad)),"
    " peaks AS (SELECT *, max(o_totalprice) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey"
    " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS peak FROM kept),"
    " survivors AS (SELECT o_orderkey, o_custkey, o_totalprice FROM peaks WHERE peak IS NULL OR o_totalprice > peak)"
)


def _only(lake: Lake, codes: list[str]) -> tuple[list[R.Rule], dict[str, DataFrame]]:
    return [r for r in ORDER_RULES if r.code in codes], lake.tables(ORDER_TABLES)


def _ledger_query(name: str, codes: list[str]) -> None:
    @query(name, _sql_ledger(codes))
    def run(lake: Lake) -> DataFrame:
        return violation_ledger(*_only(lake, codes))


_ledger_query("row_predicate", ["ROW-1"])
_ledger_query("row_range", ["ROW-2", "ROW-4"])
_ledger_query("category_cap", ["ROW-3"])
_ledger_query("group_sum_cap", ["GRP-1"])
_ledger_query("group_at_least_one", ["GRP-2"])
_ledger_query("group_exactly_one", ["GRP-3"])
_ledger_query("group_monotonic", ["MON-1"])
_ledger_query("cross_table_coupling", ["CPL-1"])
_ledger_query("violation_ledger", _FILTER_CODES)


@query("constraint_report", _sql_report([r.code for r in ORDER_RULES]))
def constraint_report(lake: Lake) -> DataFrame:
    return rounded(evaluate(ORDER_RULES, lake.tables(ORDER_TABLES)))


@query(
    "run_verdict",
    "SELECT bool_and(pass_rate >= 100) AS passed, round(min(pass_rate), 6) AS overall_score FROM"
    f" ({_sql_report([r.code for r in ORDER_RULES])})",
)
def verdict(lake: Lake) -> DataFrame:
    return rounded(run_verdict(evaluate(ORDER_RULES, lake.tables(ORDER_TABLES))))


_BROKEN = [
    ("BAD-1", "no such column", "orders", "(SELECT count(*) FROM orders)"),
    ("BAD-2", "a text cast to a number", "orders", "(SELECT count(*) FROM orders)"),
    ("BAD-3", "a condition without its column", "lineitem", "(SELECT count(*) FROM orders)"),
    ("BAD-4", "a measure without its column", "customer", "(SELECT count(*) FROM orders)"),
]


@query(
    "rule_error_isolation",
    " UNION ALL ".join(
        f"SELECT '{code}' AS constraint_code, '{name}' AS constraint_name, false AS passed, {total} AS total_checked,"
        " NULL::BIGINT AS violation_count, 0.0::DOUBLE AS pass_rate, 'ERROR' AS status"
        for code, name, _, total in _BROKEN
    )
    + f" UNION ALL {_sql_report(['ROW-4'])}",
)
def rule_error_isolation(lake: Lake) -> DataFrame:
    """Rules that fail in analysis or only while they run, next to a good one."""
    (c1, n1, *_), (c2, n2, *_), (c3, n3, *_), (c4, n4, *_) = _BROKEN
    lines = R.KeyedInput("lineitem", ("l_orderkey",), {"q": R.Measure("sum", "l_quantity")})
    buyers = R.KeyedInput(
        "orders", ("o_orderkey",), {"b": R.Measure("max", "cust_no_such_column")}, R.Lookup("customer", "o_custkey", "c_custkey", ("c_acctbal",), "cust_")
    )
    rules = [
        R.row_predicate(c1, n1, "orders", "o_orderkey", "no_such_column > 0"),
        R.row_predicate(c2, n2, "orders", "o_orderkey", "CAST(o_orderpriority AS INT) > 0"),
        R.KeyedRule(c3, n3, "order", (lines,), "{q} > no_such_column", "orders"),
        R.KeyedRule(c4, n4, "order", (buyers,), "{b} > 0", "orders"),
        ROW_RULES[3],
    ]
    return rounded(evaluate(rules, lake.tables(["orders", "lineitem", "customer"])))


# A parent restricted to finished orders, so that some child keys have none.
@query(
    "foreign_key",
    "SELECT 'FK-F' AS constraint_code, 'lines of finished orders' AS constraint_name, bad = 0 AS passed,"
    " total AS total_checked, bad AS violation_count, round((total - bad) * 100.0::DOUBLE / total, 6) AS pass_rate,"
    " CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT"
    " (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS total, (SELECT count(*) FROM (SELECT DISTINCT l_orderkey"
    " FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') ON l_orderkey = o_orderkey"
    " WHERE o_orderkey IS NULL)) AS bad)",
)
def foreign_key(lake: Lake) -> DataFrame:
    rule = R.foreign_key("FK-F", "lines of finished orders", "lineitem", "l_orderkey", "orders", "o_orderkey")
    finished = lake.orders.filter("o_orderstatus = 'F'")
    return rounded(evaluate([rule], {"lineitem": lake.lineitem, "orders": finished}))


@query(
    "orphan_keys",
    "SELECT DISTINCT l_orderkey AS entity_id, 'FK-F' AS code FROM lineitem WHERE l_orderkey NOT IN"
    " (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')",
)
def orphan_keys(lake: Lake) -> DataFrame:
    rule = R.foreign_key("FK-F", "lines of finished orders", "lineitem", "l_orderkey", "orders", "o_orderkey")
    finished = lake.orders.filter("o_orderstatus = 'F'")
    return violation_ledger([rule], {"lineitem": lake.lineitem, "orders": finished})


# ------------------------------------------------------- declared constraints

_DECLARED = [
    R.unique_key("UNI-1", "order line is unique", "lineitem", ["l_orderkey", "l_linenumber"]),
    R.unique_key("UNI-2", "order key is unique", "orders", ["o_orderkey"]),
]


def _sql_one(code: str, name: str, total: str, bad: str) -> str:
    return (
        f"SELECT '{code}' AS constraint_code, '{name}' AS constraint_name, bad = 0 AS passed, total AS total_checked,"
        " bad AS violation_count, round((total - bad) * 100.0::DOUBLE / total, 6) AS pass_rate,"
        f" CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM (SELECT ({total}) AS total, ({bad}) AS bad)"
    )


@query(
    "unique_key",
    _sql_one(
        "UNI-1", "order line is unique", "SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)",
        "SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)",
    )
    + " UNION ALL "
    + _sql_one(
        "UNI-2", "order key is unique", "SELECT count(DISTINCT o_orderkey) FROM orders",
        "SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)",
    ),
)
def unique_key(lake: Lake) -> DataFrame:
    return rounded(evaluate(_DECLARED, lake.tables(["lineitem", "orders"])))


@query(
    "not_null",
    _sql_one(
        "NN-1", "parsed key present", "SELECT count(*) FROM events",
        "SELECT count(*) FROM events WHERE nullif(event_type, 'error') IS NULL",
    ),
)
def not_null(lake: Lake) -> DataFrame:
    events = lake.events.withColumn("kind", F.expr("nullif(event_type, 'error')"))
    return rounded(evaluate([R.not_null("NN-1", "parsed key present", "events", "event_id", "kind")], {"events": events}))


@query(
    "in_domain",
    _sql_one(
        "DOM-1", "known event types", "SELECT count(*) FROM events",
        "SELECT count(*) FROM events WHERE event_type NOT IN ('click', 'view', 'purchase')",
    ),
)
def in_domain(lake: Lake) -> DataFrame:
    rule = R.in_domain("DOM-1", "known event types", "events", "event_id", "event_type", ["click", "view", "purchase"])
    return rounded(evaluate([rule], lake.tables(["events"])))


@query(
    "max_length",
    _sql_one(
        "LEN-1", "text at most 2000 characters", "SELECT count(*) FROM documents",
        "SELECT count(*) FROM documents WHERE length(text) > 2000",
    ),
)
def max_length(lake: Lake) -> DataFrame:
    rule = R.max_length("LEN-1", "text at most 2000 characters", "documents", "doc_id", "text", 2000)
    return rounded(evaluate([rule], lake.tables(["documents"])))


# ----------------------------------------------------------- ordered and keyed

_SQL_PEAKS = (
    "SELECT o_orderkey, o_custkey, o_totalprice FROM (SELECT *, max(o_totalprice) OVER (PARTITION BY o_custkey"
    " ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS peak FROM orders)"
    " WHERE peak IS NULL OR o_totalprice > peak"
)


@query("monotonic_fixpoint", _SQL_PEAKS)
def monotonic_fixpoint(lake: Lake) -> DataFrame:
    kept = strict_prefix_maxima(lake.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_totalprice")
    return kept.select("o_orderkey", "o_custkey", "o_totalprice")


# Five event types hold everything, so each is a hot group; NULLs are barriers.
_HOT = Skew(rows=400)


@query(
    "previous_in_hot_group",
    "SELECT event_id, lag(value) OVER (PARTITION BY event_type ORDER BY ts, event_id) AS previous FROM events",
)
def previous_in_hot_group(lake: Lake) -> DataFrame:
    out = with_previous(lake.events, ["event_type"], ["ts", "event_id"], "value", skew=_HOT)
    return out.select("event_id", "previous")


@query(
    "fixpoint_in_hot_group",
    "WITH v AS (SELECT event_id, event_type, ts, CASE WHEN event_id % 97 <> 0 THEN value END AS v FROM events),"
    " s AS (SELECT *, count(CASE WHEN v IS NULL THEN 1 END) OVER (PARTITION BY event_type ORDER BY ts, event_id"
    " ROWS UNBOUNDED PRECEDING) AS seg FROM v),"
    " p AS (SELECT *, max(v) OVER (PARTITION BY event_type, seg ORDER BY ts, event_id"
    " ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS peak FROM s)"
    " SELECT event_id, event_type, v FROM p WHERE v IS NULL OR peak IS NULL OR v > peak",
)
def fixpoint_in_hot_group(lake: Lake) -> DataFrame:
    events = lake.events.withColumn("v", F.expr("CASE WHEN event_id % 97 <> 0 THEN value END"))
    kept = strict_prefix_maxima(events, ["event_type"], ["ts", "event_id"], "v", _HOT)
    return kept.select("event_id", "event_type", "v")


# One hot group, ordered by columns of every kind. Each key orders as its SQL twin.
_KINDS = {
    "ntz": (
        "CAST(TIMESTAMP_NTZ '2024-03-09 20:00:00' + make_dt_interval(0, 0, CAST(event_id % 2000 AS INT)) AS TIMESTAMP_NTZ)",
        "event_id % 2000",
    ),
    "collated": ("CONCAT(IF(event_id % 2 = 0, 'Key', 'kEY'), LPAD(CAST(event_id % 997 AS STRING), 4, '0')) COLLATE UTF8_LCASE", "event_id % 997"),
    "prefixed": ("CONCAT('order-000000000000-', LPAD(CAST(event_id % 997 AS STRING), 6, '0'))", "event_id % 997"),
    "wide": ("4611686018427387904 + event_id % 997", "event_id % 997"),
    "flag": ("event_id % 3 = 0", "CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END"),
    "missing": ("IF(event_id % 5 = 0, NULL, event_id % 997)", "coalesce(CASE WHEN event_id % 5 <> 0 THEN event_id % 997 END, -1)"),
    "three": ("event_id % 7", "event_id % 7"),
}


def _ordered_sql() -> str:
    parts = [
        f"SELECT '{kind}' AS kind, event_id, lag(value) OVER (PARTITION BY event_id % 1 ORDER BY {twin}, "
        f"{'user_id % 11, ' if kind == 'three' else ''}event_id) AS previous FROM events"
        for kind, (_, twin) in _KINDS.items()
    ]
    return " UNION ALL ".join(parts)


@query("previous_by_any_order", _ordered_sql())
def previous_by_any_order(lake: Lake) -> DataFrame:
    """One group holds all rows; the order is a zoneless time, a collated or
    prefixed text, a 63-bit number, a flag, a column with NULLs, or three columns."""
    out = None
    # The kinds share their groups, and so one probe.
    hot = _HOT.probe(lake.events, ["event_id % 1"])
    skew = replace(_HOT, enabled=hot is not None, known=hot)
    for kind, (order, _) in _KINDS.items():
        rows = lake.events.select("event_id", "value", F.expr(order).alias("o"), F.expr("user_id % 11").alias("p"), F.expr("event_id % 1").alias("g"))
        columns = ["o", "p", "event_id"] if kind == "three" else ["o", "event_id"]
        found = with_previous(rows, ["g"], columns, "value", skew=skew).select(F.lit(kind).alias("kind"), "event_id", "previous")
        out = found if out is None else out.unionByName(found)
    return out


@query(
    "group_key_decode",
    "SELECT o_orderkey AS entity_id, 'DEC-1' AS code FROM (SELECT o_orderkey, o_totalprice, lag(o_totalprice) OVER"
    " (PARTITION BY CAST(floor((o_orderkey - 1) / 8) AS BIGINT) ORDER BY o_orderdate, o_orderkey) AS prev FROM orders)"
    " WHERE o_totalprice <= prev",
)
def group_key_decode(lake: Lake) -> DataFrame:
    # Groups are decoded from the key and hold at most 8 rows: no skew probe.
    orders = lake.orders.withColumn("block", block_of(F.col("o_orderkey"), 1, 8))
    bad = not_increasing(orders, ["block"], ["o_orderdate", "o_orderkey"], "o_totalprice", Skew(enabled=False))
    return bad.select(F.col("o_orderkey").alias("entity_id"), F.lit("DEC-1").alias("code"))


@query(
    "group_fingerprint",
    "WITH f AS (SELECT l_orderkey, count(*) AS n, string_agg(l_returnflag || ':' || l_linenumber, ','"
    " ORDER BY l_returnflag || ':' || l_linenumber) AS f FROM lineitem GROUP BY l_orderkey)"
    " SELECT min(l_orderkey) AS first_order, max(n) AS items, count(*) AS orders FROM f GROUP BY f",
)
def fingerprint(lake: Lake) -> DataFrame:
    """Orders grouped by equal sets of lines."""
    digest = group_fingerprint(lake.lineitem, "l_orderkey", ["l_returnflag", "l_linenumber"])
    same = digest.groupBy(*fingerprint_columns())
    return same.agg(
        F.min("l_orderkey").alias("first_order"), F.max("fp_n").alias("items"), F.count(F.lit(1)).alias("orders")
    ).select("first_order", "items", "orders")


@query(
    "fingerprint_groups",
    "WITH f AS (SELECT l_orderkey, string_agg(l_returnflag || ':' || l_linenumber, ','"
    " ORDER BY l_returnflag || ':' || l_linenumber) AS f FROM lineitem GROUP BY l_orderkey)"
    " SELECT o_orderkey, lag(o_totalprice) OVER (PARTITION BY o_orderstatus, o_orderpriority, f"
    " ORDER BY o_orderdate, o_orderkey) AS previous FROM orders JOIN f ON o_orderkey = l_orderkey",
)
def fingerprint_groups(lake: Lake) -> DataFrame:
    """Series of orders with the same status, priority and set of lines."""
    same = multiset_groups(lake.lineitem, "l_orderkey", ["l_returnflag", "l_linenumber"], "lines")
    joined = lake.orders.join(same, F.col("o_orderkey") == F.col("l_orderkey"))
    group = ["o_orderstatus", "o_orderpriority", "lines"]
    out = with_previous(joined, group, ["o_orderdate", "o_orderkey"], "o_totalprice", skew=_HOT)
    return out.select("o_orderkey", "previous")


# -------------------------------------------------------------------- filtering


@query("compliant_filter", f"{_SQL_SURVIVORS} SELECT * FROM survivors")
def compliant_filter(lake: Lake) -> DataFrame:
    kept = compliant_parent(ORDER_RULES, lake.tables(ORDER_TABLES), "orders", "o_orderkey")
    return kept.select("o_orderkey", "o_custkey", "o_totalprice")


@query(
    "compliant_children",
    f"{_SQL_SURVIVORS} SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_returnflag FROM lineitem"
    " WHERE l_orderkey IN (SELECT o_orderkey FROM survivors)",
)
def compliant_children(lake: Lake) -> DataFrame:
    tables = lake.tables(ORDER_TABLES)
    lines = tables["lineitem"].withColumnRenamed("l_orderkey", "o_orderkey")
    rules = [r for r in ORDER_RULES]
    kept = compliant_parent(rules, tables, "orders", "o_orderkey")
    children = restrict_children({"lineitem": lines}, runtime.pin(kept), "o_orderkey")["lineitem"]
    return children.select(
        F.col("o_orderkey").alias("l_orderkey"), "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag"
    )


@query(
    "compliant_tables",
    "WITH kept AS (SELECT * FROM orders WHERE NOT (o_totalprice < 5000 OR o_totalprice > 450000)),"
    " lines AS (SELECT l_orderkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM kept))"
    " SELECT 'orders' AS name, count(*) AS n FROM kept UNION ALL SELECT 'lineitem', count(*) FROM lines",
)
def compliant_tables(lake: Lake) -> DataFrame:
    """A parent and a child restricted together; the parent is staged once."""
    tables = {"orders": lake.orders, "lineitem": lake.lineitem.withColumnRenamed("l_orderkey", "o_orderkey")}
    out = filter_compliant([ROW_RULES[3]], tables, "orders", "o_orderkey", ["lineitem"])
    count = lambda n: out[n].agg(F.count(F.lit(1)).alias("n")).select(F.lit(n).alias("name"), "n")
    return count("orders").unionByName(count("lineitem"))


def _restricted_sql(kept: str) -> str:
    return f"SELECT l_orderkey AS o_orderkey, l_linenumber, l_extendedprice FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE {kept})"


@query("children_behind_bloom_filter", f"SELECT 'few kept' AS side, * FROM ({_restricted_sql('o_totalprice > 300000')}) UNION ALL SELECT 'few lost', * FROM ({_restricted_sql('o_totalprice < 300000')})")
def children_behind_bloom_filter(lake: Lake) -> DataFrame:
    """Lines of dear orders and of the others, with no broadcast of ids: a filter of the smaller side comes first."""
    lines = lake.lineitem.withColumnRenamed("l_orderkey", "o_orderkey").select("o_orderkey", "l_linenumber", "l_extendedprice")
    out = []
    for side, kept in (("few kept", "o_totalprice > 300000"), ("few lost", "o_totalprice < 300000")):
        rows = restrict_children({"lineitem": lines}, lake.orders.filter(kept), "o_orderkey", max_rows=0)["lineitem"]
        out.append(rows.select(F.lit(side).alias("side"), *rows.columns))
    return out[0].unionByName(out[1])


# -------------------------------------------------------------------- profiling


@query(
    "row_counts",
    "SELECT 'orders' AS name, count(*) AS cnt FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem",
)
def row_counts(lake: Lake) -> DataFrame:
    count = lambda n: profile.row_count(lake.table(n)).select(F.lit(n).alias("name"), "cnt")
    return count("orders").unionByName(count("lineitem"))


@query(
    "freq_share",
    "SELECT event_type, count(*) AS cnt, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM events), 2) AS pct"
    " FROM events GROUP BY event_type",
)
def freq_share(lake: Lake) -> DataFrame:
    return profile.freq_share(lake.events, "event_type")


@query(
    "freq_share_all",
    "SELECT l_suppkey, count(*) AS cnt, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM lineitem), 4) AS pct"
    " FROM lineitem GROUP BY l_suppkey",
)
def freq_share_all(lake: Lake) -> DataFrame:
    """Every one of the many categories, without a limit."""
    return profile.freq_share(lake.lineitem, "l_suppkey", digits=4)


@query(
    "freq_share_top",
    "SELECT l_suppkey, count(*) AS cnt, round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM lineitem), 2) AS pct"
    " FROM lineitem GROUP BY l_suppkey ORDER BY cnt DESC, l_suppkey LIMIT 20",
)
def freq_share_top(lake: Lake) -> DataFrame:
    return profile.freq_share(lake.lineitem, "l_suppkey", top=20)


@query(
    "group_size_hist",
    "SELECT group_size, count(*) AS cnt FROM (SELECT count(*) AS group_size FROM lineitem GROUP BY l_orderkey)"
    " GROUP BY group_size",
)
def group_size_hist(lake: Lake) -> DataFrame:
    return profile.group_size_histogram(lake.lineitem, "l_orderkey")


@query(
    "named_distribution",
    "SELECT coalesce(n_name, CAST(c_nationkey AS VARCHAR)) AS category, count(*) AS cnt,"
    " round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM customer), 2) AS pct FROM customer LEFT JOIN"
    " (SELECT * FROM nation WHERE n_regionkey < 3) ON c_nationkey = n_nationkey"
    " GROUP BY coalesce(n_name, CAST(c_nationkey AS VARCHAR))",
)
def named_distribution(lake: Lake) -> DataFrame:
    # An incomplete dictionary: the other nations fall back to their id.
    known = lake.nation.filter("n_regionkey < 3")
    return profile.named_distribution(lake.customer, "c_nationkey", known, "n_nationkey", "n_name")


@query(
    "numeric_summary",
    "SELECT round(min(c_acctbal), 6) AS min, round(max(c_acctbal), 6) AS max, round(avg(c_acctbal), 6) AS avg,"
    " round(quantile_disc(c_acctbal, 0.5), 6) AS median,"
    " round(avg(CASE WHEN c_acctbal > 0 THEN log10(c_acctbal) END), 6) AS avg_log10 FROM customer",
)
def numeric_summary(lake: Lake) -> DataFrame:
    return rounded(profile.numeric_summary(lake.customer, "c_acctbal", log10_mean=True))


@query(
    "profile_columns",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", round(min({c}), 4) AS min, round(max({c}), 4) AS max, round(avg({c}), 4) AS avg,"
        f" round(quantile_disc({c}, 0.5), 4) AS median FROM lineitem"
        for c in ("l_quantity", "l_extendedprice", "l_tax")
    ),
)
def profile_columns(lake: Lake) -> DataFrame:
    return rounded(profile.profile_columns(lake.lineitem, ["l_quantity", "l_extendedprice", "l_tax"]), 4)


@query(
    "windowed_top_category",
    "SELECT l_returnflag, round(avg(o_totalprice), 4) AS avg_value, round(avg(log10(o_totalprice)), 4) AS avg_log10,"
    " count(*) AS cnt FROM orders JOIN (SELECT l_orderkey, l_returnflag, row_number() OVER (PARTITION BY l_orderkey"
    " ORDER BY l_extendedprice DESC, l_returnflag) AS rn FROM lineitem) ON o_orderkey = l_orderkey AND rn = 1"
    " WHERE o_orderdate BETWEEN TIMESTAMP '1995-01-01' AND TIMESTAMP '1998-12-31' GROUP BY l_returnflag",
)
def windowed_top_category(lake: Lake) -> DataFrame:
    low, high = (F.lit(d).cast("timestamp_ntz") for d in ("1995-01-01", "1998-12-31"))
    return rounded(
        profile.windowed_top_category(
            lake.orders, "o_orderkey", "o_totalprice", ("o_orderdate", low, high),
            lake.lineitem, "l_orderkey", "l_returnflag", "l_extendedprice",
        ), 4,
    )


@query(
    "two_way_counts",
    "SELECT l_returnflag, l_linestatus, count(*) AS cnt FROM lineitem GROUP BY l_returnflag, l_linestatus",
)
def two_way_counts(lake: Lake) -> DataFrame:
    return profile.two_way_counts(lake.lineitem, "l_returnflag", "l_linestatus")


@query(
    "hot_keys",
    "SELECT event_type, n FROM (SELECT event_type, count(*) AS n, (SELECT count(*) FROM events) AS total FROM events"
    " GROUP BY event_type) WHERE n >= 0.1 * total",
)
def hot_keys(lake: Lake) -> DataFrame:
    """Keys with at least a tenth of all rows, as the probe for hot groups finds them."""
    events = lake.events
    least = max(1, -(-events.count() // 10))
    hot = runtime.hot_groups(events, ["event_type"], least).select("h")
    named = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).withColumn("h", F.xxhash64("event_type"))
    return named.join(runtime.checked_broadcast(hot), "h", "left_semi").filter(F.col("n") >= least).select("event_type", "n")
