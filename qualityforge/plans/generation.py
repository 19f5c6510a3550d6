"""Registered queries: keyed random columns and synthetic tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qualityforge.functions.keyed import Keyed
from qualityforge.functions.scalars import let
from qualityforge.operators import synth
from qualityforge.operators.fidelity import PROBS, Categorical, Numeric
from qualityforge.plans.lake import _sql_uniform
from qualityforge.plans.preset import _CAPS as _ELEMENT_CAPS
from qualityforge.plans.preset import _SQL_ALL, _SQL_BAD, _values
from qualityforge.plans.recipe_sql import recipe_sql
from qualityforge.plans.registry import Lake, query, rounded
from qualityforge.presets import zirconia as Z
from qualityforge.presets import zirconia_recipes as G

CUSTOMER = Keyed(("c_custkey",))
ORDER = Keyed(("o_orderkey",))
SEGMENTS = [("BRONZE", 5.0), ("SILVER", 3.0), ("GOLD", 1.5), ("PLATINUM", 0.5)]
GOODS = [("tea", 4.0), ("rice", 3.0), ("salt", 2.0), ("silk", 0.7), ("gold", 0.3)]


def _cu(stream: str, index: str = "0") -> str:
    return _sql_uniform(stream, "c_custkey", index)


def _ou(stream: str, index: str = "0") -> str:
    return _sql_uniform(stream, "o_orderkey", index)


def _sql_normal(u, stream: str, index: str = "0") -> str:
    r, a = u(stream + "/r", index), u(stream + "/a", index)
    return f"(sqrt(-2.0::DOUBLE * ln({r})) * cos(2.0::DOUBLE * pi() * {a}))"


def _part(index: int = 0, part: str = "j") -> str:
    """Index and part of a draw, as the hashed text has them."""
    return f"('{index}:' || {part})"


def _sql_uniforms(u, stream: str, n: int, index: int = 0) -> str:
    return f"list_transform(range(0, {n}), lambda j: {u(stream, _part(index))})"


def _sql_choice(u: str, items: list[tuple[str, float]]) -> str:
    total = sum(w for _, w in items)
    arms, acc = [], 0.0
    for name, w in items[:-1]:
        acc += w
        arms.append(f"WHEN {u} * {total}::DOUBLE <= {acc}::DOUBLE THEN '{name}'")
    return f"CASE {' '.join(arms)} ELSE '{items[-1][0]}' END"


@query("keyed_uniform", f"SELECT c_custkey, round({_cu('u')}, 9) AS a, round({_cu('u', '1')}, 9) AS b FROM customer")
def keyed_uniform(lake: Lake) -> DataFrame:
    return rounded(lake.customer.select("c_custkey", CUSTOMER.uniform("u").alias("a"), CUSTOMER.uniform("u", 1).alias("b")), 9)


@query("keyed_normal", f"SELECT c_custkey, round({_sql_normal(_cu, 'n')}, 6) AS z FROM customer")
def keyed_normal(lake: Lake) -> DataFrame:
    return rounded(lake.customer.select("c_custkey", CUSTOMER.normal("n").alias("z")))


@query(
    "keyed_gamma",
    f"SELECT c_custkey, round(-list_sum(list_transform({_sql_uniforms(_cu, 'g', 3)}, lambda x: ln(x))), 6) AS g FROM customer",
)
def keyed_gamma(lake: Lake) -> DataFrame:
    return rounded(lake.customer.select("c_custkey", CUSTOMER.gamma("g", 3).alias("g")))


@query("keyed_beta", f"SELECT c_custkey, round(list_sort({_sql_uniforms(_cu, 'b', 6)})[3], 6) AS x FROM customer")
def keyed_beta(lake: Lake) -> DataFrame:
    return rounded(lake.customer.select("c_custkey", CUSTOMER.beta("b", 3, 4).alias("x")))


def _sql_gamma(u, stream: str, shape: float, index: int = 0) -> str:
    """The first accepted proposal; a shape below one takes a power of a uniform besides."""
    if shape < 1:
        return f"({_sql_gamma(u, stream, shape + 1, index)} * pow({u(stream + '/s', str(index))}, {1 / shape!r}::DOUBLE))"
    d = shape - 1 / 3
    w = f"(1 + {1 / (9 * d) ** 0.5!r}::DOUBLE * t.x)"
    tries = f"list_transform(range(0, 24), lambda j: {{'x': {_sql_normal(u, stream + '/x', _part(index))}, 'lu': ln({u(stream + '/u', _part(index))})}})"
    accept = f"{w} > 0 AND t.lu < 0.5 * t.x * t.x + {d!r}::DOUBLE * (1 - {w} * {w} * {w} + 3 * ln(greatest({w}, 1e-300)))"
    return f"({d!r}::DOUBLE * pow(list_transform(list_filter({tries}, lambda t: {accept}), lambda t: {w})[1], 3))"


@query(
    "keyed_beta_real",
    f"SELECT c_custkey, round(x / (x + y), 6) AS x FROM (SELECT c_custkey, {_sql_gamma(_cu, 'br/a', 2.5)} AS x,"
    f" {_sql_gamma(_cu, 'br/b', 0.7)} AS y FROM customer)",
)
def keyed_beta_real(lake: Lake) -> DataFrame:
    """Non-integer shapes, by rejection over keyed proposals."""
    return rounded(lake.customer.select("c_custkey", CUSTOMER.beta("br", 2.5, 0.7).alias("x")))


@query(
    "keyed_wide",
    f"SELECT c_custkey, round(list_sort({_sql_uniforms(_cu, 'wide', 149, 0)})[70], 6) AS a,"
    f" round(list_sort({_sql_uniforms(_cu, 'wide', 149, 1)})[70], 6) AS b,"
    " list_sort(list_transform(range(0, 1100), lambda j: {'k': -ln(" + _cu("many", _part(0)) + "), 'v': j}))[1].v AS first FROM customer",
)
def keyed_wide(lake: Lake) -> DataFrame:
    """Draws of 149 uniforms and of 1,100 items: neighbouring indices share none."""
    items = F.transform(F.sequence(F.lit(0), F.lit(1099)), lambda j: F.struct(j.cast("long").alias("v"), F.lit(1.0).alias("w")))
    drawn = CUSTOMER.sample_without_replacement("many", items, "w", 1)
    a, b = (CUSTOMER.beta_int("wide", 70, 80, i) for i in (0, 1))
    customers = synth.spread(lake.customer.select("c_custkey"), "c_custkey")
    return rounded(customers.select("c_custkey", a.alias("a"), b.alias("b"), drawn[0]["v"].alias("first")))


@query("weighted_choice", f"SELECT c_custkey, {_sql_choice(_cu('seg'), SEGMENTS)} AS tier FROM customer")
def weighted_choice(lake: Lake) -> DataFrame:
    return lake.customer.select("c_custkey", CUSTOMER.choice("seg", SEGMENTS).alias("tier"))


_GOODS_SQL = ", ".join(f"{{'item': '{n}', 'w': {w}::DOUBLE}}" for n, w in GOODS)
_SAMPLE_SQL = (
    f"list_transform(list_sort(list_transform(range(0, {len(GOODS)}), lambda i: {{'k': -ln(@u) / ([{_GOODS_SQL}])[i + 1].w,"
    f" 'v': ([{_GOODS_SQL}])[i + 1].item}}))[1:3], lambda t: t.v)"
)


def _goods():
    return F.array(*[F.struct(F.lit(n).alias("item"), F.lit(w).alias("w")) for n, w in GOODS])


@query("sample_wor", f"SELECT c_custkey, array_to_string({_SAMPLE_SQL.replace('@u', _cu('wor', _part(0, 'i')))}, ',') AS items FROM customer")
def sample_wor(lake: Lake) -> DataFrame:
    drawn = CUSTOMER.sample_without_replacement("wor", _goods(), "w", 3)
    return lake.customer.select("c_custkey", F.array_join(F.transform(drawn, lambda x: x["item"]), ",").alias("items"))


_ITEM = "struct<item:string,amount:double,cap:double>"
_CAPS = [("a", 0.20), ("b", 0.12), ("c", 0.25), ("d", 0.05)]


@query(
    "running_budget",
    "SELECT c_custkey, item, round(amount, 4) AS amount FROM (SELECT c_custkey, unnest(list_reduce(list_transform("
    f"range(0, {len(_CAPS)}), lambda i: {{'item': (['a', 'b', 'c', 'd'])[i + 1], 'amount': {_cu('budget', 'i')} * 0.3::DOUBLE,"
    " 'cap': ([0.20::DOUBLE, 0.12, 0.25, 0.05])[i + 1]}),"
    " lambda acc, x: CASE WHEN least(greatest(0.01, least(x.cap, x.amount)), 0.30 - acc.used) > 0.01 THEN {'used': acc.used +"
    " least(greatest(0.01, least(x.cap, x.amount)), 0.30 - acc.used), 'kept': list_append(acc.kept, {'item': x.item,"
    " 'amount': floor(least(greatest(0.01, least(x.cap, x.amount)), 0.30 - acc.used) * 10000 + 0.5) / 10000})} ELSE acc END,"
    " {'used': 0.0::DOUBLE, 'kept': []::STRUCT(item VARCHAR, amount DOUBLE)[]}).kept, recursive := true) FROM customer)",
)
def running_budget(lake: Lake) -> DataFrame:
    drawn = F.array(
        *[
            F.struct(
                F.lit(n).alias("item"), (CUSTOMER.uniform("budget", i) * 0.3).alias("amount"), F.lit(c).alias("cap")
            )
            for i, (n, c) in enumerate(_CAPS)
        ]
    )
    kept = synth.running_budget(F.col("drawn"), "amount", "cap", 0.01, 0.30, 4, _ITEM)
    return rounded(
        lake.customer.select("c_custkey", drawn.alias("drawn")).select("c_custkey", F.inline(kept)).drop("cap"), 4
    )


_SERIES_SQL = f"list_transform(range(0, 6), lambda i: 0.4::DOUBLE + i * 0.1::DOUBLE + ({_ou('noise', 'i')} - 0.5) * 0.5::DOUBLE)"


@query(
    "monotone_repair",
    "SELECT o_orderkey, pos, round(v, 6) AS v FROM (SELECT o_orderkey, unnest(s) AS v, unnest(range(0, 6)) AS pos FROM"
    f" (SELECT o_orderkey, list_reduce({_SERIES_SQL}, lambda acc, x: CASE WHEN len(acc) = 0 THEN [x]"
    " ELSE list_append(acc, CASE WHEN x <= acc[len(acc)] THEN least(acc[len(acc)] * 1.05::DOUBLE, 1.0) ELSE x END) END,"
    " []::DOUBLE[]) AS s FROM orders))",
)
def monotone_repair(lake: Lake) -> DataFrame:
    series = F.transform(
        F.sequence(F.lit(0), F.lit(5)), lambda i: 0.4 + i * 0.1 + (ORDER.uniform("noise", i) - 0.5) * 0.5
    )
    fixed = synth.monotone_repair(F.col("s"), lambda i: F.lit(1.05), 1.0)
    orders = synth.spread(lake.orders.select("o_orderkey"), "o_orderkey")
    out = orders.select("o_orderkey", series.alias("s")).select("o_orderkey", F.posexplode(fixed).alias("pos", "v"))
    return rounded(out.withColumn("pos", F.col("pos").cast("long")))


@query(
    "mixture_value",
    f"SELECT o_orderkey, round(CASE WHEN {_ou('mix/mode')} < 0.7 THEN CASE WHEN len(c) > 0 THEN"
    f" c[CAST(floor({_ou('mix/pick')} * len(c)) AS INT) + 1] ELSE lo + {_ou('mix/free')} * (hi - lo) END"
    f" ELSE floor((lo + {_ou('mix/free')} * (hi - lo)) / 10 + 0.5) * 10 END, 6) AS v FROM (SELECT o_orderkey, lo, hi,"
    " list_filter([100.0::DOUBLE, 250, 400, 550], lambda x: x BETWEEN lo AND hi) AS c FROM (SELECT o_orderkey,"
    " CASE o_orderstatus WHEN 'F' THEN 90.0::DOUBLE WHEN 'O' THEN 200 ELSE 410 END AS lo,"
    " CASE o_orderstatus WHEN 'F' THEN 300.0::DOUBLE WHEN 'O' THEN 600 ELSE 500 END AS hi FROM orders))",
)
def mixture_value(lake: Lake) -> DataFrame:
    ranged = synth.range_lookup(lake.orders, "o_orderstatus", {"F": (90, 300), "O": (200, 600)}, (410, 500), ["lo", "hi"])
    v = synth.mixture_value(ORDER, "mix", [100, 250, 400, 550], F.col("lo"), F.col("hi"), 0.7, 10)
    return rounded(ranged.select("o_orderkey", v.alias("v")))


@query(
    "range_lookup",
    "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 90.0::DOUBLE WHEN 'O' THEN 200 ELSE 410 END AS lo,"
    " CASE o_orderstatus WHEN 'F' THEN 300.0::DOUBLE WHEN 'O' THEN 600 ELSE 500 END AS hi FROM orders",
)
def range_lookup(lake: Lake) -> DataFrame:
    ranges = {"F": (90, 300), "O": (200, 600)}
    out = synth.range_lookup(lake.orders, "o_orderstatus", ranges, (410, 500), ["lo", "hi"])
    return out.select("o_orderkey", "lo", "hi")


@query(
    "retry_until",
    f"SELECT c_custkey, round(coalesce(list_filter(list_transform(range(0, 8), lambda i: {_cu('try', 'i')}),"
    " lambda x: x > 0.7)[1], -1.0), 6) AS v FROM customer",
)
def retry_until(lake: Lake) -> DataFrame:
    v = synth.retry_until(lambda i: CUSTOMER.uniform("try", i), lambda x: x > 0.7, 8, F.lit(-1.0), "double")
    return rounded(lake.customer.select("c_custkey", v.alias("v")))


_POINT_SQL = (
    "CAST(floor(greatest(300.0::DOUBLE, least(1400.0::DOUBLE, greatest(300.0::DOUBLE, center - floor((n - 1) / 2.0::DOUBLE * gap))"
    f" + i * gap + {_sql_normal(_ou, 'pts/jitter', 'i')} * 5)) + 0.5) AS DOUBLE)"
)


@query(
    "series_expand",
    "SELECT o_orderkey, unnest(CASE WHEN len(s) < 2 THEN list_transform(range(0, n), lambda i:"
    " least(1400.0::DOUBLE, greatest(300.0::DOUBLE, center - 150) + i * 75.0::DOUBLE)) ELSE s END) AS t FROM (SELECT o_orderkey, n, center,"
    f" list_sort(list_distinct(list_transform(range(0, n), lambda i: {_POINT_SQL}))) AS s FROM (SELECT o_orderkey,"
    f" 3 + o_orderkey % 6 AS n, 300.0::DOUBLE + o_orderkey % 800 AS center, 50.0::DOUBLE + {_ou('pts/gap')} * 50.0::DOUBLE AS gap FROM orders))",
)
def series_expand(lake: Lake) -> DataFrame:
    n = (3 + F.col("o_orderkey") % 6).cast("int")
    center = 300.0 + (F.col("o_orderkey") % 800).cast("double")
    pts = synth.ordered_points(ORDER, "pts", F.col("center"), F.col("n"), (50, 100), 5.0, 300, 1400, 150, 75)
    orders = synth.spread(lake.orders.select("o_orderkey"), "o_orderkey")
    staged = orders.select("o_orderkey", n.alias("n"), center.alias("center"))
    return staged.select("o_orderkey", F.explode(pts).alias("t"))


@query(
    "argmax_item",
    "SELECT c_custkey, list_reduce(list_transform(range(0, 5), lambda i: {'i': i, 'v': floor("
    f"{_cu('arg', 'i')} * 4)}}), lambda a, x: CASE WHEN x.v > a.v THEN x ELSE a END).i AS best,"
    f" CAST(list_sum(list_transform(range(0, 5), lambda i: floor({_cu('arg', 'i')} * 4))) AS DOUBLE) AS total FROM customer",
)
def argmax_item(lake: Lake) -> DataFrame:
    """First position of the largest of five small draws, and their sum."""
    items = F.transform(
        F.sequence(F.lit(0), F.lit(4)),
        lambda i: F.struct(i.cast("long").alias("i"), F.floor(CUSTOMER.uniform("arg", i) * 4).cast("double").alias("v")),
    )
    staged = lake.customer.select("c_custkey", items.alias("items"))
    best = synth.argmax_item(F.col("items"), "v")
    return staged.select("c_custkey", best["i"].alias("best"), synth.total_of(F.col("items"), "v").alias("total"))


@query(
    "forbidden_repair",
    "WITH a AS (SELECT o_orderkey, o_totalprice, 1 + CAST(floor("
    f"{_ou('major')} * 3) AS INT) AS m, 1 + CAST(floor({_ou('count')} * 2) AS INT) AS n FROM orders),"
    " b AS (SELECT *, CASE WHEN n = 1 THEN [m] ELSE [m, list_filter([1, 2, 3, 4], lambda x: x <> m)"
    f"[CAST(floor({_ou('other')} * 3) AS INT) + 1]] END AS ids FROM a)"
    " SELECT o_orderkey, array_to_string(CASE WHEN len(ids) = 1 AND m = 1 AND o_totalprice < 100000 THEN [2]"
    " WHEN len(ids) = 1 AND m = 3 AND o_totalprice > 300000 THEN [1] ELSE ids END, ',') AS ids FROM b",
)
def forbidden_repair(lake: Lake) -> DataFrame:
    """A dependent second choice, then repair of forbidden single choices."""
    a = lake.orders.select(
        "o_orderkey", "o_totalprice", (1 + ORDER.pick("major", 3)).alias("m"), (1 + ORDER.pick("count", 2)).alias("n")
    )
    second = synth.other_candidate(ORDER, "other", [1, 2, 3, 4], F.array("m"))
    b = a.withColumn("ids", F.array_compact(F.array(F.col("m"), F.when(F.col("n") == 2, second))))
    alone = F.size("ids") == 1
    ids = (
        F.when(alone & (F.col("m") == 1) & (F.col("o_totalprice") < 100000), F.array(F.lit(2)))
        .when(alone & (F.col("m") == 3) & (F.col("o_totalprice") > 300000), F.array(F.lit(1)))
        .otherwise(F.col("ids"))
    )
    return b.select("o_orderkey", F.array_join(ids.cast("array<string>"), ",").alias("ids"))


@query(
    "conditional_choice",
    f"SELECT o_orderkey, CASE WHEN o_totalprice >= 300000 THEN {_sql_choice(_ou('cc'), SEGMENTS)}"
    f" WHEN o_orderstatus = 'F' THEN {_sql_choice(_ou('cc'), GOODS)} ELSE 'none' END AS pick FROM orders",
)
def conditional_choice(lake: Lake) -> DataFrame:
    """The weighted list depends on the row, the draw does not."""
    from qualityforge.functions.keyed import weighted_choice as pick

    staged = lake.orders.withColumn("u", ORDER.uniform("cc"))
    value = (
        F.when(F.col("o_totalprice") >= 300000, pick(F.col("u"), SEGMENTS))
        .when(F.col("o_orderstatus") == "F", pick(F.col("u"), GOODS))
        .otherwise("none")
    )
    return staged.select("o_orderkey", value.alias("pick"))


@query(
    "arrhenius_curve",
    "SELECT o_orderkey, i AS point, round(log10(CASE WHEN t >= 600 THEN k1 / (t + 273.15) * exp(-1.0::DOUBLE / (8.617333e-5 * (t + 273.15)))"
    " ELSE k1 * exp(0.15::DOUBLE / (8.617333e-5 * 873.15)) / (t + 273.15) * exp(-1.15::DOUBLE / (8.617333e-5 * (t + 273.15))) END), 8)"
    " AS log_value FROM (SELECT o_orderkey, i, 400.0::DOUBLE + i * 100 AS t, 10 ** (-o_totalprice / 100000)"
    " * 1073.15::DOUBLE * exp(1.0::DOUBLE / (8.617333e-5 * 1073.15)) AS k1 FROM orders, unnest(range(0, 6)) AS r(i))",
)
def arrhenius_curve(lake: Lake) -> DataFrame:
    """A two-segment curve, continuous at the boundary, along six points."""
    k1 = F.pow(F.lit(10.0), -F.col("o_totalprice") / 100000) * G.REFERENCE_K
    k1 = k1 * F.exp(F.lit(1.0) / (G.BOLTZMANN_EV * G.REFERENCE_K))
    staged = lake.orders.select("o_orderkey", k1.alias("k1"), F.explode(F.sequence(F.lit(0), F.lit(5))).alias("point"))
    t = 400.0 + F.col("point") * 100
    kelvin = t + 273.15
    low = F.col("k1") * F.exp(F.lit(0.15) / (G.BOLTZMANN_EV * G.SEGMENT_K))
    value = F.when(t >= 600, F.col("k1") / kelvin * F.exp(-1.0 / (G.BOLTZMANN_EV * kelvin))).otherwise(
        low / kelvin * F.exp(-1.15 / (G.BOLTZMANN_EV * kelvin))
    )
    return rounded(
        staged.select("o_orderkey", F.col("point").cast("long").alias("point"), F.log10(value).alias("log_value")), 8
    )


@query(
    "text_template",
    f"SELECT c_custkey, CASE WHEN {_cu('tpl')} < 0.55 THEN c_name || ' buys ' || array_to_string("
    f"{_SAMPLE_SQL.replace('@u', _cu('tw', _part(0, 'i')))}, ' and ') || '.' ELSE {_sql_choice(_cu('tier'), SEGMENTS)} || ' customer with '"
    " || ((CAST(round(abs(c_acctbal) * 100) AS BIGINT) + 5) // 100) || '.'"
    " || ((CAST(round(abs(c_acctbal) * 100) AS BIGINT) + 5) // 10 % 10) || ' on account.' END AS line FROM customer",
)
def text_template(lake: Lake) -> DataFrame:
    drawn = CUSTOMER.sample_without_replacement("tw", _goods(), "w", 3)
    names = F.transform(drawn, lambda x: x["item"])
    first = F.concat("c_name", F.lit(" buys "), F.array_join(names, " and "), F.lit("."))
    amount = F.format_string("%.1f", F.abs("c_acctbal"))
    second = F.concat(CUSTOMER.choice("tier", SEGMENTS), F.lit(" customer with "), amount, F.lit(" on account."))
    return lake.customer.select("c_custkey", F.when(CUSTOMER.uniform("tpl") < 0.55, first).otherwise(second).alias("line"))


_FAN = (
    "SELECT o_orderkey, n, 10000001 + o_orderkey * 8 + i AS sample_id, i, v FROM (SELECT o_orderkey, n,"
    " unnest(range(0, n)) AS i, unnest(list_transform(range(0, n), lambda j: o_totalprice + j)) AS v FROM"
    " (SELECT o_orderkey, o_totalprice, 1 + o_orderkey % 5 AS n FROM orders))"
)


def _fanned(lake: Lake) -> dict[str, DataFrame]:
    n = 1 + F.col("o_orderkey") % 5
    idx = F.sequence(F.lit(0).cast("long"), n - 1)
    groups = lake.orders.select(
        "o_orderkey",
        F.transform(idx, lambda j: F.struct((F.col("o_totalprice") + j).alias("v"))).alias("points"),
        F.array(
            F.struct(F.col("o_orderstatus").alias("tag")), F.struct(F.col("o_orderpriority").alias("tag"))
        ).alias("tags"),
    )
    return synth.fan_out(groups, "o_orderkey", "points", {"tags": "tags"}, "sample_id", 10000001, 8)


@query("fan_out", f"SELECT sample_id, o_orderkey, round(v, 4) AS v FROM ({_FAN})")
def fan_out(lake: Lake) -> DataFrame:
    return rounded(_fanned(lake)["parent"], 4)


@query(
    "fan_out_children",
    f"SELECT f.sample_id, f.o_orderkey, unnest([o_orderstatus, o_orderpriority]) AS tag FROM ({_FAN}) f JOIN orders o"
    " ON f.o_orderkey = o.o_orderkey",
)
def fan_out_children(lake: Lake) -> DataFrame:
    return _fanned(lake)["tags"]


# -------------------------------------------------------- the preset, one recipe
# group per order


def _groups(lake: Lake, source: str = "md5", seed: int = 12345) -> DataFrame:
    """Recipe groups from the source that SQL can recompute; bulk generation uses the faster one."""
    ids = synth.spread(lake.orders.select(F.col("o_orderkey").alias("recipe_group_id")), "recipe_group_id")
    return G.recipe_groups(ids, seed=seed, source=source)


_RECIPES = f"WITH {recipe_sql(12345)}"


@query("generate_samples", f"{_RECIPES} SELECT * REPLACE (round(conductivity, 9) AS conductivity) FROM material_samples")
def generate_samples(lake: Lake) -> DataFrame:
    return rounded(G.expand(_groups(lake))[Z.PARENT], 9)


@query("generate_dopants", f"{_RECIPES} SELECT * FROM sample_dopants")
def generate_dopants(lake: Lake) -> DataFrame:
    return G.expand(_groups(lake))["sample_dopants"]


@query("generate_sintering", f"{_RECIPES} SELECT * FROM sintering_steps")
def generate_sintering(lake: Lake) -> DataFrame:
    return G.expand(_groups(lake))["sintering_steps"]


@query("generate_phases", f"{_RECIPES} SELECT * FROM sample_crystal_phases")
def generate_phases(lake: Lake) -> DataFrame:
    return G.expand(_groups(lake))["sample_crystal_phases"]


# The recipe stage with the engine-neutral source can be recomputed in SQL.
@query(
    "generate_recipes",
    "SELECT o_orderkey AS recipe_group_id, list_position(["
    + ", ".join(f"'{m}'" for m in Z.SYNTHESIS_METHODS)
    + f"], {_sql_choice(_sql_uniform('method', 'o_orderkey', seed=12345), G.METHOD_SHARES)}) AS synthesis_method_id, list_position(["
    + ", ".join(f"'{r}'" for r in Z.PROCESSING_ROUTES)
    + f"], {_sql_choice(_sql_uniform('route', 'o_orderkey', seed=12345), G.ROUTE_SHARES)}) AS processing_route_id FROM orders",
)
def generate_recipes(lake: Lake) -> DataFrame:
    return _groups(lake).select("recipe_group_id", "synthesis_method_id", "processing_route_id")


def _generated(lake: Lake, seed: int = 12345) -> dict[str, DataFrame]:
    """Generated facts staged once in the shared folder, plus dictionaries."""
    from qualityforge import runtime

    path = runtime.scratch_path(lake.spark, "generated")
    _groups(lake, seed=seed).write.parquet(path)
    return {**G.expand(lake.spark.read.parquet(path)), **Z.dictionaries(lake.spark)}


_DICTIONARIES = (
    f"synthesis_method_dict AS {_values(list(enumerate(Z.SYNTHESIS_METHODS, 1)), 'id, name')}, processing_route_dict AS"
    f" {_values(list(enumerate(Z.PROCESSING_ROUTES, 1)), 'id, name')}, crystal_structure_dict AS {_values(Z.CRYSTAL_STRUCTURES, 'id, code, full_name')}"
)


def _sql_checked(ctes: str) -> str:
    """Report rows of the hard constraints on the tables of ``ctes``."""
    parts = [
        f"SELECT '{r.code}' AS constraint_code, '{r.name}' AS constraint_name, ({_SQL_ALL[r.code]}) AS total_checked, ({_SQL_BAD[r.code]}) AS violation_count"
        for r in Z.hard_constraints()
    ]
    return (
        f"{ctes}, {_DICTIONARIES} SELECT constraint_code, constraint_name, violation_count = 0 AS passed, total_checked, violation_count,"
        " round((total_checked - violation_count) * 100.0::DOUBLE / total_checked, 6) AS pass_rate,"
        f" CASE WHEN violation_count = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM ({' UNION ALL '.join(parts)})"
    )


@query("generate_report", _sql_checked(_RECIPES))
def generate_report(lake: Lake) -> DataFrame:
    """Hard constraints on the generated tables."""
    return rounded(Z.validate(_generated(lake)))


# Samples that break no rule, then the strict rises of what is left of each group.
_SURVIVORS = (
    f"WITH {recipe_sql(12345, 'raw_')}, tops AS (SELECT sample_id, round(sum(dopant_molar_fraction), 6) AS total, sum(CASE WHEN dopant_valence IN (2, 3) THEN 1 ELSE 0 END) AS low,"
    f" count(*) FILTER (dopant_molar_fraction <= 0 OR {_ELEMENT_CAPS}) AS bad FROM raw_sample_dopants GROUP BY sample_id),"
    " shapes AS (SELECT sample_id, sum(is_major_phase::INT) AS majors, count(*) AS n, count(*) FILTER (crystal_id = 1 AND is_major_phase) AS cubic,"
    " count(*) FILTER (crystal_id = 3 AND is_major_phase) AS mono FROM raw_sample_crystal_phases GROUP BY sample_id),"
    " seen AS (SELECT *, lag(conductivity) OVER (PARTITION BY recipe_group_id ORDER BY operating_temperature, sample_id) AS prev FROM raw_material_samples),"
    f" sound AS (SELECT * FROM seen JOIN tops USING (sample_id) JOIN shapes USING (sample_id) WHERE bad = 0 AND low > 0 AND total <= {Z.TOTAL_FRACTION_LIMIT} AND majors = 1"
    f" AND NOT (n = 1 AND ((total < {Z.LOW_DOPING} AND cubic > 0) OR (total > {Z.HIGH_DOPING} AND mono > 0))) AND conductivity BETWEEN 1e-8 AND 1"
    " AND operating_temperature BETWEEN 300 AND 1400 AND (prev IS NULL OR conductivity > prev)),"
    " peaks AS (SELECT *, max(conductivity) OVER (PARTITION BY recipe_group_id ORDER BY operating_temperature, sample_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS peak FROM sound),"
    " material_samples AS (SELECT * FROM peaks WHERE peak IS NULL OR conductivity > peak),"
    + ", ".join(f" {t} AS (SELECT * FROM raw_{t} WHERE sample_id IN (SELECT sample_id FROM material_samples))" for t in Z.CHILDREN)
)


@query("generate_compliant", _sql_checked(_SURVIVORS))
def generate_compliant(lake: Lake) -> DataFrame:
    """Hard constraints again after the compliant filter: all pass, on the rows that stay."""
    tables = _generated(lake)
    return rounded(Z.validate({**tables, **Z.compliant(tables)}))


@query("generate_compliant_samples", f"{_SURVIVORS} SELECT sample_id, operating_temperature, round(conductivity, 9) AS conductivity FROM material_samples")
def generate_compliant_samples(lake: Lake) -> DataFrame:
    kept = Z.compliant(_generated(lake))[Z.PARENT]
    return rounded(kept.select("sample_id", "operating_temperature", "conductivity"), 9)


def _sql_fidelity() -> str:
    """Scores of the nine dimensions of two populations, by grouped counts, discrete quantiles and leading dopants."""
    dims = Z.fidelity_dimensions()
    both = lambda columns, table, where="true": " UNION ALL ".join(f"SELECT {columns}, {r} AS is_real FROM {p}{table} WHERE {where}" for p, r in (("r_", "true"), ("", "false")))
    scores = []
    for d in dims:
        if isinstance(d, Categorical):
            where = (d.where or "true").replace("CAST(is_major_phase AS INT) = 1", "is_major_phase")
            counted = f"SELECT c, count(*) FILTER (is_real) AS rn, count(*) FILTER (NOT is_real) AS gn FROM ({both(f'{d.expr} AS c', d.table, where)}) GROUP BY c"
            shares = f"SELECT rn::DOUBLE / sum(rn) OVER () AS p, gn::DOUBLE / sum(gn) OVER () AS q FROM ({counted})"
            term = lambda x: f"CASE WHEN {x} > 0 THEN 0.5 * {x} * ln({x} / ((p + q) / 2)) ELSE 0 END"
            scores.append(f"SELECT '{d.name}' AS dimension, 1 - sum({term('p')} + {term('q')}) / ln(2) AS score FROM ({shares})")
        elif isinstance(d, Numeric):
            stats = (
                f"SELECT is_real, avg(v) AS mean, coalesce(stddev_samp(v), 1) AS std, min(v) AS lo, max(v) AS hi, quantile_disc(v, {list(PROBS)}) AS qs"
                f" FROM ({both(f'{d.expr} AS v', d.table, d.where or 'true')}) GROUP BY is_real"
            )
            near = lambda x: f"(1 - least({x} * 3, 1))"
            rmse = "sqrt(list_sum(list_transform(range(1, 8), lambda i: ((g.qs[i] - r.qs[i]) / greatest(abs(r.hi - r.lo), 1e-10)) ** 2)) / 7)"
            mean = "abs(g.mean - r.mean) / greatest(abs(r.hi - r.lo), 1e-10)"
            ratio = "CASE WHEN r.std > 1e-10 THEN least(r.std, g.std) / greatest(r.std, g.std) ELSE 1 END"
            scores.append(f"SELECT '{d.name}', greatest(0, 0.6 * {near(rmse)} + 0.2 * {near(mean)} + 0.2 * {ratio}) FROM ({stats}) r JOIN ({stats}) g ON r.is_real AND NOT g.is_real")
        else:
            means = lambda p: (
                f"SELECT {d.category} AS e, avg(log10({d.value})) AS m FROM {p}{d.parent} JOIN (SELECT sample_id, {d.category}, row_number() OVER (PARTITION BY sample_id"
                f" ORDER BY {d.rank} DESC, {d.category}) AS rn FROM {p}{d.child}) USING (sample_id) WHERE rn = 1 AND {d.window_column} BETWEEN {d.low} AND {d.high} AND {d.value} > 0"
                f" GROUP BY {d.category} HAVING count(*) >= {d.min_support}"
            )
            pairs = f"SELECT r.m AS x, g.m AS y FROM ({means('r_')}) r JOIN ({means('')}) g USING (e)"
            scores.append(
                f"SELECT '{d.name}', 0.5 * greatest(0, (corr(x, y) + 1) / 2) + 0.5 * greatest(0, 1 - 2 * sqrt(avg((x - y) ** 2)) / greatest(max(x) - min(x), 1)) FROM ({pairs})"
            )
    weights = " UNION ALL ".join(f"SELECT '{d.name}' AS dimension, {float(d.weight)!r}::DOUBLE AS weight" for d in dims)
    grade = "CASE WHEN score >= 0.90 THEN 'EXCELLENT' WHEN score >= 0.75 THEN 'GOOD' WHEN score >= 0.60 THEN 'FAIR' ELSE 'POOR' END"
    return (
        f"WITH {recipe_sql(12345, 'r_')}, {recipe_sql(777)} SELECT dimension, round(score, 8) AS score, weight, round(score * weight, 8) AS weighted_score, {grade} AS grade"
        f" FROM ({' UNION ALL '.join(scores)}) JOIN ({weights}) USING (dimension)"
    )


@query("generate_fidelity", _sql_fidelity())
def generate_fidelity(lake: Lake) -> DataFrame:
    """Two generated populations with different seeds score near one."""
    return rounded(Z.fidelity(_generated(lake), _generated(lake, 777)).summary, 8)
