"""Hand-made rows for every rule, through the preset and the generic builders."""

from __future__ import annotations

import pytest

from qualityforge.operators import rules as R
from qualityforge.operators.constraints import check, evaluate, violation_ledger
from qualityforge.presets import zirconia as Z

B = Z.BASE_SAMPLE_ID


def zirconia(spark, samples=(), dopants=(), sintering=(), phases=(), dicts=True):
    """samples: (id, group, temperature, conductivity); dopants: (id, element,
    valence, fraction); sintering: (id,); phases: (id, crystal, major)."""
    s = [(i, "r", "t", 1, 5, t, c, g) for i, g, t, c in samples]
    tables = {
        "material_samples": spark.createDataFrame(
            s, "sample_id long, reference string, material_source_and_purity string, synthesis_method_id int,"
            " processing_route_id int, operating_temperature double, conductivity double, recipe_group_id long",
        ),
        "sample_dopants": spark.createDataFrame(
            [(i, e, 90.0, v, f) for i, e, v, f in dopants], Z.SCHEMAS["sample_dopants"]
        ),
        "sintering_steps": spark.createDataFrame(
            [(i, 1, 1400.0, 60.0) for (i,) in sintering], Z.SCHEMAS["sintering_steps"]
        ),
        "sample_crystal_phases": spark.createDataFrame(list(phases), Z.SCHEMAS["sample_crystal_phases"]),
    }
    return {**tables, **(Z.dictionaries(spark) if dicts else {})}


def counts(df):
    return {r["constraint_code"]: r["violation_count"] for r in df.collect()}


def test_row_rules(spark):
    samples = [
        (1, 1, 300.0, 1e-8), (2, 2, 1400.0, 1.0), (3, 3, 500.0, 0.0), (4, 4, 500.0, -1.0),
        (5, 5, 299.9, 1.1), (6, 6, None, None), (7, 7, 1400.1, 1e-9),
    ]
    dopants = [
        (1, "Sc", 3, 0.12), (2, "Sc", 3, 0.1201), (3, "Yb", 3, 0.9), (4, "Y", 3, 0.0), (5, "Ca", 2, None),
        (6, None, 3, 0.29), (7, "Ce", 2, 0.19),
    ]
    got = counts(Z.validate(zirconia(spark, samples, dopants)))
    assert got["HC-1"] == 2
    assert got["HC-9"] == 4  # 0, -1, 1.1, 1e-9
    assert got["HC-10"] == 2
    assert got["HC-2a"] == 1
    assert got["HC-2b"] == 2


def test_group_rules(spark):
    samples = [(i, i, 500.0, 0.1) for i in range(1, 10)]
    dopants = [
        (1, "Y", 3, 0.30), (2, "Y", 3, 0.3005), (3, "Y", 3, 0.3006), (4, "Ti", 4, 0.1), (4, "Nb", 5, 0.1),
        (5, "Ti", 4, 0.1), (5, "Ca", 2, 0.1),
    ]  # sample 6.. have no dopants and are invisible
    phases = [
        (1, 1, True), (2, 1, True), (2, 2, True), (3, 1, False), (4, 1, None), (5, 1, True), (5, 2, False),
    ]
    got = counts(Z.validate(zirconia(spark, samples, dopants, phases=phases)))
    assert got["HC-3"] == 1
    assert got["HC-4"] == 1
    assert got["HC-5"] == 2


def test_foreign_keys_and_denominators(spark):
    samples = [(1, 1, 500.0, 0.1), (2, 1, 600.0, 0.2)]
    dopants = [(1, "Y", 3, 0.1), (9, "Y", 3, 0.1), (9, "Y", 3, 0.1), (None, "Y", 3, 0.1)]
    rows = {r["constraint_code"]: r for r in Z.validate(zirconia(spark, samples, dopants, [(2,)])).collect()}
    assert rows["HC-6a"]["violation_count"] == 2  # key 9 once, NULL once
    assert rows["HC-6a"]["total_checked"] == 2  # distinct non-NULL keys
    assert rows["HC-6b"]["violation_count"] == 0
    assert rows["HC-6b"]["total_checked"] == 1
    assert rows["HC-6c"]["total_checked"] == 0
    assert rows["HC-6c"]["pass_rate"] == 100.0


def test_coupling(spark):
    low = [(1, "Y", 3, 0.0011), (1, "Sc", 3, 0.0337), (1, "Yb", 3, 0.0152)]  # nominal 0.05
    dopants = low + [(2, "Y", 3, 0.04), (3, "Y", 3, 0.04), (4, "Y", 3, 0.13), (5, "Y", 3, 0.12), (6, "Y", 3, 0.13)]
    phases = [
        (1, 1, True), (2, 1, True), (3, 1, True), (3, 2, False), (4, 3, True), (5, 3, True), (6, 3, False),
        (7, 1, True), (2, 99, False),
    ]
    samples = [(i, i, 500.0, 0.1) for i in range(1, 8)]
    tables = zirconia(spark, samples, dopants, phases=phases)
    # 2 (an unknown crystal id does not count as a phase) and 4.
    assert counts(Z.validate(tables))["HC-8"] == 2
    assert counts(Z.validate(tables, exact_double=True))["HC-8"] == 3
    ids = {r["entity_id"] for r in Z.validate_with_ledger(tables).ledger.filter("code = 'HC-8'").collect()}
    assert ids == {2, 4}


def test_missing_dictionary_is_an_error_not_a_stop(spark):
    tables = zirconia(spark, [(1, 1, 500.0, 0.1)], [(1, "Y", 3, 0.04)], phases=[(1, 1, True)], dicts=False)
    rows = {r["constraint_code"]: r for r in Z.validate(tables).collect()}
    assert len(rows) == 13
    assert (rows["HC-8"]["status"], rows["HC-8"]["passed"], rows["HC-8"]["pass_rate"]) == ("ERROR", False, 0.0)
    assert rows["HC-8"]["violation_count"] is None
    assert all(r["passed"] for c, r in rows.items() if c != "HC-8")
    assert Z.validate_with_ledger(tables).ledger.count() == 0  # the filter skips the rule


def test_empty_tables(spark):
    rows = Z.validate(zirconia(spark)).collect()
    assert [r["constraint_code"] for r in rows] == [
        "HC-1", "HC-2a", "HC-2b", "HC-3", "HC-4", "HC-5", "HC-6a", "HC-6b", "HC-6c", "HC-7", "HC-8", "HC-9", "HC-10",
    ]
    assert all(r["total_checked"] == 0 and r["pass_rate"] == 100.0 and r["passed"] for r in rows)


def test_group_key_resolution(spark):
    """Group column, then decoded ids, then the dopant fingerprint."""
    series = [(B + 0, 0, 500.0, 0.2), (B + 1, 0, 600.0, 0.1), (B + 8, 1, 500.0, 0.1)]
    dopants = [(i, "Y", 3, 0.1) for i, *_ in series]
    tables = zirconia(spark, series, dopants)
    _, rule, drop = Z.resolve_series(tables)
    assert rule.group == ("recipe_group_id",) and not drop

    bare = {**tables, "material_samples": tables["material_samples"].drop("recipe_group_id")}
    named = bare["material_samples"].replace({"r": Z.SYNTHETIC_REFERENCE}, subset=["reference"])
    decoded = {**bare, "material_samples": named}
    _, rule, _ = Z.resolve_series(decoded)
    assert " div " in rule.group[0]
    assert counts(Z.validate(decoded))["HC-7"] == 1

    # The marker is missing: same method, route and dopants make one series.
    _, rule, drop = Z.resolve_series(bare)
    assert rule.name.endswith("derived recipe group (temp up -> cond up)") and drop
    assert counts(Z.validate(bare))["HC-7"] == 2
    # One id below the base is enough to fall back.
    odd = named.unionByName(named.limit(1).replace({B: 5}, subset=["sample_id"]))
    _, rule, _ = Z.resolve_series({**bare, "material_samples": odd})
    assert rule.where == "__fp_n IS NOT NULL"


def test_fingerprint_ignores_order_and_keeps_multiplicity(spark):
    samples = [(i, 0, 500.0 + i, 1.0 - i * 0.1) for i in range(1, 5)]
    dopants = [
        (1, "Y", 3, 0.1), (1, "Sc", 3, 0.05), (2, "Sc", 3, 0.05), (2, "Y", 3, 0.1),
        (3, "Y", 3, 0.1), (3, "Y", 3, 0.1), (3, "Sc", 3, 0.05),
    ]
    tables = zirconia(spark, samples, dopants)
    tables["material_samples"] = tables["material_samples"].drop("recipe_group_id")
    ids = {r["entity_id"] for r in Z.validate_with_ledger(tables).ledger.filter("code = 'HC-7'").collect()}
    assert ids == {2}  # 1 and 2 match, 3 has one more Y, 4 has no dopants


def test_schema_constraints(spark):
    samples = [(1, 1, 500.0, 0.1), (1, 1, 600.0, 0.2), (2, 1, 700.0, 0.3)]
    dopants = [(1, "Yttriumoxide", 3, 0.1), (None, "Y", 3, 0.1)]
    phases = [(1, 1, True), (1, 1, False), (2, 77, True)]
    tables = zirconia(spark, samples, dopants, phases=phases)
    got = counts(evaluate(Z.schema_constraints(), tables))
    assert got["PK-samples"] == 1
    assert got["PK-phases"] == 1
    assert got["LEN-element"] == 1
    assert got["NN-sample_dopants"] == 1
    assert got["FK-crystal_id"] == 1
    assert got["FK-synthesis_method_id"] == 0


def test_ledger_lists_each_code_once(spark):
    df = spark.createDataFrame([(1, -1.0), (1, -2.0), (2, 5.0), (3, 50.0)], "k long, v double")
    rules = [
        R.row_predicate("A", "positive", "t", "k", "v <= 0"),
        R.row_range("B", "range", "t", "k", "v", 0.0, 10.0),
        R.group_sum_cap("C", "sum", "t", "k", "v", 10.0),
    ]
    report = check(rules, {"t": df})
    assert {tuple(r) for r in report.ledger.collect()} == {(1, "A"), (1, "B"), (3, "B"), (3, "C")}
    assert counts(report.results) == {"A": 2, "B": 3, "C": 1}
    assert violation_ledger([], {}).count() == 0


def test_domain_literals(spark):
    df = spark.createDataFrame([(1, "it's"), (2, "b\\"), (3, "c"), (4, None)], "k long, v string")
    rule = R.in_domain("D", "domain", "t", "k", "v", ["it's", "b\\"])
    assert counts(evaluate([rule], {"t": df})) == {"D": 1}


@pytest.mark.parametrize("kind", ["string", "int", "long"])
def test_key_types_may_differ(spark, kind):
    child = spark.createDataFrame([(1,), (2,), (3,)], "k int")
    parent = spark.createDataFrame([(1,), (2,)], "p long").selectExpr(f"cast(p as {kind}) as p")
    rule = R.foreign_key("F", "fk", "c", "k", "p", "p")
    assert counts(evaluate([rule], {"c": child, "p": parent})) == {"F": 1}


def test_multisets_are_told_apart_whatever_their_digests(spark):
    import random

    from pyspark.sql import functions as F

    from qualityforge.operators.normalize import group_fingerprint, multiset_groups

    rng = random.Random(3)
    held = {k: [(rng.choice("abc"), rng.randrange(2)) for _ in range(rng.randrange(4))] for k in range(120)}
    held[200], held[201] = [("x", 1)] * 500, [("x", 1)] * 500
    rows = [(k, e, n) for k, own in held.items() for e, n in own] + [(k, None, 1) for k in held] + [(None, "a", 1)]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "k bigint, e string, n int").repartition(5)
    want, first = {}, {}
    for k in sorted(held):
        want[k] = first.setdefault(tuple(sorted(held[k])), k)

    def one_digest(df, key, items):
        return df.groupBy(key).agg(F.lit(7).alias("d"))

    def by_size(df, key, items):
        return df.groupBy(key).agg((F.count("e") % 2).alias("d"))

    for digest in (group_fingerprint, by_size, one_digest):
        got = {r["k"]: r["same"] for r in multiset_groups(df, "k", ["e", "n"], "same", digest=digest).collect()}
        assert got == want


def test_a_failure_that_is_no_rules_fault_surfaces(spark, tmp_path):
    import os

    from pyspark.errors import PySparkException

    from qualityforge.operators.constraints import rule_fault

    path = str(tmp_path / "t")
    spark.range(100).selectExpr("id", "concat('n', id) AS text").repartition(4).write.parquet(path)
    df = spark.read.parquet(path)
    good = R.row_predicate("A", "ids are positive", "t", "id", "id < 1")
    bad = R.row_predicate("B", "texts are numbers", "t", "id", "CAST(text AS INT) < 0")
    assert [r["status"] for r in evaluate([good, bad], {"t": df}).collect()] == ["FAIL", "ERROR"]
    # The rule is right and a file has gone: no ERROR for it, nor for the other.
    gone = next(n for n in os.listdir(path) if n.startswith("part-"))
    os.remove(os.path.join(path, gone))
    with pytest.raises(Exception, match="FILE_NOT_EXIST") as caught:
        evaluate([good, bad], {"t": df})
    assert not (isinstance(caught.value, PySparkException) and rule_fault(caught.value))
