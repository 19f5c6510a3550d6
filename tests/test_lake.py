"""Sources, sinks, sampling and normalising."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from test_compliant import random_tables

from qualityforge import runtime
from qualityforge.operators import normalize, sampling
from qualityforge.plans.run import RunOptions, run_stages
from qualityforge.presets import zirconia as Z
from qualityforge.sources import reports, sync
from qualityforge.sources import tables as tab


def test_table_path_and_quote():
    assert tab.table_path("/a/b//", "db", "t") == "/a/b/db/t"
    assert tab.table_path(" ", "t") == "./t"
    assert tab.table_path(None, "t") == "./t"
    assert tab.quote("o'x") == "o\\'x"


def test_jdbc_options():
    src = sync.JdbcSource("jdbc:x", {"user": "u"}, {"facts": ("id", 1, 1000)}, 16)
    assert src.options("dict") == {"user": "u", "url": "jdbc:x", "dbtable": "dict"}
    opts = src.options("facts")
    assert opts["partitionColumn"] == "id" and opts["numPartitions"] == "16" and opts["upperBound"] == "1000"


def test_sync(spark, tmp_path):
    src, out = str(tmp_path / "src"), str(tmp_path / "out")
    tab.write_tables(Z.dictionaries(spark), src)
    status = sync.sync_tables(spark, sync.ParquetSource(src), Z.DICTIONARIES, out)
    assert [tuple(r) for r in status.collect()] == [
        ("synthesis_method_dict", 9, 9, True), ("processing_route_dict", 19, 19, True), ("crystal_structure_dict", 6, 6, True),
    ]
    with pytest.raises(Exception, match="no_such"):
        sync.sync_tables(spark, sync.ParquetSource(src), ["no_such"], out)


def test_optional_and_declared_schema(spark, tmp_path):
    base = str(tmp_path)
    wide = spark.createDataFrame([(1, "x", 2.5, 9)], "sample_id int, reference string, conductivity float, extra int")
    tab.write_tables({"t": wide}, base)
    assert tab.load_optional(spark, f"{base}/none") is None
    assert tab.load_optional(spark, "no_such_table") is None
    schema = T.StructType([T.StructField("sample_id", T.LongType()), T.StructField("conductivity", T.DoubleType())])
    df = tab.load(spark, f"{base}/t", schema)
    assert df.schema == schema and tuple(df.first()) == (1, 2.5)
    assert "extra" not in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(tab.load_tables(spark, base, ["t"], ["u"])) == ["t"]


def test_external_tables(spark, tmp_path):
    name, path = "qf_external_dict", str(tmp_path / "it's")
    tab.write_rows(spark, Z.CRYSTAL_STRUCTURES, Z.SCHEMAS["crystal_structure_dict"], path)
    tab.register_external(spark, name, Z.SCHEMAS["crystal_structure_dict"], path, replace=True)
    assert spark.table(name).filter("code = 'β'").first()["full_name"] == "Beta-phase"
    tab.save_external(spark.createDataFrame([(1, "n")], "id int, name string"), "qf_saved", str(tmp_path / "saved"))
    assert spark.read.parquet(str(tmp_path / "saved")).count() == spark.table("qf_saved").count() == 1
    for t in (name, "qf_saved"):
        spark.sql(f"DROP TABLE IF EXISTS {t}")


def test_reports_append_and_export(spark, tmp_path):
    base = str(tmp_path / "rep")
    tables = random_tables(spark, 7, 150)
    meta = reports.RunMeta("db", 150, 150, run_id=11)
    results = Z.validate(tables)
    assert reports.append_constraint_report(results, meta, base) == 11
    reports.append_constraint_report(results, reports.RunMeta("db", 150, 150, run_id=12), base)
    assert spark.read.parquet(base + "/hard_constraint_result").count() == 26
    reports.append_fidelity_report(Z.fidelity(tables, tables), reports.RunMeta("db", 150, 150, run_id=13), base)
    runs = {r["run_id"]: r for r in spark.read.parquet(base + "/validation_run").collect()}
    assert runs[11]["passed"] is False and runs[11]["overall_grade"] is None
    assert runs[13]["passed"] is None and runs[13]["overall_score"] == pytest.approx(1.0) and runs[13]["overall_grade"] == "EXCELLENT"
    assert spark.read.parquet(base + "/fidelity_numerical").count() == 4 * 14
    for name, schema in reports.REPORT_TABLES.items():
        assert reports.read_reports(spark, base, name).schema == schema
    # Exported as tab-separated text and read back with the declared types.
    out = str(tmp_path / "tsv")
    reports.read_reports(spark, base, "validation_run").coalesce(1).write.csv(out, sep="\t", header=True)
    back = reports.read_exported(spark, out, "validation_run")
    assert {r["run_id"]: r["overall_score"] for r in back.collect()} == {k: r["overall_score"] for k, r in runs.items()}


def test_runs_are_published_whole_or_not_at_all(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "rep")
    results = Z.validate(random_tables(spark, 3, 60))
    assert reports.read_reports(spark, base, "validation_run").count() == 0
    reports.append_constraint_report(results, reports.RunMeta("db", 60, 60, run_id=1), base)

    def rows(table):
        return [r["run_id"] for r in reports.read_reports(spark, base, table).select("run_id").distinct().orderBy("run_id").collect()]

    write, calls = reports._write, []

    def failing(df, path):
        calls.append(path)
        if len(calls) == 2:
            raise OSError("disk full")
        write(df, path)

    # The details are written, the run row is not: nothing of the run is seen.
    monkeypatch.setattr(reports, "_write", failing)
    with pytest.raises(OSError, match="disk full"):
        reports.append_constraint_report(results, reports.RunMeta("db", 60, 60, run_id=2), base)
    monkeypatch.setattr(reports, "_write", write)
    assert rows("hard_constraint_result") == rows("validation_run") == [1]
    assert spark.read.parquet(base + "/hard_constraint_result").count() == 26

    # Everything is written but not published.
    monkeypatch.setattr(reports._Attempt, "publish", lambda self: self.meta.run_id)
    reports.append_constraint_report(results, reports.RunMeta("db", 60, 60, run_id=2), base)
    monkeypatch.undo()
    assert rows("hard_constraint_result") == rows("validation_run") == [1]

    # A retry counts once, and a repeated run id replaces what it had.
    for _ in range(2):
        reports.append_constraint_report(results.limit(5), reports.RunMeta("db", 60, 60, run_id=2), base)
    assert rows("validation_run") == [1, 2] and reports.read_reports(spark, base, "validation_run").count() == 2
    assert reports.read_reports(spark, base, "hard_constraint_result").count() == 13 + 5


def test_run_stages(spark, tmp_path):
    tables = random_tables(spark, 8, 150)
    base = str(tmp_path)
    opts = RunOptions("db", base + "/rep", real=tables, compliant_path=base + "/ok", validate=True, fidelity=True, profile=True, sample_ratio=0.5)
    done = run_stages(tables, opts)
    assert set(done) == {"hard_constraint", "profile", "compliant_filter", "fidelity"}
    runs = reports.read_reports(spark, base + "/rep", "validation_run")
    assert runs.count() == 3 and runs.filter("sampled_count < total_count").count() == 3
    shown = reports.read_reports(spark, base + "/rep", reports.PROFILE_TABLE)
    totals = {r["item"]: r["value"] for r in shown.filter("statistic = 'rows'").collect()}
    assert totals["material_samples"] == runs.first()["sampled_count"]
    assert spark.read.parquet(base + "/ok/material_samples").count() > 0
    with pytest.raises(ValueError, match="ratio"):
        run_stages(tables, RunOptions("db", base, sample_ratio=1.5))
    # A failing stage is reported at the end; the others still run.
    with pytest.raises(RuntimeError, match="fidelity"):
        run_stages(tables, RunOptions("db", base + "/rep2", real={}, validate=True, fidelity=True))
    assert spark.read.parquet(base + "/rep2/hard_constraint_result").count() == 13


def test_samples(spark):
    parent = spark.range(0, 20000, 1, 4).withColumnRenamed("id", "k")
    child = parent.unionByName(parent).withColumn("v", F.lit(1)).unionByName(spark.createDataFrame([(-1, 1)], "k long, v int"))
    out = sampling.referential_sample({"p": parent, "c": child}, "p", "k", ["c"], 0.2, seed=4)
    n = out["p"].count()
    assert n == pytest.approx(4000, rel=0.06) and out["c"].count() == 2 * n
    again = sampling.key_hash_sample(parent.repartition(9), "k", 0.2, seed=4)
    assert again.count() == n and again.join(out["p"], "k", "left_anti").count() == 0
    assert sampling.key_hash_sample(parent, "k", 0.1, seed=4).join(out["p"], "k", "left_anti").count() == 0
    for bad in (0, 1.1, -1):
        with pytest.raises(ValueError):
            sampling.bernoulli_sample(parent, bad)


def test_normalise_flat_source(spark):
    flat = {
        "material_samples": spark.createDataFrame(
            [
                (1, "r", "m", "Sol–gel method", "dry pressing", 500.0, 0.1),
                (2, "r", "m", "no such method", None, 500.0, 0.1),
                (3, "r", "m", "glycine METHOD", "/", 500.0, 0.1),
            ],
            "sample_id int, reference string, material_source_and_purity string, synthesis_method string,"
            " processing_route string, operating_temperature float, conductivity double",
        ),
        "sample_dopants": spark.createDataFrame(
            [(7, 1, "Y", 101.9, 3, 0.1)],
            "id int, sample_id int, dopant_element string, dopant_ionic_radius double, dopant_valence int, dopant_molar_fraction double",
        ),
        "sintering_steps": spark.createDataFrame([(8, 1, 1, 1400.0, 60.0)], "id int, sample_id int, step_order int, sintering_temperature double, sintering_duration double"),
        "sample_crystal_phases": spark.createDataFrame([(1, 1, None)], "sample_id int, crystal_id int, is_major_phase boolean"),
    }
    dicts = Z.dictionaries(spark)
    out = Z.normalise_flat(flat, dicts)
    got = {r["sample_id"]: (r["synthesis_method_id"], r["processing_route_id"]) for r in out["material_samples"].collect()}
    assert got == {1: (8, 5), 2: (None, None), 3: (None, 1)}
    loose = Z.normalise_flat(flat, dicts, collation="UTF8_LCASE")["material_samples"]
    assert {r["sample_id"]: r["synthesis_method_id"] for r in loose.collect()} == {1: 8, 2: None, 3: 6}
    assert out["sample_dopants"].columns[0] == "id"
    assert out["sample_crystal_phases"].first()["is_major_phase"] is True


def test_dictionary_ids_are_dense_and_ordered(spark):
    names = [f"n{i % 997:04d}" for i in range(5000)] + [None]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(7)
    rows = normalize.build_dictionary(df, "name").orderBy("id").collect()
    assert [(r["id"], r["name"]) for r in rows] == list(enumerate(sorted({n for n in names if n}), 1))


def test_unbounded_dictionary_is_not_broadcast(spark):
    big = spark.range(0, 50, 1, 2).selectExpr("id", "concat('n', id) as name")
    assert runtime.fits_broadcast(big, 50) and not runtime.fits_broadcast(big, 49)


def test_shared_folder_is_the_configured_one(spark):
    path = runtime.shared_dir(spark)
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert configured in path
    assert runtime.scratch_path(spark, "x") != runtime.scratch_path(spark, "x")
