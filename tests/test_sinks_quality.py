import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from gridpulse.operators import quality
from gridpulse.sinks import tables

HIST = "State string, County string, FIPS string, SAIDI double, SAIFI double, Date date, state_code string"


def test_history_upsert_idempotent(spark, tmpdir_path):
    d1, d2 = dt.date(2025, 5, 1), dt.date(2025, 5, 2)
    rows = [("Georgia", "Fulton", "13121", 0.1, 0.2, d1, "ga"), ("Georgia", "Cobb", "13067", 0.3, 0.4, d1, "ga"),
            ("Georgia", "Fulton", "13121", 0.5, 0.6, d2, "ga")]
    path = os.path.join(tmpdir_path, "hist")
    df = spark.createDataFrame(rows, HIST)
    tables.upsert_history(df, path)
    tables.upsert_history(df, path)
    assert spark.read.parquet(path).count() == 3
    fix = spark.createDataFrame([("Georgia", "Fulton", "13121", 9.0, 9.0, d1, "ga")], HIST)
    tables.upsert_history(fix, path)
    got = tables.read_history(spark, path, "ga", 2025, 5).collect()
    assert [(r.County, r.Date, r.SAIDI) for r in got] == [("Fulton", d1, 9.0), ("Fulton", d2, 0.5)]


def test_replace_date_keeps_null_dates(spark):
    d1 = dt.date(2025, 5, 1)
    existing = spark.createDataFrame([("G", "A", "1", 1.0, 1.0, d1, "ga"), ("G", "B", "2", 1.0, 1.0, None, "ga")], HIST)
    new = spark.createDataFrame([("G", "A", "1", 5.0, 5.0, d1, "ga")], HIST)
    out = sorted((r.County, r.SAIDI) for r in tables.replace_date(existing, new).collect())
    assert out == [("A", 5.0), ("B", 1.0)]


def test_dashboard_write_summary(spark, tmpdir_path):
    d1, d2 = dt.date(2025, 5, 1), dt.date(2025, 5, 2)
    schema = "County string, FIPS string, SAIDI string, LOWER_SAIFI string, SAIFI string, UPPER_SAIFI string, State string, Date date, state_code string"
    rows = [("Fulton", "1", "0.1", "0.1", "0.1", "0.1", "Georgia", d1, "ga"),
            ("Fulton", "1", "0.2", "0.2", "0.2", "0.2", "Georgia", d2, "ga")]
    path = os.path.join(tmpdir_path, "dash")
    summary = tables.write_dashboard(spark.createDataFrame(rows, schema), path)
    assert summary["rows"] == 2 and summary["success"] and summary["columns"] == 8
    names = sorted(p.split("run=")[1].split("/", 1)[1] for p in tables.published_paths(spark, path))
    assert names == ["Date=2025-05-01/GA_DATA.csv", "Date=2025-05-02/GA_DATA.csv"]
    for p in tables.published_paths(spark, path):
        with open(p) as f:
            assert f.readline().strip() == ",".join(tables.DASHBOARD_COLUMNS)
    # a second run of one day replaces that day's file only
    tables.write_dashboard(spark.createDataFrame([(*rows[1][:2], "0.9", *rows[1][3:])], schema), path)
    back = sorted((r.Date, r.SAIDI, r.state_code) for r in tables.read_dashboard(spark, path).collect())
    assert back == [("2025-05-01", "0.1", "ga"), ("2025-05-02", "0.9", "ga")]


def test_a_dashboard_run_that_dies_leaves_the_old_files(spark, tmpdir_path, monkeypatch):
    schema = "County string, FIPS string, SAIDI string, LOWER_SAIFI string, SAIFI string, UPPER_SAIFI string, State string, Date date, state_code string"
    row = ("Fulton", "1", "0.1", "0.1", "0.1", "0.1", "Georgia", dt.date(2025, 5, 1), "ga")
    path = os.path.join(tmpdir_path, "dash")
    assert tables.read_dashboard(spark, path).count() == 0
    tables.write_dashboard(spark.createDataFrame([row], schema), path)
    for step in ("_name_files", "published"):
        monkeypatch.setattr(tables, step, lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            tables.write_dashboard(spark.createDataFrame([(*row[:2], "0.9", *row[3:])], schema), path)
        monkeypatch.undo()
        assert [r.SAIDI for r in tables.read_dashboard(spark, path).collect()] == ["0.1"]


def test_monthly_export(spark, tmpdir_path):
    from gridpulse.sources import lookups

    rows = [("Georgia", c, "1", 0.1, 0.2, dt.date(2025, m, d), "ga") for c in ("Fulton", "Cobb") for m, d in ((5, 2), (5, 1), (6, 1))]
    rows += [("Alabama", "Autauga", "2", 0.3, None, dt.date(2025, 5, 1), "al"), ("Georgia", "Hall", "3", 0.5, 0.5, None, "ga")]
    path = os.path.join(tmpdir_path, "monthly")
    assert tables.export_monthly(spark.createDataFrame(rows, HIST), path) == 7
    files = {p.split("run=")[1].split("/", 1)[1]: p for p in tables.published_paths(spark, path)}
    assert sorted(files) == ["AL/2025_05.csv", "GA/2025_05.csv", "GA/2025_06.csv"]
    with open(files["GA/2025_05.csv"]) as f:
        lines = f.read().splitlines()
    assert lines[0] == "State,County,FIPS,SAIDI,SAIFI,Date"
    assert [(x.split(",")[5], x.split(",")[1]) for x in lines[1:]] == [("2025-05-01", "Cobb"), ("2025-05-01", "Fulton"), ("2025-05-02", "Cobb"), ("2025-05-02", "Fulton")]
    back = lookups.read_monthly_history(spark, os.path.dirname(os.path.dirname(files["GA/2025_05.csv"])))
    assert back.count() == 7 and back.where("state_code = 'al'").first().County == "Autauga"


def test_dashboard_write_failure_raises(spark, tmpdir_path):
    blocked = os.path.join(tmpdir_path, "file")
    open(blocked, "w").close()
    schema = "County string, FIPS string, SAIDI string, LOWER_SAIFI string, SAIFI string, UPPER_SAIFI string, State string, Date date, state_code string"
    with pytest.raises(Exception):
        tables.write_dashboard(spark.createDataFrame([("F", "1", "0", "0", "0", "0", "G", dt.date(2025, 5, 1), "ga")], schema), blocked)


def test_compare_tolerance_rules(spark):
    b = spark.createDataFrame([("A", "0.1", "<0.0001"), ("B", "0.1", "0.5"), ("C", None, "x"), ("D", "1", "1")],
                              "County string, SAIDI string, SAIFI string")
    o = spark.createDataFrame([("A", "0.10009", "<0.0001"), ("B", "0.1002", "<0.0001"), ("C", None, None), ("E", "1", "1")],
                              "County string, SAIDI string, SAIFI string")
    out = sorted((r.County, r.Column) for r in quality.compare_results(b, o).collect())
    assert out == [("B", "SAIDI"), ("B", "SAIFI")]
    full = sorted((r.County, r.Column) for r in quality.compare_results(b, o, how="full").collect())
    assert ("D", "SAIDI") in full and ("E", "SAIFI") in full


def test_scenarios_are_paired_like_two_results(spark):
    rows = spark.createDataFrame([("A", "b", "1"), ("A", "c", "2"), ("B", "b", "1"), ("B", "c", "1"), ("C", "b", "5"), ("D", "c", None)], "County string, scenario string, SAIDI string")
    paired = quality.pair_scenarios(rows, "b", "c", ["County"], ["SAIDI"])
    got = sorted((r.County, r.Baseline, r.Optimized) for r in quality.mismatches(paired, ["County"], ["SAIDI"]).collect())
    assert got == [("A", "1", "2"), ("C", "5", None), ("D", None, None)]


def test_null_profile(spark):
    df = spark.createDataFrame([("p", "f1", None, "1"), ("p", "f2", "x", None), ("q", "f3", "y", "2")],
                               "emc string, source_file string, a string, b string")
    out = sorted((r.provider, r.column, r.total_rows, r.null_count) for r in quality.null_profile(df, "emc", ["a", "b"]).collect())
    assert out == [("p", "a", 2, 1), ("p", "b", 2, 1)]


def test_mapping_coverage_reports_percent_columns(spark):
    raw = spark.createDataFrame([("nc", "wake"), ("nc", "xx")], "state string, raw string")
    cmap = spark.createDataFrame([("nc", "wake", "wake"), ("nc", "durham", "zzz")], "state string, raw string, standard string")
    master = spark.createDataFrame([("nc", "wake"), ("nc", "durham")], "state string, county string")
    cols = spark.createDataFrame([("nc", "% out", "per_outage_customers_affected"), ("nc", "percent served", "customers_served"),
                                  ("nc", "# out", "per_outage_customers_affected")], "state string, raw string, standard string")
    out = sorted((r.issue, r.name) for r in quality.mapping_coverage(raw, cmap, master, cols).collect())
    assert out == [("mapped_not_master", "zzz"), ("master_never_hit", "durham"),
                   ("percent_mapped_to_count", "% out -> per_outage_customers_affected"),
                   ("percent_mapped_to_count", "percent served -> customers_served"), ("raw_unmapped", "xx")]
