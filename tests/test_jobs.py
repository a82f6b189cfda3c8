import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from gridpulse.plans import jobs
from gridpulse.sinks.tables import read_dashboard


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


@pytest.fixture()
def inputs(tmpdir_path):
    root = tmpdir_path
    _write(f"{root}/feeds/ga/a_per_county.csv",
           "timestamp,EMC,name,n_out,cust_s\n"
           "2025-05-01 10:00:00,e1,Fulton,10,100\n"
           "2025-05-01 10:15:00,e1,Fulton,4,100\n"
           "2025-05-01 11:14:00,e1,Fulton,9,100\n"
           "2025-05-01 12:14:00,e1,Fulton,7,100\n"
           "2025-05-02 09:00:00,e1,Fulton,2,100\n"
           "2025-05-01 09:00:00,e1,Nowhere,5,100\n")
    _write(f"{root}/maps/GA/col_map.csv", "raw,standard\nname,county\nn_out,per_outage_customers_affected\n"
                                          "cust_s,customers_served\ntimestamp,timestamp\n")
    _write(f"{root}/maps/GA/county_map.csv", "raw,standard,score\nfulton,fulton,100\ncobb,cobb,100\nhall,hall,100\n")
    _write(f"{root}/maps/GA/master_county_list.txt", "Fulton County\nCobb County\nHall County\n")
    _write(f"{root}/fips.csv", "state_abbr,state_name,county_name,fips\nGA,georgia,Fulton,13121\nGA,georgia,Cobb,13067\n")
    _write(f"{root}/served/GA_customers_served.csv",
           ",county,customers_served,timestamp\n0,cobb,300.7,01-15-2024 00:00:00\n1,cobb,200.6,01-15-2024 00:00:00\n")
    return jobs.Inputs(f"{root}/feeds", f"{root}/maps", f"{root}/fips.csv", f"{root}/served/*_customers_served.csv"), root


def test_job_daily_dashboard_and_history(spark, inputs):
    inp, root = inputs
    keys = jobs.run_keys_for(spark, ["GA"], ["2025-05-01"])
    res = jobs.job_daily(spark, inp, keys, out_root=f"{root}/out")
    assert res.write_summary["rows"] == 3 and res.write_summary["success"]
    dash = {r.County: r for r in read_dashboard(spark, f"{root}/out/dashboard").collect()}
    f = dash["Fulton"]
    assert (f.SAIDI, f.LOWER_SAIFI, f.SAIFI, f.UPPER_SAIFI) == ("0.075", "0.17", "0.195", "0.22")
    assert f.FIPS == "13121" and f.State == "Georgia" and str(f.Date) == "2025-05-01"
    # silent county with a served history: SAIFI is a true 0, shown as "<0.0001"; SAIDI missing -> "0.0"
    assert (dash["Cobb"].SAIDI, dash["Cobb"].SAIFI) == ("0.0", "<0.0001")
    # silent county without history, and no FIPS row
    assert (dash["Hall"].SAIDI, dash["Hall"].SAIFI, dash["Hall"].FIPS, dash["Hall"].State) == ("0.0", "0.0", None, None)
    hist = spark.read.parquet(f"{root}/out/history").collect()
    assert len(hist) == 3 and {r.County for r in hist} == {"Fulton", "Cobb", "Hall"}
    # re-running the same day is idempotent
    jobs.job_daily(spark, inp, keys, out_root=f"{root}/out")
    assert spark.read.parquet(f"{root}/out/history").count() == 3


def test_job_backfill_skips_empty_days(spark, inputs):
    inp, root = inputs
    res = jobs.job_backfill(spark, inp, ["ga"], "2025-05-01", "2025-05-03", out_root=f"{root}/bf")
    skipped = [(r.state, r.report_date) for r in res.skipped.collect()]
    assert skipped == [("ga", dt.date(2025, 5, 3))]
    hist = spark.read.parquet(f"{root}/bf/history")
    assert hist.count() == 6
    day2 = {r.County: r.SAIDI for r in hist.where("report_date = '2025-05-02'").collect()}
    assert day2["Fulton"] == pytest.approx(2 * 0.25 / 100)


def test_job_backfill_lists_a_failing_day_and_restarts(spark, inputs, monkeypatch):
    inp, root = inputs
    right = jobs.metric_daily

    def broken(reports, master, run_keys, served):
        d = right(reports, master, run_keys, served)
        bad = F.when(F.col("report_date") == "2025-05-02", F.raise_error(F.lit("bad day")).cast("double")).otherwise(F.col("saidi"))
        d.all_metrics = d.all_metrics.withColumn("saidi", bad)
        return d

    out = f"{root}/bf"
    monkeypatch.setattr(jobs, "metric_daily", broken)
    res = jobs.job_backfill(spark, inp, ["ga"], "2025-05-01", "2025-05-04", out_root=out)
    status = {r.report_date.day: (r.status, r.error) for r in jobs.backfill_ledger(spark, out).collect()}
    assert {d: s for d, (s, _) in status.items()} == {1: "done", 2: "failed", 3: "empty", 4: "empty"} and "bad day" in status[2][1]
    assert sorted((r.report_date.day, r.status) for r in res.skipped.collect()) == [(2, "failed"), (3, "empty"), (4, "empty")]
    assert {str(r.Date) for r in spark.read.parquet(f"{out}/history").collect()} == {"2025-05-01"}
    monkeypatch.undo()
    asked = []
    monkeypatch.setattr(jobs, "metric_daily", lambda reports, master, keys, served: asked.append({r.report_date.day for r in keys.collect()}) or right(reports, master, keys, served))
    res = jobs.job_backfill(spark, inp, ["ga"], "2025-05-01", "2025-05-04", out_root=out)
    assert asked == [{2}]  # what was done or empty is not done again
    assert {r.report_date.day: r.status for r in jobs.backfill_ledger(spark, out).collect()} == {1: "done", 2: "done", 3: "empty", 4: "empty"}
    assert spark.read.parquet(f"{out}/history").count() == 6 and res.history.count() == 6


def test_jobs_over_landed_feeds_give_the_same(spark, inputs):
    inp, root = inputs
    keys = jobs.run_keys_for(spark, ["GA"], ["2025-05-01", "2025-05-02"])
    landed = jobs.Inputs(inp.feeds_root, inp.mapping_root, inp.fips_path, inp.served_pattern, landing=f"{root}/landing")
    jobs.job_daily(spark, inp, keys, out_root=f"{root}/a")
    jobs.job_daily(spark, landed, keys, out_root=f"{root}/b")
    rows = [sorted(map(tuple, read_dashboard(spark, f"{root}/{x}/dashboard").collect()), key=str) for x in "ab"]
    assert rows[0] == rows[1] and len(rows[0]) == 6
    back = [jobs.job_backfill(spark, x, ["ga"], "2025-05-01", "2025-05-02", out_root=f"{root}/bf-{n}") for n, x in (("a", inp), ("b", landed))]
    assert len({tuple(sorted(map(tuple, r.history.collect()), key=str)) for r in back}) == 1
    # a saved result against another one
    assert jobs.job_compare(spark, f"{root}/a/dashboard", f"{root}/b/dashboard", how="full").count() == 0
    jobs.job_daily(spark, landed, jobs.run_keys_for(spark, ["GA"], ["2025-05-01"]), out_root=f"{root}/c")
    missing = jobs.job_compare(spark, f"{root}/a/dashboard", f"{root}/c/dashboard", how="full").collect()
    assert {r.Date for r in missing} == {"2025-05-02"} and len(missing) == 12
    assert jobs.job_compare(spark, f"{root}/a/dashboard", f"{root}/c/dashboard").count() == 0


def test_job_mapping_build(spark, inputs):
    inp, root = inputs
    cols, counties, cmap = jobs.job_mapping_build(spark, inp.feeds_root, inp.mapping_root)
    assert {r.column_name for r in cols.collect()} == {"timestamp", "emc", "name", "n_out", "cust_s"}
    got = {r.raw: r.standard for r in cmap.collect()}
    assert got == {"fulton": "fulton"}          # "nowhere" scores below 85 against every master name
