import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridpulse.functions.numeric import display_metric, half_even_round
from gridpulse.operators.events import county_served_totals
from gridpulse.plans.daily import metric_daily

SCHEMA = ("state string, report_date date, county string, emc string, ts timestamp_ntz, "
          "affected double, customers_served double, source_file string, row_id long")
D = dt.date(2025, 5, 1)


def _r(county, hhmm, aff, emc="e1", served=100.0, rid=0):
    h, m = map(int, hhmm.split(":"))
    return ("ga", D, county, emc, dt.datetime(2025, 5, 1, h, m), float(aff), served, "f", rid)


@pytest.fixture()
def daily(spark):
    rows = [_r("fulton", "10:00", 10, rid=1), _r("fulton", "10:15", 4, rid=2),
            _r("fulton", "11:14", 9, rid=3), _r("fulton", "12:14", 7, rid=4)]
    reports = spark.createDataFrame(rows, SCHEMA)
    master = spark.createDataFrame([("ga", "fulton"), ("ga", "cobb"), ("ga", "hall")], "state string, county string")
    keys = spark.createDataFrame([("ga", D)], "state string, report_date date")
    hist = spark.createDataFrame([("ga", "cobb", 300.7), ("ga", "cobb", 200.6)], "state string, county string, customers_served double")
    return metric_daily(reports, master, keys, hist)


def test_fixture_metrics(daily):
    m = {r.county: r for r in daily.metrics.collect()}
    f = m["fulton"]
    assert f.saidi == pytest.approx(0.075)
    assert f.lower_saifi == pytest.approx(0.17)
    assert f.middle_saifi == pytest.approx(0.195)
    assert f.upper_saifi == pytest.approx(0.22)
    # filler with history (sum 501.3 -> 501): SAIFI 0, SAIDI NULL
    assert m["cobb"].saidi is None and m["cobb"].middle_saifi == 0.0
    # filler without history (-1): everything NULL
    assert m["hall"].saidi is None and m["hall"].lower_saifi is None


def test_fillers_rows(daily):
    fill = {r.county: r for r in daily.events.where("is_filler").collect()}
    assert set(fill) == {"cobb", "hall"}
    assert fill["cobb"].customers_served == 501.0 and fill["hall"].customers_served == -1.0
    assert fill["cobb"].emc == "" and fill["cobb"].event_id == 1 and fill["cobb"].duration == dt.timedelta(0)


def test_served_total_sums_provider_maxima(spark):
    rows = [_r("x", "10:00", 5, "a", 100.9, 1), _r("x", "10:15", 5, "b", 50.0, 2),
            _r("x", "13:00", 5, "a", 120.2, 3)]
    reports = spark.createDataFrame(rows, SCHEMA)
    master = spark.createDataFrame([("ga", "x")], "state string, county string")
    keys = spark.createDataFrame([("ga", D)], "state string, report_date date")
    d = metric_daily(reports, master, keys)
    # events: (a,b) first emc a served max 100.9 ; (a) 120.2 -> per emc a max trunc 120; b never first
    tot = county_served_totals(d.events).collect()[0].served_total
    assert tot == 120
    m = d.metrics.collect()[0]
    assert m.lower_saifi == pytest.approx((5 + 5) / 120)
    assert m.saidi == pytest.approx(15 * 0.25 / 120.2)


def test_display_format(spark):
    vals = [None, 0.0, 0.00004, 0.00005, 0.00015, 0.0123, 12.0, 0.1234567, 1234567.5]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    out = [r.s for r in df.select(display_metric(half_even_round(F.col("x"))).alias("s")).collect()]
    assert out == ["0.0", "<0.0001", "<0.0001", "<0.0001", "0.0001", "0.0123", "12.0", "0.1235", "1234567.5"]


def test_round_half_even_like_numpy(spark):
    import numpy as np

    vals = [0.00125, 0.00135, 2.50005, 0.12345, 1.00005, 0.00015]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    out = [r.r for r in df.select(half_even_round(F.col("x")).alias("r")).collect()]
    assert out == [float(np.round(v, 4)) for v in vals]


def test_by_provider_events(spark):
    rows = [_r("x", "10:00", 5, "a", 100.0, 1), _r("x", "10:15", 7, "b", 50.0, 2), _r("x", "10:30", 9, "a", 100.0, 3)]
    reports = spark.createDataFrame(rows, SCHEMA)
    from gridpulse.operators.events import build_events

    ev = {(r.emc, r.event_id): (r.lower, r.upper) for r in build_events(reports, by_provider=True).collect()}
    assert ev == {("a", 1): (9.0, 9.0), ("b", 1): (7.0, 7.0)}
