import datetime as dt

from pyspark.sql import functions as F

from gridpulse.operators.events import build_events
from gridpulse.operators.sessionize import DEFAULT_ORDER, SLICE, in_slices, sessionize
from gridpulse.sources import adapter
from conftest import SF_MID

SCHEMA = ("state string, report_date date, county string, emc string, ts timestamp_ntz, "
          "affected double, customers_served double, source_file string, row_id long")


def _rows(spec, county="fulton", emc="e1", served=100.0):
    out = []
    for i, (hhmm, aff) in enumerate(spec):
        h, m = map(int, hhmm.split(":"))
        ts = dt.datetime(2025, 5, 1, h, m)
        out.append(("ga", ts.date(), county, emc, ts, float(aff), served, "f.csv", i))
    return out


def test_hand_computed_fixture(spark):
    # 10:00 10, 10:15 4, 11:14 9 (gap 59 -> same event), 12:14 7 (gap 60 -> new)
    df = spark.createDataFrame(_rows([("10:00", 10), ("10:15", 4), ("11:14", 9), ("12:14", 7)]), SCHEMA)
    s = sessionize(df).orderBy("ts").collect()
    assert [r.event_id for r in s] == [1, 1, 1, 2]
    assert [r.delta for r in s] == [10.0, 0.0, 5.0, 7.0]
    assert [r.prev_affected for r in s] == [0.0, 10.0, 4.0, 0.0]
    ev = build_events(df).orderBy("event_id").collect()
    assert [(e.lower, e.upper, e.middle) for e in ev] == [(10.0, 15.0, 12.5), (7.0, 7.0, 7.0)]
    assert ev[0].duration == dt.timedelta(minutes=74)
    assert ev[1].duration == dt.timedelta(0)


def test_first_report_and_exact_59_minutes(spark):
    df = spark.createDataFrame(_rows([("00:00", 3), ("00:59", 1), ("01:58", 2), ("02:58", 5)]), SCHEMA)
    s = sessionize(df).orderBy("ts").collect()
    assert [r.is_new for r in s] == [True, False, False, True]


def single_window(reports, gap="INTERVAL 59 MINUTES"):
    """The plain form: one window per county and day."""
    from pyspark.sql import Window

    w = Window.partitionBy("state", "report_date", "county").orderBy("ts", "emc", "source_file", "row_id")
    prev = F.lag("ts").over(w)
    flagged = reports.select("*", (prev.isNull() | (F.col("ts") - prev > F.expr(gap))).alias("is_new"), F.lag("affected").over(w).alias("pv"))
    before = F.when(F.col("is_new"), F.lit(0.0)).otherwise(F.col("pv"))
    running = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return flagged.select("*", F.sum(F.col("is_new").cast("long")).over(running).alias("event_id"), before.alias("prev_affected"),
                          F.greatest(F.col("affected") - before, F.lit(0.0)).alias("delta"))


COLS = ["state", "report_date", "county", "row_id", "event_id", "is_new", "prev_affected", "delta"]


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_slices_give_the_single_window_result(spark):
    reports = adapter.outage_reports(spark, SF_MID)
    assert same(sessionize(reports).select(*COLS), single_window(reports).select(*COLS))


def test_bursts_of_one_county(spark):
    # many reports at the same instant and in the same minute, between quiet hours
    rows = spark.range(3000).selectExpr(
        "'ga' AS state", "DATE'2024-01-01' AS report_date", "'c' AS county", "concat('e', id % 7) AS emc",
        "CAST(TIMESTAMP_NTZ'2024-01-01 05:00:00' + make_dt_interval(0, IF(id < 2990, 0, CAST(id % 10 AS int)), 0, IF(id < 2000, 0, id % 50)) AS timestamp_ntz) AS ts",
        "CAST(id * 37 % 101 AS double) AS affected", "100D AS customers_served", "'f' AS source_file", "id AS row_id")
    assert same(sessionize(rows).select(*COLS), single_window(rows).select(*COLS))
    plain = single_window(rows).groupBy("event_id").agg(F.sum("delta").alias("upper"), F.max("affected").alias("lower"),
        F.min_by("emc", F.struct("ts", "emc", "source_file", "row_id")).alias("emc"), F.count(F.lit(1)).alias("n_reports"))
    assert same(build_events(rows).select("event_id", "upper", "lower", "emc", "n_reports"), plain)


def test_no_window_task_holds_a_whole_hot_county(spark):
    # one county with every report of the day: no (county, minute) group has more than a small share
    reports = adapter.outage_reports(spark, SF_MID).withColumn("county", F.lit("hot"))
    assert same(sessionize(reports).select(*COLS), single_window(reports).select(*COLS))
    largest = reports.groupBy("state", "report_date", F.minute("ts"), F.hour("ts")).count().agg({"count": "max"}).first()[0]
    assert largest < 20


def test_invariants_lower_middle_upper(spark):
    reports = adapter.outage_reports(spark, SF_MID)
    ev = build_events(reports)
    bad = ev.where(~((F.col("lower") <= F.col("middle")) & (F.col("middle") <= F.col("upper"))))
    assert bad.count() == 0
    # consecutive events of a key are separated by more than 59 minutes
    from pyspark.sql import Window
    w = Window.partitionBy("state", "report_date", "county").orderBy("event_id")
    gaps = ev.withColumn("prev_end", F.lag("end_time").over(w)).where(F.col("prev_end").isNotNull())
    assert gaps.where((F.col("start_time") - F.col("prev_end")) <= F.expr("INTERVAL 59 MINUTES")).count() == 0


def test_dst_session_time_zone_does_not_shift_gaps(spark):
    # 01:30 -> 02:30 on a spring-forward day is 60 minutes of wall time
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        rows = [("ny", dt.date(2024, 3, 10), "c", "e", dt.datetime(2024, 3, 10, h, m), 1.0, 10.0, "f", i)
                for i, (h, m) in enumerate([(1, 30), (2, 29), (3, 28)])]
        df = spark.createDataFrame(rows, SCHEMA)
        assert [r.event_id for r in sessionize(df).orderBy("ts").collect()] == [1, 1, 1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_a_burst_within_one_minute_is_split(spark):
    """20,000 reports of one county in one minute, many at the same time: no window holds more than a second of them."""
    at = F.timestamp_micros(F.lit(1_746_093_600_000_000) + (F.col("id") % 7000) * 8571).cast("timestamp_ntz")
    burst = spark.range(20_000).select(
        F.lit("ga").alias("state"), F.lit("2025-05-01").cast("date").alias("report_date"), F.lit("fulton").alias("county"),
        F.concat(F.lit("e"), F.col("id") % 3).alias("emc"), at.alias("ts"), (F.col("id") * 7919 % 101).cast("double").alias("affected"),
        F.lit(100.0).alias("customers_served"), F.lit("f.csv").alias("source_file"), F.xxhash64("id").alias("row_id"))
    reports = burst.union(spark.createDataFrame(_rows([("09:00", 3), ("09:59", 4), ("11:30", 5)]), SCHEMA)).cache()
    assert same(sessionize(reports).select(*COLS), single_window(reports).select(*COLS))
    sizes = in_slices(reports, ["state", "report_date", "county"], "ts", "affected", DEFAULT_ORDER, 59).groupBy(SLICE).count()
    assert sizes.count() > 50 and sizes.agg({"count": "max"}).first()[0] < 20_000 / 40
    ev = build_events(reports).orderBy("event_id").collect()
    assert [e.n_reports for e in ev] == [20_002, 1]
    upper = single_window(reports).groupBy("event_id").agg(F.sum("delta").alias("u")).orderBy("event_id").collect()
    assert [e.upper for e in ev] == [r.u for r in upper]
