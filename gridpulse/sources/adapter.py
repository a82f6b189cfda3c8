"""Outage-shaped inputs derived from the driver's tables.

The driver provides a generic ``events`` table (event_id, ts, user_id,
event_type, value) plus ``nation``/``region``.  Every derived column below
is a deterministic expression of those columns, so DuckDB can rebuild the
same rows for the oracle check:

* county   ``'c' || user_id % 50``, state ``'s' || user_id % 2``
* provider (emc) ``event_type``; report time ``ts``; affected ``floor(value)``
* served   ``1000 + 10 * (user_id % 50) + length(event_type)``
* master counties ``c0 .. c74`` (nation keys x 3 blocks) minus c22/c45/c68:
  those beyond c49 never report and become fillers
* FIPS codes from nation/region, with a few counties missing
* served history: every event is a reading of a county 25 further on

``raw_feed`` builds the un-standardized text form (mixed case, blanks,
``"1,234"`` numbers, mixed timestamp shapes, duplicate county columns).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

N_COUNTIES = 50
MASTER_BLOCKS = 3


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Driver table as a DataFrame."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _k():
    return F.col("user_id") % F.lit(N_COUNTIES)


def outage_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Standardized reports (schema ``std_reports``) from ``events``."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("s"), (F.col("user_id") % F.lit(2)).cast("string")).alias("state"),
        F.col("ts").cast("date").alias("report_date"),
        F.concat(F.lit("c"), _k().cast("string")).alias("county"),
        F.col("event_type").alias("emc"),
        F.col("ts").cast("timestamp_ntz").alias("ts"),
        F.floor("value").cast("double").alias("affected"),
        (F.lit(1000) + F.lit(10) * _k() + F.length("event_type")).cast("double").alias("customers_served"),
        F.lit("events").alias("source_file"),
        F.col("event_id").cast("long").alias("row_id"),
    )


def _master_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    return nation.select(
        F.col("n_nationkey"),
        F.explode(F.sequence(F.lit(0), F.lit(MASTER_BLOCKS - 1))).alias("_j"),
    ).select(
        "n_nationkey",
        (F.col("n_nationkey") + F.lit(25) * F.col("_j")).cast("long").alias("k"),
    )


def master_counties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Master county list (state, county): c0 .. c74 without k % 23 = 22, so
    reported counties c22 and c45 are outside the list and get no events."""
    m = _master_numbers(spark, sf_dir).where(F.col("k") % F.lit(23) != F.lit(22))
    return m.select(
        F.concat(F.lit("s"), (F.col("k") % F.lit(2)).cast("string")).alias("state"),
        F.concat(F.lit("c"), F.col("k").cast("string")).alias("county"),
    )


def run_keys(reports: DataFrame) -> DataFrame:
    """Requested (state, report_date) pairs: every day that has reports."""
    return reports.select("state", "report_date").distinct()


def served_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Historical served rows derived from ``events``: every row is a served
    reading of county ``c<user_id % 50 + 25>``, value ``floor(value) + 0.25``.
    Master counties that no event reaches so, c0..c24, have no history."""
    k = F.col("user_id") % F.lit(N_COUNTIES) + F.lit(25)
    return read_table(spark, sf_dir, "events").select(
        F.concat(F.lit("s"), (k % F.lit(2)).cast("string")).alias("state"),
        F.concat(F.lit("c"), k.cast("string")).alias("county"),
        (F.floor("value").cast("double") + F.lit(0.25)).alias("customers_served"),
    )


def fips_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FIPS lookup (all strings); county names padded and upper-cased on
    purpose, state names from ``region``; counties with k % 17 = 5 absent."""
    m = _master_numbers(spark, sf_dir).where(F.col("k") % F.lit(17) != F.lit(5))
    region = read_table(spark, sf_dir, "region")
    joined = m.join(region, (F.col("k") % F.lit(2)) == F.col("r_regionkey"), "inner")
    return joined.select(
        F.upper(F.concat(F.lit("s"), (F.col("k") % F.lit(2)).cast("string"))).alias("state_abbr"),
        F.lower(F.col("r_name")).alias("state_name"),
        F.concat(F.lit(" C"), F.col("k").cast("string"), F.lit(" ")).alias("county_name"),
        F.lpad(F.col("k").cast("string"), 5, "0").alias("fips"),
    )


def county_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """County map (state, raw, standard): ``c<k>`` and ``xx - c<k>`` map to
    ``c<k>``; ``c<k> county`` is deliberately absent (suffix kept at run time)."""
    m = _master_numbers(spark, sf_dir)
    base = m.select(
        F.concat(F.lit("s"), (F.col("k") % F.lit(2)).cast("string")).alias("state"),
        F.concat(F.lit("c"), F.col("k").cast("string")).alias("standard"),
    )
    return base.select(
        "state",
        F.explode(F.array(F.col("standard"), F.concat(F.lit("xx - "), F.col("standard")))).alias("raw"),
        "standard",
    )


def column_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column map (state, raw, standard) derived from ``nation``: for every
    master county number a raw column of its own, some named as percentages
    although mapped to a count (what ``qa_mapping_coverage`` reports)."""
    m = _master_numbers(spark, sf_dir)
    k = F.col("k").cast("string")
    raw = F.when(F.col("k") % 3 == 0, F.concat(F.lit("% out "), k)).when(F.col("k") % 3 == 1, F.concat(F.lit("percent "), k)).otherwise(F.concat(F.lit("out "), k))
    standard = F.when(F.col("k") % 2 == 0, F.lit("per_outage_customers_affected")).when(F.col("k") % 5 == 0, F.lit("customers_served")).otherwise(F.lit("county"))
    return m.select(F.concat(F.lit("s"), (F.col("k") % 2).cast("string")).alias("state"), raw.alias("raw"), standard.alias("standard"))


def raw_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Un-standardized provider rows (all strings) with two county columns,
    an affected column, a served column, a percent-out column and text
    timestamps in ten shapes plus garbage."""
    ev = read_table(spark, sf_dir, "events")
    k = _k().cast("string")
    c = F.concat(F.lit("c"), k)
    eid = F.col("event_id")
    county_a = (
        F.when(eid % 8 == 0, F.upper(c))
        .when(eid % 8 == 1, F.concat(F.lit("  "), c, F.lit("  ")))
        .when(eid % 8 == 2, F.concat(F.lit("xx-"), c))
        .when(eid % 8 == 3, F.lit(None).cast("string"))
        .when(eid % 8 == 4, F.lit("   "))
        .when(eid % 8 == 5, F.lit("Unknown"))
        .when(eid % 8 == 6, F.concat(c, F.lit(" county")))
        .otherwise(c)
    )
    v = F.floor("value").cast("long").cast("string")
    affected = (
        F.when(eid % 6 == 0, F.concat(F.lit('"'), v, F.lit(","), F.lpad((eid % 1000).cast("string"), 3, "0"), F.lit('"')))
        .when(eid % 6 == 1, F.lit("abc"))
        .when(eid % 6 == 2, F.lit(None).cast("string"))
        .otherwise(v)
    )
    served_n = (F.lit(1000) + F.lit(10) * _k() + F.length("event_type")).cast("string")
    served = (
        F.when(eid % 11 == 0, F.lit("0"))
        .when(eid % 11 == 1, F.concat(F.lit('"'), served_n.substr(1, 1), F.lit(","), served_n.substr(2, 3), F.lit('"')))
        .otherwise(served_n)
    )
    pct = (
        F.when(eid % 5 == 0, F.lit("0%"))
        .when(eid % 5 == 1, F.concat(F.lit("<"), ((eid % 9) + 1).cast("string"), F.lit("%")))
        .when(eid % 5 == 2, F.lit(None).cast("string"))
        .otherwise(F.concat(((eid % 40) + 1).cast("string"), F.lit(".5%")))
    )
    shapes = [
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"),
        F.date_format("ts", "MM-dd-yyyy HH:mm:ss"),
        F.lit("not a time"),
        F.date_format("ts", "M/d/yyyy h:mm a"),
        F.date_format("ts", "MMM d, yyyy H:mm"),
        F.date_format("ts", "M/d/yy HH:mm"),
        F.date_format("ts", "yyyy/MM/dd HH:mm:ss"),
        F.date_format("ts", "yyyyMMdd HH:mm:ss"),
        F.date_format("ts", "d MMMM yyyy"),
        F.date_format("ts", "yyyy-MM-dd"),
    ]
    ts_text = F.get(F.array(*shapes), (eid % len(shapes)).cast("int"))
    return ev.select(
        F.concat(F.lit("s"), (F.col("user_id") % F.lit(2)).cast("string")).alias("state"),
        F.concat(F.lit("feed_"), F.col("event_type"), F.lit("_per_county.csv")).alias("source_file"),
        eid.cast("long").alias("row_id"),
        F.when(eid % 97 == 0, F.lit(None).cast("string")).otherwise(F.col("event_type")).alias("emc"),
        county_a.alias("county_a"),
        c.alias("county_b"),
        affected.alias("affected_raw"),
        served.alias("served_raw"),
        pct.alias("pct_out"),
        ts_text.alias("ts_raw"),
        F.when(eid % 10 == 7, F.lit(" MUNI ")).when(eid % 10 == 8, F.lit("county")).alias("key_raw"),
    )


# Header of the events-derived feed and its column map (configuration, as a
# state's col_map.csv would hold it).  Position i of the header is column
# ``_c<i>`` of ``raw_feed_positional``.
FEED_HEADER = ("EMC", "Name ", "CountyName", "n_out", "Cust_S", "% Out", "timestamp", "key")
FEED_SOURCES = ("emc", "county_a", "county_b", "affected_raw", "served_raw", "pct_out", "ts_raw", "key_raw")
FEED_COL_MAP = {
    "name": "county",
    "countyname": "county",
    "n_out": "per_outage_customers_affected",
    "cust_s": "customers_served",
    "timestamp": "timestamp",
}


def raw_feed_positional(spark: SparkSession, sf_dir: str, with_served: bool = True):
    """(frame with ``state, source_file, row_id, _c0..``, header): the raw
    feed as one header group; without served it is the ``% out``-only variant."""
    raw = raw_feed(spark, sf_dir)
    pairs = [(h, c) for h, c in zip(FEED_HEADER, FEED_SOURCES) if with_served or c != "served_raw"]
    cols = [F.col(c).alias(f"_c{i}") for i, (_, c) in enumerate(pairs)]
    return raw.select("state", "source_file", "row_id", *cols), [h for h, _ in pairs]
