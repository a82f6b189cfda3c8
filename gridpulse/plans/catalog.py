"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per
operator ID.  Each reads the driver tables (through the adapter) so its
work grows with them; output columns are aliased to match the SQL oracle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridpulse.constants import KEY
from gridpulse.functions.text import fn_title
from gridpulse.functions.time import micros_between
from gridpulse.operators import enrich, events as ev_ops, metrics as met_ops
from gridpulse.operators.sessionize import sessionize
from gridpulse.plans.daily import metric_daily
from gridpulse.sources import adapter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


def _minutes(c) -> "F.Column":
    """Interval/timestamp difference as double minutes (portable to SQL)."""
    return micros_between(c[0], c[1]) / F.lit(60_000_000.0)


def _daily(spark: SparkSession, sf: str):
    reports = adapter.outage_reports(spark, sf)
    return metric_daily(
        reports,
        adapter.master_counties(spark, sf),
        adapter.run_keys(reports),
        adapter.served_history(spark, sf),
    )


def _sessions(spark: SparkSession, sf: str) -> DataFrame:
    reports = adapter.outage_reports(spark, sf)
    master = adapter.master_counties(spark, sf)
    restricted = ev_ops.restrict_to_master(reports, master)
    return sessionize(restricted)


def _event_out(ev: DataFrame) -> DataFrame:
    return ev.select(
        *KEY, "event_id", "lower", "middle", "upper",
        F.col("customers_served").cast("double").alias("customers_served"),
        "start_time", "end_time",
        _minutes(("start_time", "end_time")).alias("duration_minutes"),
        "emc", "is_filler",
    )


# ---------------------------------------------------------------- flagship --
@query("metric_daily")
def q_metric_daily(spark, sf):
    return _daily(spark, sf).metrics


# ------------------------------------------------------------------ windows --
@query("win_time_gap")
def q_win_time_gap(spark, sf):
    return _sessions(spark, sf).select(*KEY, "row_id", _minutes(("prev_ts", "ts")).alias("gap_minutes"))


@query("win_session_flag")
def q_win_session_flag(spark, sf):
    return _sessions(spark, sf).select(*KEY, "row_id", "is_new")


@query("win_session_id")
def q_win_session_id(spark, sf):
    return _sessions(spark, sf).select(*KEY, "row_id", "event_id")


@query("win_prev_in_session")
def q_win_prev_in_session(spark, sf):
    return _sessions(spark, sf).select(*KEY, "row_id", "prev_affected")


@query("win_positive_delta")
def q_win_positive_delta(spark, sf):
    return _sessions(spark, sf).select(*KEY, "row_id", "delta")


# ------------------------------------------------------------- aggregations --
@query("agg_outage_events")
def q_agg_outage_events(spark, sf):
    ev = _daily(spark, sf).events.where(~F.col("is_filler"))
    return _event_out(ev)


@query("agg_event_middle")
def q_agg_event_middle(spark, sf):
    ev = _daily(spark, sf).events.where(~F.col("is_filler"))
    return ev.select(*KEY, "event_id", "middle", _minutes(("start_time", "end_time")).alias("duration_minutes"))


@query("agg_customers_served")
def q_agg_customers_served(spark, sf):
    return ev_ops.county_served_totals(_daily(spark, sf).events)


@query("agg_served_history")
def q_agg_served_history(spark, sf):
    return ev_ops.served_history_totals(adapter.served_history(spark, sf))


@query("agg_saidi")
def q_agg_saidi(spark, sf):
    return _daily(spark, sf).all_metrics.where("has_events").select(*KEY, "saidi")


@query("agg_saifi")
def q_agg_saifi(spark, sf):
    return _daily(spark, sf).metrics.drop("saidi")


# -------------------------------------------------------------------- joins --
@query("join_county_restrict")
def q_join_county_restrict(spark, sf):
    reports = adapter.outage_reports(spark, sf)
    return ev_ops.restrict_to_master(reports, adapter.master_counties(spark, sf)).select(*KEY, "row_id")


@query("join_missing_counties")
def q_join_missing_counties(spark, sf):
    return _daily(spark, sf).events.where("is_filler").select(*KEY)


@query("join_served_history")
def q_join_served_history(spark, sf):
    d = _daily(spark, sf)
    return d.events.where(F.col("is_filler")).select(*KEY, F.col("customers_served").cast("double").alias("customers_served"))


@query("join_county_spine")
def q_join_county_spine(spark, sf):
    return _daily(spark, sf).metrics


@query("join_fips")
def q_join_fips(spark, sf):
    d = _daily(spark, sf)
    j = enrich.join_fips(d.metrics, adapter.fips_table(spark, sf))
    return j.select(*KEY, "fips", "state_name")


# ---------------------------------------------------- fillers and set ops --
@query("fill_counties")
def q_fill_counties(spark, sf):
    return _event_out(_daily(spark, sf).events.where(F.col("is_filler")))


@query("set_union_counties")
def q_set_union_counties(spark, sf):
    return _event_out(_daily(spark, sf).events)


@query("set_union_providers")
def q_set_union_providers(spark, sf):
    # Providers are a key column, never separate frames: the union of the
    # per-provider standardized reports is the reports with a provider.
    reports = adapter.outage_reports(spark, sf)
    return reports.where(F.col("emc").isNotNull()).groupBy("state", "emc").agg(
        F.count(F.lit(1)).alias("n_reports"), F.sum("affected").alias("sum_affected")
    )


# ------------------------------------------------------------------ metrics --
@query("metric_round")
def q_metric_round(spark, sf):
    return met_ops.round_metrics(_daily(spark, sf).metrics)


@query("metric_format_small")
def q_metric_format_small(spark, sf):
    return met_ops.format_metrics(_daily(spark, sf).metrics)


@query("metric_add_date")
def q_metric_add_date(spark, sf):
    m = met_ops.format_metrics(_daily(spark, sf).metrics)
    return m.select("state", "county", *[c for c in m.columns if c.endswith("saidi") or c.endswith("saifi")],
                    F.date_format("report_date", "yyyy-MM-dd").alias("date"))


@query("sort_counties")
def q_sort_counties(spark, sf):
    """Metric rows in county order (one per master county and day); ``place``
    is the row's place within its state and day, so the order can be checked."""
    place = F.row_number().over(Window.partitionBy("state", "report_date").orderBy("county"))
    return _daily(spark, sf).metrics.select(*KEY, place.alias("place")).orderBy(*KEY)


# ------------------------------------------------------------- presentation --
def _exports(spark, sf):
    d = _daily(spark, sf)
    fips = adapter.fips_table(spark, sf)
    raw = enrich.final_projection(enrich.join_fips(d.metrics, fips))
    display = enrich.final_projection(enrich.join_fips(met_ops.format_metrics(d.metrics), fips))
    return raw, display


@query("final_projection")
def q_final_projection(spark, sf):
    return _exports(spark, sf)[1].drop("state_code")


@query("history_projection")
def q_history_projection(spark, sf):
    return enrich.history_projection(_exports(spark, sf)[0]).drop("state_code")


@query("sort_history")
def q_sort_history(spark, sf):
    h = enrich.history_projection(_exports(spark, sf)[0]).drop("state_code")
    place = F.row_number().over(Window.partitionBy("State", "Date").orderBy("County"))
    return h.withColumn("place", place).orderBy("State", "Date", "County")


@query("fn_title")
def q_fn_title(spark, sf):
    """Python-style title case of every raw county text of the feed
    (``xx-c12`` -> ``Xx-C12``, ``c7 county`` -> ``C7 County``)."""
    raw = adapter.raw_feed(spark, sf)
    return raw.select("state", "row_id", F.col("county_a").alias("raw"), fn_title(F.col("county_a")).alias("title"))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    # the other query modules register themselves on import
    from gridpulse.plans import queries_files, queries_jobs, queries_std  # noqa: F401

    return dict(QUERIES)
