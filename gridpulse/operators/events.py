"""Outage events, fillers for silent counties, and the customers-served total."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.constants import GAP_MINUTES, KEY
from gridpulse.operators.sessionize import DEFAULT_ORDER, SLICE, event_number, in_slices, starts_event, value_before
from gridpulse.session import maybe_broadcast

EVENT_COLUMNS = (
    "state", "report_date", "county", "event_id", "lower", "middle", "upper",
    "customers_served", "start_time", "end_time", "duration", "emc", "is_filler",
    "n_reports", "sum_affected",
)


def restrict_to_master(reports: DataFrame, master: DataFrame) -> DataFrame:
    """join_county_restrict: only counties of the master list get events."""
    return reports.join(maybe_broadcast(master.select("state", "county").distinct()), ["state", "county"], "left_semi")


def build_events(
    reports: DataFrame,
    keys: Sequence[str] = KEY,
    gap_minutes: int = GAP_MINUTES,
    by_provider: bool = False,
    order: Sequence[str] = DEFAULT_ORDER,
) -> DataFrame:
    """agg_outage_events + agg_event_middle: reports -> one row per event.

    upper = sum of positive steps, lower = largest report, served = largest
    served value, first/last time, emc of the earliest report with an emc.
    Reports are summed up per (key, second) first; the seconds of a key are
    then joined into events (see ``sessionize``).  Reports are shuffled once.

    By default all providers of a county are interleaved in one time line, as
    the source pipeline does; ``by_provider=True`` sessionizes each provider
    separately.
    """
    keys = list(keys) + (["emc"] if by_provider else [])
    part = [*keys, SLICE]
    rows = in_slices(reports, keys, "ts", "affected", order, gap_minutes)
    step = F.when(F.col("_first"), F.lit(0.0)).otherwise(F.greatest(F.col("affected") - F.col("_pv"), F.lit(0.0)))
    sums = [
        F.max("affected").alias("lower"),
        F.sum(step).alias("_steps"),
        F.max("customers_served").alias("customers_served"),
        F.min("ts").alias("start_time"),
        F.max("ts").alias("end_time"),
        F.count(F.lit(1)).alias("n_reports"),
        F.sum("affected").alias("sum_affected"),
        F.max(F.when(F.col("_first"), F.col("affected"))).alias("_v0"),
        F.max(F.when(F.col("_last"), F.col("affected"))).alias("_v1"),
    ]
    if not by_provider:
        # the window has the rows in order: the first provider is the slice's, for every row
        whole = Window.partitionBy(*part).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
        rows = rows.withColumn("_emc", F.first("emc", ignorenulls=True).over(whole))
        sums.append(F.max("_emc").alias("_emc"))
    slices = rows.groupBy(*part).agg(*sums)
    slices = slices.select(
        "*", starts_event("start_time", "end_time", keys, gap_minutes).alias("_new"), value_before("_v1", keys).alias("_carried")
    ).withColumn("event_id", event_number("_new", keys))
    before = F.when(F.col("_new"), F.lit(0.0)).otherwise(F.col("_carried"))
    joined = [
        F.max("lower").alias("lower"),
        F.sum(F.col("_steps") + F.greatest(F.col("_v0") - before, F.lit(0.0))).alias("upper"),
        F.max("customers_served").alias("customers_served"),
        F.min("start_time").alias("start_time"),
        F.max("end_time").alias("end_time"),
        F.sum("n_reports").alias("n_reports"),
        F.sum("sum_affected").alias("sum_affected"),
    ]
    if not by_provider:
        joined.append(F.min_by("_emc", F.when(F.col("_emc").isNotNull(), F.col(SLICE))).alias("emc"))
    events = slices.groupBy(*keys, "event_id").agg(*joined)
    return events.select(
        *[c for c in keys if c != "emc"],
        "event_id",
        "lower",
        ((F.col("lower") + F.col("upper")) / F.lit(2.0)).alias("middle"),
        "upper",
        "customers_served",
        "start_time",
        "end_time",
        (F.col("end_time") - F.col("start_time")).alias("duration"),
        "emc",
        F.lit(False).alias("is_filler"),
        "n_reports",
        "sum_affected",
    )


def served_history_totals(served_hist: DataFrame) -> DataFrame:
    """agg_served_history: sum of the historical rows per county, truncated to an integer."""
    return served_hist.groupBy("state", "county").agg(
        F.sum("customers_served").cast("long").alias("hist_served")
    )


def with_fillers(events: DataFrame, spine: DataFrame, served_hist: DataFrame | None = None) -> DataFrame:
    """set_union_counties with join_missing_counties, join_served_history and
    fill_counties: events of the spine's counties, and for every (state, day,
    county) without an event one filler row.

    A filler is event 1 with no times, zero duration, emc '', served =
    history total or -1, and amounts 0: sums over a filler give 0 like the
    source pipeline (whose filler amounts end up missing and are summed as
    0).  One left join of the spine with the events finds both.
    """
    joined = spine.select(*KEY).join(events.drop("is_filler"), list(KEY), "left")
    silent = F.col("event_id").isNull()
    served = F.lit(-1.0)
    if served_hist is not None:
        joined = joined.join(maybe_broadcast(served_history_totals(served_hist)), ["state", "county"], "left")
        served = F.coalesce(F.col("hist_served"), F.lit(-1)).cast("double")
    filled = {
        "event_id": F.lit(1).cast("long"),
        "customers_served": served,
        "duration": F.expr("INTERVAL '0' SECOND").cast("interval day to second"),
        "emc": F.lit(""),
        "n_reports": F.lit(0).cast("long"),
    } | {c: F.lit(0.0) for c in ("lower", "middle", "upper", "sum_affected")}
    shown = {c: F.when(silent, x).otherwise(F.col(c)).alias(c) for c, x in filled.items()}
    shown["is_filler"] = silent.alias("is_filler")
    return joined.select(*[shown.get(c, F.col(c)) for c in EVENT_COLUMNS])


def county_served_totals(events: DataFrame) -> DataFrame:
    """agg_customers_served: per county, sum over providers of each
    provider's largest event served value (bad -> 0, truncated to integer).

    The provider of an event is its first emc; events without one are not
    counted (the source groups by emc and drops missing keys).
    """
    served_int = F.coalesce(F.col("customers_served").try_cast("long"), F.lit(0).cast("long"))
    per_emc = (
        events.where(F.col("emc").isNotNull())
        .groupBy(*KEY, "emc")
        .agg(F.max(served_int).alias("emc_served"))
    )
    return per_emc.groupBy(*KEY).agg(F.sum("emc_served").cast("long").alias("served_total"))
