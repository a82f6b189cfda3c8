"""SAIDI / SAIFI per county and day, over a county spine."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.constants import KEY, METRIC_COLUMNS, REPORT_HOURS
from gridpulse.functions.numeric import display_metric, half_even_round
from gridpulse.operators.events import served_history_totals
from gridpulse.session import maybe_broadcast

METRIC_OUTPUT = ("state", "report_date", "county", *METRIC_COLUMNS)


def build_spine(master: DataFrame, run_keys: DataFrame) -> DataFrame:
    """One row per master county and requested (state, day).

    An equi-join on ``state``: the output is exactly the rows the result must
    have, so no pair is made that is not emitted.
    """
    return master.select("state", "county").distinct().join(
        run_keys.select("state", "report_date").distinct(), ["state"], "inner"
    ).select(*KEY)


def spine_metrics(
    events: DataFrame,
    spine: DataFrame,
    served_hist: DataFrame | None = None,
    report_hours: float = REPORT_HOURS,
) -> DataFrame:
    """agg_saidi, agg_saifi and join_county_spine in one two-level aggregation
    over real events; ``has_events`` tells reported counties from silent ones.

    Every report belongs to exactly one event, so SAIDI's report sums can be
    taken from the events (``sum_affected``, per-event max served) instead of
    a second pass over the reports.  Level 1 groups by (county-day, emc),
    level 2 by county-day: served total = sum over emc of the per-emc max
    (truncated, events without emc not counted); amounts summed over all.
    Spine rows without events are the filler case: SAIDI NULL, SAIFI 0 when
    the history total is positive, else NULL.
    """
    served_int = F.coalesce(F.col("customers_served").try_cast("long"), F.lit(0).cast("long"))
    per_emc = events.groupBy(*KEY, "emc").agg(
        F.max(served_int).alias("emc_served"),
        F.max("customers_served").alias("max_served"),
        F.sum("sum_affected").alias("sum_affected"),
        F.sum("lower").alias("sum_lower"),
        F.sum("middle").alias("sum_middle"),
        F.sum("upper").alias("sum_upper"),
    )
    per_key = per_emc.groupBy(*KEY).agg(
        F.sum(F.when(F.col("emc").isNotNull(), F.col("emc_served"))).alias("served_total"),
        F.max("max_served").alias("max_served"),
        F.sum("sum_affected").alias("sum_affected"),
        F.sum("sum_lower").alias("sum_lower"),
        F.sum("sum_middle").alias("sum_middle"),
        F.sum("sum_upper").alias("sum_upper"),
        F.lit(True).alias("has_events"),
    )
    joined = spine.select(*KEY).join(per_key, list(KEY), "left")
    if served_hist is not None:
        joined = joined.join(maybe_broadcast(served_history_totals(served_hist)), ["state", "county"], "left")
        filler_served = F.coalesce(F.col("hist_served"), F.lit(-1).cast("long"))
    else:
        filler_served = F.lit(-1).cast("long")
    has = F.col("has_events").isNotNull()
    served = F.when(has, F.coalesce(F.col("served_total"), F.lit(0).cast("long"))).otherwise(filler_served)
    ok = served > 0

    def ratio(c):
        return F.when(ok, F.coalesce(F.col(c), F.lit(0.0)) / served.cast("double"))

    saidi = F.when(has, F.try_divide(F.col("sum_affected") * F.lit(report_hours), F.col("max_served")))
    return joined.select(
        *KEY,
        saidi.alias("saidi"),
        ratio("sum_lower").alias("lower_saifi"),
        ratio("sum_middle").alias("middle_saifi"),
        ratio("sum_upper").alias("upper_saifi"),
        has.alias("has_events"),
        "sum_affected",
        "max_served",
    )


def with_scenarios(all_metrics: DataFrame, scenarios: Mapping[str, float]) -> DataFrame:
    """Every row of ``spine_metrics`` once per scenario (name -> hours that a
    report stands for), with the scenario's SAIDI.  The scenarios come after
    the reports are summed up, so any number of them is one pass over the reports."""
    each = F.explode(F.array(*[F.struct(F.lit(n).alias("scenario"), F.lit(float(h)).alias("hours")) for n, h in scenarios.items()]))
    rows = all_metrics.select("*", each.alias("s"))
    saidi = F.when(F.col("has_events"), F.try_divide(F.col("sum_affected") * F.col("s.hours"), F.col("max_served")))
    return rows.select(*KEY, F.col("s.scenario").alias("scenario"), saidi.alias("saidi"), *METRIC_COLUMNS[1:])


def metrics_from_events(
    events: DataFrame,
    spine: DataFrame,
    served_hist: DataFrame | None = None,
    report_hours: float = REPORT_HOURS,
) -> DataFrame:
    """Numeric metrics (unrounded, NULL = no data) for every spine row."""
    return spine_metrics(events, spine, served_hist, report_hours).select(*METRIC_OUTPUT)


def round_metrics(metrics: DataFrame) -> DataFrame:
    """metric_round: the export copy, 4 decimals (NumPy-style half-even)."""
    return metrics.select(
        *[half_even_round(F.col(c)).alias(c) if c in METRIC_COLUMNS else F.col(c) for c in metrics.columns]
    )


def format_metrics(metrics: DataFrame) -> DataFrame:
    """metric_round + metric_format_small: display text per metric."""
    return metrics.select(
        *[
            display_metric(half_even_round(F.col(c))).alias(c) if c in METRIC_COLUMNS else F.col(c)
            for c in metrics.columns
        ]
    )
