"""Gap-based sessionization of outage reports into events.

Reports of one county and day are ordered by time; a gap strictly larger
than ``gap_minutes`` (or the first report) starts a new event.  Each row
gets its event number, the previous ``affected`` value inside the event
(0 at the start) and the clipped positive step.

One method serves every size.  Reports are windowed per (key, slice), a slice
being a second: a gap of an hour cannot fall inside a slice, so a slice's
reports always belong to one event and only its first and last report matter
to the others.  One summary row per slice with reports is windowed per key to
find the events and what each slice carries in from the one before.  A county
that holds a third of all reports, or a burst of reports within a minute, is
so spread over its seconds, and a key's window sees 86,400 rows a day at most;
nothing is measured, collected or switched beforehand.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridpulse.constants import GAP_MINUTES, KEY
from gridpulse.functions.time import micros_between

DEFAULT_ORDER = ("ts", "emc", "source_file", "row_id")
SLICE, SLICE_SECONDS = "_slice", 1


def in_slices(reports: DataFrame, keys: Sequence[str], ts: str, value: str, order: Sequence[str], gap_minutes: int) -> DataFrame:
    """Reports with their slice, the value before them in it (``_pv``) and
    whether they are its ``_first`` or ``_last`` report."""
    if gap_minutes < 1:
        raise ValueError("gap_minutes must be at least 1")
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    nth = F.floor(micros_between(epoch, F.col(ts)) / F.lit(1_000_000 * SLICE_SECONDS)).cast("long")
    w = Window.partitionBy(*keys, SLICE).orderBy(*order)
    return reports.withColumn(SLICE, nth).select(
        "*",
        F.lag(value).over(w).alias("_pv"),
        F.lag(ts).over(w).isNull().alias("_first"),
        F.lead(ts).over(w).isNull().alias("_last"),
    )


def starts_event(first_ts: str, last_ts: str, keys: Sequence[str], gap_minutes: int) -> Column:
    """Whether a slice starts a new event, given its first and last time."""
    before = F.lag(last_ts).over(Window.partitionBy(*keys).orderBy(SLICE))
    return before.isNull() | ((F.col(first_ts) - before) > F.expr(f"INTERVAL '{int(gap_minutes)}' MINUTE"))


def event_number(is_new: str, keys: Sequence[str]) -> Column:
    """Running count of event starts over a key's slices."""
    running = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(F.col(is_new).cast("long")).over(running)


def value_before(last_value: str, keys: Sequence[str]) -> Column:
    """The last value of the key's slice before."""
    return F.lag(last_value).over(Window.partitionBy(*keys).orderBy(SLICE))


def sessionize(
    reports: DataFrame,
    keys: Sequence[str] = KEY,
    ts: str = "ts",
    value: str = "affected",
    order: Sequence[str] = DEFAULT_ORDER,
    gap_minutes: int = GAP_MINUTES,
) -> DataFrame:
    """Add ``is_new`` (bool), ``event_id`` (long, 1-based per key),
    ``prev_ts`` (the key's report before, of any event), ``prev_affected``
    and ``delta`` to every report row.

    ``order`` must end in a unique tie-breaker so the result is deterministic.
    """
    keys = list(keys)
    part = [*keys, SLICE]
    within = Window.partitionBy(*part).orderBy(*order)
    rows = in_slices(reports, keys, ts, value, order, gap_minutes).withColumn("_pt", F.lag(ts).over(within))
    slices = rows.groupBy(*part).agg(
        F.min(ts).alias("_t0"),
        F.max(ts).alias("_t1"),
        F.max(F.when(F.col("_last"), F.col(value))).alias("_v1"),
    )
    slices = slices.select(
        *part,
        starts_event("_t0", "_t1", keys, gap_minutes).alias("_new"),
        value_before("_t1", keys).alias("_carried_ts"),
        value_before("_v1", keys).alias("_carried"),
    )
    slices = slices.withColumn("event_id", event_number("_new", keys))
    is_new = F.col("_first") & F.col("_new")
    before = F.when(F.col("_first"), F.col("_carried")).otherwise(F.col("_pv"))
    prev = F.when(is_new, F.lit(0.0)).otherwise(before).cast("double")
    return rows.join(slices, part).select(
        *reports.columns,
        is_new.alias("is_new"),
        "event_id",
        F.when(F.col("_first"), F.col("_carried_ts")).otherwise(F.col("_pt")).alias("prev_ts"),
        prev.alias("prev_affected"),
        F.greatest(F.col(value) - prev, F.lit(0.0)).alias("delta"),
    )
