"""The daily reliability plan: reports -> events -> metrics -> outputs.

Everything is one lazy DataFrame plan keyed by (state, report_date, county),
so any number of states and days run in one job.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from gridpulse.constants import GAP_MINUTES, REPORT_HOURS
from gridpulse.operators.events import build_events, restrict_to_master, with_fillers
from gridpulse.operators.metrics import METRIC_OUTPUT, build_spine, spine_metrics


@dataclass
class DailyResult:
    spine: DataFrame
    real_events: DataFrame  # events built from reports (no fillers)
    all_metrics: DataFrame  # numeric, unrounded, NULL = no data; has_events
    served_hist: DataFrame | None = None

    @property
    def metrics(self) -> DataFrame:
        return self.all_metrics.select(*METRIC_OUTPUT)

    @property
    def events(self) -> DataFrame:
        """Events incl. one filler row per silent spine county (built on use)."""
        return with_fillers(self.real_events, self.spine, self.served_hist)


def metric_daily(
    reports: DataFrame,
    master: DataFrame,
    run_keys: DataFrame,
    served_hist: DataFrame | None = None,
    gap_minutes: int = GAP_MINUTES,
    report_hours: float = REPORT_HOURS,
    by_provider: bool = False,
) -> DailyResult:
    """SAIDI and lower/middle/upper SAIFI for every master county and requested day.

    Requested days select at the spine, which holds only them; reports of
    other days are best kept out by reading the partitions of the run.
    """
    spine = build_spine(master, run_keys)
    events = build_events(restrict_to_master(reports, master), gap_minutes=gap_minutes, by_provider=by_provider)
    found = spine_metrics(events, spine, served_hist, report_hours=report_hours)
    return DailyResult(spine=spine, real_events=events, all_metrics=found, served_hist=served_hist)
