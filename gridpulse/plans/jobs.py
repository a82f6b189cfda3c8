"""End-to-end jobs: daily run, historical backfill, mapping build.

Each job is one set-based Spark plan over any number of states and days;
the source's per-state / per-day Python loops become grouping keys.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.operators import enrich, mapping
from gridpulse.operators.metrics import METRIC_OUTPUT, format_metrics
from gridpulse.operators.quality import compare_results
from gridpulse.operators.standardize import standardize
from gridpulse.plans.daily import metric_daily
from gridpulse.session import maybe_broadcast
from gridpulse.sinks.tables import read_dashboard, read_partitioned, upsert_history, write_dashboard, write_partitioned
from gridpulse.sources import feeds, lookups
from gridpulse.sources.landing import Landing


@dataclass
class Inputs:
    feeds_root: str
    mapping_root: str
    fips_path: str
    served_pattern: str | None = None
    landing: str | None = None          # store of landed feed rows; without it the feeds are read whole
    settings_path: str | None = None    # overrides of the retrieval settings


@dataclass
class JobResult:
    display: DataFrame          # dashboard layout (text metrics)
    raw_export: DataFrame       # same layout, numeric unrounded metrics
    history: DataFrame          # six history columns + state_code
    skipped: DataFrame | None   # (state, report_date) requested without reports
    write_summary: dict | None
    groups: list


def run_keys_for(spark: SparkSession, states: Sequence[str], days: Sequence) -> DataFrame:
    """(state, report_date) pairs of a run, from parameters."""
    rows = [(s.strip().lower(), d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))) for s in states for d in days]
    return spark.createDataFrame(rows, "state string, report_date date")


def _rows(spark: SparkSession, inp: Inputs, as_of=None, stale_days=None, days=None):
    """Feed rows: from the landing, brought up to date first (only files that
    are new or have changed are opened, only the days asked for are read), or
    else from the files.  Stale files count by the settings' days, if given."""
    col_maps = lookups.col_map_dict(lookups.read_col_map(spark, inp.mapping_root))
    if inp.landing:
        landing = Landing(spark, inp.landing)
        landing.land(inp.feeds_root, col_maps)
        files = landing.files()
        return landing.read(col_maps, days=days), feeds.header_groups(files, files.withColumn("wanted", F.lit(False)), col_maps)
    settings = None
    if inp.settings_path and as_of is not None:
        manifest = feeds.file_manifest(spark, inp.feeds_root)
        settings = lookups.settings_table(spark, manifest, overrides=lookups.read_settings(spark, inp.settings_path))
    return feeds.read_feeds(spark, inp.feeds_root, col_maps, as_of=as_of, stale_days=stale_days, settings=settings)


def _inputs(spark: SparkSession, inp: Inputs, as_of=None, stale_days=None, days=None):
    raw, groups = _rows(spark, inp, as_of, stale_days, days)
    county_map = lookups.read_county_map(spark, inp.mapping_root)
    master = lookups.read_master_counties(spark, inp.mapping_root)
    fips = lookups.read_fips(spark, inp.fips_path)
    served = lookups.read_served_history(spark, inp.served_pattern) if inp.served_pattern else None
    return raw, groups, county_map, master, fips, served


def _outputs(metrics: DataFrame, fips: DataFrame):
    raw_export = enrich.final_projection(enrich.join_fips(metrics, fips))
    display = enrich.final_projection(enrich.join_fips(format_metrics(metrics), fips))
    return raw_export, display, enrich.history_projection(raw_export)


def job_daily(
    spark: SparkSession,
    inp: Inputs,
    run_keys: DataFrame,
    out_root: str | None = None,
    as_of=None,
    stale_days: int | None = None,
) -> JobResult:
    """job_daily: feeds -> standardize -> events -> metrics -> FIPS ->
    history upsert + dashboard.  Every requested (state, day) gets one row
    per master county (fillers when nothing was reported)."""
    # The days of a run are parameters; landed rows of other days are not read.
    days = [r.report_date for r in run_keys.select("report_date").distinct().collect()] if inp.landing else None
    raw, groups, county_map, master, fips, served = _inputs(spark, inp, as_of, stale_days, days)
    if raw is None:
        raise ValueError("no usable feed files")
    std = standardize(raw, county_map, run_keys=run_keys)
    if out_root is None:
        d = metric_daily(std, master, run_keys, served)
        raw_export, display, history = _outputs(d.metrics, fips)
        return JobResult(display, raw_export, history, None, None, groups)
    metrics = _materialized_metrics(spark, std, master, run_keys, served, out_root)
    raw_export, display, history = _outputs(metrics, fips)
    upsert_history(history, f"{out_root}/history")
    summary = write_dashboard(display, f"{out_root}/dashboard")
    return JobResult(display, raw_export, history, None, summary, groups)


def finish_from_reports(
    spark: SparkSession,
    std: DataFrame,
    run_keys: DataFrame,
    master: DataFrame,
    served: DataFrame | None,
    fips: DataFrame,
    out_root: str,
) -> JobResult:
    """Tail of the daily job from standardized reports: silver, metrics,
    gold, history upsert and dashboard for exactly ``run_keys``."""
    metrics = _materialized_metrics(spark, std, master, run_keys, served, out_root)
    raw_export, display, history = _outputs(metrics, fips)
    upsert_history(history, f"{out_root}/history")
    summary = write_dashboard(display, f"{out_root}/dashboard")
    return JobResult(display, raw_export, history, None, summary, [])


def _materialized_metrics(spark, std, master, run_keys, served, out_root) -> DataFrame:
    """Silver reports -> metrics -> gold metrics, each a written table.

    The raw scan and parse run once (silver write); sessionization reads
    the silver partitions of the run; both sinks read the small gold table.
    """
    silver = f"{out_root}/silver/std_reports"
    gold = f"{out_root}/gold/metrics"
    write_partitioned(std, silver, ["state", "report_date"])
    reports = read_partitioned(spark, silver, run_keys)
    d = metric_daily(reports, master, run_keys, served)
    write_partitioned(d.metrics, gold, ["state", "report_date"])
    return read_partitioned(spark, gold, run_keys).select(*d.metrics.columns)


def job_backfill(
    spark: SparkSession,
    inp: Inputs,
    states: Sequence[str],
    start,
    end,
    out_root: str | None = None,
) -> JobResult:
    """job_backfill: every day in [start, end].  Days without reports are
    skipped (no rows, listed in ``skipped``), like the source's loop over
    empty day slices; the rest is written in history writes that replace
    exactly the days present (sink_history_backfill).

    With ``out_root`` a ledger beside the history says for every (state, day)
    whether it is done, empty or has failed, and why.  All days run as one
    plan; if that fails, its days are halved until the failing ones are found,
    which are listed while all others are written.  A later call with the same
    ``out_root`` does what is not done yet: pairs in the ledger that have not
    failed are left out by an anti-join.
    """
    first, last = (d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)) for d in (start, end))
    days = [first + dt.timedelta(days=i) for i in range((last - first).days + 1)]
    raw, groups, county_map, master, fips, served = _inputs(spark, inp, days=days)
    if raw is None:
        raise ValueError("no usable feed files")
    wanted = spark.createDataFrame([(s.strip().lower(),) for s in states], "state string").select(
        "state",
        F.explode(F.sequence(F.lit(start).cast("date"), F.lit(end).cast("date"))).alias("report_date"),
    )

    def reports_of(pairs: DataFrame, first, last) -> DataFrame:
        std = standardize(raw, county_map, date_range=(first, last))
        return std.join(maybe_broadcast(pairs), ["state", "report_date"], "left_semi")

    if out_root is None:
        std = reports_of(wanted, start, end)
        reported = std.select("state", "report_date").distinct()
        raw_export, display, history = _outputs(metric_daily(std, master, reported, served).metrics, fips)
        return JobResult(display, raw_export, history, wanted.join(reported, ["state", "report_date"], "left_anti"), None, groups)

    def write(pairs: DataFrame, first, last) -> None:
        silver = f"{out_root}/silver/std_reports"
        write_partitioned(reports_of(pairs, first, last), silver, ["state", "report_date"])
        std = read_partitioned(spark, silver, pairs)
        reported = std.select("state", "report_date").distinct()
        gold = f"{out_root}/gold/metrics"
        metrics = metric_daily(std, master, reported, served).metrics
        write_partitioned(metrics, gold, ["state", "report_date"])
        metrics = read_partitioned(spark, gold, pairs).select(*metrics.columns)
        upsert_history(_outputs(metrics, fips)[2], f"{out_root}/history")
        status = F.when(F.col("reported"), "done").otherwise("empty")
        listed = pairs.join(reported.withColumn("reported", F.lit(True)), ["state", "report_date"], "left")
        _add_to_ledger(listed.select("state", "report_date", status.alias("status"), F.lit(None).cast("string").alias("error")), out_root)

    done = backfill_ledger(spark, out_root).where("status <> 'failed'").select("state", "report_date")
    todo = wanted.join(done, ["state", "report_date"], "left_anti")
    days = sorted(r.report_date for r in todo.select("report_date").distinct().collect())
    _write_or_halve(days, todo, write, out_root)
    ledger = backfill_ledger(spark, out_root).join(wanted, ["state", "report_date"], "left_semi")
    written = ledger.where("status = 'done'").select("state", "report_date")
    metrics = read_partitioned(spark, f"{out_root}/gold/metrics", written) if not written.isEmpty() else None
    if metrics is None:
        empty = metric_daily(reports_of(wanted.limit(0), start, end), master, wanted.limit(0), served).metrics
        metrics = empty
    raw_export, display, history = _outputs(metrics.select(*METRIC_OUTPUT), fips)
    return JobResult(display, raw_export, history, ledger.where("status <> 'done'"), None, groups)


def _write_or_halve(days: list, pairs: DataFrame, write: Callable, out_root: str) -> None:
    """Write the days as one plan; where that fails, in halves, down to single (state, day) pairs."""
    if not days:
        return
    own = pairs.where(F.col("report_date").between(F.lit(days[0]), F.lit(days[-1])))
    try:
        write(own, days[0], days[-1])
        return
    except Exception as failure:  # whatever it is, the other days go on and the ledger has it
        if len(days) > 1:
            half = len(days) // 2
            for part in (days[:half], days[half:]):
                _write_or_halve(part, pairs, write, out_root)
            return
        states = [r.state for r in own.select("state").distinct().collect()]
        if len(states) > 1:
            for state in sorted(states):
                _write_or_halve(days, own.where(F.col("state") == state), write, out_root)
            return
        text = str(failure).splitlines()[0][:500]
        _add_to_ledger(own.select("state", "report_date", F.lit("failed").alias("status"), F.lit(text).alias("error")), out_root)


LEDGER = "state string, report_date date, status string, error string"


def _add_to_ledger(rows: DataFrame, out_root: str) -> None:
    """One more entry of the ledger; written after the output that it speaks of."""
    rows.withColumn("at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(f"{out_root}/ledger")


def backfill_ledger(spark: SparkSession, out_root: str) -> DataFrame:
    """(state, report_date, status, error): the newest entry of every pair."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{out_root}/ledger")
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], LEDGER)
    rows = spark.read.schema(f"{LEDGER}, at timestamp").parquet(f"{out_root}/ledger")
    newest = rows.groupBy("state", "report_date").agg(F.max_by(F.struct("status", "error"), "at").alias("x"))
    return newest.select("state", "report_date", "x.status", "x.error")


def job_compare(spark: SparkSession, baseline_root: str, candidate_root: str, how: str = "inner") -> DataFrame:
    """qa_compare_tolerance of two saved results: the published dashboards
    under both folders, county by county, day by day."""
    keys = ("state_code", "Date", "County")
    return compare_results(read_dashboard(spark, baseline_root), read_dashboard(spark, candidate_root), keys, how=how)


def job_mapping_build(spark: SparkSession, feeds_root: str, mapping_root: str, out_root: str | None = None):
    """job_mapping_build: distinct raw columns -> distinct raw counties (of
    the columns the column map sends to ``county``) -> fuzzy county map."""
    manifest = feeds.file_manifest(spark, feeds_root).where("is_feed")
    headers = feeds.file_headers(spark, feeds_root).join(manifest.select("uri", "state"), "uri")
    columns = mapping.distinct_columns(headers)
    col_maps = lookups.col_map_dict(lookups.read_col_map(spark, mapping_root))
    raw, _ = feeds.read_feeds(spark, feeds_root, col_maps, drop_null_provider=False)
    counties = mapping.distinct_counties(raw, ["county"])
    master = lookups.read_master_counties(spark, mapping_root)
    cmap = mapping.fuzzy_map(counties, master)
    if out_root is not None:
        cmap.select("state", "raw", "standard", "score").write.mode("overwrite").partitionBy("state").option(
            "header", "true").csv(f"{out_root}/county_map")
    return columns, counties, cmap
