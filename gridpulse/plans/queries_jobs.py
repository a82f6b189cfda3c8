"""Registered queries: quality checks, mapping build, sinks and jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridpulse.operators import enrich, mapping, quality
from gridpulse.operators import metrics as met_ops
from gridpulse.plans import jobs
from gridpulse.plans.catalog import query
from gridpulse.session import unique_scratch
from gridpulse.sinks import tables
from gridpulse.sources import adapter
from gridpulse.sources.fixtures import ensure_fixture

# fixed values: the day replaced by set_replace_date
REPLACE_DAY = "2024-01-15"
# fixed values: the candidate run of the comparison uses a different hours-per-report
CANDIDATE_REPORT_HOURS = 0.26


def _raw_counties(spark, sf):
    raw = adapter.raw_feed(spark, sf)
    return mapping.distinct_counties(raw, ["county_a", "county_b"], key_col="key_raw")


def _outputs(spark, sf):
    from gridpulse.plans.daily import metric_daily

    reports = adapter.outage_reports(spark, sf)
    d = metric_daily(reports, adapter.master_counties(spark, sf), adapter.run_keys(reports), adapter.served_history(spark, sf))
    fips = adapter.fips_table(spark, sf)
    display = enrich.final_projection(enrich.join_fips(met_ops.format_metrics(d.metrics), fips))
    raw = enrich.final_projection(enrich.join_fips(d.metrics, fips))
    return display, raw


# ------------------------------------------------------------- mapping build --
@query("agg_distinct_counties")
def q_distinct_counties(spark, sf):
    return _raw_counties(spark, sf).orderBy("state", "raw")


@query("join_fuzzy_top1")
def q_fuzzy_top1(spark, sf):
    """The best master county of every raw name."""
    return mapping.fuzzy_map(_raw_counties(spark, sf), adapter.master_counties(spark, sf))


@query("win_best_match")
def q_best_match(spark, sf):
    """All master counties that a raw name scores 85 or more with, by place."""
    return mapping.ranked_matches(_raw_counties(spark, sf), adapter.master_counties(spark, sf))


@query("qa_mapping_coverage")
def q_mapping_coverage(spark, sf):
    cm = adapter.county_map(spark, sf)
    return quality.mapping_coverage(
        _raw_counties(spark, sf), cm, adapter.master_counties(spark, sf), adapter.column_map(spark, sf))


@query("agg_null_profile")
def q_null_profile(spark, sf):
    return quality.null_profile(
        adapter.raw_feed(spark, sf), "emc", ["county_a", "county_b", "affected_raw", "served_raw", "pct_out", "ts_raw", "key_raw"]
    )


# ---------------------------------------------------------------- comparison --
COMPARED = {"SAIDI": "saidi", "SAIFI": "middle_saifi", "LOWER_SAIFI": "lower_saifi", "UPPER_SAIFI": "upper_saifi"}
COMPARE_KEYS = ("state_code", "Date", "County")


def _paired(spark, sf):
    """Display values of a baseline and a candidate run side by side, from one pass over the reports."""
    from gridpulse.constants import KEY, REPORT_HOURS
    from gridpulse.functions.text import fn_title
    from gridpulse.plans.daily import metric_daily

    reports = adapter.outage_reports(spark, sf)
    d = metric_daily(reports, adapter.master_counties(spark, sf), adapter.run_keys(reports), adapter.served_history(spark, sf))
    runs = met_ops.with_scenarios(d.all_metrics, {"baseline": REPORT_HOURS, "candidate": CANDIDATE_REPORT_HOURS})
    shown = met_ops.format_metrics(runs).select(*KEY, "scenario", *[F.col(c).alias(name) for name, c in COMPARED.items()])
    paired = quality.pair_scenarios(shown, "baseline", "candidate", KEY, list(COMPARED))
    named = {"state_code": F.col("state"), "Date": F.col("report_date"), "County": fn_title(F.col("county"))}
    return paired.select(*[c.alias(n) for n, c in named.items()], *[c for c in paired.columns if c not in KEY])


@query("join_compare")
def q_join_compare(spark, sf):
    shown = [F.col(f"{c}__{side}").alias(f"{c}_{name}") for c in COMPARED for side, name in (("b", "base"), ("o", "opt"))]
    return _paired(spark, sf).select(*COMPARE_KEYS, *shown)


@query("qa_compare_tolerance")
def q_compare(spark, sf):
    return quality.mismatches(_paired(spark, sf), COMPARE_KEYS, list(COMPARED))


# ------------------------------------------------------------- set / sinks --
@query("set_replace_date")
def q_replace_date(spark, sf):
    _, raw = _outputs(spark, sf)
    existing = enrich.history_projection(raw)
    new = existing.where(F.col("Date") == F.lit(REPLACE_DAY).cast("date")).withColumn(
        "SAIDI", F.col("SAIDI") * F.lit(2.0))
    return tables.replace_date(existing, new)


@query("sink_dashboard_csv")
def q_sink_dashboard(spark, sf):
    display, _ = _outputs(spark, sf)
    path = unique_scratch(spark, "dashboard")
    tables.write_dashboard(display, path)
    return tables.read_dashboard(spark, path)


@query("agg_write_summary")
def q_write_summary(spark, sf):
    display, _ = _outputs(spark, sf)
    summary = tables.write_dashboard(display, unique_scratch(spark, "dashboard"))
    shown = [(summary["rows"], summary["columns"], summary["success"])]
    return spark.createDataFrame(shown, "n_rows long, n_columns int, success boolean")


@query("sink_history_upsert")
def q_sink_history(spark, sf):
    _, raw = _outputs(spark, sf)
    hist = enrich.history_projection(raw)
    path = unique_scratch(spark, "history")
    tables.upsert_history(hist, path)
    # re-running one day replaces exactly that day's rows
    tables.upsert_history(hist.where(F.col("Date") == F.lit(REPLACE_DAY).cast("date")), path)
    return spark.read.parquet(path)


# ---------------------------------------------------------------------- jobs --
def _fixture_inputs(spark, sf):
    from gridpulse.plans.queries_files import first_landed

    p = first_landed(spark, sf)[0]
    return jobs.Inputs(p.feeds, p.mappings, p.fips, f"{p.served}/*_customers_served.csv", p.landing, p.settings)


def _day_range(spark, sf):
    """First and last day of the events, and one day more (which has no reports)."""
    day = F.col("ts").cast("date")
    return adapter.read_table(spark, sf, "events").agg(F.min(day), F.date_add(F.max(day), 1)).first()


@query("job_daily")
def q_job_daily(spark, sf):
    inp = _fixture_inputs(spark, sf)
    keys = adapter.run_keys(adapter.outage_reports(spark, sf))
    res = jobs.job_daily(spark, inp, keys, out_root=unique_scratch(spark, "daily"))
    return res.display.drop("state_code")


@query("job_backfill")
def q_job_backfill(spark, sf):
    inp = _fixture_inputs(spark, sf)
    out = unique_scratch(spark, "backfill")
    jobs.job_backfill(spark, inp, ["s0", "s1"], *_day_range(spark, sf), out_root=out)
    return spark.read.parquet(f"{out}/history")


@query("sink_history_backfill")
def q_sink_backfill(spark, sf):
    """All days of the range in one history write; per state-month row
    counts of the written table, plus the skipped (state, day) pairs."""
    inp = _fixture_inputs(spark, sf)
    out = unique_scratch(spark, "backfill")
    res = jobs.job_backfill(spark, inp, ["s0", "s1"], *_day_range(spark, sf), out_root=out)
    written = spark.read.parquet(f"{out}/history").groupBy("state_code", "year", "month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("report_date").alias("n_days"))
    skipped = res.skipped.groupBy(F.col("state").alias("state_code")).agg(F.count(F.lit(1)).alias("n_skipped_days"))
    return written.join(skipped, "state_code", "left")


@query("job_mapping_build")
def q_job_mapping_build(spark, sf):
    p = ensure_fixture(spark, sf)
    _, _, cmap = jobs.job_mapping_build(spark, p.feeds, p.mappings)
    return cmap
