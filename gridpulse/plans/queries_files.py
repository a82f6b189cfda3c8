"""Registered queries over file inputs (feeds, mapping files, reference CSVs).

The files are written by Spark from the driver tables (``sources.fixtures``)
into the shared scratch folder, in two deliveries; the landing takes them up
one after the other.  The oracle rebuilds their rows from ``events``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.operators import header_plan, quality
from gridpulse.operators import standardize as std
from gridpulse.plans.catalog import query
from gridpulse.sources import feeds, lookups
from gridpulse.sources.fixtures import ensure_fixture, first_delivery
from gridpulse.sources.landing import Landing, file_counters


def _maps(spark, paths):
    return lookups.col_map_dict(lookups.read_col_map(spark, paths.mappings))


def _feeds(spark, sf, drop_null_provider=True):
    paths = ensure_fixture(spark, sf)
    df, groups = feeds.read_feeds(spark, paths.feeds, _maps(spark, paths), drop_null_provider=drop_null_provider)
    return paths, df, groups


def first_landed(spark, sf):
    """The landing of the feeds with the first delivery at least."""
    paths = ensure_fixture(spark, sf)
    landing = Landing(spark, paths.landing)
    if landing.files() is None:
        landing.land(paths.feeds, _maps(spark, paths), until=first_delivery(spark, paths))
    return paths, landing


def landed_feeds(spark, sf):
    """The landing of the feeds, up to date: one run for each delivery the first time, only a listing later on."""
    paths, landing = first_landed(spark, sf)
    maps = _maps(spark, paths)
    landing.land(paths.feeds, maps)
    return paths, landing, maps


def _layout(uri) -> F.Column:
    return F.regexp_extract(uri, r"/([^/]+)_per_county/", 1)


# -------------------------------------------------------------------- scans --
@query("scan_file_manifest")
def q_manifest(spark, sf):
    """The feed files by state, layout and what the second delivery changed, with their records."""
    files = landed_feeds(spark, sf)[1].files()
    return files.groupBy("state", _layout("uri").alias("layout"), "change").agg(F.sum(F.col("n_lines") - 1).alias("n_records"))


@query("scan_stale_filter")
def q_stale(spark, sf):
    """Records of the files that are not stale two days after the first delivery."""
    paths, landing, _ = landed_feeds(spark, sf)
    as_of = first_delivery(spark, paths) + dt.timedelta(days=2, microseconds=1)
    fresh = feeds.stale_filter(landing.files(), as_of, 2)
    return fresh.groupBy("state", _layout("uri").alias("layout")).agg(F.sum(F.col("n_lines") - 1).alias("n_records"))


@query("scan_csv_dynamic")
def q_csv_dynamic(spark, sf):
    paths = ensure_fixture(spark, sf)
    manifest = feeds.file_manifest(spark, paths.feeds).where("is_feed")
    groups = feeds.header_groups(feeds.profile_files(spark, paths.feeds), manifest, _maps(spark, paths))
    out = None
    for g in groups:
        if g.skipped_reason is not None:
            continue
        part = feeds.read_group(spark, g).groupBy("state").agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
            "header", F.lit(",".join(g.header)))
        out = part if out is None else out.unionByName(part)
    return out.groupBy("state", "header").agg(F.sum("n_rows").alias("n_rows"))


@query("scan_union_by_name")
def q_union(spark, sf):
    return _feeds(spark, sf)[1].drop("source_file", "row_id")


def _layouts(spark, sf) -> tuple[DataFrame, DataFrame]:
    """The layouts of all feed files, and the column map."""
    paths, landing, _ = landed_feeds(spark, sf)
    return header_plan.layouts(landing.files()), lookups.read_col_map(spark, paths.mappings)


@query("scan_require_timestamp")
def q_require_ts(spark, sf):
    """Every layout and why it is not read (null if it is)."""
    return header_plan.layout_report(*_layouts(spark, sf)).select("state", "header", "skipped_reason")


@query("scan_null_literals")
def q_null_literals(spark, sf):
    df = _feeds(spark, sf, drop_null_provider=False)[1]
    cols = [c for c in df.columns if c not in ("state", "source_file", "row_id")]
    return df.groupBy("state").agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in cols])


@query("scan_source_lineage")
def q_lineage(spark, sf):
    df = _feeds(spark, sf)[1]
    return df.groupBy("state", _layout("source_file").alias("layout")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("scan_provider_key")
def q_provider_key(spark, sf):
    df = _feeds(spark, sf, drop_null_provider=False)[1]
    return df.where(F.col("emc").isNotNull()).groupBy("state", "emc").agg(F.count(F.lit(1)).alias("n_rows"))


@query("scan_full_history")
def q_full_history(spark, sf):
    paths, df, _ = _feeds(spark, sf)
    cm = lookups.read_county_map(spark, paths.mappings)
    return std.standardize(df, cm).drop("source_file", "row_id")


@query("scan_recent_slice")
def q_recent_slice(spark, sf):
    """The rows of the last two days, from their partitions alone."""
    _, landing, maps = landed_feeds(spark, sf)
    return landing.read(maps, days=landing.recent_days(2)).drop("source_file", "row_id")


# ------------------------------------------------------------------ lookups --
@query("lookup_col_map")
def q_lookup_col_map(spark, sf):
    """The column map as applied: every column of every layout with its
    canonical target (NULL when unmapped)."""
    found, col_map = _layouts(spark, sf)
    columns = header_plan.normalized_columns(found)
    target = col_map.select("state", F.col("raw").alias("normalized"), "standard")
    return columns.join(target, ["state", "normalized"], "left").select("state", "header", "position", "normalized", "standard")


@query("lookup_col_lists")
def q_lookup_col_lists(spark, sf):
    return lookups.read_col_lists(spark, ensure_fixture(spark, sf).mappings)


@query("lookup_county_map")
def q_lookup_county_map(spark, sf):
    """The county map as applied to the feeds: every normalized raw county
    value with its report count and mapped name (NULL when unmapped)."""
    from gridpulse.functions.text import normalize_county

    paths, df, _ = _feeds(spark, sf)
    cm = std.prepare_county_map(lookups.read_county_map(spark, paths.mappings))
    seen = df.where(F.col("county").isNotNull()).groupBy("state", normalize_county(F.col("county")).alias("raw")).agg(
        F.count(F.lit(1)).alias("n_reports"))
    return seen.join(cm, (F.col("state") == F.col("_map_state")) & (F.col("raw") == F.col("_map_raw")), "left").select(
        "state", "raw", "n_reports", F.col("_map_std").alias("standard"))


@query("lookup_raw_counties")
def q_lookup_raw_counties(spark, sf):
    return lookups.read_raw_counties(spark, ensure_fixture(spark, sf).mappings)


@query("lookup_master_counties")
def q_lookup_master(spark, sf):
    return lookups.read_master_counties(spark, ensure_fixture(spark, sf).mappings)


@query("lookup_fips")
def q_lookup_fips(spark, sf):
    from gridpulse.operators.enrich import prepare_fips

    return prepare_fips(lookups.read_fips(spark, ensure_fixture(spark, sf).fips))


def _settings(spark, paths, states):
    return lookups.settings_table(spark, states, overrides=lookups.read_settings(spark, paths.settings))


@query("lookup_settings")
def q_lookup_settings(spark, sf):
    """Retrieval settings as used: defaults under the overrides of the
    settings file, with every state's feed bytes and whether they are above
    the partial-read size."""
    paths, landing, _ = landed_feeds(spark, sf)
    sizes = landing.files().groupBy("state").agg(F.sum("data_bytes").alias("data_bytes"))
    joined = sizes.join(_settings(spark, paths, sizes), "state", "left")
    return joined.withColumn("above_threshold", F.col("use_optimization") & (F.col("data_bytes") > F.col("threshold_bytes")))


# ------------------------------------------------------ file aggregations --
@query("agg_file_utilization")
def q_file_utilization(spark, sf):
    """Share of the newest day in the rows of every layout, from the
    landing's counters; no feed file is opened."""
    paths, landing, _ = landed_feeds(spark, sf)
    counters = file_counters(landing).withColumn("layout", _layout("source_file"))
    settings = _settings(spark, paths, counters)
    return quality.file_utilization(counters, settings, landing.recent_days(1)[0], by=("state", "layout"), size="data_bytes")


@query("agg_bytes_summary")
def q_bytes_summary(spark, sf):
    """Bytes of records available and read two days after the first
    delivery, from the landing's counters."""
    paths, landing, _ = landed_feeds(spark, sf)
    as_of = first_delivery(spark, paths) + dt.timedelta(days=2, microseconds=1)
    files = landing.files().withColumns({"bytes": F.col("data_bytes"), "is_feed": F.lit(True)})
    return feeds.bytes_summary(files, as_of, 2).drop("files_available", "files_read")


@query("agg_distinct_columns")
def q_distinct_columns(spark, sf):
    columns = header_plan.normalized_columns(_layouts(spark, sf)[0])
    return columns.select("state", F.col("normalized").alias("column_name")).distinct()


# ---------------------------------------------------------- header plans --
@query("std_normalize_names")
def q_normalize_names(spark, sf):
    return header_plan.normalized_columns(_layouts(spark, sf)[0])


@query("std_rename_columns")
def q_rename_columns(spark, sf):
    return header_plan.renamed_columns(*_layouts(spark, sf)).drop("raw")


@query("std_prune_columns")
def q_prune_columns(spark, sf):
    return header_plan.kept_columns(*_layouts(spark, sf)).select("state", "header", "position", "renamed")


@query("std_required_columns")
def q_required_columns(spark, sf):
    return header_plan.layout_report(*_layouts(spark, sf)).select("state", "header", "missing", "skipped_reason")


@query("set_missing_columns")
def q_missing_columns(spark, sf):
    return header_plan.missing_columns(*_layouts(spark, sf))
