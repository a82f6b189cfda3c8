"""Registered standardization queries over the events-derived raw feed."""

from __future__ import annotations

from pyspark.sql import functions as F

from gridpulse.constants import AFFECTED, COUNTY, SERVED, TIMESTAMP
from gridpulse.functions.text import clean_numeric, normalize_county
from gridpulse.functions.time import parse_timestamp
from gridpulse.operators import standardize as std
from gridpulse.plans.catalog import query
from gridpulse.sources import adapter

# fixed values: the days used by the date-filter queries
FILTER_DAY = "2024-01-15"
FILTER_RANGE = ("2024-01-10", "2024-01-20")


def canonical_feed(spark, sf, with_served: bool = True):
    raw, header = adapter.raw_feed_positional(spark, sf, with_served=with_served)
    plan = std.plan_header(header, adapter.FEED_COL_MAP)
    return std.coalesce_duplicates(raw, plan)


@query("std_coalesce_duplicates")
def q_coalesce(spark, sf):
    return canonical_feed(spark, sf).select("state", "row_id", COUNTY)


@query("std_drop_bad_county")
def q_drop_bad_county(spark, sf):
    return std.drop_bad_county(canonical_feed(spark, sf)).select("state", "row_id", COUNTY)


@query("std_impute_served")
def q_impute_served(spark, sf):
    df = canonical_feed(spark, sf, with_served=False)
    out = std.impute_served(df.withColumn("pct", std.pct_out_fraction(F.col("% out"))))
    return out.select(
        "state", "row_id",
        clean_numeric(F.col(AFFECTED)).alias("affected"),
        F.col("pct"),
        F.col(SERVED).cast("double").alias("customers_served"),
    )


@query("std_parse_timestamp")
def q_parse_timestamp(spark, sf):
    return canonical_feed(spark, sf).select("state", "row_id", parse_timestamp(F.col(TIMESTAMP)).alias("ts"))


@query("std_clean_numeric")
def q_clean_numeric(spark, sf):
    df = canonical_feed(spark, sf)
    return df.select(
        "state", "row_id",
        clean_numeric(F.col(AFFECTED)).alias("affected"),
        clean_numeric(F.col(SERVED)).alias("customers_served"),
    )


@query("std_filter_date")
def q_filter_date(spark, sf):
    df = std.parse_types(canonical_feed(spark, sf))
    return std.filter_date(df, FILTER_DAY).select("state", "row_id", "ts")


@query("std_filter_date_range")
def q_filter_date_range(spark, sf):
    df = std.parse_types(canonical_feed(spark, sf))
    return std.filter_date_range(df, *FILTER_RANGE).select("state", "row_id", "ts", "report_date")


@query("std_drop_zero_served")
def q_drop_zero_served(spark, sf):
    df = std.parse_types(canonical_feed(spark, sf))
    return std.drop_zero_served(df).select("state", "row_id", "customers_served")


@query("std_normalize_county")
def q_normalize_county(spark, sf):
    df = std.drop_bad_county(canonical_feed(spark, sf))
    return df.select("state", "row_id", normalize_county(F.col(COUNTY)).alias("county_key"))


@query("std_map_county")
def q_map_county(spark, sf):
    df = std.drop_bad_county(canonical_feed(spark, sf))
    return std.map_county(df, adapter.county_map(spark, sf)).select("state", "row_id", COUNTY)


@query("join_county_map")
def q_join_county_map(spark, sf):
    df = std.drop_bad_county(canonical_feed(spark, sf)).withColumn("raw_county", F.col(COUNTY))
    return std.map_county(df, adapter.county_map(spark, sf)).select("state", "row_id", "raw_county", COUNTY)


@query("std_pick_larger_column")
def q_pick_larger_column(spark, sf):
    # opt-in rule: two affected-type columns, keep the one with the larger total
    df = canonical_feed(spark, sf).withColumn(
        "affected_alt", F.concat(F.lit('"'), (F.col("row_id") % 7).cast("string"), F.lit('"'))
    )
    chosen = std.pick_larger_column(df, [AFFECTED, "affected_alt"])
    return chosen.select("state", "row_id", clean_numeric(F.col(AFFECTED)).alias("affected"))


@query("std_standardize")
def q_standardize(spark, sf):
    """The whole standardization chain (SURVEY id std_pipeline)."""
    return std.standardize(canonical_feed(spark, sf), adapter.county_map(spark, sf))
