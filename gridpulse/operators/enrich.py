"""FIPS enrichment and the public output layouts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.functions.text import fn_title, normalize_name
from gridpulse.session import maybe_broadcast


def prepare_fips(fips: DataFrame) -> DataFrame:
    """lookup_fips: all-string FIPS rows with join keys.

    State codes are compared lower-cased on both sides (an upper-case code
    in the request still finds its rows); county key is trimmed lower text.
    """
    return fips.select(
        F.lower(F.trim(F.col("state_abbr"))).alias("_fips_state"),
        normalize_name(F.col("county_name")).alias("_fips_county"),
        F.col("fips").cast("string").alias("fips"),
        F.col("state_name").cast("string").alias("state_name"),
    )


def join_fips(metrics: DataFrame, fips: DataFrame) -> DataFrame:
    """join_fips: left join on (state, trimmed lower county); a miss leaves
    FIPS and state name NULL; duplicate lookup keys fan out like the source."""
    f = maybe_broadcast(prepare_fips(fips))
    cond = (F.lower(F.trim(F.col("state"))) == F.col("_fips_state")) & (
        normalize_name(F.col("county")) == F.col("_fips_county")
    )
    return metrics.join(f, cond, "left").drop("_fips_state", "_fips_county")


def final_projection(enriched: DataFrame) -> DataFrame:
    """Dashboard/raw export layout: County, FIPS, SAIDI, LOWER_SAIFI, SAIFI
    (= middle), UPPER_SAIFI, State, Date, plus ``state_code`` for partitioning
    (``State`` is the display name and is NULL on a FIPS miss)."""
    return enriched.select(
        fn_title(F.col("county")).alias("County"),
        F.col("fips").alias("FIPS"),
        F.col("saidi").alias("SAIDI"),
        F.col("lower_saifi").alias("LOWER_SAIFI"),
        F.col("middle_saifi").alias("SAIFI"),
        F.col("upper_saifi").alias("UPPER_SAIFI"),
        fn_title(F.col("state_name")).alias("State"),
        F.col("report_date").alias("Date"),
        F.col("state").alias("state_code"),
    )


def history_projection(raw_export: DataFrame) -> DataFrame:
    """Six history columns (LOWER/UPPER dropped) plus the state code."""
    return raw_export.select("State", "County", "FIPS", "SAIDI", "SAIFI", "Date", "state_code")
