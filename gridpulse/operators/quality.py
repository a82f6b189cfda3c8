"""Data-quality and comparison operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.constants import COMPARE_TOLERANCE


def file_utilization(counters: DataFrame, settings: DataFrame, target_day, by: Sequence[str] = ("state", "source_file"), size: str = "bytes") -> DataFrame:
    """agg_file_utilization: per file (or other group ``by``), rows read,
    rows on the target day, rows whose time did not parse, the target share,
    estimated useful bytes (share x bytes) and a ``high`` / ``low`` note from
    the state's thresholds; NULL share for an empty file.

    ``counters``: a row per file and day (state, source_file, day text or
    ``none``, n_rows and the file's ``size``), as the landing keeps them; a
    file without rows has one of day NULL."""
    by = list(by)
    files = counters.select(*by, "source_file", size).distinct().groupBy(*by).agg(F.sum(size).alias("bytes"))
    n = F.coalesce("n_rows", F.lit(0))
    rows = counters.groupBy(*by).agg(
        F.sum(n).alias("n_rows"),
        F.sum(F.when(F.col("day") == F.lit(str(target_day)), n).otherwise(0)).alias("n_target_rows"),
        F.sum(F.when(F.col("day") == F.lit("none"), n).otherwise(0)).alias("n_unparsed"),
    )
    share = F.try_divide(F.col("n_target_rows").cast("double"), F.col("n_rows").cast("double"))
    limits = settings.select("state", "utilization_threshold_high", "utilization_log_low")
    j = rows.join(files, by).join(limits, "state", "left").withColumn("row_utilization", share)
    note = (
        F.when(F.col("row_utilization") >= F.col("utilization_threshold_high"), F.lit("high"))
        .when(F.col("row_utilization") <= F.col("utilization_log_low"), F.lit("low"))
        .otherwise(F.lit(""))
    )
    return j.select(
        *by, "bytes", "n_rows", "n_target_rows", "n_unparsed", "row_utilization",
        F.coalesce(F.col("row_utilization") * F.col("bytes"), F.lit(0.0)).alias("est_target_bytes"),
        note.alias("note"),
    )


def null_profile(df: DataFrame, provider_col: str = "emc", columns: Sequence[str] | None = None) -> DataFrame:
    """agg_null_profile: per provider and column, total rows and NULL count
    (only columns with NULLs), with one sample source file.  One pass:
    ``count_if`` per column, then ``unpivot``."""
    cols = [c for c in (columns or df.columns) if c != provider_col]
    agg = df.groupBy(provider_col).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.min("source_file").alias("sample_source") if "source_file" in df.columns else F.lit(None).alias("sample_source"),
        *[F.count_if(F.col(c).isNull()).alias(f"n__{c}") for c in cols],
    )
    long = agg.unpivot(
        [provider_col, "total_rows", "sample_source"], [F.col(f"n__{c}").alias(c) for c in cols], "column", "null_count"
    )
    return long.where(F.col("null_count") > 0).select(
        F.col(provider_col).alias("provider"), "sample_source", "column", "total_rows", "null_count"
    )


def normalize_for_compare(c) -> F.Column:
    """Tolerance-compare form of a value: ``<...`` text kept as text, other
    text parsed as a number (bad -> NULL)."""
    s = c.cast("string")
    return F.struct(
        F.when(s.startswith("<"), s).alias("txt"),
        F.when(~s.startswith("<") | s.isNull(), s.try_cast("double")).alias("num"),
    )


def values_match(a, b, tol: float = COMPARE_TOLERANCE) -> F.Column:
    """Both ``<x`` texts and equal; or both numbers within ``tol``; or both
    missing.  Text against number is a mismatch."""
    at, an = a.getField("txt"), a.getField("num")
    bt, bn = b.getField("txt"), b.getField("num")
    both_txt = at.isNotNull() & bt.isNotNull()
    one_txt = at.isNotNull() | bt.isNotNull()
    both_missing = an.isNull() & bn.isNull()
    return (
        F.when(both_txt, at == bt)
        .when(one_txt, F.lit(False))
        .when(both_missing, F.lit(True))
        .otherwise(F.coalesce(F.abs(an - bn) <= F.lit(tol), F.lit(False)))
    )


def pair_results(baseline: DataFrame, candidate: DataFrame, keys: Sequence[str], columns: Sequence[str], how: str = "inner") -> DataFrame:
    """join_compare: rows of both results side by side: keys, ``<column>__b``
    and ``<column>__o`` as text, and whether each side has the row."""
    keys = list(keys)
    b = baseline.select(*keys, *[F.col(c).cast("string").alias(f"{c}__b") for c in columns]).withColumn("_in_b", F.lit(True))
    o = candidate.select(*keys, *[F.col(c).cast("string").alias(f"{c}__o") for c in columns]).withColumn("_in_o", F.lit(True))
    return b.join(o, keys, "inner" if how == "inner" else "full")


def pair_scenarios(results: DataFrame, baseline: str, candidate: str, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """join_compare of two scenarios of one result (keys, scenario, columns):
    both are rows of the same plan, so they meet in a grouping by the keys."""
    sides = {"b": F.col("scenario") == baseline, "o": F.col("scenario") == candidate}
    values = [F.max(F.when(is_side, F.col(c).cast("string"))).alias(f"{c}__{side}") for c in columns for side, is_side in sides.items()]
    found = [F.max(F.when(is_side, F.lit(True))).alias(f"_in_{side}") for side, is_side in sides.items()]
    return results.groupBy(*keys).agg(*values, *found)


def mismatches(paired: DataFrame, keys: Sequence[str], columns: Sequence[str], tol: float = COMPARE_TOLERANCE) -> DataFrame:
    """qa_compare_tolerance over rows side by side: (keys, Column, Baseline, Optimized) of the values that differ."""
    keys = list(keys)
    stacked = paired.select(
        *keys, "_in_b", "_in_o",
        F.explode(F.array(*[
            F.struct(F.lit(c).alias("Column"), F.col(f"{c}__b").alias("Baseline"), F.col(f"{c}__o").alias("Optimized"))
            for c in columns
        ])).alias("_v"),
    ).select(*keys, "_in_b", "_in_o", "_v.*")
    ok = values_match(normalize_for_compare(F.col("Baseline")), normalize_for_compare(F.col("Optimized")), tol)
    ok = ok & F.col("_in_b").isNotNull() & F.col("_in_o").isNotNull()
    return stacked.where(~ok).select(*keys, "Column", "Baseline", "Optimized")


def compare_results(
    baseline: DataFrame,
    candidate: DataFrame,
    keys: Sequence[str] = ("County",),
    columns: Sequence[str] = ("SAIDI", "SAIFI", "LOWER_SAIFI", "UPPER_SAIFI"),
    tol: float = COMPARE_TOLERANCE,
    how: str = "inner",
) -> DataFrame:
    """qa_compare_tolerance of two results: long list (keys, Column, Baseline,
    Optimized) of mismatching values.  ``how='inner'`` mirrors the source
    (counties on one side only are not reported); ``how='full'`` also reports
    them, with the missing side NULL.  Columns absent on either side are skipped."""
    cols = [c for c in columns if c in baseline.columns and c in candidate.columns]
    return mismatches(pair_results(baseline, candidate, keys, cols, how), keys, cols, tol)


def mapping_coverage(
    raw_counties: DataFrame,
    county_map: DataFrame,
    master: DataFrame,
    col_map: DataFrame | None = None,
) -> DataFrame:
    """qa_mapping_coverage: raw county names without a mapping, mapped names
    that are not master counties, master counties no raw name reaches, and
    (with a column map) percent-named raw columns mapped to count columns
    -- reported, never fixed silently."""
    unmapped = raw_counties.join(county_map.select("state", "raw"), ["state", "raw"], "left_anti").select(
        "state", F.lit("raw_unmapped").alias("issue"), F.col("raw").alias("name")
    )
    stray = county_map.select("state", F.col("standard").alias("county")).distinct().join(
        master.select("state", "county"), ["state", "county"], "left_anti"
    ).select("state", F.lit("mapped_not_master").alias("issue"), F.col("county").alias("name"))
    reached = raw_counties.join(county_map, ["state", "raw"], "inner").select("state", F.col("standard").alias("county"))
    never = master.select("state", "county").join(reached.distinct(), ["state", "county"], "left_anti").select(
        "state", F.lit("master_never_hit").alias("issue"), F.col("county").alias("name")
    )
    out = unmapped.unionByName(stray).unionByName(never)
    if col_map is not None:
        out = out.unionByName(percent_mapped_to_counts(col_map))
    return out


# fixed values: canonical count columns a percentage must not feed
COUNT_COLUMNS = ("per_outage_customers_affected", "customers_served")


def percent_mapped_to_counts(col_map: DataFrame) -> DataFrame:
    """Column-map rows whose raw name looks like a percentage (``%`` or
    ``percent``) but whose target is a count column."""
    raw = F.lower(F.col("raw"))
    bad = (F.instr(raw, "%") > 0) | (F.instr(raw, "percent") > 0)
    return col_map.where(bad & F.col("standard").isin(list(COUNT_COLUMNS))).select(
        "state", F.lit("percent_mapped_to_count").alias("issue"),
        F.concat(F.col("raw"), F.lit(" -> "), F.col("standard")).alias("name"),
    )
