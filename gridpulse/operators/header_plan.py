"""What becomes of every column of every feed layout, as tables.

A layout is a header line of a state.  Its columns are normalized, renamed
through the state's column map, kept or pruned, and checked against the
required columns, all by expressions and joins over the distinct layouts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.constants import ALWAYS_ALLOWED, PCT_OUT, RAW_TIMESTAMP_COLUMN, REQUIRED_COLUMNS, SERVED
from gridpulse.functions.text import normalize_name
from gridpulse.operators.mapping import header_names

LAYOUT = ("state", "header")


def layouts(files: DataFrame) -> DataFrame:
    """(state, header, n_files): the distinct headers of each state's files (state, header)."""
    return files.where("header is not null").groupBy(*LAYOUT).agg(F.count(F.lit(1)).alias("n_files"))


def normalized_columns(found: DataFrame) -> DataFrame:
    """std_normalize_names: every column of a layout, by position, trimmed and lower-cased."""
    names = found.select(*LAYOUT, F.posexplode(header_names("header")).alias("position", "raw"))
    return names.withColumn("normalized", normalize_name(F.col("raw")))


def renamed_columns(found: DataFrame, col_map: DataFrame) -> DataFrame:
    """std_rename_columns: names through the state's column map (state, raw,
    standard); names without an entry keep their normalized form."""
    target = col_map.select("state", F.col("raw").alias("normalized"), "standard")
    joined = normalized_columns(found).join(target, ["state", "normalized"], "left")
    return joined.select(*LAYOUT, "position", "raw", "normalized", F.coalesce("standard", "normalized").alias("renamed"))


def kept_columns(found: DataFrame, col_map: DataFrame) -> DataFrame:
    """std_prune_columns: columns that are targets of the state's map, or
    always allowed; ``% out`` only in a layout without a served column."""
    targets = col_map.select("state", F.col("standard").alias("renamed")).distinct().withColumn("target", F.lit(True))
    columns = renamed_columns(found, col_map).join(targets, ["state", "renamed"], "left")
    allowed = F.coalesce("target", F.lit(False)) | F.col("renamed").isin(list(ALWAYS_ALLOWED))
    columns = columns.where(allowed).drop("target")
    served = columns.where(F.col("renamed") == SERVED).select(*LAYOUT).distinct().withColumn("served", F.lit(True))
    columns = columns.join(served, list(LAYOUT), "left")
    return columns.where(F.col("served").isNull() | (F.col("renamed") != PCT_OUT)).drop("served")


def missing_columns(found: DataFrame, col_map: DataFrame) -> DataFrame:
    """set_missing_columns: (state, header, missing_column), required columns
    that a layout lacks; ``% out`` stands for served, which it estimates."""
    wanted = found.select(*LAYOUT, F.explode(F.array(*[F.lit(c) for c in REQUIRED_COLUMNS])).alias("missing_column"))
    present = kept_columns(found, col_map).select(*LAYOUT, F.when(F.col("renamed") == PCT_OUT, SERVED).otherwise(F.col("renamed")).alias("missing_column"))
    return wanted.join(present.distinct(), [*LAYOUT, "missing_column"], "left_anti")


def layout_report(found: DataFrame, col_map: DataFrame) -> DataFrame:
    """std_required_columns and scan_require_timestamp: every layout with its
    missing columns and why it is not read (null if it is).  A layout needs a
    column named exactly ``timestamp``; required columns are checked on all
    readable layouts of a state together, as its files are one union."""
    missing = missing_columns(found, col_map)
    stamped = F.array_contains(header_names("header"), RAW_TIMESTAMP_COLUMN)
    base = found.withColumn("stamped", stamped)
    n_stamped = base.groupBy("state").agg(F.count_if("stamped").alias("n_stamped"))
    per_state = missing.join(base.where("stamped").select(*LAYOUT), list(LAYOUT), "left_semi").groupBy("state", "missing_column").agg(F.count(F.lit(1)).alias("n"))
    state_missing = per_state.join(n_stamped, "state").where("n = n_stamped").groupBy("state").agg(F.array_sort(F.collect_list("missing_column")).alias("state_missing"))
    own = missing.groupBy(*LAYOUT).agg(F.array_join(F.array_sort(F.collect_list("missing_column")), ",").alias("missing"))
    reason = F.when(~F.col("stamped"), F.lit("no timestamp column")).when(
        F.col("state_missing").isNotNull(), F.concat(F.lit("missing "), F.array_join("state_missing", ","))
    )
    joined = base.join(own, list(LAYOUT), "left").join(state_missing, "state", "left")
    return joined.select(*LAYOUT, "n_files", F.coalesce("missing", F.lit("")).alias("missing"), reason.alias("skipped_reason"))
