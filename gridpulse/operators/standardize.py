"""Standardization of raw provider rows into ``std_reports``.

Raw files differ in their headers, so a raw frame is handled per *header
group*: all files with the same header are read with positional column
names ``_c0 .. _cN`` and the header decides, at plan time, which positions
feed which canonical column.  Everything after that is row-wise and runs
inside one narrow stage (no shuffle); the county map is a small broadcast.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.constants import (
    AFFECTED,
    ALWAYS_ALLOWED,
    BAD_COUNTY_VALUES,
    COUNTY,
    EMC,
    PCT_OUT,
    REQUIRED_COLUMNS,
    SERVED,
    TIMESTAMP,
)
from gridpulse.functions.text import clean_numeric, normalize_county
from gridpulse.functions.time import parse_timestamp
from gridpulse.session import maybe_broadcast

STD_COLUMNS = (
    "state", "report_date", "county", "emc", "ts", "affected", "customers_served", "source_file", "row_id",
)


# ------------------------------------------------------------- plan time --
@dataclass
class ColumnPlan:
    """Which raw positions feed each canonical column, for one header."""

    header: list[str]
    normalized: list[str]
    renamed: list[str]
    sources: dict[str, list[int]] = field(default_factory=dict)
    missing: list[str] = field(default_factory=list)

    @property
    def usable(self) -> bool:
        return not self.missing


def normalize_names(header: Sequence[str]) -> list[str]:
    """std_normalize_names: trim + lower every raw column name."""
    return [h.strip().lower() for h in header]


def rename_columns(normalized: Sequence[str], col_map: Mapping[str, str]) -> list[str]:
    """std_rename_columns: raw -> canonical through the column map; names
    without an entry keep their (normalized) name."""
    return [col_map.get(n, n) for n in normalized]


def plan_header(header: Sequence[str], col_map: Mapping[str, str]) -> ColumnPlan:
    """std_normalize_names + std_rename_columns + std_prune_columns +
    set_missing_columns for one header.

    Kept are the canonical targets of the map plus ``% out`` and ``emc``;
    positions sharing a name are listed in column order for coalescing.
    ``% out`` is dropped when a served column exists; required columns
    still absent after that (``customers_served`` can be estimated from
    ``% out``) are listed in ``missing`` and the group is not usable.
    """
    normalized = normalize_names(header)
    renamed = rename_columns(normalized, col_map)
    allowed = set(col_map.values()) | set(ALWAYS_ALLOWED)
    sources: dict[str, list[int]] = {}
    for i, name in enumerate(renamed):
        if name in allowed:
            sources.setdefault(name, []).append(i)
    if SERVED in sources and PCT_OUT in sources:
        del sources[PCT_OUT]
    present = set(sources) | ({SERVED} if PCT_OUT in sources else set())
    missing = [c for c in REQUIRED_COLUMNS if c not in present]
    return ColumnPlan(list(header), normalized, renamed, sources, missing)


# --------------------------------------------------------------- run time --
def first_non_blank(cols: Sequence[Column]) -> Column:
    """std_coalesce_duplicates: first value that is not NULL and not blank
    after trimming; the value itself is returned untrimmed."""
    if len(cols) == 1:
        return cols[0]
    return F.coalesce(*[F.when(F.trim(c) != F.lit(""), c) for c in cols])


def coalesce_duplicates(
    raw: DataFrame,
    plan: ColumnPlan,
    keep: Sequence[str] = ("state", "source_file", "row_id"),
    impute: bool | None = None,
) -> DataFrame:
    """Project a positional raw frame onto its canonical columns.

    With ``impute`` given (file reads), the frame always carries served and
    ``% out`` (NULL when absent) plus an ``_impute`` flag, so frames of many
    header groups union cleanly and the served estimate is decided per row.
    """
    out = [F.col(k) for k in keep if k in raw.columns]
    for name, positions in plan.sources.items():
        out.append(first_non_blank([F.col(f"_c{i}") for i in positions]).alias(name))
    if EMC not in plan.sources:
        out.append(F.lit(None).cast("string").alias(EMC))
    if impute is not None:
        for name in (SERVED, PCT_OUT):
            if name not in plan.sources:
                out.append(F.lit(None).cast("string").alias(name))
        out.append(F.lit(bool(impute)).alias("_impute"))
    return raw.select(*out)


def pick_larger_column(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """std_pick_larger_column (opt-in): of several affected-type columns keep
    the one whose cleaned total is largest (first on ties), under the first
    column's name.  The totals are one global aggregate used as a scalar
    subquery, so nothing is collected to the driver."""
    if len(cols) < 2:
        return df
    totals = df.agg(*[F.coalesce(F.sum(clean_numeric(F.col(c))), F.lit(0.0)).alias(f"_t{i}") for i, c in enumerate(cols)])
    arr = F.array(*[F.col(f"_t{i}") for i in range(len(cols))])
    best = totals.select(F.array_position(arr, F.array_max(arr)).cast("int").alias("_best")).scalar()
    picked = F.element_at(F.array(*[F.col(c).cast("string") for c in cols]), best)
    return df.withColumn(cols[0], picked).drop(*cols[1:])


def drop_bad_county(df: DataFrame) -> DataFrame:
    """std_drop_bad_county: NULL county and the exact texts unknown/Unknown/UNKNOWN/''."""
    return df.where(F.col(COUNTY).isNotNull() & ~F.col(COUNTY).isin(list(BAD_COUNTY_VALUES)))


def pct_out_fraction(c: Column) -> Column:
    """``'<5%'`` -> 0.05: remove every ``<``, trailing ``%``, parse, / 100."""
    text = F.rtrim(F.regexp_replace(c.cast("string"), "<", ""))
    text = F.regexp_replace(text, "%+$", "")
    return text.try_cast("double") / F.lit(100.0)


def impute_served(df: DataFrame) -> DataFrame:
    """std_impute_served: when only ``% out`` exists, served = affected / pct,
    rounded half to even; NULL when pct is NULL or 0.

    Affected is cleaned first (quotes and thousands separators removed), so
    ``"1,200"`` gives an estimate instead of failing the whole state.
    """
    if "_impute" in df.columns:
        est = _served_estimate(F.col(AFFECTED), F.col(PCT_OUT))
        served = F.when(F.col("_impute"), est.cast("long").cast("string")).otherwise(F.col(SERVED))
        return df.withColumn(SERVED, served).drop(PCT_OUT, "_impute")
    if SERVED in df.columns or PCT_OUT not in df.columns:
        return df.drop(PCT_OUT) if PCT_OUT in df.columns else df
    est = _served_estimate(F.col(AFFECTED), F.col(PCT_OUT))
    return df.withColumn(SERVED, est.cast("long").cast("string")).drop(PCT_OUT)


def _served_estimate(affected: Column, pct_text: Column) -> Column:
    pct = pct_out_fraction(pct_text)
    # rint = round half to even on the double, like the source's float round
    return F.rint(F.try_divide(clean_numeric(affected), F.nullif(pct, F.lit(0.0))))


def parse_types(df: DataFrame) -> DataFrame:
    """std_parse_timestamp + std_clean_numeric."""
    return df.withColumns(
        {
            "ts": parse_timestamp(F.col(TIMESTAMP)),
            "affected": clean_numeric(F.col(AFFECTED)),
            "customers_served": clean_numeric(F.col(SERVED)),
        }
    ).withColumn("report_date", F.to_date(F.col("ts")))


def filter_dates(df: DataFrame, run_keys: DataFrame) -> DataFrame:
    """std_filter_date for any set of (state, day): broadcast semi join."""
    keys = maybe_broadcast(run_keys.select("state", "report_date").distinct())
    return df.join(keys, ["state", "report_date"], "left_semi")


def filter_date(df: DataFrame, day) -> DataFrame:
    """std_filter_date: keep rows of one calendar day."""
    return df.where(F.col("report_date") == F.lit(day).cast("date"))


def filter_date_range(df: DataFrame, start, end) -> DataFrame:
    """std_filter_date_range: inclusive [start, end]."""
    return df.where(F.col("report_date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))


def drop_zero_served(df: DataFrame) -> DataFrame:
    """std_drop_zero_served (unknown served was cleaned to 0 and goes too)."""
    return df.where(F.col("customers_served") != F.lit(0.0))


def prepare_county_map(county_map: DataFrame) -> DataFrame:
    """lookup_county_map: (state, raw lower/trim, standard lower/trim); the
    last row wins for a duplicated raw name when a ``line_no`` is given."""
    cm = county_map.select(
        F.lower(F.trim(F.col("state"))).alias("_map_state"),
        F.lower(F.trim(F.col("raw"))).alias("_map_raw"),
        F.lower(F.trim(F.col("standard"))).alias("_map_std"),
        *([F.col("line_no")] if "line_no" in county_map.columns else [F.lit(0).alias("line_no")]),
    )
    # tie on line_no (no line numbers given): the larger name, deterministic
    return cm.groupBy("_map_state", "_map_raw").agg(
        F.max_by("_map_std", F.struct("line_no", "_map_std")).alias("_map_std")
    )


def map_county(df: DataFrame, county_map: DataFrame, strip_county_suffix: bool = False) -> DataFrame:
    """std_normalize_county + join_county_map: normalize, look up, drop misses.

    ``strip_county_suffix`` also removes a trailing ``county`` word before
    the lookup (the source keeps it, so ``fulton county`` misses).
    """
    key = normalize_county(F.col(COUNTY))
    if strip_county_suffix:
        key = F.trim(F.regexp_replace(key, r"\s*county$", ""))
    cm = maybe_broadcast(prepare_county_map(county_map))
    joined = df.withColumn("_county_key", key).join(
        cm,
        (F.lower(F.trim(F.col("state"))) == F.col("_map_state")) & (F.col("_county_key") == F.col("_map_raw")),
        "inner",
    )
    return joined.withColumn(COUNTY, F.col("_map_std")).drop("_county_key", "_map_state", "_map_raw", "_map_std")


def standardize(
    canonical: DataFrame,
    county_map: DataFrame,
    run_keys: DataFrame | None = None,
    date_range: tuple | None = None,
    strip_county_suffix: bool = False,
) -> DataFrame:
    """std_pipeline on a frame already projected to canonical columns:
    bad county -> served estimate -> types -> dates -> zero served ->
    county map.  Rows without a provider are dropped (they have no key)."""
    df = canonical.where(F.col(EMC).isNotNull())
    df = drop_bad_county(df)
    df = impute_served(df)
    df = parse_types(df)
    if run_keys is not None:
        df = filter_dates(df, run_keys)
    if date_range is not None:
        df = filter_date_range(df, *date_range)
    df = df.where(F.col("ts").isNotNull())
    df = drop_zero_served(df)
    df = map_county(df, county_map, strip_county_suffix=strip_county_suffix)
    return df.select(*STD_COLUMNS)
