"""Mapping and reference files, read for all states in one pass each.

Layout under a mapping root (one folder per state, upper-case code):
``<ST>/col_map.csv``, ``<ST>/raw_col_lists.csv``, ``<ST>/county_map.csv``,
``<ST>/master_county_list.txt``, ``<ST>/raw_county_list.txt``; the FIPS
table and served-history files are separate CSVs.  Every lookup gets a
``state`` column (lower-case) from its folder name.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.constants import HISTORY_COLUMNS, SETTINGS_DEFAULTS, SETTINGS_STATE_OVERRIDES
from gridpulse.functions.text import normalize_name, strip_county_word
from gridpulse.functions.time import parse_timestamp


def _state_folder(name: str) -> F.Column:
    """The folder that holds the file (or folder of part files) ``name``."""
    return F.lower(F.regexp_extract(F.col("_metadata.file_path"), rf"/([^/]+)/{re.escape(name)}(?:/[^/]+)?$", 1))


def _read_csv_by_header(spark: SparkSession, files: str, state: F.Column) -> DataFrame:
    """(state, line_no, fields: map of header name -> text) over all ``files``
    (a glob).  Column order differs from file to file, so every record
    is read by position and named by its own file's first record."""
    widths = spark.read.text(files).select(F.max(F.size(F.split("value", ","))).alias("n")).first().n or 1
    schema = ", ".join(f"_c{i} string" for i in range(widths))
    records = (
        spark.read.option("header", "false").option("quote", '"').option("escape", '"').option("multiLine", "true")
        .schema(schema).csv(files)
        .select(
            state.alias("state"),
            F.col("_metadata.file_path").alias("file"),
            F.monotonically_increasing_id().alias("line_no"),
            F.array(*[f"_c{i}" for i in range(widths)]).alias("fields"),
        )
    )
    first = records.groupBy("file").agg(F.min("line_no").alias("line_no"))
    heads = records.join(first, ["file", "line_no"]).select("file", F.col("line_no").alias("head_no"), F.col("fields").alias("names"))
    rows = records.join(heads, "file").where(F.col("line_no") > F.col("head_no"))
    named = F.filter(F.arrays_zip("names", "fields"), lambda x: x["names"].isNotNull())
    clean = F.transform(named, lambda x: F.struct(F.lower(F.trim(F.regexp_replace(x["names"], "^\ufeff", ""))).alias("k"), x["fields"].alias("v")))
    return rows.select("state", "line_no", F.col("names"), F.map_from_entries(clean).alias("fields"))


def _read_csv_all_strings(spark: SparkSession, pattern: str) -> DataFrame:
    return spark.read.option("header", "true").option("inferSchema", "false").csv(pattern)


def read_col_map(spark: SparkSession, root: str) -> DataFrame:
    """lookup_col_map: (state, raw, standard, line_no), trimmed lower-case;
    rows with fewer than two fields are skipped; the last row wins for a
    repeated raw name."""
    rows = _read_csv_by_header(spark, f"{root}/*/col_map.csv", _state_folder("col_map.csv")).select(
        "state",
        normalize_name(F.col("fields")["raw"]).alias("raw"),
        normalize_name(F.col("fields")["standard"]).alias("standard"),
        "line_no",
    ).where(F.col("raw").isNotNull() & F.col("standard").isNotNull())
    return rows.groupBy("state", "raw").agg(
        F.max_by("standard", "line_no").alias("standard"), F.max("line_no").alias("line_no")
    )


def col_map_dict(col_map: DataFrame) -> dict[str, dict[str, str]]:
    """Plan-time copy of the column maps ({state: {raw: canonical}}): a few
    dozen configuration rows per state, needed to build the projections."""
    out: dict[str, dict[str, str]] = {}
    for r in col_map.select("state", "raw", "standard").collect():
        out.setdefault(r.state, {})[r.raw] = r.standard
    return out


def read_col_lists(spark: SparkSession, root: str) -> DataFrame:
    """lookup_col_lists: (state, canonical, raw) from the column-wise lists,
    blanks dropped."""
    rows = _read_csv_by_header(spark, f"{root}/*/raw_col_lists.csv", _state_folder("raw_col_lists.csv"))
    stacked = rows.select("state", F.explode("fields").alias("canonical", "raw"))
    return stacked.where(F.col("raw").isNotNull() & (F.trim("raw") != "")).select(
        "state", F.trim("canonical").alias("canonical"), "raw"
    ).distinct()


def read_county_map(spark: SparkSession, root: str) -> DataFrame:
    """lookup_county_map: (state, raw, standard, score, line_no); score is
    carried but not used by the mapping."""
    return _read_csv_by_header(spark, f"{root}/*/county_map.csv", _state_folder("county_map.csv")).select(
        "state",
        normalize_name(F.col("fields")["raw"]).alias("raw"),
        normalize_name(F.col("fields")["standard"]).alias("standard"),
        F.col("fields")["score"].try_cast("double").alias("score"),
        "line_no",
    ).where(F.col("raw").isNotNull() & F.col("standard").isNotNull())


def read_raw_counties(spark: SparkSession, root: str) -> DataFrame:
    """lookup_raw_counties: distinct trimmed lower non-empty lines."""
    df = spark.read.text(f"{root}/*/raw_county_list.txt")
    return (
        df.select(_state_folder("raw_county_list.txt").alias("state"), normalize_name(F.col("value")).alias("raw"))
        .where(F.col("raw") != "")
        .distinct()
    )


def read_master_counties(spark: SparkSession, root: str) -> DataFrame:
    """lookup_master_counties: lower, every ``county`` substring removed,
    trimmed, empty lines dropped, distinct."""
    df = spark.read.text(f"{root}/*/master_county_list.txt")
    return (
        df.select(_state_folder("master_county_list.txt").alias("state"), strip_county_word(F.col("value")).alias("county"))
        .where(F.col("county") != "")
        .distinct()
    )


def read_fips(spark: SparkSession, path: str) -> DataFrame:
    """lookup_fips: all-string FIPS table (state_abbr, state_name, county_name, fips)."""
    df = _read_csv_all_strings(spark, path)
    return df.select(*[F.col(c).cast("string").alias(c) for c in ("state_abbr", "state_name", "county_name", "fips")])


def read_served_history(spark: SparkSession, pattern: str) -> DataFrame:
    """Historical served rows: (state, county, customers_served, as_of);
    state from the ``<ST>_customers_served.csv`` file name."""
    df = _read_csv_all_strings(spark, pattern)
    state = F.lower(F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)_customers_served\.csv(?:/[^/]+)?$", 1))
    return df.select(
        state.alias("state"),
        F.col("county").cast("string").alias("county"),
        F.col("customers_served").try_cast("double").alias("customers_served"),
        parse_timestamp(F.col("timestamp")).alias("as_of"),
    )


def read_monthly_history(spark: SparkSession, root: str) -> DataFrame:
    """History files of an earlier system, ``<ST>/<yyyy>_<mm>.csv`` by month:
    the history columns and ``state_code``, ready for ``upsert_history``.
    Rows whose Date does not parse are kept with a NULL Date."""
    state = F.lower(F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)/\d{4}_\d{1,2}\.csv(?:/[^/]+)?$", 1))
    rows = _read_csv_by_header(spark, f"{root}/*/[0-9][0-9][0-9][0-9]_*.csv", state)
    shown = {"SAIDI": "double", "SAIFI": "double"}
    columns = [F.col("fields")[c.lower()].try_cast(shown.get(c, "string")).alias(c) for c in HISTORY_COLUMNS if c != "Date"]
    day = parse_timestamp(F.col("fields")["date"]).cast("date")
    return rows.select(*columns, day.alias("Date"), F.col("state").alias("state_code"))


def read_settings(spark: SparkSession, path: str, defaults=SETTINGS_DEFAULTS) -> dict[str, dict]:
    """State overrides of the retrieval settings from a CSV (state, setting,
    value), for ``settings_table``.  An unknown setting is an error; values
    take the type of the default.  A few rows per state."""
    out: dict[str, dict] = {}
    for r in _read_csv_all_strings(spark, path).collect():
        state, name = r["state"].strip().lower(), r["setting"].strip()
        if name not in defaults:
            raise ValueError(f"unknown setting {name!r}")
        kind = type(defaults[name])
        text = r["value"].strip()
        out.setdefault(state, {})[name] = text.lower() in ("true", "1", "yes") if kind is bool else kind(text)
    return out


def settings_table(spark: SparkSession, states: Iterable[str] | DataFrame,
                   defaults=SETTINGS_DEFAULTS, overrides=SETTINGS_STATE_OVERRIDES) -> DataFrame:
    """lookup_settings: defaults overlaid by each state's overrides (left join
    + coalesce).  ``states`` may be a DataFrame with a ``state`` column."""
    if not defaults:
        raise ValueError("settings need defaults")
    if isinstance(states, DataFrame):
        st = states.select(F.lower(F.trim("state")).alias("state")).distinct()
    else:
        st = spark.createDataFrame([(s.strip().lower(),) for s in states], "state string")
    keys = list(defaults)
    rows = [(k, *[v.get(c) for c in keys]) for k, v in overrides.items()]
    schema = "state string, " + ", ".join(f"{c} {_sql_type(defaults[c])}" for c in keys)
    ov = spark.createDataFrame(rows, schema)
    joined = st.join(ov, "state", "left")
    return joined.select(
        "state", *[F.coalesce(F.col(c), F.lit(defaults[c])).alias(c) for c in keys]
    )


def _sql_type(v) -> str:
    if isinstance(v, bool):
        return "boolean"
    if isinstance(v, int):
        return "bigint"
    if isinstance(v, float):
        return "double"
    return "string"
