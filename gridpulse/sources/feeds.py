"""Provider feed files: manifest, headers, per-header-group CSV reads.

Layout: ``<root>/<state>/.../<name>.csv``; a file is a feed when its path
matches ``per[_]?count(y|ies)?`` (any case) and ends in ``.csv``.  Files with
different headers cannot share one CSV read (columns would be assigned by
position across layouts), so the files are grouped by header text and each
group is read with positional all-string columns, projected onto the
canonical columns, and the groups are unioned by name.  A profile of each
file tells its header and whether its records may run over several lines;
only such files are read whole.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.constants import (
    FEED_NAME_PATTERN,
    FEED_SUFFIX_PATTERN,
    NULL_LITERALS,
    PROVIDER_COLUMN,
    PCT_OUT,
    RAW_TIMESTAMP_COLUMN,
    REQUIRED_COLUMNS,
    SERVED,
)
from gridpulse.functions.text import null_if_literal
from gridpulse.operators.standardize import ColumnPlan, coalesce_duplicates, plan_header
from gridpulse.session import BROADCAST_LIMIT_BYTES, maybe_broadcast


# ----------------------------------------------------------------- manifest --
def file_manifest(spark: SparkSession, root: str) -> DataFrame:
    """scan_file_manifest: every file under ``root`` with state, size and
    modification time; ``is_feed`` marks names matching the feed pattern.
    ``path`` opens the file, ``uri`` is its escaped name in lineage columns.

    Uses the binaryFile source for its listing only: ``content`` is never
    selected, so no file body is read.
    """
    listing = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path", F.col("_metadata.file_path").alias("uri"), "length", "modificationTime")
    )
    rel = F.regexp_replace(F.col("path"), r"^.*?" + _escape(root.rstrip("/")) + "/", "")
    named = F.regexp_extract("path", r"/state=([^/]+)/", 1)  # a folder named so, else the first one
    return listing.select(
        "path",
        "uri",
        F.lower(F.coalesce(F.nullif(named, F.lit("")), F.split(rel, "/").getItem(0))).alias("state"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
        (F.col("path").rlike(FEED_SUFFIX_PATTERN) & F.col("path").rlike(FEED_NAME_PATTERN)).alias("is_feed"),
    )


def _escape(text: str) -> str:
    import re

    return re.escape(text.replace("file://", "").replace("file:", ""))


def stale_filter(manifest: DataFrame, as_of, stale_days: int = 2) -> DataFrame:
    """scan_stale_filter: keep feeds modified within ``stale_days`` (a number
    or column) of ``as_of`` (a timestamp value or column); older ones are skipped."""
    as_of = as_of if hasattr(as_of, "cast") else F.lit(as_of)
    stale_days = stale_days if hasattr(stale_days, "cast") else F.lit(stale_days)
    cutoff = as_of.cast("timestamp") - F.make_dt_interval(stale_days)
    return manifest.where(F.col("modified") >= cutoff)


def bytes_summary(manifest: DataFrame, as_of, stale_days: int = 2) -> DataFrame:
    """agg_bytes_summary per state: bytes of all feeds (stale ones included,
    as the source counts them before the age test), bytes read, reduction %."""
    feeds = manifest.where("is_feed")
    as_of = as_of if hasattr(as_of, "cast") else F.lit(as_of)
    cutoff = as_of.cast("timestamp") - F.make_dt_interval(F.lit(stale_days))
    fresh = F.col("modified") >= cutoff
    agg = feeds.groupBy("state").agg(
        F.sum("bytes").cast("long").alias("bytes_available"),
        F.coalesce(F.sum(F.when(fresh, F.col("bytes"))), F.lit(0)).cast("long").alias("bytes_read"),
        F.count(F.lit(1)).alias("files_available"),
        F.count_if(fresh).alias("files_read"),
    )
    return agg.withColumn(
        "reduction_pct",
        F.lit(100.0) - F.try_divide(F.col("bytes_read").cast("double"), F.col("bytes_available").cast("double")) * 100.0,
    )


# ------------------------------------------------------------------ profiles --
def profile_files(spark: SparkSession, files: str | Sequence[str]) -> DataFrame:
    """(uri, header, n_lines, n_odd, data_bytes), one row per file that has a
    line, from one pass over the files in splits.

    ``header`` is the first line, whole, however long.  ``n_odd`` counts the
    lines with an odd number of quotes: a quoted field that holds a line
    break makes at least one (its first line ends inside quotes), so a file
    without any has one record per line and can be read in splits.
    ``data_bytes`` is the size of the lines behind the header.

    ``files``: a root folder (its feed files, found recursively) or a list of
    paths.  Spark's text reader opens them, on any file system it knows; a
    file that cannot be opened fails the job.  ``uri`` is the file's name as
    ``_metadata.file_path`` has it (escaped), the same as the lineage column.
    """
    name = F.col("_metadata.file_path")
    if isinstance(files, str):
        text = spark.read.option("recursiveFileLookup", "true").text(files)
        text = text.where(name.rlike(FEED_SUFFIX_PATTERN) & name.rlike(FEED_NAME_PATTERN))
    elif files:
        text = spark.read.text(list(files))
    else:
        return spark.createDataFrame([], PROFILE)
    lines = text.select("value", name.alias("uri"), F.col("_metadata.file_block_start").alias("start"))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    # Only lines of a file's first split can be its header.  The groups are found by a number, whose
    # sort is cheap; the header is the only text that a group carries on.
    in_first = F.col("start") == 0
    lines = lines.select(
        F.xxhash64("uri").alias("id"), "uri", F.when(in_first, F.col("value")).alias("text"),
        F.when(in_first, F.monotonically_increasing_id()).alias("place"),
        (quotes % 2 == 1).alias("odd"), (F.octet_length("value") + 1).alias("size"),
    )
    found = lines.groupBy("id").agg(
        F.min("uri").alias("uri"),
        F.max("uri").alias("last_uri"),
        F.min_by("text", "place").alias("header"),
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if("odd").alias("n_odd"),
        F.sum("size").alias("bytes"),
    )
    same = F.when(F.col("uri") != F.col("last_uri"), F.raise_error(F.lit("two file names with one hash"))).otherwise(F.col("uri"))
    behind = F.col("bytes") - F.octet_length("header") - 1
    return found.select(same.alias("uri"), F.regexp_replace("header", "^\ufeff", "").alias("header"), "n_lines", "n_odd", behind.alias("data_bytes"))


PROFILE = "uri string, header string, n_lines long, n_odd long, data_bytes long"


def file_headers(spark: SparkSession, files: str | Sequence[str]) -> DataFrame:
    """(uri, header): the first line of each file."""
    return profile_files(spark, files).select("uri", "header")


def split_header(line: str) -> list[str]:
    """Header text -> column names (CSV rules: quotes, embedded commas)."""
    import csv

    return next(csv.reader([line])) if line is not None else []


@dataclass
class HeaderGroup:
    state: str
    header: list[str]
    paths: list[str]
    plan: ColumnPlan | None
    skipped_reason: str | None = None
    uris: list[str] = field(default_factory=list)
    quoted: bool = False  # some lines may go on in the next one


def header_groups(
    headers: DataFrame,
    manifest: DataFrame,
    col_maps: Mapping[str, Mapping[str, str]],
) -> list[HeaderGroup]:
    """Group feed files by (state, header, quoting); plan each group.
    ``headers`` are file profiles, or (uri, header) alone: then every file is
    taken for one whose records may run over several lines.

    Collects one row per distinct header and state (layouts are few), with
    the names of its files: of those alone that are ``wanted``, if the
    manifest has such a column.  Groups
    without an exact ``timestamp`` column (scan_require_timestamp), and all
    groups of a state whose files together lack a required column
    (std_required_columns), are kept with a reason and not read.
    """
    quoted = F.col("n_odd") > 0 if "n_odd" in headers.columns else F.lit(True)
    wanted = F.col("wanted") if "wanted" in manifest.columns else F.lit(True)
    rows = (
        headers.select("uri", "header", quoted.alias("quoted"))
        .join(manifest.select("uri", "path", "state", wanted.alias("wanted")), "uri")
        .groupBy("state", "header", "quoted")
        .agg(F.sort_array(F.collect_list(F.when(F.col("wanted"), F.struct("path", "uri")))).alias("files"))
        .orderBy("state", "header", "quoted")
        .collect()
    )
    groups = []
    for r in rows:
        cols = split_header(r.header)
        plan = None
        reason = None
        if RAW_TIMESTAMP_COLUMN not in cols:
            reason = "no timestamp column"
        else:
            plan = plan_header(cols, col_maps.get(r.state, {}))
        groups.append(HeaderGroup(r.state, cols, [f.path for f in r.files], plan, reason, [f.uri for f in r.files], r.quoted))
    # Required columns are checked on the state's union of files, as the
    # source checks its outer-unioned frame: a file lacking a column gets
    # NULLs there; only a state where no file has it is skipped.
    present: dict[str, set] = {}
    for g in groups:
        if g.plan is not None:
            cols_ = set(g.plan.sources) | ({SERVED} if PCT_OUT in g.plan.sources else set())
            present.setdefault(g.state, set()).update(cols_)
    for g in groups:
        if g.plan is not None:
            missing = [c for c in REQUIRED_COLUMNS if c not in present.get(g.state, set())]
            if missing:
                g.skipped_reason = "missing " + ",".join(missing)
    return groups


def read_group(spark: SparkSession, group: HeaderGroup, impute: bool | None = None, states: DataFrame | None = None) -> DataFrame:
    """scan_csv_dynamic for one header group: positional all-string read,
    null literals -> NULL, lineage column, canonical projection.

    Quotes inside a quoted field are doubled.  Files whose quoted fields hold
    line breaks are read whole, one task each; all others in splits.  A short
    record lacks its last fields (NULL); a record with more fields than the
    header fails the job, naming the file.

    ``impute``: estimate served from ``% out`` for this group's rows (the
    state has no served column in any file); see ``read_feeds``.  ``states``
    gives the state of every file (uri, state) if there are several."""
    width = len(group.header)
    schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width + 1)])
    df = (
        spark.read.schema(schema)
        .option("header", "true")
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", str(group.quoted).lower())
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", "true")
        .csv(group.paths)
    )
    too_long = F.raise_error(F.concat(F.lit("record with more fields than the header in "), F.col("_metadata.file_path")))
    df = df.where(F.when(F.col(f"_c{width}").isNotNull(), too_long.cast("boolean")).otherwise(F.lit(True)))
    df = df.select(
        F.col("_metadata.file_path").alias("source_file"),
        *[null_if_literal(F.col(f"_c{i}"), NULL_LITERALS).alias(f"_c{i}") for i in range(len(group.header))],
    )
    # deterministic tie-breaker from the row content (identical rows may
    # swap places without changing any result)
    df = df.withColumn("row_id", F.xxhash64("source_file", *[F.col(f"_c{i}") for i in range(len(group.header))]))
    if states is None:
        df = df.withColumn("state", F.lit(group.state))
    else:
        df = df.join(states, df["source_file"] == states["uri"]).drop("uri")
    return coalesce_duplicates(df, group.plan, impute=impute)


def read_feeds(
    spark: SparkSession,
    root: str,
    col_maps: Mapping[str, Mapping[str, str]],
    as_of=None,
    stale_days: int | None = None,
    require_provider: bool = True,
    drop_null_provider: bool = True,
    settings: DataFrame | None = None,
) -> tuple[DataFrame | None, list[HeaderGroup]]:
    """scan_* chain: manifest -> (stale filter) -> profiles -> groups ->
    per-group reads -> unionByName (missing canonical columns NULL).

    A file is stale after ``stale_days``, or after the days of its state in
    ``settings`` (see ``lookups.settings_table``), counted from ``as_of``.
    Rows without a provider are dropped (scan_provider_key); with
    ``require_provider`` an input where no group has the provider column is
    an error, as in the source.
    """
    manifest = file_manifest(spark, root).where("is_feed")
    if settings is not None and as_of is not None:
        limits = maybe_broadcast(settings.select("state", "stale_threshold_days"))
        manifest = stale_filter(manifest.join(limits, "state"), as_of, F.col("stale_threshold_days").cast("int"))
    elif stale_days is not None and as_of is not None:
        manifest = stale_filter(manifest, as_of, stale_days)
    groups = header_groups(profile_files(spark, root), manifest, col_maps)
    return read_planned(spark, groups, require_provider=require_provider, drop_null_provider=drop_null_provider), groups


def served_states(groups: Sequence[HeaderGroup]) -> dict[str, bool]:
    """Whether any usable file of a state has a served column."""
    out: dict[str, bool] = {}
    for g in groups:
        if g.skipped_reason is None:
            out[g.state] = out.get(g.state, False) or SERVED in g.plan.sources
    return out


def state_table(spark: SparkSession, named: Sequence[tuple[str, str]]) -> DataFrame:
    """(uri, state) of the files named, for a join with their rows that never
    broadcasts the rows.

    Catalyst has no size for a list that the driver hands it, and takes text
    rows of which few columns are used for much smaller than they are; left to
    itself it broadcasts the rows, or shuffles them by the few file names."""
    states = spark.createDataFrame(named, "uri string, state string")
    size = sum(len(uri) + len(state) for uri, state in named)
    return F.broadcast(states) if size <= BROADCAST_LIMIT_BYTES else states.hint("merge")


def read_planned(
    spark: SparkSession,
    groups: Sequence[HeaderGroup],
    only_paths: set[str] | None = None,
    require_provider: bool = True,
    drop_null_provider: bool = True,
) -> DataFrame | None:
    """Read planned header groups (optionally only some of their files, e.g.
    the new files of a stream batch; the served decision still comes from
    all groups of the state)."""
    usable = [g for g in groups if g.skipped_reason is None]
    if require_provider and usable and not any(PROVIDER_COLUMN in g.header for g in usable):
        raise ValueError(f"Expected column '{PROVIDER_COLUMN}' not found in data")
    # Files of a state are one outer union in the source: a served column in
    # any file means the column exists (empty) for every provider, and
    # ``% out`` is then not used.  Decide it per state at plan time.
    has_served = served_states(usable)
    # Groups that are read alike are one read, whatever their states.
    alike: dict[tuple, list[HeaderGroup]] = {}
    for g in usable:
        if only_paths is not None:
            picked = [(p, u) for p, u in zip(g.paths, g.uris, strict=True) if p in only_paths]
            if not picked:
                continue
            g = replace(g, paths=[p for p, _ in picked], uris=[u for _, u in picked])
        sources = tuple((name, tuple(at)) for name, at in g.plan.sources.items())
        alike.setdefault((tuple(g.header), sources, g.quoted, has_served[g.state]), []).append(g)
    frames = []
    for (*_, served), some in alike.items():
        whole = replace(some[0], paths=[p for g in some for p in g.paths])
        states = None
        if len(some) > 1:
            states = state_table(spark, [(u, g.state) for g in some for u in g.uris])
        frames.append(read_group(spark, whole, impute=not served, states=states))
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.where(F.col("emc").isNotNull()) if drop_null_provider else out
