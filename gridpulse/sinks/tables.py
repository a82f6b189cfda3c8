"""Sinks: published CSV files (dashboard, monthly history), idempotent date-partitioned tables."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gridpulse.constants import DASHBOARD_COLUMNS, HISTORY_COLUMNS
from gridpulse.session import maybe_broadcast
from gridpulse.sinks.commits import Commits

# Files that get their names at a time.
RENAMES = 16
MAX_RECORDS_PER_FILE = 5_000_000


def write_partitioned(df: DataFrame, path: str, partition_cols: Sequence[str]) -> None:
    """Dynamic-overwrite Parquet write (silver reports, gold metrics): only
    the partitions present in ``df`` are replaced.  Written tables are also
    the lineage cut of a job: after an executor loss, later stages re-read
    them instead of recomputing the scan and parse.  ``rebalance`` lets AQE
    size the write tasks: skewed partitions split, small ones merged."""
    (
        df.hint("rebalance", *partition_cols)
        .sortWithinPartitions(*partition_cols)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
        .partitionBy(*partition_cols)
        .parquet(path)
    )


def read_partitioned(spark: SparkSession, path: str, keys: DataFrame | None = None) -> DataFrame:
    """Read a (state, report_date) partitioned table; with ``keys`` only the
    requested partitions (semi join on partition columns -> pruning)."""
    df = spark.read.parquet(path)
    if keys is not None:
        df = df.join(maybe_broadcast(keys.select("state", "report_date").distinct()), ["state", "report_date"], "left_semi")
    return df


def publish_csv(df: DataFrame, root: str, columns: Sequence[str], folder: Column, name: Column, order: Sequence[str] = ()) -> int:
    """Publish ``columns`` as CSV files with headers, one for every (folder,
    name) of the rows, and return the number of rows.

    Spark writes the files below ``<root>/run=<id>``, where nobody looks, and
    they get their names there, several at a time.  ``index`` lists every
    published file with the run that wrote it: the files of this run and, of
    the last commit's list, those that this run does not replace.  The commit
    at the end makes all of it current at once (see ``Commits``); until then,
    and if the run dies, readers see the files of the run before.
    """
    spark = df.sparkSession
    commits = Commits(spark, root)
    run = commits.new_run()
    obs = Observation("published")
    keyed = df.select(*columns, folder.cast("string").alias("_folder"), name.cast("string").alias("_name"))
    (
        keyed.observe(obs, F.count(F.lit(1)).alias("rows"))
        .repartition("_folder", "_name")
        .sortWithinPartitions("_folder", "_name", *order)
        .write.option("header", "true")
        .partitionBy("_folder", "_name")
        .csv(f"{root}/run={run}/_parts")
    )
    written = _name_files(spark, f"{root}/run={run}")
    own = spark.createDataFrame(written, "folder string, name string").withColumn("run", F.lit(run))
    last = published(spark, root)
    index = own if last is None else own.unionByName(last.join(own, ["folder", "name"], "left_anti"))
    index.write.parquet(f"{root}/_index/run={run}")
    commits.add(run)
    return int(obs.get["rows"])


def published(spark: SparkSession, root: str) -> DataFrame | None:
    """(folder, name, run) of the current files under ``root``; a file's path
    is ``<root>/run=<run>/<folder>/<name>``.  None before the first commit."""
    run = Commits(spark, root).last()[1]
    return None if run is None else spark.read.parquet(f"{root}/_index/run={run}")


def published_paths(spark: SparkSession, root: str) -> list[str]:
    """Paths of the current files."""
    index = published(spark, root)
    return [] if index is None else [f"{root}/run={r.run}/{r.folder}/{r.name}" for r in index.collect()]


def _name_files(spark: SparkSession, base: str) -> list[tuple[str, str]]:
    """Rename ``base/_parts/_folder=F/_name=N/part-*`` to ``base/F/N``; returns all (F, N)."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path
    parts = at(f"{base}/_parts")
    fs = parts.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def value(path) -> str:
        return unquote(path.getName().split("=", 1)[1])

    def children(path) -> list:
        return [f.getPath() for f in fs.listStatus(path) if "=" in f.getPath().getName()]

    def move(folder, source) -> tuple[str, str]:
        files = [f.getPath() for f in fs.listStatus(source) if f.getPath().getName().startswith("part-")]
        target = at(f"{base}/{value(folder)}/{value(source)}")
        if len(files) != 1:
            raise RuntimeError(f"{len(files)} files for {target}")
        if not fs.rename(files[0], target):
            raise RuntimeError(f"could not name {target}")
        return value(folder), value(source)

    todo = []
    for folder in children(parts):
        fs.mkdirs(at(f"{base}/{value(folder)}"))
        todo += [(folder, source) for source in children(folder)]
    with ThreadPoolExecutor(RENAMES) as pool:
        done = list(pool.map(lambda x: move(*x), todo))
    fs.delete(parts, True)
    return done


def write_dashboard(display: DataFrame, path: str) -> dict:
    """sink_dashboard_csv: one CSV with header per state and run day, under
    its public name ``Date=<day>/<STATE>_DATA.csv`` (see ``publish_csv``).
    All days of the run are published; files of other days stay.  Any
    failure raises.  Returns agg_write_summary (rows, columns, target, success)."""
    folder, name = F.concat(F.lit("Date="), F.col("Date").cast("string")), F.concat(F.upper("state_code"), F.lit("_DATA.csv"))
    rows = publish_csv(display, path, DASHBOARD_COLUMNS, folder, name, ["County"])
    return {"rows": rows, "columns": len(DASHBOARD_COLUMNS), "target": path, "success": True}


def read_dashboard(spark: SparkSession, path: str) -> DataFrame:
    """The published files, with the state of their names."""
    schema = ", ".join(f"`{c}` string" for c in DASHBOARD_COLUMNS)
    files = published_paths(spark, path)
    if not files:
        return spark.createDataFrame([], f"{schema}, state_code string")
    code = F.lower(F.regexp_extract(F.col("_metadata.file_path"), r"/([^/]+)_DATA\.csv$", 1))
    return spark.read.option("header", "true").schema(schema).csv(files).withColumn("state_code", code)


def export_monthly(history: DataFrame, path: str) -> int:
    """The history as one CSV per state and month, ``<ST>/<yyyy>_<mm>.csv``,
    sorted by Date and County, published together; rows without a Date have
    no month and are left out.  Returns the number of rows."""
    dated = history.where("Date is not null")
    name = F.concat(F.date_format("Date", "yyyy_MM"), F.lit(".csv"))
    return publish_csv(dated, path, HISTORY_COLUMNS, F.upper("state_code"), name, ["Date", "County"])


def upsert_history(history: DataFrame, path: str) -> None:
    """sink_history_upsert / sink_history_backfill: Parquet partitioned by
    (state_code, year, month, report_date) with dynamic partition overwrite:
    re-running a day replaces exactly that day's partition (idempotent), any
    number of days and states go in one write, and concurrent runs of
    different days touch different partitions."""
    df = history.select(
        *HISTORY_COLUMNS,
        "state_code",
        F.year("Date").alias("year"),
        F.month("Date").alias("month"),
        F.col("Date").alias("report_date"),
    )
    (
        df.hint("rebalance", "state_code", "report_date")
        .sortWithinPartitions("state_code", "report_date", "County")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("state_code", "year", "month", "report_date")
        .parquet(path)
    )


def read_history(spark: SparkSession, path: str, state: str | None = None, year: int | None = None,
                 month: int | None = None) -> DataFrame:
    """A state-month of history sorted by Date, County (sort_history)."""
    df = spark.read.parquet(path)
    if state is not None:
        df = df.where(F.col("state_code") == state)
    if year is not None:
        df = df.where(F.col("year") == year)
    if month is not None:
        df = df.where(F.col("month") == month)
    return df.select(*HISTORY_COLUMNS, "state_code").orderBy("Date", "County")


def replace_date(existing: DataFrame, new_rows: DataFrame, keys: Sequence[str] = ("state_code",)) -> DataFrame:
    """set_replace_date as a DataFrame operation: existing rows of the
    (state, day) pairs present in ``new_rows`` are replaced by ``new_rows``;
    existing rows whose Date is NULL (unparseable) survive."""
    days = maybe_broadcast(new_rows.select(*keys, "Date").distinct())
    kept = existing.join(days, [*keys, "Date"], "left_anti")
    return kept.unionByName(new_rows.select(*existing.columns))
