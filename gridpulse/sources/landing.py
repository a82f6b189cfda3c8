"""Incremental landing of feed files into day partitions.

The landing keeps, run by run, three small tables beside the landed rows:

* ``files``: the snapshot of the feed files (name, state, size, modification
  time) with each file's profile (header, quoting, lines, bytes);
* ``days``: for every file and day the number of its rows and a signature of
  their contents, partial sums that merge over any set of files and days;
* ``partitions``: which run wrote the current rows of a (state, day).

A new run lists the files and compares the listing with the last snapshot:
only files that are new, or whose size or time has changed, are opened, for
their profile and for their rows.  A grown file's days whose signature is as
before are known already; the other days, and those of removed files, are
merged with the rows of the other files and written as new partitions.  No
partition is overwritten: the run's commit makes its partitions current all
at once (see ``Commits``), so a run that dies leaves the old state readable
and is simply started again.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.constants import AFFECTED, COUNTY, EMC, PCT_OUT, SERVED, TIMESTAMP
from gridpulse.functions.time import parse_timestamp
from gridpulse.session import maybe_broadcast
from gridpulse.sinks.commits import Commits
from gridpulse.sources import feeds

ROW_COLUMNS = (TIMESTAMP, EMC, COUNTY, AFFECTED, SERVED, PCT_OUT, "source_file", "row_id")
DATA = (
    "source_file string, row_id long, "
    + ", ".join(f"`{c}` string" for c in ROW_COLUMNS[:-2])
    + ", state string, day string, run string"
)
# Day partition of rows whose time does not parse.
NO_DAY = "none"
MAX_RECORDS_PER_FILE = 5_000_000


def changes(listing: DataFrame, last: DataFrame | None) -> DataFrame:
    """(uri, change): ``new``, ``changed`` (size or time), ``same`` or ``removed``."""
    now = listing.select("uri", F.col("bytes").alias("b1"), F.col("modified").alias("m1"))
    if last is None:
        return now.select("uri", F.lit("new").alias("change"))
    before = last.select("uri", F.col("bytes").alias("b0"), F.col("modified").alias("m0"))
    change = (
        F.when(F.col("b0").isNull(), "new")
        .when(F.col("b1").isNull(), "removed")
        .when((F.col("b0") == F.col("b1")) & (F.col("m0") == F.col("m1")), "same")
        .otherwise("changed")
    )
    return now.join(before, "uri", "full").select("uri", change.alias("change"))


class Landing:
    """Landed feed rows and their bookkeeping under one ``store`` folder."""

    def __init__(self, spark: SparkSession, store: str):
        self.spark, self.store = spark, store.rstrip("/")
        self.commits = Commits(spark, self.store)

    def _table(self, name: str, run: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.store}/{name}/run={run}")

    def _keep(self, df: DataFrame, name: str, run: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{self.store}/{name}/run={run}")
        return self._table(name, run)

    def files(self) -> DataFrame | None:
        """The last snapshot: uri, path, state, bytes, modified, header,
        n_lines, n_odd, data_bytes and the change that its run saw."""
        run = self.commits.last()[1]
        return None if run is None else self._table("files", run)

    def days(self) -> DataFrame | None:
        """(state, source_file, day, n_rows, s1, s2) of all landed files."""
        run = self.commits.last()[1]
        return None if run is None else self._table("days", run)

    def listing(self, root: str, until=None) -> DataFrame:
        """The feed files under ``root`` as they are now, those modified by ``until`` if given."""
        found = feeds.file_manifest(self.spark, root).where("is_feed").drop("is_feed")
        return found if until is None else found.where(F.col("modified") <= F.lit(until))

    def refresh_files(self, listing: DataFrame, run: str) -> DataFrame:
        """Take the snapshot of a run: profiles of unchanged files are kept, only others are opened."""
        last = self.files()
        marked = listing.join(changes(listing, last), "uri")
        # The listing is on the driver already; so are the names of the files to open.
        fresh = [r.path for r in marked.where("change <> 'same'").select("path").collect()]
        profiles = feeds.profile_files(self.spark, fresh)
        if last is not None:
            known = last.join(marked.where("change = 'same'").select("uri"), "uri", "left_semi")
            profiles = profiles.unionByName(known.select(*profiles.columns))
        return self._keep(marked.join(profiles, "uri", "left"), "files", run)

    def land(self, root: str, col_maps: Mapping[str, Mapping[str, str]], until=None) -> DataFrame:
        """scan_recent_slice, landing side: bring the store up to date with
        the feeds under ``root`` (those modified by ``until``, if given).
        Returns the (state, day) pairs whose partitions were written anew.
        Rows without a provider or a parsable time are landed too."""
        listing = self.listing(root, until)
        last_files, last_days = self.files(), self.days()
        if last_files is not None and changes(listing, last_files).where("change <> 'same'").isEmpty():
            return self.spark.createDataFrame([], "state string, day string")
        run = self.commits.new_run()
        last_run = self.commits.last()[1]
        files = self.refresh_files(listing, run)
        gone = changes(files, last_files).where("change = 'removed'").select("uri")
        opened = files.where("change <> 'same'")
        paths = {r.path for r in opened.select("path").collect()}
        left = opened.select("uri").union(gone)  # files whose old rows no longer count
        # All layouts count for what a state's files have; only the opened files pass the driver.
        groups = feeds.header_groups(files, files.withColumn("wanted", F.col("change") != "same"), col_maps)
        raw = feeds.read_planned(self.spark, groups, paths, require_provider=False, drop_null_provider=False)
        if raw is None:
            raw = self.spark.createDataFrame([], ", ".join(f"`{c}` string" for c in ("state", *ROW_COLUMNS[:-1])) + ", row_id long")
        for c in ROW_COLUMNS:
            if c not in raw.columns:
                raw = raw.withColumn(c, F.lit(None).cast("string"))
        day = F.coalesce(F.to_date(parse_timestamp(F.col(TIMESTAMP))).cast("string"), F.lit(NO_DAY))
        staged = raw.select(*ROW_COLUMNS, "state", day.alias("day"))
        staged.write.mode("overwrite").parquet(f"{self.store}/staging/run={run}")
        staged = self._table("staging", run)

        found = staged.groupBy("state", "source_file", "day").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("row_id") % (1 << 30)).alias("s1"), F.bit_xor("row_id").alias("s2")
        )
        found = self._keep(found, "found", run)
        partition = ["state", "day"]
        if last_days is None:
            days, touched = found, found.select(*partition).distinct()
        else:
            left_files = left.withColumnRenamed("uri", "source_file")
            old = last_days.join(left_files, "source_file", "left_semi").select(*found.columns)
            kept = last_days.join(left_files, "source_file", "left_anti")
            days = kept.unionByName(found)
            # A day of a file that is in both with the same signature has not changed.
            touched = found.exceptAll(old).unionByName(old.exceptAll(found)).select(*partition).distinct()
        days = self._keep(days, "days", run)
        touched = self._keep(touched, "touched", run)
        rows = staged.join(maybe_broadcast(touched), partition, "left_semi")
        if last_run is not None:
            other = self._current(last_run).join(maybe_broadcast(touched), partition, "left_semi")
            other = other.join(maybe_broadcast(left.withColumnRenamed("uri", "source_file")), "source_file", "left_anti")
            rows = rows.unionByName(other)
        (
            rows.withColumn("run", F.lit(run))
            .hint("rebalance", *partition)
            .sortWithinPartitions(*partition)
            .write.mode("append")
            .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
            .partitionBy(*partition, "run")
            .parquet(f"{self.store}/data")
        )
        current = touched.join(days.select(*partition).distinct(), partition, "left_semi").withColumn("run", F.lit(run))
        if last_run is not None:
            current = current.unionByName(self._table("partitions", last_run).join(touched, partition, "left_anti"))
        self._keep(current, "partitions", run)
        self.commits.add(run)
        for name in ("staging", "found"):
            self.commits.remove(f"{name}/run={run}")
        return touched

    def _current(self, run: str, keep: Column | None = None) -> DataFrame:
        """Rows of the partitions that are current as of ``run``."""
        parts = self._table("partitions", run)
        if keep is not None:
            parts = parts.where(keep)
        # The runs that still own a partition, as literals: the scan lists no others.
        live = [r.run for r in parts.select("run").distinct().collect()]
        data = self.spark.read.schema(DATA).parquet(f"{self.store}/data").where(F.col("run").isin(live))
        if keep is not None:
            data = data.where(keep)
        return data.join(maybe_broadcast(parts), ["state", "day", "run"], "left_semi").drop("run")

    def read(self, col_maps: Mapping[str, Mapping[str, str]], days: Sequence | None = None, states: Sequence[str] | None = None, drop_null_provider: bool = True) -> DataFrame:
        """scan_recent_slice, reading side: the landed rows of some days and
        states (of all, if not given), as ``feeds.read_feeds`` returns them;
        other partitions are not read.  ``days`` may hold None for the rows
        without a parsable time."""
        run = self.commits.last()[1]
        if run is None:
            raise ValueError(f"nothing has been landed under {self.store}")
        keep = F.lit(True)
        if days is not None:
            keep = keep & F.col("day").isin([NO_DAY if d is None else str(d) for d in days])
        if states is not None:
            keep = keep & F.col("state").isin([s.strip().lower() for s in states])
        files = self._table("files", run)
        served = feeds.served_states(feeds.header_groups(files, files.withColumn("wanted", F.lit(False)), col_maps))
        without = [s for s, has in served.items() if not has]
        rows = self._current(run, keep)
        rows = rows.withColumn("_impute", F.col("state").isin(without)).withColumn("report_date", F.col("day").try_cast("date")).drop("day")
        return rows.where(F.col(EMC).isNotNull()) if drop_null_provider else rows

    def touched_since(self, number: int) -> DataFrame:
        """(state, day) pairs that the runs committed after ``number`` wrote anew."""
        out = self.spark.createDataFrame([], "state string, day string")
        for run in self.commits.after(number):
            out = out.unionByName(self._table("touched", run))
        return out.distinct()

    def recent_days(self, n: int) -> list:
        """The last ``n`` days that hold rows."""
        run = self.commits.last()[1]
        parts = self._table("partitions", run).where(F.col("day") != NO_DAY)
        return [r.day for r in parts.select("day").distinct().orderBy(F.desc("day")).limit(n).collect()]


def file_counters(landing: Landing) -> DataFrame:
    """(state, source_file, bytes, data_bytes, modified, day, n_rows): the
    counters of the landed files; a file without rows has one of day null."""
    files = landing.files().select("state", F.col("uri").alias("source_file"), "bytes", "data_bytes", "modified")
    return files.join(landing.days().select("source_file", "day", "n_rows"), "source_file", "left")
