"""Incremental daily run as a Structured Streaming query.

A file stream over the feed folder is the trigger: every micro-batch with
new files brings the landing up to date (see ``Landing``: it finds new, grown
and removed files itself and commits once) and replaces the results of the
days that the landing has written anew since the results were last brought up
to date.  That state is a commit of its own beside the results, so a batch
that fails in between is made good by the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.operators.standardize import standardize
from gridpulse.plans.jobs import Inputs, finish_from_reports
from gridpulse.session import maybe_broadcast, scratch_path
from gridpulse.sinks.commits import Commits
from gridpulse.sources import lookups
from gridpulse.sources.landing import Landing


def run_batch(spark: SparkSession, inp: Inputs, out_root: str) -> DataFrame:
    """Land what has changed and replace the results of the touched days;
    returns their (state, report_date) pairs."""
    if not inp.landing:
        raise ValueError("an incremental run needs a landing store")
    col_maps = lookups.col_map_dict(lookups.read_col_map(spark, inp.mapping_root))
    landing = Landing(spark, inp.landing)
    landing.land(inp.feeds_root, col_maps)
    number, run = landing.commits.last()
    applied = Commits(spark, f"{out_root}/_applied")
    touched = landing.touched_since(applied.last()[0])
    days = touched.select("state", F.col("day").try_cast("date").alias("report_date")).where("report_date is not null")
    if applied.last()[0] == number:
        return days
    rows = landing.read(col_maps).join(maybe_broadcast(days), ["state", "report_date"], "left_semi").drop("report_date")
    std = standardize(rows, lookups.read_county_map(spark, inp.mapping_root), run_keys=days)
    served = lookups.read_served_history(spark, inp.served_pattern) if inp.served_pattern else None
    finish_from_reports(
        spark, std, days, lookups.read_master_counties(spark, inp.mapping_root), served,
        lookups.read_fips(spark, inp.fips_path), out_root,
    )
    applied.add(run)
    return days


def run_incremental(
    spark: SparkSession,
    inp: Inputs,
    out_root: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
):
    """Start the stream (``availableNow``: process what is there, then stop)."""
    checkpoint = checkpoint or scratch_path(spark, "streams", "incremental-daily")
    files = (
        spark.readStream.format("binaryFile")
        .schema("path string, modificationTime timestamp, length long, content binary")
        .option("recursiveFileLookup", "true")
        .load(inp.feeds_root)
        .select("path", "modificationTime")     # content is never read
    )
    writer = files.writeStream.foreachBatch(lambda df, batch: run_batch(spark, inp, out_root)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=processing_time or "1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query
