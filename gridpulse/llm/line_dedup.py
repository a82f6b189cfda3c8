"""Line dedup on levelled sorted runs of line hashes.

A run is a table of (h1, h2, n): the 128-bit hash of a line key and the
number of documents that hold it, bucketed and sorted by the hash.  Every
batch of documents is merge-anti-joined with the runs: a key that some run
already shows in ``min_docs`` documents is settled and needs no further
rows; all other keys of the batch become a new run of level 0.  When a level
holds ``fanout`` runs they are compacted into one run of the next level.
A key is common if its counts over all runs reach ``min_docs``.

The runs are bucketed tables in the shared scratch folder, so the anti-joins
do not shuffle a run again; only the batch moves.  Compaction re-sums the
runs of one level, once per level.
Counting is per key with partial sums, so a line that every document has
costs one row per task.  Lines of common keys are found by an equi-join
whose skewed side Spark's adaptive execution splits.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.llm.common import BLANKS, ascii_lower, id_and_text, spool
from gridpulse.session import unique_scratch

KEY = ["h1", "h2"]


class LineRuns:
    """Levelled runs of line hashes; the driver holds their table names only."""

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = 4, buckets: int | None = None):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.root = unique_scratch(spark, "llm/line-runs")
        self.levels: list[list[str]] = [[]]
        self.written: list[str] = []

    def _write(self, counts: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        (
            counts.repartition(self.buckets, *KEY)
            .write.bucketBy(self.buckets, *KEY)
            .sortBy(*KEY)
            .option("path", f"{self.root}/{name}")
            .saveAsTable(name)
        )
        self.written.append(name)
        return name

    def _merged(self, names: list[str]) -> DataFrame:
        # Read as plain files: a union of bucketed scans is taken for partitioned by key, but its
        # partitions are not lined up (seen with Spark 4.1.2), so sums over it would stay partial.
        files = self.spark.read.schema("h1 long, h2 long, n long").parquet(*[f"{self.root}/{n}" for n in names])
        return files.groupBy(*KEY).agg(F.sum("n").alias("n"))

    def add(self, batch: DataFrame) -> None:
        """Add one batch: rows (h1, h2, n), each key once."""
        fresh = batch.select(*KEY, "n").repartition(self.buckets, *KEY)
        for name in self.names():
            settled = self.spark.table(name).where(F.col("n") >= self.min_docs).select(*KEY)
            fresh = fresh.join(settled.hint("merge"), KEY, "left_anti")
        self.levels[0].append(self._write(fresh))
        for level in range(len(self.levels)):
            if len(self.levels[level]) >= self.fanout:
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._write(self._merged(self.levels[level])))
                self.levels[level] = []

    def names(self) -> list[str]:
        return [n for level in self.levels for n in level]

    def common(self) -> DataFrame:
        """Keys found in at least ``min_docs`` documents."""
        return self._merged(self.names()).where(F.col("n") >= self.min_docs).select(*KEY)

    def close(self) -> None:
        """Take the runs out of the catalog; their files stay in the scratch folder."""
        for name in self.written:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")


def line_occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, th, h1, h2, positions): for every document and line key of at
    least ``min_chars`` code points, the places of its lines (from 0)."""
    lines = docs.select(
        "doc_id",
        F.xxhash64("text").alias("th"),
        F.posexplode(F.split(ascii_lower(F.col("text")), "\n", -1)).alias("pos", "line"),
    ).withColumn("line", F.btrim("line", F.lit(BLANKS)))
    return (
        lines.where(F.char_length("line") >= min_chars)
        .select("doc_id", "th", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit("line"), "line").alias("h2"))
        .groupBy("doc_id", "th", *KEY)
        .agg(F.collect_set("pos").alias("positions"))
    )


def line_dedup(
    docs: DataFrame,
    min_docs: int = 10,
    min_chars: int = 1,
    batches: int = 4,
    fanout: int = 3,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Drop every line whose key stands in at least ``min_docs`` documents.

    A line's key is the line without blanks ``[\\x20\\x09-\\x0D]`` at its ends,
    A-Z lower-cased; keys shorter than ``min_chars`` code points always stay.
    Returns one row per input row: doc_id, text (kept lines joined by line
    feeds), n_lines, n_dropped.

    Defined cases: null or empty text is one empty line; a document whose
    lines all go has the empty text; a row that repeats another one's id and
    text is the same document (counted once, returned as often as given);
    equal ids with different texts are different documents, and so are null
    ids with different texts; an empty table gives an empty result; other
    columns are ignored.  Keys are compared by 128 bits of hash.
    """
    spark = docs.sparkSession
    rows = id_and_text(docs, id_col, text_col)
    occ = spool(line_occurrences(rows, min_chars), "line-occurrences")
    batch = F.pmod(F.xxhash64("doc_id", "th"), F.lit(batches))
    counts = spool(
        occ.groupBy(batch.alias("batch"), *KEY).agg(F.count(F.lit(1)).alias("n")), "line-batches", partition_by="batch"
    )
    runs = LineRuns(spark, min_docs, fanout)
    for b in range(batches):
        runs.add(counts.where(F.col("batch") == b))
    common = spool(runs.common(), "line-common")
    runs.close()
    drops = (
        occ.join(common, KEY)
        .groupBy("doc_id", "th")
        .agg(F.array_sort(F.flatten(F.collect_list("positions"))).alias("drop"))
    )
    drops = spool(drops, "line-drops").select(F.col("doc_id").alias("d_id"), F.col("th").alias("d_th"), "drop")
    lines = F.split("text", "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("drop"))
    return (
        rows.withColumn("th", F.xxhash64("text"))
        .join(drops, F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("th") == F.col("d_th")), "left")
        .select(
            "doc_id",
            F.when(F.col("drop").isNull(), F.col("text"))
            .otherwise(F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n"))
            .alias("text"),
            F.size(lines).cast("long").alias("n_lines"),
            F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
        )
    )
