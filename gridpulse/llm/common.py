"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridpulse.session import unique_scratch

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"
# The blanks of the contracts: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; every other character stays."""
    return F.translate(text, UPPER, LOWER)


# Rows that an Arrow batch holds at most.  Texts are long, and a batch exists several times on its way
# (JVM, Arrow, Python strings), so Spark's default of 10,000 rows would need gigabytes an executor.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batch size to ``BATCH_ROWS`` if it is larger."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator works on, so extra columns never clash; null text is empty."""
    small_batches(docs.sparkSession)
    return docs.select(docs[id_col].cast("long").alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))


def spool(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to the shared scratch folder and read it back: cuts the
    lineage with files that outlive any executor."""
    path = unique_scratch(df.sparkSession, f"llm/{name}")
    writer = df.write.partitionBy(partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spool_narrow(df: DataFrame, name: str) -> DataFrame:
    """``spool`` for rows of a few numbers: an eighth of the shuffle partitions
    hold them, so that many rounds of small tables do not become many files."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return spool(df.coalesce(max(1, parts // 8)), name)


def fold_share(id_col: Column | str, folds: int = 5) -> Column:
    """crc32 of the id written as text, modulo ``folds`` (a null id counts as fold 0)."""
    col = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(F.encode(col.cast("string"), "UTF-8")) % folds, F.lit(0))


# Lower-cases A-Z and turns every other ASCII character but digits and letters into a blank.
_PLAIN = bytes(
    c + 32 if 0x41 <= c <= 0x5A else c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)


def plain_words(text: str) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, as UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(_PLAIN).split()
