"""Training-data pipeline: five stages over ``documents``, each one operator.

Every stage reads the Parquet output of the one before.  All but the last
return the columns of documents; the last returns packed pieces.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridpulse.llm.common import fold_share, spool
from gridpulse.llm.decontaminate import contamination
from gridpulse.llm.language_id import UND, identify_language
from gridpulse.llm.line_dedup import line_dedup
from gridpulse.llm.packing import pack
from gridpulse.llm.simhash_dedup import simhash_classes
from gridpulse.session import maybe_broadcast, unique_scratch

# A text whose n-grams lie further from every profile is in none of the learnt languages.
LEAST_SCORE = 0.15
# Key of a stage's rows, and what it is made of: a file's number and the row's place in the file.
ROW, FILE, PLACE = "__row", "__file", "__place"
PLACE_BITS = 40


def _keyed(docs: DataFrame) -> DataFrame:
    """The rows with a key of their own, ``ROW``: ids may be null or repeated,
    and decisions belong to rows.  Parquet files number their rows, so the key
    is the same whenever the files are read again and nothing is copied; rows
    from elsewhere are written out with their key."""
    try:
        placed = docs.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(PLACE))
    except AnalysisException:
        return spool(docs.withColumn(ROW, F.monotonically_increasing_id()), "pipeline-rows")
    number = F.row_number().over(W.orderBy(FILE)).cast("long")
    files = spool(placed.select(FILE).distinct().select(FILE, number.alias("__number")), "pipeline-files")
    key = F.shiftleft("__number", PLACE_BITS) + F.col(PLACE)
    return placed.join(maybe_broadcast(files), FILE).select(*[placed[c] for c in docs.columns], key.alias(ROW))


def _keep(docs: DataFrame, rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Keyed ``rows`` whose key is (``left_semi``) or is not (``left_anti``) the doc_id of ``keys``, as in ``docs``."""
    return rows.join(keys.select(F.col("doc_id").alias(ROW)).distinct(), ROW, how).select(*docs.columns)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that the labelled documents teach."""
    rows = _keyed(docs)
    found = identify_language(rows, fold_share("doc_id") != 0, id_col=ROW)
    rejected = found.where((F.col("lang_pred") == UND) | (F.col("score") < LEAST_SCORE))
    return _keep(docs, rows, rejected, "left_anti")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more documents (rows) share."""
    rows = _keyed(docs)
    kept = line_dedup(rows, min_docs=10, min_chars=1, id_col=ROW).where("n_dropped > 0")
    kept = kept.select(F.col("doc_id").alias(ROW), F.col("text").alias("__kept"))
    joined = rows.join(kept, ROW, "left")
    text = F.coalesce("__kept", rows["text"])
    out = {"text": text, "n_chars": F.char_length(text).cast(docs.schema["n_chars"].dataType)}
    return joined.select(*[out[c].alias(c) if c in out else rows[c] for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of every near-duplicate class: the first of the smallest id
    (of a class without any id, its first row)."""
    rows = _keyed(docs)
    classes = simhash_classes(rows, width=3, radius=3, id_col=ROW).select(F.col("doc_id").alias(ROW), "component_id")
    order = F.struct(rows["doc_id"].isNull(), rows["doc_id"], F.col(ROW).alias("row"))
    first = rows.join(classes, ROW).groupBy("component_id").agg(F.min(order).alias("first"))
    return _keep(docs, rows, first.select(F.col("first.row").alias("doc_id")), "left_semi")


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    rows = _keyed(docs)
    found = contamination(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=ROW)
    return _keep(docs, rows, found, "left_anti")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces, packed into sequences of 1024 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), "byte", capacity=1024, end_id=2)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_stage),
    ("line_dedup", line_stage),
    ("simhash_near_dedup", near_duplicate_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]

# Tokenizing and SimHash over XXH64 are not expressible in DuckDB SQL; tests hold the pipeline against a brute-force version.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and
    read again; a stage's rows go once the next stage's are written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = unique_scratch(spark, f"llm/pipeline-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            _remove(spark, before)
        before = path
    return docs


def _remove(spark: SparkSession, path: str) -> None:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
