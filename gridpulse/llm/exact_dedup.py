"""Exact dedup on an extendible-hash index kept in shared files.

The key of a document is the 64-bit hash of its normalised text.  The
directory addresses buckets by the leading bits of the key.  It starts with
one bucket and doubles while a bucket is overfull: the bucket is split on its
next bit, the others keep their local depth.  Bucket sizes come from a
histogram over leading bits, taken ``STEP`` bits at a time and only under
buckets that are still overfull, so the driver sees bucket counts, no keys.

Documents enter the index as entries.  A key that only one document has is
one entry without its text.  The texts of a repeated key travel: the rows of
a task that agree in key and bytes are one entry with their number and
largest id, so a text that a third of all rows hold is one entry per task.
The directory puts every entry into its bucket; buckets are ranges of the
key, and an owner task gets a range of them.  There the entries of one key
form a chain in the order of their bytes, every entry is compared with the
one before it byte by byte, and a new link begins where they differ.  A
link's entries give keep_id and group_size, whichever tasks they came from.
The links are the index's files; a document finds its own through the
directory, by bucket, key and the hash of its text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridpulse.llm.common import ascii_lower, id_and_text, spool
from gridpulse.session import maybe_broadcast

# Bits by which the directory grows per histogram: 2**STEP counts per overfull bucket.
STEP = 8


def _key(norm, bits: int):
    """The leading ``bits`` of the text's hash, left-aligned in 64 bits."""
    h = F.xxhash64(norm)
    return h if bits == 64 else h.bitwiseAND(F.lit(-(1 << (64 - bits))))


def _prefix(bits: int):
    """The leading ``bits`` of the key as a number."""
    return F.shiftrightunsigned("key", 64 - bits) if bits else F.lit(0).cast("long")


def build_directory(entries: DataFrame, capacity: int, max_bits: int) -> list[tuple[int, int, int]]:
    """Leaves (prefix, local depth, keys) of the extendible-hash directory over rows (key), each key once.

    Splitting stops at ``max_bits``: keys that agree in all bits chain in one
    bucket.  Hashed keys fill the leaves evenly, so their number is a few
    times ``entries / capacity``.
    """
    leaves: list[tuple[int, int, int]] = []
    full = [(0, 0, 0)]
    depth = 0
    while full:
        step = min(STEP, max_bits - depth)
        under = entries
        if depth:
            overfull = entries.sparkSession.createDataFrame([(p,) for p, _, _ in full], "p long")
            under = entries.join(overfull, _prefix(depth) == F.col("p"), "left_semi")
        counted = {r["p"]: r["n"] for r in under.groupBy(_prefix(depth + step).alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()}
        todo, full = [(p, depth) for p, _, _ in full], []
        while todo:
            p, d = todo.pop()
            width = depth + step - d
            n = sum(counted.get((p << width) + i, 0) for i in range(1 << width))
            if n <= capacity or d == max_bits:
                leaves.append((p, d, n))
            elif d == depth + step:
                full.append((p, d, n))
            else:
                todo += [(2 * p, d + 1), (2 * p + 1, d + 1)]
        depth += step
    return sorted(leaves, key=lambda x: x[0] << (64 - x[1]))


def bucketed(rows: DataFrame, leaves: list[tuple[int, int, int]]) -> DataFrame:
    """Rows (key, ..) with the bucket that the directory has for their key."""
    directory = rows.sparkSession.createDataFrame([(d, p, i) for i, (p, d, _) in enumerate(leaves)], "depth int, prefix long, bucket int")
    # A leaf is the key range under its prefix; keys look it up at each local depth in use.
    depths = sorted({d for _, d, _ in leaves})
    at = F.inline(F.array(*[F.struct(F.lit(d).alias("depth"), _prefix(d).alias("prefix")) for d in depths]))
    return rows.select("*", at).join(maybe_broadcast(directory), ["depth", "prefix"]).drop("depth", "prefix")


def entries_of(docs: DataFrame, short: DataFrame, counts: DataFrame, key_bits: int) -> DataFrame:
    """(key, sha, norm, id, n): the documents of a key alone, without text,
    and those of repeated keys, summed in their tasks, with their text."""
    alone = short.join(counts.where("n = 1").select("key"), "key").select("key", "sha", F.lit(None).cast("string").alias("norm"), F.col("doc_id").alias("id"), F.lit(1).cast("long").alias("n"))
    norm = ascii_lower(F.col("text"))
    texts = docs.select("doc_id", norm.alias("norm"), _key(norm, key_bits).alias("key"))
    # A merge join at every size: the repeated keys grow with the rows.
    texts = texts.join(counts.where("n > 1").select("key").hint("merge"), "key", "left_semi").withColumn("task", F.spark_partition_id())
    summed = texts.groupBy("task", "key", "norm").agg(F.max("doc_id").alias("id"), F.count(F.lit(1)).alias("n"))
    return alone.union(summed.select("key", F.sha2("norm", 256).alias("sha"), "norm", "id", "n"))


def build_index(docs: DataFrame, short: DataFrame, capacity: int | None, key_bits: int) -> tuple[DataFrame, list[tuple[int, int, int]]]:
    """The index, read back from its files, and its directory: one row per
    different text with bucket, key, chain (place among the texts of this
    key), sha (of the normalised text), keep_id and group_size."""
    counts = spool(short.groupBy("key").agg(F.count(F.lit(1)).alias("n")), "dedup-keys")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = build_directory(counts, capacity or counts.count() // (4 * parts) + 1, key_bits)
    owners = max(1, min(len(leaves), parts))
    owned = bucketed(entries_of(docs, short, counts, key_bits), leaves).repartitionByRange(owners, "bucket")
    along = W.partitionBy("bucket", "key").orderBy("norm")
    begins = F.lag("norm").over(along).eqNullSafe(F.col("norm")).cast("int")
    # A chain's first entry has no neighbour; its lag is null, like the text of a key alone.
    linked = owned.withColumn("new", F.when(F.row_number().over(along) == 1, 1).otherwise(1 - begins))
    linked = linked.withColumn("chain", F.sum("new").over(along.rowsBetween(W.unboundedPreceding, W.currentRow)))
    links = linked.groupBy("bucket", "key", "chain").agg(F.max("id").alias("keep_id"), F.sum("n").alias("group_size"), F.first("sha").alias("sha"))
    return spool(links.sortWithinPartitions("bucket", "key", "chain"), "dedup-index"), leaves


def exact_dedup(
    docs: DataFrame,
    capacity: int | None = None,
    key_bits: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Class of every document under equality of texts after lower-casing A-Z.

    Returns one row per input row: doc_id, keep_id (the largest id of the
    class, the row that stays), group_size, kept, text_sha256 (lowercase hex
    of the normalised text), bucket and chain (place in the index).
    ``capacity`` is the number of different keys a bucket holds before it is
    split (by default a quarter of a shuffle partition's even share, so that
    the directory grows with the cluster and not with the keys); ``key_bits`` shortens the key, which only lengthens the chains.

    Defined cases: null text is the empty text; a null id never wins against
    a number, and a class of null ids only has a null keep_id and keeps all
    its rows; rows that repeat an id and its text are returned as often as
    given, all with the same values; an empty table gives an empty result;
    other columns are ignored.
    """
    rows = id_and_text(docs, id_col, text_col)
    norm = ascii_lower(F.col("text"))
    short = spool(rows.select("doc_id", _key(norm, key_bits).alias("key"), F.sha2(norm, 256).alias("sha")), "dedup-rows")
    index, leaves = build_index(rows, short, capacity, key_bits)
    return (
        bucketed(short, leaves)
        .join(index, ["bucket", "key", "sha"])
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.col("sha").alias("text_sha256"),
            "bucket",
            "chain",
        )
    )
