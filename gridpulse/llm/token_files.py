"""Token ids in files: frequency-ranked, byte-aligned variable-length coding.

Ids are replaced by their frequency rank over the whole corpus, so common
tokens are small numbers.  A rank takes one to four data bytes; its byte
count goes, two bits each, into a separate control stream (four ranks a
control byte).  A decoder looks the control bytes up in a table of lengths
and gathers the data bytes with numpy, without a branch per token.

The files are Parquet shards in the shared folder, written and read by Spark.
A row is a block of whole documents: shard, block, first, doc_ids, lengths,
control, data.  Shards are ranges of doc_id, blocks follow each other in a
shard, so (shard, block) is ascending doc_id order.  ``ranks`` beside them
holds the id of every rank.  The tokenizing pass counts the ids as it goes,
so texts and ids are read once before the files are written.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridpulse.llm.common import id_and_text, spool
from gridpulse.llm.tokens import encoder

# Tokens after which a block is closed.
BLOCK_TOKENS = 1 << 16
# Bytes of each of the four ranks behind a control byte.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.int64) + 1


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """(control, data) of unsigned 32-bit ranks."""
    ranks = ranks.astype("<u4")
    size = 1 + (ranks > 0xFF).astype(np.uint8) + (ranks > 0xFFFF) + (ranks > 0xFFFFFF)
    codes = np.zeros((len(ranks) + 3) // 4 * 4, np.uint8)
    codes[: len(ranks)] = size - 1
    control = codes[0::4] | codes[1::4] << 2 | codes[2::4] << 4 | codes[3::4] << 6
    used = np.arange(4) < size[:, None]
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` ranks, by lookup of the control bytes' lengths."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(size) - size
    raw = np.concatenate((np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)))
    out = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        out[more] |= raw[at[more] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def encoded(docs: DataFrame, tokenizer_path: str, kind: str, end_id: int) -> DataFrame:
    """(doc_id, h, width, payload, counts): every whole text's ids and the end
    id, in 2 bytes each where the vocabulary allows it, else in 4, with their
    hash; and from every task one row more, the counts of its ids."""
    end = np.array([end_id], "<u4").tobytes()

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer_path, kind)
        size = max(own.tokenizer.get_vocab_size(), end_id + 1)
        width = "<u2" if size <= 1 << 16 else "<u4"
        total = np.zeros(size, np.int64)
        for batch in batches:
            ids = [np.frombuffer(own.encode(text) + end, "<u4").astype(width) for text in batch.column(1).to_pylist()]
            if ids:
                total += np.bincount(np.concatenate(ids), minlength=size)
            payload = [x.tobytes() for x in ids]
            h = [xxhash.xxh64_intdigest(x) - (1 << 63) for x in payload]
            yield _payloads(batch.column(0), h, [int(width[-1])] * len(ids), payload, [None] * len(ids))
        used = np.flatnonzero(total)
        yield _payloads([None], [None], [None], [None], [np.concatenate((used, total[used])).tobytes()])

    return docs.mapInArrow(tokenized, "doc_id long, h long, width int, payload binary, counts binary")


def _payloads(doc_id, h: list, width: list, payload: list, counts: list) -> pa.RecordBatch:
    doc_id = doc_id if isinstance(doc_id, pa.Array) else pa.array(doc_id, pa.int64())
    return pa.RecordBatch.from_arrays(
        [doc_id, pa.array(h, pa.int64()), pa.array(width, pa.int32()), pa.array(payload, pa.binary()), pa.array(counts, pa.binary())],
        names=["doc_id", "h", "width", "payload", "counts"],
    )


def id_counts(payloads: DataFrame) -> DataFrame:
    """(id, n) over all documents, from the tasks' counts."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                ids, n = np.frombuffer(packed, np.int64).reshape(2, -1)
                yield pa.RecordBatch.from_pydict({"id": ids, "n": n})

    counts = payloads.where("counts is not null").select("counts")
    return counts.mapInArrow(split, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str, kind: str = "word", end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode all documents and write ``path``/ranks and ``path``/blocks.

    Every document ends with ``end_id``.  Defined cases: a null or empty text
    is the end id alone; null ids come first; rows that repeat an id stay
    separate documents, next to each other; an empty table writes no block;
    other columns are ignored.  A long document is one block of its own.
    """
    payloads = spool(encoded(id_and_text(docs, id_col, text_col), tokenizer_path, kind, end_id), "token-payloads")
    counts = id_counts(payloads).collect()  # at most one row per vocabulary entry
    by_rank = np.array([r["id"] for r in sorted(counts, key=lambda r: (-r["n"], r["id"]))], np.int64)
    spark = docs.sparkSession
    spark.createDataFrame([(i, int(x)) for i, x in enumerate(by_rank)], "rank long, id long").coalesce(1).write.parquet(f"{path}/ranks")
    rank_of = np.zeros(int(by_rank.max(initial=0)) + 1, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, block = TaskContext.get().partitionId(), 0
        ids: list[np.ndarray] = []
        owners: list[int | None] = []
        held = 0

        def closed() -> pa.RecordBatch:
            control, data = encode_ranks(np.concatenate(ids))
            row = {"shard": shard, "block": block, "tokens": held, "doc_ids": list(owners), "lengths": [len(x) for x in ids], "control": control, "data": data}
            return pa.RecordBatch.from_pylist([row], schema=BLOCK_ARROW)

        for batch in batches:
            for doc_id, width, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = rank_of[np.frombuffer(payload, f"<u{width}")]
                if held and held + len(own) > BLOCK_TOKENS:
                    yield closed()
                    block, ids, owners, held = block + 1, [], [], 0
                ids.append(own), owners.append(doc_id)
                held += len(own)
        if held:
            yield closed()

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The payload's hash is the second key, so rows of one id, or without any, are spread over tasks as well.
    ordered = payloads.where("counts is null").select("doc_id", "h", "width", "payload").repartitionByRange(parts, "doc_id", "h").sortWithinPartitions("doc_id", "h")
    ordered.select("doc_id", "width", "payload").mapInArrow(blocks, BLOCK).write.parquet(f"{path}/blocks")


BLOCK = "shard int, block int, tokens long, doc_ids array<long>, lengths array<long>, control binary, data binary"
BLOCK_ARROW = pa.schema(
    [
        ("shard", pa.int32()), ("block", pa.int32()), ("tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())), ("control", pa.binary()), ("data", pa.binary()),
    ]
)


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document of the files: doc_id, start (ids of all documents
    before it), n_tokens, ids_crc32 (of the ids as below) and, unless it is
    left out, ids (little-endian unsigned 32-bit, as binary)."""
    blocks = spark.read.schema(BLOCK).parquet(f"{path}/blocks")
    ids = np.array([r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], "<u4")
    # Prefix sums in two levels: over the shards (as many as partitions wrote), then over a shard's blocks.
    shards = blocks.groupBy("shard").agg(F.sum("tokens").alias("n"))
    before = F.coalesce(F.sum("n").over(W.orderBy("shard").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    inside = F.coalesce(F.sum("tokens").over(W.partitionBy("shard").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = blocks.select("shard", "block", inside.alias("inside")).join(shards.select("shard", before.alias("before")), "shard")
    starts = spool(starts.select("shard", "block", (F.col("before") + F.col("inside")).alias("start")), "token-starts")
    placed = blocks.join(starts, ["shard", "block"]).select("start", "doc_ids", "lengths", "control", "data")

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lengths = np.array(row["lengths"], np.int64)
                ends = np.cumsum(lengths)
                raw = memoryview(ids[decode_ranks(row["control"], row["data"], int(ends[-1]))]).cast("B")
                own = [raw[4 * (b - n) : 4 * b] for b, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
                out = {
                    "doc_id": pa.array(row["doc_ids"], pa.int64()),
                    "start": row["start"] + ends - lengths,
                    "n_tokens": lengths,
                    "ids_crc32": pa.array([zlib.crc32(x) for x in own], pa.int64()),
                }
                if with_ids:
                    out["ids"] = pa.array([x.tobytes() for x in own], pa.binary())
                yield pa.RecordBatch.from_pydict(out)

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return placed.mapInArrow(decode, schema)
