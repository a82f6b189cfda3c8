"""Best-two-fit packing of token documents into fixed-length sequences.

A sequence is filled greedily with the longest documents that fit; then its
smallest document is replaced by two unpacked documents that together fit
the gap it leaves more tightly.  Documents of equal length are
interchangeable, so the fill is found on the table of lengths (at most
``capacity`` rows, whatever the corpus) and each fill is used for as many
sequences as its scarcest length allows.  The documents then take their
places by rank: Spark numbers the pieces within their length in two levels
(a hash part, then the part's prefix sum), so that a length that a third of
all rows share is numbered in parallel.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridpulse.llm.common import id_and_text, spool
from gridpulse.llm.tokens import encoder

# Pieces are numbered in about sqrt(n) / PARTS parts: both a part's share of one length and the parts of a length stay small.
PARTS = 40


def _two(counts: np.ndarray, room: int) -> tuple[int, int]:
    """The lengths (a, b) of two unpacked documents with the largest sum up to ``room``; (0, 0) if there are none."""
    sizes = np.flatnonzero(counts[: room + 1])
    if len(sizes) == 0:
        return 0, 0
    # The largest partner of each size; a size is its own partner only if there are two of it.
    at = np.searchsorted(sizes, room - sizes, side="right") - 1
    alone = (at >= 0) & (sizes[at] == sizes) & (counts[sizes] < 2)
    at = np.where(alone, at - 1, at)
    total = np.where(at >= 0, sizes + sizes[at], 0)
    best = int(np.argmax(total))
    return (int(sizes[best]), int(sizes[at[best]])) if total[best] else (0, 0)


def fill_one(counts: np.ndarray, capacity: int) -> list[int]:
    """One sequence's lengths, taken from ``counts`` (by length): greedy, then best two for the smallest."""
    left, gap, fill = counts.copy(), capacity, []
    while gap:
        fits = np.flatnonzero(left[: gap + 1])
        if len(fits) == 0:
            break
        size = int(fits[-1])
        n = min(int(left[size]), gap // size)
        fill += [size] * n
        left[size] -= n
        gap -= n * size
    while gap and len(fill) > 1:
        smallest = fill[-1]
        a, b = _two(left, gap + smallest)
        if a + b <= smallest:
            break
        fill.pop()
        left[smallest] += 1
        for size in (a, b):
            fill.append(size)
            left[size] -= 1
        gap += smallest - a - b
        fill.sort(reverse=True)
    return fill


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs (length, first rank, ranks, documents of this length a sequence, offset, first sequence).

    The ranks of a length from ``first rank`` on stand in consecutive
    sequences.  A fill is repeated until its scarcest length falls below its
    use, so there are about as many fills as different lengths.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    taken, sequence, runs = Counter(), 0, []
    while counts.any():
        use = Counter(fill_one(counts, capacity))
        times = min(int(counts[size]) // n for size, n in use.items())
        offset = 0
        for size, n in use.items():
            runs.append((size, taken[size], times * n, n, offset, sequence))
            taken[size] += times * n
            counts[size] -= times * n
            offset += size * n
        sequence += times
    return runs


def token_pieces(docs: DataFrame, capacity: int, end_id: int, tokenizer_path: str, kind: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids with the
    end id, cut into pieces of ``capacity`` only if longer; the first piece
    takes the remainder."""
    end = np.array([end_id], "<u4").tobytes()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer_path, kind).encode
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text) + end
                n = len(ids) // 4
                bounds = [0, *range((n - 1) % capacity + 1, n + 1, capacity)]
                out += [(doc_id, i, lo, hi - lo, zlib.crc32(ids[4 * lo : 4 * hi])) for i, (lo, hi) in enumerate(zip(bounds, bounds[1:], strict=False))]
            cols = list(zip(*out, strict=True)) or [()] * 5
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            names = ("doc_id", "piece", "start", "length", "ids_crc32")
            yield pa.RecordBatch.from_pydict({k: pa.array(c, t) for k, c, t in zip(names, cols, kinds, strict=True)})

    return docs.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    kind: str = "byte",
    capacity: int = 1024,
    end_id: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` tokens.

    Returns one row per piece: doc_id, piece (from 0), start (ids of the
    document before it), length, ids_crc32 (of the little-endian unsigned
    32-bit ids), sequence_id, offset (place in the sequence, without gaps).

    Defined cases: a null or empty text is one piece holding the end id;
    documents longer than ``capacity`` are cut from their end, so only the
    first piece is shorter; equal lengths are ranked by hash part, id and
    piece; repeated rows and null ids are packed like any other row; an empty
    table gives an empty result; other columns are ignored.
    """
    cut = spool(token_pieces(id_and_text(docs, id_col, text_col), capacity, end_id, tokenizer_path, kind), "pack-pieces")
    parts = math.isqrt(cut.count()) // PARTS + 1
    pieces = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(parts)).cast("int"))
    sizes = spool(pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n")), "pack-lengths")
    histogram = {r["length"]: r["n"] for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    before = F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    place = F.row_number().over(W.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32"))
    ranked = pieces.withColumn("place", place).join(sizes.select("length", "part", before.alias("before")), ["length", "part"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("place") - 1).alias("rank"))

    runs = np.array(sorted(plan(histogram, capacity)), np.int64).reshape(-1, 6)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = {int(x): runs[runs[:, 0] == x] for x in np.unique(runs[:, 0])}
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            sequence, offset = np.empty_like(rank), np.empty_like(rank)
            for size in np.unique(length):
                own = firsts[int(size)]
                mine = length == size
                run = own[np.searchsorted(own[:, 1], rank[mine], side="right") - 1]
                nth = rank[mine] - run[:, 1]
                sequence[mine] = run[:, 5] + nth // run[:, 3]
                offset[mine] = run[:, 4] + nth % run[:, 3] * size
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence), pa.array(offset)], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(placed, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
