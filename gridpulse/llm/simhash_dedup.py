"""SimHash near-dedup by covering locality-sensitive hashing.

Every bit place of the 64-bit fingerprint gets a non-zero label of r + 1
bits, and every non-zero vector v of r + 1 bits is one table: its mask holds
the places whose label has an odd product with v.  The labels of r places
span at most r dimensions, so some v is orthogonal to all of them: two
fingerprints that differ in at most r places agree under that table's whole
mask.  So all pairs within the radius meet in one of the 2^(r+1) - 1 tables,
with no error probability.

Copies collapse first: links are sought between different fingerprints, each
standing for its smallest document.  A table's bucket is searched in
vectorised blocks and returns a spanning forest of its links (at most one per
member), not its pairs.  A bucket of more than ``block`` members is split
into blocks by the fingerprint's hash, and every pair of blocks becomes its
own group, so no task ever holds more than two blocks of a bucket.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import id_and_text, spool
from gridpulse.llm.components import components

SEED = 42
# Shingles whose bits are counted at once, so a very long text needs little memory.
CHUNK = 1 << 15


def fingerprint(text: str, width: int) -> int:
    """SimHash of a text's ``width``-word shingles (repeats count), unsigned;
    a bit is set if more than half of the shingle hashes set it."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    n = max(1, len(words) - width + 1)
    starts = [0, *(ends[: n - 1] + 1).tolist()]
    stops = ends[min(width, len(words)) - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for lo in range(0, n, CHUNK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[lo : lo + CHUNK], stops[lo : lo + CHUNK], strict=True)], dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, fp): the signed 64-bit fingerprint of every whole text."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.array([fingerprint(t, width) for t in batch.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "fp": fps})

    return docs.select("doc_id", "text").mapInArrow(hashed, "doc_id long, fp long")


def covering_masks(radius: int) -> list[int]:
    """The 2^(radius+1) - 1 masks over 64 bit places."""
    size = 1 << (radius + 1)
    labels = [1 + place % (size - 1) for place in range(64)]
    return [sum(1 << place for place, label in enumerate(labels) if (label & v).bit_count() % 2) for v in range(1, size)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def bucket_forest(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Spanning forest (index pairs) of the links among different fingerprints."""
    left = np.arange(len(fps))
    links = []
    while len(left):
        frontier, left = [left[0]], left[1:]
        while frontier and len(left):
            at = frontier.pop()
            near = np.bitwise_count(fps[left] ^ fps[at]) <= radius
            links += [(at, j) for j in left[near]]
            frontier += list(left[near])
            left = left[~near]
    return links


def fingerprint_links(distinct: DataFrame, radius: int, block: int) -> DataFrame:
    """(a, b): links between the rows (fp, node) of different fingerprints,
    enough of them that linked components are those of all pairs in the radius."""
    masks = [_signed(m) for m in covering_masks(radius)]
    member: Column = F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(m)) for m in masks]))
    members = distinct.select("fp", "node", member.alias("tab", "key"))
    sizes = members.groupBy("tab", "key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    sizes = spool(sizes, "simhash-buckets")
    blocks = F.ceil(F.col("members") / block).cast("int")
    own = F.pmod(F.xxhash64("fp"), blocks).cast("int")
    met = members.join(sizes, ["tab", "key"]).select("fp", "node", "tab", "key", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    grouped = met.select("tab", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp", "node")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def forest(fps: np.ndarray, nodes: np.ndarray) -> pa.RecordBatch:
            pairs = np.array(bucket_forest(fps, radius), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_pydict({"a": nodes[pairs[:, 0]], "b": nodes[pairs[:, 1]]})

        rest: list[np.ndarray] | None = None
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if rest is not None:
                cols = [np.concatenate(x) for x in zip(rest, cols, strict=True)]
            new = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:4]], axis=0)) + 1
            bounds = [0, *new.tolist()]
            out = []
            for lo, hi in zip(bounds, bounds[1:], strict=False):
                if hi - lo > 1:
                    out.append(forest(cols[4][lo:hi].view(np.uint64), cols[5][lo:hi]))
            if out:
                yield from pa.Table.from_batches(out).combine_chunks().to_batches()
            rest = [c[bounds[-1] :] for c in cols]
        if rest is not None and len(rest[0]) > 1:
            yield forest(rest[4].view(np.uint64), rest[5])

    keys = ["tab", "key", "lo", "hi"]
    placed = grouped.repartition(*keys).sortWithinPartitions(*keys)
    return placed.mapInArrow(linked, "a long, b long")


def simhash_classes(docs: DataFrame, width: int = 3, radius: int = 3, block: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Near-duplicate class of every document.

    Shingles are ``width`` words ``[^\\x20\\x09-\\x0D]+`` after lower-casing
    A-Z, repeats included (a shorter text is one shingle); documents link if
    their fingerprints differ in at most ``radius`` bits.  Returns one row per
    input row: doc_id, fp, component_id (smallest doc_id reachable over
    links, the row's own included).

    Defined cases: a null text, or one without words, has fingerprint 0 and
    links like any other; a row with a null id gets its fingerprint and a
    null component if no numbered row shares that fingerprint (null ids
    never stand for others); repeated rows get equal
    answers, and rows that share an id but not the text are classed each by
    its own text; an empty table
    gives an empty result; other columns are ignored.
    """
    rows = spool(fingerprints(id_and_text(docs, id_col, text_col), width), "simhash-fingerprints")
    distinct = spool(rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node")), "simhash-distinct")
    found = spool(fingerprint_links(distinct, radius, block), "simhash-links")
    root = components(found)
    classes = distinct.join(root, "node", "left").select("fp", F.coalesce("component", "node").alias("component_id"))
    return rows.join(classes, "fp", "left").select("doc_id", "fp", "component_id")
