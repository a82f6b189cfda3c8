"""Hard-negative mining by angular triangle filtering.

Every row stores its norm and its angles to a few reference directions.  The
angle between two rows is at least the largest difference and at most the
smallest sum of their angles to a reference (the triangle inequality on the
sphere).  Its cosine, multiplied by both norms and widened by a margin for
rounding, bounds their score.  Only pairs whose bounds overlap a score window
are scored, in integers.

Anchors are the queries: they are taken in blocks of bounded size, and every
block is searched for in all rows, which stay where they are.  A task keeps
the best rows of every window only, and its bounds tighten as it reads; the
tasks' best are merged by a grouped rank.  So a label or a vector that a
third of all rows share is read like any other.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridpulse.llm.common import spool

SCALE = 256
# Reference directions, and the rows from which they are chosen.
REFERENCES, SAMPLE = 16, 2048
# Anchors of a pass over all rows (with their vectors broadcast), and of a step of it.
PASS_ANCHORS, STEP_ANCHORS = 4096, 128
BATCH_ROWS = 4096
# Share of the product of both norms by which bounds are widened: angles of 64-bit cosines are off by some 1e-7.
MARGIN = 1e-6


def usable(rows: DataFrame, id_col: str, label_col: str, vector_col: str) -> DataFrame:
    """(vec_id, label, v): rows whose id, label and components are all there
    and finite, one for every id, components as integers."""
    vector = rows[vector_col]
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    kept = rows.where(rows[id_col].isNotNull() & rows[label_col].isNotNull() & vector.isNotNull() & ~bad)
    whole = F.transform(kept[vector_col], lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    row = F.struct(kept[label_col].cast("long").alias("label"), whole.alias("v"))
    return kept.select(kept[id_col].cast("long").alias("vec_id"), row.alias("row")).groupBy("vec_id").agg(F.min("row").alias("row")).select("vec_id", "row.*")


def unit(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norms, and the vectors at length 1 (a zero vector stays)."""
    x = vectors.astype(np.float64)
    norm = np.sqrt((x * x).sum(axis=1))
    return norm, x / np.where(norm > 0, norm, 1)[:, None]


def chosen_references(sample: np.ndarray) -> np.ndarray:
    """Directions far from each other: each next one is the sampled direction
    whose nearest chosen one is furthest."""
    norm, direction = unit(sample)
    direction = direction[norm > 0]
    if not len(direction):
        return np.zeros((1, sample.shape[1] if sample.ndim == 2 else 1))
    picked = [0]
    nearest = direction @ direction[0]
    while len(picked) < REFERENCES and nearest.min() < 1 - 1e-9:
        picked.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, direction @ direction[picked[-1]])
    return direction[picked]


def matrix(vectors: pa.Array, width: int) -> np.ndarray:
    """Integer vectors as rows of one matrix; components beyond a vector's end are 0."""
    flat, ends = vectors.flatten().to_numpy(), np.cumsum(pa.compute.list_value_length(vectors).to_numpy())
    sizes = np.diff(ends, prepend=0)
    if len(sizes) and (sizes == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(sizes), width), np.int64)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(ends - sizes, sizes)] = flat
    return out


def dots(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of both."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**62:
        return np.einsum("ij,ij->i", a, b)
    return np.array([sum(x * y for x, y in zip(p, q, strict=True)) for p, q in zip(a.tolist(), b.tolist(), strict=True)], object)


class Rows:
    """Some rows with what their bounds need."""

    def __init__(self, vec_id: np.ndarray, label: np.ndarray, v: np.ndarray, norm: np.ndarray, angles: np.ndarray):
        self.vec_id, self.label, self.v, self.norm, self.angles = vec_id, label, v, norm, angles

    def part(self, at) -> Rows:
        return Rows(self.vec_id[at], self.label[at], self.v[at], self.norm[at], self.angles[at])


def bounds(a: Rows, b: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest possible score of every row of ``a`` with every row of ``b``."""
    least, most = np.zeros((len(a.norm), len(b.norm))), np.full((len(a.norm), len(b.norm)), np.pi)
    for k in range(a.angles.shape[1]):
        x, y = a.angles[:, k, None], b.angles[None, :, k]
        np.maximum(least, np.abs(x - y), out=least)
        both = x + y
        np.minimum(most, np.minimum(both, 2 * np.pi - both), out=most)
    size = a.norm[:, None] * b.norm[None, :]
    room = size * MARGIN + 1
    return np.cos(np.maximum(most, least)) * size - room, np.cos(least) * size + room


def first(keys: np.ndarray, score: np.ndarray, vec_id: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` of every key by falling score, then rising id."""
    order = np.lexsort((vec_id, -score, keys))
    sorted_keys = keys[order]
    start = np.flatnonzero(np.diff(sorted_keys, prepend=-1))
    place = np.arange(len(order)) - np.repeat(start, np.diff(start, append=len(order)))
    return order[place < n]


class Best:
    """The first ``n`` candidates of every window, over all rows read so far."""

    def __init__(self, windows: int, n: int):
        self.n = n
        self.key = self.vec_id = np.zeros(0, np.int64)
        self.score = np.zeros(0, np.int64)
        self.least = np.full(windows, -np.inf)  # a lower score cannot be among a window's first any more

    def add(self, key: np.ndarray, score: np.ndarray, vec_id: np.ndarray) -> None:
        key, score, vec_id = (np.concatenate(x) for x in ((self.key, key), (self.score, score), (self.vec_id, vec_id)))
        at = first(key, score, vec_id, self.n)
        self.key, self.score, self.vec_id = key[at], score[at], vec_id[at]
        count = np.bincount(self.key, minlength=len(self.least))
        last = np.cumsum(count)[count >= self.n] - 1
        self.least[count >= self.n] = self.score[last].astype(np.float64)


def search(rows: DataFrame, held, width: int, wanted: Callable, windows: int, n: int, schema: str, name: Callable) -> DataFrame:
    """Best candidates of every window of the broadcast anchors in ``rows``.
    ``wanted(anchors, at, rows, best)`` gives (window, place of the row,
    score) of the pairs that a step of anchors has scored."""

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors, best = held.value[0], Best(windows, n)
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH_ROWS):
                c = [x.slice(lo, BATCH_ROWS) for x in batch.columns]
                vectors = matrix(c[2], width)
                angles = np.frombuffer(b"".join(c[4].to_pylist()), np.float64).reshape(len(vectors), -1)
                own = Rows(c[0].to_numpy(), c[1].to_numpy(), vectors, c[3].to_numpy(), angles)
                for at in range(0, len(anchors.norm), STEP_ANCHORS):
                    window, place, score = wanted(slice(at, at + STEP_ANCHORS), own, best)
                    if len(window):
                        best.add(window, score, own.vec_id[place])
        yield pa.RecordBatch.from_pydict(name(best))

    return rows.mapInArrow(found, schema)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 5,
    least_percent: int = 80,
    most_percent: int = 100,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
) -> DataFrame:
    """Hard negatives of every anchor and positive.

    Components become floor(256 * x); a score is the integer inner product.
    ``is_anchor`` is a condition on ``vec_id``.  An anchor's positives are its
    first ``positives`` other rows of the same label, by falling score and
    rising id.  For each, the first ``negatives`` rows of another label with
    least_percent * positive <= 100 * negative <= most_percent * positive are
    returned: anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score.

    Defined cases: rows with a null id, label, vector or component, or a
    component that is not finite, take no part; of rows that share an id the
    one with the smallest (label, vector) takes part; equal vectors are ties,
    the smaller id first; a vector ends where it ends (missing components are
    0), an empty or zero vector scores 0; a window without rows gives none;
    an empty table gives an empty result; other columns are ignored.  Scores
    are exact; one beyond 64 bits fails the query.
    """
    spark = rows.sparkSession
    plain = spool(usable(rows, id_col, label_col, vector_col), "negatives-rows")
    width = max(1, plain.agg(F.max(F.size("v"))).first()[0] or 0)
    sampled = plain.orderBy(F.xxhash64("vec_id")).limit(SAMPLE).select("v").toArrow().column(0).combine_chunks()
    references = chosen_references(matrix(sampled, width))

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            norm, direction = unit(matrix(batch.column(2), width))
            angles = np.arccos(np.clip(direction @ references.T, -1, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(norm), pa.array([a.tobytes() for a in angles], pa.binary())], names=["vec_id", "label", "v", "norm", "angles"])

    # Stored once; every pass reads them.
    stored = spool(plain.mapInArrow(measured, "vec_id long, label long, v array<long>, norm double, angles binary"), "negatives-angles")
    anchors = stored.where(is_anchor)
    blocks = max(1, math.ceil(anchors.count() / PASS_ANCHORS))
    out = None
    for b in range(blocks):
        c = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").toArrow().combine_chunks()
        own = [c.column(i).combine_chunks() if c.num_rows else pa.array([], c.schema.field(i).type) for i in range(5)]
        block = Rows(own[0].to_numpy(), own[1].to_numpy(), matrix(own[2], width), own[3].to_numpy(), np.frombuffer(b"".join(own[4].to_pylist()), np.float64).reshape(c.num_rows, len(references)))
        found = _mine(stored, block, width, positives, negatives, least_percent, most_percent)
        out = found if out is None else out.union(found)
    return out


def _mine(stored: DataFrame, block: Rows, width: int, positives: int, negatives: int, least_percent: int, most_percent: int) -> DataFrame:
    """The negatives of one block of anchors."""
    spark = stored.sparkSession
    held = spark.sparkContext.broadcast((block,))
    rank = F.row_number().over(W.partitionBy("window").orderBy(F.desc("score"), "vec_id"))

    def alike(at: slice, own: Rows, best: Best) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of one label that can be among an anchor's positives."""
        some = held.value[0].part(at)
        low, high = bounds(some, own)
        same = (some.label[:, None] == own.label[None, :]) & (some.vec_id[:, None] != own.vec_id[None, :])
        # The lower bounds of a batch already give a score that the last positive has at least.
        least = best.least[at]
        if own.norm.size >= positives:
            sure = np.where(same, low, -np.inf)
            least = np.maximum(least, np.partition(sure, -positives, axis=1)[:, -positives])
        i, j = np.nonzero(same & (high >= least[:, None]))
        return i + at.start, j, dots(some.v[i], own.v[j])

    named = "window int, vec_id long, score long"
    shown = lambda best: {"window": best.key.astype(np.int32), "vec_id": best.vec_id, "score": pa.array(best.score.tolist(), pa.int64())}
    near = search(stored, held, width, alike, len(block.norm), positives, named, shown)
    near = spool(near.withColumn("rank", rank).where(F.col("rank") <= positives), "negatives-positives")
    pairs = near.orderBy("window", "rank").toArrow()  # at most ``positives`` for every anchor of the block
    owner, score = pairs.column("window").to_numpy().astype(np.int64), pairs.column("score").to_numpy()
    place = pairs.column("rank").to_numpy().astype(np.int64) - 1
    # Window w of anchor i is i * positives + place; scores it takes.
    lowest, highest = np.full(len(block.norm) * positives, np.inf), np.full(len(block.norm) * positives, -np.inf)
    lowest[owner * positives + place] = [-(-least_percent * s // 100) for s in score.tolist()]
    highest[owner * positives + place] = [most_percent * s // 100 for s in score.tolist()]
    limits = spark.sparkContext.broadcast((lowest, highest))

    def unlike(at: slice, own: Rows, best: Best) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs of two labels whose score can be in a window and among its first."""
        some = held.value[0].part(at)
        low, high = bounds(some, own)
        other = some.label[:, None] != own.label[None, :]
        first_window = at.start * positives
        lo, hi = (x[first_window : first_window + len(some.norm) * positives].reshape(-1, positives) for x in limits.value)
        least = np.maximum(lo, best.least[first_window : first_window + len(some.norm) * positives].reshape(-1, positives))
        any_window = np.zeros(other.shape, bool)
        for k in range(positives):
            any_window |= (high >= least[:, k, None]) & (low <= hi[:, k, None])
        i, j = np.nonzero(other & any_window)
        scores = dots(some.v[i], own.v[j])
        windows, places, values = [], [], []
        for k in range(positives):
            inside = (scores >= least[i, k]) & (scores <= hi[i, k])
            windows.append((i[inside] + at.start) * positives + k)
            places.append(j[inside])
            values.append(scores[inside])
        return np.concatenate(windows), np.concatenate(places), np.concatenate(values)

    hard = search(stored, held, width, unlike, len(lowest), negatives, named, shown)
    hard = hard.withColumn("rank", rank).where(F.col("rank") <= negatives)
    ids = spark.createDataFrame(
        [(int(i * positives + p), int(block.vec_id[i]), int(v), int(s)) for i, p, v, s in zip(owner, place, pairs.column("vec_id").to_pylist(), score.tolist(), strict=True)],
        "window int, anchor_id long, positive_id long, positive_score long",
    )
    return hard.join(ids, "window").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
