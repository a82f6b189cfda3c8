"""Benchmark decontamination by SimHash over item-sized windows.

For every benchmark item, documents are searched for windows of the item's
number of words that resemble it.  A window's SimHash is taken over its
five-word shingles; a multi-index finds the items whose fingerprint differs
in at most ``RADIUS`` bits: the 64 bits are cut into ``BLOCKS`` blocks, two
fingerprints within the radius agree in some block up to ``RADIUS // BLOCKS``
bits, and the index lists every item under all such neighbours of its block
values.  What the blocks bring together are the candidates; they are verified
exactly by the weighted Jaccard similarity of the shingles (sum of the smaller
counts by sum of the larger).

A window that holds too few shingles of the items of its size cannot reach
the similarity and is not fingerprinted; this bound loses no match.  The
radius is wide, so that it hardly loses one either: of windows at similarity
0.8, 64 bits differ in 9.7 places on average if all shingles are different
and in 13 if the differing ones are repeated; by a binomial estimate one in
500,000 of the latter lies beyond 28.

Documents stay where they are: nothing is shuffled, so no passage that many
documents share gathers in one task.  The benchmark is the query set; it is
taken in blocks of bounded size, each a pass over the documents.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import id_and_text, plain_words

WORDS = 5
RADIUS = 28
BLOCKS = 8
# Bounds of one block of the benchmark.
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 32 << 20

# Windows whose shingles' signs are summed at once.
STEP = 4096

EDGES = [64 * i // BLOCKS for i in range(BLOCKS + 1)]


def shingles(words: list[bytes], length: int = WORDS) -> list[bytes]:
    """Runs of ``length`` words, joined by a blank; a shorter text is one shingle."""
    return [b" ".join(words[i : i + length]) for i in range(max(1, len(words) - length + 1))] if words else []


def signs(grams: list[bytes]) -> np.ndarray:
    """A row of 64 plus or minus ones for every shingle."""
    hashes = np.array([xxhash.xxh64_intdigest(g) for g in grams], "<u8")
    return np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.int32) * 2 - 1


def to_fingerprints(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view("<u8").reshape(-1)


class MultiIndex:
    """Items of one size by the neighbours of their block values."""

    def __init__(self, fps: np.ndarray, radius: int):
        self.fps, self.radius, self.blocks = fps, radius, []
        for lo, hi in zip(EDGES, EDGES[1:], strict=False):
            flips = [sum(1 << i for i in some) for k in range(radius // BLOCKS + 1) for some in combinations(range(hi - lo), k)]
            values = (self._value(fps, lo, hi)[:, None] ^ np.array(flips, np.uint64)).reshape(-1)
            order = np.argsort(values, kind="stable")
            self.blocks.append((lo, hi, values[order], order // len(flips)))

    @staticmethod
    def _value(fps: np.ndarray, lo: int, hi: int) -> np.ndarray:
        return fps >> np.uint64(lo) & np.uint64((1 << (hi - lo)) - 1)

    def near(self, fps: np.ndarray) -> list[tuple[int, int, int]]:
        """(place in ``fps``, item, distance) of all pairs within the radius."""
        found = set()
        for lo, hi, values, items in self.blocks:
            own = self._value(fps, lo, hi)
            first, last = np.searchsorted(values, own, "left"), np.searchsorted(values, own, "right")
            n = last - first
            at = np.repeat(np.arange(len(fps)), n)
            item = items[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)]
            far = np.bitwise_count(fps[at] ^ self.fps[item])
            keep = far <= self.radius
            found.update(zip(at[keep].tolist(), item[keep].tolist(), far[keep].tolist(), strict=True))
        return sorted(found)


class ItemBlock:
    """A bounded block of the benchmark, ready to be searched for."""

    def __init__(self, items: list[tuple[int, str]], similarity: float):
        self.similarity = similarity
        self.items: dict[int, list[tuple[int, Counter]]] = defaultdict(list)  # by number of words
        self.sizes: dict[bytes, set[int]] = defaultdict(set)
        self.lengths = {WORDS}
        fps: dict[int, list] = defaultdict(list)
        for item_id, text in items:
            words = plain_words(text)
            if words:
                grams = shingles(words)
                self.items[len(words)].append((item_id, Counter(grams)))
                fps[len(words)].append(signs(grams).sum(axis=0))
                self.lengths.add(min(WORDS, len(words)))
                for g in grams:
                    self.sizes[g].add(len(words))
        self.index = {size: MultiIndex(to_fingerprints(np.array(sums)), RADIUS) for size, sums in fps.items()}

    def anchors(self, words: list[bytes]) -> dict[int, set[int]]:
        """For every item size, the word places where a shingle of such an item starts."""
        joined = b" ".join(words)
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = [0, *(ends[:-1] + 1).tolist()]
        known, at = self.sizes, defaultdict(set)
        for length in self.lengths:
            for i, (a, b) in enumerate(zip(starts, ends[length - 1 :].tolist(), strict=False)):
                if joined[a:b] in known:
                    for size in known[joined[a:b]]:
                        if min(size, WORDS) == length or len(words) < WORDS:
                            at[size].add(i)
        return at

    @staticmethod
    def fingerprints(own: list[bytes], grams: int) -> np.ndarray:
        """Fingerprint of every window of ``grams`` shingles, in steps so that a long run takes little memory."""
        out = []
        for at in range(0, len(own) - grams + 1, STEP):
            part = signs(own[at : at + STEP + grams - 1])
            sums = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(part, axis=0)))
            out.append(to_fingerprints(sums[grams:] - sums[:-grams]))
        return np.concatenate(out)

    def matches(self, text: str) -> list[tuple[int, int, int, int, float]]:
        """(item_id, first word, words, distance, similarity): the best window of every item found."""
        words = plain_words(text)
        if not words:
            return []
        best: dict[tuple, tuple] = {}  # by item id; items without an id by their place
        share = self.similarity / (1 + self.similarity)
        for size, at in self.anchors(words).items():
            width = min(size, len(words))
            grams, item_grams = max(1, width - WORDS + 1), max(1, size - WORDS + 1)
            hits = np.zeros(len(words) + 1, np.int64)
            hits[np.array(sorted(at)) + 1] = 1
            hits = np.cumsum(hits)
            windows = np.arange(len(words) - width + 1)
            inside = hits[windows + grams] - hits[windows]
            least = math.ceil(share * (grams + item_grams) - 1e-9)
            windows = windows[inside >= least]
            # Neighbouring windows share their shingles' sums.
            for run in np.split(windows, np.flatnonzero(np.diff(windows) > grams) + 1):
                if len(run) == 0:
                    continue
                lo, hi = int(run[0]), int(run[-1])
                own = shingles(words[lo : hi + width], min(size, WORDS))
                fps = self.fingerprints(own, grams)[run - lo]
                for place, item, far in self.index[size].near(fps):
                    item_id, wanted = self.items[size][item]
                    start = int(run[place]) - lo
                    got = Counter(own[start : start + grams])
                    alike = (got & wanted).total() / (got | wanted).total()
                    key = (True, size, item) if item_id is None else (False, item_id, 0)
                    if alike >= self.similarity and (-alike, lo + start) < best.get(key, (None, 0.0, 0))[1:3]:
                        best[key] = (item_id, -alike, lo + start, width, far)
        return [(i, start, width, far, -alike) for _, (i, alike, start, width, far) in sorted(best.items())]


_PREPARED: dict[str, ItemBlock] = {}


def prepared(name: str, held, similarity: float) -> ItemBlock:
    """This worker's block of that name: prepared once, kept until another one is asked for."""
    if name not in _PREPARED:
        _PREPARED.clear()
        _PREPARED[name] = ItemBlock(held.value, similarity)
    return _PREPARED[name]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    similarity: float = 0.8,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Benchmark items that documents hold.

    Words are runs of ASCII letters, digits and non-ASCII characters, A-Z
    lower-cased.  Returns one row per document row and item found: doc_id,
    item_id, first_word and n_words (the window), distance (of the
    fingerprints), similarity (``similarity`` or more).

    Defined cases: null or wordless texts and items match nothing; an item of
    fewer than five words is one shingle and matches where these words stand;
    a document shorter than an item is compared whole; of equally similar
    windows the first is given; repeated items give the largest similarity
    under each id, items without an id are each their own; repeated documents are answered each; null ids are kept;
    an empty table on either side gives an empty result; other columns are
    ignored.
    """
    schema = "doc_id long, item_id long, first_word long, n_words long, distance int, similarity double"
    items = benchmark.select(benchmark[item_col].cast("long").alias("item_id"), benchmark[item_text_col].alias("text"))
    n, chars = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, math.ceil(n / BLOCK_ITEMS), math.ceil(chars / BLOCK_CHARS))
    rows = id_and_text(docs, id_col, text_col)
    found = None
    for b in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).where("text is not null")
        held = docs.sparkSession.sparkContext.broadcast([(r["item_id"], r["text"]) for r in part.collect()])
        name = uuid.uuid4().hex

        def search(batches: Iterator[pa.RecordBatch], held=held, name=name) -> Iterator[pa.RecordBatch]:
            block = prepared(name, held, similarity)
            for batch in batches:
                out = [
                    (doc_id, *match)
                    for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                    for match in block.matches(text)
                ]
                cols = list(zip(*out, strict=True)) or [()] * 6
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.float64())
                names = ("doc_id", "item_id", "first_word", "n_words", "distance", "similarity")
                yield pa.RecordBatch.from_pydict({k: pa.array(c, t) for k, c, t in zip(names, cols, kinds, strict=True)})

        own = rows.mapInArrow(search, schema)
        found = own if found is None else found.union(own)
    return found
