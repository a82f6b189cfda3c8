"""Near-dedup by SetSketch registers, with exact verification.

A document is the set of its shingles.  Register i of a set holds
floor(1 - log_b(x)) of the smallest of exponential values x that a hash gives
its elements, truncated to 0 .. TOP: minima on an exponential scale, so the
registers of a union are the larger registers of both (``merge``), and a
register of two sets agrees with a probability close to their similarity.
Bands of registers make the candidates: sets that agree in all registers of
some band.  The numbers of larger, equal and smaller registers of a pair, with
both set sizes, give the likelihood of every similarity; a pair whose most
likely similarity lies decisively below the threshold is dismissed, every
other one is verified on the full sets.

Equal sets collapse before anything else and stand as one node.  A band's
bucket is never paired out.  First every node is tested with one member of
its buckets, of their first ones the one it shares most buckets with; this
joins most of a group of near copies along a star.  Classes that then still
meet in some bucket form clusters; every set goes once to its cluster, which
is searched whole, in blocks of bounded size, for links between different
classes, and returns a spanning forest of them.  So components are those of
all candidate pairs, and no pair is left out because its bucket is large.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridpulse.llm.common import id_and_text, spool, spool_narrow
from gridpulse.llm.components import components

# A pair at similarity 0.8 is in no common bucket with a probability of 6e-7.
BANDS, ROWS = 36, 5
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 1
SEED = 42
# Shingles whose registers are computed at once.
STEP = 1 << 8
_MIX = np.uint64(0x9E3779B97F4A7C15)
# Words whose hashes a worker keeps.
WORDS_KEPT = 400_000
# A pair is dismissed if its best likelihood is larger by this factor's logarithm than that at the threshold.
DECISIVE = 16.0
# Sets of a block of a cluster.
BLOCK = 1024

_FACTORS = np.random.Generator(np.random.PCG64(SEED)).integers(0, 1 << 31, BANDS * ROWS, np.uint32) * np.uint32(2) + np.uint32(1)


class _WordHashes(dict):
    """64-bit hashes of words; keeps those it has computed while there is room."""

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word, SEED)
        if len(self) < WORDS_KEPT:
            self[word] = h
        return h


_HASHES = _WordHashes()


def shingle_set(text: str, width: int) -> np.ndarray:
    """Sorted 64-bit hashes of the different ``width``-word shingles; fewer words are one shingle, none give no set."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    own = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    n = max(1, len(words) - width + 1)
    h = np.full(n, min(width, len(words)), np.uint64)
    for k in range(min(width, len(words))):
        h = (h + own[k : k + n]) * _MIX
        h ^= h >> np.uint64(32)
    return np.unique(h)


def registers(shingles: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set that is not empty.  The values of a
    register are the low 32 bits of the hashes times an odd number."""
    low = shingles.astype(np.uint32)[:, None]
    least = np.full(len(_FACTORS), np.iinfo(np.uint32).max, np.uint32)
    for lo in range(0, len(low), STEP):
        np.minimum(least, (low[lo : lo + STEP] * _FACTORS).min(axis=0), out=least)
    share = (least + 0.5) / 2.0**32
    x = -np.log1p(-share) / RATE
    return np.clip(np.floor(1 - np.log(x) / math.log(BASE)), 0, TOP).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def band_keys(regs: np.ndarray) -> list[int]:
    raw = regs.tobytes()
    return [xxhash.xxh64_intdigest(raw[2 * ROWS * i : 2 * ROWS * (i + 1)], i) - (1 << 63) for i in range(BANDS)]


def log_likelihood(share: np.ndarray, larger: np.ndarray, smaller: np.ndarray, equal: np.ndarray, similarity) -> np.ndarray:
    """Of the counts of registers in which the first set's is larger, smaller
    or equal; ``share`` is the first set's part of both sizes added."""

    def p(x):
        return -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / math.log(BASE)

    up, down = p(share - (1 - share) * similarity), p(1 - share - share * similarity)
    tiny = 1e-12
    return larger * np.log(np.maximum(up, tiny)) + smaller * np.log(np.maximum(down, tiny)) + equal * np.log(np.maximum(1 - up - down, tiny))


def hopeless(regs: np.ndarray, n: int, others: np.ndarray, sizes: np.ndarray, threshold: float) -> np.ndarray:
    """Which of ``others`` are too unlike, by size or decisively by likelihood."""
    larger, smaller = (regs > others).sum(axis=1), (regs < others).sum(axis=1)
    equal = others.shape[1] - larger - smaller
    u = n / (n + sizes)
    v = 1 - u
    # The most likely similarity, which has a closed form for a base near 1.
    b = equal * (u * u + v * v) + v * v * larger + u * u * smaller
    root = np.sqrt(np.maximum(b * b - 4 * others.shape[1] * equal * (u * v) ** 2, 0))
    likely = np.minimum((b - root) / (2 * others.shape[1] * u * v), threshold)
    at, best = (log_likelihood(u, larger, smaller, equal, s) for s in (threshold, likely))
    return (np.minimum(n, sizes) < threshold * np.maximum(n, sizes) - 1e-9) | (best - at > DECISIVE)


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * intersection >= percent * union, of two sorted sets."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketched(docs: DataFrame, width: int) -> DataFrame:
    """(doc_id, th, n, k1, k2, bands): hash of the text, size and 128-bit hash of the set, keys of its bands."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, k1, k2, bands = [], [], [], []
            for text in batch.column(2).to_pylist():
                own = shingle_set(text, width)
                high, low = divmod(xxhash.xxh3_128_intdigest(own.tobytes()), 1 << 64)
                n.append(len(own)), k1.append(high - (1 << 63)), k2.append(low - (1 << 63))
                bands.append(band_keys(registers(own)) if len(own) else [])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(n, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc_id", "th", "n", "k1", "k2", "bands"],
            )

    return docs.select("doc_id", F.xxhash64("text").alias("th"), "text").mapInArrow(sketch, "doc_id long, th long, n long, k1 long, k2 long, bands array<long>")


def full_sets(texts: DataFrame, width: int) -> DataFrame:
    """(node, n, regs, shingles) of (node, text)."""

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [shingle_set(t, width) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(s) for s in own], pa.int64()), pa.array([registers(s).tobytes() for s in own], pa.binary()), pa.array([s.tobytes() for s in own], pa.binary())],
                names=["node", "n", "regs", "shingles"],
            )

    return texts.mapInArrow(sets, "node long, n long, regs binary, shingles binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike."""
    one = sets.select(F.col("node").alias("a"), F.col("n").alias("n1"), F.col("regs").alias("r1"), F.col("shingles").alias("s1"))
    two = sets.select(F.col("node").alias("b"), F.col("n").alias("n2"), F.col("regs").alias("r2"), F.col("shingles").alias("s2"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = [], []
            for row in batch.to_pylist():
                r1, r2 = np.frombuffer(row["r1"], np.uint16), np.frombuffer(row["r2"], np.uint16)[None, :]
                if not hopeless(r1, row["n1"], r2, np.array([row["n2"]]), percent / 100)[0] and alike(np.frombuffer(row["s1"], np.uint64), np.frombuffer(row["s2"], np.uint64), percent):
                    a.append(row["a"]), b.append(row["b"])
            yield pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return pairs.join(one, "a").join(two, "b").mapInArrow(check, "a long, b long")


def rooted(links: DataFrame) -> DataFrame:
    """(node, label) of links (a, b) with b < a and each a once: the last node that the links of a lead to."""
    up = links.select(F.col("a").alias("node"), F.col("b").alias("label"))
    while True:
        above = up.select(F.col("node").alias("label"), F.col("label").alias("above"))
        further = up.join(above, "label", "left")
        up = spool_narrow(further.select("node", F.coalesce("above", "label").alias("label"), F.col("above").isNotNull().alias("moved")), "setsketch-roots")
        if up.where("moved").isEmpty():
            return up.select("node", "label")
        up = up.select("node", "label")


def forest(labels: np.ndarray, sizes: np.ndarray, regs: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Pairs of different labels of linked sets, enough to join what all such links join."""
    left = np.ones(len(labels), bool)
    links = []
    for begin in range(len(labels)):
        if not left[begin]:
            continue
        frontier = np.flatnonzero(left & (labels == labels[begin])).tolist()
        left[frontier] = False
        while frontier and left.any():
            at = frontier.pop()
            rest = np.flatnonzero(left)
            rest = rest[~hopeless(regs[at], int(sizes[at]), regs[rest], sizes[rest], percent / 100)]
            for other in rest.tolist():
                if left[other] and alike(sets[at], sets[other], percent):
                    links.append((int(labels[at]), int(labels[other])))
                    joined = np.flatnonzero(left & (labels == labels[other]))
                    left[joined] = False
                    frontier += joined.tolist()
    return links


def cluster_links(members: DataFrame, sets: DataFrame, percent: int, block: int) -> DataFrame:
    """(a, b): labels that links join inside the clusters of ``members`` (cluster, node, label)."""
    sizes = spool_narrow(members.groupBy("cluster").agg(F.count(F.lit(1)).alias("members")), "setsketch-clusters")
    blocks = F.ceil(F.col("members") / block).cast("int")
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    met = members.join(sizes, "cluster").select("cluster", "node", "label", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    grouped = met.select("cluster", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "node", "label").join(sets, "node").drop("node")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def done(held: list[dict]) -> pa.RecordBatch:
            regs = np.array([np.frombuffer(r["regs"], np.uint16) for r in held])
            labels, sizes = (np.array([r[c] for r in held], np.int64) for c in ("label", "n"))
            links = forest(labels, sizes, regs, [np.frombuffer(r["shingles"], np.uint64) for r in held], percent)
            a, b = zip(*links, strict=True) if links else ((), ())
            return pa.RecordBatch.from_pydict({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

        now, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["cluster"], row["lo"], row["hi"])
                if key != now:
                    if len(held) > 1:
                        yield done(held)
                    now, held = key, []
                held.append(row)
        if len(held) > 1:
            yield done(held)

    keys = ["cluster", "lo", "hi"]
    return grouped.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(linked, "a long, b long")


def setsketch_classes(
    docs: DataFrame,
    width: int = 5,
    percent: int = 80,
    block: int = BLOCK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Near-duplicate class of every document.

    Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; a document's set
    is its different ``width``-word shingles (fewer words: the whole sequence
    as one).  Documents link if 100 * intersection >= ``percent`` * union.
    Returns one row per input row: doc_id, n_shingles, component_id (smallest
    doc_id reachable over links, the row's own included).

    Defined cases: a null text, or one without words, has an empty set and
    links with nothing, not even its like; a null id gets the class of a
    numbered row with an equal set, else a null one (null ids never stand for
    others); repeated rows get equal answers, and rows that share an id but
    not the text are classed each by its own text; an empty table gives an
    empty result; other columns are ignored.  Shingles are compared by 64
    bits of hash, equal sets by 128.  A pair at the threshold is missed with
    a probability of about 1e-6, a more similar one with less.
    """
    texts = id_and_text(docs, id_col, text_col)
    rows = spool(sketched(texts, width), "setsketch-rows")
    full = rows.where("n > 0 and doc_id is not null")
    distinct = full.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "th", "bands")).alias("x")).select("k1", "k2", "x.*")
    distinct = spool(distinct.withColumn("node", F.monotonically_increasing_id()), "setsketch-distinct")
    members = distinct.select("node", F.explode(F.array_distinct("bands")).alias("key"))
    met = members.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first < last").drop("last")
    shared = spool(members.join(met, "key"), "setsketch-members")
    needed = distinct.select("node", "doc_id", "th").join(shared.select("node").distinct(), "node")
    found = texts.withColumn("th", F.xxhash64("text")).join(needed, ["doc_id", "th"]).groupBy("node").agg(F.min("text").alias("text"))
    sets = spool(full_sets(found, width), "setsketch-sets")

    votes = shared.where("node <> first").groupBy("node", "first").agg(F.count(F.lit(1)).alias("votes"))
    best = votes.groupBy("node").agg(F.max(F.struct(F.col("votes"), (-F.col("first")).alias("b"))).alias("best"))
    stars = verified(best.select(F.col("node").alias("a"), (-F.col("best.b")).alias("b")), sets, percent)
    labels = rooted(spool(stars, "setsketch-stars"))
    labelled = shared.select("key", "node").join(labels, "node", "left").select("key", "node", F.coalesce("label", "node").alias("label"))
    several = labelled.groupBy("key").agg(F.min("label").alias("first"), F.max("label").alias("last")).where("first < last").drop("last")
    labelled = spool_narrow(labelled.join(several, "key"), "setsketch-open")
    clusters = components(labelled.select(F.col("label").alias("a"), F.col("first").alias("b")))
    members = labelled.select("node", "label").distinct().join(clusters.select(F.col("node").alias("label"), F.col("component").alias("cluster")), "label")
    joined = components(spool(cluster_links(members, sets, percent, block), "setsketch-links"))
    answer = distinct.select("k1", "k2", "doc_id", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    answer = answer.join(joined.withColumnRenamed("node", "label"), "label", "left").withColumn("class", F.coalesce("component", "label"))
    answer = spool_narrow(answer.select("k1", "k2", "doc_id", "class"), "setsketch-classes")
    ids = answer.groupBy("class").agg(F.min("doc_id").alias("component_id"))
    answer = answer.join(ids, "class").select("k1", "k2", "component_id")
    return rows.join(answer, ["k1", "k2"], "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
