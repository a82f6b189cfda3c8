"""Phrase collocations by SON partitioning: two passes over the texts.

A phrase that occurs ``min_count`` times in all shards together reaches its
share of that count in at least one of them (the shares are those of the
shards' sizes and sum up to the whole).  So the first pass mines every shard
completely at its proportionally lowered support, and the union of the
locally frequent phrases holds every frequent one.  The second pass reads all
texts again and counts those candidates globally and exactly.

A shard is every ``shards``-th task of the scan, so it grows with the input
and is mined by many tasks: phrases travel as 48-bit hashes, packed by hash
range, and a range is merged in one task of bounded size.  Hashes that
collide only add candidates.  The candidates become a bitmap of at most
``FILTER_BITS`` bits, which the second pass asks before it hands a phrase's
words on; what passes by chance is counted like the rest and falls below
``min_count``.  Words and phrases are summed per chunk of texts before any
shuffle, so a language, a line or a word with a third of all rows arrives as
one row per chunk.

Parts of a frequent phrase are frequent, so all counts that the scores need
are counted candidates; scores are computed in 38-digit decimals.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridpulse.llm.common import small_batches, spool

UNKNOWN = "und"
HASH_BITS = 48
# Size bound of the broadcast bitmap of candidates, and its bits for each of them while it has room.
FILTER_BITS, BITS_EACH = 1 << 28, 16
# Bits of a bitmap of Spark's bitmap functions.
BITMAP = 1 << 15
# Characters of text that are counted at once, and hashes that a hash range should hold.
CHUNK, RANGE = 6_000_000, 4_000_000

# Lower-cases A-Z, makes every separator of pieces a full stop and the tab a blank.
_MARKS = bytes(0x2E if c in b".,;:!?" or 0x0A <= c <= 0x0D else 0x20 if c == 9 else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256))
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class _Numbers(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Phrases:
    """All different phrases of up to ``longest`` words in some texts of one language."""

    def __init__(self, texts: list[str], lang: str):
        joined = b".".join(t.encode("utf-8", "surrogatepass") for t in texts)
        numbers = _Numbers({b".": 0})
        self.words = joined.translate(_MARKS).replace(b".", b" . ").split()
        self.ids = np.fromiter(map(numbers.__getitem__, self.words), np.int64, len(self.words))
        self.different = len(numbers)
        seed = xxhash.xxh64_intdigest(lang.encode())
        self.hashes = np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in numbers), np.uint64, len(numbers))
        self.total = int(np.count_nonzero(self.ids))

    def of_length(self, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """(words, first place, count, hash) of the different phrases of every length."""
        inside = self.ids != 0
        key, valid = self.ids, inside
        for m in range(1, longest + 1):
            if m > 1:
                key, valid = key[:-1] * self.different + self.ids[m - 1 :], valid[:-1] & inside[m - 1 :]
            at = np.flatnonzero(valid)
            _, first, back, count = np.unique(key[at], return_index=True, return_inverse=True, return_counts=True)
            # From here on a phrase is its number among those of its length, so keys stay small.
            key = np.zeros(len(key), np.int64)
            key[at] = back
            place = at[first]
            h = np.zeros(len(place), np.uint64)
            for k in range(m):
                h = (h ^ self.hashes[self.ids[place + k]]) * _MULTIPLIER
                h ^= h >> np.uint64(29)
            yield m, place, count, h >> np.uint64(64 - HASH_BITS)


def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[str]]]:
    """Texts by language, handed on whenever ``CHUNK`` characters are held."""
    held: dict[str, list[str]] = {}
    size = 0
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            held.setdefault(lang, []).append(text)
            size += len(text)
            if size >= CHUNK:
                yield from held.items()
                held, size = {}, 0
    yield from held.items()


def squeeze(keys: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted keys and their counts as compressed byte planes of the keys' differences."""
    both = np.concatenate((np.diff(keys, prepend=np.uint64(0)), counts.astype(np.uint64))).astype("<u8")
    return zstandard.ZstdCompressor(level=1).compress(both.view(np.uint8).reshape(-1, 8).T.tobytes())


def unsqueeze(payload: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(payload), np.uint8).reshape(8, -1)
    both = np.ascontiguousarray(planes.T).view("<u8").reshape(2, -1)
    return np.cumsum(both[0], dtype=np.uint64), both[1].astype(np.int64)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted different keys with their summed counts."""
    keys, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def locally_frequent(texts: DataFrame, min_count: int, longest: int, shards: int) -> DataFrame:
    """(h): hashes of the phrases that reach their shard's share of ``min_count``."""
    spark = texts.sparkSession
    shard = F.pmod(F.spark_partition_id(), F.lit(shards))
    sizes = {r["shard"]: r["size"] for r in texts.groupBy(shard.alias("shard")).agg(F.sum(F.length("text")).alias("size")).collect()}
    total = sum(sizes.values())
    # Rounded up: a count below the share is a count below the next whole number.  Fractions of integers are exact.
    support = [max(1, -(-min_count * sizes.get(s, 0) // total)) if total else 1 for s in range(shards)]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(1, math.ceil(max(parts, longest * total / 5 / RANGE) / shards))
    width = -(-(1 << HASH_BITS) // ranges)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = TaskContext.get().partitionId() % shards
        for lang, group in chunks(batches):
            found = [(h, count) for _, _, count, h in Phrases(group, lang).of_length(longest)]
            keys, counts = merged(found)
            if not len(keys):
                continue
            bounds = np.searchsorted(keys, np.arange(ranges + 1, dtype=np.uint64) * np.uint64(width))
            rows = [(own * ranges + i, squeeze(keys[lo:hi], counts[lo:hi])) for i, (lo, hi) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if hi > lo]
            part, payload = zip(*rows, strict=True)
            yield pa.RecordBatch.from_pydict({"part": pa.array(part, pa.int32()), "payload": pa.array(payload, pa.binary())})

    def frequent(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def mined(part: int, held: list) -> pa.RecordBatch:
            keys, counts = merged(held)
            return pa.RecordBatch.from_pydict({"h": keys[counts >= support[part // ranges]].view(np.int64)})

        now, held, size = -1, [], 0
        for batch in batches:
            for part, payload in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if part != now:
                    if held:
                        yield mined(now, held)
                    now, held, size = part, [], 0
                held.append(unsqueeze(payload))
                size += len(held[-1][0])
                if size > 2 * RANGE:
                    held = [merged(held)]
                    size = len(held[0][0])
        if held:
            yield mined(now, held)

    counted = texts.mapInArrow(local, "part int, payload binary")
    dealt = counted.repartition(shards * ranges, "part").sortWithinPartitions("part")
    return dealt.mapInArrow(frequent, "h long").distinct()


def candidate_bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits of all hashes, taken modulo the bitmap's size, as bytes."""
    n = hashes.count()
    bits = min(FILTER_BITS, max(BITMAP, 1 << max(1, n * BITS_EACH - 1).bit_length()))
    place = F.col("h").bitwiseAND(F.lit(bits - 1))
    rows = hashes.select(F.shiftright(place, 15).alias("bucket"), place.bitwiseAND(F.lit(BITMAP - 1)).alias("bit"))
    maps = rows.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map"))
    out = np.zeros(bits // 8, np.uint8)
    for r in maps.collect():  # at most FILTER_BITS in all
        own = np.frombuffer(r["map"], np.uint8)[: BITMAP // 8]
        out[r["bucket"] * (BITMAP // 8) :][: len(own)] = own
    return out


def count_candidates(texts: DataFrame, candidates: DataFrame, longest: int) -> DataFrame:
    """(lang, words, phrase, n): exact counts of the candidates; the number
    of all words of a language is its row of 0 words."""
    held = texts.sparkSession.sparkContext.broadcast(candidate_bitmap(candidates))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = held.value
        mask = np.uint64(len(bits) * 8 - 1)
        for lang, group in chunks(batches):
            phrases = Phrases(group, lang)
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(([lang], [0], [""], [phrases.total]), _TYPES, strict=True)], names=_NAMES)
            for m, place, n, h in phrases.of_length(longest):
                spot = h & mask
                known = np.flatnonzero(bits[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8) & 1)
                words = phrases.words
                if m == 1:
                    shown = [words[i] for i in place[known].tolist()]
                else:
                    shown = [b" ".join(words[i : i + m]) for i in place[known].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang], pa.string()).take(pa.array(np.zeros(len(known), np.int32))), pa.array(np.full(len(known), m, np.int32)), pa.array(shown, pa.binary()).cast(pa.string()), pa.array(n[known])], names=_NAMES
                )

    found = texts.mapInArrow(count, "lang string, words int, phrase string, n long")
    return found.groupBy("lang", "words", "phrase").agg(F.sum("n").alias("n"))


_NAMES = ["lang", "words", "phrase", "n"]
_TYPES = [pa.string(), pa.int32(), pa.string(), pa.int64()]


def _big(col):
    return F.col(col).cast("decimal(18,0)") if isinstance(col, str) else col.cast("decimal(18,0)")


def scored(counts: DataFrame) -> DataFrame:
    """(lang, phrase, words, a, k, l, r, score): every phrase of two or more
    words at the cut of the lowest score (of equal ones, the first)."""
    words = F.split("phrase", " ", -1)
    cut = counts.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cut = cut.select("*", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("first"), F.array_join(F.slice(words, F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("rest"))
    left = counts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r"))
    met = cut.join(left, ["lang", "first"]).join(right, ["lang", "rest"])
    met = met.withColumn("square", _big("a") * _big("a")).withColumn("both", _big("l") * _big("r"))
    met = met.withColumn("score", F.expr("(cast(1000000 as decimal(38,0)) * square) div both").cast("long"))
    best = met.groupBy("lang", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "words", "a", "best.*")


def collocations(
    docs: DataFrame,
    min_count: int = 10,
    longest: int = 3,
    inside_percent: int = 50,
    top: int = 2000,
    shards: int = 4,
    lang_col: str = "lang",
    text_col: str = "text",
) -> DataFrame:
    """The highest-scoring phrases of every language.

    Texts (A-Z lower-cased) are split at ``[.,;:!?\\x0A-\\x0D]`` into pieces
    and those at blanks and tabs into words.  A phrase is 2 to ``longest``
    words that occur together at least ``min_count`` times in a language; its
    score is floor(1000000 * a * a / (l * r)) for its count a and the counts
    l and r of its two parts at the lowest-scoring cut.  A phrase goes if a
    longer one around it has at least ``inside_percent`` percent of its
    count.  Returns the first ``top`` of every language by score, count (both
    descending) and phrase (UTF-8 bytes): lang, rank, phrase, a, l, r, n (all
    words of the language), score, words, cut.

    Defined cases: a null language is ``und``, together with texts so named;
    null and empty texts hold no words; a repeated row counts as often as
    given, whatever its id; ties end at the phrase, which is unique; a text
    longer than a chunk is a chunk of its own; an empty table, or one without
    frequent phrases, gives an empty result; other columns are ignored.
    Counts up to 16 digits are exact; beyond, the decimals overflow and the query fails.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(docs[lang_col].cast("string"), F.lit(UNKNOWN)).alias("lang"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    candidates = spool(locally_frequent(texts, min_count, longest, shards), "phrase-candidates")
    counted = count_candidates(texts, candidates, longest)
    counts = spool(counted.where((F.col("n") >= min_count) | (F.col("words") == 0)), "phrase-counts")
    phrases = counts.where("words > 0")
    found = spool(scored(phrases), "phrase-scores")
    # Every shorter phrase of two or more words inside a longer one, with the longest count around it.
    words = F.split("phrase", " ", -1)
    longer = found.where("words > 2").select("lang", "a", "words", words.alias("w"))
    longer = longer.select("*", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("m"))
    longer = longer.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("m") + 1)).alias("at"))
    around = longer.groupBy("lang", F.array_join(F.slice("w", F.col("at"), F.col("m")), " ").alias("phrase")).agg(F.max("a").alias("around"))
    kept = found.join(around, ["lang", "phrase"], "left").where(
        F.col("around").isNull() | (_big("around") * 100 < _big("a") * inside_percent)
    )
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    best = kept.withColumn("rank", place).where(F.col("rank") <= top)
    totals = counts.where("words = 0").select("lang", F.col("n"))
    return best.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", "words", F.col("k").alias("cut"))
