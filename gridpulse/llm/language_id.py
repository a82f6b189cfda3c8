"""Language identification by rank-order n-gram profiles.

A profile lists the most frequent character n-grams (1 to 3 letters, words
padded with a blank) by rank.  A document's own most frequent n-grams are
compared with each language's profile by the out-of-place distance: the sum
of rank differences, and the profile length for an n-gram the profile lacks.
The language at the smallest distance wins.

Both passes run in Arrow batches.  Learning sums n-gram counts per language
inside each task and combines them by a grouped sum in Spark; only the top of
each language (``profile_size`` rows) comes back to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from gridpulse.llm.common import id_and_text

ORDERS = 3
# Code points fit 21 bits, so three of them fit one signed 64-bit number.
BITS = 21
UND = "und"
# Counts a task holds per language before it hands them on.
FLUSH = 500_000


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Different n-grams of a text (codes, ascending) and their counts.

    Letters are lower-cased; every run of other characters is one blank, and
    n-grams that are blanks only are left out.
    """
    low = text.lower()
    points = np.frombuffer(low.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.int64)
    if len(points) == 0:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    letters = letter_mask(points)
    points = np.where(letters, points, 32)
    keep = letters.copy()
    keep[1:] |= letters[:-1]  # of a run of other characters only the first stays
    points = np.concatenate(([32], points[keep], [32]))
    parts = [points[points != 32]]
    two = (points[:-1] << BITS) | points[1:]
    parts.append(two[(points[:-1] != 32) | (points[1:] != 32)])
    if len(points) > 2:
        three = (two[:-1] << BITS) | points[2:]
        parts.append(three[points[1:-1] != 32])
    codes = np.sort(np.concatenate(parts))
    if len(codes) == 0:
        return codes, codes
    starts = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1])))
    return codes[starts], np.diff(np.concatenate((starts, [len(codes)])))


_LETTER: np.ndarray | None = None


def letter_mask(points: np.ndarray) -> np.ndarray:
    """Which code points are letters (str.isalpha), from a table over the plane of common scripts."""
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)
    return _LETTER[points]


def ranked(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent n-grams, most frequent first, ties by code."""
    if len(codes) > 4 * size:
        least = np.partition(counts, len(counts) - size)[len(counts) - size]
        top = counts >= least
        codes, counts = codes[top], counts[top]
    return codes[np.lexsort((codes, -counts))[:size]]


def count_ngrams(labelled: DataFrame) -> DataFrame:
    """(lang, gram, n): n-gram counts of all rows (text, lang)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        size = 0

        def handed_on() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                codes, back = np.unique(np.concatenate([c for c, _ in parts]), return_inverse=True)
                n = np.bincount(back, weights=np.concatenate([k for _, k in parts])).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"lang": pa.array([lang] * len(codes), pa.string()), "gram": codes, "n": n})
            held.clear()

        for batch in batches:
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                codes, counts = ngrams(text)
                held.setdefault(lang, []).append((codes, counts))
                size += len(codes)
                if size > FLUSH:
                    yield from handed_on()
                    size = 0
        yield from handed_on()

    rows = labelled.select("text", "lang").mapInArrow(count, "lang string, gram long, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn_profiles(labelled: DataFrame, profile_size: int) -> dict[str, np.ndarray]:
    """Each language's ``profile_size`` most frequent n-grams in rank order."""
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = count_ngrams(labelled).withColumn("place", place).where(F.col("place") <= profile_size)
    found: dict[str, list] = {}
    for r in top.select("lang", "place", "gram").collect():
        found.setdefault(r["lang"], []).append((r["place"], r["gram"]))
    return {lang: np.array([g for _, g in sorted(rows)], np.int64) for lang, rows in sorted(found.items())}


def identify_language(
    docs: DataFrame,
    learn_from: Column,
    profile_size: int = 400,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Predict the language of every whole text.

    Profiles are learnt from the rows where ``learn_from`` holds and the label
    is not null.  Returns one row per input row: doc_id, lang_pred (a learnt
    label), score (0 to 1: how far the distance is below the largest
    possible), margin (score minus the next language's).

    Defined cases: a text that is null or has no letter, or any text if no
    profile could be learnt, gets ``und``, score 0 and margin 0; ties go to
    the language first in order; a text of one letter is still compared;
    repeated rows and null ids are answered row by row; an empty table gives
    an empty result; other columns are ignored.
    """
    labelled = docs.where(learn_from & docs[lang_col].isNotNull() & docs[text_col].isNotNull()).select(
        docs[text_col].alias("text"), docs[lang_col].alias("lang")
    )
    profiles = learn_profiles(labelled, profile_size)
    tables = [(lang, np.sort(grams), np.argsort(grams, kind="stable")) for lang, grams in profiles.items()]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores, margins = [], [], []
            for text in batch.column(1).to_pylist():
                own = ranked(*ngrams(text), profile_size)
                if len(own) == 0 or not tables:
                    langs.append(UND), scores.append(0.0), margins.append(0.0)
                    continue
                places = np.arange(len(own))
                distances = []
                for _, grams, ranks in tables:
                    at = np.minimum(np.searchsorted(grams, own), len(grams) - 1)
                    off = np.abs(ranks[at] - places)
                    distances.append(np.where(grams[at] == own, np.minimum(off, profile_size), profile_size).sum())
                found = 1 - np.array(distances) / (profile_size * len(own))
                best = int(np.argmax(found))
                langs.append(tables[best][0]), scores.append(float(found[best]))
                margins.append(float(found[best] - max(np.delete(found, best), default=0.0)))
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column(0), "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64()), "margin": pa.array(margins, pa.float64())}
            )

    return id_and_text(docs, id_col, text_col).mapInArrow(predict, "doc_id long, lang_pred string, score double, margin double")
