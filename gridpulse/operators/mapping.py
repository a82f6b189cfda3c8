"""Mapping build for a new state: raw column names, raw county names, and a
fuzzy county map (raw name -> best master county).

The score of two names is the weighted ratio of the well-known fuzzy string
libraries.  With ratio(a, b) = 200 * LCS(a, b) / (|a| + |b|) (LCS: longest
common subsequence) it is the largest of

* ratio(a, b);
* for lengths within a factor of 1.5: 0.95 of the better of the ratio of the
  sorted words and the token-set ratio (common words counted as equal);
* otherwise, within a factor of 8: 0.9 of the best ratio of the shorter name
  with a window of the longer one, and 0.95 * 0.9 of the same for words (100
  if any word is common).

Scores of 85 and more are kept; the best per raw name wins, ties to the
smaller name.  Candidate pairs come from equi-joins only, and hold every pair
that can reach 85 (``may_reach`` says why).
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gridpulse.constants import FUZZY_MIN_SCORE, MUNICIPAL_KEY
from gridpulse.functions.text import normalize_name

# fixed values: weights and length factors of the weighted ratio
WORDS_WEIGHT, PART_WEIGHT = 0.95, 0.9
PART_FROM, PART_BELOW = 1.5, 8.0


def header_names(header: str) -> Column:
    """Column names of a header line by CSV rules: quoted names may hold commas and doubled quotes."""
    fields = F.regexp_extract_all(header, F.lit('(?:^|,)("(?:[^"]|"")*"|[^,]*)'), F.lit(1))
    return F.transform(fields, lambda x: F.regexp_replace(F.regexp_replace(x, '^"|"$', ""), '""', '"'))


def distinct_columns(headers: DataFrame) -> DataFrame:
    """agg_distinct_columns: (state, column_name) trimmed lower, distinct,
    from a (state, header) table of raw header lines."""
    names = headers.select("state", F.explode(header_names("header")).alias("name"))
    return names.select("state", normalize_name(F.col("name")).alias("column_name")).distinct()


def distinct_counties(df: DataFrame, county_cols: Sequence[str], key_col: str | None = None) -> DataFrame:
    """agg_distinct_counties: raw county values of every county column:
    drop NULL, lower, remove every ``county``, trim, drop empty; rows whose
    trimmed lower ``key`` is ``muni`` are skipped; distinct (state, raw)."""
    src = df
    if key_col is not None and key_col in df.columns:
        src = df.where(F.col(key_col).isNull() | (F.lower(F.trim(F.col(key_col))) != F.lit(MUNICIPAL_KEY)))
    stacked = src.select("state", F.explode(F.array(*[F.col(c).cast("string") for c in county_cols])).alias("v"))
    cleaned = stacked.where(F.col("v").isNotNull()).select(
        "state", F.trim(F.regexp_replace(F.lower("v"), "county", "")).alias("raw")
    )
    return cleaned.where(F.col("raw") != "").distinct()


# ---------------------------------------------------------------- the score --
def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence; a bit for every character of ``a``."""
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    whole = row = (1 << len(a)) - 1
    for c in b:
        met = row & places.get(c, 0)
        row = (row + met | row - met) & whole
    return len(a) - row.bit_count()


def ratio(a: str, b: str) -> float:
    return 200.0 * lcs(a, b) / (len(a) + len(b)) if a or b else 100.0


def part_ratio(a: str, b: str) -> float:
    """Best ratio of the shorter name with a window of its length in the longer one; windows may stick out at both ends."""
    short, long = sorted((a, b), key=len)
    if not short:
        return 0.0 if long else 100.0
    n = len(short)
    best = max(ratio(short, long[max(0, i) : i + n]) for i in range(1 - n, len(long)))
    if n == len(long):
        best = max(best, *(ratio(long, short[max(0, i) : i + n]) for i in range(1 - n, n)))
    return best


def _word_sets(a: str, b: str) -> tuple[list[str], str, str]:
    """Common words, and the words of one name only, sorted and joined."""
    one, two = set(a.split()), set(b.split())
    return sorted(one & two), " ".join(sorted(one - two)), " ".join(sorted(two - one))


def words_ratio(a: str, b: str) -> float:
    """The better of the ratio of all words in order and of the words as sets."""
    in_order = ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split())))
    common, own, other = _word_sets(a, b)
    if common and not (own and other):
        return 100.0
    n = len(" ".join(common))
    gap = 1 if n else 0
    left, right = n + gap + len(own), n + gap + len(other)
    apart = len(own) + len(other) - 2 * lcs(own, other)
    found = [in_order, 100.0 - 100.0 * apart / (left + right) if left + right else 0.0]
    if n:
        found += [100.0 - 100.0 * (gap + len(x)) / (n + size) for x, size in ((own, left), (other, right))]
    return max(found)


def words_part_ratio(a: str, b: str) -> float:
    common, own, other = _word_sets(a, b)
    if common:
        return 100.0
    return max(part_ratio(" ".join(sorted(a.split())), " ".join(sorted(b.split()))), part_ratio(own, other))


def weighted_ratio(a: str, b: str) -> float:
    """The score of two names, 0 to 100; an empty name scores 0."""
    if not a or not b:
        return 0.0
    factor = max(len(a), len(b)) / min(len(a), len(b))
    if factor < PART_FROM:
        return max(ratio(a, b), WORDS_WEIGHT * words_ratio(a, b))
    weight = PART_WEIGHT if factor < PART_BELOW else 0.6
    return max(ratio(a, b), weight * part_ratio(a, b), WORDS_WEIGHT * weight * words_part_ratio(a, b))


@F.pandas_udf(T.DoubleType())
def fuzzy_score(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([weighted_ratio(x, y) for x, y in zip(a, b, strict=True)], dtype="float64")


# ------------------------------------------------------------- the candidates --
def _words(col: str) -> Column:
    return F.filter(F.split(col, r"\s+"), lambda w: w != "")


def _forms(col: str) -> list[Column]:
    """A name as it stands, with its words sorted, and sorted without repeats."""
    return [F.col(col), F.array_join(F.array_sort(_words(col)), " "), F.array_join(F.array_sort(F.array_distinct(_words(col))), " ")]


WORD, CHARACTER = 3, 4


def _grams(names: DataFrame, col: str) -> DataFrame:
    """(state, ``col``, kind, gram, nth): the pairs of neighbouring characters
    of a name's forms (kinds 0 to 2; the nth of its kind and gram), its
    different words (3) and its different characters (4)."""

    def pairs(text: Column) -> Column:
        n = F.length(text)
        return F.when(n < 2, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(2))))

    def of_kind(grams: Column, kind: int) -> Column:
        def numbered(gram: Column, i: Column) -> Column:
            nth = F.size(F.filter(F.slice(grams, F.lit(1), i + 1), lambda g: g == gram))
            return F.struct(F.lit(kind).alias("kind"), gram.alias("gram"), nth.alias("nth"))

        return F.transform(grams, numbered)

    found = [of_kind(pairs(text), k) for k, text in enumerate(_forms(col))]
    found += [of_kind(F.array_distinct(_words(col)), WORD), of_kind(F.array_distinct(F.split(col, "")), CHARACTER)]
    return names.select("state", col, F.explode(F.concat(*found)).alias("x")).select("state", col, "x.*")


def may_reach(a: str, b: str, shared: Sequence[Column], min_score: float) -> Column:
    """Whether two names with so many ``shared`` grams of each kind can score ``min_score``.

    An insertion or deletion breaks two pairs of neighbours at most, so texts
    of lengths n and m at distance d share at least max(n, m) - 1 - 2 d pairs,
    and a ratio of r percent means d <= (1 - r / 100) (n + m).  A window of
    the longer text has no more characters than the shorter one, whose pairs
    it must share, and its pairs are the longer text's.  Each form is held
    against the ratio that its weight asks for.  A common word may always do;
    a name of one character shares it with a name that it is like.
    """

    def enough(kind: int, score: float, part: bool) -> Column:
        n, m = (F.length(_forms(x)[kind]) for x in (a, b))
        size, total = (F.least(n, m), 2 * F.least(n, m)) if part else (F.greatest(n, m), n + m)
        broken = F.floor((1.0 - min(score, 100.0) / 100.0) * total + 1e-9)
        return (shared[kind] > 0) & (shared[kind] >= size - 1 - 2 * broken)

    n, m = F.length(a), F.length(b)
    apart = F.greatest(n, m) >= PART_FROM * F.least(n, m)
    whole = enough(0, min_score, False)
    for kind in (1, 2):
        whole = whole | enough(kind, min_score / WORDS_WEIGHT, False)
    part = enough(0, min_score / PART_WEIGHT, True)
    for kind in (1, 2):
        part = part | enough(kind, min_score / PART_WEIGHT / WORDS_WEIGHT, True)
    return whole | apart & part | (shared[WORD] > 0) | (F.least(n, m) == 1) & (shared[CHARACTER] > 0)


def fuzzy_candidates(raw: DataFrame, master: DataFrame, min_score: float = FUZZY_MIN_SCORE) -> DataFrame:
    """(state, raw, standard): every pair that can reach ``min_score``, and few others."""
    r = raw.select("state", "raw").distinct()
    m = master.select("state", F.col("county").alias("standard")).distinct()
    met = _grams(r, "raw").join(_grams(m, "standard"), ["state", "kind", "gram", "nth"])
    # Single characters matter only where a name is one.
    met = met.where((F.col("kind") < CHARACTER) | (F.least(F.length("raw"), F.length("standard")) == 1))
    counted = met.groupBy("state", "raw", "standard").agg(*[F.count_if(F.col("kind") == k).alias(f"k{k}") for k in range(CHARACTER + 1)])
    reach = may_reach("raw", "standard", [F.col(f"k{k}") for k in range(CHARACTER + 1)], min_score)
    return counted.where(reach).select("state", "raw", "standard")


def ranked_matches(raw: DataFrame, master: DataFrame, min_score: float = FUZZY_MIN_SCORE) -> DataFrame:
    """win_best_match: (state, raw, standard, score, place), the pairs that
    reach ``min_score``; a raw name's best match has place 1, ties go to the
    smaller name."""
    found = fuzzy_candidates(raw, master, min_score).withColumn("score", fuzzy_score(F.col("raw"), F.col("standard")))
    found = found.where(F.col("score") >= F.lit(min_score))
    w = Window.partitionBy("state", "raw").orderBy(F.col("score").desc(), F.col("standard").asc())
    return found.withColumn("place", F.row_number().over(w))


def fuzzy_map(raw: DataFrame, master: DataFrame, min_score: float = FUZZY_MIN_SCORE) -> DataFrame:
    """join_fuzzy_top1: the best master county of every raw name, kept when
    its score reaches ``min_score``."""
    return ranked_matches(raw, master, min_score).where("place = 1").drop("place")
