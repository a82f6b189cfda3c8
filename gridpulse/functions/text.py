"""String expressions used while standardizing raw feeds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridpulse.constants import NULL_LITERALS


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def null_if_literal(c: Column | str, literals=NULL_LITERALS) -> Column:
    """Text the CSV reader of the source pipeline treats as missing -> NULL.

    The text is compared as it is: ``' NA '`` and blanks are values, as there.
    """
    c = _col(c)
    return F.when(c.isin(list(literals)), F.lit(None).cast("string")).otherwise(c)


def normalize_name(c: Column | str) -> Column:
    """trim + lower: canonical form of column names and map keys."""
    return F.lower(F.trim(_col(c)))


def normalize_county(c: Column | str) -> Column:
    """trim, lower, and ``xx-name`` -> ``xx - name`` (two-letter prefix)."""
    return F.regexp_replace(normalize_name(c), r"^([a-z]{2})-", "$1 - ")


def strip_county_word(c: Column | str) -> Column:
    """lower, remove every ``county`` substring, trim (master list rule)."""
    return F.trim(F.regexp_replace(F.lower(_col(c)), "county", ""))


def clean_numeric(c: Column | str) -> Column:
    """Remove quotes and thousands separators, parse, bad or missing -> 0.

    NaN/inf text never reaches here as a number: NaN literals are nulled at
    ingest, and ``nanvl`` maps a parsed NaN to 0 like a failed parse.
    """
    cleaned = F.regexp_replace(_col(c).cast("string"), '[",]', "")
    parsed = cleaned.try_cast("double")
    return F.coalesce(F.nanvl(parsed, F.lit(None).cast("double")), F.lit(0.0))


def fn_title(c: Column | str) -> Column:
    """Python ``str.title()``: upper-case every letter that follows a non-letter.

    ``initcap`` only capitalizes after white space (``Miami-dade``); splitting
    at each non-letter -> letter boundary first gives ``Miami-Dade``,
    ``O'Brien`` and ``C12X``.
    """
    parts = F.split(F.lower(_col(c)), r"(?<=[^\p{L}])(?=\p{L})")
    return F.array_join(F.transform(parts, lambda p: F.initcap(p)), "")
