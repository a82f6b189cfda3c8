"""Numeric presentation helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridpulse.constants import ROUND_DIGITS, SMALL_LABEL, SMALL_THRESHOLD


def half_even_round(c: Column | str, digits: int = ROUND_DIGITS) -> Column:
    """Round like the source pipeline's float rounding.

    Scale by 10**digits, round half to even on the binary double (``rint``),
    scale back: the same IEEE steps a NumPy round takes, so ties resolve the
    same way (``bround`` works on the decimal expansion and can differ).
    """
    c = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** digits)
    return F.rint(c * F.lit(scale)) / F.lit(scale)


def display_metric(rounded: Column | str, digits: int = ROUND_DIGITS) -> Column:
    """Text shown on the dashboard for an already rounded metric.

    null -> ``0.0``; ``|x| < 0.0001`` (true zeros included) -> ``<0.0001``;
    else the shortest decimal text with at least one fractional digit
    (``12.0``, ``0.0123``), never scientific notation.
    """
    x = F.col(rounded) if isinstance(rounded, str) else rounded
    text = x.cast(f"decimal(38,{digits})").cast("string")
    text = F.regexp_replace(F.regexp_replace(text, "0+$", ""), r"\.$", ".0")
    return (
        F.when(x.isNull(), F.lit("0.0"))
        .when(F.abs(x) < F.lit(SMALL_THRESHOLD), F.lit(SMALL_LABEL))
        .otherwise(text)
    )
