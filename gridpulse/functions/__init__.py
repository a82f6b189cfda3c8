"""Column-expression helpers (all JVM-side built-ins, no Python UDFs)."""

from gridpulse.functions.text import (
    clean_numeric,
    fn_title,
    null_if_literal,
    normalize_county,
    normalize_name,
    strip_county_word,
)
from gridpulse.functions.numeric import display_metric, half_even_round
from gridpulse.functions.time import micros_between, parse_timestamp

__all__ = [
    "clean_numeric",
    "display_metric",
    "fn_title",
    "half_even_round",
    "micros_between",
    "normalize_county",
    "normalize_name",
    "null_if_literal",
    "parse_timestamp",
    "strip_county_word",
]
