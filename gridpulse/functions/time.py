"""Timestamp parsing and arithmetic on ``timestamp_ntz`` (time-zone free)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



# English month names by their first three letters.
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
# The date and time shapes that are read part by part.
SHAPES = (
    r"^(?:\d{4}[-/]\d{1,2}[-/]\d{1,2}"
    r"|\d{1,2}[-/]\d{1,2}[-/](?:\d{4}|\d{2})"
    r"|[A-Za-z]{3}[a-z]*\.? +\d{1,2},? +\d{4}"
    r"|\d{1,2}[- ]+[A-Za-z]{3}[a-z]*\.?,?[- ]+\d{4})"
    r"(?:,? +\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,6})?)?)?$"
)
AM_PM = r" *([AaPp])\.?[Mm]\.?$"


def parse_timestamp(c: Column | str) -> Column:
    """Parse mixed-format text to ``timestamp_ntz``; unparseable -> NULL.

    Dates: ``yyyy-MM-dd``, ``yyyy/MM/dd``, ``yyyyMMdd``, ``MM-dd-yyyy`` and
    ``MM/dd/yyyy`` (one or two digits, two-digit years 1969 to 2068),
    ``MMM d, yyyy`` and ``d MMM yyyy`` (names in full or short).  Times:
    ``HH:mm``, optional seconds and fraction, after a blank or ``T``, with
    optional AM/PM.  The parts are pulled out once, written as ISO text and
    checked by one ``try_cast``, so no format is tried in turn.  Other shapes
    are left to the cast itself.
    """
    raw = F.trim((F.col(c) if isinstance(c, str) else c).cast("string"))
    spaced = F.regexp_replace(raw, r"(?<=\d)T(?=\d)", " ")
    spaced = F.regexp_replace(spaced, r"^(\d{4})(\d{2})(\d{2})(?=\D|$)", "$1-$2-$3")
    mark = F.lower(F.regexp_extract(raw, AM_PM, 1))
    text = F.regexp_replace(spaced, AM_PM, "")

    def iso(parts: Column) -> Column:
        a, b, d = (F.get(parts, i) for i in range(3))
        hour = F.coalesce(F.get(parts, 3), F.lit("0")).try_cast("int")
        name = F.when(a.rlike("^[A-Za-z]"), a).when(b.rlike("^[A-Za-z]"), b)
        month = F.when(name.isNotNull(), ((F.instr(F.lit(MONTHS), F.lower(F.substring(name, 1, 3))) + 2) / 3).cast("string"))
        year = F.when(F.length(a) == 4, a).when(F.length(d) == 4, d).otherwise(
            F.concat(F.when(d.try_cast("int") < 69, "20").otherwise("19"), d))
        month = F.coalesce(F.regexp_replace(month, r"\.0$", ""), F.when(F.length(a) == 4, b).otherwise(a))
        day = F.when(F.length(a) == 4, d).when(b.rlike("^[A-Za-z]"), a).otherwise(b)
        clock = F.when(mark == "", hour).when(hour.between(1, 12), hour % 12 + F.when(mark == "p", 12).otherwise(0))
        seconds = F.concat(F.coalesce(F.get(parts, 5), F.lit("00")), F.coalesce(F.concat(F.lit("."), F.get(parts, 6)), F.lit("")))
        return F.concat(year, F.lit("-"), F.lpad(month, 2, "0"), F.lit("-"), F.lpad(day, 2, "0"), F.lit(" "),
                        F.lpad(clock.cast("string"), 2, "0"), F.lit(":"), F.coalesce(F.get(parts, 4), F.lit("00")), F.lit(":"), seconds)

    # A one-element array, so that the parts are pulled out once however often they are used.
    parts = F.array(F.regexp_extract_all(text, F.lit("[0-9]+|[A-Za-z]+"), F.lit(0)))
    apart = F.when(text.rlike(SHAPES), F.get(F.transform(parts, iso), 0)).try_cast("timestamp_ntz")
    # Most feeds write ISO or US dates, which need one replacement and one cast.
    plain = F.regexp_replace(raw, r"^(\d{1,2})[-/](\d{1,2})[-/](\d{4})", "$3-$1-$2").try_cast("timestamp_ntz")
    return F.coalesce(plain, apart)


def micros_between(start: Column | str, end: Column | str) -> Column:
    """Whole microseconds from ``start`` to ``end`` of two ``timestamp_ntz``.

    ``timestamp_diff`` casts NTZ values through the session time zone (an
    hour off across a DST change); the NTZ difference is an exact day-time
    interval, turned into microseconds by adding it to the epoch instant.
    """
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.unix_micros(F.timestamp_micros(F.lit(0)) + (e - s))
