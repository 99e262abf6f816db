"""Timestamp parsing and rendering (P5, P9, P10) as Column expressions.

All parsing ends in ``try_cast``: its hand-written parser returns null without
raising, while pattern formatters throw an exception for every row that does
not fit, which is far too slow when whole feeds use another format.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.functions.text import strip

# Accepted shapes.
DAY_FIRST = r"^\d{1,2}-\d{1,2}-\d{4}$"
PLAIN = r"^\d{4}-\d{1,2}-\d{1,2}[T ]\d{1,2}:\d{1,2}:\d{1,2}$"
EXTENDED = (r"^\d{4}-\d\d-\d\d(?:T\d\d(?::\d\d(?::\d\d(?:\.\d+)?)?)?"
            r"(?:[+-]\d\d(?::\d\d(?::\d\d)?)?)?)?$")
WEEK_DATE = r"^(\d{4})-?W(\d\d)(?:-?([1-7]))?$"
WEEK_AND_TIME = (r"^(\d{4}-W\d\d-[1-7](?=\D)|\d{4}W\d\d[1-7]?(?=\D)|\d{4}-W\d\d(?=\D)).(\d\d.*)$")


def _iso_text(text: Column) -> Column:
    """Rewrite the compact and mixed ISO-8601 spellings to the extended one."""
    rewrites = [
        (r"^(\d{4})(\d\d)(\d\d)(?=\D|$)", "$1-$2-$3"),
        (r"^(\d{4}-\d\d-\d\d).(?=\d\d)", "$1T"),
        (r"^(.{10}T\d\d)(\d\d)(\d\d)?(?=[^\d:]|$)", "$1:$2:$3"),
        (r"^(.{10}T\d\d:\d\d):(?=[^\d]|$)", "$1"),
        (r"([+-]\d\d)(\d\d)$", "$1:$2"),
        # A cast takes an offset behind seconds only.
        (r"T(\d\d)([+-])", "T$1:00$2"),
        (r"T(\d\d:\d\d)([+-])", "T$1:00$2"),
    ]
    out = F.replace(F.replace(text, F.lit("Z"), F.lit("+00:00")), F.lit(","), F.lit("."))
    for pattern, replacement in rewrites:
        out = F.regexp_replace(out, pattern, replacement)
    return out


def _week_date(text: Column) -> Column:
    """ISO week date; the day defaults to Monday, a week the year lacks is null."""
    digits = F.replace(text, F.lit("-"), F.lit(""))
    year, week = (F.substring(digits, at, n).try_cast("int") for at, n in ((1, 4), (6, 2)))
    day = F.coalesce(F.substring(digits, 8, 1).try_cast("int"), F.lit(1))
    fourth = F.make_date(year, F.lit(1), F.lit(4))
    date = F.date_add(fourth, (week - 1) * 7 + day - 1 - F.weekday(fourth))
    return F.when(F.weekofyear(date) == week, date.cast("timestamp"))


def _extended(text: Column) -> Column:
    # No match extracts '', which casts to null.
    return F.regexp_extract(_iso_text(text), EXTENDED, 0).try_cast("timestamp")


def _other_iso(text: Column) -> Column:
    day = F.date_format(_week_date(F.regexp_extract(text, WEEK_AND_TIME, 1)), "yyyy-MM-dd")
    return (F.when(text.rlike(WEEK_DATE), _week_date(text))
            .when(text.rlike(WEEK_AND_TIME),
                  _extended(F.concat(day, F.lit("T"), F.regexp_extract(text, WEEK_AND_TIME, 2))))
            .otherwise(_extended(text)))


def parse_instant(c: Column | str, stripped: bool = False) -> Column:
    """P5: business timestamp of a feed; no zone means UTC, failure is null.
    ``stripped`` says that the text has no outer white space any more."""
    text = (F.col(c) if isinstance(c, str) else c) if stripped else strip(c)
    # A day in front is the only spelling with a dash this early.
    month = F.substring_index(F.substring_index(text, "-", 2), "-", -1)
    day_first = F.when(text.rlike(DAY_FIRST), F.concat_ws(
        "-", F.substring(text, -4, 4), month, F.substring_index(text, "-", 1))
        .try_cast("timestamp"))
    return (F.when(F.instr(text, "-").between(2, 3), day_first)
            .when(text.rlike(PLAIN), text.try_cast("timestamp"))
            .otherwise(_other_iso(text)))


def parse_iso(c: Column | str) -> Column:
    """Lenient ISO-8601 on persist, failure is null."""
    return _other_iso(strip(c))


def iso_format(c: Column | str) -> Column:
    """P10: instant as ISO-8601 text in UTC, microseconds only when present."""
    ts = F.col(c) if isinstance(c, str) else c
    micros = F.date_format(ts, "SSSSSS")
    fraction = F.when(micros != "000000", F.concat(F.lit("."), micros)).otherwise("")
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("+00:00"))
