"""Scalar text and number cleaning (P2, P3, P4) as Column expressions."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column, functions as F

# The characters that count as white space when text is trimmed.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
              "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
              "\u2028\u2029\u202f\u205f\u3000")

# Text forms of a float (digits may be grouped by single underscores).
_DIGITS = r"\d(?:_?\d)*"
FLOAT_PATTERN = (rf"^[+-]?(?:{_DIGITS}\.?(?:{_DIGITS})?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?$")
NUMBER_CHARACTERS = r"^[0123456789.eE+-]+$"
INFINITY_PATTERN = r"^[+-]?(?i:inf(?:inity)?)$"
NAN_PATTERN = r"^[+-]?(?i:nan)$"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    """Text of any value without surrounding Unicode white space."""
    return F.btrim(_col(c).cast("string"), F.lit(WHITESPACE))


def clean_text(c: Column | str) -> Column:
    """Trimmed text, blank becomes null."""
    return F.nullif(strip(c), F.lit(""))


def clean_email(c: Column | str) -> Column:
    """Trimmed, lower-cased text, blank becomes null."""
    return F.lower(clean_text(c))


@lru_cache(maxsize=1)
def _other_digits() -> tuple[str, str]:
    """The decimal digits of all scripts but ASCII, and the ASCII digit that each stands for."""
    found = [c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.decimal(c, None) is not None]
    return "".join(found), "".join(str(unicodedata.decimal(c)) for c in found)


def ascii_digits(text: Column) -> Column:
    """Decimal digits of any script as ASCII digits."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, text).otherwise(F.translate(text, *_other_digits()))


def to_number(c: Column | str, stripped: bool = False) -> Column:
    """Text to double, anything that is not a number becomes null.
    ``stripped`` says that the text has no outer white space any more.

    The shape is checked first because a plain cast also takes ``1d`` and hex
    floats, and takes neither grouped digits nor those of other scripts.
    """
    text = _col(c) if stripped else strip(c)
    # Of these characters alone, a cast takes exactly the numbers; '' is no match.
    grouped = F.replace(F.regexp_extract(ascii_digits(text), FLOAT_PATTERN, 0), F.lit("_"), F.lit(""))
    return (F.when(text.rlike(NUMBER_CHARACTERS), text.try_cast("double"))
            .when(text.rlike(INFINITY_PATTERN), text.try_cast("double"))
            .when(text.rlike(NAN_PATTERN), F.lit(float("nan")))
            .otherwise(grouped.try_cast("double")))


def is_blank(c: Column | str) -> Column:
    """Null or nothing but white space."""
    return F.coalesce(strip(c) == "", F.lit(True))
