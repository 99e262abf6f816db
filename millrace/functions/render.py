"""Fixed-point text and rounding, exact on the binary value with ties to even.

``round`` and ``format_string`` round the shortest decimal form and take ties up;
``format_number`` with a pattern rounds the value itself, ties to even, which is
what ``2.675 -> 2.67`` and ``0.25 -> 0.2`` need.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_PLACE = re.compile(r"%(?:\.(\d)f|d|s|%)")


def fixed(c: Column, places: int) -> Column:
    """A double as text with the given number of decimals."""
    value = c.cast("double")
    pattern = "0." + "0" * places if places else "0"
    text = F.call_function("format_number", value, F.lit(pattern))
    return (F.when(F.isnan(value), "nan").when(value == float("inf"), "inf")
            .when(value == float("-inf"), "-inf").otherwise(text))


def round_even(c: Column, places: int) -> Column:
    """A double rounded to the given number of decimals."""
    return fixed(c, places).try_cast("double")


def fill(template: str, *values: Column) -> Column:
    """A text with its places (%.1f, %d, %s) filled in."""
    given = iter(values)
    texts: list[Column] = []

    def place(match: re.Match) -> str:
        if match.group() == "%%":
            return "%%"
        value = next(given)
        texts.append(fixed(value, int(match.group(1))) if match.group(1)
                     else value.cast("string"))
        return "%s"

    return F.format_string(_PLACE.sub(place, template), *texts)
