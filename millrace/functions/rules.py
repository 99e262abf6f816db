"""Validation rules V1-V7 as Column expressions over canonical rows."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace import contract as K
from millrace.functions.text import WHITESPACE, is_blank

# Fixed value: shape of an email address (no white space, one @, a dot after it).
EMAIL_SHAPE = "^[^@{0}]+@[^@{0}]+\\.[^@{0}]+$"
ANY_EMAIL = EMAIL_SHAPE.format(WHITESPACE)
# The same where all characters are ASCII; so small a set is matched by table look-up.
ASCII_EMAIL = EMAIL_SHAPE.format("".join(c for c in WHITESPACE if ord(c) < 128))


def is_email(c: str) -> Column:
    """Whether a text has the shape of an email address; never null."""
    email = F.col(c)
    fits = F.when(F.length(email) == F.octet_length(email), email.rlike(ASCII_EMAIL)).otherwise(
        email.rlike(ANY_EMAIL))
    return F.coalesce(fits, F.lit(False))


def rule_breaches() -> list[tuple[Column, str]]:
    """(condition that breaks the rule, message), in rule order. No condition is null."""
    value = F.col("value")
    return [
        (is_blank("record_id"), K.MISSING_ID),
        (is_blank("name"), K.MISSING_NAME),
        (~is_email("email"), K.INVALID_EMAIL),
        (value.isNull(), K.NOT_NUMERIC),
        (F.coalesce(value < 0, F.lit(False)), K.NEGATIVE_VALUE),
        (F.col("created_at").isNull(), K.INVALID_CREATED),
    ]


def error_list() -> Column:
    """V7: every message that applies, in rule order."""
    return F.array_compact(F.array(*[F.when(bad, F.lit(text)) for bad, text in rule_breaches()]))


def passes_all() -> Column:
    """True when no rule is broken; cheaper than building the list of messages."""
    ok = F.lit(True)
    for bad, _ in rule_breaches():
        ok = ok & ~bad
    return ok
