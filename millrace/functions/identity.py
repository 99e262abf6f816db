"""Row identity: fingerprints (P8) and content-based ids."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from millrace.functions.text import strip


def _part(c: Column | str) -> Column:
    return F.lower(strip(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))))


def fingerprint(record_id: Column | str = "record_id", email: Column | str = "email") -> Column:
    """Hex SHA-256 of the trimmed, lower-cased id and email.

    Never null; saying so keeps joins on it from adding a filter that would compute
    the digest a second time.
    """
    return F.coalesce(F.sha2(F.concat_ws("|", _part(record_id), _part(email)), 256), F.lit(""))


def content_id(prefix: str, *parts: Column | str) -> Column:
    """Id that depends on what a row says, not on when it was written, so a
    rescan produces the same id and insert-if-absent drops it."""
    cols = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("-"))
            for p in parts]
    return F.concat(F.lit(prefix), F.substring(F.sha2(F.concat_ws("\x1f", *cols), 256), 1, 32))
