"""The instant a computation is made for, as a Column."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, functions as F

AsOf = Column | datetime | str | None


def as_instant(as_of: AsOf) -> Column:
    """Explicit instants make results repeatable; None means now."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of.cast("timestamp")
    return F.lit(str(as_of)).cast("timestamp")
