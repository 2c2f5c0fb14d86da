"""Timestamp parsing and formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EVENT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_timestamp(text: str | Column, fmt: str | None = None, *, strict: bool = False) -> Column:
    """Text -> timestamp.

    Lenient by default: text that does not parse becomes NULL instead of
    failing the job (Spark's ANSI mode makes ``to_timestamp`` raise).  An
    offset in the text is converted into the session time zone.
    """
    c = _col(text)
    if strict:
        return F.to_timestamp(c, fmt) if fmt else F.to_timestamp(c)
    return F.try_to_timestamp(c, F.lit(fmt)) if fmt else F.try_to_timestamp(c)


def format_event_time(text: str | Column, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """ISO timestamp text -> ``yyyy-MM-dd HH:mm:ss`` text (seconds, truncated)."""
    return F.date_format(parse_timestamp(text), fmt)
