"""Small Column builders. Everything stays inside Spark's built-in functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tidy(column: str) -> Column:
    """Lower-cased text without surrounding blanks; null stays null."""
    return F.lower(F.trim(F.col(column)))


def parse_time(column: str, pattern: str) -> Column:
    """Timestamp from text, null where the text does not fit (also under ANSI mode)."""
    return F.try_to_timestamp(F.col(column), F.lit(pattern))


def parse_time_or_iso(column: str, pattern: str) -> Column:
    """Like ``parse_time``; a text that does not fit may also be an ISO date, alone or with a time, with a zone or not."""
    iso = F.when(F.col(column).rlike(r"^\s*\d{4}-\d{2}-\d{2}([ T]\d.*)?\s*$"), F.col(column))
    return F.coalesce(parse_time(column, pattern), iso.try_cast("timestamp"))


def whole_seconds(column: str) -> Column:
    """Seconds since the epoch, sub-second part cut off (floor)."""
    return F.unix_seconds(F.col(column))


def slot_start(seconds: Column, width: int) -> Column:
    """Start of the fixed-width slot that holds ``seconds``; correct before 1970 too."""
    return seconds - F.pmod(seconds, F.lit(width).cast("long"))


def share(part: str, whole: str, digits: int | None = 4) -> Column:
    """``part / whole`` where ``whole > 0``, else 0.0; unrounded when ``digits`` is None."""
    ratio = F.col(part) / F.col(whole)
    if digits is not None:
        ratio = F.round(ratio, digits)
    return F.when(F.col(whole) > 0, ratio).otherwise(F.lit(0.0))


def exact_mean(column: str, scale: int = 4) -> Column:
    """Mean of values that carry ``scale`` decimals, through decimals: no float noise before rounding."""
    return F.avg(F.col(column).cast(f"decimal(18,{scale})"))
