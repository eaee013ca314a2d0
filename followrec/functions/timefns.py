"""Time expressions (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts_text(text) -> Column:
    """Feed timestamp text read by character position.

    Positions 1-10 are the date and 12-19 the time; the character between them
    may be anything (blank, 'T', ...) and anything after position 19 (fraction,
    zone suffix) is ignored. Result is a zone-free timestamp, whole seconds.
    """
    t = _c(text)
    return F.to_timestamp_ntz(
        F.concat(F.substring(t, 1, 10), F.lit(" "), F.substring(t, 12, 8)),
        F.lit("yyyy-MM-dd HH:mm:ss"),
    )


def epoch_seconds(ts) -> Column:
    """Whole epoch seconds (floor) of a zone-free UTC timestamp."""
    return F.unix_timestamp(_c(ts))


def decay_remainder(ts, as_of_epoch: int, lookback_seconds: int) -> Column:
    """L - age in whole seconds, as bigint.

    The decayed weight of one engagement is max(0, remainder) / L; keeping the
    integer remainder makes sums exact and rankings order-independent. There
    is no upper clamp: an engagement after `as_of` weighs more than 1.
    """
    return F.lit(lookback_seconds).cast("bigint") - (
        F.lit(as_of_epoch).cast("bigint") - epoch_seconds(ts)
    )


def recent_follow(ts, since: date) -> Column:
    """Follow recency at date level: calendar day of ts >= `since`."""
    return F.to_date(_c(ts)) >= F.lit(since)


def date_folder(ts) -> Column:
    """Daily folder name yyyyMMdd."""
    return F.date_format(_c(ts), "yyyyMMdd")


def iso_z_to_date(text) -> Column:
    """Message 'yyyy-MM-ddTHH:mm:ssZ' text to its calendar date (no zone shift)."""
    return F.to_date(F.to_timestamp_ntz(_c(text), F.lit("yyyy-MM-dd'T'HH:mm:ss'Z'")))


def days_since(d, anchor: date) -> Column:
    return F.datediff(_c(d), F.lit(anchor))


def week_bin(day, bin_days: int, max_day: int) -> Column:
    """Right-closed bins (0,b], (b,2b], ... up to max_day; null outside."""
    d = _c(day)
    return F.when((d >= 1) & (d <= max_day), F.floor((d - 1) / bin_days).cast("int"))


def week_bounds(week_idx, anchor: date, bin_days: int):
    """First and last calendar day of a bin."""
    w = _c(week_idx)
    start = F.date_add(F.lit(anchor), w * bin_days + 1)
    end = F.date_add(F.lit(anchor), w * bin_days + bin_days)
    return start, end
