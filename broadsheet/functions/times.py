"""Time columns: tolerant parsing, ISO week labels, ages. The clock is always a column given by the caller."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_text(text: Column) -> Column:
    """Trimmed, Z written as an offset, '' as NULL; nothing is validated."""
    return F.replace(F.nullif(F.trim(text), F.lit("")), F.lit("Z"), F.lit("+00:00"))


def parse_iso(text: Column) -> Column:
    """A timestamp of ISO text; a text without an offset is UTC by the session's zone; anything else is NULL."""
    return text.try_cast("timestamp")


def parse_feed(text: Column) -> Column:
    """RFC 822 dates of feeds, the weekday ignored, or ISO text."""
    bare = F.regexp_replace(F.trim(text), "^[A-Za-z]{3}, *", "")
    return F.coalesce(F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss z")), F.try_to_timestamp(bare, F.lit("d MMM yyyy HH:mm:ss Z")), parse_iso(text))


def week_label(ts: Column) -> Column:
    """ISO week as YYYY-Www."""
    return F.concat(F.extract(F.lit("YEAROFWEEK"), ts).cast("string"), F.lit("-W"), F.lpad(F.weekofyear(ts).cast("string"), 2, "0"))


def day_bucket(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd")


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def age_days(as_of: Column, ts: Column) -> Column:
    """Whole days, rounded down."""
    return F.floor(seconds_between(as_of, ts) / F.lit(86400.0))


def time_boost(as_of: Column, ts: Column) -> Column:
    """A fresh article's bonus: 3 today down to -2 beyond two weeks, -2 also without a date."""
    days = F.coalesce(age_days(as_of, ts), F.lit(999))
    return F.when(days <= 0, 3).when(days <= 2, 2).when(days <= 4, 1).when(days <= 7, 0).when(days <= 14, -1).otherwise(-2)
