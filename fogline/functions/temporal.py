"""UTC instants, Pacific calendar values and feed timestamps."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

PACIFIC = "America/Los_Angeles"
US_PER_SEC = 1_000_000
US_PER_DAY = 86_400 * US_PER_SEC
POLL_SECONDS = 60

_SNAPSHOT_PATTERN = "yyyy-MM-dd'T'HH-mm-ss.SSSSSS'Z'"


def pacific_date(ts: Column, tz: str = PACIFIC) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, tz))


def pacific_tod_us(ts: Column, tz: str = PACIFIC) -> Column:
    """Microseconds since local midnight, for range predicates."""
    local = F.from_utc_timestamp(ts, tz)
    return F.pmod(F.unix_micros(local), F.lit(US_PER_DAY))


def pacific_tod_text(ts: Column, tz: str = PACIFIC) -> Column:
    return F.date_format(F.from_utc_timestamp(ts, tz), "HH:mm:ss.SSSSSS")


def tod_us(text: str) -> int:
    """'HH:MM[:SS]' -> microseconds since midnight."""
    t = dt.time.fromisoformat(text)
    return ((t.hour * 60 + t.minute) * 60 + t.second) * US_PER_SEC + t.microsecond


def local_text_to_utc(text: Column, tz: str) -> Column:
    """Floating local timestamp text -> UTC instant; NULL when it does not parse."""
    return F.to_utc_timestamp(F.try_to_timestamp(F.nullif(F.trim(text), F.lit(""))), tz)


def text_to_utc(text: Column) -> Column:
    return local_text_to_utc(text, "UTC")


def pacific_range_to_utc(
    start_date: str | None, end_date: str | None, tz: str = PACIFIC
) -> tuple[Column | None, Column | None]:
    """Inclusive local dates -> half-open UTC bounds, daylight saving included."""
    if not start_date or not end_date:
        return None, None
    after_end = (dt.date.fromisoformat(end_date) + dt.timedelta(days=1)).isoformat()
    dt.date.fromisoformat(start_date)
    return (
        F.to_utc_timestamp(F.lit(start_date).cast("timestamp"), tz),
        F.to_utc_timestamp(F.lit(after_end).cast("timestamp"), tz),
    )


def utc_to_pacific_date_text(ts: Column, tz: str = PACIFIC) -> Column:
    return F.date_format(F.from_utc_timestamp(ts, tz), "yyyy-MM-dd")


def epoch_to_ts(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def snapshot_ts_from_path(path: Column) -> Column:
    """'<...>/2026-06-23T00-00-00.000000Z.pb' -> instant; NULL when the name is not a timestamp."""
    name = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.pb$", "")
    # Fewer than six fraction digits are accepted by padding on the right.
    padded = F.regexp_replace(
        F.concat(F.regexp_extract(name, r"^(\d{4}-\d{2}-\d{2}T\d{2}-\d{2}-\d{2}\.\d{1,6})Z$", 1), F.lit("000000")),
        r"(\.\d{6})\d*$",
        "$1",
    )
    return F.try_to_timestamp(F.concat(padded, F.lit("Z")), F.lit(_SNAPSHOT_PATTERN))


def yyyymmdd_or(text: Column, fallback: Column) -> Column:
    return F.coalesce(F.try_to_date(text, "yyyyMMdd"), fallback)


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(float(US_PER_SEC))


def floor_hour(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def lookback_dates(end_date: str, days: int = 10) -> tuple[dt.date, dt.date]:
    """First and last day of the window that ends at ``end_date`` and holds ``days`` days."""
    if days < 1:
        raise ValueError("days must be at least 1")
    end = dt.date.fromisoformat(end_date)
    return end - dt.timedelta(days=days - 1), end


def on_slot(ts: Column, interval_seconds: int, base_seconds: int = POLL_SECONDS) -> Column:
    """True on the polling slots that an ``interval_seconds`` schedule serves."""
    every = max(1, -(-interval_seconds // base_seconds)) if interval_seconds > 0 else 1
    slot = F.floor(F.unix_micros(ts) / F.lit(float(base_seconds * US_PER_SEC)))
    return F.pmod(slot, F.lit(every)) == 0


def is_past_date(text: Column, as_of: Column) -> Column:
    """A real ISO date that lies before ``as_of``."""
    trimmed = F.trim(text)
    shaped = trimmed.rlike(r"^\d{4}-\d{2}-\d{2}$")
    parsed = F.try_to_date(F.when(shaped, trimmed), "yyyy-MM-dd")
    return F.coalesce(parsed < as_of, F.lit(False))
