"""Local days, time buckets and text forms of times."""

from __future__ import annotations

from datetime import date, datetime, time, timedelta, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import Column
from pyspark.sql import functions as F

LOCAL_ZONE = "Asia/Jakarta"


def hhmm_timestamp(day: Column, hhmm: Column) -> Column:
    """UTC time from a yyyy-MM-dd string and an HHMM integer without leading zeros."""
    return F.try_to_timestamp(
        F.concat_ws(" ", day, F.lpad(hhmm.cast("string"), 4, "0")), F.lit("yyyy-MM-dd HHmm")
    )


def local_day_bounds(run_date: str, zone: str = LOCAL_ZONE, days: int = 1) -> tuple[Column, Column]:
    """[start, end) in UTC of the ``days`` local days that end with ``run_date``."""
    last = date.fromisoformat(run_date)
    start, end = last - timedelta(days=days - 1), last + timedelta(days=1)
    return tuple(
        F.to_utc_timestamp(F.lit(d.isoformat()).cast("timestamp"), zone) for d in (start, end)
    )


def in_local_day(ts: Column, run_date: str, zone: str = LOCAL_ZONE, days: int = 1) -> Column:
    start, end = local_day_bounds(run_date, zone, days)
    return (ts >= start) & (ts < end)


def utc_bounds(run_date: str, zone: str = LOCAL_ZONE) -> tuple[datetime, datetime]:
    """[start, end) of a local day in UTC."""
    first = datetime.combine(date.fromisoformat(run_date), time(), ZoneInfo(zone))
    after = datetime.combine(date.fromisoformat(run_date) + timedelta(days=1), time(), ZoneInfo(zone))
    return first.astimezone(timezone.utc), after.astimezone(timezone.utc)


def candidate_utc_days(run_date: str, zone: str = LOCAL_ZONE) -> list[str]:
    """The UTC days that a local day touches, in any zone: a partition filter."""
    start, end = utc_bounds(run_date, zone)
    days = (end - timedelta(microseconds=1)).date() - start.date()
    return [(start.date() + timedelta(days=i)).isoformat() for i in range(days.days + 1)]


def default_run_date(now: datetime | None = None, zone: str = LOCAL_ZONE) -> str:
    """Yesterday in the local zone, the day a run without a date is for."""
    return ((now or datetime.now(timezone.utc)).astimezone(ZoneInfo(zone)).date() - timedelta(days=1)).isoformat()


def local_date(ts: Column, zone: str = LOCAL_ZONE) -> Column:
    return F.to_date(F.from_utc_timestamp(ts, zone))


def run_date_of(ts: Column, zone: str = LOCAL_ZONE, days: int = 1, anchor: str = "2024-01-01") -> Column:
    """Run a row belongs to: the last local day of its window of ``days`` days.

    With one day (the default) this is the local date itself. ``anchor`` is the first day of
    some window and only matters for longer windows.
    """
    day = local_date(ts, zone)
    if days == 1:
        return day
    offset = F.pmod(F.datediff(day, F.lit(anchor).cast("date")), F.lit(days))
    return F.date_add(F.date_sub(day, offset), days - 1)


def floor_minutes(ts: Column, minutes: int = 10) -> Column:
    step = minutes * 60_000_000
    micros = F.unix_micros(ts)
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(step)))


def iso_utc(ts: Column) -> Column:
    """ISO-8601 with a numeric offset (+00:00); fractions only where there are any."""
    seconds = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    fraction = F.when(micros == 0, F.lit("")).otherwise(
        F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))
    )
    return F.concat(seconds, fraction, F.lit("+00:00"))


def hour_path(ts: Column) -> tuple[Column, Column]:
    """Directory and file prefix of an hourly feed file."""
    folder = F.concat_ws("/", F.date_format(ts, "yyyyMM"), F.date_format(ts, "dd"))
    prefix = F.concat(F.lit("H09_"), F.date_format(ts, "yyyyMMdd_HH"), F.lit("00"))
    return folder, prefix
