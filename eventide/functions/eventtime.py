"""Event-time arithmetic in whole microseconds."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def micros(span: timedelta) -> int:
    return span // timedelta(microseconds=1)


def from_seconds(col: Column | str) -> Column:
    return F.timestamp_seconds(col)


def from_millis(col: Column | str) -> Column:
    return F.timestamp_millis(col)


def epoch_micros(ts: Column | str) -> Column:
    return F.unix_micros(ts)


def bucket(value: Column, width: int) -> Column:
    """floor(value / width) on longs, right for values below zero too."""
    w = F.lit(width).cast("long")
    return F.call_function("div", value - F.pmod(value, w), w)


def instant(index: Column, width: int) -> Column:
    """The timestamp `index` widths after the epoch."""
    return F.timestamp_micros(index * F.lit(width).cast("long"))


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def utc_clock(ts: Column | str) -> Column:
    """The zone-less UTC time of an instant, whatever the session's zone is."""
    return F.timestamp_add("MICROSECOND", epoch_micros(ts), _epoch())


def from_utc_clock(clock: Column | str) -> Column:
    """The instant of a zone-less UTC time, whatever the session's zone is."""
    since = (F.col(clock) if isinstance(clock, str) else clock) - _epoch()
    minutes = F.lit(0).cast("long")
    for unit, size in (("DAY", 24 * 60), ("HOUR", 60), ("MINUTE", 1)):
        minutes = minutes + F.extract(F.lit(unit), since).cast("long") * size
    seconds = F.extract(F.lit("SECOND"), since)
    return F.timestamp_micros(minutes * 60_000_000 + (seconds * 1_000_000).cast("long"))


def local_day(ts: Column | str, zone: str) -> Column:
    """Calendar day of an instant in `zone`, e.g. '+08:00', whatever the session's zone is."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc_clock(ts)).cast("date")


def local_day_end(day: Column | str, zone: str) -> Column:
    """The instant at which a calendar day ends in `zone`."""
    midnight = F.date_add(day, 1).cast("timestamp_ntz")
    return from_utc_clock(F.convert_timezone(F.lit(zone), F.lit("UTC"), midnight))


def window_end(ts: Column | str, size: timedelta) -> Column:
    """End of the tumbling, epoch-aligned window that holds `ts`."""
    width = micros(size)
    return instant(bucket(epoch_micros(ts), width) + 1, width)
