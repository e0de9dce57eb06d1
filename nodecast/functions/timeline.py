"""Column functions on time: steps, calendar parts, ISO text."""

from __future__ import annotations

import re
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, functions as F, types as T

_UNIT_SECONDS = {
    "us": 1e-6, "microsecond": 1e-6,
    "ms": 1e-3, "millisecond": 1e-3,
    "s": 1, "sec": 1, "second": 1,
    "min": 60, "minute": 60, "t": 60,
    "h": 3600, "hour": 3600,
    "d": 86400, "day": 86400,
    "w": 604800, "week": 604800,
}


def step_micros(step: str) -> int:
    """Length in microseconds of a step such as ``1min``, ``90s``, ``7 days``."""
    parts = re.fullmatch(r"\s*(\d*)\s*([A-Za-z]+)\s*", step)
    unit = parts and parts.group(2).lower()
    if unit and unit not in _UNIT_SECONDS:
        unit = unit.removesuffix("s")
    if not unit or unit not in _UNIT_SECONDS:
        raise ValueError(f"not a fixed time step: {step!r}")
    micros = round(int(parts.group(1) or 1) * _UNIT_SECONDS[unit] * 1_000_000)
    if micros <= 0:
        raise ValueError(f"a time step must be positive: {step!r}")
    return micros


def micros_interval(micros: int) -> Column:
    return F.make_dt_interval(secs=F.lit(micros / 1_000_000).cast("decimal(18,6)"))


def floor_to(timestamp: Column, micros: int) -> Column:
    """Start of the epoch-aligned step that holds the timestamp."""
    at = F.unix_micros(timestamp)
    return F.timestamp_micros(at - F.pmod(at, F.lit(micros)))


def as_utc(moment: str | datetime) -> datetime:
    """A driver-side moment in UTC; a naive one is taken to be UTC already."""
    if isinstance(moment, str):
        moment = datetime.fromisoformat(moment)
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def moment(value: datetime) -> Column:
    """A timestamp literal that does not depend on any local time zone."""
    since_epoch = as_utc(value) - datetime(1970, 1, 1, tzinfo=timezone.utc)
    return F.timestamp_micros(F.lit(since_epoch // timedelta(microseconds=1)))


def floor_moment(value: datetime, micros: int) -> datetime:
    """``floor_to`` for a moment on the driver."""
    epoch = datetime(1970, 1, 1, tzinfo=timezone.utc)
    length = timedelta(microseconds=micros)
    return epoch + (as_utc(value) - epoch) // length * length


def parse_timestamp(column: Column, kind: T.DataType) -> Column:
    """Any stored form of a timestamp as TIMESTAMP; unreadable text is NULL."""
    if isinstance(kind, T.StringType):
        return F.try_to_timestamp(column)
    if isinstance(kind, T.IntegralType):  # epoch nanoseconds
        return F.timestamp_micros(F.floor(column / F.lit(1000)).cast("bigint"))
    return column.cast("timestamp")


def iso_text(timestamp: Column) -> Column:
    return F.date_format(timestamp, "yyyy-MM-dd'T'HH:mm:ssxxx")


def seconds_between(later: Column, earlier: Column) -> Column:
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def calendar_parts(timestamp: Column) -> dict[str, Column]:
    return {
        "hour_utc": F.hour(timestamp).cast("smallint"),
        "day_of_week_utc": F.weekday(timestamp).cast("tinyint"),
    }


def minute_cycle(timestamp: Column) -> dict[str, Column]:
    """Minute of day as a point on the unit circle."""
    angle = 2 * F.pi() * (F.hour(timestamp) * 60 + F.minute(timestamp)) / 1440
    return {"minute_sin": F.sin(angle), "minute_cos": F.cos(angle)}
