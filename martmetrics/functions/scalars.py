"""Scalar column functions (all built-in expressions, kept inside whole-stage codegen)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import LOCAL_OFFSET_SECONDS

_MS_PER_DAY = 86400000
_EPOCH = "1970-01-01"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_date_from_epoch_ms(ms, offset_seconds: int = LOCAL_OFFSET_SECONDS) -> Column:
    """Local calendar day of an epoch-milliseconds instant (UTC + offset).

    Pure integer arithmetic, so it does not depend on the session time zone.
    """
    days = F.floor((_c(ms) + F.lit(offset_seconds * 1000)) / F.lit(_MS_PER_DAY)).cast("int")
    return F.date_add(F.lit(_EPOCH).cast("date"), days)


def local_stamp_from_epoch_ms(ms, fmt: str = "yyyy-MM-dd HH:mm:ss",
                              offset_seconds: int = LOCAL_OFFSET_SECONDS) -> Column:
    """``from_unixtime((ms + offset_ms) / 1000, fmt)`` rendered on a UTC session clock."""
    secs = ((_c(ms) + F.lit(offset_seconds * 1000)) / F.lit(1000)).cast("bigint")
    return F.date_format(F.timestamp_seconds(secs), fmt)


def epoch_ms_bounds(start: str, end: str, offset_seconds: int = LOCAL_OFFSET_SECONDS) -> tuple[int, int]:
    """Half-open epoch-ms range [lo, hi) of instants whose local day is in [start, end].

    Lets a local-day filter run as a plain range on the raw column (pushed to the scan).
    """
    d0 = _dt.date.fromisoformat(str(start))
    d1 = _dt.date.fromisoformat(str(end)) + _dt.timedelta(days=1)
    epoch = _dt.date(1970, 1, 1)
    lo = (d0 - epoch).days * _MS_PER_DAY - offset_seconds * 1000
    hi = (d1 - epoch).days * _MS_PER_DAY - offset_seconds * 1000
    return lo, hi


def local_today(as_of=None, offset_seconds: int = LOCAL_OFFSET_SECONDS) -> Column:
    """Local date of ``as_of`` (a UTC timestamp string/Column); the wall clock if None."""
    ts = F.current_timestamp() if as_of is None else (F.lit(as_of).cast("timestamp")
                                                      if not isinstance(as_of, Column) else as_of)
    return F.to_date(ts + F.make_interval(secs=F.lit(offset_seconds)))


def report_stamp(as_of=None, fmt: str = "yyyy-MM-dd HH:mm",
                 offset_seconds: int = LOCAL_OFFSET_SECONDS) -> Column:
    """Run-time stamp in local time (``as_of`` pins it for reproducible runs)."""
    ts = F.current_timestamp() if as_of is None else (F.lit(as_of).cast("timestamp")
                                                      if not isinstance(as_of, Column) else as_of)
    return F.date_format(ts + F.make_interval(secs=F.lit(offset_seconds)), fmt)


def weekday_label(d) -> Column:
    """Three-letter weekday ('Mon'...'Sun'), like ``strftime('%a')`` in the C locale."""
    return F.date_format(_c(d), "EEE")


def iso_date(d) -> Column:
    """ISO day string ``yyyy-MM-dd`` (``strftime('%F')``)."""
    return F.date_format(_c(d), "yyyy-MM-dd")


def fill_blank(c, value: str = "Blank") -> Column:
    return F.coalesce(_c(c), F.lit(value))


def safe_ratio(num, den) -> Column:
    """num / den as double; NULL when den is 0 or NULL (Hive semantics, no ANSI error)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def format_indian(x) -> Column:
    """Indian digit grouping of a number with its decimals dropped after 2-dp rounding.

    1234567.999 -> '12,34,568'; -1234.5 -> '-1,234'. Rounding is half-up at 2 dp, then the
    fraction is cut toward zero, as a currency formatter followed by ``split('.')[0]`` does.
    """
    whole = F.round(_c(x), 2).cast("decimal(38,2)").cast("bigint").cast("string")
    return F.regexp_replace(whole, r"(\d)(?=(\d\d)+\d$)", "$1,")


def entity_label(value, prefix: str | None, null_label: str) -> Column:
    """``CASE WHEN v IS NULL THEN null_label ELSE concat(prefix, v) END`` (constant if no prefix)."""
    if prefix is None:
        return F.lit(null_label)
    v = _c(value)
    return F.when(v.isNull(), F.lit(null_label)).otherwise(F.concat(F.lit(prefix), v.cast("string")))
