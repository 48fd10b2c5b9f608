"""Time helpers: epoch milliseconds, wall-clock text and event-time columns.

Every conversion takes an explicit zone instead of the session zone, so a
result never depends on where the job runs.  Wall-clock values are kept as
``TIMESTAMP_NTZ`` (what parquet in the test tables holds), which makes
``window()`` and ``date_format`` independent of ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layout of all business times, and the zone the commerce
# database writes its text times in.
TEXT_FORMAT = "yyyy-MM-dd HH:mm:ss"
DAY_FORMAT = "yyyy-MM-dd"
COMMERCE_TZ = "+08:00"

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _fixed_offset_ms(tz: str):
    """Milliseconds of a fixed ``+hh:mm`` offset; None for region zones."""
    if tz in ("UTC", "Z"):
        return 0
    m = re.fullmatch(r"([+-])(\d{2}):(\d{2})", tz)
    if not m:
        return None
    ms = (int(m.group(2)) * 60 + int(m.group(3))) * 60_000
    return ms if m.group(1) == "+" else -ms


def _to_zone(ntz_utc: Column, tz: str) -> Column:
    off = _fixed_offset_ms(tz)
    if off is None:  # region zone: daylight saving needs the zone rules
        return F.convert_timezone(F.lit("UTC"), F.lit(tz), ntz_utc)
    return ntz_utc if off == 0 else F.timestamp_add("MILLISECOND", F.lit(off), ntz_utc)


def _from_zone(ntz_local: Column, tz: str) -> Column:
    off = _fixed_offset_ms(tz)
    if off is None:
        return F.convert_timezone(F.lit(tz), F.lit("UTC"), ntz_local)
    return ntz_local if off == 0 else F.timestamp_add("MILLISECOND", F.lit(-off), ntz_local)


def ms_to_wallclock(ms, tz: str = "UTC") -> Column:
    """Epoch milliseconds -> wall-clock ``TIMESTAMP_NTZ`` in ``tz``."""
    return _to_zone(F.timestamp_add("MILLISECOND", _c(ms), F.expr(_EPOCH)), tz)


def wallclock_to_ms(ntz, tz: str = "UTC") -> Column:
    """Wall-clock ``TIMESTAMP_NTZ`` in ``tz`` -> epoch milliseconds."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), _from_zone(_c(ntz), tz))


def ms_to_text(ms, tz: str = "UTC", fmt: str = TEXT_FORMAT) -> Column:
    """Epoch ms -> ``yyyy-MM-dd HH:mm:ss`` text (F16, first half)."""
    return F.date_format(ms_to_wallclock(ms, tz), fmt)


def ms_to_day(ms, tz: str = "UTC") -> Column:
    """Epoch ms -> ``yyyy-MM-dd``."""
    return F.date_format(ms_to_wallclock(ms, tz), DAY_FORMAT)


def text_to_wallclock(text) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text -> NTZ; NULL when it does not parse.

    A cast, not a pattern parse: the ISO layout is what the cast reads, and it
    is several times cheaper per row.  ``try_cast`` gives NULL instead of an
    error under ANSI mode.
    """
    return _c(text).try_cast("timestamp_ntz")


def text_to_ms(text, tz: str = COMMERCE_TZ) -> Column:
    """Text time written in ``tz`` -> epoch ms; NULL when it does not parse (F16)."""
    return wallclock_to_ms(text_to_wallclock(text), tz)


def text_to_ms_or(text, fallback, tz: str = COMMERCE_TZ) -> Column:
    """Parse with fallback to the record time when the text is bad."""
    return F.coalesce(text_to_ms(text, tz), _c(fallback))


def day_int(ntz) -> Column:
    """``toYYYYMMDD``."""
    return F.date_format(_c(ntz), "yyyyMMdd").cast("int")


def split_text_time(text):
    """``create_date``, ``create_hour`` from ``yyyy-MM-dd HH:mm:ss`` (P5, F2)."""
    parts = F.split(_c(text), " ")
    return parts.getItem(0), F.split(parts.getItem(1), ":").getItem(0)


def tumble(event_time: Column, size: str) -> Column:
    """Tumbling event-time window (W5/W6); ``event_time`` is NTZ or TIMESTAMP."""
    return F.window(event_time, size)


def window_text(win: Column, fmt: str = TEXT_FORMAT):
    """``stt``/``edt`` text of a window struct."""
    return F.date_format(win.getField("start"), fmt), F.date_format(win.getField("end"), fmt)


def processing_time_ms(now_ms: int | None = None) -> Column:
    """F14 ``UNIX_TIMESTAMP()*1000``: wall-clock ms of the query, or a fixed
    value when injected (tests and oracle checks must not depend on it)."""
    return F.lit(now_ms).cast("bigint") if now_ms is not None else F.unix_millis(F.current_timestamp())
