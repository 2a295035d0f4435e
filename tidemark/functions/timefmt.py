"""Time expressions that do not depend on the session time zone.

Wall-clock values are kept as TIMESTAMP_NTZ (the driver tables load that way)
and epoch values as milliseconds since 1970-01-01 in UTC. Conversions go
through ``timestampdiff`` / ``timestampadd`` against the NTZ epoch, so a
session in any zone gives the same text as the oracle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def ntz_to_epoch_ms(ts) -> Column:
    """Wall-clock NTZ (read as UTC) -> epoch milliseconds, truncated."""
    return F.timestamp_diff("MILLISECOND", F.expr(_EPOCH), _c(ts))


def epoch_ms_to_ntz(ms, zone: str = "UTC") -> Column:
    """Epoch milliseconds -> wall-clock NTZ in ``zone``."""
    utc = F.timestamp_add("MILLISECOND", _c(ms), F.expr(_EPOCH))
    if zone.upper() == "UTC":
        return utc
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def ntz_to_instant(ts) -> Column:
    """NTZ wall clock (UTC) -> TIMESTAMP instant, for watermarks and windows."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.expr(_EPOCH), _c(ts)))


def instant_to_ntz(ts) -> Column:
    """TIMESTAMP instant -> NTZ wall clock in UTC (zone-independent)."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(_c(ts)), F.expr(_EPOCH))


def log_date(ms, zone: str = "UTC") -> Column:
    """Epoch ms -> 'yyyy-MM-dd'."""
    return F.date_format(epoch_ms_to_ntz(ms, zone), "yyyy-MM-dd")


def log_hour(ms, zone: str = "UTC") -> Column:
    """Epoch ms -> 'HH'."""
    return F.date_format(epoch_ms_to_ntz(ms, zone), "HH")


def datetime_date(text) -> Column:
    """'yyyy-MM-dd HH:mm:ss' -> 'yyyy-MM-dd' by splitting on the space.

    ``get`` returns null where the reference would throw on a malformed value.
    """
    return F.get(F.split(_c(text), " "), 0)


def datetime_hour(text) -> Column:
    """'yyyy-MM-dd HH:mm:ss' -> 'HH' (text before the first ':' of the time part)."""
    return F.get(F.split(F.get(F.split(_c(text), " "), 1), ":"), 0)


def previous_day(date_text) -> Column:
    """'yyyy-MM-dd' -> the day before, same format."""
    return F.date_format(F.date_sub(F.to_date(_c(date_text)), 1), "yyyy-MM-dd")


def previous_day_str(date_text: str) -> str:
    import datetime as _dt
    d = _dt.date.fromisoformat(date_text) - _dt.timedelta(days=1)
    return d.isoformat()
