"""Time functions.

All of them are built-in expressions and never read the session zone: an
instant is epoch milliseconds, a wall clock is a ``TIMESTAMP_NTZ`` in a zone
given as an argument. So results are the same on every cluster whatever
``spark.sql.session.timeZone`` says.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

_EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(ts, ts_type: T.DataType | None = None) -> Column:
    """Epoch milliseconds of a timestamp column.

    ``TIMESTAMP_NTZ`` values are read as UTC wall clock (parquet written
    without zone); ``TIMESTAMP`` values are instants.
    """
    ts = _c(ts)
    if isinstance(ts_type, T.TimestampType):
        return F.unix_millis(ts)
    # Built from the wall-clock fields, which never involve a zone (a
    # timestampdiff on TIMESTAMP_NTZ is rewritten through the session zone).
    return (F.unix_date(F.to_date(ts)).cast("bigint") * F.lit(86_400_000)
            + F.hour(ts).cast("bigint") * F.lit(3_600_000)
            + F.minute(ts).cast("bigint") * F.lit(60_000)
            + F.floor(F.extract(F.lit("SECOND"), ts) * F.lit(1000)).cast("bigint"))


def ms_to_local(ms, zone: str = "UTC") -> Column:
    """Wall clock (``TIMESTAMP_NTZ``) in ``zone`` of epoch milliseconds."""
    utc = F.timestamp_add("MILLISECOND", _c(ms), F.expr(_EPOCH_NTZ))
    if zone.upper() in ("UTC", "Z", "+00:00", "GMT"):
        return utc
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def fmt_date(ntz) -> Column:
    """``yyyy-MM-dd`` of a wall clock. ``date_format`` would cast a
    ``TIMESTAMP_NTZ`` through the session zone; a DATE cast does not."""
    return F.to_date(_c(ntz)).cast("string")


def fmt_datetime(ntz_whole_seconds) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a wall clock holding whole seconds (the
    string form of ``TIMESTAMP_NTZ`` prints no zero fraction)."""
    return _c(ntz_whole_seconds).cast("string")


def to_date(ms, zone: str = "UTC") -> Column:
    """F1 ``toDate``: epoch ms -> ``yyyy-MM-dd`` in ``zone``."""
    return fmt_date(ms_to_local(ms, zone))


def to_ymd_hms(ms, zone: str = "UTC") -> Column:
    """F2 ``toYmdHms``: epoch ms -> ``yyyy-MM-dd HH:mm:ss`` in ``zone``."""
    secs = F.floor(_c(ms) / F.lit(1000)).cast("bigint") * F.lit(1000)
    return fmt_datetime(ms_to_local(secs, zone))


def to_ts(text, is_full: bool = False, offset: str = "+08:00") -> Column:
    """F3 ``toTs``: date or datetime text -> epoch ms at a fixed offset.

    The reference pins the offset to +08:00 whatever the machine zone; it is
    an argument here with that default.
    """
    t = _c(text)
    if not is_full:
        t = F.concat(t, F.lit(" 00:00:00"))
    local = F.to_timestamp_ntz(t, F.lit("yyyy-MM-dd HH:mm:ss"))
    wall_ms = epoch_ms(local)
    sign = -1 if offset.startswith("-") else 1
    hh, mm = offset.lstrip("+-").split(":")
    off_ms = sign * (int(hh) * 3600 + int(mm) * 60) * 1000
    return wall_ms - F.lit(off_ms)


def rowtime(ts_ms, zone: str = "UTC") -> Column:
    """``TO_TIMESTAMP(FROM_UNIXTIME(ts/1000))`` — whole seconds of the
    event, as wall clock in ``zone`` (integer division drops the ms)."""
    secs = F.floor(_c(ts_ms) / F.lit(1000)).cast("bigint")
    return ms_to_local(secs * F.lit(1000), zone)


def rowtime_instant(ts_ms, zone: str = "UTC") -> Column:
    """P7 for streams: watermarks need a ``TIMESTAMP`` (instant) column, so
    the wall clock of :func:`rowtime` is carried as the instant whose UTC
    reading equals it. Windows over it align to ``zone`` wall clock, and
    :func:`wall_clock` turns it back without the session zone."""
    if zone.upper() in ("UTC", "Z", "+00:00", "GMT"):
        return F.timestamp_seconds(F.floor(_c(ts_ms) / F.lit(1000)).cast("bigint"))
    return F.timestamp_millis(epoch_ms(rowtime(ts_ms, zone)))


def wall_clock(c, c_type: T.DataType | None = None) -> Column:
    """A ``TIMESTAMP_NTZ`` as is; an instant from :func:`rowtime_instant`
    as its UTC wall clock (no session zone involved)."""
    if isinstance(c_type, T.TimestampType):
        return ms_to_local(F.unix_millis(_c(c)), "UTC")
    return _c(c)


def arrival(ts: str = "ts", seq: str = "seq") -> F.Column:
    """The order (ts, seq) as one decimal, a fixed-width aggregation buffer;
    a missing ``seq`` counts as 0."""
    return (F.col(ts).cast("decimal(19,0)") * F.lit(Decimal(1 << 63))
            + F.coalesce(F.col(seq), F.lit(0)).cast("decimal(19,0)"))
