"""Wall-clock time functions.

Log times are zone-less (``TIMESTAMP_NTZ``); a zone is always an argument, so no
result depends on ``spark.sql.session.timeZone``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values -----------------------------------------------------------
MAX_TIMEDIFF = 838 * 3600 + 59 * 60 + 59   # a TIME value saturates at 838:59:59
DAY_SECONDS = 60 * 60 * 24
# ---- end of fixed values ----------------------------------------------------


def _ntz(col: Column) -> Column:
    return col.cast("timestamp_ntz")


def wall_seconds(clock: Column) -> Column:
    """Seconds from 1970-01-01 00:00:00 on the same clock; codegen-friendly."""
    t = _ntz(clock)
    return (
        F.unix_date(t.cast("date")).cast("bigint") * DAY_SECONDS
        + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
    )


def to_epoch(clock: Column, zone: str = "UTC") -> Column:
    """Epoch seconds of a wall clock (or its text).

    An hour that occurs twice means the daylight one. A clock the spring change
    skips is read with the offset before the change, so it means one hour later.
    """
    if zone == "UTC":
        return wall_seconds(clock)
    return wall_seconds(F.convert_timezone(F.lit(zone), F.lit("UTC"), _ntz(clock)))


def epoch_clock(seconds: Column, zone: str = "UTC") -> Column:
    """Wall clock in ``zone`` of an epoch second."""
    s = seconds.cast("bigint")
    day = F.floor(s / DAY_SECONDS).cast("int")
    rest = F.pmod(s, F.lit(DAY_SECONDS)).cast("decimal(18,6)")
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(days=day, secs=rest)
    return utc if zone == "UTC" else F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def from_epoch(seconds: Column, zone: str = "UTC") -> Column:
    """``YYYY-MM-DD HH:MM:SS`` text of an epoch second."""
    return epoch_clock(seconds, zone).cast("string")


def clock_time(clock: Column) -> Column:
    """``HH:MM:SS`` part of a wall clock."""
    return F.substring(_ntz(clock).cast("string"), 12, 8)


def date_offset(as_of: Column, days: int) -> Column:
    """Day ``days`` away from ``as_of`` as ``YYYY-MM-DD`` text."""
    return F.date_add(as_of.cast("date"), days).cast("string")


def utc_to_local(utc: Column, zone: str) -> Column:
    """Struct (local clock, offset in seconds, daylight flag) of a UTC clock.

    Standard time is the smaller of the January and July offsets of that year.
    """
    t = _ntz(utc)

    def offset(c: Column) -> Column:
        return wall_seconds(F.convert_timezone(F.lit("UTC"), F.lit(zone), c)) - wall_seconds(c)

    winter = F.make_date(F.year(t), F.lit(1), F.lit(1)).cast("timestamp_ntz")
    summer = F.make_date(F.year(t), F.lit(7), F.lit(1)).cast("timestamp_ntz")
    off = offset(t)
    return F.struct(
        F.convert_timezone(F.lit("UTC"), F.lit(zone), t).alias("local_time"),
        off.cast("int").alias("utc_offset"),
        (off != F.least(offset(winter), offset(summer))).alias("is_dst"),
    )


def interval_valid(begin: Column, end: Column, zone: str = "UTC") -> Column:
    """Whether a local interval is non-empty; both ends follow the same daylight rule."""
    return to_epoch(begin, zone) < to_epoch(end, zone)


def timediff(a: Column, b: Column) -> Column:
    """Signed ``a - b`` in seconds, saturating like a TIME value; NULL if either is NULL."""
    diff = wall_seconds(a) - wall_seconds(b)
    # least/greatest skip NULLs, so the NULL rule has to be stated.
    return F.when(diff.isNotNull(), F.greatest(F.least(diff, F.lit(MAX_TIMEDIFF)), F.lit(-MAX_TIMEDIFF)))


def format_timediff(seconds: Column) -> Column:
    """``[-]HH:MM:SS`` text of a signed second count (hours may have three digits)."""
    a = F.abs(seconds)
    pad = lambda c: F.lpad(c.cast("string"), 2, "0")
    hours = F.floor(a / 3600)
    text = F.concat(
        F.when(hours < 100, pad(hours)).otherwise(hours.cast("string")),
        F.lit(":"), pad(F.floor(F.pmod(a, F.lit(3600)) / 60)), F.lit(":"), pad(F.pmod(a, F.lit(60))),
    )
    return F.when(seconds < 0, F.concat(F.lit("-"), text)).otherwise(text)


def hms_seconds(text: str) -> int:
    """Seconds of an ``[-]H:M:S`` literal, for comparisons with :func:`timediff`."""
    sign = -1 if text.startswith("-") else 1
    h, m, s = (int(p) for p in text.lstrip("-").split(":"))
    return sign * (h * 3600 + m * 60 + s)
