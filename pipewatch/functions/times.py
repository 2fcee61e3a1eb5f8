"""Time column functions.  No function reads the clock: ``now`` and
``as_of`` are always arguments."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

# Fixed value: the text prefix that counts as an ISO date-time.
ISO_PREFIX = r"^\d\d\d\d-\d\d-\d\dT\d\d:\d\d:\d\d.?(?:\d\d\d)?Z?"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ts_literal(value, dtype: DataType | str = "timestamp_ntz") -> Column:
    """A timestamp literal of the column's own type in which no Python or
    session time zone is involved.  A value without a zone is UTC; as an
    instant (TIMESTAMP) it is built from epoch microseconds (text: read in
    zone UTC), as ``timestamp_ntz`` from its own text."""
    if isinstance(value, Column):
        return value
    instant = (dtype if isinstance(dtype, str) else dtype.typeName()) == "timestamp"
    if isinstance(value, dt.date) and not isinstance(value, dt.datetime):
        value = dt.datetime(value.year, value.month, value.day)
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
        if instant:
            return F.timestamp_micros(F.lit((value - dt.datetime(1970, 1, 1)) // dt.timedelta(microseconds=1)).cast("bigint"))
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(f"{value} UTC" if instant else str(value)).cast(dtype)


def epoch_seconds(text: Column | str, fmt: str = "yyyy-MM-dd HH:mm:ss", tz: str = "UTC") -> Column:
    """Whole epoch seconds of a local date-time text read in zone ``tz``;
    unusable text gives null."""
    zoned = F.concat(_c(text), F.lit(" " + tz))
    return F.unix_seconds(F.try_to_timestamp(zoned, F.lit(fmt + " VV")))


def ntz_epoch_seconds(ts: Column | str) -> Column:
    """Whole epoch seconds of a timestamp_ntz taken as UTC wall time."""
    return F.timestamp_diff("SECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), _c(ts))


_EPOCH_NTZ = "1970-01-01 00:00:00"
# The zone-free text of a timestamp_ntz ("yyyy-MM-dd HH:mm:ss[.ffffff]").
_WALL = r"^(\d{4})-(\d{2})-(\d{2}) (\d{2}):(\d{2}):(\d{2})"
_TOKENS = (("yyyy", "$1"), ("MM", "$2"), ("dd", "$3"), ("HH", "$4"), ("mm", "$5"), ("ss", "$6"))


def utc_wall(ts: Column | str, dtype: DataType | None = None) -> Column:
    """A timestamp as ``timestamp_ntz`` wall time: NTZ values unchanged, an
    instant (TIMESTAMP) as its UTC wall clock - never the session zone."""
    c = _c(ts)
    if dtype is not None and dtype.typeName() == "timestamp":
        return F.timestamp_add("MICROSECOND", F.unix_micros(c), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))
    return c


def instant(wall: Column | str) -> Column:
    """A ``timestamp_ntz`` read as UTC wall time, as an instant (TIMESTAMP) -
    never in the session zone."""
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", F.lit(_EPOCH_NTZ).cast("timestamp_ntz"), _c(wall)))


def _replacement(pattern: str) -> str:
    out, i = [], 0
    while i < len(pattern):
        if pattern[i] == "'":
            j = pattern.index("'", i + 1)
            out.append(pattern[i + 1 : j])
            i = j + 1
            continue
        for tok, ref in _TOKENS:
            if pattern.startswith(tok, i):
                out.append(ref)
                i += len(tok)
                break
        else:
            out.append("\\" + pattern[i] if pattern[i] in "$\\" else pattern[i])
            i += 1
    return "".join(out)


def format_ntz(ts: Column | str, pattern: str) -> Column:
    """Render a ``timestamp_ntz`` with a ``yyyy MM dd HH mm ss`` pattern
    (quoted literals allowed) without any time zone.  (``date_format``
    first turns the value into a session-zone instant, which shifts wall
    times that fall in a daylight-saving gap of that zone.)"""
    wall = F.regexp_extract(_c(ts).cast("string"), _WALL, 0)
    return F.when(_c(ts).isNotNull(), F.regexp_replace(wall, _WALL + "$", _replacement(pattern)))


def parse_ntz(text: Column | str, pattern: str) -> Column:
    """Parse text to ``timestamp_ntz`` without any time zone (null when the
    text does not fit the pattern or is not a valid date-time)."""
    instant = F.try_to_timestamp(F.concat(_c(text), F.lit(" UTC")), F.lit(pattern + " VV"))
    return F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.lit(_EPOCH_NTZ).cast("timestamp_ntz"))


def to_local(text: Column | str, hours: int = 8) -> Column:
    """Text starting with an ISO date-time becomes that time + ``hours``,
    as ``yyyy-MM-ddTHH:mm:ss`` (fraction and zone dropped); other text, and
    text whose date is not valid, is returned unchanged."""
    c = _c(text)
    parsed = parse_ntz(F.substring(c, 1, 19), "yyyy-MM-dd'T'HH:mm:ss")
    shifted = format_ntz(F.timestamp_add("HOUR", F.lit(hours), parsed), "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(c.rlike(ISO_PREFIX), F.coalesce(shifted, c)).otherwise(c)
