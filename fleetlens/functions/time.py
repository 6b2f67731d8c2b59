"""Time text, instants and durations, whatever the session's zone is."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, functions as F
from pyspark.sql.types import DataType, TimestampNTZType

_UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def duration_micros(text: str) -> int:
    """Length of a duration such as ``'30 seconds'`` or ``'1 day 2 hours'``."""
    words = text.split()
    if not words or len(words) % 2:
        raise ValueError(f"not a duration: {text!r}")
    total = 0
    for amount, unit in zip(words[::2], words[1::2]):
        unit = unit.lower().removesuffix("s")
        if unit not in _UNIT_MICROS:
            raise ValueError(f"unit of no fixed length in duration: {text!r}")
        total += int(amount) * _UNIT_MICROS[unit]
    return total


def _utc_clock(instant: Column | str) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.ffffff]`` of an instant in UTC; a time without a zone is
    taken as it stands. Neither goes through the session's zone, whose clock has gaps."""
    column = F.col(instant) if isinstance(instant, str) else instant
    since = F.make_dt_interval(secs=F.unix_micros(column.cast("timestamp")).cast("decimal(24,6)") / 1_000_000)
    utc = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since
    zoneless = F.typeof(column) == "timestamp_ntz"
    # Known when the query is planned; in UTC an instant is spelled as it is.
    plain = F.when(zoneless | _in_utc(), column.cast("string"))
    return F.coalesce(plain, utc.cast("string"))


def _in_utc() -> Column:
    return F.current_timezone() == "UTC"


def iso_millis(instant: Column | str) -> Column:
    """ISO-8601 text, cut (not rounded) to milliseconds, with ``Z``."""
    clock = _utc_clock(instant)
    seconds = F.replace(F.substring_index(clock, ".", 1), F.lit(" "), F.lit("T"))
    millis = F.concat(seconds, F.lit("."), F.rpad(F.regexp_extract(clock, r"\.(\d{1,3})", 1), 3, "0"),
                      F.lit("Z"))
    column = F.col(instant) if isinstance(instant, str) else instant
    return F.when(_in_utc(), F.date_format(column, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).otherwise(millis)


def iso_text(instant: Column | str, suffix: str = "Z") -> Column:
    """ISO-8601 text with as many fraction digits as the value needs, so that
    microseconds survive a trip through JSON."""
    return F.concat(F.replace(_utc_clock(instant), F.lit(" "), F.lit("T")), F.lit(suffix))


_DAY_TEXT = r"\d{4}-\d{2}-\d{2}"
_CLOCK_TEXT = r"[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?"
_ZONE_TEXT = r" ?(?:Z|[+-]\d{2}:?\d{2})"
#: What a cast reads as it stands, and nearly all times are spelled like.
_WHOLE_TEXT = rf"^{_DAY_TEXT}[T ]\d{{2}}:\d{{2}}:\d{{2}}(?:\.\d{{1,9}})?(?:Z|[+-]\d{{2}}:\d{{2}})$"


def parse_time(text: Column | str, form: str = "iso") -> Column:
    """Instant from ISO-8601 text: a date, with a time or not, with a zone or not (then
    UTC). Anything else is NULL: casts would also take a bare number as a year or as
    seconds, and a bare clock time as today's. ``form='auto'`` also takes epoch
    milliseconds."""
    column = F.col(text) if isinstance(text, str) else text
    spelled = F.regexp_replace(F.regexp_replace(column, " ?Z$", "+00:00"),
                               r" ?([+-]\d{2}):?(\d{2})$", "$1:$2")
    whole = (F.when(column.rlike(f"^{_DAY_TEXT}{_CLOCK_TEXT}{_ZONE_TEXT}$"), spelled)
             .when(column.rlike(f"^{_DAY_TEXT}{_CLOCK_TEXT}$"), F.concat(column, F.lit("+00:00")))
             .when(column.rlike(f"^{_DAY_TEXT}$"), F.concat(column, F.lit("T00:00:00+00:00"))))
    seconds = F.regexp_replace(whole, r"^(.{10}.\d{2}:\d{2})([+-])", "$1:00$2")
    parsed = F.when(column.rlike(_WHOLE_TEXT), column).otherwise(seconds).try_cast("timestamp")
    if form == "iso":
        return parsed
    if form == "auto":
        digits = column.rlike(r"^-?\d+$")
        return F.coalesce(parsed, F.when(digits, F.timestamp_millis(column.try_cast("bigint"))))
    raise ValueError(f"unknown time form: {form!r}")


def parse_clock(text: Column | str) -> Column:
    """Time without a zone from ISO-8601 text without one (or with ``Z``), else NULL."""
    column = F.col(text) if isinstance(text, str) else text
    plain = F.regexp_replace(column, " ?Z$", "")
    return F.when(plain.rlike(f"^{_DAY_TEXT}(?:{_CLOCK_TEXT})?$"), plain).try_cast("timestamp_ntz")


def utc_date(instant: Column | str) -> Column:
    """UTC calendar day of an instant, whatever the session zone is."""
    column = F.col(instant) if isinstance(instant, str) else instant
    days = F.floor(F.unix_micros(column) / F.lit(_UNIT_MICROS["day"]))
    return F.date_from_unix_date(days.cast("int"))


def as_utc(moment: datetime) -> datetime:
    """``moment`` with the zone UTC; one without a zone is taken as UTC."""
    if moment.tzinfo is None:
        return moment.replace(tzinfo=timezone.utc)
    return moment.astimezone(timezone.utc)


def time_literal(moment: datetime, kind: DataType) -> Column:
    """A literal to compare a time column of type ``kind`` with, whatever the zones
    of the session and of the driver are."""
    moment = as_utc(moment)
    if isinstance(kind, TimestampNTZType):
        return F.lit(moment.replace(tzinfo=None).isoformat(" ")).cast(kind)
    return F.lit(moment)
