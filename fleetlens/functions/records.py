"""Builders for device and event messages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .time import iso_millis


def _col(value) -> Column:
    return F.col(value) if isinstance(value, str) else value


def random_device_id() -> Column:
    """A random UUID. A task that is run again draws new ones; write the result
    before it is used twice, or take ``stable_device_id``."""
    return F.uuid()


def stable_device_id(*columns) -> Column:
    """UUID-shaped text computed from the given columns."""
    digest = F.sha2(F.concat_ws("|", *[_col(c).cast("string") for c in columns]), 256)
    return F.concat_ws("-", *[F.substring(digest, start, length) for start, length in
                              ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


def device_record(device_id, location, city, region, country_code, timezone) -> Column:
    """Nested device message; arguments are Columns or column names."""
    place = F.struct(
        _col(country_code).alias("countryCode"),
        _col(region).alias("region"),
        _col(city).alias("city"),
        _col(location).alias("loc"),
        _col(timezone).alias("timezone"),
    )
    return F.struct(_col(device_id).alias("deviceId"),
                    F.struct(place.alias("location")).alias("payload"))


def event_record(device_id, notification, instant, message_name=None) -> Column:
    """Nested event message with the event time as millisecond ISO text."""
    stamp = iso_millis(_col(instant))
    name = F.lit("operatingNotification") if message_name is None else _col(message_name)
    return F.struct(
        _col(device_id).alias("deviceId"),
        name.alias("messageName"),
        F.struct(_col(notification).alias("notificationName"),
                 stamp.alias("eventTimestamp")).alias("payload"),
        stamp.alias("timestamp"),
    )


def sorted_values(values) -> Column:
    """A multi-value string in sorted order; duplicates stay."""
    return F.array_sort(_col(values))
