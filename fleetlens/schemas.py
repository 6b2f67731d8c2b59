"""Row types of the topics and of polygon input."""

from __future__ import annotations

from pyspark.sql.types import (DataType, DoubleType, IntegerType, LongType, StringType,
                               StructField, StructType, TimestampNTZType, TimestampType)

_STRING, _LONG, _INT, _DOUBLE = StringType(), LongType(), IntegerType(), DoubleType()
_INSTANT, _ZONELESS = TimestampType(), TimestampNTZType()


def _row(**fields: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in fields.items()])


# ``payload`` is an object on the wire and is kept as its JSON text.
DEVICES = _row(deviceId=_STRING, payload=_STRING)

EVENTS = _row(deviceId=_STRING, messageName=_STRING, payload=_STRING, timestamp=_INSTANT)

# Written with eventTimestamp as text, read back as an instant.
ENRICHED_OUT = _row(deviceId=_STRING, deviceCity=_STRING, deviceRegion=_STRING,
                    deviceLocation=_STRING, messageName=_STRING,
                    eventNotificationName=_STRING, timestamp=_INSTANT, eventTimestamp=_STRING)
ENRICHED_IN = _row(deviceId=_STRING, deviceCity=_STRING, deviceRegion=_STRING,
                   deviceLocation=_STRING, messageName=_STRING,
                   eventNotificationName=_STRING, timestamp=_INSTANT, eventTimestamp=_INSTANT)

ALERTS = _row(window_start=_ZONELESS, window_end=_ZONELESS, total_count_per_deviceid=_LONG,
              deviceId=_STRING, deviceLocation=_STRING, avg_error_count=_LONG,
              std_error_count=_LONG)

# Vertices of land-use and city outlines, in ring order.
POLYGONS = _row(polygon_id=_LONG, landuse=_STRING, vertex_no=_INT, lat=_DOUBLE, lon=_DOUBLE)
