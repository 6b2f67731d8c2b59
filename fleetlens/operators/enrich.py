"""Put events on the map: events joined with device records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.json import json_value
from .spread import BROADCAST_BYTES, DEFAULT_SALTS, broadcast_if_fits, spread_join

OUTPUT = ["deviceId", "deviceCity", "deviceRegion", "deviceLocation", "messageName",
          "eventNotificationName", "timestamp", "eventTimestamp"]
NOTICE = ["deviceId", "messageName", "eventNotificationName", "timestamp", "eventTimestamp"]
_EVENT_HASH = ["timestamp", "eventTimestamp", "messageName", "eventNotificationName"]


def device_places(devices: DataFrame, *extra: Column) -> DataFrame:
    """The joined fields of a device; read from its JSON once per device."""
    return devices.select(
        "deviceId",
        json_value("payload", "$.location.city").alias("deviceCity"),
        json_value("payload", "$.location.region").alias("deviceRegion"),
        json_value("payload", "$.location.loc").alias("deviceLocation"),
        *extra,
    )


def event_notices(events: DataFrame) -> DataFrame:
    """The joined fields of an event; the JSON text is dropped before the join."""
    return events.select(
        "deviceId", "messageName",
        json_value("payload", "$.notificationName").alias("eventNotificationName"),
        "timestamp",
        json_value("payload", "$.eventTimestamp").alias("eventTimestamp"),
    )


def enrich(events: DataFrame, devices: DataFrame, *, broadcast: str | None = None,
           broadcast_limit: int = BROADCAST_BYTES, salts: int | None = None) -> DataFrame:
    """Events with city, region and location of their device.

    Inner join with bag semantics: an event comes out once per row of its device,
    and not at all when the device is unknown.

    How the join runs:

    - batch: Spark's size threshold decides on a broadcast (``broadcast="auto"``);
      beyond it the join shuffles and adaptive execution splits skewed devices;
    - stream with a device table: the table is measured once
      (``broadcast="measured"``) and broadcast within ``broadcast_limit`` bytes;
      beyond that every device's events are spread over ``salts`` tasks, because
      adaptive execution does not help a stream;
    - two streams: spread over ``salts`` tasks. All rows are kept as state, since an
      event may wait for its device forever; prefer a device table or
      ``enrich_bounded``.
    """
    notices, places = event_notices(events), device_places(devices)
    both = events.isStreaming and devices.isStreaming
    if broadcast is None:
        broadcast = "measured" if events.isStreaming and not both else "auto"
    if broadcast not in ("auto", "measured"):
        raise ValueError(f"unknown broadcast: {broadcast!r}")
    if broadcast == "measured" and not devices.isStreaming:
        places, fits = broadcast_if_fits(places, broadcast_limit)
        salts = 1 if fits else (salts or DEFAULT_SALTS)
    if salts is None:
        salts = DEFAULT_SALTS if both else 1
    return spread_join(notices, places, ["deviceId"], _EVENT_HASH, salts).select(*OUTPUT)


def enrich_bounded(events: DataFrame, devices: DataFrame, *, device_time: str,
                   wait: str, delay: str = "5 seconds",
                   salts: int = DEFAULT_SALTS) -> DataFrame:
    """Stream-stream join whose state is bounded.

    An event meets the rows of its device whose ``device_time`` lies within
    ``wait`` of its ``timestamp``, before or after; rows that can meet no more
    leave the state. Devices have to be announced again at least that often.
    """
    notices = event_notices(events).withWatermark("timestamp", delay)
    places = (device_places(devices, F.col(device_time).alias("_seen"))
              .withWatermark("_seen", delay))
    reach = f"INTERVAL '{wait}'"
    near = F.expr(f"_seen >= timestamp - {reach} AND _seen <= timestamp + {reach}")
    joined = spread_join(notices, places, ["deviceId"], _EVENT_HASH, salts, where=near)
    return joined.select(*OUTPUT)


def join_all(events: DataFrame, devices: DataFrame) -> DataFrame:
    """Every column of both sides, each under a name of its own."""
    return (devices.withColumnRenamed("payload", "device_payload")
            .join(events.withColumnRenamed("payload", "event_payload"), "deviceId"))
