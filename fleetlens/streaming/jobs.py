"""The two stream jobs, and several sinks for one stream."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas
from ..operators.alerts import alerts_from_counts, closed_counts, deviation_alerts
from ..functions.json import json_value
from ..functions.time import parse_time
from ..operators.enrich import OUTPUT, device_places, enrich, event_notices
from ..sources.messages import decode, encode
from ..sources.topics import FileTopic, KafkaTopic
from .late import Lateness
from .waiting import WaitingEvents

Topic = FileTopic | KafkaTopic


def devices_from(messages: DataFrame, on_error: str = "fail") -> DataFrame:
    return decode(messages, schemas.DEVICES, on_error)


def events_from(messages: DataFrame, on_error: str = "fail") -> DataFrame:
    return decode(messages, schemas.EVENTS, on_error)


def enriched_from(messages: DataFrame, on_error: str = "drop") -> DataFrame:
    return decode(messages, schemas.ENRICHED_IN, on_error)


def alerts_from(messages: DataFrame, on_error: str = "drop") -> DataFrame:
    return decode(messages, schemas.ALERTS, on_error)


def enrichment_job(spark: SparkSession, devices: Topic | DataFrame | Callable[[], DataFrame],
                   events: Topic, sink: Topic, checkpoint: str, *, on_error: str = "fail",
                   trigger: dict | None = None, waiting: WaitingEvents | None = None,
                   unplaced: Topic | None = None) -> StreamingQuery:
    """Device places put on events, topic to topic.

    ``devices`` (columns ``deviceId, payload``) is one of

    - a DataFrame: events meet the device files that were there when it was made;
    - a function that reads the device table: called for every micro-batch, so new
      devices are seen. An event ahead of its device is lost, unless there is a place
      for it to wait: ``waiting`` keeps it and joins it again with every later batch.
      Those that give up go to ``unplaced``, if given, without a place;
    - a topic: both sides are streams. Events wait for their device, and all rows
      stay in state.

    With a function, file topics are written exactly-once and Kafka at-least-once.
    """
    if waiting is not None and not callable(devices):
        raise ValueError("events wait for devices that are read anew for every batch")
    trigger = trigger or {"processingTime": "360 seconds"}
    arriving = events.stream(spark)
    if callable(devices):
        def write(batch: DataFrame, batch_id: int) -> None:
            name = _batch_name(checkpoint, batch_id)
            if waiting is None:
                sink.publish(encode(enrich(events_from(batch, on_error), devices())), name)
                return
            rows = waiting.place(event_notices(events_from(batch, on_error)), device_places(devices()), batch_id)
            sink.publish(encode(rows.where("placed = 'yes'").select(*OUTPUT)), name)
            if unplaced is not None:
                unplaced.publish(encode(rows.where("placed = 'never'").select(*OUTPUT)), name)
            waiting.forget(batch.sparkSession, batch_id)

        return _start(arriving.writeStream.foreachBatch(write), checkpoint, trigger)
    if not isinstance(devices, DataFrame):
        devices = devices_from(devices.stream(spark), on_error)
    joined = enrich(events_from(arriving, on_error), devices)
    return _start(sink.publish_stream(encode(joined)), checkpoint, trigger)


def _batch_name(checkpoint: str, batch_id: int) -> str:
    """The same whenever the batch is run again, and no other job's."""
    return f"{hashlib.md5(checkpoint.rstrip('/').encode()).hexdigest()[:12]}-{batch_id}"


def late_job(spark: SparkSession, source: Topic, on_time: Topic, late: Topic, checkpoint: str,
             lateness: Lateness, *, time_path: str = "$.eventTimestamp",
             trigger: dict | None = None) -> StreamingQuery:
    """Send every message on, or to ``late`` if all windows of its time are closed.

    A window count drops such rows without a word; behind this job it meets none that is
    late by the job's own watermark, and those that are can be looked at or counted again.
    Messages without a readable time are sent on. One evaluation of each batch decides.
    """
    time = parse_time(json_value("value", time_path))

    def write(batch: DataFrame, batch_id: int) -> None:
        session, name = batch.sparkSession, _batch_name(checkpoint, batch_id)
        is_late = lateness.late(session, time, batch_id)
        rows, seen = lateness.observe(batch, time)
        on_time.publish(rows.where(~is_late), name)
        late.publish(batch.where(is_late), name)
        lateness.note(session, batch_id, seen)

    return _start(source.stream(spark).writeStream.foreachBatch(write), checkpoint,
                  trigger or {"processingTime": "10 seconds"})


def alert_job(spark: SparkSession, enriched: Topic, sink: Topic, checkpoint: str, *,
              status: str = "accessRejected", trigger: dict | None = None,
              one_state: bool = False, k: float = 3, floor: float = 5,
              integer_stats: bool = True, **settings) -> StreamingQuery:
    """Deviation alerts, topic to topic; ``settings`` go to ``deviation_alerts``.

    As one chain of stream operators the topic is read twice, for counts and for
    statistics, and the join keeps state of its own. With ``one_state`` the stream
    only counts, and every micro-batch is judged as the whole windows it closes:
    one read and a third of the state. File topics are written exactly-once, Kafka
    at-least-once.
    """
    trigger = trigger or {"processingTime": "10 seconds"}
    events = enriched_from(enriched.stream(spark))
    picked = F.col("eventNotificationName") == status
    if not one_state:
        alerts = deviation_alerts(events, where=picked, k=k, floor=floor,
                                  integer_stats=integer_stats, **settings)
        return _start(sink.publish_stream(encode(_shown(alerts))), checkpoint, trigger)

    judging = {name: settings.pop(name) for name in ("salts",) if name in settings}
    keys = [settings.get("key", "deviceId"), *settings.get("also", ("deviceLocation",))]
    size = settings.get("size", "1 minute")

    def judge(batch: DataFrame, batch_id: int) -> None:
        alerts = alerts_from_counts(batch, keys, size, k, floor, integer_stats, **judging)
        sink.publish(encode(_shown(alerts)), _batch_name(checkpoint, batch_id))

    return fan_out(closed_counts(events, where=picked, **settings), [judge], checkpoint, trigger)


def _shown(alerts: DataFrame) -> DataFrame:
    """An alert's columns in the order of its messages; keys that are not grouped by are
    left out, and others follow."""
    named = [c for c in schemas.ALERTS.names if c in alerts.columns]
    return alerts.select(*named, *[c for c in alerts.columns if c not in named])


def _start(writer, checkpoint: str, trigger: dict) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()


def fan_out(stream: DataFrame, sinks: list[Callable[[DataFrame, int], None]],
            checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """One stream into several sinks, read once.

    Each sink gets every micro-batch and its number. A failed batch is repeated
    for all sinks with the same number, so a sink should replace what it wrote
    under that number before.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            for sink in sinks:
                sink(batch, batch_id)
        finally:
            batch.unpersist()

    return _start(stream.writeStream.foreachBatch(write), checkpoint,
                  trigger or {"availableNow": True})
