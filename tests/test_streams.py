import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlens import operators as op, plans, schemas
from fleetlens.session import scratch_dir
from fleetlens.sources import FileTopic, decode
from fleetlens.streaming import (Lateness, WaitingEvents, alert_job, alerts_from, devices_from, enriched_from,
                                 enrichment_job, events_from, fan_out, late_job)

from fixtures import START, device, event, run_of_events, values

NOW = {"availableNow": True}


def rejected():
    return F.col("eventNotificationName") == "accessRejected"


def geo(device_id, when, status="accessRejected"):
    stamp = when.isoformat(timespec="milliseconds") + "Z"
    return json.dumps({"deviceId": device_id, "deviceLocation": "47,8", "messageName": "m",
                       "eventNotificationName": status, "timestamp": stamp, "eventTimestamp": stamp})


def topic(spark, label, **settings):
    return FileTopic(scratch_dir(spark, label), **settings)


def run(rows, spark, checkpoint=None):
    path = scratch_dir(spark, "out")
    query = (rows.writeStream.format("parquet").option("path", path)
             .option("checkpointLocation", checkpoint or scratch_dir(spark, "progress"))
             .trigger(**NOW).start())
    query.awaitTermination()
    return spark.read.schema(rows.schema).parquet(path), query


def pipeline(spark, messages, devices=20, **settings):
    """Both jobs and the three tables, as one run over a file topic."""
    sent, enriched, alerts = (topic(spark, n) for n in ("sent", "enriched", "alerts"))
    sent.publish(values(spark, messages))
    known = devices_from(values(spark, [device(n) for n in range(devices)]))
    enrichment_job(spark, known, sent, enriched, scratch_dir(spark, "p1"), trigger=NOW).awaitTermination()
    alert_job(spark, enriched, alerts, scratch_dir(spark, "p2"), trigger=NOW,
              **settings).awaitTermination()
    return enriched, alerts


@pytest.mark.parametrize("one_state", [False, True])
def test_only_the_disrupted_device_alerts(spark, one_state):
    enriched, alerts = pipeline(spark, run_of_events(disrupted=7), one_state=one_state)
    rows = alerts_from(alerts.table(spark), "fail").collect()
    assert {r["deviceId"] for r in rows} == {"d07"}
    assert all(r["total_count_per_deviceid"] > r["avg_error_count"] + 3 * r["std_error_count"] + 5
               for r in rows)
    # The same as in batch, for the windows that the watermark has closed.
    batch = op.deviation_alerts(enriched_from(enriched.table(spark)), where=rejected())
    closed = op.closed_before(batch, F.lit(START + timedelta(seconds=234)).cast("timestamp_ntz"))
    names = schemas.ALERTS.names
    assert sorted(map(tuple, closed.select(*names).collect())) == sorted(tuple(r) for r in rows)
    assert batch.count() > closed.count() > 3

    path = scratch_dir(spark, "alert-table")
    plans.load_stream(alerts.stream(spark), plans.ALERTS, path, scratch_dir(spark, "p3"), "s").awaitTermination()
    stored = plans.alerts_on_map(plans.read_table(spark, plans.ALERTS, path)).collect()
    assert {r["deviceId"] for r in stored} == {"d07"} and len(stored) == len(rows)
    assert {round(r["deviceLatitude"], 6) for r in stored} == {47.370007}


def test_a_normal_run_raises_no_alert(spark):
    _, alerts = pipeline(spark, run_of_events())
    assert spark.read.schema("value STRING").text(alerts.path).count() == 0


def test_events_that_are_not_counted_close_windows_too(spark):
    source = topic(spark, "closing")
    times = [(f"d{d}", START + timedelta(seconds=s)) for d in range(3) for s in range(d, 60, 5)]
    source.publish(values(spark, [geo(d, t) for d, t in times]
                          + [geo("d0", START + timedelta(seconds=s)) for s in range(40)]
                          + [geo("d0", START + timedelta(minutes=10), "accessGranted")]))
    rows = op.deviation_alerts(enriched_from(source.stream(spark)), where=rejected(), k=1, floor=0)
    got, _ = run(rows, spark)
    want = op.deviation_alerts(enriched_from(source.table(spark)), where=rejected(), k=1, floor=0)
    assert want.count() > 0
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_late_rows(spark):
    """A row behind the watermark of its own batch still counts; one that arrives
    a whole batch after the watermark has moved does not."""
    source = topic(spark, "late", max_files_per_trigger=1)
    checkpoint, out = scratch_dir(spark, "progress"), scratch_dir(spark, "out")
    late = geo("late", START + timedelta(seconds=10))

    def step(*messages):
        source.publish(values(spark, list(messages)).coalesce(1))
        rows = enriched_from(source.stream(spark)).withWatermark("eventTimestamp", "5 seconds")
        counts = op.hop_counts(rows, ["deviceId"], "eventTimestamp", "1 minute", "30 seconds")
        (counts.writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", checkpoint).trigger(**NOW).start().awaitTermination())

    step(geo("on time", START + timedelta(seconds=10)), geo("mover", START + timedelta(minutes=5)), late)
    step(geo("mover", START + timedelta(minutes=6)))
    step(late)
    step(geo("mover", START + timedelta(minutes=12)))
    rows = spark.read.parquet(out)
    assert {r["total_count"] for r in rows.where("deviceId = 'late'").collect()} == {1}
    assert rows.where("deviceId = 'late'").count() == 2


def test_stream_to_stream_events_wait_for_their_device(spark):
    events, devices = topic(spark, "ev"), topic(spark, "dev")
    enriched, checkpoint = topic(spark, "geo"), scratch_dir(spark, "progress")

    def step():
        enrichment_job(spark, devices, events, enriched, checkpoint, trigger=NOW).awaitTermination()
        return sorted(r["deviceId"] for r in enriched_from(enriched.table(spark)).collect())

    events.publish(values(spark, [event("d01", START), event("d02", START)]))
    devices.publish(values(spark, [device(1)]))
    assert step() == ["d01"]
    devices.publish(values(spark, [device(2)]))
    assert step() == ["d01", "d02"]
    devices.publish(values(spark, [device(2)]))          # announced again: joins again
    assert step() == ["d01", "d02", "d02"]


def test_device_table_can_be_read_anew_for_every_batch(spark):
    events, enriched = topic(spark, "ev"), topic(spark, "geo")
    known, checkpoint = topic(spark, "known"), scratch_dir(spark, "progress")

    def step(number):
        known.publish(values(spark, [device(number)]))
        events.publish(values(spark, [event(f"d{number:02}", START)]))
        enrichment_job(spark, lambda: devices_from(known.table(spark)), events, enriched, checkpoint,
                       trigger=NOW).awaitTermination()

    step(1)
    step(2)
    assert sorted(r["deviceId"] for r in enriched_from(enriched.table(spark)).collect()) == ["d01", "d02"]


def test_bounded_join_lets_state_go(spark):
    events, devices = topic(spark, "ev"), topic(spark, "dev")
    checkpoint = scratch_dir(spark, "progress")
    names = "deviceId STRING, payload STRING, seen TIMESTAMP"

    def announced(number, when):
        record = json.loads(device(number))
        return json.dumps({**record, "seen": when.isoformat() + "Z"})

    def joined():
        from pyspark.sql.types import StructField, StructType, TimestampType
        schema = StructType([*schemas.DEVICES.fields, StructField("seen", TimestampType())])
        return op.enrich_bounded(events_from(events.stream(spark)), decode(devices.stream(spark), schema),
                                 device_time="seen", wait="10 minutes", salts=2)

    out = scratch_dir(spark, "out")
    progress = None
    for minutes in (0, 5, 60, 120):
        when = START + timedelta(minutes=minutes)
        events.publish(values(spark, [event("d01", when)]))
        devices.publish(values(spark, [announced(1, when)]))
        query = (joined().writeStream.format("parquet").option("path", out)
                 .option("checkpointLocation", checkpoint).trigger(**NOW).start())
        query.awaitTermination()
        progress = query.lastProgress
    # Events at 0 and 5 minutes meet both early announcements, the others their own.
    assert spark.read.parquet(out).count() == 6
    assert progress["stateOperators"][0]["numRowsTotal"] <= 6


def test_strict_job_stops_at_bad_text(spark):
    events = topic(spark, "ev")
    events.publish(values(spark, ["bad{"]))
    query = enrichment_job(spark, devices_from(values(spark, [device(1)])), events, topic(spark, "geo"),
                           scratch_dir(spark, "progress"), trigger=NOW)
    with pytest.raises(Exception, match="MALFORMED"):
        query.awaitTermination()


def test_streamed_table(spark):
    source = topic(spark, "ingest", max_files_per_trigger=1)
    path, checkpoint = scratch_dir(spark, "table"), scratch_dir(spark, "progress")
    for day in (1, 2):
        source.publish(values(spark, [geo("d1", datetime(2024, 3, day)), geo("d2", datetime(2023, 1, 1)), "bad{"]))

    def step(checkpoint, stream_id):
        plans.load_stream(source.stream(spark), plans.EVENTS_GEO, path, checkpoint, stream_id).awaitTermination()
        return plans.read_table(spark, plans.EVENTS_GEO, path).count()

    assert step(checkpoint, "s1") == 4                      # rows a year late are kept
    assert step(checkpoint, "s1") == 4                      # nothing new
    # A batch that is repeated under its number replaces itself.
    assert step(scratch_dir(spark, "lost-progress"), "s1") == 4
    # Reading from the beginning as another stream adds everything again.
    assert step(scratch_dir(spark, "reset"), "s2") == 8


def test_fan_out_repeats_for_all_sinks(spark):
    source = topic(spark, "fan")
    source.publish(values(spark, ["a", "b", "c"]))
    got = {"one": [], "two": []}

    def sink(name):
        return lambda batch, number: got[name].append((number, batch.count()))

    fan_out(source.stream(spark), [sink("one"), sink("two")], scratch_dir(spark, "progress")).awaitTermination()
    assert got == {"one": [(0, 3)], "two": [(0, 3)]}


def devices_of(rows):
    return sorted(r["deviceId"] for r in rows.collect())


def test_events_wait_for_their_device(spark):
    sent, enriched, unplaced = (topic(spark, n, max_files_per_trigger=1) for n in ("ev", "geo", "never"))
    checkpoint, known = scratch_dir(spark, "progress"), []
    waiting = WaitingEvents(scratch_dir(spark, "waiting"), patience=2)

    def step(*numbers, of=(), **settings):
        known.extend(of)
        sent.publish(values(spark, [event(f"d{n:02}", START) for n in numbers]).coalesce(1))
        enrichment_job(spark, lambda: devices_from(values(spark, [device(n) for n in known])), sent, enriched,
                       checkpoint, trigger=NOW, waiting=waiting, unplaced=unplaced, **settings).awaitTermination()
        return devices_of(enriched_from(enriched.table(spark))), devices_of(enriched_from(unplaced.table(spark)))

    assert step(1, 2, 3, of=[1]) == (["d01"], [])
    assert step(2, of=[2]) == (["d01", "d02", "d02"], [])
    assert step(1, of=[2]) == (["d01", "d01", "d02", "d02"], ["d03"])    # two batches are over
    assert step(3, of=[3]) == (["d01", "d01", "d02", "d02", "d03"], ["d03"])
    assert len([n for n in waiting_folders(spark, waiting) if n.startswith("batch-")]) <= 2


def waiting_folders(spark, waiting):
    from fleetlens.storage import names
    return names(spark, waiting.path)


def test_a_batch_that_is_placed_again_takes_what_is_there(spark):
    waiting = WaitingEvents(scratch_dir(spark, "waiting"))
    notices = op.enrich(events_from(values(spark, [event("d01", START), event("d02", START)])),
                        devices_from(values(spark, [device(1), device(2)]))).select(
        "deviceId", "messageName", "eventNotificationName", "timestamp", "eventTimestamp")
    places = lambda n: spark.createDataFrame([(f"d{n:02}", "c", "r", "l")],
                                             "deviceId STRING, deviceCity STRING, deviceRegion STRING, deviceLocation STRING")
    first = sorted(map(tuple, waiting.place(notices, places(1), 0).select("deviceId", "placed").collect()))
    again = sorted(map(tuple, waiting.place(notices, places(2), 0).select("deviceId", "placed").collect()))
    assert first == again == [("d01", "yes"), ("d02", "waits")]
    later = waiting.place(notices.limit(0), places(2), 1).select("deviceId", "placed", "waited").collect()
    assert [tuple(r) for r in later] == [("d02", "yes", 1)]
    assert waiting.place(notices.limit(0), places(2), 2).count() == 0


def test_waiting_needs_devices_that_are_read_anew(spark):
    with pytest.raises(ValueError, match="anew"):
        enrichment_job(spark, devices_from(values(spark, [device(1)])), topic(spark, "a"), topic(spark, "b"),
                       scratch_dir(spark, "p"), waiting=WaitingEvents(scratch_dir(spark, "w")))


def test_a_batch_is_published_once(spark):
    found = topic(spark, "batches")
    for text in ("a", "b"):
        found.publish(values(spark, [text]), "job-1")
    found.publish(values(spark, ["c"]), "job-2")
    found.publish(values(spark, ["d"]))
    assert sorted(r["value"] for r in found.table(spark).collect()) == ["a", "c", "d"]
    got, _ = run(found.stream(spark), spark)
    assert sorted(r["value"] for r in got.collect()) == ["a", "c", "d"]
    with pytest.raises(ValueError, match="name"):
        found.publish(values(spark, ["e"]), "_job/1")


def test_a_retried_batch_adds_no_message(spark):
    """The second sink fails the first time, when the first one is written already."""
    source, sink, tries = topic(spark, "source"), topic(spark, "sink"), []
    source.publish(values(spark, ["a", "b"]))
    checkpoint = scratch_dir(spark, "progress")

    def fails_once(batch, number):
        tries.append(number)
        if len(tries) == 1:
            raise OSError("no connection")

    def step():
        return fan_out(source.stream(spark), [lambda batch, n: sink.publish(batch, f"job-{n}"), fails_once], checkpoint)

    with pytest.raises(Exception, match="no connection"):
        step().awaitTermination()
    step().awaitTermination()
    assert tries == [0, 0] and sorted(r["value"] for r in sink.table(spark).collect()) == ["a", "b"]


def test_late_rows_go_their_own_way(spark):
    source, on_time, late = (topic(spark, n, max_files_per_trigger=1) for n in ("source", "on-time", "late"))
    at = lambda name, seconds: geo(name, START + timedelta(seconds=seconds))
    steps = [[at("a", 0), at("b", 300)], [at("edge", 205), at("in", 235), at("c", 301)], ["bad{"],
             [at("d", 239), at("e", 246), at("f", 276)]]
    for texts in steps:
        source.publish(values(spark, texts).coalesce(1))
    checkpoint, lateness = scratch_dir(spark, "p"), Lateness(scratch_dir(spark, "lateness"))
    for _ in range(2):  # the second time nothing is new
        late_job(spark, source, on_time, late, checkpoint, lateness, trigger=NOW).awaitTermination()
    texts = [[r["value"] for r in t.table(spark).collect()] for t in (late, on_time)]
    # By the second file the watermark is at 295 s, and the last windows of 205 and 235 have
    # ended at 240 and 270; by the last file it is at 296 s, and that of 246 ends at 300.
    assert sorted(json.loads(t)["deviceId"] for t in texts[0]) == ["d", "edge", "in"]
    assert sorted(json.loads(t)["deviceId"] for t in texts[1] if t != "bad{") == ["a", "b", "c", "e", "f"]
    assert "bad{" in texts[1]


@pytest.mark.parametrize("panes", [True, False])
def test_long_windows_on_a_stream_from_panes(spark, panes):
    source = topic(spark, f"panes-{panes}", max_files_per_trigger=1)
    for hour in range(0, 30, 5):
        source.publish(values(spark, [geo(f"d{n % 3}", START + timedelta(hours=hour, minutes=13 * n))
                                      for n in range(20)]).coalesce(1))
    rows = enriched_from(source.stream(spark)).withWatermark("eventTimestamp", "5 seconds")
    got, query = run(op.hop_counts(rows, ["deviceId"], "eventTimestamp", "8 hours", "1 hour", panes=panes), spark)
    want = op.closed_before(op.hop_counts(enriched_from(source.table(spark)), ["deviceId"], "eventTimestamp",
                                          "8 hours", "1 hour"),
                            F.lit(START + timedelta(hours=25, minutes=13 * 19, seconds=-5)))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 50
    assert len(query.lastProgress["stateOperators"]) == 1 + panes
