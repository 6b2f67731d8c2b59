import json

import pytest
from pyspark.sql import functions as F

from fleetlens import schemas
from fleetlens.functions import device_record, event_record
from fleetlens.sources import (FileTopic, KafkaTopic, decode, encode, read_csv, read_json_array,
                               to_messages, write_csv, write_json)

from fixtures import START, device, event, values

GOOD = event("d01", START, "accessRejected")
BAD = ["bad{", GOOD[:-1], "[1, 2]", '"text"', "", "  "]


def test_payload_stays_json_text(spark):
    row = decode(values(spark, [device(1)]), schemas.DEVICES, "fail").first()
    assert row["deviceId"] == "d01"
    assert json.loads(row["payload"])["location"]["city"] == "Zürich"


@pytest.mark.parametrize("text", BAD)
def test_strict_decoding_stops_at_bad_text(spark, text):
    with pytest.raises(Exception, match="MALFORMED|blank message"):
        decode(values(spark, [GOOD, text]), schemas.EVENTS, "fail").collect()


def test_tolerant_decoding_skips_bad_text(spark):
    rows = decode(values(spark, [GOOD, *BAD, None]), schemas.EVENTS).collect()
    assert [r["deviceId"] for r in rows] == ["d01"]


def test_bad_text_can_be_kept(spark):
    rows = decode(values(spark, [GOOD, *BAD, None]), schemas.EVENTS, "keep").collect()
    assert [r["_corrupt_record"] for r in rows] == [None, *BAD]
    assert all(r["deviceId"] is None for r in rows[1:])


def test_missing_and_unreadable_fields_are_null(spark):
    texts = ['{"deviceId": "d01"}', '{"deviceId": "d02", "timestamp": "soon"}', "{}"]
    rows = decode(values(spark, texts), schemas.EVENTS).collect()
    assert [(r["deviceId"], r["timestamp"]) for r in rows] == [("d01", None), ("d02", None), (None, None)]


BAD_TIMES = ["1686822333487", '"12:30:45"', '"2023"', '" 2023"', '"soon"', '"1686822333487"']


def test_times_that_are_none_are_null(spark):
    texts = [f'{{"deviceId": "d", "timestamp": {t}}}' for t in BAD_TIMES]
    for mode in ("drop", "keep"):
        rows = decode(values(spark, texts), schemas.EVENTS, mode).collect()
        assert [(r["deviceId"], r["timestamp"]) for r in rows] == [("d", None)] * len(texts)


@pytest.mark.parametrize("time", BAD_TIMES)
def test_strict_decoding_stops_at_times_that_are_none(spark, time):
    with pytest.raises(Exception, match="MALFORMED time in timestamp"):
        decode(values(spark, [f'{{"deviceId": "d", "timestamp": {time}}}']), schemas.EVENTS, "fail").collect()


def test_unknown_mode_is_refused(spark):
    with pytest.raises(ValueError):
        decode(values(spark, [GOOD]), schemas.EVENTS, "ignore")


def test_each_message_is_parsed_once(spark):
    plan = decode(values(spark, [GOOD]), schemas.EVENTS).where("deviceId = 'd01'")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("from_json") == 1


def test_enriched_events_survive_a_round_trip(spark):
    rows = spark.sql("""
        SELECT 'd01' deviceId, 'Zürich' deviceCity, CAST(NULL AS STRING) deviceRegion,
               '47.1,8.2' deviceLocation, 'm' messageName, 'n' eventNotificationName,
               TIMESTAMP '2023-06-15 09:45:33.123456' timestamp,
               '2023-06-15T09:45:33.487Z' eventTimestamp""")
    text = encode(rows).first()["value"]
    assert '"deviceRegion":null' in text and '"timestamp":"2023-06-15T09:45:33.123456Z"' in text
    back = decode(encode(rows), schemas.ENRICHED_IN).first()
    assert str(back["timestamp"]) == "2023-06-15 09:45:33.123456"
    assert str(back["eventTimestamp"]) == "2023-06-15 09:45:33.487000"
    assert "deviceRegion" not in encode(rows, keep_nulls=False).first()["value"]


def test_window_bounds_have_no_zone(spark):
    rows = spark.sql("SELECT TIMESTAMP_NTZ '2023-06-15 09:45:30' AS window_start")
    assert encode(rows).first()["value"] == '{"window_start":"2023-06-15T09:45:30"}'


def test_records_look_like_the_wire(spark):
    frame = spark.sql("SELECT 'd01' id, '47.37,8.52' loc, TIMESTAMP '2023-06-15 09:00:00' t")
    record = device_record("id", "loc", F.lit("Zürich"), F.lit("Zurich"), F.lit("CH"),
                           F.lit("Europe/Zurich"))
    assert json.loads(to_messages(frame, record).first()[0]) == json.loads(device(1, "47.37,8.52"))
    sent = to_messages(frame, event_record("id", F.lit("accessRejected"), "t")).first()[0]
    assert json.loads(sent) == json.loads(GOOD)


def test_files(spark, tmp_path):
    rows = spark.createDataFrame([("47.1,8.2",), ("47.3,8.4",)], "coordinates STRING")
    write_csv(rows.coalesce(1), str(tmp_path / "csv"))
    part = next((tmp_path / "csv").glob("part-*")).read_text().splitlines()
    assert part[0] == "coordinates" and part[1].startswith('"47.')
    back = read_csv(spark, str(tmp_path / "csv"), "coordinates STRING")
    assert sorted(r[0] for r in back.collect()) == ["47.1,8.2", "47.3,8.4"]

    (tmp_path / "devices.json").write_text(
        "[\n " + ",\n ".join(device(n) for n in range(3)) + "\n]", encoding="utf-8")
    found = read_json_array(spark, str(tmp_path / "devices.json"), schemas.DEVICES)
    assert [r["deviceId"] for r in found.collect()] == ["d00", "d01", "d02"]

    write_json(spark.sql("SELECT 1 a, CAST(NULL AS INT) b"), str(tmp_path / "json"))
    assert next((tmp_path / "json").glob("part-*")).read_text().strip() == '{"a":1,"b":null}'


def test_kafka_options():
    topic = KafkaTopic("EVENTS", "broker:9092", group_id="g", options={"maxOffsetsPerTrigger": "10"})
    assert topic.reader_options() == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "EVENTS",
        "startingOffsets": "earliest", "maxOffsetsPerTrigger": "10", "kafka.group.id": "g"}
    assert topic.writer_options() == {"kafka.bootstrap.servers": "broker:9092", "topic": "EVENTS"}


def test_file_topic(spark, tmp_path):
    topic = FileTopic(str(tmp_path / "topic"))
    topic.publish(values(spark, ["a", "b"]))
    topic.publish(values(spark, ["c"]))
    assert sorted(r[0] for r in topic.table(spark).collect()) == ["a", "b", "c"]
