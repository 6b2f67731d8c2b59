from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from fleetlens import operators as op, schemas
from fleetlens.operators.spread import measured_bytes
from fleetlens.sources import decode

from fixtures import START, device, event, values


def devices(spark, numbers):
    return decode(values(spark, [device(n) for n in numbers]), schemas.DEVICES, "fail")


def events(spark, ids):
    return decode(values(spark, [event(i, START) for i in ids]), schemas.EVENTS, "fail")


def test_an_event_gets_the_place_of_its_device(spark):
    row = op.enrich(events(spark, ["d03"]), devices(spark, range(5))).first()
    assert row.asDict() | {"timestamp": None} == {
        "deviceId": "d03", "deviceCity": "Zürich", "deviceRegion": "Zurich",
        "deviceLocation": "47.370003,8.520003", "messageName": "operatingNotification",
        "eventNotificationName": "accessGranted", "timestamp": None,
        "eventTimestamp": "2023-06-15T09:00:00.000Z"}
    assert [f.name for f in schemas.ENRICHED_OUT] == list(row.asDict())


def test_unknown_and_missing_devices_do_not_appear(spark):
    assert op.enrich(events(spark, ["d99", None]), devices(spark, range(5))).count() == 0


@pytest.mark.parametrize("settings_", [{}, {"broadcast": "measured"}, {"salts": 7},
                                       {"broadcast": "measured", "broadcast_limit": 0}])
def test_duplicate_devices_multiply(spark, settings_):
    got = op.enrich(events(spark, ["d01", "d01", "d02"]), devices(spark, [1, 1, 2]), **settings_)
    assert Counter(r["deviceId"] for r in got.collect()) == {"d01": 4, "d02": 1}


def test_broadcast_only_within_the_limit(spark):
    def joined(**limits):
        frame = op.enrich(events(spark, ["d01"]), devices(spark, range(5)), broadcast="measured", **limits)
        return frame._jdf.queryExecution().optimizedPlan().toString()

    assert "strategy=broadcast" in joined()
    assert "strategy=broadcast" not in joined(broadcast_limit=10)
    assert "_salt" in joined(broadcast_limit=10)


def test_measured_bytes_grow_with_the_rows(spark):
    small, large = (devices(spark, range(n)) for n in (2, 20))
    assert 0 < measured_bytes(small) < measured_bytes(large)
    assert measured_bytes(small.where("false")) == 0


def test_join_all_keeps_both_payloads(spark):
    got = op.join_all(events(spark, ["d01"]), devices(spark, [1]))
    assert got.columns == ["deviceId", "device_payload", "messageName", "event_payload", "timestamp"]
    assert got.count() == 1


@settings(max_examples=15, deadline=None)
@given(big=st.lists(st.integers(0, 5), max_size=30), small=st.lists(st.integers(0, 5), max_size=8),
       salts=st.sampled_from([1, 2, 16]))
def test_spread_join_is_a_plain_join(spark, big, small, salts):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(big)], "k INT, i INT")
    right = spark.createDataFrame([(k, j) for j, k in enumerate(small)], "k INT, j INT")
    got = op.spread_join(left, right, ["k"], ["i"], salts)
    assert got.columns == ["k", "i", "j"]
    want = Counter((k, i, j) for i, k in enumerate(big) for j, m in enumerate(small) if k == m)
    assert Counter(tuple(r) for r in got.collect()) == want


def test_a_hot_key_is_spread_over_tasks(spark):
    hot = spark.range(4000).select(F.lit(1).alias("k"), "id")
    small = spark.range(3).select(F.col("id").cast("int").alias("k"), F.lit("x").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = op.spread_join(hot, small, ["k"], ["id"])
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert joined.count() == 4000
        assert len(sizes) > 1 and max(r["count"] for r in sizes) < 3000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_latest_per_key(spark):
    rows = spark.createDataFrame([("a", 1, 10), ("a", 2, 5), ("a", 2, 7), ("b", 0, None)],
                                 "k STRING, t INT, v INT")
    got = op.latest_per_key(rows, "k", ["t", "v"])
    assert sorted(tuple(r) for r in got.collect()) == [("a", 2, 7), ("b", 0, None)]
    assert sorted(r[0] for r in op.distinct_keys(rows, "k").collect()) == ["a", "b"]
