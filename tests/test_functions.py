import json
import math
from datetime import date, datetime

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from fleetlens import functions as fn


def one(spark, column, **row):
    names = ", ".join(f"{k} {'DOUBLE' if isinstance(v, float) else 'STRING'}" for k, v in row.items())
    frame = spark.createDataFrame([tuple(row.values())], names or "x INT") if row else spark.range(1)
    return frame.select(column.alias("r")).first()["r"]


@pytest.mark.parametrize("path, want", [
    ("$.s", "{x}"), ("$.n", "1.5"), ("$.t", "true"), ("$.z", None), ("$.a", None),
    ("$.o", None), ("$.o.b", "1"), ("$.none", None), ("$.e", ""), ("$.q", "[1] is text"),
])
def test_json_value_gives_scalars_only(spark, path, want):
    doc = json.dumps({"s": "{x}", "n": 1.5, "t": True, "z": None, "a": [1], "o": {"b": 1},
                      "e": "", "q": "[1] is text"})
    assert one(spark, fn.json_value("doc", path), doc=doc) == want


@pytest.mark.parametrize("doc", ["bad{", '{"s": "x"', "", None])
def test_json_value_of_broken_text_is_null(spark, doc):
    frame = spark.createDataFrame([(doc,)], "doc STRING")
    assert frame.select(fn.json_value("doc", "$.s")).first()[0] is None


@pytest.mark.parametrize("text, lat, lon", [
    ("47.3757424811726,8.529675964932226", 47.3757424811726, 8.529675964932226),
    ("-47.1,-8.2", -47.1, -8.2),
    ("47,8", 47.0, 8.0),
    ("junk", None, None),
    (None, None, None),
    ("47.0,8.5e-05", 47.0, -5.0),
])
def test_split_location(spark, text, lat, lon):
    frame = spark.createDataFrame([(text,)], "loc STRING")
    got_lat, got_lon = frame.select(*fn.split_location("loc", "double")).first()
    assert (got_lat, got_lon) == (lat, lon)


def test_stored_positions_are_single_precision(spark):
    lat, _ = fn.split_location("loc")
    frame = spark.createDataFrame([("47.3757424811726,8.5",)], "loc STRING").select(lat.alias("lat"))
    assert dict(frame.dtypes) == {"lat": "float"}
    assert frame.select(F.col("lat").cast("string")).first()[0] == "47.375744"


def haversine(lat1, lon1, lat2, lon2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = (math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2)
         * math.sin(math.radians(lon2 - lon1) / 2) ** 2)
    return 2 * 6373.0 * math.atan2(math.sqrt(a), math.sqrt(1 - a))


def test_distance_matches_the_formula(spark):
    points = [(47.37, 8.52), (47.38, 8.53), (-33.9, 151.2), (0.0, 0.0), (89.9, 10.0)]
    frame = spark.createDataFrame(points, "lat DOUBLE, lon DOUBLE")
    got = [r[0] for r in frame.select(fn.geo_distance_km("lat", "lon", 47.37, 8.52)).collect()]
    assert got == pytest.approx([haversine(*p, 47.37, 8.52) for p in points], abs=1e-9)


@settings(max_examples=15, deadline=None)
@given(lat0=st.floats(-90, 90), lon0=st.floats(-180, 180), radius=st.floats(0.01, 3000))
def test_bounding_box_loses_no_position_in_the_circle(spark, lat0, lon0, radius):
    grid = spark.range(400).select(
        (F.lit(lat0) + (F.col("id") % 20 - 10) * radius / 1000).alias("lat"),
        (F.lit(lon0) + (F.floor(F.col("id") / 20) - 10) * radius / 1000).alias("lon"))
    grid = grid.where("lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180")
    near = grid.where(fn.geo_distance_km("lat", "lon", lat0, lon0) < radius)
    assert near.where(~fn.bounding_box("lat", "lon", (lat0, lon0), radius)).count() == 0


def test_bounding_box_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "p")
    spark.range(10).selectExpr("47.0 + id AS lat", "8.0 + id AS lon").selectExpr(
        "double(lat) lat", "double(lon) lon").write.parquet(path)
    plan = spark.read.parquet(path).where(fn.within_radius("lat", "lon", (47.37, 8.52), 0.1))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(lat" in text and "LessThanOrEqual(lat" in text


def test_disruption_only_where_and_when_it_is_on(spark):
    frame = spark.createDataFrame([(47.37, 8.52), (47.3705, 8.5201), (47.39, 8.52), (None, None)],
                                  "lat DOUBLE, lon DOUBLE")
    on = [r[0] for r in frame.select(fn.disrupted("lat", "lon", True)).collect()]
    assert on == [True, True, False, False]
    assert not any(r[0] for r in frame.select(fn.disrupted("lat", "lon", False)).collect())


def test_offset_and_disk(spark):
    frame = spark.createDataFrame([(47.37, 8.53, 300.0, -400.0)],
                                  "lat DOUBLE, lon DOUBLE, dx DOUBLE, dy DOUBLE")
    lat, lon = frame.select(*fn.offset_position("lat", "lon", "dx", "dy")).first()
    assert haversine(47.37, 8.53, lat, lon) == pytest.approx(0.5, abs=0.001)
    assert frame.select(fn.within_disk("dx", "dy", 500), fn.within_disk("dx", "dy", 499.9)
                        ).first()[:] == (True, False)


def test_iso_text_keeps_what_the_value_has(spark):
    times = [datetime(2023, 6, 15, 9, 45, 33, 487000), datetime(2023, 6, 15, 9, 45, 30),
             datetime(2023, 6, 15, 10, 0, 0, 120456)]
    frame = spark.createDataFrame([(t,) for t in times], "t TIMESTAMP_NTZ").select(
        fn.iso_text("t"), fn.iso_millis("t"))
    assert [tuple(r) for r in frame.collect()] == [
        ("2023-06-15T09:45:33.487Z", "2023-06-15T09:45:33.487Z"),
        ("2023-06-15T09:45:30Z", "2023-06-15T09:45:30.000Z"),
        ("2023-06-15T10:00:00.120456Z", "2023-06-15T10:00:00.120Z")]


@pytest.mark.parametrize("text, form, want", [
    ("2023-06-15T09:45:33.487Z", "iso", datetime(2023, 6, 15, 9, 45, 33, 487000)),
    ("2023-06-15T11:45:33+02:00", "iso", datetime(2023, 6, 15, 9, 45, 33)),
    ("2023-06-15", "iso", datetime(2023, 6, 15)),
    ("1686822333487", "iso", None),
    ("1686822333487", "auto", datetime(2023, 6, 15, 9, 45, 33, 487000)),
    ("soon", "iso", None), ("soon", "auto", None), (None, "auto", None), ("", "iso", None),
    ("2023-06-15 09:45", "iso", datetime(2023, 6, 15, 9, 45)),
    ("2023-06-15T09:45:33 +0100", "iso", datetime(2023, 6, 15, 8, 45, 33)),
    ("2023", "iso", None), (" 2023", "auto", None), ("12:30:45", "iso", None), ("T12:30", "iso", None),
    ("2023-06", "iso", None), ("2023-06-31", "iso", None), ("2023-06-15T25:00:00Z", "iso", None),
])
def test_parse_time(spark, text, form, want):
    frame = spark.createDataFrame([(text,)], "t STRING")
    got = frame.select(fn.parse_time("t", form).cast("timestamp_ntz")).first()[0]
    assert got == want


@pytest.mark.parametrize("zone", ["Asia/Tokyo", "America/New_York"])
def test_time_text_does_not_depend_on_the_session_zone(spark, zone):
    text = ["2024-03-10T02:30:00Z", "2024-11-03T05:30:00.123456Z", "2024-06-15T00:00:00.5Z"]
    kept = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        frame = spark.createDataFrame([(t,) for t in text], "t STRING")
        instants = frame.select(fn.parse_time("t").alias("i"), fn.parse_clock("t").alias("c"))
        got = instants.select(fn.iso_text("i"), fn.iso_text("c"), fn.iso_millis("i")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", kept)
    assert [r[0] for r in got] == text and [r[1] for r in got] == text
    assert [r[2] for r in got] == ["2024-03-10T02:30:00.000Z", "2024-11-03T05:30:00.123Z",
                                   "2024-06-15T00:00:00.500Z"]


@pytest.mark.parametrize("path", ["$.a[*].b", "a.b", "$..a", "$.a[?(@.b)]"])
def test_json_value_refuses_other_paths_at_once(path):
    with pytest.raises(ValueError):
        fn.json_value("doc", path)


def test_json_value_with_brackets_and_repeated_keys(spark):
    docs = ['{"a": "{x", "b": 1, "b": 2}', '{"a": {"x": 1}, "b": 1, "b": 2}', '{"a": "[1"}',
            '{"a": [1]}', '{"a": "{\\"x\\": 1}"}']
    frame = spark.createDataFrame([(d,) for d in docs], "doc STRING")
    got = [r[0] for r in frame.select(fn.json_value("doc", "$.a")).collect()]
    assert got == ["{x", None, "[1", None, '{"x": 1}']


def test_utc_date_before_and_after_the_epoch(spark):
    frame = spark.createDataFrame([("1969-12-31T23:59:59.999Z",), ("2024-02-29T00:00:00Z",)], "t STRING")
    got = [r[0] for r in frame.select(fn.utc_date(fn.parse_time("t"))).collect()]
    assert got == [date(1969, 12, 31), date(2024, 2, 29)]


def test_durations():
    assert fn.duration_micros("30 seconds") == 30_000_000
    assert fn.duration_micros("1 day 2 hours") == 93_600_000_000
    for text in ("1 month", "fast", "5"):
        with pytest.raises(ValueError):
            fn.duration_micros(text)


def test_device_ids(spark):
    frame = spark.createDataFrame([("47,8",), ("47,9",)], "loc STRING")
    stable = [r[0] for r in frame.select(fn.stable_device_id("loc")).collect()]
    assert stable == [r[0] for r in frame.select(fn.stable_device_id("loc")).collect()]
    assert len(set(stable)) == 2 and all(len(s) == 36 for s in stable)


def test_sorted_values_keep_duplicates(spark):
    frame = spark.createDataFrame([(["b", "a", "b"],)], "v ARRAY<STRING>")
    assert frame.select(fn.sorted_values("v")).first()[0] == ["a", "b", "b"]


@pytest.mark.parametrize("kind", ["TIMESTAMP", "TIMESTAMP_NTZ"])
def test_time_literals_do_not_depend_on_the_session_zone(spark, kind):
    from datetime import timedelta, timezone
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        text = "2024-01-01 12:00:00" + ("Z" if kind == "TIMESTAMP" else "")
        frame = spark.createDataFrame([(text,)], "t STRING").select(F.col("t").cast(kind))
        moments = [datetime(2024, 1, 1, 12), datetime(2024, 1, 1, 12, tzinfo=timezone.utc),
                   datetime(2024, 1, 1, 14, tzinfo=timezone(timedelta(hours=2)))]
        for moment in moments:
            assert frame.where(F.col("t") == fn.time_literal(moment, frame.schema["t"].dataType)).count() == 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_locate_reads_the_text_once(spark):
    from fleetlens.operators import locate
    frame = spark.createDataFrame([("47.37,8.52",), ("junk",)], "loc STRING")
    rows = locate(frame, "loc").where(fn.within_radius("lat", "lon", (47.37, 8.52), 0.1))
    assert [tuple(r) for r in rows.collect()] == [("47.37,8.52", 47.37, 8.52)]
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract") <= 4
