"""Batch queries: filters, functions, joins, aggregates, alerts, polygons."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetlens import functions as fn, operators as op, schemas
from fleetlens.sources import decode, encode, to_messages

from . import sql
from .data import (city, device_messages, devices, event_messages, events, land, land_with_holes, location,
                   positions, table)
from .registry import query

DAYS = {"size": "2 days", "slide": "1 day"}


def _rounded(column: Column, name: str) -> Column:
    return F.round(column, 6).alias(name)


def _zoneless(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in columns})


def _alerts(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    settings = {"key": "user_id", "also": (), "time": "ts",
                "where": F.col("event_type") == "error", **DAYS, **settings}
    return op.deviation_alerts(table(spark, sf_dir, "events"), **settings)


# Alerts and window counts ---------------------------------------------------------

@query(sql.alerts(2 * sql.DAY, sql.DAY, 3, 0))
def deviation_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir, floor=0)


@query(sql.alerts(2 * sql.DAY, sql.DAY, 3, 5))
def deviation_alerts_ref(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir)


@query(sql.alerts(2 * sql.DAY, sql.DAY, 3, 5, source="""(
    SELECT ts, user_id, event_type FROM events,
           range(CASE WHEN user_id % 50 = 7 AND day(ts) BETWEEN 10 AND 14 THEN 25 ELSE 1 END))"""))
def deviation_alerts_disrupted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean, three deviations and five: some devices send every event 25 times for five days."""
    disrupted = (F.col("user_id") % 50 == 7) & F.dayofmonth("ts").between(10, 14)
    times = F.explode(F.array_repeat(F.lit(0), F.when(disrupted, 25).otherwise(1))).alias("again")
    rows = table(spark, sf_dir, "events").select("ts", "user_id", "event_type", times)
    return op.deviation_alerts(rows, key="user_id", also=(), time="ts", where=F.col("event_type") == "error",
                               size="2 days", slide="1 day")


@query(sql.alerts(4 * sql.DAY, 2 * sql.DAY, 2, 0))
def deviation_alerts_4d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir, size="4 days", slide="2 days", k=2, floor=0)


@query(sql.alerts(2 * sql.DAY, sql.DAY, 2, 0.5, integer_stats=False))
def deviation_alerts_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _alerts(spark, sf_dir, k=2, floor=0.5, integer_stats=False)
    return rows.withColumns({c: F.round(c, 6) for c in ("avg_error_count", "std_error_count")})


@query(sql.alerts(2 * sql.DAY, sql.DAY, 1, 0, keys="user_id, event_type", where="TRUE"))
def deviation_alerts_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir, also=("event_type",), where=None, k=1, floor=0)


@query(sql.alerts(2 * sql.DAY, sql.DAY, 3, 0, last="a.window_start >= TIMESTAMP '2024-01-08' "
                                                   "AND a.window_end <= TIMESTAMP '2024-01-22'"))
def deviation_alerts_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir, floor=0,
                   time_range=(datetime(2024, 1, 8), datetime(2024, 1, 22)))


@query(sql.alerts(24 * sql.HOUR, sql.HOUR, 3, 1))
def deviation_alerts_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _alerts(spark, sf_dir, size="24 hours", slide="1 hour", floor=1)


@query(sql.hops(2 * sql.DAY, sql.DAY, "user_id", "event_type = 'error'"))
def hop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    return op.hop_counts(rows, ["user_id"], "ts", **DAYS)


@query(sql.hops(60 * sql.SECOND, 30 * sql.SECOND, "user_id, event_type"))
def hop_counts_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.hop_counts(table(spark, sf_dir, "events"), ["user_id", "event_type"], "ts",
                         "1 minute", "30 seconds")


@query(sql.hops(24 * sql.HOUR, 2 * sql.HOUR, "event_type"))
def hop_counts_panes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.hop_counts(table(spark, sf_dir, "events"), ["event_type"], "ts",
                         "24 hours", "2 hours", panes=True)


@query(f"""
    SELECT window_start, window_end, CAST(trunc(avg(total_count)) AS BIGINT) AS avg_error_count,
           CAST(trunc(round(stddev_samp(total_count), 9)) AS BIGINT) AS std_error_count
    FROM ({sql.hops(2 * sql.DAY, sql.DAY, "user_id")}) GROUP BY ALL""")
def window_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = op.count_by_hop(table(spark, sf_dir, "events"), ["user_id"], "ts", **DAYS)
    return op.with_bounds(op.window_stats(counts), "2 days")


@query(f"""
    SELECT window_start, window_end, round(avg(total_count), 6) AS avg_error_count,
           round(stddev_samp(total_count), 6) AS std_error_count
    FROM ({sql.hops(sql.HOUR, sql.HOUR // 2, "user_id")}) GROUP BY ALL""")
def window_stats_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = op.count_by_hop(table(spark, sf_dir, "events"), ["user_id"], "ts",
                             "1 hour", "30 minutes")
    return op.with_bounds(op.window_stats(counts, integer_stats=False), "1 hour").select(
        "window_start", "window_end", _rounded(F.col("avg_error_count"), "avg_error_count"),
        _rounded(F.col("std_error_count"), "std_error_count"))


@query(sql.alerts(2 * sql.DAY, sql.DAY, 3, 0, keys='"deviceId", "deviceLocation"',
                  where="\"eventNotificationName\" = 'error'",
                  source=f"({sql.ENRICHED})", time='"timestamp"'))
def enriched_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages to alerts: decode, enrich, encode, decode, alert."""
    enriched = op.enrich(events(table(spark, sf_dir, "events")),
                         devices(table(spark, sf_dir, "customer")))
    again = decode(encode(enriched), schemas.ENRICHED_IN)
    return op.deviation_alerts(again, where=F.col("eventNotificationName") == "error",
                               floor=0, **DAYS)


# Messages -------------------------------------------------------------------------

@query(f"""
    SELECT CAST(c_custkey AS VARCHAR) AS "deviceId", 'CH' AS "countryCode",
           CAST(c_nationkey AS VARCHAR) AS region, c_mktsegment AS city, {sql.LOCATION} AS loc,
           'Europe/Zurich' AS timezone
    FROM customer""")
def decode_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = {name: fn.json_value("payload", f"$.location.{name}").alias(name)
               for name in ("countryCode", "region", "city", "loc", "timezone")}
    return devices(table(spark, sf_dir, "customer")).select("deviceId", *payload.values())


@query("""
    SELECT event_id, CASE event_id % 6 WHEN 0 THEN date_trunc('second', ts)
                                       WHEN 5 THEN date_trunc('day', ts) END AS ts
    FROM events""")
def decode_bad_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Times as ISO text, a number, a clock time, a year, a year after a blank, a date."""
    ts = F.col("ts")
    forms = [fn.iso_text(F.date_trunc("second", ts)), F.unix_millis(ts.cast("timestamp")).cast("string"),
             F.date_format(ts, "HH:mm:ss"), F.date_format(ts, "yyyy"), F.date_format(ts, "' 'yyyy"),
             F.date_format(ts, "yyyy-MM-dd")]
    text = F.element_at(F.array(*forms), (F.col("event_id") % 6 + 1).cast("int"))
    quote = F.when(F.col("event_id") % 6 == 1, "").otherwise('"')
    sent = table(spark, sf_dir, "events").select(F.concat(
        F.lit('{"deviceId": "'), F.col("event_id").cast("string"), F.lit('", "timestamp": '),
        quote, text, quote, F.lit("}")).alias("value"))
    return decode(sent, schemas.EVENTS).select(
        F.col("deviceId").cast("bigint").alias("event_id"),
        F.col("timestamp").cast("timestamp_ntz").alias("ts"))


@query(f"""
    SELECT CAST(user_id AS VARCHAR) AS "deviceId", 'operatingNotification' AS "messageName",
           event_type AS "notificationName", {sql.MILLIS} AS "timestamp"
    FROM events""")
def decode_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(table(spark, sf_dir, "events")).select(
        "deviceId", "messageName",
        fn.json_value("payload", "$.notificationName").alias("notificationName"), "timestamp")
    return _zoneless(rows, "timestamp")


def _damaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event rows as JSON; sign-ups are cut off, views have a time that is none."""
    rows = table(spark, sf_dir, "events").select(
        "event_type", F.to_json(F.struct("event_id", F.when(F.col("event_type") == "view", "soon")
                                         .otherwise(fn.iso_millis("ts")).alias("ts"))).alias("value"))
    cut = F.expr("left(value, length(value) - 1)")
    return rows.select(F.when(F.col("event_type") == "signup", cut)
                       .otherwise(F.col("value")).alias("value"))


@query(f"""
    SELECT event_id, CASE WHEN event_type <> 'view' THEN {sql.ISO_MILLIS} ELSE 'none' END AS ts,
           TRUE AS missing_is_null
    FROM events WHERE event_type <> 'signup'""")
def decode_tolerant(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode(_damaged(spark, sf_dir), _as_struct("event_id BIGINT, ts TIMESTAMP, missing STRING"))
    return rows.select("event_id", F.coalesce(fn.iso_millis("ts"), F.lit("none")).alias("ts"),
                       F.col("missing").isNull().alias("missing_is_null"))


@query("""
    SELECT event_type = 'signup' AS corrupt, count(*) AS n,
           CAST(sum(CASE WHEN event_type <> 'signup' THEN event_id ELSE 0 END) AS BIGINT) AS ids
    FROM events GROUP BY 1""")
def decode_keep_corrupt(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode(_damaged(spark, sf_dir), _as_struct("event_id BIGINT, ts TIMESTAMP"), "keep")
    return (rows.groupBy(F.col("_corrupt_record").isNotNull().alias("corrupt"))
            .agg(F.count("*").alias("n"), F.sum(F.coalesce("event_id", F.lit(0))).alias("ids")))


def _as_struct(ddl: str):  # needs a session, so not at import
    from pyspark.sql.types import StructType
    return StructType.fromDDL(ddl)


@query("""
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.') ||
           rtrim(strftime(ts, '%f'), '0') || 'Z' AS zoned,
           strftime(ts, '%Y-%m-%dT%H:%M:%S.') || rtrim(strftime(ts, '%f'), '0') AS zoneless,
           event_type AS kind
    FROM events WHERE strftime(ts, '%f') <> '000000'
    UNION ALL
    SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ'), strftime(ts, '%Y-%m-%dT%H:%M:%S'),
           event_type
    FROM events WHERE strftime(ts, '%f') = '000000'""")
def encode_iso(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("zoned"), F.col("ts").alias("zoneless"),
        F.col("event_type").alias("kind"))
    return decode(encode(rows), _as_struct(
        "event_id BIGINT, zoned STRING, zoneless STRING, kind STRING"))


@query("""
    SELECT event_id, event_type = 'error' AS has_value, TRUE AS keeps_null
    FROM events""")
def encode_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_type") == "error", F.col("value")).alias("value"))
    kept = encode(rows).select(F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"),
                               F.col("value").contains('"value":').alias("keeps_null"))
    dropped = encode(rows, keep_nulls=False).select(
        F.get_json_object("value", "$.event_id").cast("bigint").alias("event_id"),
        F.col("value").contains('"value":').alias("has_value"))
    return dropped.join(kept, "event_id")


# Projections, filters, scalar functions -------------------------------------------

@query("SELECT event_id, user_id, value FROM events")
def project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", "user_id", "value")


@query("SELECT event_id, ts, user_id FROM events WHERE event_type = 'error'")
def filter_eq(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").where(F.col("event_type") == "error")
    return rows.select("event_id", "ts", "user_id")


@query("SELECT event_id, event_type FROM events WHERE event_type IN ('error', 'signup', 'view')")
def filter_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "event_type")
    return rows.where(F.col("event_type").isin("error", "signup", "view"))


@query("SELECT event_id, value FROM events WHERE value > 20 + 3 * 10 + 5")
def filter_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "events").select("event_id", "value")
    return rows.where(F.col("value") > F.lit(20) + F.lit(3) * F.lit(10) + F.lit(5))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, TRUE AS missing_is_null, "
       "TRUE AS object_is_null FROM events")
def json_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", fn.json_value("props", "$.k").alias("k"),
        fn.json_value("props", "$.none").isNull().alias("missing_is_null"),
        fn.json_value("props", "$").isNull().alias("object_is_null"))


@query(f"SELECT c_custkey, {sql.LOCATION} AS packed, round({sql.latitude(sql.LOCATION)}, 6) AS lat, "
       f"round({sql.longitude(sql.LOCATION)}, 6) AS lon FROM customer")
def location_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lon = fn.split_location("packed", "double")
    rows = table(spark, sf_dir, "customer").select("c_custkey", location().alias("packed"))
    return rows.select("c_custkey", "packed", _rounded(lat, "lat"), _rounded(lon, "lon"))


@query(f"SELECT c_custkey, round(CAST(CAST({sql.latitude(sql.LOCATION)} AS FLOAT) AS DOUBLE), 4) AS lat, "
       f"round(CAST(CAST({sql.longitude(sql.LOCATION)} AS FLOAT) AS DOUBLE), 4) AS lon, "
       "TRUE AS text_is_null FROM customer")
def location_float(spark: SparkSession, sf_dir: str) -> DataFrame:
    lat, lon = fn.split_location(location())
    none, _ = fn.split_location("c_mktsegment")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", F.round(lat.cast("double"), 4).alias("lat"),
        F.round(lon.cast("double"), 4).alias("lon"), none.isNull().alias("text_is_null"))


@query(f"SELECT id, {sql.LOCATION.replace('c_custkey', 'id')} AS loc, "
       f"CAST(lat AS VARCHAR) || ',' || CAST(lon AS VARCHAR) AS packed FROM ({sql.POSITIONS})")
def pack_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = positions(table(spark, sf_dir, "customer"))
    return rows.select("id", location_of("id").alias("loc"), fn.pack_location("lat", "lon").alias("packed"))


def location_of(column: str) -> Column:
    """``location()`` for a key under another name."""
    def digits(base: int, factor: int, span: int) -> Column:
        return F.lpad((base + F.col(column) * factor % span).cast("string"), 6, "0")

    return F.concat(F.lit("47."), digits(370000, 37, 9000), F.lit(",8."), digits(510000, 53, 20000))


_KM = """2 * 6373.0 * atan2(sqrt(a), sqrt(1 - a))"""
_HAVERSINE = f"""
    SELECT id, lat, lon, {_KM} AS km FROM (
        SELECT *, pow(sin((radians(47.37) - radians(lat)) / 2), 2) + cos(radians(lat))
                  * cos(radians(47.37)) * pow(sin((radians(8.52) - radians(lon)) / 2), 2) AS a
        FROM ({sql.POSITIONS}))"""


@query(f"SELECT id, round(km, 6) AS km FROM ({_HAVERSINE})")
def geo_distance(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = positions(table(spark, sf_dir, "customer"))
    return rows.select("id", _rounded(fn.geo_distance_km("lat", "lon", 47.37, 8.52), "km"))


@query(f"SELECT id, lat, lon FROM ({_HAVERSINE}) WHERE km < 0.5")
def geofence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = positions(table(spark, sf_dir, "customer"))
    return rows.where(fn.within_radius("lat", "lon", (47.37, 8.52), 0.5))


@query(f"""
    SELECT user_id, count(*) AS n, km < 0.5 AS disrupted
    FROM events JOIN ({_HAVERSINE}) ON user_id = id GROUP BY ALL""")
def disrupted_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Look up the position of the device of every event and tell which are disrupted."""
    places = positions(table(spark, sf_dir, "customer")).withColumnRenamed("id", "user_id")
    counted = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count("*").alias("n"))
    near = fn.disrupted("lat", "lon", True, radius_km=0.5)
    return counted.join(places, "user_id").select("user_id", "n", near.alias("disrupted"))


@query(f"""
    SELECT id, round(lat + dy / (6371000 * pi() / 180), 6) AS new_lat,
           round(lon + dx / (6371000 * cos(radians(lat)) * pi() / 180), 6) AS new_lon,
           sqrt(dx * dx + dy * dy) <= 2000 AS in_disk
    FROM (SELECT *, id * 7 % 4001 - 2000 AS dx, id * 11 % 4001 - 2000 AS dy FROM ({sql.POSITIONS}))""")
def offset_position(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = positions(table(spark, sf_dir, "customer")).select(
        "*", (F.col("id") * 7 % 4001 - 2000).alias("dx"), (F.col("id") * 11 % 4001 - 2000).alias("dy"))
    new_lat, new_lon = fn.offset_position("lat", "lon", "dx", "dy")
    return rows.select("id", _rounded(new_lat, "new_lat"), _rounded(new_lon, "new_lon"),
                       fn.within_disk("dx", "dy", 2000).alias("in_disk"))


@query(f"SELECT event_id, {sql.ISO_MILLIS} AS iso FROM events")
def iso_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", fn.iso_millis("ts").alias("iso"))


@query("SELECT event_id, date_trunc('milliseconds', ts) AS iso, "
       "date_trunc('milliseconds', ts) AS millis, TRUE AS text_is_null, "
       "strftime(ts, '%Y-%m-%d') AS day FROM events")
def parse_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    instant = F.col("ts").cast("timestamp")
    rows = table(spark, sf_dir, "events").select(
        "event_id", fn.parse_time(fn.iso_millis("ts")).alias("iso"),
        fn.parse_time(F.unix_millis(instant).cast("string"), "auto").alias("millis"),
        fn.parse_time("event_type").isNull().alias("text_is_null"),
        fn.utc_date(instant).cast("string").alias("day"))
    return _zoneless(rows, "iso", "millis")


@query(f"""
    SELECT CAST(c_custkey AS VARCHAR) AS id, {sql.LOCATION} AS loc, c_mktsegment AS city,
           to_json({{'deviceId': CAST(c_custkey AS VARCHAR), 'payload': {{'location': {{
               'countryCode': 'CH', 'region': CAST(c_nationkey AS VARCHAR), 'city': c_mktsegment,
               'loc': {sql.LOCATION}, 'timezone': 'Europe/Zurich'}}}}}})::VARCHAR AS value
    FROM customer""")
def nested_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = device_messages(table(spark, sf_dir, "customer"))
    return text.select(F.get_json_object("value", "$.deviceId").alias("id"),
                       F.get_json_object("value", "$.payload.location.loc").alias("loc"),
                       F.get_json_object("value", "$.payload.location.city").alias("city"), "value")


@query(f"""
    SELECT to_json({{'deviceId': CAST(user_id AS VARCHAR), 'messageName': 'operatingNotification',
                    'payload': {{'notificationName': event_type, 'eventTimestamp': {sql.ISO_MILLIS}}},
                    'timestamp': {sql.ISO_MILLIS}}})::VARCHAR AS value
    FROM events""")
def event_record(spark: SparkSession, sf_dir: str) -> DataFrame:
    return event_messages(table(spark, sf_dir, "events"))


@query(f"""
    SELECT c_custkey, d[1:8] || '-' || d[9:12] || '-' || d[13:16] || '-' || d[17:20] || '-'
                      || d[21:32] AS device_id
    FROM (SELECT c_custkey, sha256({sql.LOCATION} || '|' || c_custkey) AS d FROM customer)""")
def stable_device_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", fn.stable_device_id(location(), "c_custkey").alias("device_id"))


@query("SELECT count(*) AS n, TRUE AS all_distinct, TRUE AS all_uuid FROM customer")
def random_device_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = r"^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
    ids = table(spark, sf_dir, "customer").select(fn.random_device_id().alias("id"))
    return (ids.groupBy("id").agg(F.count("*").alias("n"))
            .agg(F.sum("n").alias("n"), (F.max("n") == 1).alias("all_distinct"),
                 F.bool_and(F.col("id").rlike(shape)).alias("all_uuid")))


@query("""
    SELECT event_id, list_sort([event_type, 'm', CAST(user_id AS VARCHAR), 'm'])[1] AS v1,
           list_sort([event_type, 'm', CAST(user_id AS VARCHAR), 'm'])[2] AS v2,
           list_sort([event_type, 'm', CAST(user_id AS VARCHAR), 'm'])[3] AS v3,
           list_sort([event_type, 'm', CAST(user_id AS VARCHAR), 'm'])[4] AS v4
    FROM events""")
def sorted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = fn.sorted_values(F.array("event_type", F.lit("m"), F.col("user_id").cast("string"),
                                      F.lit("m")))
    rows = table(spark, sf_dir, "events").select("event_id", values.alias("v"))
    return rows.select("event_id", *[F.col("v")[i].alias(f"v{i + 1}") for i in range(4)])


# Joins ----------------------------------------------------------------------------

def _enriched(spark: SparkSession, sf_dir: str, **settings) -> DataFrame:
    rows = op.enrich(events(table(spark, sf_dir, "events")),
                     devices(table(spark, sf_dir, "customer")), **settings)
    return _zoneless(rows, "timestamp")


@query(sql.ENRICHED)
def enrich_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir)


@query(sql.ENRICHED)
def enrich_broadcast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir, broadcast="measured")


@query(sql.ENRICHED)
def enrich_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _enriched(spark, sf_dir, broadcast="measured", broadcast_limit=0)


@query(f"""
    SELECT CAST(c_custkey AS VARCHAR) AS "deviceId", {sql.LOCATION} AS loc,
           event_type AS "notificationName", {sql.MILLIS} AS "timestamp"
    FROM customer JOIN events ON c_custkey = user_id""")
def join_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op.join_all(events(table(spark, sf_dir, "events")),
                       devices(table(spark, sf_dir, "customer")))
    rows = rows.select("deviceId", fn.json_value("device_payload", "$.location.loc").alias("loc"),
                       fn.json_value("event_payload", "$.notificationName").alias("notificationName"),
                       "timestamp")
    return _zoneless(rows, "timestamp")


@query(f"""
    SELECT o_orderkey, {sql.LOCATION} AS loc FROM orders JOIN customer ON o_custkey = c_custkey""")
def key_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    places = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"),
                                                     location().alias("loc"))
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return rows.join(places, "o_custkey").select("o_orderkey", "loc")


# One row per key ------------------------------------------------------------------

@query("""
    SELECT user_id, event_id, ts, event_type, value, props FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""")
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.latest_per_key(table(spark, sf_dir, "events"), "user_id", ["ts", "event_id"])


@query("SELECT DISTINCT user_id FROM events")
def distinct_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.distinct_keys(table(spark, sf_dir, "events"), "user_id")


# Polygons -------------------------------------------------------------------------

@query(sql.inside(sql.POSITIONS, sql.LAND))
def point_in_polygon(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.points_inside(positions(table(spark, sf_dir, "customer")),
                            land(table(spark, sf_dir, "supplier")), cell_degrees=0.001)


_USED = ("SELECT * FROM (" + sql.LAND
         + ") WHERE landuse IN ('commercial', 'industrial', 'residential')")


@query(f"""
    SELECT id, lat, lon FROM ({sql.POSITIONS})
    WHERE (lat, lon) IN (SELECT (lat, lon) FROM ({sql.inside(sql.POSITIONS, _USED)}))
      AND (lat, lon) IN (SELECT (lat, lon) FROM ({sql.inside(sql.POSITIONS, sql.CITY)}))""")
def covered_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer")
    return op.covered_positions(positions(customers), land(table(spark, sf_dir, "supplier")),
                                city(customers), cell_degrees=0.001).select("id", "lat", "lon")


@query(f"""
    SELECT polygon_id, landuse, vertex_no, round(lat, 6) AS lat, round(lon, 6) AS lon
    FROM ({sql.LAND}) WHERE landuse <> 'forest' AND polygon_id IN (
        SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)""")
def valid_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forests lose a vertex here; suppliers in debt get one that is not finite."""
    suppliers = table(spark, sf_dir, "supplier")
    debts = suppliers.select(F.col("s_suppkey").alias("polygon_id"),
                             (F.col("s_acctbal") < 0).alias("in_debt"))
    vertices = land(suppliers).join(debts, "polygon_id")
    gap = (F.col("landuse") == "forest") & (F.col("vertex_no") == 2)
    broken = F.col("in_debt") & (F.col("vertex_no") == 3)
    vertices = vertices.where(~gap).withColumn(
        "lat", F.when(broken, F.lit(float("nan"))).otherwise(F.col("lat"))).drop("in_debt")
    return op.valid_polygons(vertices).select("polygon_id", "landuse", "vertex_no",
                                              _rounded(F.col("lat"), "lat"),
                                              _rounded(F.col("lon"), "lon"))


@query(f"""
    SELECT polygon_id, round(lat, 6) AS lat1, round(lon, 6) AS lon1,
           round(coalesce(lead(lat) OVER w, first_value(lat) OVER w), 6) AS lat2,
           round(coalesce(lead(lon) OVER w, first_value(lon) OVER w), 6) AS lon2,
           round(min(lon) OVER (PARTITION BY polygon_id), 6) AS west
    FROM ({sql.LAND}) WINDOW w AS (PARTITION BY polygon_id ORDER BY vertex_no)""")
def polygon_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    edges = op.polygon_edges(land(table(spark, sf_dir, "supplier")))
    return edges.select("polygon_id", *[_rounded(F.col(c), c)
                                        for c in ("lat1", "lon1", "lat2", "lon2", "west")])


@query(sql.inside_rings(sql.POSITIONS, sql.LAND_WITH_HOLES))
def polygon_holes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A point in a hole is not inside."""
    return op.points_inside(positions(table(spark, sf_dir, "customer")),
                            land_with_holes(table(spark, sf_dir, "supplier")), cell_degrees=0.0005)


@query(f"SELECT polygon_id, substr(reason, 3) AS reason FROM ({sql.invalid(sql.LAND_WITH_HOLES)})")
def invalid_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.invalid_polygons(land_with_holes(table(spark, sf_dir, "supplier")), cell_degrees=0.0005)
