"""Queries that write files or store tables and read them back."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens import operators as op, plans
from fleetlens.functions import device_record
from fleetlens.session import scratch_dir
from fleetlens.sources import (FileTopic, encode, read_csv, read_json_array, write_csv, write_json)

from . import sql
from .data import device_messages, devices, event_messages, events, location, table
from .registry import query


def _enriched_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(op.enrich(events(table(spark, sf_dir, "events")),
                            devices(table(spark, sf_dir, "customer"))))


def _events_table(spark: SparkSession, sf_dir: str, label: str) -> str:
    path = scratch_dir(spark, label)
    plans.load(_enriched_messages(spark, sf_dir), plans.EVENTS_GEO, path, "first")
    return path


def _devices_table(spark: SparkSession, sf_dir: str, label: str) -> str:
    path = scratch_dir(spark, label)
    plans.load(device_messages(table(spark, sf_dir, "customer")), plans.DEVICES, path, "first")
    return path


def _alerts_table(spark: SparkSession, sf_dir: str, label: str) -> str:
    from .batch import enriched_alerts
    path = scratch_dir(spark, label)
    plans.load(encode(enriched_alerts(spark, sf_dir)), plans.ALERTS, path, "first")
    return path


def _rounded(*columns: str) -> dict:
    return {c: F.round(F.col(c).cast("double"), 4) for c in columns}


def _stored_position(text: str, lat: str, lon: str) -> str:
    return (f"round(CAST(CAST({sql.latitude(text)} AS FLOAT) AS DOUBLE), 4) AS {lat}, "
            f"round(CAST(CAST({sql.longitude(text)} AS FLOAT) AS DOUBLE), 4) AS {lon}")


# Files ----------------------------------------------------------------------------

@query(f"SELECT {sql.LOCATION} AS coordinates FROM customer")
def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "csv")
    write_csv(table(spark, sf_dir, "customer").select(location().alias("coordinates")), path)
    return read_csv(spark, path, "coordinates STRING")


@query("SELECT event_id, user_id, CASE WHEN event_type <> 'view' THEN props ELSE 'none' END AS props "
       "FROM events")
def json_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "json")
    rows = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.when(F.col("event_type") != "view", F.col("props")).alias("props"))
    write_json(rows, path)
    rows = spark.read.schema("event_id BIGINT, user_id BIGINT, props STRING").json(path)
    return rows.withColumn("props", F.coalesce("props", F.lit("none")))


@query(f'SELECT CAST(c_custkey AS VARCHAR) AS "deviceId", {sql.LOCATION} AS loc, '
       "c_mktsegment AS city FROM customer")
def json_array_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Device records of one nation per file, each file one JSON array."""
    path = scratch_dir(spark, "json-array")
    customers = table(spark, sf_dir, "customer")
    record = device_record(F.col("c_custkey").cast("string"), location(), "c_mktsegment",
                           F.lit("Zurich"), F.lit("CH"), F.lit("Europe/Zurich"))
    # Arrays of at most 1,000 records, however many devices a nation has.
    batch = F.floor(F.col("c_custkey") / 1000)
    arrays = customers.groupBy("c_nationkey", batch).agg(F.to_json(F.collect_list(record)).alias("value"))
    arrays.select("value").write.option("lineSep", "\n").option("maxRecordsPerFile", 1).text(path)
    rows = read_json_array(spark, path, "deviceId STRING, payload STRUCT<location: "
                                        "STRUCT<city: STRING, loc: STRING>>")
    return rows.select("deviceId", "payload.location.loc", "payload.location.city")


@query(f'SELECT CAST(user_id AS VARCHAR) AS "deviceId", event_type AS name, {sql.MILLIS} AS ts FROM events')
def topic_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fleetlens.streaming import events_from
    topic = FileTopic(scratch_dir(spark, "topic"))
    topic.publish(event_messages(table(spark, sf_dir, "events")))
    rows = events_from(topic.table(spark))
    return rows.select("deviceId", F.get_json_object("payload", "$.notificationName").alias("name"),
                       F.col("timestamp").cast("timestamp_ntz").alias("ts"))


# Store tables ---------------------------------------------------------------------

_STORED_DEVICES = f"""
    SELECT TIMESTAMP '2010-01-01' AS "__time", c_mktsegment AS "payload.location.city",
           'CH' AS "payload.location.countryCode", {sql.LOCATION} AS location,
           CAST(c_nationkey AS VARCHAR) AS "payload.location.region",
           'Europe/Zurich' AS "payload.location.timezone",
           CAST(c_custkey AS VARCHAR) AS "deviceId",
           {_stored_position(sql.LOCATION, 'latitude', 'longitude')}
    FROM customer"""

_STORED_EVENTS = f"""
    SELECT {sql.MILLIS} AS "__time", "deviceId", "deviceCity", "deviceRegion", "messageName",
           "eventNotificationName",
           CASE WHEN epoch_ms(ts) % 1000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
                ELSE rtrim(strftime(ts, '%Y-%m-%dT%H:%M:%S.%g'), '0') || 'Z' END AS "timestamp",
           {_stored_position('"deviceLocation"', '"deviceLatitude"', '"deviceLongitude"')},
           strftime(ts, '%Y-%m-%d') AS "__date"
    FROM (SELECT "timestamp" AS ts, * EXCLUDE ("timestamp") FROM ({sql.ENRICHED}))"""


def _show_events(rows: DataFrame) -> DataFrame:
    shown = {"__time": F.col("__time").cast("timestamp_ntz"),
             **_rounded("deviceLatitude", "deviceLongitude")}
    if "__date" in rows.columns:
        shown["__date"] = F.col("__date").cast("string")
    return rows.withColumns(shown)


@query(_STORED_DEVICES)
def ingest_devices(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = plans.read_table(spark, plans.DEVICES, _devices_table(spark, sf_dir, "devices"))
    return rows.withColumns({"__time": F.col("__time").cast("timestamp_ntz"),
                             **_rounded("latitude", "longitude")})


@query(_STORED_EVENTS)
def ingest_events_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show_events(plans.read_table(spark, plans.EVENTS_GEO,
                                         _events_table(spark, sf_dir, "events-geo")))


_ENRICHED_ALERTS = sql.alerts(2 * sql.DAY, sql.DAY, 3, 0, keys='"deviceId", "deviceLocation"',
                              where="\"eventNotificationName\" = 'error'",
                              source=f"({sql.ENRICHED})", time='"timestamp"')


@query(f"""
    SELECT window_end AS "__time", strftime(window_start, '%Y-%m-%dT%H:%M:%S') AS window_start,
           total_count_per_deviceid, "deviceId", avg_error_count, std_error_count,
           {_stored_position('"deviceLocation"', '"deviceLatitude"', '"deviceLongitude"')},
           strftime(window_end, '%Y-%m-%d') AS "__date"
    FROM ({_ENRICHED_ALERTS})""")
def ingest_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _show_events(plans.read_table(spark, plans.ALERTS,
                                         _alerts_table(spark, sf_dir, "alerts")))


@query(_STORED_EVENTS)
def ingest_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that is repeated adds nothing."""
    path = _events_table(spark, sf_dir, "again")
    plans.load(_enriched_messages(spark, sf_dir), plans.EVENTS_GEO, path, "first")
    return _show_events(plans.read_table(spark, plans.EVENTS_GEO, path))


@query("""
    SELECT event_id, ts AS "__time", CAST(value * 100 AS BIGINT) // 100 AS whole,
           list_sort([event_type, 'm', 'm']) [1] AS tag1, 3 AS n_tags, strftime(ts, '%Y-%m-%d') AS "__date"
    FROM (SELECT * REPLACE (date_trunc('milliseconds', ts) AS ts) FROM events)
    WHERE event_type <> 'signup'""")
def ingest_custom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A spec of one's own: nested path, several values in one column, a whole number
    from text, and messages without a time left out."""
    spec = plans.IngestSpec(
        name="CUSTOM", time_column="at", time_form="auto",
        dimensions=(plans.Dimension("event_id", "long"), plans.Dimension("whole", "long"),
                    plans.Dimension("tags", multi_value=True)),
        paths={"whole": "$.inner.value"})
    stamp = F.when(F.col("event_type") != "signup", F.unix_millis(F.col("ts").cast("timestamp")))
    record = F.struct("event_id", F.struct("value").alias("inner"), stamp.alias("at"),
                      F.array("event_type", F.lit("m"), F.lit("m")).alias("tags"))
    path = scratch_dir(spark, "custom")
    plans.load(encode(table(spark, sf_dir, "events").select(record.alias("r")).select("r.*")),
               spec, path, "first")
    rows = plans.read_table(spark, spec, path)
    return rows.select("event_id", F.col("__time").cast("timestamp_ntz").alias("__time"), "whole",
                       F.col("tags")[0].alias("tag1"), F.size("tags").alias("n_tags"),
                       F.col("__date").cast("string").alias("__date"))


@query(f"SELECT * FROM ({_STORED_EVENTS}) WHERE \"__time\" >= TIMESTAMP '2024-01-10 06:00:00' "
       "AND \"__time\" < TIMESTAMP '2024-01-15 18:30:00'")
def scan_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _events_table(spark, sf_dir, "scan")
    return _show_events(plans.scan(spark, plans.EVENTS_GEO, path, datetime(2024, 1, 10, 6),
                                   datetime(2024, 1, 15, 18, 30)))


@query(f"SELECT * FROM ({_STORED_EVENTS}) WHERE NOT \"__time\" < TIMESTAMP '2024-01-12'")
def delete_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _events_table(spark, sf_dir, "delete")
    plans.delete_interval(spark, plans.EVENTS_GEO, path, date(1000, 1, 1), date(2024, 1, 12))
    return _show_events(plans.read_table(spark, plans.EVENTS_GEO, path))


@query(f"SELECT * FROM ({_STORED_EVENTS}) WHERE \"__time\" >= TIMESTAMP '2024-01-05' "
       "AND \"__time\" < TIMESTAMP '2024-01-20'")
def ingest_ranged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Early and late rows turned away while loading."""
    path = scratch_dir(spark, "ranged")
    plans.load(_enriched_messages(spark, sf_dir), plans.EVENTS_GEO, path, "first",
               start=datetime(2024, 1, 5), end=datetime(2024, 1, 20))
    return _show_events(plans.read_table(spark, plans.EVENTS_GEO, path))


@query(f"SELECT * FROM ({_STORED_EVENTS}) WHERE \"__time\" < TIMESTAMP '2024-01-10'")
def ingest_replaced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load repeated with fewer days, and one repeated with no row."""
    path, sent = _events_table(spark, sf_dir, "replaced"), _enriched_messages(spark, sf_dir)
    plans.load(sent, plans.EVENTS_GEO, path, "second")
    plans.load(sent, plans.EVENTS_GEO, path, "first", end=datetime(2024, 1, 10))
    plans.load(sent.limit(0), plans.EVENTS_GEO, path, "second")
    return _show_events(plans.read_table(spark, plans.EVENTS_GEO, path))


@query("""
    SELECT 1 AS step, count(*) AS n FROM customer UNION ALL
    SELECT 2, 2 * count(*) FROM customer UNION ALL SELECT 3, 0 UNION ALL
    SELECT 4, count(*) FROM customer""")
def view_follows_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load, query, load, query, empty, query, load, query in one session."""
    path, sent = scratch_dir(spark, "view"), device_messages(table(spark, sf_dir, "customer"))
    counts = []

    def count() -> None:
        counts.append((len(counts) + 1, spark.sql("SELECT count(*) FROM DEVICES").first()[0]))

    plans.load(sent, plans.DEVICES, path, "a")
    plans.enable(spark, plans.DEVICES, path)
    count()
    plans.load(sent, plans.DEVICES, path, "b")
    count()
    plans.delete_all(spark, path)
    count()
    plans.load(sent, plans.DEVICES, path, "c")
    count()
    plans.disable(spark, plans.DEVICES)
    return spark.createDataFrame(counts, "step INT, n BIGINT")


def _by_device(messages: DataFrame, parts: int, part: int) -> DataFrame:
    return messages.where(F.get_json_object("value", "$.deviceId").cast("bigint") % parts == part)


@query(f"""
    SELECT * FROM ({_STORED_EVENTS})
    WHERE CAST("deviceId" AS BIGINT) % 3 <> 1 OR "__time" < TIMESTAMP '2024-01-10'""")
def compacted_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads, rewritten as one file a day; then one of them is repeated with fewer
    days, and the days it has left are rewritten again."""
    path, sent = scratch_dir(spark, "compacted"), _enriched_messages(spark, sf_dir)
    for part in range(3):
        plans.load(_by_device(sent, 3, part), plans.EVENTS_GEO, path, f"s-{part}")
    plans.compact(spark, plans.EVENTS_GEO, path, before=date(2024, 1, 20))
    plans.load(_by_device(sent, 3, 1), plans.EVENTS_GEO, path, "s-1", end=datetime(2024, 1, 10))
    plans.compact(spark, plans.EVENTS_GEO, path)
    return _show_events(plans.read_table(spark, plans.EVENTS_GEO, path))


@query("""
    SELECT count(DISTINCT CAST(ts AS DATE)) FILTER (ts < TIMESTAMP '2024-01-20') AS days,
           count(*) > 0 AS has_rows
    FROM events JOIN customer ON user_id = c_custkey""")
def compacted_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A compacted day is one file, whatever the number of loads."""
    path, sent = scratch_dir(spark, "few-files"), _enriched_messages(spark, sf_dir)
    for part in range(4):
        plans.load(_by_device(sent, 4, part), plans.EVENTS_GEO, path, f"s-{part}")
    plans.compact(spark, plans.EVENTS_GEO, path, before=date(2024, 1, 20))
    rows = plans.read_table(spark, plans.EVENTS_GEO, path).withColumn("file", F.input_file_name())
    early = F.when(F.col("__date") < "2024-01-20", F.col("file"))
    return rows.agg(F.count_distinct(early).alias("days"), (F.count("*") > 0).alias("has_rows"))


@query(f"""
    SELECT * FROM ({_STORED_EVENTS})
    WHERE "eventNotificationName" <> 'error' OR "__time" < TIMESTAMP '2024-01-08'
       OR "__time" >= TIMESTAMP '2024-01-12'""")
def replace_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days are replaced by a query that reads them."""
    path = _events_table(spark, sf_dir, "replace-days")
    plans.enable(spark, plans.EVENTS_GEO, path)
    plans.replace_interval(spark, plans.EVENTS_GEO, path, """
        SELECT * FROM EVENTS_GEO WHERE eventNotificationName <> 'error'
        AND __date >= DATE'2024-01-08' AND __date < DATE'2024-01-12'""",
                           date(2024, 1, 8), date(2024, 1, 12), "without errors")
    found = _show_events(spark.table(plans.EVENTS_GEO.name))
    plans.disable(spark, plans.EVENTS_GEO)
    return found


@query("""
    SELECT 'batch' AS load, count(*) AS n_read,
           count(*) FILTER (event_type <> 'error' AND ts < TIMESTAMP '2024-01-15') AS n_kept
    FROM events JOIN customer ON user_id = c_custkey
    UNION ALL
    SELECT 'stream-0', count(*), count(*) FILTER (event_type <> 'error')
    FROM events JOIN customer ON user_id = c_custkey""")
def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages that cannot be decoded, or are too late, are counted and left out."""
    sent = _enriched_messages(spark, sf_dir).withColumn(
        "value", F.when(F.col("value").contains('"error"'), F.substring("value", 2, 1_000_000))
        .otherwise(F.col("value")))
    path, topic = scratch_dir(spark, "counted"), FileTopic(scratch_dir(spark, "counted-topic"))
    plans.load(sent, plans.EVENTS_GEO, path, "batch", end=datetime(2024, 1, 15))
    topic.publish(sent)
    plans.load_stream(topic.stream(spark), plans.EVENTS_GEO, path, scratch_dir(spark, "counted-progress"),
                      "stream").awaitTermination()
    reports = [(r.load_id, r.read, r.kept) for r in plans.load_history(spark, path)]
    return spark.createDataFrame(reports, "load STRING, n_read BIGINT, n_kept BIGINT")


_DEVICES_A_DAY = f"""
    SELECT "__date" AS day, count(*) AS n, count(DISTINCT "deviceId") AS devices FROM ({_STORED_EVENTS})
    GROUP BY 1"""


@query(f"SELECT day, n, devices, TRUE AS near FROM ({_DEVICES_A_DAY})")
def distinct_devices_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct counts from sketches, within 5 percent (three times the stated error) of the truth."""
    rows = plans.read_table(spark, plans.EVENTS_GEO, _events_table(spark, sf_dir, "sketched"))
    sketches = plans.day_sketches(rows, distinct=["deviceId"])
    exact = rows.groupBy("__date").agg(F.count_distinct("deviceId").alias("devices"))
    off = F.abs(plans.distinct_count("deviceId") - F.col("devices"))
    return sketches.join(exact, "__date").select(
        F.col("__date").cast("string").alias("day"), F.col("rows").alias("n"), "devices",
        (off <= F.greatest(F.col("devices") * 0.05, F.lit(1))).alias("near"))


@query("""
    SELECT event_type AS kind, count(*) AS n, TRUE AS devices_near, TRUE AS middle_near
    FROM events JOIN customer ON user_id = c_custkey WHERE value IS NOT NULL GROUP BY 1""")
def merged_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches per day and kind, written, read and merged over the whole time."""
    events_, customers = table(spark, sf_dir, "events"), table(spark, sf_dir, "customer")
    rows = (events_.join(customers, F.col("user_id") == F.col("c_custkey")).where("value IS NOT NULL")
            .select(F.to_date("ts").alias("__date"), F.col("event_type").alias("kind"), "user_id", "value"))
    path = scratch_dir(spark, "sketches")
    plans.day_sketches(rows, ["kind"], ["user_id"], ["value"]).write.parquet(path)
    found = plans.merged(spark.read.parquet(path), ["kind"]).withColumns({
        "about": plans.distinct_count("user_id"), "middle": plans.quantile("value", 0.5)})
    exact = rows.groupBy("kind").agg(F.count_distinct("user_id").alias("devices"))
    share = (rows.join(found.select("kind", "middle"), "kind").groupBy("kind")
             .agg(F.avg((F.col("value") <= F.col("middle")).cast("double")).alias("share")))
    off = F.abs(F.col("about") - F.col("devices"))
    return found.join(exact, "kind").join(share, "kind").select(
        "kind", F.col("rows").alias("n"),
        (off <= F.greatest(F.col("devices") * 0.05, F.lit(1))).alias("devices_near"),
        (F.abs(F.col("share") - 0.5) <= 0.05).alias("middle_near"))


# Reports --------------------------------------------------------------------------

@query(f'SELECT "deviceId", latitude, longitude FROM ({_STORED_DEVICES})')
def device_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = plans.read_table(spark, plans.DEVICES, _devices_table(spark, sf_dir, "map"))
    return plans.device_map(rows).withColumns(_rounded("latitude", "longitude"))


@query(f"""
    SELECT time_bucket(INTERVAL 1 DAY, "__time") AS bucket_start, "deviceCity",
           count(*) FILTER ("eventNotificationName" = 'error') AS rejected, count(*) AS total
    FROM ({_STORED_EVENTS}) GROUP BY ALL""")
def rejected_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = plans.read_table(spark, plans.EVENTS_GEO, _events_table(spark, sf_dir, "over-time"))
    report = plans.rejected_over_time(rows, "1 day", "error", area=("deviceCity",))
    return report.withColumn("bucket_start", F.col("bucket_start").cast("timestamp_ntz"))


@query(f"""
    SELECT window_end AS "__time", "deviceId",
           {_stored_position('"deviceLocation"', '"deviceLatitude"', '"deviceLongitude"')},
           total_count_per_deviceid, avg_error_count, std_error_count
    FROM ({_ENRICHED_ALERTS})
    WHERE window_end >= TIMESTAMP '2024-01-08' AND window_end < TIMESTAMP '2024-01-22'""")
def alerts_on_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _alerts_table(spark, sf_dir, "alerts-map")
    rows = plans.scan(spark, plans.ALERTS, path, datetime(2024, 1, 8), datetime(2024, 1, 22))
    return _show_events(plans.alerts_on_map(rows))


@query(f'SELECT "deviceId" AS id, latitude FROM ({_STORED_DEVICES})')
def sql_over_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text in, JSON rows out."""
    plans.enable(spark, plans.DEVICES, _devices_table(spark, sf_dir, "sql"))
    found = plans.query_messages(spark, "SELECT deviceId, latitude, longitude FROM DEVICES")
    plans.disable(spark, plans.DEVICES)
    lat = F.get_json_object("value", "$.latitude").cast("float").cast("double")
    return found.select(F.get_json_object("value", "$.deviceId").alias("id"),
                        F.round(lat, 4).alias("latitude"))


@query("""
    SELECT c_custkey AS id, c_acctbal >= 0 AS has_city, TRUE AS kept_with_nulls FROM customer""")
def rows_as_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored rows as JSON: devices with their NULLs, events without. Devices of
    customers in debt have no city here."""
    customers = table(spark, sf_dir, "customer")
    cities = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    sent = device_messages(customers.withColumn("c_mktsegment", cities))
    path = scratch_dir(spark, "as-messages")
    plans.load(sent, plans.DEVICES, path, "first")
    rows = plans.read_table(spark, plans.DEVICES, path)

    def has_city(messages: DataFrame, name: str) -> DataFrame:
        return messages.select(
            F.get_json_object("value", "$.deviceId").cast("bigint").alias("id"),
            F.col("value").contains('"payload.location.city":').alias(name))

    kept = has_city(plans.as_messages(rows, plans.DEVICES), "kept_with_nulls")
    dropped = has_city(plans.as_messages(rows, plans.EVENTS_GEO), "has_city")
    return dropped.join(kept, "id")


@query(f'SELECT "deviceId", latitude, longitude FROM ({_STORED_DEVICES})')
def save_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "saved")
    name = "saved_" + path.rsplit("-", 1)[1]
    rows = plans.read_table(spark, plans.DEVICES, _devices_table(spark, sf_dir, "to-save"))
    plans.save_result(plans.device_map(rows), name, path)
    return spark.table(name).withColumns(_rounded("latitude", "longitude"))
