"""Queries that run as streams over the tables, to the end of what is there."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetlens import operators as op, plans
from fleetlens.functions import iso_millis
from fleetlens.session import scratch_dir
from fleetlens.sources import FileTopic
from fleetlens.streaming import (Lateness, WaitingEvents, alert_job, alerts_from, enriched_from, enrichment_job,
                                 events_from, fan_out, late_job)

from . import sql
from .data import device_messages, devices, event_messages, events, in_steps, stream, table
from .registry import query
from .tables import _STORED_EVENTS, _enriched_messages, _show_events

_NOW = {"availableNow": True}


def _run(rows: DataFrame, label: str) -> DataFrame:
    """Rows a stream has appended by the end of its input."""
    spark = rows.sparkSession
    path = scratch_dir(spark, label)
    (rows.writeStream.format("parquet").outputMode("append").option("path", path)
     .option("checkpointLocation", scratch_dir(spark, f"{label}-progress"))
     .trigger(**_NOW).start().awaitTermination())
    return spark.read.schema(rows.schema).parquet(path)


def _timed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Watermarks need an instant, the table has zone-less times.
    return stream(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


_ERROR = "event_type = 'error'"
_ERROR_HOPS = sql.hops(2 * sql.DAY, sql.DAY, "user_id", "event_type = 'error'")


@query(f"SELECT * FROM ({_ERROR_HOPS}) WHERE {sql.CLOSED}")
def stream_hop_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _timed_events(spark, sf_dir).withWatermark("ts", "5 seconds")
    rows = rows.where(F.when(F.col("ts").isNotNull(), F.col("event_type") == "error"))
    found = _run(op.hop_counts(rows, ["user_id"], "ts", "2 days", "1 day"), "stream-hops")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz")
                              for c in ("window_start", "window_end")})


@query(sql.alerts(2 * sql.DAY, sql.DAY, 3, 0, last=sql.CLOSED))
def stream_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    alerts = op.deviation_alerts(
        _timed_events(spark, sf_dir), key="user_id", also=(), time="ts",
        where=F.col("event_type") == "error", size="2 days", slide="1 day", floor=0)
    return _run(alerts, "stream-alerts")


def _zoneless(rows: DataFrame) -> DataFrame:
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


@query(sql.ENRICHED)
def stream_enrich_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = op.enrich(events(stream(spark, sf_dir, "events")),
                       devices(table(spark, sf_dir, "customer")))
    return _zoneless(_run(joined, "stream-static"))


@query(sql.ENRICHED)
def stream_enrich_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = op.enrich(events(stream(spark, sf_dir, "events")),
                       devices(stream(spark, sf_dir, "customer")))
    return _zoneless(_run(joined, "stream-stream"))


@query(f"""
    SELECT e.* FROM ({sql.ENRICHED}) e JOIN (
        SELECT CAST(o_custkey AS VARCHAR) AS id, DATE '2024-01-01' + 1 AS seen FROM orders
        GROUP BY ALL) d ON e."deviceId" = d.id
    WHERE e."timestamp" BETWEEN seen - INTERVAL 10 DAY AND seen + INTERVAL 10 DAY""")
def stream_enrich_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only devices whose customer has ordered announce themselves, on one day."""
    buyers = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey")).distinct()
    customers = stream(spark, sf_dir, "customer").join(buyers, "c_custkey")
    announced = devices(customers).withColumn("seen", F.lit("2024-01-02").cast("timestamp"))
    joined = op.enrich_bounded(events(stream(spark, sf_dir, "events")), announced,
                               device_time="seen", wait="10 days")
    return _zoneless(_run(joined, "stream-bounded"))


@query(_STORED_EVENTS)
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    topic = FileTopic(scratch_dir(spark, "ingest-topic"), max_files_per_trigger=1)
    topic.publish(_enriched_messages(spark, sf_dir))
    path = scratch_dir(spark, "ingest-table")
    plans.load_stream(topic.stream(spark), plans.EVENTS_GEO, path,
                      scratch_dir(spark, "ingest-progress"), "s1").awaitTermination()
    return _show_events(plans.read_table(spark, plans.EVENTS_GEO, path))


@query("""
    SELECT CAST(user_id AS VARCHAR) AS "deviceId", 2 * count(*) AS n
    FROM events JOIN customer ON user_id = c_custkey GROUP BY 1""")
def stream_reset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A topic read from the beginning again, on top of what is stored."""
    topic = FileTopic(scratch_dir(spark, "reset-topic"))
    topic.publish(_enriched_messages(spark, sf_dir))
    path, progress = scratch_dir(spark, "reset-table"), scratch_dir(spark, "reset-progress")
    for _ in range(2):
        plans.reset_stream(topic.stream(spark), plans.EVENTS_GEO, path, progress).awaitTermination()
    return plans.read_table(spark, plans.EVENTS_GEO, path).groupBy("deviceId").agg(
        F.count("*").alias("n"))


_STREAMED_ALERTS = sql.alerts(
    2 * sql.DAY, sql.DAY, 3, 0, keys='"deviceId", "deviceLocation"',
    where="\"eventNotificationName\" = 'error'", source=f"({sql.ENRICHED})", time='"timestamp"',
    last=sql.CLOSED)


@query(_STREAMED_ALERTS)
def stream_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both jobs, topic to topic: events to enriched events to alerts."""
    sent, enriched, alerts = (FileTopic(scratch_dir(spark, f"topic-{name}"))
                              for name in ("events", "enriched", "alerts"))
    sent.publish(event_messages(table(spark, sf_dir, "events")))
    enrichment_job(spark, devices(table(spark, sf_dir, "customer")), sent, enriched,
                   scratch_dir(spark, "enrich-progress"), trigger=_NOW).awaitTermination()
    alert_job(spark, enriched, alerts, scratch_dir(spark, "alert-progress"), status="error",
              size="2 days", slide="1 day", floor=0, trigger=_NOW).awaitTermination()
    return alerts_from(alerts.table(spark), "fail")


@query(_STREAMED_ALERTS)
def stream_topics_one_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alerts from a stream that only counts, judged batch by batch."""
    enriched, alerts = (FileTopic(scratch_dir(spark, f"topic-{name}")) for name in ("geo", "found"))
    enriched.publish(_enriched_messages(spark, sf_dir))
    alert_job(spark, enriched, alerts, scratch_dir(spark, "one-state-progress"), status="error",
              size="2 days", slide="1 day", floor=0, one_state=True, trigger=_NOW).awaitTermination()
    return alerts_from(alerts.table(spark), "fail")


@query("""
    SELECT event_type = 'error' AS is_error, count(*) AS n FROM events GROUP BY 1""")
def stream_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stream, two sinks."""
    errors, others = scratch_dir(spark, "errors"), scratch_dir(spark, "others")

    def sink(path: str, wanted):
        def write(batch: DataFrame, batch_id: int) -> None:
            batch.where(wanted).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        return write

    is_error = F.col("event_type") == "error"
    fan_out(stream(spark, sf_dir, "events"), [sink(errors, is_error), sink(others, ~is_error)],
            scratch_dir(spark, "fan-out-progress")).awaitTermination()
    both = spark.read.parquet(errors).unionByName(spark.read.parquet(others))
    return both.groupBy(is_error.alias("is_error")).agg(F.count("*").alias("n"))


# Streams of several micro-batches ---------------------------------------------------

def _week() -> Column:
    return F.least(F.lit(3), F.floor((F.dayofmonth("ts") - 1) / 8))


@query(f"SELECT * FROM ({sql.hops(24 * sql.HOUR, sql.HOUR, 'user_id', _ERROR)}) WHERE {sql.CLOSED}")
def stream_hop_counts_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long windows from panes, over four ordered files."""
    rows = table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    arriving = in_steps(rows, _week(), 4, scratch_dir(spark, "weeks")).withWatermark("ts", "5 seconds")
    arriving = arriving.where(F.when(F.col("ts").isNotNull(), F.col("event_type") == "error"))
    found = _run(op.hop_counts(arriving, ["user_id"], "ts", "24 hours", "1 hour"), "stream-hourly")
    return found.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


@query(sql.ENRICHED)
def stream_enrich_waiting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quarter of the devices is announced with each file of events."""
    customers = table(spark, sf_dir, "customer")
    sent, enriched = FileTopic(scratch_dir(spark, "ahead"), 1), FileTopic(scratch_dir(spark, "placed"))
    rows = table(spark, sf_dir, "events")
    for n in range(4):
        sent.publish(event_messages(rows.where(_week() == n)).coalesce(1))
    known = iter(range(4))
    waiting = WaitingEvents(scratch_dir(spark, "waiting"))
    enrichment_job(spark, lambda: devices(customers.where(F.col("c_custkey") % 4 <= next(known))), sent, enriched,
                   scratch_dir(spark, "waiting-progress"), waiting=waiting, trigger=_NOW).awaitTermination()
    found = enriched_from(enriched.table(spark), "fail")
    return _zoneless(found.withColumn("eventTimestamp", iso_millis("eventTimestamp")))


@query(f"""
    WITH sent AS (
        SELECT event_id, user_id, ts, least(3, least(3, (day(ts) - 1) // 8)
               + CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END) AS step
        FROM (SELECT * REPLACE ({sql.MILLIS} AS ts) FROM events)),
    newest AS (SELECT step, max(ts) AS ts FROM sent GROUP BY step)
    SELECT CAST(user_id AS VARCHAR) AS "deviceId", sent.ts AS "timestamp",
           coalesce(make_timestamp((epoch_us(sent.ts) // {sql.HOUR} + 1) * {sql.HOUR})
                    <= (SELECT max(ts) FROM newest WHERE newest.step < sent.step) - INTERVAL 5 SECOND, FALSE)
           AS late
    FROM sent""")
def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four files; every tenth event comes a file too late. An event is late when the hour
    it is in has been over for all files before."""
    rows = table(spark, sf_dir, "events")
    step = F.least(F.lit(3), _week() + F.when(F.col("event_id") % 10 == 0, 1).otherwise(0))
    sent = FileTopic(scratch_dir(spark, "mixed"), 1)
    for n in range(4):
        sent.publish(event_messages(rows.where(step == n)).coalesce(1))
    on_time, late = (FileTopic(scratch_dir(spark, f"topic-{name}")) for name in ("on-time", "late"))
    late_job(spark, sent, on_time, late, scratch_dir(spark, "late-progress"),
             Lateness(scratch_dir(spark, "lateness"), "1 hour", "1 hour"), time_path="$.timestamp",
             trigger=_NOW).awaitTermination()
    parts = [events_from(topic.table(spark)).withColumn("late", F.lit(is_late))
             for topic, is_late in ((on_time, False), (late, True))]
    return _zoneless(parts[0].unionByName(parts[1]).select("deviceId", "timestamp", "late"))


@query("SELECT event_type AS name, count(*) AS n FROM events GROUP BY 1")
def topic_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch that is published again under its name adds nothing."""
    topic, rows = FileTopic(scratch_dir(spark, "batches")), table(spark, sf_dir, "events")
    for n in (0, 1, 1, 0):
        topic.publish(event_messages(rows.where(F.col("event_id") % 2 == n)), f"half-{n}")
    found = events_from(topic.table(spark))
    return found.groupBy(F.get_json_object("payload", "$.notificationName").alias("name")).agg(
        F.count("*").alias("n"))


@query("""
    SELECT event_id, CASE WHEN day(ts) <= 16 THEN n_name ELSE upper(n_name) || '!' END AS region
    FROM events LEFT JOIN customer ON user_id = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
    WHERE c_custkey IS NOT NULL""")
def lookup_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that change between two micro-batches."""
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("region"))
    lookup, out = plans.Lookup(scratch_dir(spark, "lookup"), "nation"), scratch_dir(spark, "looked-up")
    lookup.publish(nations)
    rows = table(spark, sf_dir, "events").join(table(spark, sf_dir, "customer"), F.col("user_id") == F.col("c_custkey"))
    rows = rows.select("event_id", "ts", F.col("c_nationkey").alias("nation"))
    half = (F.dayofmonth("ts") > 16).cast("int")

    def write(batch: DataFrame, batch_id: int) -> None:
        found = lookup.join(batch)
        found.select("event_id", "region").write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
        lookup.publish(nations.withColumn("region", F.concat(F.upper("region"), F.lit("!"))))

    fan_out(in_steps(rows, half, 2, scratch_dir(spark, "halves")), [write],
            scratch_dir(spark, "lookup-progress")).awaitTermination()
    return spark.read.parquet(out).select("event_id", "region")
