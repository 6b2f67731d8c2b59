"""Dashboard queries on the store tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.messages import encode


def device_map(devices: DataFrame) -> DataFrame:
    """Where the devices are."""
    return devices.select("deviceId", "latitude", "longitude")


def rejected_over_time(events: DataFrame, bucket: str = "1 minute",
                       status: str = "accessRejected",
                       area: tuple[str, ...] = ("deviceLatitude", "deviceLongitude")) -> DataFrame:
    """Events of one status per time bucket and area, with the number of all events.

    Buckets without a single event have no row; those where nothing was rejected
    have a count of 0.
    """
    rejected = F.col("eventNotificationName") == status
    return (events.groupBy(F.window("__time", bucket).alias("_w"), *area)
            .agg(F.count_if(rejected).alias("rejected"), F.count("*").alias("total"))
            .select(F.col("_w.start").alias("bucket_start"), *area, "rejected", "total"))


def alerts_on_map(alerts: DataFrame) -> DataFrame:
    """Alerts with their position; take ``scan`` for a time range."""
    return alerts.select("__time", "deviceId", "deviceLatitude", "deviceLongitude",
                         "total_count_per_deviceid", "avg_error_count", "std_error_count")


def query_messages(spark: SparkSession, text: str) -> DataFrame:
    """Rows of a SQL query on the registered tables, as JSON objects in ``value``."""
    return encode(spark.sql(text))


def save_result(rows: DataFrame, table: str, path: str | None = None) -> None:
    """Keep a whole query result as a table, at ``path`` if given."""
    writer = rows.write.mode("errorifexists")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
