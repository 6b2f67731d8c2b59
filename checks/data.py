"""Device-event inputs derived from the given tables.

``customer`` is the device dimension and ``events`` the event stream, joined on
``user_id = c_custkey``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from fleetlens import schemas
from fleetlens.functions import device_record, event_record
from fleetlens.operators import locate
from fleetlens.sources import decode, to_messages


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a file stream."""
    return (spark.readStream.schema(table(spark, sf_dir, name).schema)
            .option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir))


def in_steps(rows: DataFrame, step: Column, steps: int, path: str) -> DataFrame:
    """Rows as a stream of one micro-batch for each ``step`` from 0 on."""
    for n in range(steps):
        rows.where(step == n).coalesce(1).write.mode("append").parquet(path)
    return (rows.sparkSession.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
            .parquet(path))


def location() -> Column:
    """``lat,lon`` text of a customer, near the disruption centre."""

    def digits(base: int, factor: int, span: int) -> Column:
        return F.lpad((base + F.col("c_custkey") * factor % span).cast("string"), 6, "0")

    return F.concat(F.lit("47."), digits(370000, 37, 9000), F.lit(",8."),
                    digits(510000, 53, 20000))


def device_messages(customers: DataFrame) -> DataFrame:
    rows = customers.select(
        F.col("c_custkey").cast("string").alias("id"), location().alias("loc"),
        F.col("c_mktsegment").alias("city"), F.col("c_nationkey").cast("string").alias("region"))
    record = device_record("id", "loc", "city", "region", F.lit("CH"), F.lit("Europe/Zurich"))
    return to_messages(rows, record)


def event_messages(events: DataFrame) -> DataFrame:
    record = event_record(F.col("user_id").cast("string"), "event_type",
                          F.col("ts").cast("timestamp"))
    return to_messages(events, record)


def devices(customers: DataFrame) -> DataFrame:
    return decode(device_messages(customers), schemas.DEVICES, "fail")


def events(rows: DataFrame) -> DataFrame:
    return decode(event_messages(rows), schemas.EVENTS, "fail")


def positions(customers: DataFrame) -> DataFrame:
    """``id, lat, lon`` (DOUBLE) of every customer."""
    rows = customers.select(F.col("c_custkey").alias("id"), location().alias("loc"))
    return locate(rows, "loc").drop("loc")


def land(suppliers: DataFrame) -> DataFrame:
    """A land-use outline with five vertices for every supplier; the fifth is a dent
    that makes it concave."""
    key = F.col("s_suppkey")
    south = F.lit(47.37) + (key * 41 % 9000) / F.lit(1e6)
    west = F.lit(8.51) + (key * 59 % 20000) / F.lit(1e6)
    ring = [(0.0, 0.0), (0.0, 0.0021), (0.0013, 0.0023), (0.0004, 0.0011), (0.0012, 0.0002)]
    vertices = F.array(*[
        F.struct(F.lit(i).alias("vertex_no"), (south + F.lit(dy)).alias("lat"),
                 (west + F.lit(dx)).alias("lon")) for i, (dy, dx) in enumerate(ring)])
    use = F.element_at(F.array(*[F.lit(u) for u in ("commercial", "forest", "industrial",
                                                    "residential")]),
                       (F.col("s_nationkey") % 4 + 1).cast("int"))
    return (suppliers.select(key.alias("polygon_id"), use.alias("landuse"),
                             F.explode(vertices).alias("v"))
            .select("polygon_id", "landuse", "v.*"))


def land_with_holes(suppliers: DataFrame) -> DataFrame:
    """``land``, with a small four-sided hole for every third supplier. Holes of every ninth
    lie outside, some outlines cross themselves and some repeat a vertex."""
    key = F.col("s_suppkey")
    vertices = land(suppliers).withColumn("ring_no", F.lit(0))
    south = F.lit(47.37) + (key * 41 % 9000) / F.lit(1e6)
    west = F.lit(8.51) + (key * 59 % 20000) / F.lit(1e6)
    shift = F.when(key % 9 == 0, F.lit(0.01)).otherwise(F.lit(0.0))
    ring = [(0.0001, 0.0006), (0.0001, 0.0009), (0.0002, 0.0009), (0.0003, 0.0007)]
    corners = F.array(*[
        F.struct(F.lit(i).alias("vertex_no"), (south + F.lit(dy)).alias("lat"),
                 (west + F.lit(dx) + shift).alias("lon")) for i, (dy, dx) in enumerate(ring)])
    holes = (suppliers.where(key % 3 == 0)
             .select(key.alias("polygon_id"), F.lit("hole").alias("landuse"), F.explode(corners).alias("v"))
             .select("polygon_id", "landuse", "v.*", F.lit(1).alias("ring_no")))
    number = F.when((F.col("polygon_id") % 7 == 0) & F.col("vertex_no").isin(1, 2), 3 - F.col("vertex_no"))
    outer = vertices.withColumn("vertex_no", F.coalesce(number, "vertex_no"))
    again = outer.where((F.col("polygon_id") % 11 == 0) & (F.col("vertex_no") == 4)).withColumn(
        "vertex_no", F.lit(5))
    return outer.unionByName(again).unionByName(holes)


def city(customers: DataFrame) -> DataFrame:
    """An eight-sided outline around the middle half of all positions."""
    box = positions(customers).agg(F.min("lat").alias("s"), F.max("lat").alias("n"),
                                   F.min("lon").alias("w"), F.max("lon").alias("e"))
    ring = [(0.25, 0.4), (0.25, 0.6), (0.4, 0.75), (0.6, 0.75), (0.75, 0.6), (0.75, 0.4),
            (0.6, 0.25), (0.4, 0.25)]
    vertices = F.array(*[
        F.struct(F.lit(i).alias("vertex_no"),
                 (F.col("s") + (F.col("n") - F.col("s")) * F.lit(dy)).alias("lat"),
                 (F.col("w") + (F.col("e") - F.col("w")) * F.lit(dx)).alias("lon"))
        for i, (dy, dx) in enumerate(ring)])
    return (box.select(F.lit(0).cast("bigint").alias("polygon_id"), F.lit("city").alias("landuse"),
                       F.explode(vertices).alias("v"))
            .select("polygon_id", "landuse", "v.*"))
