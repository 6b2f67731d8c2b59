"""Messages to store tables, and reading them back.

A table is a folder of Parquet files. Every write has a folder ``__part`` of its own,
with a folder for each UTC day ``__date`` (unless the spec says otherwise) below it;
the log of the table (``manifest``) says which of them count. Rows carry the name of
their load, ``__load``: entering a load again puts it in the place of an earlier
attempt, so a batch that is run again after a failure adds nothing twice.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import date, datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import (ArrayType, DateType, FloatType, LongType, StringType,
                               StructField, StructType, TimestampType)

from ..functions.observed import observed
from ..functions.records import sorted_values
from ..functions.time import as_utc, parse_time, utc_date
from ..sources.messages import decode, encode
from . import manifest
from .specs import Dimension, IngestSpec
from .views import refresh

_TYPES = {"string": StringType(), "long": LongType(), "float": FloatType()}


def _message_schema(spec: IngestSpec) -> StructType:
    """The fields a spec reads, all as text, nested along its paths."""
    tree: dict = {}
    own = {d.name for d in spec.dimensions} - set(spec.paths) - set(spec.derived)
    for name in sorted(own | set(spec.reads) | ({spec.time_column} - {None})):
        tree[name] = {}
    for path in spec.paths.values():
        level = tree
        for step in path.removeprefix("$.").split("."):
            level = level.setdefault(step, {})

    def build(level: dict) -> StructType:
        return StructType([StructField(name, build(below) if below else StringType())
                           for name, below in level.items()])

    return build(tree)


def _at(path: str) -> Column:
    first, *steps = path.removeprefix("$.").split(".")
    column = F.col(f"`{first}`")
    for step in steps:
        column = column.getField(step)
    return column


def _typed(dimension: Dimension) -> Column:
    text = F.col(f"`{dimension.name}`")
    if dimension.kind == "long":
        return F.coalesce(text.try_cast("bigint"),
                          text.try_cast("double").try_cast("bigint"))
    if dimension.kind == "float":
        return text.try_cast("float")
    if dimension.multi_value:
        many = F.when(text.startswith("["), F.from_json(text, "array<string>"))
        return sorted_values(F.coalesce(many, F.when(text.isNotNull(), F.array(text))))
    return text


def shape(messages: DataFrame, spec: IngestSpec, on_error: str = "drop") -> DataFrame:
    """``__time`` and the dimensions of a spec from a ``value`` column."""
    rows = decode(messages, _message_schema(spec), on_error)
    read = rows.select("*", *[_at(path).alias(name) for name, path in spec.paths.items()])
    read = read.select("*", *[make().alias(name) for name, make in spec.derived.items()])
    instant = (F.lit(None).cast("timestamp") if spec.time_column is None
               else parse_time(F.col(f"`{spec.time_column}`"), spec.time_form))
    if spec.missing_time is not None:
        instant = F.coalesce(instant, F.to_timestamp(F.lit(spec.missing_time)))
    kept = read.select(instant.alias("__time"),
                       *[_typed(d).alias(d.name) for d in spec.dimensions])
    return kept.where(F.col("__time").isNotNull())


def shape_counted(messages: DataFrame, spec: IngestSpec) -> tuple[DataFrame, Observation, Observation]:
    """``shape`` with counts of messages read and rows kept, filled when it runs."""
    seen, kept = Observation(f"{spec.name} read"), Observation(f"{spec.name} kept")
    rows = shape(messages.observe(seen, F.count("*").alias("n")), spec)
    return rows.observe(kept, F.count("*").alias("n")), seen, kept


def table_schema(spec: IngestSpec) -> StructType:
    fields = [StructField("__time", TimestampType())]
    for d in spec.dimensions:
        kind = _TYPES[d.kind]
        fields.append(StructField(d.name, ArrayType(kind) if d.multi_value else kind))
    fields += [StructField("__load", StringType()), StructField("__part", StringType())]
    if spec.partition_by_day:
        fields.append(StructField("__date", DateType()))
    return StructType(fields)


@dataclass(frozen=True)
class LoadReport:
    """What a load has read and kept; the rest were messages that could not be decoded,
    had no time, or were too early or too late."""

    load_id: str
    read: int
    kept: int
    days: tuple[date, ...] = ()

    @property
    def dropped(self) -> int:
        return self.read - self.kept


def load(messages: DataFrame, spec: IngestSpec, path: str, load_id: str,
         start: datetime | None = None, end: datetime | None = None,
         rebalance: bool = True) -> LoadReport:
    """Append a batch of messages to a table as the load ``load_id``.

    Loading the same id again replaces it. ``start`` and ``end`` (exclusive)
    optionally reject rows that are too early or too late; by default none are.
    ``rebalance`` shuffles rows by day before writing, for few files per day; without
    it every task writes a file for every day it meets, which is better when the
    input is in time order already.
    """
    seen, kept = Observation(), Observation()
    rows = shape(messages.observe(seen, F.count("*").alias("n")), spec)
    if start is not None:
        rows = rows.where(F.col("__time") >= F.lit(as_utc(start)))
    if end is not None:
        rows = rows.where(F.col("__time") < F.lit(as_utc(end)))
    part = write_part(rows.observe(kept, F.count("*").alias("n")).withColumn("__load", F.lit(load_id)),
                      spec, path, rebalance)
    entry = {"load": load_id, "folders": manifest.written(messages.sparkSession, path, part),
             "read": observed(seen, "n", 0), "kept": observed(kept, "n", 0)}
    enter(messages.sparkSession, path, lambda state: entry)
    days = sorted(day for _, day in map(manifest.key_of, entry["folders"]) if day)
    return LoadReport(load_id, entry["read"], entry["kept"], tuple(days))


def write_part(rows: DataFrame, spec: IngestSpec, path: str, rebalance: bool = True) -> str:
    """Write rows with their ``__load`` to a folder of their own, which is not entered yet.
    Nothing that is there is listed or touched."""
    days = []
    if spec.partition_by_day:
        rows, days = rows.withColumn("__date", utc_date("__time")), ["__date"]
        if rebalance:
            # A day too large for one task is split again.
            rows = rows.hint("rebalance", "__date")
    writer = (rows.write.mode("errorifexists").partitionBy(*days)
              .option("maxRecordsPerFile", spec.rows_per_file))
    for name in spec.indexed if spec.values_per_file else ():
        writer = (writer.option(f"parquet.bloom.filter.enabled#{name}", "true")
                  .option(f"parquet.bloom.filter.expected.ndv#{name}", spec.values_per_file))
    part = uuid.uuid4().hex
    writer.parquet(manifest.folder_path(path, (part, None)))
    return part


def enter(spark: SparkSession, path: str, make) -> tuple[manifest.State, manifest.State]:
    """``manifest.commit``, seen by the tables that are enabled."""
    before, after = manifest.commit(spark, path, make)
    refresh(spark, path, after)
    return before, after


def load_history(spark: SparkSession, path: str) -> list[LoadReport]:
    """The last loads of a table, oldest first: ``manifest.RECENT`` at most."""
    return [LoadReport(r["load"], r["read"], r["kept"]) for r in manifest.current(spark, path).recent]


def list_days(spark: SparkSession, path: str) -> list[date]:
    return manifest.current(spark, path).days()


def load_stream(messages: DataFrame, spec: IngestSpec, path: str, checkpoint: str,
                stream_id: str, trigger: dict | None = None,
                rebalance: bool = True) -> StreamingQuery:
    """Keep a table filled from a message stream.

    Every micro-batch is one load, so a batch that is repeated after a failure
    replaces itself; ``load_history`` tells what each has read and kept. There is no
    watermark: late and early rows are kept.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        load(batch, spec, path, f"{stream_id}-{batch_id}", rebalance=rebalance)

    return (messages.writeStream.foreachBatch(write)
            .option("checkpointLocation", checkpoint)
            .queryName(f"{spec.name}-{stream_id}")
            .trigger(**(trigger or {"availableNow": True})).start())


def reset_stream(messages: DataFrame, spec: IngestSpec, path: str, progress: str,
                 **settings) -> StreamingQuery:
    """``load_stream`` from the earliest message on, under a new identity with its
    own checkpoint below ``progress``. Rows already stored stay: delete them first
    (``delete_interval`` or ``delete_all``) to have each once."""
    stream_id = uuid.uuid4().hex
    return load_stream(messages, spec, path, f"{progress.rstrip('/')}/{stream_id}", stream_id,
                       **settings)


def read_table(spark: SparkSession, spec: IngestSpec, path: str,
               days: list[date] | None = None) -> DataFrame:
    """All rows: ``__time``, the dimensions and, where partitioned, ``__date``. With
    ``days``, only the folders of those days are listed and read. Loads that are entered
    later are not seen."""
    folders = manifest.current(spark, path).folders
    if days is not None:
        wanted = set(days)
        folders = {key: f for key, f in folders.items() if key[1] in wanted}
    return read_folders(spark, spec, path, folders).drop("__load", "__part")


def read_folders(spark: SparkSession, spec: IngestSpec, path: str,
                 folders: dict[manifest.Key, manifest.Folder]) -> DataFrame:
    """Rows of some folders that count, with their ``__load`` and ``__part``."""
    if not folders:
        return spark.createDataFrame([], table_schema(spec))
    rows = (spark.read.schema(table_schema(spec)).option("basePath", path)
            .parquet(*sorted(manifest.folder_path(path, key) for key in folders)))
    return counting(rows, folders)


def counting(rows: DataFrame, folders: dict[manifest.Key, manifest.Folder]) -> DataFrame:
    """Rows without those of loads that were made again after their folder was compacted."""
    gone = [(part, day, load) for (part, day), found in folders.items() for load in found.without]
    if not gone:
        return rows
    again = [(F.col("__part") == part) & (F.col("__load") == load)
             & (F.lit(True) if day is None else F.col("__date") == F.lit(day)) for part, day, load in gone]
    return rows.where(~reduce(Column.__or__, again))


def as_messages(rows: DataFrame, spec: IngestSpec) -> DataFrame:
    """Stored rows as JSON objects in ``value``, with or without their NULLs as the
    spec says."""
    return encode(rows, spec.keep_nulls)


def scan(spark: SparkSession, spec: IngestSpec, path: str, start: datetime,
         end: datetime) -> DataFrame:
    """Rows with ``start <= __time < end``; only folders of those days are listed.
    Datetimes without a zone are UTC."""
    start, end = as_utc(start), as_utc(end)
    days = None
    if spec.partition_by_day:
        last = (end - timedelta(microseconds=1)).date()
        days = [day for day in list_days(spark, path) if start.date() <= day <= last]
    rows = read_table(spark, spec, path, days)
    return rows.where((F.col("__time") >= F.lit(start)) & (F.col("__time") < F.lit(end)))
