"""Append-only message streams with one ``value STRING`` column.

Both kinds replay from the earliest message. How far a reader got lives in the
checkpoint of its query: one checkpoint per query.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import DataStreamWriter

from ..storage import move_new

#: What one micro-batch reads at most, so that a backlog is worked off in steps.
FILES_PER_TRIGGER, OFFSETS_PER_TRIGGER = 1_000, 50_000_000


@dataclass(frozen=True)
class KafkaTopic:
    """A Kafka topic; needs the spark-sql-kafka package on the cluster.

    ``options`` are passed to the reader as they are; without ``maxOffsetsPerTrigger``
    among them, a micro-batch has ``OFFSETS_PER_TRIGGER`` messages at most.
    Writing is at-least-once.
    """

    name: str
    servers: str
    starting: str = "earliest"
    group_id: str | None = None
    options: dict[str, str] = field(default_factory=dict)

    def reader_options(self) -> dict[str, str]:
        found = {"kafka.bootstrap.servers": self.servers, "subscribe": self.name,
                 "startingOffsets": self.starting, **self.options}
        if self.group_id:
            found["kafka.group.id"] = self.group_id
        return found

    def writer_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, "topic": self.name}

    def stream(self, spark: SparkSession) -> DataFrame:
        limited = {"maxOffsetsPerTrigger": str(OFFSETS_PER_TRIGGER), **self.reader_options()}
        reader = spark.readStream.format("kafka").options(**limited)
        return reader.load().selectExpr("CAST(value AS STRING) AS value")

    def table(self, spark: SparkSession) -> DataFrame:
        reader = spark.read.format("kafka").options(**self.reader_options())
        return reader.load().selectExpr("CAST(value AS STRING) AS value")

    def publish(self, messages: DataFrame, batch: str | None = None) -> None:
        """``batch`` is not used: a batch that is published again is there twice."""
        messages.write.format("kafka").options(**self.writer_options()).save()

    def publish_stream(self, messages: DataFrame) -> DataStreamWriter:
        return (messages.writeStream.format("kafka").outputMode("append")
                .options(**self.writer_options()))


@dataclass(frozen=True)
class FileTopic:
    """A folder of text files, one message per line; also those of folders in it.

    Written by ``publish`` or by ``publish_stream``, not both: a folder that a
    stream has written lists its committed files in a log, and readers go by
    that log. Writing from a stream is exactly-once.
    """

    path: str
    max_files_per_trigger: int = FILES_PER_TRIGGER

    def stream(self, spark: SparkSession) -> DataFrame:
        return (spark.readStream.format("text").schema("value STRING")
                .option("maxFilesPerTrigger", self.max_files_per_trigger)
                .option("recursiveFileLookup", "true").load(self.path))

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema("value STRING").option("recursiveFileLookup", "true").text(self.path)

    def publish(self, messages: DataFrame, batch: str | None = None) -> None:
        """Add messages. Those of a named ``batch`` appear all at once, in a folder of that
        name, and only the first time: a batch that is run again adds nothing."""
        rows = messages.select("value")
        if batch is None:
            rows.write.mode("append").text(self.path)
            return
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9.-]*", batch):
            raise ValueError(f"not a name for a batch: {batch!r}")
        root = self.path.rstrip("/")
        draft = f"{root}/_{uuid.uuid4().hex}"
        rows.write.text(draft)
        move_new(messages.sparkSession, draft, f"{root}/{batch}")

    def publish_stream(self, messages: DataFrame) -> DataStreamWriter:
        return (messages.select("value").writeStream.format("text").outputMode("append")
                .option("path", self.path))
