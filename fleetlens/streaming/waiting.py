"""Events that come before their device."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.enrich import NOTICE, OUTPUT
from ..storage import delete, names

_SCHEMA = (", ".join(f"{c} {'TIMESTAMP' if c == 'timestamp' else 'STRING'}" for c in OUTPUT)
           + ", waited INT, placed STRING")


class WaitingEvents:
    """What each micro-batch has placed and what it left over, in a folder of its own.

    A batch is joined once, and its result is written before anything is made of it: a
    batch that is run again takes what is there, so an event is placed or waits, never
    both and never neither, however the devices have changed meanwhile. An event is placed
    with all rows its device has at that moment. It waits for ``patience`` further batches;
    None is for ever. Every batch writes those still waiting anew, so let them give up
    where devices may never come.
    """

    def __init__(self, path: str, patience: int | None = None):
        self.path, self.patience = path.rstrip("/"), patience

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/batch-{batch_id}"

    def _done(self, spark: SparkSession, batch_id: int) -> bool:
        return "_SUCCESS" in names(spark, self._folder(batch_id))

    def after(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Events of a batch with ``placed`` (``yes``, ``waits`` or ``never``)."""
        if not self._done(spark, batch_id):
            return spark.createDataFrame([], _SCHEMA)
        return spark.read.schema(_SCHEMA).parquet(self._folder(batch_id))

    def place(self, notices: DataFrame, places: DataFrame, batch_id: int) -> DataFrame:
        """Join the events of a batch, and those that the batch before left over, with the
        devices there are; ``after`` of the batch."""
        spark = notices.sparkSession
        if not self._done(spark, batch_id):
            left = self.after(spark, batch_id - 1).where("placed = 'waits'")
            rows = (notices.select(*NOTICE, F.lit(0).alias("waited"))
                    .unionByName(left.select(*NOTICE, (F.col("waited") + 1).alias("waited"))))
            over = F.lit(False) if self.patience is None else F.col("waited") >= self.patience
            placed = F.when(F.col("_known"), "yes").when(over, "never").otherwise("waits")
            joined = rows.join(places.withColumn("_known", F.lit(True)), "deviceId", "left")
            (joined.select(*OUTPUT, "waited", placed.alias("placed"))
             .write.mode("overwrite").partitionBy("placed").parquet(self._folder(batch_id)))
        return self.after(spark, batch_id)

    def forget(self, spark: SparkSession, batch_id: int) -> None:
        """Delete what no batch from ``batch_id`` on needs."""
        for name in names(spark, self.path):
            number = name.removeprefix("batch-")
            if number.isdigit() and int(number) < batch_id - 1:
                delete(spark, f"{self.path}/{name}")
