"""Lookup tables that change while streams read them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.spread import BROADCAST_BYTES, broadcast_if_fits
from ..storage import delete, names, read_json, write_json_new


class Lookup:
    """A small table in versions, each whole and never changed.

    A version is written to a folder of its own and then entered by number. ``rows`` reads
    the newest one that is entered, so what calls it for every micro-batch follows a change
    with the next batch, and a reader that has begun keeps the version it has. The last
    ``keep`` versions stay.
    """

    def __init__(self, path: str, key: str, keep: int = 3):
        self.path, self.key, self.keep = path.rstrip("/"), key, keep

    def versions(self, spark: SparkSession) -> list[int]:
        found = (n.removesuffix(".json") for n in names(spark, self.path) if n.endswith(".json"))
        return sorted(int(n) for n in found if n.isdigit())

    def publish(self, rows: DataFrame) -> int:
        """Put rows in the place of all that were there; the number of the new version. A key
        that is null or there twice is an error, and then nothing is changed."""
        spark = rows.sparkSession
        twice = rows.groupBy(F.col(self.key)).count().where(F.col(self.key).isNull() | (F.col("count") > 1))
        if not twice.isEmpty():
            raise ValueError(f"{self.key} is null or repeated")
        while True:
            known = self.versions(spark)
            number = known[-1] + 1 if known else 1
            folder = f"rows-{number}"
            if folder in names(spark, self.path):  # another writer's, or one that failed
                folder = f"{folder}-{len(names(spark, self.path))}"
            rows.write.mode("overwrite").parquet(f"{self.path}/{folder}")
            if write_json_new(spark, self.path, f"{number}.json", {"folder": folder}):
                break
        for old in self.versions(spark)[:-self.keep]:
            folder = self._folder(spark, old)
            delete(spark, f"{self.path}/{old}.json")
            delete(spark, f"{self.path}/{folder}")
        return number

    def _folder(self, spark: SparkSession, number: int) -> str:
        return read_json(spark, f"{self.path}/{number}.json")["folder"]

    def rows(self, spark: SparkSession) -> DataFrame:
        """The newest version."""
        known = self.versions(spark)
        if not known:
            raise ValueError(f"nothing published at {self.path}")
        return spark.read.parquet(f"{self.path}/{self._folder(spark, known[-1])}")

    def join(self, rows: DataFrame, on: str | None = None, limit: int = BROADCAST_BYTES) -> DataFrame:
        """Rows with the columns of their key, as far as it is known: a left join on ``on``
        (the key's name if None). Broadcast if measured to be within ``limit`` bytes; beyond,
        it shuffles. Columns that ``rows`` has already are left out."""
        on = on or self.key
        found = self.rows(rows.sparkSession)
        taken = {c.lower() for c in rows.columns}
        found = found.select(F.col(self.key).alias("_key"), *[
            c for c in found.columns if c != self.key and c.lower() not in taken])
        small, _ = broadcast_if_fits(found, limit)
        return rows.join(small, F.col(on) == F.col("_key"), "left").drop("_key")
