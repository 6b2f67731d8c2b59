"""Late rows as a stream of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from ..functions.observed import observed
from ..functions.time import duration_micros
from ..storage import delete, names, read_json, write_json_new


class Lateness:
    """Which rows come too late for every window they are in.

    The watermark of a batch lies ``delay`` behind the newest time of all batches before it;
    a row is late if the last window that holds its time has ended by then. What has been
    seen is written down per batch, so a batch that is run again is judged alike. Rows
    without a time are not late, and do not move the watermark.
    """

    def __init__(self, path: str, size: str = "1 minute", slide: str = "30 seconds", delay: str = "5 seconds"):
        self.path = path.rstrip("/")
        self.size, self.slide, self.delay = map(duration_micros, (size, slide, delay))

    def newest(self, spark: SparkSession, batch_id: int) -> int | None:
        """Newest time up to a batch, in microseconds."""
        found = read_json(spark, f"{self.path}/{batch_id}.json") if batch_id >= 0 else None
        return found and found["newest"]

    def late(self, spark: SparkSession, time: Column, batch_id: int) -> Column:
        """Whether a row of a batch is late; never NULL."""
        newest = self.newest(spark, batch_id - 1)
        if newest is None:
            return F.lit(False)
        micros = F.unix_micros(time)
        last_end = micros - F.pmod(micros, F.lit(self.slide)) + F.lit(self.size)
        return F.coalesce(last_end <= F.lit(newest - self.delay), F.lit(False))

    def observe(self, rows: DataFrame, time: Column) -> tuple[DataFrame, Observation]:
        seen = Observation()
        return rows.observe(seen, F.max(F.unix_micros(time)).alias("newest")), seen

    def note(self, spark: SparkSession, batch_id: int, seen: Observation) -> None:
        """Write down what a batch has seen, once its rows are where they belong."""
        known = [n for n in (self.newest(spark, batch_id - 1), observed(seen, "newest")) if n is not None]
        write_json_new(spark, self.path, f"{batch_id}.json", {"newest": max(known, default=None)})
        for name in names(spark, self.path):
            number = name.removesuffix(".json")
            if number.isdigit() and int(number) < batch_id - 1:
                delete(spark, f"{self.path}/{name}")
