"""One row per key, and the keys themselves."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def latest_per_key(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The row with the greatest ``order`` values for every key.

    An aggregate, not a window: a hot key is reduced to one row per task before
    anything is shuffled. ``order`` has to be unique within a key for the result
    to be determined.
    """
    names = [c for c in rows.columns if c != key]
    best = F.max_by(F.struct(*[F.col(f"`{c}`") for c in names]),
                    F.struct(*[F.col(f"`{c}`") for c in order]))
    return (rows.groupBy(key).agg(best.alias("_best"))
            .select(key, *[F.col("_best").getField(c).alias(c) for c in names]))


def distinct_keys(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(key).distinct()
