"""Joins that hold up when one key has a large share of the rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

DEFAULT_SALTS = 16
BROADCAST_BYTES = 64 * 1024 * 1024
_SALT = "_salt"


def spread_join(big: DataFrame, small: DataFrame, on: list[str], spread_by: list[str],
                salts: int = DEFAULT_SALTS, where: Column | None = None) -> DataFrame:
    """Inner equi-join with every key of ``big`` split over ``salts`` tasks.

    A row of ``big`` gets one salt from a hash of ``spread_by``; ``small`` gets a
    copy for every salt, so each pair meets exactly once and no row is lost. The
    salt depends on the row alone, so a task that is run again repeats it. ``where``
    is an additional condition, tested inside the join.
    """
    if salts > 1:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in spread_by]), F.lit(salts))
        # Never NULL, and known not to be: no null test is added to the input.
        big = big.withColumn(_SALT, F.coalesce(salt, F.lit(0)))
        numbers = F.sequence(F.lit(0).cast("bigint"), F.lit(salts - 1).cast("bigint"))
        small = small.withColumn(_SALT, F.explode(numbers))
        on = [*on, _SALT]
    joined = big.join(small, on)
    if where is not None:
        joined = joined.where(where)
    return joined.drop(_SALT)


def measured_bytes(rows: DataFrame) -> int:
    """Uncompressed size of a batch DataFrame, from one aggregate pass over it."""
    per_row = 16
    sizes = [F.coalesce(F.octet_length(F.col(f"`{name}`").cast("string")), F.lit(0)) + per_row
             for name in rows.columns]
    total = F.sum(reduce(lambda a, b: a + b, sizes).cast("bigint"))
    return rows.agg(F.coalesce(total, F.lit(0)).alias("n")).first()["n"]


def broadcast_if_fits(rows: DataFrame, limit: int = BROADCAST_BYTES) -> tuple[DataFrame, bool]:
    """``rows``, hinted for broadcast if measured to be within ``limit`` bytes."""
    fits = measured_bytes(rows) <= limit
    return (F.broadcast(rows) if fits else rows), fits
