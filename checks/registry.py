"""A query is registered together with the SQL that has to give the same rows."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        @functools.wraps(run)
        def in_utc(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return run(spark, sf_dir)

        QUERIES[run.__name__] = in_utc
        if sql is not None:
            ORACLES[run.__name__] = sql
        return in_utc

    return add
