"""File readers and writers. Schemas are given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_json_array(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Rows from files that each hold one JSON array of objects.

    Such a file cannot be split: one task reads one file. Keep big data in
    newline-delimited files.
    """
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """CSV with a header line; a quoted ``"a,b"`` is one field."""
    return spark.read.schema(schema).option("header", True).csv(path)


def write_csv(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    rows.write.mode(mode).option("header", True).csv(path)


def write_json(rows: DataFrame, path: str, keep_nulls: bool = True,
               mode: str = "errorifexists") -> None:
    """Newline-delimited JSON."""
    rows.write.mode(mode).option("ignoreNullFields", not keep_nulls).json(path)
