"""Token counts from a digest cache.

A count is stored under the digest of the text and the digest of the tokenizer's file.
Counting joins the digests of the documents to what is stored, encodes each text that is
not there once, and appends the new counts. Byte-level BPE distinguishes every byte, so
the only normalisation that leaves counts right is null to the empty text.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens.llm.common import saved, text_of
from fleetlens.llm.tokens import encoder, tokenizer_version
from fleetlens.session import scratch_dir

STORED = "digest binary, tokenizer string, n_tokens bigint"


def stored_counts(spark: SparkSession, cache: str | None, version: str) -> DataFrame:
    """``digest, n_tokens`` of one tokenizer version; empty where nothing is stored yet."""
    empty = spark.createDataFrame([], STORED)
    if cache is None:
        return empty.select("digest", "n_tokens")
    path = spark._jvm.org.apache.hadoop.fs.Path(cache)
    there = path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)
    rows = spark.read.schema(STORED).parquet(cache) if there else empty
    # A load that was repeated after a failure may have stored a count twice.
    return rows.where(F.col("tokenizer") == version).groupBy("digest").agg(
        F.min("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", cache: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, n_bytes, n_tokens`` of every row; null texts count as empty.

    ``cache`` is a shared folder; without one, a new folder below ``spark.checkpoint.dir``
    is used. Texts repeated under many ids are encoded once. Rows with null or repeated ids
    are counted like others. Other columns are not read. The tokenizer runs without added,
    begin or end tokens; its special strings inside a text are what its library makes of
    them; nothing is cut off or padded.
    """
    spark = docs.sparkSession
    version = tokenizer_version(tokenizer)
    cache = cache or scratch_dir(spark, "token-cache")
    rows = docs.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    rows = rows.withColumn("digest", F.unhex(F.md5("text")))
    keys = saved(rows.select("id", "digest", F.octet_length("text").cast("bigint").alias("n_bytes")),
                 "digests")
    known = stored_counts(spark, cache, version)
    # One row stands for a text: its smallest id says where the text is fetched.
    misses = (keys.groupBy("digest").agg(F.min("id").alias("at"))
              .join(known, "digest", "left_anti"))
    texts = _fetch(rows, saved(misses, "misses"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = encoder(tokenizer).ids
        for batch in batches:
            n = [len(ids(text)) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array([version] * len(n), pa.string()),
                 pa.array(n, pa.int64())], ["digest", "tokenizer", "n_tokens"])

    texts.mapInArrow(count, STORED).write.mode("append").parquet(cache)
    known = saved(stored_counts(spark, cache, version), "counts")
    return keys.join(known, "digest").select(F.col("id").alias(id_col), "n_bytes", "n_tokens")


def _fetch(rows: DataFrame, misses: DataFrame) -> DataFrame:
    """``digest, text`` of the misses. Ids are spread, digests of copies are not: the text is
    looked for by id. An id repeated with its text is encoded as often, and stored alike."""
    wanted = misses.select(F.col("digest").alias("wanted"), "at")
    return rows.join(wanted, rows["id"].eqNullSafe(wanted["at"])
                     & (rows["digest"] == wanted["wanted"])).select("digest", "text")
