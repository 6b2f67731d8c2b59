"""A corpus made ready for training: each stage takes ``(spark, docs, sf_dir)``, is written
as Parquet, and is read again as the next one's documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens.llm import line_dedup, mixing, near_dedup, packing, toxicity
from fleetlens.llm.common import saved
from fleetlens.llm.queries import TOKENIZER
from fleetlens.llm.tokens import encoder


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose probability of being toxic is below one half."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.toxicity(model) < 0.5)


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that repeat an earlier one."""
    return line_dedup.without_repeated_lines(docs)


def no_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: five words, a similarity of 0.8."""
    return near_dedup.without_near_duplicates(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed_documents(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the packed sequences, with their token ids."""
    return packing.pack(docs, lambda: encoder(TOKENIZER).encode)


STAGES = [("toxicity", not_toxic), ("line_dedup", new_lines), ("minhash_near_dedup", no_near_copies),
          ("source_mixing", mixed), ("packing", packed)]

#: Trained dictionaries, signatures and a tokenizer: not in SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
