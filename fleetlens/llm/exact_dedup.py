"""Exact duplicates by 128-bit content hash, with the bytes compared."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetlens.llm.common import BLANKS, saved, text_of


def one_space(text: Column) -> Column:
    return F.regexp_replace(text, BLANKS, " ")


def md5_128(text: Column) -> Column:
    return F.unhex(F.md5(text))


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 normalise: Callable[[Column], Column] = one_space,
                 digest: Callable[[Column], Column] = md5_128) -> DataFrame:
    """``id_col, keep_id, group_size, kept, text_sha256`` for every row.

    Rows are counted per digest, which combines in each task before it is shuffled. Only
    texts whose digest occurs again are compared as bytes: they are grouped by digest
    and text, so that two texts of one digest come apart. The result holds for any
    ``digest``; a poor one only costs time.

    Null texts are empty texts. Rows with a null id are never the one that stays while
    another row of the group has an id; in a group without any id, ``keep_id`` is null and
    one row stays. Of rows repeated with the smallest id, one stays. Other columns of
    ``docs`` are not read.
    """
    rows = docs.select(F.col(id_col).alias("id"),
                       normalise(text_of(text_col)).alias("body"))
    rows = rows.select("id", "body", digest(F.col("body")).alias("digest"))
    base = saved(rows.select("id", "digest", F.sha2("body", 256).alias("sha")), "digests")
    again = saved(base.groupBy("digest").count().where("count > 1").select("digest"), "repeated")
    members = saved(rows.join(again, "digest"), "members")
    classes = saved(members.groupBy("digest", "body").agg(F.min("id").alias("keep_id"),
                                                          F.count(F.lit(1)).alias("size")),
                    "classes")
    grouped = members.join(classes, ["digest", "body"]).select(
        "id", "digest", F.sha2("body", 256).alias("sha"), "keep_id", "size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("smallest"))
    # Several rows may carry the smallest id: number only these, never a whole group.
    tie = Window.partitionBy("digest", "sha", "keep_id").orderBy("id")
    first = (grouped.where("smallest").withColumn("turn", F.row_number().over(tie))
             .withColumn("kept", F.col("turn") == 1).drop("turn"))
    others = grouped.where("not smallest").withColumn("kept", F.lit(False))
    alone = base.join(again, "digest", "left_anti").select(
        "id", "digest", "sha", F.col("id").alias("keep_id"), F.lit(1).cast("bigint").alias("size"),
        F.lit(True).alias("smallest"), F.lit(True).alias("kept"))
    return alone.unionByName(first).unionByName(others).select(
        F.col("id").alias(id_col), "keep_id", F.col("size").alias("group_size"), "kept",
        F.col("sha").alias("text_sha256"))
