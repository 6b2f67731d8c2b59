"""Connected components by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import saved


def _done(stars: DataFrame) -> bool:
    """Whether every child hangs on one parent that is no child itself."""
    ends = (stars.select(F.col("child").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
            .unionByName(stars.select(F.col("parent").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))))
    return (ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
            .agg(F.count_if(F.expr("up > 1 or (up > 0 and down > 0)")).alias("n")).first().n == 0)


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node, component`` (the smallest node it reaches) for every end of a link.

    In turns, every node hangs its larger neighbours (large star), then its smaller ones
    (small star), on its smallest neighbour, until each node hangs on the least of its
    component. Minima combine in each task; a node with very many neighbours meets them in
    a join that adaptive execution splits. Each turn is written to the shared folder. Links
    with a null end and links from a node to itself are left out; repeated ones count once.
    """
    stars = saved(links.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
                  .select(F.greatest(a, b).alias("child"), F.least(a, b).alias("parent"))
                  .distinct(), "links")
    while not _done(stars):
        both = stars.unionByName(stars.select(F.col("parent").alias("child"),
                                              F.col("child").alias("parent")))
        least = saved(both.groupBy("child").agg(F.min("parent").alias("m"))
                      .select(F.col("child").alias("node"), F.least("child", "m").alias("least")),
                      "least")
        large = saved(both.join(least, F.col("child") == F.col("node")).where("parent > child")
                      .select(F.col("parent").alias("child"), F.col("least").alias("parent"))
                      .distinct(), "large-star")
        small = large.groupBy("child").agg(F.min("parent").alias("least"))
        hung = large.join(saved(small.withColumnRenamed("child", "node"), "small"),
                          F.col("child") == F.col("node"))
        stars = saved(hung.where("parent != least")
                      .select(F.col("parent").alias("child"), F.col("least").alias("parent"))
                      .unionByName(large.groupBy("child").agg(F.min("parent").alias("parent")))
                      .distinct(), "stars")
    roots = stars.select(F.col("parent").alias("node")).distinct()
    return saved(stars.select(F.col("child").alias("node"), F.col("parent").alias("component"))
                 .unionByName(roots.select("node", F.col("node").alias("component"))), "components")
