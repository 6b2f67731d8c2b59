"""Comparing the members of buckets without expanding buckets into pairs."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F

from fleetlens.llm.common import saved

#: Times more leaders in each round.
FAN = 4
#: Members left in a bucket that are compared with each other, not with further leaders.
SMALL = 4096


def leader_rounds(pairs: DataFrame, compare: Callable[[DataFrame], DataFrame],
                  left: list[DataFrame] | None = None, after: int = 1) -> DataFrame:
    """All comparisons made, as ``compare`` returns them.

    ``pairs`` has ``bucket, a, b``: members and their bucket's first leader. ``compare`` takes
    distinct ``a, b`` and returns them with ``hit``, whether a need not be compared further in
    this bucket. Members without a hit meet 4 leaders of their own in the next round, then 16,
    and so on, until each has had a hit or has led; so the rounds grow with the logarithm of
    a bucket. Leaders are the smallest members, found without gathering a bucket in one task.

    Members that are like none of many leaders make pairs with the square of their number. If
    ``left`` is a list, members of buckets that still have ``SMALL`` or fewer of them after that
    many rounds are put there (``bucket, member``): the caller has to compare all of a bucket
    with each other. Larger buckets go on here.
    """
    pairs = saved(pairs.select("bucket", "a", "b"), "pairs")
    found: list[DataFrame] = []
    led, leaders, rounds = None, 1, 0
    while True:
        checked = saved(compare(pairs.select("a", "b").distinct()), "compared")
        found.append(checked)
        hits = checked.where("hit").select("a", "b", F.lit(True).alias("_hit")).distinct()
        alone = (pairs.join(hits, ["a", "b"], "left").groupBy("bucket", "a")
                 .agg(F.max("_hit").alias("_hit")).where("_hit is null")
                 .select("bucket", F.col("a").alias("member")))
        if led is not None:  # a leader has met all others of its bucket
            alone = alone.join(led, (F.col("bucket") == F.col("of")) & (F.col("member") == F.col("b")),
                               "left_anti")
        rest = saved(alone, "rest")
        leaders, rounds = leaders * FAN, rounds + 1
        if left is not None and rounds == after:
            sized = saved(rest.join(rest.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")), "bucket"), "sized")
            left.append(sized.where(F.col("n").between(2, SMALL)).select("bucket", "member"))
            rest = sized.where(F.col("n") > SMALL).select("bucket", "member")
        rank = F.row_number().over(Window.partitionBy("bucket").orderBy("member"))
        led = saved(rest.withColumn("rank", rank).where(F.col("rank") <= leaders)
                    .select(F.col("bucket").alias("of"), F.col("member").alias("b")), "leaders")
        pairs = saved(rest.join(led, (F.col("bucket") == F.col("of")) & (F.col("member") > F.col("b")))
                      .select("bucket", F.col("member").alias("a"), "b"), "pairs")
        if pairs.isEmpty():
            return reduce(DataFrame.unionByName, found)
