"""Mixing sources to target weights by pivotal dependent rounding.

Every document has a number of copies ``target / source size`` in expectation. Its whole
part is taken; its fraction is rounded together with those of other documents of its
source. Two fractions meet, mass moves from one to the other in a random direction until
one of them is whole, and the other goes on. Mass is weighed by document size, so the
words of a source stay the same in every meeting, whichever way it goes. What is left of
a bucket is one fraction; those meet again in a tree of small buckets until a source has
one left.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetlens.llm.common import saved, text_of, unused, word_count

#: Fractions that meet in one bucket of the tree.
FAN_IN = 4096
_CUT = 1e-9


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (1, 2, 3),
                   limit: int = 3) -> DataFrame:
    """``source, source_size, target`` from ``source, size``.

    Sources in order of code points, null last, weigh ``weights`` in turn. They share the
    sum of all sizes by weight; a target stops at ``limit`` times its source's size, and
    what is above is shared anew by weight among the rest.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    # Rank without one task for all: ranges of sources are counted, then numbered within.
    ranged = saved(totals.repartitionByRange(F.col("source").isNull(), F.col("source"))
                   .withColumn("part", F.spark_partition_id()), "sources")
    counts = sorted((r["part"], r["count"]) for r in ranged.groupBy("part").count().collect())
    start, before = {}, 0
    for part, count in counts:
        start[part], before = before, before + count
    in_part = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    offset = F.element_at(F.create_map(*[F.lit(x) for kv in (start or {-1: 0}).items()
                                         for x in kv]), F.col("part"))
    rank = offset + F.row_number().over(in_part) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (rank % len(weights) + 1).cast("int"))
    ranked = saved(ranged.select("source", "source_size", weight.alias("weight")), "weights")
    cap = F.col("source_size").cast("double") * limit
    sums = ranked.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    total = sums["words"] or 0
    share, full = total / (sums["weight"] or 1), 0
    while True:  # a share for each unit of weight; it only grows as sources get full
        above = F.col("weight") * F.lit(share) > cap
        state = ranked.agg(F.count_if(above).alias("n"), F.sum(F.when(above, cap)).alias("caps"),
                           F.sum(F.when(~above, F.col("weight"))).alias("rest")).first()
        if state["n"] == full or not state["rest"]:
            break
        share, full = (total - state["caps"]) / state["rest"], state["n"]
    return ranked.select("source", "source_size",
                         F.least(F.col("weight") * F.lit(share), cap).alias("target"))


def _draw(key: str, seed: int, turn: int) -> Column:
    """A number of [0, 1) that depends on the key, not on where its row lies."""
    return F.pmod(F.xxhash64(key, F.lit(seed), F.lit(turn)), F.lit(1 << 40)) / float(1 << 40)


def _round_bucket(size: np.ndarray, part: np.ndarray, draw: np.ndarray) -> tuple[np.ndarray, int]:
    """Rounded fractions and the row whose fraction is left, or -1. ``draw`` has one
    number of [0, 1) for each row."""
    out, held = part.copy(), -1
    for i in range(len(out)):
        if held < 0:
            held = i
            continue
        a, b, p, q = size[held], size[i], out[held], out[i]
        up, down = min((1 - p) * a, q * b), min(p * a, (1 - q) * b)  # words to held, to i
        if draw[i] * (up + down) < down:
            p, q = p + up / a, q - up / b
        else:
            p, q = p - down / a, q + down / b
        out[held], out[i] = (round(x) if min(x, 1 - x) < _CUT else x for x in (p, q))
        whole = [x in (0, 1) for x in (out[held], out[i])]
        held = -1 if all(whole) else i if whole[0] else held
    return out, held


def pivotal_round(fractions: DataFrame, fan_in: int = FAN_IN, seed: int = 0) -> DataFrame:
    """``key, extra`` (0 or 1) from ``key, source, size, part`` with size > 0 and
    0 < part < 1. ``key`` is unique; the same rows give the same result."""
    schema = "key string, source string, size bigint, part double, live boolean"

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        # Large documents meet first, so that small ones are left.
        pdf = pdf.sort_values(["size", "key"], ascending=[False, True], ignore_index=True)
        out, held = _round_bucket(pdf["size"].to_numpy(np.float64), pdf["part"].to_numpy(),
                                  pdf["draw"].to_numpy())
        live = np.zeros(len(pdf), bool)
        if held >= 0:
            live[held] = True
        return pdf.assign(part=out, live=live)[["key", "source", "size", "part", "live"]]

    live, done, level = fractions, [], 0
    while True:
        level += 1
        counts = saved(live.groupBy(F.col("source").alias("of")).agg(F.count(F.lit(1)).alias("n")),
                       "fractions")
        most = counts.agg(F.max("n")).first()[0] or 0
        dealt = live.join(counts, F.col("source").eqNullSafe(F.col("of"))).select(
            "key", "source", "size", "part",
            F.pmod(F.xxhash64("key", F.lit(seed), F.lit(level)),
                   F.ceil(F.col("n") / fan_in)).alias("bucket"),
            _draw("key", seed, -level).alias("draw"))
        settled = saved(dealt.groupBy("source", "bucket").applyInPandas(settle, schema), "settled")
        done.append(settled.where("not live"))
        live = settled.where("live").drop("live")
        if most <= fan_in:
            break
    # One fraction is left per source: to the nearer side, so that words stay near the target.
    last = live.select("key", (F.col("part") >= 0.5).cast("int").alias("extra"))
    return reduce(DataFrame.unionByName,
                  [d.select("key", F.col("part").cast("int").alias("extra")) for d in done], last)


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), limit: int = 3, seed: int = 0,
        id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Copies of every document that bring its source to its target.

    Returns ``id, digest, source, n_rows, size, source_size, target, copies`` with one row
    for each distinct id, text and source; ``digest`` is ``xxhash64(text)`` and ``n_rows``
    counts the equal rows, each of which is taken ``copies`` times. ``copies`` is at most
    ``limit``. A source's words differ from its target by half a document at most, apart
    from documents whose equal rows move together. Null texts have size 0; documents of
    size 0 get no copy, as they add no words. A null source is a source. The same rows
    give the same copies, however they are partitioned. Other columns are not read.
    """
    rows = saved(docs.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("digest"),
                             F.col(source_col).alias("source"), word_count(text_col).alias("size"))
                 .groupBy("id", "digest", "source", "size")
                 .agg(F.count(F.lit(1)).alias("n_rows")), "sizes")
    targets = saved(source_targets(
        rows.select("source", (F.col("size") * F.col("n_rows")).alias("size")), weights, limit)
        .withColumnRenamed("source", "of"), "targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    near = F.when(F.abs(ratio - F.round(ratio)) < _CUT, F.round(ratio)).otherwise(ratio)
    planned = rows.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of").select(
        "*", F.concat_ws(":", "id", "digest", F.coalesce("source", F.lit("\0"))).alias("key"),
        F.floor(near).cast("int").alias("whole"), (near - F.floor(near)).alias("part"))
    planned = saved(planned, "planned")
    open_ = planned.where("size > 0 and part > 0")
    extra = pivotal_round(open_.select("key", "source", (F.col("size") * F.col("n_rows")).alias("size"),
                                       "part"), seed=seed)
    return planned.join(extra, "key", "left").select(
        "id", "digest", "source", "n_rows", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.col("whole") + F.coalesce("extra", F.lit(0))).otherwise(0)
        .alias("copies"))


def mixed_documents(docs: DataFrame, **settings) -> DataFrame:
    """The documents of the mix, each repeated as often as it is taken."""
    names = unused(docs, "own_id", "key", "of", "times", "turn")
    own_id, key, of, times, turn = names
    copies = mix(docs, **settings).where("copies > 0").select(
        F.col("id").alias(own_id), F.col("digest").alias(key), F.col("source").alias(of),
        F.col("copies").alias(times))
    at = lambda name, default: docs[settings.get(name, default)]
    joined = docs.join(saved(copies, "copies"), at("id_col", "doc_id").eqNullSafe(F.col(own_id))
                       & (F.xxhash64(text_of(at("text_col", "text"))) == F.col(key))
                       & at("source_col", "source").eqNullSafe(F.col(of)))
    return joined.withColumn(turn, F.explode(F.sequence(F.lit(1), times))).select(*docs.columns)
