"""Near duplicates by circulant MinHash, banding and exact Jaccard verification.

Documents with the same shingle set are one class, and only its representative goes on.
Representatives that share a band of signature coordinates form a bucket. Buckets are not
expanded into pairs: every member is compared with the bucket's leader on the full sets.
Members that are not even related to it are compared with each other in blocks, or, while
there are many, with further leaders.
What remains are related documents of one family that are linked to different leaders, or
to none; those are compared in blocks, each pair of blocks in one task, and only across
components. So are documents near a leader with those of its family that left the bucket
before they could meet.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetlens.llm.common import saved, text_of, unused
from fleetlens.llm.components import components
from fleetlens.llm.leaders import leader_rounds
from fleetlens.llm.shingles import Shingler, blocks, circulant_signatures, mix64

#: Coordinates of a signature are cut into bands of ROWS: at a similarity of 0.8 a pair
#: has no band in common once in 10,000 pairs, at 0.85 once in four million.
BANDS, ROWS = 32, 6
#: Similarity in percent from which two documents are of one family.
RELATED = 50
#: Members in a block of a family, and share of a family's blocks in one task.
BLOCK = 256


def _described(docs: DataFrame, size: int, bands: int, rows: int) -> DataFrame:
    """``id, text_key, n, set_key, bands`` of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            for begin, end in blocks(texts):
                value, bounds = shingler.sets(texts[begin:end])
                n = np.diff(bounds)
                none = np.zeros(1, np.uint64)
                sums = [np.concatenate((none, np.cumsum(mix64(value ^ np.uint64(seed)))))
                        for seed in (0x2545F4914F6CDD1D, 0x27D4EB2F165667C5)]
                keys = np.column_stack([s[bounds[1:]] - s[bounds[:-1]] for s in sums])
                signature = circulant_signatures(value, bounds, bands * rows).astype(np.uint64)
                band = np.full((end - begin, bands), 0, np.uint64)
                for r in range(rows):
                    band = mix64(band * np.uint64(0x9E3779B97F4A7C15) + signature[:, r::rows])
                band = mix64(band + np.arange(bands, dtype=np.uint64)).view(np.int64)
                part = batch.slice(begin, end - begin)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, band.size + 1, bands, dtype=np.int32)),
                    pa.array(band.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), pa.array(n, pa.int64()),
                     pa.array([k.tobytes() for k in keys], pa.binary()), lists],
                    ["id", "text_key", "n", "set_key", "bands"])

    return docs.select("id", "text", "text_key").mapInArrow(
        run, "id bigint, text_key bigint, n bigint, set_key binary, bands array<bigint>")


def _full_sets(docs: DataFrame, size: int) -> DataFrame:
    """``id, hashes`` (sorted 64-bit integers, little-endian) of the rows given."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(size)
        for batch in batches:
            texts = [t.encode() for t in batch.column(1).to_pylist()]
            for begin, end in blocks(texts):
                value, bounds = shingler.sets(texts[begin:end])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(begin, end - begin),
                     pa.array([value[a:b].tobytes() for a, b in zip(bounds, bounds[1:])], pa.binary())],
                    ["id", "hashes"])

    return docs.select("id", "text").mapInArrow(run, "id bigint, hashes binary")


def _shared(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b, shared, together`` (sizes of intersection and union) of pairs ``a, b``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (batch.column(n).to_pylist() for n in ("x", "y"))
            both, all_ = [], []
            for x, y in zip(left, right):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both.append(len(np.intersect1d(x, y, assume_unique=True)))
                all_.append(len(x) + len(y) - both[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("a"), batch.column("b"), pa.array(both, pa.int64()),
                 pa.array(all_, pa.int64())], ["a", "b", "shared", "together"])

    joined = (pairs.join(sets.select(F.col("id").alias("a"), F.col("hashes").alias("x")), "a")
              .join(sets.select(F.col("id").alias("b"), F.col("hashes").alias("y")), "b"))
    return joined.select("a", "b", "x", "y").mapInArrow(
        run, "a bigint, b bigint, shared bigint, together bigint")


def _links_of_blocks(percent: int):
    """Links between documents of different components, for two blocks of a family."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        left = pdf[pdf["side"] != 1].reset_index(drop=True)
        right = pdf[pdf["side"] != 0].reset_index(drop=True)
        out = []
        sides = [[np.frombuffer(h, np.uint64) for h in s["hashes"]] for s in (left, right)]
        if sides[0] and sides[1]:
            size = [np.array([len(h) for h in s]) for s in sides]
            flat = [np.concatenate(s) for s in sides]
            common = np.intersect1d(*flat)
            place = [np.searchsorted(common, f) for f in flat]
            owner = [np.repeat(np.arange(len(s)), n) for s, n in zip(sides, size)]
            inside = [common[np.minimum(p, len(common) - 1)] == f if len(common) else
                      np.zeros(len(f), bool) for p, f in zip(place, flat)]
            both = np.zeros((len(sides[0]), len(sides[1])), np.float32)
            for lo in range(0, len(common), 4096):  # columns at a time: memory stays bounded
                matrix = []
                for side, p, o, i in zip(sides, place, owner, inside):
                    here = i & (p >= lo) & (p < lo + 4096)
                    m = np.zeros((len(side), min(4096, len(common) - lo)), np.float32)
                    m[o[here], p[here] - lo] = 1
                    matrix.append(m)
                both += matrix[0] @ matrix[1].T
            both = both.astype(np.int64)
            linked = 100 * both >= percent * (size[0][:, None] + size[1][None, :] - both)
            linked &= left["component"].to_numpy()[:, None] != right["component"].to_numpy()[None, :]
            of = right["component"].to_numpy()
            for i in np.flatnonzero(linked.any(1)):  # one link per component is enough
                _, first = np.unique(of[linked[i]], return_index=True)
                for j in np.flatnonzero(linked[i])[first]:
                    out.append((left["id"][i], right["id"][j]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return run


def _across_components(families: DataFrame, left: list[DataFrame], linked: DataFrame,
                       sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between components of one family, or of the members left in one bucket."""
    member = families.select(F.col("node").alias("id"), F.col("component").alias("family"))
    for rest in left:
        member = member.unionByName(rest.select(F.col("member").alias("id"), F.col("bucket").alias("family")))
    member = member.join(linked.select(F.col("node").alias("id"), F.col("component").alias("c")),
                         "id", "left").select("id", "family", F.coalesce("c", "id").alias("component"))
    member = saved(member, "family-members")
    open_ = (member.groupBy("family").agg(F.count(F.lit(1)).alias("n"),
                                          F.min("component").alias("lo"), F.max("component").alias("hi"))
             .where("lo < hi").select("family", F.ceil(F.col("n") / BLOCK).cast("int").alias("n_blocks")))
    dealt = (member.join(saved(open_, "open-families"), "family")
             .withColumn("block", F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1)))
             .select("family", "id", "component", F.least("block", "other").alias("i"),
                     F.greatest("block", "other").alias("j"),
                     F.when(F.col("block") == F.col("other"), 2)
                     .when(F.col("block") < F.col("other"), 0).otherwise(1).alias("side")))
    return (dealt.join(sets, "id").groupBy("family", "i", "j")
            .applyInPandas(_links_of_blocks(percent), "a bigint, b bigint"))


def _across_families(verified: DataFrame, families: DataFrame, linked: DataFrame, sets: DataFrame,
                     percent: int) -> DataFrame:
    """Links ``a, b`` between a document that had a hit with a leader and one that had none.

    A document leaves a bucket at its first hit, with a leader at ``RELATED`` or more. What it
    is linked to may miss that, but is near the same leader, as distances add up: at
    ``RELATED - (100 - percent)`` or more. So what is near a leader and of another family is
    compared, in blocks, with what had a hit with that leader.
    """
    least = max(0, RELATED - (100 - percent))
    family, component = (rows.select(F.col("node").alias(side), F.col("component").alias(f"{name}_{side}"))
                         for rows, name, side in ((families, "f", "a"), (linked, "c", "a")))
    close = (verified.where(f"NOT hit AND shared > 0 AND 100 * shared >= {least} * together").select("a", "b").distinct()
             .join(family, "a", "left").join(family.toDF("b", "f_b"), "b", "left")
             .where(F.coalesce("f_a", "a") != F.coalesce("f_b", "b")).select("a", "b"))
    close = saved(close, "close")
    held = saved(verified.where("hit").select("a", "b").distinct()
                 .join(close.select("b").distinct(), "b", "left_semi"), "held")

    def blocks_of(rows: DataFrame, name: str) -> DataFrame:
        return rows.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias(name))

    counts = saved(blocks_of(close, "n_close").join(blocks_of(held, "n_held"), "b"), "leader-blocks")

    def dealt(rows: DataFrame, own: str, other: str, side: int) -> DataFrame:
        own_block = F.pmod(F.xxhash64("a"), F.col(own)).cast("int")
        others = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        i, j = ("own", "other") if side == 0 else ("other", "own")
        return (rows.join(counts, "b").withColumn("own", own_block).withColumn("other", others)
                .select(F.col("b").alias("leader"), F.col("a").alias("id"), F.col(i).alias("i"), F.col(j).alias("j"),
                        F.lit(side).alias("side")))

    both = dealt(close, "n_close", "n_held", 0).unionByName(dealt(held, "n_held", "n_close", 1))
    named = both.join(component.toDF("id", "c"), "id", "left").withColumn("component", F.coalesce("c", "id")).drop("c")
    return (named.join(sets, "id").groupBy("leader", "i", "j")
            .applyInPandas(_links_of_blocks(percent), "a bigint, b bigint"))


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, bands: int = BANDS,
                    rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text_key, n_shingles, component_id, kept`` for every row.

    Two documents are linked if ``100 * shared >= percent * together`` holds for their sets
    of distinct ``shingle_words``-word shingles (the whole sequence, if it is shorter).
    ``component_id`` is the smallest id reached by links, and ``kept`` marks its row.
    ``text_key`` is ``xxhash64(text)``, for joining decisions back to rows.

    Texts that are null, empty or hold no word have no shingle and are linked with nothing.
    Ids are integers. A row with a null id gets the component of its set; it is kept only if
    that has no id at all. Rows repeated with their id are one document and share their
    decision; an id with several texts belongs to the component of each. Sets are compared by
    64-bit shingle hashes. Other columns are not read.
    """
    if percent < RELATED:
        raise ValueError(f"links need a similarity of {RELATED} percent or more")
    rows_in = docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).alias("text"))
    rows_in = rows_in.withColumn("text_key", F.xxhash64("text"))
    described = saved(_described(rows_in, shingle_words, bands, rows), "described")
    # The smallest id of a set stands for it; several sets may share an id.
    classes = saved(described.where("n > 0 and id is not null").groupBy("set_key")
                    .agg(F.min("id").alias("rep")), "classes")
    reps = (described.join(classes.withColumnRenamed("set_key", "key"),
                           (F.col("set_key") == F.col("key")) & (F.col("id") == F.col("rep")))
            .select("rep", F.explode("bands").alias("bucket")))
    active = _shared_buckets(saved(reps, "bands"))
    candidates = saved(active.select(F.col("member").alias("id")).distinct(), "candidates")
    wanted = rows_in.join(candidates, "id")
    sets = saved(_full_sets(wanted, shingle_words).dropDuplicates(["id", "hashes"]), "sets")
    first = active.where("member != leader").select("bucket", F.col("member").alias("a"),
                                                    F.col("leader").alias("b"))
    left: list[DataFrame] = []

    verified = leader_rounds(first, lambda pairs: _shared(pairs, sets).withColumn(
        "hit", F.expr(f"100 * shared >= {RELATED} * together")), left)
    links = verified.where(f"100 * shared >= {percent} * together").select("a", "b")
    families = components(verified.where("hit"))
    links = saved(links, "links")
    linked = components(links)
    across = saved(_across_components(families, left, linked, sets, percent)
                   .unionByName(_across_families(verified, families, linked, sets, percent)), "across")
    linked = _lifted(linked, across)
    decided = classes.join(linked, F.col("rep") == F.col("node"), "left").select(
        "set_key", F.coalesce("component", "rep").alias("component"))
    out = described.drop("bands").join(
        saved(decided.withColumnRenamed("set_key", "key"), "decided"),
        F.col("set_key") == F.col("key"), "left")
    component = F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id_col), "text_key", F.col("n").alias("n_shingles"),
                      component.alias("component_id"),
                      F.coalesce(F.col("id") == component, component.isNull()).alias("kept"))


def _lifted(linked: DataFrame, across: DataFrame) -> DataFrame:
    """The components of ``linked`` with links ``a, b`` between them: only these are gone over."""
    if across.isEmpty():
        return linked
    of = linked.select("node", "component")
    between = (across.join(of.toDF("a", "ca"), "a", "left").join(of.toDF("b", "cb"), "b", "left")
               .select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).distinct())
    upper = components(saved(between, "between")).toDF("one", "above")
    return saved(linked.join(upper, F.col("component") == F.col("one"), "full").select(
        F.coalesce("node", "one").alias("node"), F.coalesce("above", "component").alias("component")), "lifted")


def _shared_buckets(reps: DataFrame) -> DataFrame:
    """``bucket, member, leader`` of buckets with several members; the smallest leads."""
    led = (reps.groupBy("bucket").agg(F.min("rep").alias("leader"), F.max("rep").alias("last"))
           .where("leader < last").select("bucket", "leader"))
    return saved(reps.join(saved(led, "leaders"), "bucket")
                 .select("bucket", F.col("rep").alias("member"), "leader"), "buckets")


def without_near_duplicates(docs: DataFrame, **settings) -> DataFrame:
    """The rows that are kept."""
    id_col, text_col = settings.get("id_col", "doc_id"), settings.get("text_col", "text")
    own_id, key = unused(docs, "own_id", "key")
    dropped = near_duplicates(docs, **settings).where("not kept").select(
        F.col(id_col).alias(own_id), F.col("text_key").alias(key))
    return docs.join(saved(dropped.distinct(), "dropped"),
                     docs[id_col].cast("bigint").eqNullSafe(F.col(own_id))
                     & (F.xxhash64(text_of(text_col)) == F.col(key)), "left_anti")
