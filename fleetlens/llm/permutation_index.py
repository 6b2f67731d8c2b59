"""Nearest neighbours by a permutation index.

Nearness is the inner product, so vectors get one more coordinate that makes all of them
as long as the longest, and queries a zero there: the angle between them then goes by the
product. A vector is represented by the pivots nearest to it, in order. It is posted under
the first few of them; a query looks into the lists of its own first pivots. What it finds
there is ranked by Spearman's footrule between the two orders, and only the best are ranked
again by their inner product in double precision. Equal vectors are one entry, with as
many of their smallest ids as a result can hold. Lists are dealt out in blocks, so that a
pivot with very many vectors or queries is shared by many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetlens.llm.common import saved

#: Pivots; length of the order kept; lists a vector is posted in; lists a query looks into.
PIVOTS, ORDER, POSTS, PROBES = 256, 64, 8, 64
#: Share of a list's new entries, best by footrule, that is ranked by inner product.
RERANK = 0.35
_X_BLOCK, _Q_BLOCK = 4096, 512


def _plain(vectors: DataFrame, column: str) -> Column:
    """The vector with its own type of floats, others as doubles; without negative zeros."""
    kind = vectors.schema[column].dataType.simpleString()
    kind = kind if kind == "array<float>" else "array<double>"
    return F.transform(F.col(column).cast(kind), lambda v: F.when(v == 0, F.abs(v)).otherwise(v))


def _entries(vectors: DataFrame, id_col: str, vector_col: str, keep: int) -> DataFrame:
    """``rep, id, vector`` with up to ``keep`` smallest ids of each usable vector."""
    x = _plain(vectors, vector_col)
    usable = (F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
              & F.exists(x, lambda v: v != 0))
    rows = (vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).where(usable)
            .select(F.col(id_col).cast("bigint").alias("id"),
                    x.alias("vector")))
    same = Window.partitionBy(F.xxhash64("vector"), "vector").orderBy("id")
    return (rows.distinct().withColumn("turn", F.row_number().over(same)).where(F.col("turn") <= keep)
            .withColumn("rep", F.min("id").over(Window.partitionBy(F.xxhash64("vector"), "vector")))
            .select("rep", "id", "turn", "vector"))


def _length(v: np.ndarray) -> float:
    most = float(np.abs(v).max(initial=0.0))
    return most * float(np.linalg.norm(v / most)) if most else 0.0


def _lengthened(v: np.ndarray, longest: float, width: int) -> np.ndarray:
    """The vector on ``width`` coordinates, and one that makes it as long as the longest; all
    in parts of that."""
    out = np.zeros(width + 1)
    out[:min(len(v), width)] = v[:width] / longest
    out[width] = np.sqrt(max(0.0, 1.0 - (_length(v) / longest) ** 2))
    return out


def _ordered(entries: DataFrame, pivots: np.ndarray, longest: float, order: int, lists: int,
             queries: bool = False) -> DataFrame:
    """``rep, vector, pivots`` (16-bit numbers of the nearest pivots, in order), ``lists``
    (the first of them). Queries have nothing in the last coordinate."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for v in batch.column("vector").to_pylist():
                x = _lengthened(np.asarray(v, float), longest, pivots.shape[1] - 1)
                if queries:
                    x[-1] = 0.0
                near.append(np.argsort(-(pivots @ x), kind="stable")[:order].astype(np.uint16))
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("vector"),
                 pa.array([n.tobytes() for n in near], pa.binary()),
                 pa.array([n[:lists].tolist() for n in near], pa.list_(pa.int32()))],
                ["rep", "vector", "pivots", "lists"])

    kind = entries.schema["vector"].dataType.simpleString()
    return entries.select("rep", "vector").mapInArrow(
        run, f"rep bigint, vector {kind}, pivots binary, lists array<int>")


def _search(posts: int, keep: int, n_pivots: int):
    """Best ``keep`` entries of a block of a list, for each query of a block."""
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        of = pdf["side"].to_numpy()
        x, q = pdf[of == 0], pdf[of == 1]
        out: list[tuple[int, int, float]] = []
        # Vectors of another length have no inner product with the query.
        for width in set(map(len, q["vector"])) & set(map(len, x["vector"])) if len(x) and len(q) else ():
            here, ask = x[x["vector"].map(len) == width], q[q["vector"].map(len) == width]
            vectors, reps = np.array(here["vector"].tolist(), float), here["rep"].to_numpy()
            wanted = np.array(ask["vector"].tolist(), float)
            near = [np.array([np.frombuffer(p, np.uint16) for p in side["pivots"]], np.int64)
                    for side in (here, ask)]
            order = near[0].shape[1]
            rank = np.full((n_pivots, len(here)), order, np.int16)
            rank[near[0].T, np.arange(len(here))] = np.arange(order, dtype=np.int16)[:, None]
            place = np.arange(order, dtype=np.int16)[:, None]
            for i, (own, turn) in enumerate(zip(ask["rep"], ask["turn"])):
                ranks = rank[near[1][i]]
                new = np.flatnonzero(~(ranks[:turn] < posts).any(0))  # not met in an earlier list
                ranks = ranks[:, new]
                footrule = (np.abs(ranks - place) + ranks).sum(0)  # but for a constant
                if len(new) > 2 * keep:
                    most = max(2 * keep, int(np.ceil(RERANK * len(new))))
                    new = new[np.argpartition(footrule, most - 1)[:most]] if most < len(new) else new
                score = (vectors[new] * wanted[i]).sum(1)
                for j in np.lexsort((reps[new], -score))[:keep]:
                    out.append((own, reps[new[j]], score[j]))
        return pd.DataFrame(out, columns=["q", "x", "score"]).astype(
            {"q": "int64", "x": "int64", "score": "float64"})

    return run


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, id_col, score``: the ``k`` best found for every query, which is a
    row whose id fulfils ``is_query`` (from an id column to a condition).

    The score is the inner product in double precision; equal scores go by smaller id, and
    a query does not find itself. Vectors that are null, zero, or hold null, NaN or infinite
    components take no part, as do rows without an id. An id repeated with its vector counts
    once. Vectors of different lengths are never neighbours. Tables of fewer entries than
    pivots are searched in every list. The pivots are a sample of bounded size, chosen by a
    hash of the id; every vector is posted.
    """
    keep = k + 1
    members = saved(_entries(vectors, id_col, vector_col, keep), "vectors")
    entries = members.where("turn = 1").select("rep", "vector")
    chosen = entries.orderBy(F.xxhash64("rep", F.lit(5)), "rep").limit(PIVOTS).collect()
    width = max((len(r["vector"]) for r in chosen), default=1)
    largest = F.array_max(F.transform("vector", lambda v: F.abs(v.cast("double"))))
    parts = F.aggregate("vector", F.lit(0.0), lambda s, v: s + F.pow(v.cast("double") / F.col("largest"), 2))
    longest = entries.withColumn("largest", largest).agg(
        F.max(F.col("largest") * F.sqrt(parts)).alias("n")).first()["n"] or 1.0
    pivots = np.zeros((max(len(chosen), 1), width + 1))
    for i, r in enumerate(chosen):
        pivots[i] = _lengthened(np.asarray(r["vector"], float), longest, width)
    full = len(pivots) < PIVOTS  # fewer entries than pivots: every list
    order = len(pivots) if full else ORDER
    posts, probes = (order, order) if full else (POSTS, PROBES)
    ordered = saved(_ordered(entries, pivots, longest, order, posts), "ordered")
    queries = saved(vectors.where(F.col(id_col).isNotNull() & is_query(F.col(id_col)))
                    .select(F.col(id_col).cast("bigint").alias("query_id"),
                            _plain(vectors, vector_col).alias("vector")).distinct(), "queries")
    asked = saved(queries.join(ordered.select("rep", F.col("vector").alias("v")),
                               F.col("vector") == F.col("v")).select("query_id", "rep"), "asked")
    wanted = saved(_ordered(entries.join(asked.select("rep").distinct(), "rep", "left_semi"), pivots, longest, order,
                            probes, queries=True), "wanted")
    posted = ordered.select("*", F.posexplode(F.slice("lists", 1, posts)).alias("turn", "pivot"))
    probed = wanted.select("*", F.posexplode(F.slice("lists", 1, probes)).alias("turn", "pivot"))
    sizes = (posted.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / _X_BLOCK).cast("int").alias("nx"))
             .join(probed.groupBy("pivot").agg(
                 F.ceil(F.count(F.lit(1)) / _Q_BLOCK).cast("int").alias("nq")), "pivot"))
    sizes = F.broadcast(saved(sizes, "lists"))  # a row per pivot at most
    hashed = F.xxhash64("rep")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    dealt = (posted.join(sizes, "pivot").withColumn("bx", F.pmod(hashed, F.col("nx")).cast("int"))
             .withColumn("bq", every("nq")).withColumn("side", F.lit(0))
             .unionByName(probed.join(sizes, "pivot")
                          .withColumn("bq", F.pmod(hashed, F.col("nq")).cast("int"))
                          .withColumn("bx", every("nx")).withColumn("side", F.lit(1))))
    found = (dealt.select("pivot", "bx", "bq", "side", "rep", "vector", "pivots", "turn")
             .groupBy("pivot", "bx", "bq")
             .applyInPandas(_search(posts, keep, len(pivots)), "q bigint, x bigint, score double"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "x")
    found = found.withColumn("turn", F.row_number().over(best)).where(F.col("turn") <= keep).drop("turn")
    ids = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    named = (found.join(members.select(F.col("rep").alias("x"), "id"), "x")
             .withColumn("turn", F.row_number().over(ids)).where(F.col("turn") <= keep)
             .groupBy("q").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id")))
                               .alias("best")))  # k + 1 at most
    others = F.slice(F.filter("best", lambda b: b["id"] != F.col("query_id")), 1, k)
    return (asked.join(saved(named, "best"), F.col("rep") == F.col("q"))
            .select("query_id", F.posexplode(others).alias("at", "b"))
            .select("query_id", (F.col("at") + 1).alias("rank"), F.col("b.id").alias(id_col),
                    (-F.col("b.s")).alias("score")))
