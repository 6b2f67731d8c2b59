"""Exact inner-product search over vectors sorted by length.

Vectors are packed in blocks by descending length. A block is turned by the right singular
vectors of a sample, so that its first coordinates hold most of every product: a product is
at most its partial sum over these plus, by Cauchy and Schwarz, the product of the lengths of
the two rests. Queries first meet the longest vectors, which gives each a score that its
results reach at least. Sorted by that score per length they are packed anew, and a group of
queries meets only blocks whose longest vector can reach it. What no bound rules out is
multiplied in whole numbers, so the rotation decides about time, never about results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetlens.llm.common import saved

#: Vectors of a block, queries of a group, numbers of either; blocks that queries meet first.
BLOCK, GROUP, CELLS, HEAD = 1024, 2048, 1 << 22, 4
#: Rows the rotation is fitted on, coordinates it turns, bounds for groups of queries.
SAMPLE_ROWS, TURNED, STEPS = 4096, 256, 1024
_SLACK = 1e-9  # of the product of lengths: far above what rounding does to a sum
_MOST = 2 ** 63 - 1
_PACK = ("part int, turn int, n int, width int, kind string, data binary, ids array<bigint>, "
         "rows array<bigint>, lengths array<double>, floors array<bigint>, top double, low double")


def _kind(most: int) -> np.dtype:
    return next(np.dtype(k) for k in ("i1", "i2", "i4", "i8") if most <= np.iinfo(k).max)


def _packed(rows: DataFrame, order: list[Column], size: int) -> DataFrame:
    """Blocks of up to ``size`` rows in ``order``, from ``row, id, vector, length, floor``."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, turn, held, width = TaskContext.get().partitionId(), 0, [], 0

        def block() -> pa.RecordBatch:
            data = np.zeros((len(held), width), np.int64)
            for out, (_, _, vector, _, _) in zip(data, held):
                out[:len(vector)] = vector
            low, high = int(data.min(initial=0)), int(data.max(initial=0))
            kind = _kind(max(high, -low - 1))
            lengths = [h[3] for h in held]
            needs = [-np.inf if h[4] is None or h[4] <= 0 else h[4] / h[3] if h[3] else np.inf for h in held]
            values = [part, turn, len(held), width, kind.str, data.astype(kind).tobytes(), [h[1] for h in held],
                      [h[0] for h in held], lengths, [h[4] for h in held], max(lengths), min(needs)]
            return pa.RecordBatch.from_pylist([dict(zip(schema.names, values))], schema)

        for batch in batches:
            vectors = batch.column("vector")
            for i, (row, id_, length, floor) in enumerate(zip(*(batch.column(c).to_pylist() for c in (
                    "row", "id", "length", "floor")))):
                vector = vectors[i].values.to_numpy()
                if held and (len(held) == size or (len(held) + 1) * max(width, len(vector)) > CELLS):
                    yield block()
                    turn, held, width = turn + 1, [], 0
                held.append((row, id_, vector, length, floor))
                width = max(width, len(vector))
        if held:
            yield block()

    big = pa.list_(pa.int64())
    schema = pa.schema([("part", pa.int32()), ("turn", pa.int32()), ("n", pa.int32()), ("width", pa.int32()),
                        ("kind", pa.string()), ("data", pa.binary()), ("ids", big), ("rows", big),
                        ("lengths", pa.list_(pa.float64())), ("floors", big), ("top", pa.float64()),
                        ("low", pa.float64())])
    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return dealt.select("row", "id", "vector", "length", "floor").mapInArrow(pack, _PACK)


def _numbered(packs: DataFrame, label: str) -> tuple[DataFrame, int]:
    """Packs with ``number`` in their order, and how many there are. One count per task that
    packed, which the number of shuffle partitions bounds, goes through the driver."""
    packs = saved(packs, label)
    counts = sorted((r["part"], r["count"]) for r in packs.groupBy("part").count().collect())
    start, before = [], 0
    for part, count in counts:
        start += [F.lit(part), F.lit(before)]
        before += count
    first = F.element_at(F.create_map(*(start or [F.lit(-1), F.lit(0)])), F.col("part"))
    return packs.withColumn("number", (first + F.col("turn")).cast("bigint")), before


def _rotation(rows: DataFrame) -> np.ndarray:
    """Right singular vectors of ``SAMPLE_ROWS`` rows chosen by hash, on the first coordinates."""
    sample = (rows.orderBy(F.xxhash64("row", F.lit(11)), "row").limit(SAMPLE_ROWS)
              .select(F.slice("vector", 1, TURNED).alias("v")).collect())
    width = max((len(r["v"]) for r in sample), default=0)
    data = np.zeros((max(len(sample), 1), width))
    for out, r in zip(data, sample):
        out[:len(r["v"])] = r["v"]
    return np.linalg.svd(data, full_matrices=False)[2] if width else np.zeros((0, 0))


def _products(q: np.ndarray, x: np.ndarray, most: float, pairs: bool) -> np.ndarray:
    """Exact inner products of all rows of ``q`` and ``x``, or of row n with row n. What does
    not fit into 64 bits is given as the nearest number that does."""
    if most < 2 ** 53:
        q, x = q.astype(np.float64), x.astype(np.float64)
    elif most >= 2 ** 62:
        q, x = q.astype(object), x.astype(object)
    if pairs:
        out = (q * x).sum(1) if len(q) else np.zeros(0)
    else:
        out = q @ x.T
    return np.clip(out, -_MOST, _MOST).astype(np.int64)


class _Side:
    """A pack's vectors, ids and lengths, turned."""

    def __init__(self, pack: dict, rotation: np.ndarray):
        self.data = np.frombuffer(pack["data"], pack["kind"]).reshape(pack["n"], pack["width"]).astype(np.int64)
        self.nameless = np.array([i is None for i in pack["ids"]])
        self.ids = np.array([0 if i is None else i for i in pack["ids"]], np.int64)
        self.rows = np.array(pack["rows"], np.int64)
        self.lengths = np.array(pack["lengths"])
        head = np.zeros((pack["n"], rotation.shape[1]))
        head[:, :pack["width"]] = self.data[:, :rotation.shape[1]]
        self.turned = head @ rotation.T
        # Length of what the first w turned coordinates leave.
        self.rest = np.sqrt(np.maximum(self.lengths[:, None] ** 2 - np.cumsum(self.turned ** 2, 1), 0))

    def cut(self, n: int) -> "_Side":
        for name in ("data", "nameless", "ids", "rows", "lengths", "turned", "rest"):
            setattr(self, name, getattr(self, name)[:n])
        return self


class _Search:
    """A group of queries on its way through blocks."""

    def __init__(self, pack: dict, rotation: np.ndarray, k: int):
        self.q, self.k, self.rotation = _Side(pack, rotation), k, rotation
        self.floor = np.array([-_MOST if f is None else f for f in pack["floors"]], np.int64)
        self.pool = [np.zeros(0, np.int64) for _ in range(5)]  # query, score, without id, id, row

    def meet(self, pack: dict) -> None:
        x, q = _Side(pack, self.rotation), self.q
        need = self.floor - _SLACK * np.abs(self.floor)
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(need <= 0, -np.inf, need / q.lengths).min(initial=np.inf)
        x.cut(int(np.searchsorted(-x.lengths, -least * (1 - _SLACK), "right")) if np.isfinite(least) else len(x.ids))
        if not len(x.ids):
            return
        qi, xi, score = self._survivors(x, need)
        own = q.rows[qi] == x.rows[xi]
        good = (score >= self.floor[qi]) & ~own
        qi, xi, score = qi[good], xi[good], score[good]
        pool = [np.concatenate(p) for p in zip(self.pool, (qi, score, x.nameless[xi], x.ids[xi], x.rows[xi]))]
        order = np.lexsort((pool[4], pool[3], pool[2], -pool[1], pool[0]))
        qi = pool[0][order]
        turn = np.arange(len(qi)) - np.searchsorted(qi, qi, "left")
        self.pool = [p[order][turn < self.k] for p in pool]
        last = np.flatnonzero(turn[turn < self.k] == self.k - 1)
        at = self.pool[0][last]
        self.floor[at] = np.maximum(self.floor[at], self.pool[1][last])

    def _survivors(self, x: _Side, need: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs that no bound rules out, with their products."""
        q, d = self.q, len(self.rotation)
        width = min(q.data.shape[1], x.data.shape[1])
        most = float(q.lengths.max(initial=0)) * float(x.lengths.max(initial=0))
        need = need[:, None] - _SLACK * q.lengths[:, None] * x.lengths[None, :]
        partial, done = np.zeros((len(q.ids), len(x.ids))), 0
        for w in sorted({d // 8, d // 4, d // 2} - {0}):
            partial += q.turned[:, done:w] @ x.turned[:, done:w].T
            done = w
            alive = partial + q.rest[:, w - 1][:, None] * x.rest[:, w - 1][None, :] >= need
            if alive.mean() < 0.05:
                qi, xi = np.nonzero(alive)
                score = [_products(q.data[qi[a:a + 65536], :width], x.data[xi[a:a + 65536], :width], most, True)
                         for a in range(0, len(qi), 65536)]
                return qi, xi, np.concatenate(score or [np.zeros(0, np.int64)])
        score = _products(q.data[:, :width], x.data[:, :width], most, False)
        qi, xi = np.nonzero(score >= self.floor[:, None])
        return qi, xi, score[qi, xi]

    def best(self) -> pa.RecordBatch:
        of, score, nameless, ids, rows = self.pool
        reached = np.bincount(of, minlength=len(self.q.ids))[of] == self.k
        return pa.RecordBatch.from_arrays(
            [pa.array(self.q.rows[of]), pa.array(self.q.ids[of]), pa.array(ids, mask=nameless.astype(bool)),
             pa.array(rows), pa.array(score), pa.array(self.floor[of], mask=~reached)],
            ["q_row", "query_id", "id", "row", "score", "floor"])


_FOUND = "q_row bigint, query_id bigint, id bigint, row bigint, score bigint, floor bigint"


def _scan(groups: DataFrame, n_groups: int, blocks: DataFrame, first: int, last: int, limits: np.ndarray,
          rotation: np.ndarray, k: int) -> DataFrame:
    """Best of blocks ``first`` to ``last`` for each query. ``limits`` has, for up to ``STEPS``
    equal ranges of groups, the least length that any of them can use, ascending."""
    spark = groups.sparkSession
    n_blocks = last - first
    workers = spark.sparkContext.defaultParallelism
    # Few blocks to a slab where there is little work, many where a group's copies would count.
    slab = max(1, min(16, n_groups * n_blocks // (4 * workers)))
    n_slabs = -(-n_blocks // slab)
    step = -(-n_groups // max(len(limits), 1))
    useful = F.size(F.filter(F.array(*[F.lit(float(x)) for x in limits]),
                             lambda v: v <= F.col("top") * (1 + _SLACK)))
    upto = F.least(F.lit(n_groups), useful * step).cast("bigint")
    columns = ["group", "slab", "number", "n", "width", "kind", "data", "ids", "rows", "lengths", "floors"]
    asked = groups.select(F.col("number").alias("group"), F.lit(-1).cast("bigint").alias("number"),
                          *columns[3:], F.explode(F.sequence(F.lit(0), F.lit(n_slabs - 1))).alias("slab"))
    met = (blocks.where(F.col("number").between(first, last - 1)).withColumn("upto", upto).where("upto > 0")
           .select(F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("upto") - 1)).alias("group"), "number",
                   *columns[3:], F.floor((F.col("number") - first) / slab).cast("int").alias("slab")))
    keys = ["group", "slab"]
    dealt = (asked.select(columns).unionByName(met.select(columns))
             .repartition(max(1, min(n_groups * n_slabs, 32 * workers)), *keys)
             .sortWithinPartitions(*keys, "number"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = at = None
        for batch in batches:
            for i in range(batch.num_rows):
                pack = {c: batch.column(c)[i].as_py() for c in columns}
                if (pack["group"], pack["slab"]) != at:
                    if search is not None:
                        yield search.best()
                    at, search = (pack["group"], pack["slab"]), _Search(pack, rotation, k)
                else:
                    search.meet(pack)
        if search is not None:
            yield search.best()

    return dealt.mapInArrow(run, _FOUND)


def top_products(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id",
                 vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, id_col, score`` (all but the rank 64-bit): the ``k`` rows with the
    highest inner product for every query, which is a row whose id fulfils ``is_query``.

    ``vector_col`` holds arrays of whole numbers. Ties go to the smaller id, null last. A row
    does not find itself; rows that repeat its id, or its vector, are rows like others, and a
    query that is repeated has its results as often. Rows with a null vector or a null in it
    take no part; rows with a null id are found, but ask nothing. A shorter vector counts as
    filled up with zeros; empty and zero vectors have product 0 with all. Products beyond 64
    bits are given as the nearest number within. The rotation is fitted on 4,096 rows at most.
    """
    x = F.col(vector_col).cast("array<bigint>")
    length = F.sqrt(F.aggregate("vector", F.lit(0.0), lambda s, v: s + v.cast("double") * v.cast("double")))
    rows = saved(vectors.where(F.col(vector_col).isNotNull()).where(F.forall(vector_col, lambda v: v.isNotNull()))
                 .select(F.col(id_col).cast("bigint").alias("id"), x.alias("vector"),
                         F.coalesce(is_query(F.col(id_col)), F.lit(False)).alias("asks"))
                 .withColumn("length", length).withColumn("row", F.monotonically_increasing_id()), "vectors")
    rotation = _rotation(rows)
    longest = [F.desc("length"), F.col("row")]
    plain = rows.withColumn("floor", F.lit(None).cast("bigint"))
    blocks, n_blocks = _numbered(_packed(plain, longest, BLOCK), "blocks")
    groups, n_groups = _numbered(_packed(plain.where("asks"), longest, GROUP), "queries")
    head = min(HEAD, n_blocks)
    everything = np.full(1, -np.inf)
    found = vectors.sparkSession.createDataFrame([], _FOUND)
    if n_groups:
        found = saved(_scan(groups, n_groups, blocks, 0, head, everything, rotation, k), "head")
    if n_groups and n_blocks > head:
        floors = found.groupBy("q_row").agg(F.max("floor").alias("floor"))
        asked = (rows.where("asks").join(floors, F.col("row") == F.col("q_row"), "left")
                 .withColumn("need", F.when(F.col("floor") > 0, F.col("floor") / F.col("length"))))
        hardest = [F.asc_nulls_first("need"), F.col("row")]
        groups, n_groups = _numbered(_packed(asked, hardest, GROUP), "queries")
        step = -(-n_groups // STEPS)
        limits = (groups.groupBy(F.floor(F.col("number") / step).alias("step")).agg(F.min("low").alias("low"))
                  .orderBy("step").collect())  # STEPS rows at most
        rest = _scan(groups, n_groups, blocks, head, n_blocks,
                     np.array([r["low"] for r in limits]) * (1 - _SLACK), rotation, k)
        found = found.unionByName(saved(rest, "found"))
    best = Window.partitionBy("q_row").orderBy(F.desc("score"), F.asc_nulls_last("id"), "row")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.col("id").alias(id_col), "score"))
