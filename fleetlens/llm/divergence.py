"""How far the terms of a source are from those of other sources, and of all its language.

The counts of a language's terms in its groups (one for each source) are a matrix that is
mostly zeros. It is cut into tiles of columns, dealt out by the term's hash, and of 64 rows.
A tile is held as K-squared quadtrees, one per 64 columns: every node says which of its four
quadrants hold anything. Two blocks of rows are traversed jointly for all their pairs of
groups: where both quadrants are empty, all their cells have the same price, which is
multiplied by the number of columns and looked at no further; what is left at the leaves is
priced cell by cell. All arithmetic is in whole numbers.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetlens.llm.common import saved, text_of

#: Documents of a language that a kept term is in; prices are parts of so many.
MIN_DOCS, SCALE = 10, 1_000_000_000
#: Columns of a tile; rows of a block and columns of a quadtree, as a power of two.
COLUMNS, DEPTH = 4096, 6
SIDE = 1 << DEPTH
#: Quadtrees traversed at once; entries counted in a task before they are handed on; bytes
#: of a text cut into terms at once.
TREES, ENTRIES, PIECE = 4, 500_000, 1 << 22

_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _pieces(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a UTF-8 text, a bounded number of bytes at once."""
    data, at = data.translate(_LETTERS), 0
    while at < len(data):
        end = len(data) if len(data) - at <= PIECE else data.find(b" ", at + PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    groups: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    entries = 0

    def rows() -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for (lang, source), (words, docs) in groups.items():
            for column, values in zip(columns, ([lang] * len(words), [source] * len(words), words.keys(),
                                                words.values(), map(docs.__getitem__, words))):
                column.extend(values)
        groups.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.binary(), pa.int64(), pa.int64()))],
            ["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, text in zip(*(batch.column(c) for c in ("lang", "source", "text"))):
            words, docs = groups.setdefault((lang.as_py(), source.as_py()), (Counter(), Counter()))
            before, seen = len(words), set()
            for terms in _pieces(text.as_py()):
                words.update(terms)
                seen.update(terms)
            docs.update(seen)
            entries += len(words) - before
            if entries > ENTRIES:
                yield rows()
                entries = 0
    yield rows()


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                source_col: str = "source") -> DataFrame:
    """``lang, source, term, n, docs``: occurrences of every term and documents that hold it."""
    counted = docs.select(text_of(lang_col).cast("string").alias("lang"),
                          text_of(source_col).cast("string").alias("source"),
                          text_of(text_col).cast("binary").alias("text")
                          ).mapInArrow(_count, "lang string, source string, term binary, n bigint, docs bigint")
    return (counted.groupBy("lang", "source", F.col("term").cast("string").alias("term"))
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def price(count: Column | str, mass: Column | str) -> Column:
    """Smoothed share of a term, in parts of ``SCALE``, from its count and ``N + 2 V``."""
    count, mass = (F.col(c) if isinstance(c, str) else c for c in (count, mass))
    scaled = (count + 2).cast("decimal(20,0)") * F.lit(SCALE)
    return F.call_function("div", scaled, mass.cast("decimal(20,0)")) + 1


def difference(p: Column | str, q: Column | str) -> Column:
    """Squared difference of two prices over their sum, without its fraction."""
    p, q = ((F.col(c) if isinstance(c, str) else c).cast("bigint") for c in (p, q))
    return F.call_function("div", (p - q) * (p - q), p + q)


class QuadTrees:
    """K-squared trees over cells of a block of rows, one per ``SIDE`` columns. ``parts[l]``
    has, for each node of level ``l`` that is not empty, the numbers of its quadrants' nodes at
    the next level, or -1 for an empty one; at the last level these are cells."""

    def __init__(self, row: np.ndarray, column: np.ndarray):
        key = (column >> DEPTH) << (2 * DEPTH)
        for bit in range(DEPTH):
            key |= ((row >> bit & 1) << (2 * bit + 1)) | ((column >> bit & 1) << (2 * bit))
        self.cells = np.argsort(key)  # of a leaf's number
        self.parts = []
        below = key[self.cells]
        for _ in range(DEPTH):
            nodes, parent = np.unique(below >> 2, return_inverse=True)
            part = np.full((len(nodes), 4), -1, np.int64)
            part[parent, below & 3] = np.arange(len(below))
            self.parts.append(part)
            below = nodes
        self.parts.reverse()
        self.roots = below

    def root(self, trees: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.roots, trees), max(len(self.roots) - 1, 0))
        return np.where(self.roots[at] == trees, at, -1) if len(self.roots) else np.full(len(trees), -1)

    def part(self, level: int, node: np.ndarray, which: np.ndarray) -> np.ndarray:
        if not len(self.roots):
            return node
        return np.where(node >= 0, self.parts[level][node, which], -1)


def joint_sums(a: tuple[np.ndarray, ...], b: tuple[np.ndarray, ...] | None, n_columns: int) -> np.ndarray:
    """Differences of all pairs of rows of two blocks, summed over all columns.

    A block is ``row, column, price`` of its cells and ``empty``, each row's price of a cell
    without a count. Without ``b``, the pairs ``i < j`` of one block are summed.
    """
    same = b is None
    (row_a, column_a, price_a, empty_a), (row_b, column_b, price_b, empty_b) = a, a if same else b
    left = QuadTrees(row_a, column_a)
    right = left if same else QuadTrees(row_b, column_b)
    sums = np.zeros((len(empty_a), len(empty_b)), np.int64)
    unused = [np.zeros((1 << l, 1 << l), np.int64) for l in range(DEPTH + 1)]  # columns empty for both
    for lo in range(0, -(-n_columns // SIDE), TREES):
        tree = np.arange(lo, min(lo + TREES, -(-n_columns // SIDE)))
        front = [left.root(tree), right.root(tree), np.zeros(len(tree), np.int64), np.zeros(len(tree), np.int64), tree]
        for level in range(DEPTH + 1):
            width = SIDE >> level
            inside = (front[2] * width < len(empty_a)) & (front[3] * width < len(empty_b))
            na, nb, ra, rb, c = (x[inside] for x in front)
            empty = (na < 0) & (nb < 0)
            np.add.at(unused[level], (ra[empty], rb[empty]), np.clip(n_columns - c[empty] * width, 0, width))
            na, nb, ra, rb, c = (x[~empty] for x in (na, nb, ra, rb, c))
            if level == DEPTH:
                break
            split = [[], [], [], [], []]
            for i, j, s in np.ndindex(2, 2, 2):
                keep = slice(None) if not same else np.flatnonzero(2 * ra + i <= 2 * rb + j)
                for out, values in zip(split, (left.part(level, na[keep], np.full(len(na[keep]), 2 * i + s)),
                                               right.part(level, nb[keep], np.full(len(nb[keep]), 2 * j + s)),
                                               2 * ra[keep] + i, 2 * rb[keep] + j, 2 * c[keep] + s)):
                    out.append(values)
            front = [np.concatenate(x) for x in split]
        p, q = empty_a[ra], empty_b[rb]
        p[na >= 0] = price_a[left.cells[na[na >= 0]]]
        q[nb >= 0] = price_b[right.cells[nb[nb >= 0]]]
        np.add.at(sums, (ra, rb), (p - q) ** 2 // (p + q))
    row, other = (np.arange(SIDE) for _ in range(2))
    columns = sum(u[np.ix_(row >> (DEPTH - l), other >> (DEPTH - l))] for l, u in enumerate(unused))
    p, q = empty_a[:, None], empty_b[None, :]
    return sums + columns[:len(empty_a), :len(empty_b)] * ((p - q) ** 2 // (p + q))


def _tile(table: pa.Table) -> pa.Table:
    """Sums of a tile's pairs of rows; a row without a term brings its empty price."""
    row, p = (table.column(c).to_numpy() for c in ("row", "price"))
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    coded = table.column("term").combine_chunks().dictionary_encode()
    n_columns = len(coded.dictionary)
    header = np.asarray(coded.is_null())
    column = coded.indices.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    # Common terms first, so that empty cells lie together.
    place = np.empty(n_columns, np.int64)
    place[np.argsort(-np.bincount(column[~header], minlength=n_columns), kind="stable")] = np.arange(n_columns)
    blocks = []
    for block in dict.fromkeys((i, j)):
        of = row // SIDE == block
        empty = np.zeros(int((of & header).sum()), np.int64)
        empty[row[of & header] % SIDE] = p[of & header]
        cells = of & ~header
        blocks.append((row[cells] % SIDE, place[column[cells]], p[cells], empty))
    sums = joint_sums(blocks[0], blocks[1] if i != j else None, n_columns)
    a, b = np.triu_indices(len(sums), 1) if i == j else map(np.ravel, np.indices(sums.shape))
    return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * len(a), pa.string()),
                     "a": pa.array(a + i * SIDE, pa.int64()), "b": pa.array(b + j * SIDE, pa.int64()),
                     "met": pa.array(np.full(len(a), n_columns), pa.int64()), "value": pa.array(sums[a, b], pa.int64())})


class Divergence:
    """The terms kept of each language and the groups' counts of them.

    ``docs`` are read once. Null texts, languages and sources count as empty; a term is a
    stretch of letters A to Z, in lower case, and of characters above 0x7F. Rows with null or
    repeated ids are documents like others, and other columns are not read. A language
    without kept terms has groups, with differences of 0. Every group of a language is
    compared with every other, so results grow with the square of a language's sources; a
    task holds two blocks of 64 of them and about 4,096 terms.
    """

    def __init__(self, docs: DataFrame, text_col: str = "text", lang_col: str = "lang",
                 source_col: str = "source", min_docs: int = MIN_DOCS):
        counts = saved(term_counts(docs, text_col, lang_col, source_col), "term-counts")
        kept = saved(counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
                     .where(F.col("docs") >= min_docs).drop("docs"), "kept-terms")
        self.cells = saved(counts.drop("docs").join(kept, ["lang", "term"]), "cells")
        groups = docs.select(text_of(lang_col).cast("string").alias("lang"),
                             text_of(source_col).cast("string").alias("source")).distinct()
        langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_n"))
        sums = self.cells.groupBy("lang", "source").agg(F.sum("n").alias("n"))
        known = groups.join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
        self.groups = saved(known.select(
            "lang", "source", F.coalesce("terms", F.lit(0)).alias("terms"),
            (F.coalesce("n", F.lit(0)) + 2 * F.coalesce("terms", F.lit(0))).alias("mass"),
            (F.col("lang_n") + 2 * F.col("terms")).alias("lang_mass"),
            # A row of a language for each source: small next to the pairs that are the result.
            (F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1).cast("bigint").alias("row"),
            F.count(F.lit(1)).over(Window.partitionBy("lang")).alias("rows")), "groups")

    def pairs(self) -> DataFrame:
        """``lang, source, other, value`` for each two groups of a language, both ways."""
        priced = self.groups.where("terms > 0").withColumn("empty", price(F.lit(0).cast("bigint"), "mass"))
        tiles = F.ceil(F.col("terms") / COLUMNS)
        cells = self.cells.join(priced, ["lang", "source"]).select(
            "lang", F.pmod(F.xxhash64("term"), tiles).alias("tile"), "row", "rows", "term",
            price("n", "mass").alias("price"))
        headers = priced.select("lang", F.explode(F.sequence(F.lit(0).cast("bigint"), tiles - 1)).alias("tile"), "row",
                                "rows", F.lit(None).cast("string").alias("term"), F.col("empty").alias("price"))
        own = F.floor(F.col("row") / SIDE)
        other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("rows") - 1) / SIDE)))
        dealt = (cells.unionByName(headers).withColumn("own", own).withColumn("other", other)
                 .select("lang", "tile", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                         "row", "term", "price"))
        sums = (dealt.groupBy("lang", "tile", "i", "j")
                .applyInArrow(_tile, "lang string, a bigint, b bigint, met bigint, value bigint")
                .groupBy("lang", "a", "b").agg(F.sum("met").alias("met"), F.sum("value").alias("value")))
        zero = F.when(F.col("terms") > 0, price(F.lit(0).cast("bigint"), "mass"))
        sides = [self.groups.select("lang", F.col("source").alias(name), F.col("row").alias(f"{name}_row"), "terms",
                                    zero.alias(f"{name}_zero")) for name in ("source", "other")]
        both = sides[0].join(sides[1].drop("terms"), "lang").where("source_row != other_row")
        both = both.withColumn("a", F.least("source_row", "other_row")).withColumn(
            "b", F.greatest("source_row", "other_row"))
        # Terms that neither block of rows has: one more quadrant of one price.
        unmet = (F.col("terms") - F.coalesce("met", F.lit(0))) * difference("source_zero", "other_zero")
        return both.join(sums, ["lang", "a", "b"], "left").select(
            "lang", "source", "other",
            F.when(F.col("terms") > 0, F.coalesce("value", F.lit(0)) + unmet).otherwise(F.lit(0)).alias("value"))

    def terms(self) -> DataFrame:
        """``lang, source, term, value`` for terms more frequent in a group than in its language."""
        priced = (self.cells.join(self.groups, ["lang", "source"])
                  .withColumn("p", price("n", "mass")).withColumn("q", price("lang_n", "lang_mass")))
        return priced.where("p > q").select("lang", "source", "term", difference("p", "q").alias("value"))


def ranked(rows: DataFrame, item: str, most: int | None = None) -> DataFrame:
    """Rows of ``lang, source, value`` and ``item`` with ``rank`` by value, descending, and item."""
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), item)
    out = rows.withColumn("rank", F.row_number().over(order))
    return out if most is None else out.where(F.col("rank") <= most)
