"""Fuzzy line dedup by MinHash, with DataFrame functions only.

Lines are compared by their sets of character shingles. Every distinct line gets minima
of hashed shingles under many permutations; lines that agree on a band of minima form a
bucket, whose members are compared with its leaders by exact Jaccard similarity; those left
are compared with each other in blocks. Lines that are near a leader, but not linked to it,
are compared in blocks with those that are.
Links are joined to components, and of each component the first line in document order stays.

Lines are cut once and written. Line text is never shuffled as a whole: what leaves the scan
is a signature per distinct line, then two numbers per band; texts are fetched for lines that
share a bucket, and a filter of fixed size, broadcast, keeps others out of that shuffle.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from fleetlens.llm.common import saved, text_of, unused
from fleetlens.llm.components import components
from fleetlens.llm.leaders import leader_rounds

SHINGLE = 7
#: A pair at a similarity of 0.8 has a band in common in 99 of 100 cases, at 0.9 in
#: 9,999 of 10,000.
BANDS, ROWS = 9, 4
PERCENT = 80
#: Shingles of a line that are signed in one row, and bytes of a character in UTF-32.
CHUNK, WIDE = 16, 4
#: What is cut off at the ends of a line.
EDGES = " \t\r\x0b\x0c"
#: Lines in a block, and shingles in it, about.
BLOCK, BLOCK_SHINGLES = 256, 1 << 19
#: 64-bit words of a set's parities, a power of two.
WORDS = 8
#: Bits of a broadcast filter: 8 MB. A full one only lets more rows through.
_FILTER_BITS, _PAGE_BITS = 26, 15


def line_form(line: Column) -> Column:
    """What is compared: lower case, without blanks at the ends. Trimming measures every
    character of a line, so lines whose first and last byte are no blanks are left as they are."""
    code, blanks = line.cast("binary"), [F.lit(c.encode()) for c in EDGES]
    edged = F.substring(code, 1, 1).isin(*blanks) | F.substring(code, -1, 1).isin(*blanks)
    return F.lower(F.when(edged, F.btrim(line, F.lit(EDGES))).otherwise(line))


def _lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id, text_key, line_no, line, key`` of every line that is not blank."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), text_of(text_col).alias("text"))
    lines = rows.select("id", F.xxhash64("text").alias("text_key"),
                        F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    lines = lines.withColumn("line", F.coalesce(line_form(F.col("raw")), F.lit(""))).where("line != ''")
    return lines.select("id", "text_key", "line_no", "line", F.xxhash64("line").alias("key"))


def _last(code: Column) -> Column:
    """Where the last shingle of a line in UTF-32 starts; a short line is its only one."""
    return F.greatest(F.lit(1), F.octet_length(code) - (WIDE * SHINGLE - 1))


def _cut(code: Column, start: Column) -> Column:
    return F.substring(code, start, F.lit(WIDE * SHINGLE))


def _signatures(lines: DataFrame) -> DataFrame:
    """``key, m0, m1, ...``. A permutation is a 32-bit hash combined with a constant by XOR;
    the constants' leading bits differ, so that minima come from different shingles.

    Every line takes all its shingles: two forms of signature would part pairs that lie on
    both sides of the bound between them. Characters of equal width are cut by place. A row has
    ``CHUNK`` shingles, so that minima of a line are met once for all of them; behind a line's
    end it repeats the last, which changes no minimum.
    """
    n = BANDS * ROWS
    draw = random.Random(11)
    masks = [(((i * 64 // n) << 26) | draw.getrandbits(26)) - (1 << 31) for i in range(n)]
    chunks = (lines.select("key", F.encode("line", "UTF-32").alias("code"))
              .select("key", "code", _last(F.col("code")).alias("last"))
              .select("key", "code", "last", F.explode(F.sequence(
                  F.lit(1), F.col("last"), F.lit(WIDE * CHUNK))).alias("start")))
    hashed = chunks.select("key", *[
        F.hash(_cut(F.col("code"), F.least(F.col("start") + WIDE * j, F.col("last")))).alias(f"h{j}")
        for j in range(CHUNK)])
    return hashed.groupBy("key").agg(*[
        F.min(F.least(*[F.col(f"h{j}").bitwiseXOR(F.lit(mask)) for j in range(CHUNK)])).alias(f"m{k}")
        for k, mask in enumerate(masks)])


def _filter_of(values: DataFrame, column: str) -> DataFrame:
    """``page, bits`` of the values' hashes; at most 2**26 bits together."""
    place = F.shiftrightunsigned(F.col(column), 64 - _FILTER_BITS)
    return (values.select(place.alias("place"))
            .groupBy(F.shiftright("place", _PAGE_BITS).alias("page"))
            .agg(F.bitmap_construct_agg(F.col("place").bitwiseAND((1 << _PAGE_BITS) - 1)).alias("bits")))


def _passing(rows: DataFrame, column: str, bits: DataFrame) -> DataFrame:
    """Rows whose value may be in the filter."""
    place = F.shiftrightunsigned(F.col(column), 64 - _FILTER_BITS)
    low = place.bitwiseAND((1 << _PAGE_BITS) - 1).cast("int")
    byte = F.conv(F.hex(F.substring(F.col("bits"), F.shiftright(low, 3) + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.call_function("shiftright", byte, low.bitwiseAND(7)).bitwiseAND(1)
    return (rows.join(F.broadcast(bits), F.shiftright(place, _PAGE_BITS) == F.col("page"))
            .where(bit == 1).drop("page", "bits"))


def _all_hashes(line: Column) -> Column:
    """64-bit hashes of all shingles, repeats too."""
    # as an element of an array, the line is not copied for every shingle
    cut = F.transform(F.array(F.encode(line, "UTF-32")), lambda code: F.transform(
        F.sequence(F.lit(1), _last(code), F.lit(WIDE)), lambda start: F.xxhash64(_cut(code, start))))
    return F.get(cut, F.lit(0))


def _hashes(line: Column) -> Column:
    """The set as 64-bit hashes, which take less room."""
    return F.array_distinct(_all_hashes(line))


def _similar(pairs: DataFrame, texts: DataFrame, percent: int, near: int) -> DataFrame:
    """The pairs ``a, b`` whose similarity is ``near`` or more, and whether it is a ``hit``:
    ``percent`` or more. Sets of too different sizes cannot be that similar, and are not taken
    from their lines again. A leader's set is taken once, not once per pair."""
    leaders = texts.join(pairs.select(F.col("b").alias("key")).distinct(), "key", "left_semi").select(
        F.col("key").alias("b"), _hashes(F.col("line")).alias("y"), F.col("n").alias("ny"))
    members = texts.select(F.col("key").alias("a"), F.col("line").alias("x"), F.col("n").alias("nx"))
    # A filter on what a generator returns stays behind it: sets are not met twice per pair.
    # One of its own for hashes leaves the other one to generated code.
    sized = (pairs.join(members, "a").join(leaders, "b")
             .where(100 * F.least("nx", "ny") >= near * F.greatest("nx", "ny"))
             .select("a", "b", "y", F.explode(F.array(_all_hashes(F.col("x")))).alias("s"),
                     (F.col("nx") + F.col("ny")).alias("sum"))
             .select("a", "b", F.explode(F.array(F.size(F.array_intersect("s", "y")))).alias("shared"), "sum"))
    together = F.col("sum") - F.col("shared")
    return sized.where(100 * F.col("shared") >= near * together).select(
        "a", "b", (100 * F.col("shared") >= percent * together).alias("hit"))


def _dealt(members: DataFrame, n_own: str, n_other: str) -> DataFrame:
    """``members`` (``b, key``) in blocks, each once for every block of the other side."""
    return (members.withColumn("own", F.pmod(F.xxhash64("key"), F.col(n_own)).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col(n_other) - 1))))


def _with_sets(rows: DataFrame, texts: DataFrame) -> DataFrame:
    """``rows`` with a key's set as ``s`` and, as ``w``, the parities of how many of its hashes
    fall on each of 64 * WORDS places."""
    sets = (texts.join(rows.select("key").distinct(), "key", "left_semi")
            .select("key", F.explode(F.array(_hashes(F.col("line")))).alias("s")))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("h").bitwiseAND(63).cast("int"))
    word = F.shiftright("h", 6).bitwiseAND(WORDS - 1)
    parity = [F.bit_xor(F.when(word == k, bit).otherwise(F.lit(0).cast("bigint"))) for k in range(WORDS)]
    words = saved(sets.select("key", F.explode("s").alias("h")).groupBy("key").agg(F.array(*parity).alias("w")),
                  "words")
    return rows.join(sets, "key").join(words, "key")


def _like(x: Column, y: Column, percent: int) -> Column:
    """Whether two sets are alike. Those of too different sizes are not met, nor those whose
    parities differ in more places than like sets have elements apart: each such place has one."""
    n, m = F.size(x["s"]), F.size(y["s"])
    apart = reduce(lambda a, b: a + b, [F.bit_count(F.get(x["w"], F.lit(k)).bitwiseXOR(F.get(y["w"], F.lit(k))))
                                        for k in range(WORDS)])
    # 100 * shared >= percent * (n + m - shared), with the sets met once
    return ((100 * F.least(n, m) >= percent * F.greatest(n, m))
            & ((100 + percent) * apart <= (100 - percent) * (n + m))
            & ((100 + percent) * F.size(F.array_intersect(x["s"], y["s"])) >= percent * (n + m)))


def _within(left: DataFrame, linked: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between components: all like lines of what leaders left in a bucket."""
    of = linked.select(F.col("node").alias("key"), "component")
    members = saved(left.select("bucket", F.col("member").alias("key")).join(of, "key", "left")
                    .select("bucket", "key", F.coalesce("component", "key").alias("c")), "left")
    counts = (members.join(texts.select("key", "n"), "key").groupBy("bucket")
              .agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.ceil(F.greatest(
                  F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias("n_blocks"))
              .where("lo < hi").select("bucket", "n_blocks"))
    dealt = (_dealt(members.join(saved(counts, "left-blocks"), "bucket"), "n_blocks", "n_blocks")
             .select("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
                     "own", "c", "key"))
    member = F.struct("c", "s", "w")
    grouped = (_with_sets(dealt, texts)
               .groupBy("bucket", "i", "j").agg(
                   F.collect_list(F.when(F.col("own") == F.col("i"), member)).alias("xs"),
                   F.collect_list(F.when(F.col("own") == F.col("j"), member)).alias("ys")))

    def of_one(x: Column) -> Column:
        new = lambda y: (x["c"] < y["c"]) | ((x["c"] != y["c"]) & (F.col("i") != F.col("j")))
        return F.transform(F.filter("ys", lambda y: new(y) & _like(x, y, percent)),
                           lambda y: F.struct(x["c"].alias("a"), y["c"].alias("b")))

    return grouped.select(F.explode(F.array_distinct(F.flatten(F.transform("xs", of_one)))).alias("link")
                          ).select("link.a", "link.b")


def _across(compared: DataFrame, linked: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` between components: lines near a leader that are like a line linked to it.

    A line that is linked to a leader is not compared further in that bucket. What is like it
    is, as distances add up, near the same leader: at ``2 * percent - 100`` or more. So these
    are all the pairs of a bucket that no leader has met; those of one component are left out.
    """
    of = linked.select(F.col("node"), F.col("component"))
    near = (compared.where("not hit").select("a", "b").distinct()
            .join(of.toDF("a", "ca"), "a", "left").join(of.toDF("b", "cb"), "b", "left")
            .select("b", F.col("a").alias("key"), F.coalesce("ca", "a").alias("ca"),
                    F.coalesce("cb", "b").alias("cb")).where("ca != cb"))
    near = saved(near, "near")
    held = saved(compared.where("hit").select("b", F.col("a").alias("key")).distinct()
                 .join(near.select("b").distinct(), "b", "left_semi"), "held")
    sizes = texts.select("key", "n")

    def blocks(members: DataFrame, name: str) -> DataFrame:
        return (members.join(sizes, "key").groupBy("b").agg(F.ceil(F.greatest(
            F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_SHINGLES)).cast("int").alias(name)))

    counts = saved(blocks(near, "n_near").join(blocks(held, "n_held"), "b"), "blocks")
    left = (_dealt(near.join(counts, "b"), "n_near", "n_held")
            .select("b", F.col("own").alias("i"), F.col("other").alias("j"), "key", "ca", "cb"))
    right = (_dealt(held.join(counts, "b"), "n_held", "n_near")
             .select("b", F.col("other").alias("i"), F.col("own").alias("j"), "key",
                     F.lit(None).cast("bigint").alias("ca"), F.lit(None).cast("bigint").alias("cb")))
    both = _with_sets(left.unionByName(right), texts)
    grouped = both.groupBy("b", "i", "j").agg(
        F.max("cb").alias("cb"),
        F.collect_list(F.when(F.col("ca").isNotNull(), F.struct("ca", "s", "w"))).alias("xs"),
        F.collect_list(F.when(F.col("ca").isNull(), F.struct("s", "w"))).alias("ys"))

    found = F.filter("xs", lambda x: F.exists("ys", lambda y: _like(x, y, percent)))
    return grouped.select("cb", F.explode(F.array_distinct(F.transform(found, lambda x: x["ca"])))
                          .alias("ca")).select(F.col("ca").alias("a"), F.col("cb").alias("b"))


def _joined(compared: DataFrame, texts: DataFrame, percent: int, left: Sequence[DataFrame] = ()) -> DataFrame:
    """``node, component`` of the lines linked by leaders, across components or among those left."""
    linked = components(compared.where("hit"))
    more = _across(compared, linked, texts, percent)
    for rest in left:
        more = more.unionByName(_within(rest, linked, texts, percent))
    more = saved(more, "across")
    if more.isEmpty():
        return linked
    upper = components(more).toDF("one", "above")
    return linked.join(upper, F.col("component") == F.col("one"), "full").select(
        F.coalesce("node", "one").alias("node"), F.coalesce("above", "component").alias("component"))


def line_components(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """``id, text_key, line_no, first_id, first_key, first_line`` of every line that has a
    like one: where it stands, and where the first line of its component stands. Lines
    count from 0; ``text_key`` is ``xxhash64(text)``.

    Two lines are alike if the Jaccard similarity of their sets of 7-character shingles is
    ``percent`` or more; a line of up to 7 characters is its only shingle. Lines of a bucket
    are compared with its leader; those not linked to it with four leaders of their own; what is
    left, with each other in blocks, or, while a bucket has many, with further leaders. Lines near
    a leader are then compared with those linked to it, so that components are those of all pairs
    of a bucket. Sets are compared by 64-bit hashes of shingles. The first line is the one of the
    smallest id, then text and place. Blank lines and null texts hold no line. Ids are integers; null
    ids come last. Rows repeated with their id and text are one document. Other columns are
    not read.
    """
    lines = saved(_lines(docs, id_col, text_col), "lines")
    bands = _signatures(lines).select("key", F.explode(F.array(*[
        F.xxhash64(F.lit(b), *[F.col(f"m{b * ROWS + r}") for r in range(ROWS)])
        for b in range(BANDS)])).alias("bucket"))
    # The smallest key leads. The frame grows by a row, so that no bucket is held in memory.
    before = Window.partitionBy("bucket").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = saved(bands.select("bucket", F.col("key").alias("a"), F.first("key").over(before).alias("b"))
                  .where("a != b"), "members")
    among = saved(first.select(F.explode(F.array("a", "b")).alias("key")).distinct(), "among")
    texts = saved(_passing(lines.select("key", "line"), "key",
                           saved(_filter_of(among, "key"), "filter"))
                  .dropDuplicates(["key"]).join(among, "key", "left_semi")
                  .withColumn("n", F.size(_hashes(F.col("line")))), "texts")
    near = max(0, 2 * percent - 100)
    left: list[DataFrame] = []
    compared = leader_rounds(first, lambda pairs: _similar(pairs, texts, percent, near), left, after=2)
    return _placed(lines, _joined(saved(compared.distinct(), "compared"), texts, percent, left))


def _placed(lines: DataFrame, found: DataFrame) -> DataFrame:
    """Every place of lines that occur again, alike or linked, with its component's first."""
    places = lines.select("id", "text_key", "line_no", "key")
    again = places.groupBy("key").count().where("count > 1").select("key")
    named = (again.join(found.withColumnRenamed("node", "key"), "key", "full")
             .select("key", F.coalesce("component", "key").alias("component")))
    placed = saved(places.join(saved(named, "named"), "key").drop("key"), "placed")
    first = placed.groupBy("component").agg(F.min(F.struct(
        F.col("id").isNull().alias("last"), "id", "text_key", "line_no")).alias("first"))
    return placed.join(saved(first, "first"), "component").select(
        "id", "text_key", "line_no", F.col("first.id").alias("first_id"),
        F.col("first.text_key").alias("first_key"), F.col("first.line_no").alias("first_line"))


def without_repeated_lines(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id",
                           text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """The documents without lines that repeat an earlier one; a document whose lines are
    all gone stays, with an empty text. ``length_col``, if it is a column, follows."""
    places = line_components(docs, percent, id_col, text_col)
    gone = places.where(~(F.col("id").eqNullSafe(F.col("first_id"))
                          & (F.col("text_key") == F.col("first_key"))
                          & (F.col("line_no") == F.col("first_line"))))
    own_id, key, lost, lines = unused(docs, "own_id", "key", "lost", "lines")
    gone = saved(gone.groupBy(F.col("id").alias(own_id), F.col("text_key").alias(key))
                 .agg(F.collect_set("line_no").alias(lost)), "gone")  # of one document
    joined = docs.join(gone, docs[id_col].cast("bigint").eqNullSafe(F.col(own_id))
                       & (F.xxhash64(text_of(text_col)) == F.col(key)), "left")
    parts = F.split(F.col(text_col), "\n")
    kept = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(lost)))
    rest = F.array_join(F.transform(kept, lambda i: F.get(F.col(lines), i)), "\n")
    joined = joined.withColumn(lines, F.when(F.col(lost).isNotNull(), parts))
    text = F.when(F.col(lost).isNull(), F.col(text_col)).otherwise(rest)
    out = {text_col: text}
    if length_col in docs.columns:
        out[length_col] = F.when(F.col(lost).isNull(), F.col(length_col)).otherwise(
            F.length(rest)).cast(docs.schema[length_col].dataType)
    return joined.select(*[out[c].alias(c) if c in out else F.col(c) for c in docs.columns])
