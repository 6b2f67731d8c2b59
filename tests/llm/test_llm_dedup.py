"""Exact, near and line dedup against brute force."""

import hashlib
import itertools
import random
import re
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fleetlens.llm import exact_dedup, line_dedup, near_dedup
from fleetlens.llm.components import components
from fleetlens.llm.leaders import leader_rounds
from fleetlens.llm.shingles import Shingler

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
ODD = [(1, "a  b\tc"), (2, "a b c"), (3, None), (4, ""), (5, " "), (5, " "), (6, "a b c"), (6, "a b c"),
       (None, "a b c"), (None, "only me"), (7, "x" * 50000), (8, "x" * 50000), (9, "A b c")]


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)


def sample(spark):
    if not Path(SF_DIR).is_dir():
        pytest.skip("no test data")
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def similar(sets, percent):
    """Pairs of keys whose sets have a similarity of ``percent`` or more."""
    seen = defaultdict(list)
    for key in sorted(sets):
        both = Counter(other for item in sets[key] for other in seen[item])
        for other, n in both.items():
            if 100 * n >= percent * (len(sets[key]) + len(sets[other]) - n):
                yield other, key
        for item in sets[key]:
            seen[item].append(key)


# Exact ------------------------------------------------------------------------------

def exact_brute(rows):
    body = [re.sub(r"[\x20\x09-\x0D]+", " ", t or "") for _, t in rows]
    groups = defaultdict(list)
    for (i, _), b in zip(rows, body):
        groups[b].append(i)
    keep = {b: min((i for i in ids if i is not None), default=None) for b, ids in groups.items()}
    return sorted(((i, keep[b], len(groups[b]), hashlib.sha256(b.encode()).hexdigest())
                   for (i, _), b in zip(rows, body)), key=str), groups


@pytest.mark.parametrize("digest", [exact_dedup.md5_128, lambda t: F.lit(b"same"),
                                    lambda t: F.length(t).cast("string").cast("binary")])
def test_exact_groups(spark, digest):
    """Also with digests that collide all the time."""
    docs = frame(spark, ODD).withColumns({c: F.lit("x") for c in ("keep_id", "digest", "body", "id", "sha")})
    rows = exact_dedup.exact_groups(docs, digest=digest).collect()
    want, groups = exact_brute(ODD)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str) == want
    kept = Counter(r.text_sha256 for r in rows if r.kept)
    assert len(kept) == len(groups) and set(kept.values()) == {1}
    assert all(r.doc_id == r.keep_id for r in rows if r.kept)


def test_exact_groups_of_nothing(spark):
    assert exact_dedup.exact_groups(frame(spark, [])).count() == 0


# Components -------------------------------------------------------------------------

def test_components(spark):
    draw = random.Random(5)
    links = [(draw.randrange(200), draw.randrange(200)) for _ in range(110)]
    links += [(n, n + 1) for n in range(300, 360)] + [(400, n) for n in range(401, 460)] + [(7, 7)]
    got = components(spark.createDataFrame([*links, (None, 3)], "a BIGINT, b BIGINT")).collect()
    ends = {n for a, b in links if a != b for n in (a, b)}
    assert {r.node: r.component for r in got} == roots(ends, [x for x in links if x[0] != x[1]])
    assert components(spark.createDataFrame([], "a BIGINT, b BIGINT")).count() == 0


# Near -------------------------------------------------------------------------------

def word_sets(rows, size):
    sets = {}
    for i, text in rows:
        words = (text or "").encode().lower().split()
        sets[i] = frozenset(tuple(words[j:j + size]) for j in range(len(words) - size + 1)) or (
            frozenset([tuple(words)]) if words else frozenset())
    return sets


@pytest.mark.parametrize("size", [1, 3, 5])
def test_shingle_sets(size):
    texts = ["", " ", "one", "a b", "A b\tC d\x0be", "é É è", "x y z x y z x y z", "w " * 500]
    _, bounds = Shingler(size).sets([t.encode() for t in texts])
    want = word_sets(enumerate(texts), size)
    assert [b - a for a, b in zip(bounds, bounds[1:])] == [len(want[i]) for i in range(len(texts))]


@pytest.mark.parametrize("size, percent", [(3, 85), (5, 80)])
def test_near_duplicates(spark, size, percent):
    rows = [(r.doc_id, r.text) for r in sample(spark).collect()]
    draw, words = random.Random(3), [f"w{n}" for n in range(400)]
    base = [draw.choice(words) for _ in range(120)]
    for n in range(150):  # a family of which some members are not like its first one
        copy = list(base)
        for _ in range(draw.choice([0, 1, 2, 3, 4, 6])):
            copy[draw.randrange(len(copy))] = draw.choice(words)
        rows.append((10_000 + n, " ".join(copy)))
    rows += [(20_000, None), (20_001, ""), (20_002, "\t "), (20_003, "Two words"), (20_004, "two  WORDS")]
    docs = frame(spark, rows).withColumns({c: F.lit(1) for c in ("id", "rep", "bucket", "component")})
    got = near_dedup.near_duplicates(docs, size, percent).collect()
    sets = word_sets(rows, size)
    want = roots(sets, similar({k: s for k, s in sets.items() if s}, percent))
    assert {r.doc_id: r.component_id for r in got} == want
    assert {r.doc_id: r.n_shingles for r in got} == {k: len(s) for k, s in sets.items()}
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_links_of_documents_that_leave_a_bucket_early(spark):
    """A leads the others by half its text; B, which is like A, is near them, but not enough."""
    a = [f"a{n}" for n in range(500)]
    b = a[:488] + [f"b{n}" for n in range(12)]
    others = [(n, " ".join(a[158:] + [f"o{n}.{i}" for i in range(168)])) for n in range(300)]
    rows = [*others, (1000, " ".join(a)), (1001, " ".join(b))]
    sets = word_sets(rows, 3)
    like = [len(sets[i] & sets[0]) / len(sets[i] | sets[0]) for i in (1000, 1001)]
    assert like[0] > 0.5 > like[1] > 0.47
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame(spark, rows), 3, 85).collect()}
    assert got == {**{n: n for n, _ in others}, 1000: 1000, 1001: 1000}


def test_near_duplicates_with_odd_ids(spark):
    got = near_dedup.near_duplicates(frame(spark, ODD)).collect()
    assert len(got) == len(ODD)
    by = defaultdict(set)
    for r in got:
        by[r.doc_id].add((r.component_id, r.kept))
    assert by[2] == {(1, False)} and by[9] == {(1, False)} and by[1] == {(1, True)}
    assert by[None] == {(1, False), (None, True)} and by[3] == {(3, True)} and by[8] == {(7, False)}
    assert near_dedup.near_duplicates(frame(spark, [])).count() == 0


def test_without_near_duplicates(spark):
    docs = frame(spark, ODD).withColumns({"_id": F.lit(0), "own_id": F.lit(0), "key": F.lit(0)})
    left = near_dedup.without_near_duplicates(docs)
    assert left.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == Counter(
        [ODD[0], *ODD[2:6], (None, "only me"), ODD[10]])


# Lines ------------------------------------------------------------------------------

def line_brute(rows):
    places = [(i, n, line.strip(" \t\r\x0b\x0c").lower()) for i, text in rows
              for n, line in enumerate((text or "").split("\n"))]
    places = [p for p in places if p[2]]
    sets = {line: frozenset(line[j:j + 7] for j in range(max(1, len(line) - 6))) for _, _, line in places}
    of = roots(sets, similar(sets, 80))
    groups = defaultdict(list)
    for i, n, line in places:
        groups[of[line]].append((i, n))
    return {(p, min(g)) for g in groups.values() if len(g) > 1 for p in g}


def test_line_components(spark):
    rows = [(r.doc_id, r.text) for r in sample(spark).collect()]
    rows += [(50_001, "short\nshort one\n\n  SHORT \nthe quick brown fox jumps over the lazy dog today"),
             (50_002, "the quick brown fox jumps over the lazy dog todaY!\nshort"), (50_003, None),
             (50_004, "日本語の行がここにあります、長い文\nab"), (50_005, "日本語の行がここにあります、長い文。")]
    docs = frame(spark, rows).withColumns({c: F.lit(1) for c in ("id", "key", "line", "bucket")})
    got = line_dedup.line_components(docs).collect()
    assert {((r.id, r.line_no), (r.first_id, r.first_line)) for r in got} == line_brute(rows)


def edited(draw, line, n):
    """The line with ``n`` letters put in place of others."""
    line = list(line)
    for at in draw.sample(range(len(line)), n):
        line[at] = draw.choice("abcdefghijklmnopqrstuvwxyz")
    return "".join(line)


def prose(draw, n_words):
    return " ".join("".join(draw.choices("abcdefghijklmnop", k=draw.randint(2, 8))) for _ in range(n_words))


def test_families_of_lines(spark):
    """Families of which many members are not like their leader, but like one that is."""
    draw = random.Random(9)
    rows = []
    for family in range(6):
        base = prose(draw, 40)
        lines = [edited(draw, base, draw.choice([0, 1, 2, 3, 4, 5])) for _ in range(40)]
        rows += [(family * 1000 + n, line) for n, line in enumerate(lines)]
    got = line_dedup.line_components(frame(spark, rows)).collect()
    assert {((r.id, r.line_no), (r.first_id, r.first_line)) for r in got} == line_brute(rows)


def test_links_across_components(spark):
    """Every pair that leaders of one bucket leave out is found, also in many blocks."""
    draw = random.Random(4)
    rows = []
    for _ in range(5):
        base = prose(draw, 30)
        rows += [edited(draw, base, draw.choice([0, 2, 3, 4, 5])) for _ in range(50)]
    sets = {n: frozenset(t[j:j + 7] for j in range(len(t) - 6)) for n, t in enumerate(rows)}
    texts = spark.createDataFrame([(n, t, len(sets[n])) for n, t in enumerate(rows)], "key BIGINT, line STRING, n INT")
    pairs = spark.createDataFrame([(0, n, 0) for n in range(1, len(rows))], "bucket BIGINT, a BIGINT, b BIGINT")
    compared = line_dedup.leader_rounds(pairs, lambda p: line_dedup._similar(p, texts, 80, 60)).distinct()
    want = roots(sets, similar(sets, 80))
    for block in (256, 7):
        line_dedup.BLOCK, before = block, line_dedup.BLOCK
        try:
            got = {r.node: r.component for r in line_dedup._joined(compared, texts, 80).collect()}
        finally:
            line_dedup.BLOCK = before
        assert {n: got.get(n, n) for n in sets} == want
    direct = roots(sets, [(r.a, r.b) for r in compared.where("hit").collect()])
    assert direct != want  # leaders alone lose some


def test_what_leaders_leave_is_not_paired(spark):
    """Members that are like none make few comparisons; every pair is compared or left together."""
    m, made, left = 120, [], []
    pairs = spark.createDataFrame([(0, n, 0) for n in range(1, m)], "bucket BIGINT, a BIGINT, b BIGINT")

    def compare(pairs):
        made.extend((r.b, r.a) for r in pairs.collect())
        return pairs.withColumn("hit", F.lit(False))

    leader_rounds(pairs, compare, left, after=2)
    rest = sorted(r.member for rows in left for r in rows.collect())
    assert len(made) < 5 * m
    assert set(made) | set(itertools.combinations(rest, 2)) == set(itertools.combinations(range(m), 2))


@pytest.mark.parametrize("block", [256, 5])
def test_like_lines_among_those_left(spark, monkeypatch, block):
    """Lines of one family that are mostly unlike, and a few copies that leaders do not meet."""
    draw, rows = random.Random(6), []
    base = prose(draw, 40)
    for n in range(60):
        line = edited(draw, base, draw.choice([4, 5, 6]))
        rows.append((n, line))
        if n % 6 == 5:
            rows.append((1000 + n, edited(draw, line, 1)))
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    got = line_dedup.line_components(frame(spark, rows)).collect()
    assert {((r.id, r.line_no), (r.first_id, r.first_line)) for r in got} == line_brute(rows)


def test_documents_left_in_a_bucket_meet_in_blocks(spark, monkeypatch):
    """One comparison per member with a leader, whatever a bucket's members are like."""
    made, shared = [], near_dedup._shared
    common, rows = [f"c{n}" for n in range(120)], []
    for n in range(40):  # a third in common: buckets, but no hit with a leader
        rows.append((n, " ".join(common + [f"o{n}.{i}" for i in range(150)])))
    rows += [(100 + n, rows[n][1] + " more") for n in range(0, 40, 7)]
    monkeypatch.setattr(near_dedup, "_shared", lambda p, s: (made.append(p.count()), shared(p, s))[1])
    got = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(frame(spark, rows), 3, 85, bands=8, rows=1).collect()}
    assert got == {i: i % 100 for i, _ in rows}
    assert len(made) == 1


def test_like_lines_of_any_number_of_blanks(spark):
    """Few blanks against many, sparse lines against dense ones, runs of blanks."""
    draw = random.Random(2)
    pairs = []
    for _ in range(6):
        words = ["".join(draw.choices("abcdefghijklmnop", k=n)) for n in (8, 8, 7, 8, 7, 8, 7)]
        pairs.append((" ".join(words), " ".join(words) + " a b c d"))  # 6 blanks, 10 blanks
        long = " ".join("".join(draw.choices("abcdefghijklmnop", k=n)) for n in [28] * 10 + [30])
        pairs.append((long, long + "x"))  # 320 characters, 321
        table = prose(draw, 6) + " " + "".join(draw.choices("abcdefghijklmnop", k=30))
        pairs.append((table.replace(" ", "  ", 1), table.replace(" ", " " * 6, 1)))
    rows = [(2 * n + side, line) for n, pair in enumerate(pairs) for side, line in enumerate(pair)]
    got = line_dedup.line_components(frame(spark, rows)).collect()
    assert {((r.id, r.line_no), (r.first_id, r.first_line)) for r in got} == line_brute(rows)
    assert len(line_brute(rows)) >= 24


def test_without_repeated_lines(spark):
    rows = [(1, "keep this line as it is\nand this other one\n\nkeep this line as it is"),
            (2, "and this other one\nKeep this line as it is\nnew here"), (3, "and this other one"),
            (4, None), (None, "and this other one"), (5, "")]
    docs = frame(spark, rows).withColumns({"n_chars": F.length("text").cast("bigint"), "lost": F.lit(1), "key": F.lit(1)})
    left = line_dedup.without_repeated_lines(docs)
    assert left.columns == docs.columns and left.dtypes == docs.dtypes
    got = {r.doc_id: (r.text, r.n_chars) for r in left.collect()}
    assert got == {1: ("keep this line as it is\nand this other one\n", 43), 2: ("new here", 8), 3: ("", 0),
                   4: (None, None), None: ("", 0), 5: ("", 0)}
    assert line_dedup.without_repeated_lines(frame(spark, [])).count() == 0


def test_line_dedup_is_native(spark):
    plan = line_dedup._signatures(line_dedup._lines(frame(spark, ODD), "doc_id", "text"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", text)


def test_only_lines_with_blanks_at_an_end_are_trimmed(spark):
    ends = ["", " ", "\t\r", "\x0b \x0c", "\u00a0", "é", "\U0001d4b3"]
    texts = [a + body + b for a in ends for body in ("", "x", "A b", "日 É") for b in ends]
    lines = spark.createDataFrame(list(enumerate([*texts, None])), "key BIGINT, raw STRING")
    formed = lines.select("key", line_dedup.line_form(F.col("raw")).alias("line"))
    got = {r.key: r.line for r in formed.collect()}
    assert got == {**{n: t.strip(" \t\r\x0b\x0c").lower() for n, t in enumerate(texts)}, len(texts): None}
    plan = formed._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"CASE WHEN .* THEN trim\(", plan), plan


def test_lines_are_cut_once(spark, monkeypatch):
    """Signatures, texts and places all come from one cutting of the documents."""
    plans, saved = [], line_dedup.saved
    monkeypatch.setattr(line_dedup, "saved", lambda df, label: (
        plans.append(df._jdf.queryExecution().analyzed().toString()), saved(df, label))[1])
    line_dedup.line_components(frame(spark, ODD)).collect()
    assert sum("posexplode" in plan for plan in plans) == 1


def test_signatures_take_every_shingle(spark):
    """The minima of a line are those of its shingles, each a line of its own; also where a
    row of shingles ends, and for characters of any width."""
    draw = random.Random(3)
    letters = "abc dé日𝒳"
    texts = ["".join(draw.choices(letters, k=n)) for n in (1, 6, 7, 8, 21, 22, 23, 24, 38, 39, 40, 200)]
    shingles = {text: {text[j:j + 7] for j in range(max(1, len(text) - 6))} for text in texts}
    every = sorted({*texts, *itertools.chain(*shingles.values())})
    lines = spark.createDataFrame(list(enumerate(every)), "key BIGINT, line STRING")
    got = {every[r.key]: r[1:] for r in line_dedup._signatures(lines).collect()}
    for text, parts in shingles.items():
        assert got[text] == tuple(min(m) for m in zip(*[got[part] for part in parts], strict=True))
    hashes = {r.line: set(r.s) for r in lines.select("line", line_dedup._hashes(F.col("line")).alias("s")).collect()}
    for text, parts in shingles.items():
        assert hashes[text] == {h for part in parts for h in hashes[part]} and len(hashes[text]) == len(parts)
