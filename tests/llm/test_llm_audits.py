"""Exact search, source divergence and periodic runs against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlens.llm import divergence, norm_search, periodic_runs, queries

SF_DIR = "/root/testdata/sf0.001"
needs_data = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test data")


def every_twentieth(i):
    return i % 20 == 0


def brute_products(rows, k):
    usable = [(i, v) for i, v in rows if v is not None and None not in v]
    out = []
    for n, (i, q) in enumerate(usable):
        if i is not None and i % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(q, v)), j is None, j or 0)
                            for m, (j, v) in enumerate(usable) if m != n)
            out += [(i, rank, None if none else j, -s) for rank, (s, none, j) in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def searched(spark, rows, kind="array<bigint>", **settings):
    frame = spark.createDataFrame(rows, f"vec_id bigint, embedding {kind}").withColumn("row", F.lit(1))
    frame = frame.withColumn("length", F.lit("x"))
    return sorted(map(tuple, norm_search.top_products(frame, every_twentieth, **settings).collect()), key=str)


@pytest.mark.parametrize("sigma", [0.0, 1.0])
def test_products_equal_brute_force(spark, monkeypatch, sigma):
    for name, value in (("BLOCK", 16), ("GROUP", 4), ("HEAD", 2), ("STEPS", 3)):
        monkeypatch.setattr(norm_search, name, value)
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 12)) * np.linspace(20, 1, 12) * rng.lognormal(0, sigma, size=(400, 1))
    rows = [(i, np.floor(v).astype(int).tolist()) for i, v in enumerate(x)]
    rows += [(1000 + i, rows[3][1]) for i in range(120)]  # one very common vector
    assert searched(spark, rows, k=7) == brute_products(rows, 7)


def test_products_of_odd_vectors(spark):
    rows = [(0, [1, 2]), (20, [3]), (20, [3]), (None, [5, 5]), (3, []), (40, [0, 0]), (5, None), (6, [None]),
            (60, None), (7, [2 ** 30, 1]), (80, [2 ** 31, -1, 4])]
    assert searched(spark, rows, k=3) == brute_products(rows, 3)
    assert searched(spark, [], k=3) == [] and searched(spark, [(20, [1])], k=3) == []
    few = [(20, [1, 1]), (1, [2, 0])]
    assert searched(spark, few) == [(20, 1, 1, 2)]
    assert searched(spark, [(20, [2 ** 62]), (1, [4])]) == [(20, 1, 1, 2 ** 63 - 1)]


@pytest.mark.parametrize("rows", [1, 5, 64])
def test_joint_sums(rows):
    rng = np.random.default_rng(rows)
    for columns in (1, 63, 65, 700):
        for share in (0.0, 0.02, 0.7):
            blocks = []
            for n in (rows, max(1, rows // 2)):
                held = rng.random((n, columns)) < share
                empty = rng.integers(1, 50, n)
                prices = np.where(held, rng.integers(1, 10 ** 9, (n, columns)), empty[:, None])
                blocks.append(((*np.nonzero(held), prices[held], empty), prices))
            for one, other in ((0, 1), (0, 0)):
                p, q = blocks[one][1][:, None], blocks[other][1][None]
                want = ((p - q) ** 2 // (p + q)).sum(2)
                got = divergence.joint_sums(blocks[one][0], blocks[other][0] if one != other else None, columns)
                if one == other:
                    want, got = np.triu(want, 1), np.triu(got, 1)
                assert (got == want).all()


def brute_divergence(rows, min_docs):
    def words(text):
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        return "".join(c if "a" <= c <= "z" or c > "\x7f" else " " for c in text).split(" ")

    docs, counts, groups = Counter(), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        found = [w for w in words(text) if w]
        groups[lang or ""].add(source or "")
        counts[lang or "", source or ""].update(found)
        docs.update((lang or "", w) for w in set(found))
    out = []
    for lang, sources in groups.items():
        kept = [t for (of, t), n in docs.items() if of == lang and n >= min_docs]

        def priced(names):
            mine = [sum(counts[lang, s][t] for s in names) for t in kept]
            return [1 + 10 ** 9 * (n + 2) // (sum(mine) + 2 * len(kept)) for n in mine]

        whole = priced(sources)
        for s in sources:
            p = priced([s])
            for other in sources - {s}:
                out.append((lang, s, other, sum((a - b) ** 2 // (a + b) for a, b in zip(p, priced([other])))))
            out += [(lang, s, "=" + t, (a - b) ** 2 // (a + b))
                    for t, a, b in zip(kept, p, whole) if counts[lang, s][t] and a > b]
    return sorted(out)


def test_divergence_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(divergence, "COLUMNS", 16)
    monkeypatch.setattr(divergence, "ENTRIES", 40)
    monkeypatch.setattr(divergence, "PIECE", 50)
    rng = random.Random(3)
    vocabulary = [chr(97 + i % 26) * (1 + i // 26) for i in range(60)] + ["É", "é", "日本"]
    rows = [(None, None, None), ("", "en", "quiet"), ("Aa aA", "xx", "few"), ("1 2\n", "en", None)]
    for i in range(500):
        lang = rng.choice(["en", "en", "de", None])
        source = f"s{int(90 * rng.random() ** 2)}" if rng.random() < 0.6 else "hot"
        text = rng.choice([" ", "-", "\n9"]).join(rng.choices(vocabulary, range(63, 0, -1), k=rng.randint(0, 30)))
        rows.append((text, lang, source))
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumns(
        {c: F.lit(1) for c in ("n", "term", "row", "mass")})
    audit = divergence.Divergence(docs, min_docs=3)
    got = [tuple(r) for r in audit.pairs().collect()]
    got += [(r.lang, r.source, "=" + r.term, r.value) for r in audit.terms().collect()]
    assert sorted(got) == brute_divergence(rows, 3)
    best = divergence.ranked(audit.terms(), "term", 2).collect()
    assert {r["rank"] for r in best} == {1, 2}
    none = divergence.Divergence(docs.limit(0))
    assert none.pairs().count() == none.terms().count() == 0


def test_large_counts_are_exact(spark):
    row = spark.range(1).select(divergence.price(F.lit(7 * 10 ** 12), F.lit(9 * 10 ** 12 + 1)).alias("p"),
                                divergence.difference(F.lit(10 ** 9 + 1), F.lit(2)).alias("f")).first()
    assert row.p == 1 + 10 ** 9 * (7 * 10 ** 12 + 2) // (9 * 10 ** 12 + 1)
    assert row.f == (10 ** 9 - 1) ** 2 // (10 ** 9 + 3)


def brute_runs(words):
    out = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(6, 4 * q):
                out.setdefault((start, i + q - start), q)
            i += 1
    return sorted((s, q, n) for (s, n), q in out.items())


def collapse(words, runs):
    gone = {i for s, q, n in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_words(rng):
    n = rng.choice([0, 1, 5, 6, 7, 20, 60, 200])
    words = [rng.choice("abcde"[:rng.choice([1, 2, 2, 3, 5])]) for _ in range(n)]
    if n and rng.random() < 0.6:
        a, p = rng.randrange(n), rng.randint(1, max(1, n // 4))
        words = [words[i if i < a else a + (i - a) % p] for i in range(n)]
        words += words[-7:] + words if rng.random() < 0.3 else []
    return words


def test_cover_has_every_difference():
    found = {(a - b) % periodic_runs.SPAN for a in periodic_runs.COVER for b in periodic_runs.COVER}
    assert found == set(range(periodic_runs.SPAN))


def test_extensions_equal_brute_force():
    rng = random.Random(1)
    for _ in range(30):
        words = random_words(rng) + random_words(rng) + ["."]
        coded = np.array([ord(w) for w in words])
        lce = periodic_runs.CommonExtensions(coded)
        pairs = [(i, j) for j in range(len(words)) for i in range(j)][:3000]
        if not pairs:
            continue
        got = lce.between(*np.array(pairs).T)
        for (i, j), n in zip(pairs, got):
            want = next((k for k in range(len(words)) if j + k == len(words) or words[i + k] != words[j + k]), 0)
            assert n == want


@pytest.mark.parametrize("batch, grid", [(200_000, 1_000_000), (50, 7)])
def test_runs_equal_brute_force(spark, monkeypatch, batch, grid):
    monkeypatch.setattr(periodic_runs, "BATCH_WORDS", batch)
    monkeypatch.setattr(periodic_runs, "GRID", grid)
    rng = random.Random(batch)
    texts = [None, "", " \t\n", "a b " * 3, "x" * 70_000] + ["\x0b ".join(random_words(rng)) for _ in range(300)]
    got = periodic_runs._struct([t and t.encode() for t in texts]).to_pylist()
    for text, row in zip(texts, got):
        words = (text or "").replace("\x0b", " ").split()
        runs = brute_runs(words)
        assert [(r["start"], r["period"], r["length"]) for r in row["runs"]] == runs
        assert row["collapsed"].decode() == collapse(words, runs)
    docs = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "text string, runs int")
    found = docs.select("runs", periodic_runs.periodic_runs().alias("r")).select(
        "runs", "r.runs", periodic_runs.strongest("r.runs").alias("best"))
    for i, runs, best in found.collect():
        want = max(runs, key=lambda r: (r.length / r.period, -r.start, -r.period), default=None)
        assert best == want and len(runs) == len(got[i]["runs"])
    assert docs.limit(0).select(periodic_runs.periodic_runs()).count() == 0


def test_a_long_text():
    rng = random.Random(2)
    words = [str(rng.randrange(2000)) for _ in range(300_000)]
    words[100_000:] = [words[100_000 + i % 33_333] for i in range(200_000)]
    words[50_000:50_012] = ["go"] * 12
    row = periodic_runs._struct([" ".join(words).encode()]).to_pylist()[0]
    runs = [(r["start"], r["length"], r["period"]) for r in row["runs"]]
    assert runs == [(50_000, 12, 1), (100_000, 200_000, 33_333)]
    assert len(row["collapsed"].split()) == 300_000 - 11 - (200_000 - 33_333)


@needs_data
def test_runs_of_documents(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    odd = spark.createDataFrame([(None, "a " * 9, None, None, 0), (10 ** 12, None, "en", "s", 0),
                                 (7, "a b c d", "en", "s", 0), (7, "a b c d", "en", "s", 0)], docs.schema)
    docs.limit(150).unionByName(odd).write.parquet(f"{tmp_path}/documents.parquet")
    rows = spark.read.parquet(f"{tmp_path}/documents.parquet").collect()
    want = []
    for r in rows:
        words = [w for w in (r.text or "").translate(dict.fromkeys(range(9, 14), " ")).split(" ") if w]
        if r.doc_id is not None and (h := zlib.crc32(str(r.doc_id).encode())) % 10 == 0 and words:
            n, g = len(words), h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute_runs(words)
        top = max(runs, key=lambda x: (x[2] / x[1], -x[0], -x[1]), default=None)
        best = (top[0], top[2], top[1], 1000 * top[2] // top[1]) if top else (None,) * 4
        lines = "".join(f"{s},{n},{q}\n" for s, q, n in runs)
        want.append((r.doc_id, len(runs), *best, *(hashlib.sha256(t.encode()).hexdigest()
                                                  for t in (lines, collapse(words, runs)))))
    got = queries.op13_periodic_runs(spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert sum(w[1] for w in want) > 5
