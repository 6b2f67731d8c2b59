"""Mixing, nearest neighbours, registered queries and the pipeline."""

from collections import Counter
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
import corpus_pipeline
from checks.compare import database, difference
from fleetlens.llm import mixing, permutation_index, queries

SF_DIR = "/root/testdata/sf0.001"
DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
needs_data = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test data")


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (1, 2, 3)[n % 3] for n, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(3 * sizes[s] for s in full)
        rest = sum(weight[s] for s in names if s not in full)
        above = {s for s in names if s not in full and weight[s] * left > 3 * sizes[s] * rest}
        if not above:
            return {s: 3.0 * sizes[s] if s in full else weight[s] * left / rest for s in names}
        full |= above


def documents(spark, n=3000):
    rng = np.random.default_rng(2)
    rows = []
    for i in range(n):
        source = [None, "a", "b", "ä", "z"][int(rng.choice(5, p=[.02, .6, .05, .3, .03]))]
        rows.append((i, " ".join(["w"] * int(rng.integers(0, 60))), "en", source, 0))
    return spark.createDataFrame(rows, DOCS)


def test_mix(spark):
    docs = documents(spark).withColumns({c: F.lit(1) for c in ("size", "part", "copies", "of")})
    rows = mixing.mix(docs).collect()
    sizes = Counter()
    for r in rows:
        sizes[r.source] += r.size
    want = brute_targets(sizes)
    taken = Counter()
    for r in rows:
        assert r.target == pytest.approx(want[r.source]) and 0 <= r.copies <= 3
        assert abs(r.copies - r.target / r.source_size) < 1 or r.size == 0
        taken[r.source] += r.copies * r.size
    assert all(abs(taken[s] - want[s]) <= 30.001 for s in want)  # half a document
    again = mixing.mix(docs.repartition(7)).collect()
    assert {r.id: r.copies for r in again} == {r.id: r.copies for r in rows}


def test_the_tree_has_several_levels(spark):
    rows = [(str(n), "s", 1 + n % 5, 0.3) for n in range(500)]
    got = mixing.pivotal_round(spark.createDataFrame(rows, "key STRING, source STRING, size BIGINT, part DOUBLE"),
                               fan_in=8).collect()
    assert len(got) == 500 and {r.extra for r in got} == {0, 1}
    words = sum((1 + int(r.key) % 5) * r.extra for r in got)
    assert abs(words - 0.3 * sum(r[2] for r in rows)) <= 2.5


def test_rounding_keeps_expectations():
    rng = np.random.default_rng(4)
    size, part = rng.integers(1, 40, 12).astype(float), rng.uniform(0.05, 0.95, 12)
    mean = np.mean([mixing._round_bucket(size, part, rng.random(12))[0] for _ in range(20000)], 0)
    assert np.abs(mean - part).max() < 0.02


def test_mix_of_odd_rows(spark):
    rows = [(1, None, "en", "s", 0), (2, "", "en", None, 0), (3, "a b", "en", "s", 0), (3, "a b", "en", "s", 0),
            (None, "c", "en", "t", 0)]
    docs = spark.createDataFrame(rows, DOCS)
    got = mixing.mix(docs).collect()
    assert sorted((str(r.id), r.n_rows, r.size) for r in got) == [
        ("1", 1, 0), ("2", 1, 0), ("3", 2, 2), ("None", 1, 1)]
    left = mixing.mixed_documents(docs)
    assert left.columns == docs.columns
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.mixed_documents(docs.limit(0)).count() == 0


def brute_nearest(rows, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v
          and np.isfinite(np.array(v, float)).all() and np.any(v)]
    out = {}
    for i, q in ok:
        if i % 20 == 0:
            scored = sorted((-float((q * v).sum()), j) for j, v in ok if j != i and len(v) == len(q))
            out[i] = [(j, -s) for s, j in scored[:k]]
    return out


@pytest.mark.parametrize("n, dims", [(12, 4), (150, 8)])
def test_small_tables_are_searched_whole(spark, n, dims):
    rng = np.random.default_rng(n)
    rows = [(i, rng.normal(size=dims).round(3).tolist()) for i in range(n)]
    rows += [(200 + i, rows[1][1]) for i in range(60)]  # one very common vector
    rows += [(1000, None), (1020, [0.0] * dims), (1040, [float("nan")] * dims), (1060, [None] * dims), (None, [1.0] * dims)]
    frame = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>").withColumn("rep", F.lit(1))
    got = permutation_index.nearest(frame, lambda i: i % 20 == 0, k=20).collect()
    want = brute_nearest(rows, 20)
    assert {r.query_id for r in got} == set(want)
    for q, best in want.items():
        mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [m[:2] for m in mine] == [(n + 1, j) for n, (j, _) in enumerate(best)]
        assert [m[2] for m in mine] == pytest.approx([s for _, s in best], abs=1e-12)
    assert permutation_index.nearest(frame.limit(0), lambda i: i % 20 == 0).count() == 0


@needs_data
def test_recall(spark):
    vectors = spark.read.parquet(f"{SF_DIR}/embeddings.parquet")
    got = permutation_index.nearest(vectors, lambda i: i % 20 == 0, k=20).collect()
    want = brute_nearest([(r.vec_id, r.embedding) for r in vectors.collect()], 20)
    found = {(r.query_id, r.vec_id) for r in got}
    right = [(q, j) in found for q, best in want.items() for j, _ in best]
    assert sum(right) >= 0.9 * len(right)


@pytest.mark.parametrize("sigma", [0.0, 0.6, 1.0])
def test_recall_with_lengths_of_any_spread(spark, sigma):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(4000, 48)) * rng.lognormal(0, sigma, size=(4000, 1))
    rows = [(i, v.round(4).tolist()) for i, v in enumerate(x)]
    frame = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<DOUBLE>")
    got = permutation_index.nearest(frame, lambda i: i % 20 == 0, k=20).collect()
    found = {(r.query_id, r.vec_id) for r in got}
    want = brute_nearest(rows, 20)
    right = [(q, j) in found for q, best in want.items() for j, _ in best]
    assert len(want) == 200 and sum(right) >= 0.9 * len(right)


@needs_data
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_sql(spark, name):
    assert difference(spark, database(SF_DIR), name, SF_DIR) is None


@needs_data
def test_pipeline(spark):
    assert registered.queries()["pipeline"] is corpus_pipeline.run
    assert [len([q for q in registered.queries() if q.startswith(f"op{n}_")]) for n in range(1, 14)] == [1] * 13
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = {r.doc_id for r in docs.collect()}
        docs = corpus_pipeline.saved(stage(spark, docs, SF_DIR), name)
        assert docs.columns == columns and {r.doc_id for r in docs.collect()} <= before, name
    kept = Counter(r.doc_id for r in docs.collect())
    assert 0 < len(kept) < len(ids) and max(kept.values()) <= 3
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).collect()
    assert Counter(r.doc_id for r in packed if r.start == 0) == kept
