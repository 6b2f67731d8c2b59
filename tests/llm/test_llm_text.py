"""Tokens, packing, personal data, URLs and toxicity."""

import random
import re
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetlens.llm import packing, pii, token_counts, toxicity, url_filter
from fleetlens.llm.queries import RULES, TOKENIZER, VOCABULARY
from fleetlens.llm.tokens import encoder
from fleetlens.session import scratch_dir

SF_DIR = "/root/testdata/sf0.01"
DOCS = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
TEXTS = [None, "", " ", "one", "two  blanks", " lead and trail ", "<|endoftext|> inside", "日本語 text", "é è ñ ß ſ",
         "don't we'll I'M 'tis", "a\n\n\nb\t\tc\r\n", "x" * 3000, "1234567 89 ²³", "\x00\x1c\x85\xa0z", "naïve café " * 800]


def frame(spark, texts):
    return spark.createDataFrame([(n, t, "en", "s", 0) for n, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(public_tokenizers.path(TOKENIZER))
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(max_codepoint=0x250), st.sampled_from(" \n'ab1.")), max_size=60))
def test_ids_are_the_librarys(text):
    e = encoder(TOKENIZER)
    assert e.ids(text) == e.tokenizer.encode(text, add_special_tokens=False).ids


def test_token_counts_and_cache(spark, library):
    docs = frame(spark, [*TEXTS, "one", "one"]).withColumns({"digest": F.lit(1), "n_tokens": F.lit(1)})
    cache = scratch_dir(spark, "cache")
    got = token_counts.token_counts(docs, cache=cache).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {n: len(library(t)) for n, t in enumerate([*TEXTS, "one", "one"])}
    assert all(r.n_bytes == len(([*TEXTS, "one", "one"][r.doc_id] or "").encode()) for r in got)
    stored = spark.read.parquet(cache)
    assert stored.count() == len({t or "" for t in TEXTS})  # each text once
    again = token_counts.token_counts(frame(spark, ["one", "new"]), cache=cache).collect()
    assert {r.doc_id: r.n_tokens for r in again} == {0: len(library("one")), 1: len(library("new"))}
    assert spark.read.parquet(cache).count() == stored.count() + 1
    # Another version of the tokenizer does not see these counts.
    assert token_counts.stored_counts(spark, cache, "other").count() == 0
    assert token_counts.token_counts(frame(spark, [])).count() == 0


def check_packing(rows, ids_of):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    for doc, want in ids_of.items():
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(want))
            assert bytes(r.ids) == np.array(want[at:at + r.length], "<u4").tobytes()
            at += r.length
        assert at == len(want)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= pieces[0].tier and len({r.step_group for r in pieces}) == 1
    return {k: (v[0].tier, sum(r.length for r in v), v[0].step_group) for k, v in by_sequence.items()}


def test_packing_round_trip(spark, library):
    texts = TEXTS + [" ".join(["word"] * n) for n in range(0, 900, 37)]
    docs = frame(spark, texts).withColumns({"ids": F.lit(1), "start": F.lit(2)}).repartition(2, "doc_id")
    rows = packing.pack(docs, lambda: encoder(TOKENIZER).encode).collect()
    sequences = check_packing(rows, {n: library(t) + [0] for n, t in enumerate(texts)})
    assert sum(length < tier for tier, length, _ in sequences.values()) <= 2  # one per partition
    assert packing.pack(frame(spark, []), lambda: encoder(TOKENIZER).encode).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 5000), max_size=60))
def test_tier_packer(lengths):
    packer = packing.TierPacker()
    for n, length in enumerate(lengths):
        packer.add(n, length)
        if n % 7 == 0:
            packer.pack(1023)
    packer.finish()
    seen = {}
    for tier, pieces in packer.windows:
        assert sum(p[2] for p in pieces) <= tier
        for document, start, length in pieces:
            seen.setdefault(document, []).append((start, length))
    for n, length in enumerate(lengths):
        at = 0
        for start, size in sorted(seen[n]):
            assert start == at
            at += size
        assert at == length
    assert sum(sum(p[2] for p in pieces) < tier for tier, pieces in packer.windows) <= 1


def test_step_groups_are_full():
    groups, held = packing.StepGroups(4096), {}
    tiers = sorted(random.Random(1).choices(packing.TIERS, k=500), reverse=True)
    for tier in tiers:
        group = groups.place(tier)
        held[group] = held.get(group, 0) + tier
    assert sorted(held.values())[1:] == [4096] * (len(held) - 1)


# Personal data ----------------------------------------------------------------------

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
        "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = [int(d) for d in m.group() if d.isdigit()]
            doubled = [d if i % 2 == 0 else 2 * d - 9 * (d > 4) for i, d in enumerate(reversed(digits))]
            if (kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m.group().split("."))
                    or kind == "card" and 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
                    or kind == "phone" and 10 <= len(digits) <= 15):
                out.append((kind, *m.span()))
    return out


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from(["a", "@", ".", "1", "22", "555", "-", " ", "+", "(", "99999", "b@x.y", "1.2.3.4",
                                 "4111111111111111", "é", "256", "00"]), max_size=18).map("".join))
def test_plain_spans(text):
    assert pii.plain_spans(text) == base_spans(text)


@pytest.mark.parametrize("text, want", [
    ("mail john.doe [at] example [dot] com now", [("email", "john.doe [at] example [dot] com")]),
    ("john at example dot com", [("email", "john at example dot com")]),
    ("jоhn@exаmple.com", [("email", "jоhn@exаmple.com")]),
    ("plus four one five five five one two three four five six",
     [("phone", "plus four one five five five one two three four five six")]),
    ("192 dot 168 dot 1 dot 1", [("ip", "192 dot 168 dot 1 dot 1")]),
    ("４１１１ 1111 1111 1111", [("card", "４１１１ 1111 1111 1111")]),
    ("abc​@x.org", [("email", "abc​@x.org")]),
    ("we met at noon. dot matrix at home", []), ("one two three", []), ("", []),
])
def test_disguised_spans(text, want):
    plain, added = pii.find_spans(text)
    found = {(kind, text[a:b]) for kind, a, b in added} | {(kind, text[a:b]) for kind, a, b in plain}
    assert set(want) <= found and len(added) <= len(want)
    assert plain == base_spans(text)


@pytest.mark.parametrize("text, want", [
    ("card 4111 1111 1111 111 one", [("card", "4111 1111 1111 111 one")]),
    ("card four 111 1111 1111 1111.", [("card", "four 111 1111 1111 1111")]),
    ("call +1 555 010 four 321 now", [("phone", "+1 555 010 four 321")]),
    ("plus four, one, five, five, five, one, two, three, four, five",
     [("phone", "plus four, one, five, five, five, one, two, three, four, five")]),
    ("+four  one\nfive 555 1234 FIVE", [("phone", "+four  one\nfive 555 1234 FIVE")]),
    ("192 dot 168 dot one dot 1", [("ip", "192 dot 168 dot one dot 1")]),
    ("４１１１ 1111 1111 1111 one more", [("card", "４１１１ 1111 1111 1111")]),
    ("no one has 12 phones", []), ("someone 4111 1111 1111 111", []), ("4111 1111 1111 111 ones", []),
    ("4111 1111 1111 1111 one", []),
])
def test_single_number_words(text, want):
    plain, added = pii.find_spans(text)
    assert [(kind, text[a:b]) for kind, a, b in added] == want
    assert plain == base_spans(text)


def test_disguised_never_touch_plain(spark):
    text = "a@b.cc dot org and +1 (487) 555-7209 one two"
    plain, added = pii.find_spans(text)
    assert [s[0] for s in plain] == ["email", "phone"] and not added
    rows = frame(spark, [text, None, "", "x" * 20000]).select("doc_id", pii.pii_spans().alias("s")).collect()
    assert [len(r.s) for r in sorted(rows)] == [2, 0, 0, 0]


# URLs -------------------------------------------------------------------------------

@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("http://A.Example.NET/en/1?x=casino", "a.example.net", "/en/1", "example.net/en/", "allow"),
    ("http://example.net", "example.net", "", None, "allow"), ("http://x.net/", "x.net", "/", "net/", "block"),
    ("http://notnet/", "notnet", "/", None, "allow"), ("http://net/", "net", "/", "net/", "block"),
    ("http://m.casino-win.example.com/en/", "m.casino-win.example.com", "/en/", None, "block"),
    ("http://casinos.example.com/", "casinos.example.com", "/", None, "allow"),
    ("http://free.example.com/free", "free.example.com", "/free", None, "allow"),
    ("http://free.example.com/Bets?a#b", "free.example.com", "/Bets", None, "block"),
    ("casino", "", "", None, "block"), (None, "", "", None, "allow"), ("", "", "", None, "allow"),
    ("a://b://c/d", "b:", "//c/d", None, "allow"), ("http://h?q/../", "h", "", None, "allow"),
])
def test_urls(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, "x", 3)], "page_id BIGINT, url STRING, host STRING, hits INT")
    r = url_filter.judge_urls(pages, VOCABULARY, RULES).first()
    assert (r.page_id, r.host, r.path, r.rule, r.verdict) == (1, host, path, rule, verdict)


def test_no_vocabulary(spark):
    pages = spark.createDataFrame([(1, "http://casino.x/")], "page_id BIGINT, url STRING")
    assert url_filter.judge_urls(pages, url_filter.Vocabulary((), ())).first().verdict == "allow"
    assert url_filter.judge_urls(pages.limit(0), VOCABULARY).count() == 0


# Toxicity ---------------------------------------------------------------------------

def test_held_out_accuracy(spark):
    if not Path(SF_DIR).is_dir():
        pytest.skip("no test data")
    docs, labels = (spark.read.parquet(f"{SF_DIR}/{n}.parquet") for n in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    rows = (docs.join(labels, "doc_id").withColumn("score", toxicity.toxicity(model)).toPandas())
    held = rows[[zlib.crc32(str(i).encode()) % 5 == 0 for i in rows.doc_id]]
    assert ((held.score >= 0.5) == (held.toxic == 1)).mean() >= 0.9
    assert rows.score.between(0, 1).all()
    # Labels that are held out change nothing.
    others = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert toxicity.train(docs, others) == model
    clashing = docs.withColumns({"_id": F.lit(0), "_label": F.lit(1), "id": F.lit(2)})
    assert toxicity.train(clashing, labels.withColumn("_id", F.lit(3))) == model


def test_toxicity_of_odd_tables(spark):
    docs = frame(spark, [None, "", "x " * 40000])
    labels = spark.createDataFrame([(0, 1), (1, None), (None, 1), (77, 0)], "doc_id BIGINT, toxic INT")
    for given_labels in (labels, labels.limit(0)):
        scores = docs.select(toxicity.toxicity(toxicity.train(docs, given_labels)).alias("s")).collect()
        assert len(scores) == 3 and all(0 <= r.s <= 1 for r in scores)


def labelled(alphabet, blank, n, seed=1):
    """Texts of which every sixth is toxic: it holds three of five phrases."""
    draw = random.Random(seed)
    words = ["".join(draw.choices(alphabet, k=draw.randint(2, 7))) for _ in range(500)]
    phrases = ["".join(draw.choices(alphabet, k=9)) for _ in range(5)]
    rows = []
    for i in range(n):
        text = draw.choices(words, k=draw.randint(10, 40))
        for _ in range(3 * (i % 6 == 0)):
            text.insert(draw.randrange(len(text)), draw.choice(phrases))
        rows.append((blank.join(text), int(i % 6 == 0)))
    return rows


@pytest.mark.parametrize("alphabet, blank, n", [
    ("abcdefghijklmnopqrst", " ", 60),  # so few that no word is significant
    ("".join(chr(0x4E00 + 7 * i) for i in range(600)), "", 120),
    ("".join(chr(0x4E00 + 7 * i) for i in range(600)), "", 600)])
def test_recall_of_toxic_rows(alphabet, blank, n):
    rows = labelled(alphabet, blank, 2 * n)
    scorer = toxicity.Scorer(toxicity.learn(*zip(*rows[:n])))
    found = [scorer.score(text) >= 0.5 for text, _ in rows[n:]]
    toxic = [y == 1 for _, y in rows[n:]]
    assert sum(f and y for f, y in zip(found, toxic)) >= 0.6 * sum(toxic)
    assert sum(f == y for f, y in zip(found, toxic)) >= 0.9 * n
