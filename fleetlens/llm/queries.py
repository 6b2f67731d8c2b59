"""The registered queries of this subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fleetlens.llm import (divergence, exact_dedup, line_dedup, mixing, near_dedup, norm_search, packing,
                           periodic_runs, permutation_index, pii, token_counts, toxicity, url_filter)
from fleetlens.llm.common import BLANKS, text_of
from fleetlens.llm.tokens import encoder

TOKENIZER = "byte_bpe_50k.json"
#: Words that hosts and paths of pages nobody wants are made of.
VOCABULARY = url_filter.Vocabulary(
    strict=("casino", "porn", "xxx", "spam"),
    soft=("adult", "ads", "bet", "bets", "bonus", "cheap", "escort", "farm", "free", "jackpot",
          "pills", "poker", "sex", "slots", "track", "viagra", "win"))
RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"),
         ("allow", "org/fr/"))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hierarchical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_table(spark, sf_dir, "documents"), lambda: encoder(TOKENIZER).encode)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset", "tier", "step_group")


def op2_fuzzy_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that have a like one, with the first line of their component."""
    places = line_dedup.line_components(_table(spark, sf_dir, "documents"))
    first = (F.col("id").eqNullSafe(F.col("first_id")) & (F.col("text_key") == F.col("first_key"))
             & (F.col("line_no") == F.col("first_line")))
    return places.select(F.col("id").alias("doc_id"), "line_no", F.col("first_id").alias("keep_doc_id"),
                         F.col("first_line").alias("keep_line_no"), first.alias("kept"))


def op3_digest_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(_table(spark, sf_dir, "documents"), TOKENIZER)
    return counts.withColumn("over_limit", F.col("n_tokens") > 512)


def op4_circulant_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), shingle_words=3, percent=85
                                      ).drop("text_key")


def op5_url_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), VOCABULARY, RULES)


def op6_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.nearest(_table(spark, sf_dir, "embeddings"), lambda i: i % 20 == 0, k=20)


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(_table(spark, sf_dir, "documents"))


def op8_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    scored = docs.select("doc_id", toxicity.held_out().alias("held_out"),
                         toxicity.toxicity(model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op9_pivotal_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = mixing.mix(_table(spark, sf_dir, "documents"))
    return (copies.withColumn("row", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n_rows"))))
            .select(F.col("id").alias("doc_id"), "size", "source_size", "target",
                    (F.col("copies") * F.col("size")).alias("taken")))


def op10_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _table(spark, sf_dir, "documents").select("doc_id", pii.pii_spans().alias("all"))

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of_kind(kind):
        return F.size(F.filter("all", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    plain = F.filter("all", lambda s: s["plain"])
    return found.select("doc_id", *map(of_kind, pii.KINDS), F.sha2(joined(plain), 256).alias("base_sha256"),
                        joined(F.col("all")).alias("spans"))


def op11_norm_sorted_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = (_table(spark, sf_dir, "embeddings").where(x.isNotNull()).where(finite)
             .withColumn("embedding", F.transform(x, lambda v: F.floor(64 * v.cast("double")))))
    return norm_search.top_products(whole, lambda i: i % 20 == 0, k=20)


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    audit = divergence.Divergence(_table(spark, sf_dir, "documents"))
    pairs, terms = divergence.ranked(audit.pairs(), "other"), divergence.ranked(audit.terms(), "term", 10)

    def part(rows: DataFrame, name: str, item: str) -> DataFrame:
        return rows.select("lang", "source", F.lit(name).alias("part"), F.col(item).alias("item"), "value", "rank")

    return part(pairs, "pair", "other").unionByName(part(terms, "term", "term"))


def _repeating(docs: DataFrame) -> DataFrame:
    """The texts, some with words replaced by earlier ones, as the query's contract says."""
    words = F.when(F.trim(text := F.regexp_replace(text_of("text"), BLANKS, " ")) == "", F.array()).otherwise(
        F.split(F.trim(text), " "))
    h = F.crc32(F.col("doc_id").cast("string"))
    split = docs.select("doc_id", text_of("text").alias("text"), F.floor(h / 10).alias("g"),
                        F.when(h % 10 == 0, words).alias("words"))
    n = F.size("words").cast("bigint")
    a = F.col("g") % n
    p = F.floor((n - a) / (3 + F.col("g") % 8)) + 1
    pattern = F.slice("words", (a + 1).cast("int"), p.cast("int"))
    many = F.flatten(F.array_repeat(pattern, F.ceil((n - a) / p).cast("int")))
    made = F.concat(F.slice("words", F.lit(1), a.cast("int")), F.slice(many, F.lit(1), (n - a).cast("int")))
    return split.select("doc_id", F.when(n > 0, F.array_join(made, " ")).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _repeating(_table(spark, sf_dir, "documents"))
    found = docs.select("doc_id", periodic_runs.periodic_runs("text").alias("found"))
    best = found.select("doc_id", F.col("found.runs").alias("runs"), F.col("found.collapsed").alias("collapsed"),
                        periodic_runs.strongest("found.runs").alias("best"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in (
        "start", "length", "period")]), F.lit("\n")))
    return best.select("doc_id", F.size("runs").cast("bigint").alias("n_runs"),
                       *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
                       F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
                       F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
                       F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _url_sql() -> str:
    url = "translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def hits(terms: tuple[str, ...]) -> str:
        return " + ".join(f"CAST(regexp_matches({url}, '(^|[^a-z0-9]){t}([^a-z0-9]|$)') AS INT)"
                          for t in terms)

    cases = [(text, verdict, *text.partition("/")) for verdict, text in
             sorted(RULES, key=lambda r: -len(r[1]))]
    fits = [(text, verdict, f"(host = '{host}' OR ends_with(host, '.{host}')) AND "
                            f"starts_with(path, '/{path}')") for text, verdict, host, _, path in cases]
    rule = " ".join(f"WHEN {fit} THEN '{text}'" for text, _, fit in fits)
    said = " ".join(f"WHEN {fit} THEN '{verdict}'" for _, verdict, fit in fits)
    return f"""
    WITH parts AS (
        SELECT page_id, {hits(VOCABULARY.strict)} AS strict_terms, {hits(VOCABULARY.soft)} AS soft_terms,
               translate(regexp_extract(coalesce(url, ''), '{url_filter.URL_PARTS}', 1),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '{url_filter.URL_PARTS}', 2) AS path
        FROM pages)
    SELECT page_id, host, path, CASE {rule} END AS rule,
           CASE {said} WHEN strict_terms >= 1 OR soft_terms >= {VOCABULARY.soft_hits} THEN 'block'
                ELSE 'allow' END AS verdict,
           strict_terms, soft_terms
    FROM parts"""


_COPIES_SQL = """
    WITH bodies AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS body
        FROM documents),
    groups AS (
        SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM bodies GROUP BY body)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
    FROM bodies JOIN groups USING (body)"""

_PRODUCTS_SQL = """
    WITH whole AS (
        SELECT row_number() OVER () AS n, vec_id,
               [CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
        FROM embeddings
        WHERE embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    scored AS (
        SELECT q.n, q.vec_id AS query_id, c.vec_id,
               CAST(coalesce(list_sum([z[1] * z[2] FOR z IN list_zip(q.v, c.v)]), 0) AS BIGINT) AS score
        FROM whole q JOIN whole c ON q.n <> c.n WHERE q.vec_id % 20 = 0)
    SELECT query_id, CAST(row_number() OVER best AS INT) AS rank, vec_id, score
    FROM scored WINDOW best AS (PARTITION BY n ORDER BY score DESC, vec_id)
    QUALIFY row_number() OVER best <= 20"""

_DIVERGENCE_SQL = """
    WITH docs AS (
        SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
        FROM documents),
    words AS (
        SELECT n, lang, source,
               unnest(regexp_extract_all(body, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM docs),
    kept AS (
        SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM words GROUP BY lang, term
        HAVING count(DISTINCT n) >= 10),
    langs AS (SELECT lang, sum(n) + 2 * count(*) AS mass FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    counts AS (
        SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM words SEMI JOIN kept USING (lang, term)
        GROUP BY lang, source, term),
    cells AS (
        SELECT lang, source, term, coalesce(c.n, 0) AS n, k.n AS lang_n,
               sum(coalesce(c.n, 0)) OVER (PARTITION BY lang, source)
               + 2 * count(*) OVER (PARTITION BY lang, source) AS mass
        FROM groups JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
    priced AS (
        SELECT lang, source, term, n, CAST(1 + (1000000000 * (n + 2)) // cells.mass AS HUGEINT) AS p,
               CAST(1 + (1000000000 * (lang_n + 2)) // langs.mass AS HUGEINT) AS q
        FROM cells JOIN langs USING (lang)),
    pairs AS (
        SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
        FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
        GROUP BY ALL),
    parts AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
        UNION ALL
        SELECT lang, source, 'term', term, CAST((p - q) * (p - q) // (p + q) AS BIGINT)
        FROM priced WHERE n > 0 AND p > q)
    SELECT *, CAST(row_number() OVER best AS INT) AS rank FROM parts
    WINDOW best AS (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))
    QUALIFY part = 'pair' OR row_number() OVER best <= 10"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q for q in (
        op1_hierarchical_packing, op2_fuzzy_line_dedup, op3_digest_token_counts,
        op4_circulant_near_dedup, op5_url_vocabulary, op6_permutation_index, op7_exact_dedup,
        op8_compression_toxicity, op9_pivotal_mixing, op10_pii_spans, op11_norm_sorted_search,
        op12_source_divergence, op13_periodic_runs)}

ORACLES: dict[str, str] = {"op5_url_vocabulary": _url_sql(), "op7_exact_dedup": _COPIES_SQL,
                           "op11_norm_sorted_search": _PRODUCTS_SQL, "op12_source_divergence": _DIVERGENCE_SQL}
