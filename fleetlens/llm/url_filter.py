"""URL filter: host and path rules, then a weighted vocabulary.

An Aho-Corasick automaton finds all terms in one pass over a URL. A term counts where no
letter or digit touches it. One strict term, or several distinct soft ones, reject.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOUCHES = frozenset(_LOWER + "0123456789")
#: What lies between the first ``://`` and ``/``, ``?``, ``#`` or the end; then the path.
URL_PARTS = "://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Vocabulary:
    """Lower-case terms. ``soft_hits`` distinct soft ones reject like one strict one."""

    strict: tuple[str, ...]
    soft: tuple[str, ...]
    soft_hits: int = 2


@lru_cache(maxsize=4)
def _automaton(vocabulary: Vocabulary) -> ahocorasick.Automaton | None:
    terms = {t: (t, False) for t in vocabulary.soft} | {t: (t, True) for t in vocabulary.strict}
    if not terms:
        return None
    automaton = ahocorasick.Automaton()
    for term, value in terms.items():
        automaton.add_word(term, value)
    automaton.make_automaton()
    return automaton


def found_terms(vocabulary: Vocabulary, url: str) -> tuple[set[str], set[str]]:
    """Distinct strict and soft terms of a URL whose A-Z are lower-cased."""
    automaton = _automaton(vocabulary)
    strict, soft = set(), set()
    for last, (term, is_strict) in automaton.iter(url) if automaton else ():
        before, after = last - len(term), last + 1
        if ((before < 0 or url[before] not in _TOUCHES)
                and (after == len(url) or url[after] not in _TOUCHES)):
            (strict if is_strict else soft).add(term)
    return strict, soft


def term_hits(vocabulary: Vocabulary, url: Column) -> Column:
    """``strict, soft``: distinct terms; none in a null URL."""

    @F.pandas_udf("strict int, soft int")
    def count(urls: pd.Series) -> pd.DataFrame:
        hits = [found_terms(vocabulary, u) for u in urls]
        return pd.DataFrame({"strict": [len(a) for a, _ in hits], "soft": [len(b) for _, b in hits]},
                            dtype="int32")

    return count(F.translate(F.coalesce(url, F.lit("")), _UPPER, _LOWER))


def judge_urls(pages: DataFrame, vocabulary: Vocabulary, rules: tuple[tuple[str, str], ...] = (),
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """``id_col, host, path, rule, verdict, strict_terms, soft_terms`` for every row.

    ``rules`` are pairs of verdict (allow or block) and ``host/path``. The longest that fits
    decides; without one, the vocabulary does. A null URL and one without ``://`` have an
    empty host and path; a null one is allowed. Repeated rows and null ids are judged like
    others; other columns are not read.
    """
    url = F.coalesce(F.col(url_col), F.lit(""))
    rows = pages.select(
        F.col(id_col), F.translate(F.regexp_extract(url, URL_PARTS, 1), _UPPER, _LOWER).alias("host"),
        F.regexp_extract(url, URL_PARTS, 2).alias("path"),
        term_hits(vocabulary, F.col(url_col)).alias("hits"))
    rule, said = F.lit(None).cast("string"), F.lit(None).cast("string")
    for verdict, text in sorted(rules, key=lambda r: len(r[1])):  # the longest is asked first
        host, slash, path = text.partition("/")
        fits = (((F.col("host") == host) | F.col("host").endswith("." + host))
                & F.col("path").startswith(slash + path))
        rule, said = F.when(fits, text).otherwise(rule), F.when(fits, verdict).otherwise(said)
    rejected = (F.col("hits.strict") >= 1) | (F.col("hits.soft") >= vocabulary.soft_hits)
    return rows.select(
        id_col, "host", "path", rule.alias("rule"),
        F.coalesce(said, F.when(rejected, "block").otherwise("allow")).alias("verdict"),
        F.col("hits.strict").alias("strict_terms"), F.col("hits.soft").alias("soft_terms"))
