"""What several operators need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from fleetlens.session import scratch_dir

#: The only blanks that end a word: space and 0x09-0x0D.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows of ``df``, written once to the shared folder and read from there.

    It cuts the lineage and survives lost executors. Joins of what is read can be
    re-dealt by adaptive execution when a key is hot.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores before it as make it no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def text_of(column: str | Column) -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def word_count(column: str | Column) -> Column:
    """Number of words: after blanks are made one, a gap between words is one space."""
    spaced = F.trim(F.regexp_replace(text_of(column), BLANKS, " "))
    gaps = F.length(spaced) - F.length(F.replace(spaced, F.lit(" "), F.lit("")))
    return F.when(spaced == "", 0).otherwise(gaps + 1).cast("bigint")
