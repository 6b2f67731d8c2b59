"""Scalar access to JSON text."""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

_PATH = re.compile(r"\$(\.[^.\[\]*'?]+|\[\d+\]|\['[^'*]+'\])*")


def json_value(text: Column | str, path: str) -> Column:
    """The scalar at ``path`` as STRING; NULL when it is missing, null, an
    object or an array, or when the text is not JSON. Paths are made of names and
    indexes; others are refused here and not on some row.

    ``get_json_object`` also returns the text of objects and arrays. Only a
    result that starts like one is looked at again, to tell it from a string
    that happens to begin with a bracket. In a document that repeats a key, which
    a variant does not hold, it is nested if it is JSON by itself.
    """
    if not _PATH.fullmatch(path):
        raise ValueError(f"not a path of names and indexes: {path!r}")
    doc = F.col(text) if isinstance(text, str) else text
    found = F.get_json_object(doc, path)
    nested_like = found.startswith("{") | found.startswith("[")
    kind = F.schema_of_variant(F.try_variant_get(F.try_parse_json(doc), path, "variant"))
    nested = F.coalesce(kind.rlike("^(OBJECT|ARRAY)"), F.get_json_object(found, "$").isNotNull())
    return F.when(nested_like, F.when(~nested, found)).otherwise(found)
