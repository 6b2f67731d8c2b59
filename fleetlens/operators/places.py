"""Positions as columns of their own."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.geo import split_location


def locate(rows: DataFrame, location: str, lat: str = "lat", lon: str = "lon",
           as_type: str = "double") -> DataFrame:
    """``rows`` with the position read from ``lat,lon`` text, once per row.

    Filters and joins on columns that are only computed are moved below the
    computation, and would read the text again in every term of a distance.
    """
    parts = split_location(location, as_type)
    pair = F.struct(parts[0].alias(lat), parts[1].alias(lon))
    return rows.select("*", F.inline(F.array(pair)))
