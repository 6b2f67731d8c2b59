"""Sketches per day, merged when a question is asked.

How many devices there were, and how values were spread, cannot be added up over days
from the answers of each; sketches can. They are made once per day, in binary columns of a
few kilobytes, and a question about any days and areas reads those instead of the rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

#: Logarithm of the registers of a distinct count: its relative error is about
#: 1.04 / sqrt(2 ** REGISTERS), 1.6 percent, in two of three cases.
REGISTERS = 12
#: Size of a quantile sketch: the rank of its answers is off by about 1.3 percent of the rows.
QUANTILE_SIZE = 200


def day_sketches(rows: DataFrame, by: Sequence[str] = (), distinct: Sequence[str] = (),
                 quantiles: Sequence[str] = (), day: str = "__date") -> DataFrame:
    """One row per day and ``by``: ``rows`` (their number), ``<column>_distinct`` and
    ``<column>_quantiles`` as binary sketches.

    They are built in every task and merged behind one shuffle, whose rows are sketches. A
    column of which a group has no value has an empty sketch; NULLs count in none.
    """
    sketches = [F.count("*").alias("rows")]
    for c in distinct:
        sketches.append(F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), REGISTERS).alias(f"{c}_distinct"))
    for c in quantiles:
        sketches.append(F.kll_sketch_agg_double(F.col(f"`{c}`").cast("double"), QUANTILE_SIZE)
                        .alias(f"{c}_quantiles"))
    return rows.groupBy(day, *[F.col(f"`{c}`") for c in by]).agg(*sketches)


def merged(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketches of several days and areas as one per ``by``."""
    found = [F.sum("rows").alias("rows")]
    for c in sketches.columns:
        if c.endswith("_distinct"):
            found.append(F.hll_union_agg(f"`{c}`").alias(c))
        elif c.endswith("_quantiles"):
            found.append(F.kll_merge_agg_double(f"`{c}`").alias(c))
    return sketches.groupBy(*[F.col(f"`{c}`") for c in by]).agg(*found)


def distinct_count(column: str) -> Column:
    """The number of distinct values a sketch has seen, about."""
    return F.hll_sketch_estimate(f"`{column}_distinct`")


def quantile(column: str, share: float) -> Column:
    """The value that ``share`` of the values are at or below, about. NULL if there were none."""
    sketch = F.col(f"`{column}_quantiles`")
    return F.when(F.kll_sketch_get_n_double(sketch) > 0,
                  F.kll_sketch_get_quantile_double(sketch, F.lit(share)))
