"""What an observation has seen."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import Observation


def observed(seen: Observation, name: str, without: int | None = None) -> int | None:
    """A metric of an observation whose rows have been written. Where the optimiser knew
    that there were no rows, nothing was observed: ``without``."""
    try:
        return seen.get[name]
    except Py4JJavaError as error:
        if "AssertionError" not in error.java_exception.getClass().getName():
            raise
        return without
