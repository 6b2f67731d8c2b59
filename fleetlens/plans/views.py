"""Tables by name.

The folders of an enabled table are partitions in the session's catalog, which are
added and dropped as its log changes: a load costs what it has written, and a query
lists the partitions it asks for. The name is a view on top of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import manifest

_CHUNK = 500
#: By path: the keys that are partitions, and what makes the views of each session.
_PARTITIONS: dict[str, set[manifest.Key]] = {}
_VIEWS: dict[str, dict[tuple[str, str], Callable[[manifest.State], None]]] = {}


def _root(path: str) -> str:
    return path.rstrip("/")


def _partitions(path: str) -> str:
    return f"parts_{hashlib.md5(_root(path).encode()).hexdigest()}"


def _session(spark: SparkSession) -> str:
    return spark._jsparkSession.sessionUUID()


def _spec(key: manifest.Key) -> str:
    part, day = key
    return f"PARTITION (__part = '{part}'" + (f", __date = DATE '{day.isoformat()}')" if day else ")")


def _bring_up(spark: SparkSession, path: str, state: manifest.State) -> None:
    name, known = _partitions(path), _PARTITIONS[_root(path)]
    new, gone = sorted(state.folders.keys() - known, key=str), sorted(known - state.folders.keys(), key=str)
    for lo in range(0, len(new), _CHUNK):
        places = " ".join(f"{_spec(k)} LOCATION '{manifest.folder_path(path, k)}'" for k in new[lo:lo + _CHUNK])
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {places}")
    for lo in range(0, len(gone), _CHUNK):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(map(_spec, gone[lo:lo + _CHUNK]))}")
    _PARTITIONS[_root(path)] = set(state.folders)


def show(spark: SparkSession, name: str, path: str, columns: list[tuple[str, str]], days: bool,
         counting: Callable[[DataFrame, dict], DataFrame]) -> None:
    """Make a table of these ``columns`` queryable as ``name`` in this session."""
    table = _partitions(path)
    if _root(path) not in _PARTITIONS:
        keys = ["__part"] + ["__date"] * days
        listed = ", ".join(f"`{c}` {kind}" for c, kind in [*columns, ("__part", "STRING")]
                           + [("__date", "DATE")] * days)
        spark.sql(f"DROP TABLE IF EXISTS {table}")  # an earlier process may have left it
        spark.sql(f"CREATE TABLE {table} ({listed}) USING parquet "
                  f"PARTITIONED BY ({', '.join(keys)}) LOCATION '{_root(path)}'")
        _PARTITIONS[_root(path)] = set()

    def view(state: manifest.State) -> None:
        rows = counting(spark.table(table), state.folders)
        rows.drop("__load", "__part").createOrReplaceTempView(name)

    _VIEWS.setdefault(_root(path), {})[_session(spark), name] = view
    refresh(spark, path, manifest.current(spark, path))


def hide(spark: SparkSession, name: str) -> bool:
    """Take a name out of this session. Its partitions stay, for data frames made before."""
    for views in _VIEWS.values():
        views.pop((_session(spark), name), None)
    return spark.catalog.dropTempView(name)


def refresh(spark: SparkSession, path: str, state: manifest.State) -> None:
    """What was entered is seen by the next query."""
    views = _VIEWS.get(_root(path), {})
    if views:
        _bring_up(spark, path, state)
    for view in list(views.values()):
        view(state)
