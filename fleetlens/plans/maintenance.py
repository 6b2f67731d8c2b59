"""Tables by name, deleting and replacing rows, and compaction."""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..storage import delete, file_system
from . import manifest, views
from .specs import IngestSpec
from .store import LoadReport, counting, enter, read_folders, table_schema, write_part


def enable(spark: SparkSession, spec: IngestSpec, path: str) -> None:
    """Make a table queryable by its name in this session. What this process loads or
    deletes later is seen by the next query; for changes by others, enable it again."""
    disable(spark, spec)
    columns = [(f.name, f.dataType.simpleString()) for f in table_schema(spec)
               if f.name not in ("__part", "__date")]
    views.show(spark, spec.name, path, columns, spec.partition_by_day, counting)


def disable(spark: SparkSession, spec: IngestSpec) -> bool:
    """Take a table out of view; its files stay."""
    return views.hide(spark, spec.name)


def _needs_days(spec: IngestSpec, instead: str) -> None:
    if not spec.partition_by_day:
        raise ValueError(f"{spec.name} has no days; {instead}")


def delete_interval(spark: SparkSession, spec: IngestSpec, path: str, start: date,
                    end: date) -> list[date]:
    """Delete the files of days with ``start <= day < end`` and name those days.

    Whole day folders go, without reading a row. Data frames made before have to be
    read anew. A table without days is refused: use ``delete_all``.
    """
    _needs_days(spec, "delete_all empties it")
    before, after = enter(spark, path, lambda state: (
        {"drop": [start.isoformat(), end.isoformat()]}
        if any(start <= day < end for day in state.days()) else None))
    return sorted(_delete(spark, path, before, after))


def delete_all(spark: SparkSession, path: str) -> None:
    """Empty a table; its log stays."""
    _delete(spark, path, *enter(spark, path, lambda state: {"empty": True} if state.folders else None))


def _delete(spark: SparkSession, path: str, before: manifest.State, after: manifest.State) -> set:
    gone = before.folders.keys() - after.folders.keys()
    for key in gone:
        delete(spark, manifest.folder_path(path, key))
    spark.catalog.refreshByPath(path)
    return {day for _, day in gone}


def compact(spark: SparkSession, spec: IngestSpec, path: str, before: date | None = None) -> list[date]:
    """Rewrite closed days that several writes have left files of, and name those days.

    Days before ``before`` (all, if None) that hold more than one folder, or rows that no
    longer count, become one folder each: few files, in one job, dealt out by day. The swap
    is one entry of the log. Who has read the log before goes on with the old folders, which
    stay until ``remove_unused``. A day that a load, a deletion or another compaction has
    changed meanwhile is left as it is; the next compaction sees to it. Rows keep the name
    of their load, so one that is repeated afterwards still replaces itself.
    """
    state = manifest.current(spark, path)
    by_day: dict[date | None, list[manifest.Key]] = {}
    for key in state.folders:
        if before is None or key[1] is None or key[1] < before:
            by_day.setdefault(key[1], []).append(key)
    old = {key: state.folders[key] for keys in by_day.values() for key in keys
           if len(keys) > 1 or state.folders[key].without}
    if not old:
        return []
    rows = read_folders(spark, spec, path, old).drop("__part", "__date")
    part = write_part(rows if spec.partition_by_day else rows.hint("rebalance"), spec, path)
    new = manifest.written(spark, path, part)
    done: list[date] = []

    def swap(now: manifest.State) -> dict | None:
        done.clear()
        swapped, folders = [], {}
        for day in {key[1] for key in old}:
            mine = [key for key in old if key[1] == day]
            if any(now.folders.get(key) != old[key] for key in mine):
                continue
            done.append(day)
            swapped += [manifest.key_text(key) for key in mine]
            loads = reduce(or_, (old[key].loads for key in mine))
            text = manifest.key_text((part, day))
            if text in new:  # else no row of the day counts
                folders[text] = {**new[text], "loads": loads.names}
        return {"swapped": swapped, "folders": folders} if swapped else None

    enter(spark, path, swap)
    return sorted(day for day in done if day is not None)


def remove_unused(spark: SparkSession, path: str, older_than: timedelta = timedelta(days=7)) -> int:
    """Delete folders that do not count: replaced, compacted, or left by a write that failed.

    Those changed within ``older_than`` stay, for readers that began before and writes that
    are not entered yet. This lists the whole table. Returns the number of folders deleted.
    """
    files, root = file_system(spark, path)
    limit = (datetime.now(timezone.utc) - older_than).timestamp() * 1000
    used = {key for key in manifest.current(spark, path).folders}
    removed = 0
    for part in files.listStatus(root) if files.exists(root) else []:
        name = part.getPath().getName()
        if not name.startswith("__part="):
            continue
        days = [s for s in files.listStatus(part.getPath()) if s.isDirectory()]
        keys = [(name.removeprefix("__part="), date.fromisoformat(s.getPath().getName().removeprefix("__date=")))
                for s in days if s.getPath().getName().startswith("__date=")]
        keys = keys or [(name.removeprefix("__part="), None)]
        if part.getModificationTime() > limit:
            continue
        unused = [key for key in keys if key not in used]
        for key in unused if len(unused) < len(keys) else [(keys[0][0], None)]:
            delete(spark, manifest.folder_path(path, key))
            removed += 1
    return removed


def replace_interval(spark: SparkSession, spec: IngestSpec, path: str, rows: DataFrame | str, start: date,
                     end: date, load_id: str) -> LoadReport:
    """Put the result of a query in the place of all days with ``start <= day < end``.

    ``rows``, a data frame or SQL over tables that are enabled, has ``__time`` and the
    dimensions of the spec by name; dimensions it lacks are NULL, other columns are left
    out. A row without a time or outside the interval is an error, and then nothing is
    changed. The query may read the very days it replaces. Days without a row are empty.
    """
    _needs_days(spec, "delete_all and load it again")
    rows = spark.sql(rows) if isinstance(rows, str) else rows
    there = {c.lower(): c for c in rows.columns}
    wanted = [f for f in table_schema(spec) if f.name not in ("__load", "__part", "__date")]
    picked = rows.select(*[(F.col(f"`{there[f.name.lower()]}`") if f.name.lower() in there else F.lit(None))
                           .cast(f.dataType).alias(f.name) for f in wanted])
    first, last = (F.lit(day.isoformat()).cast("timestamp") for day in (start, end))
    inside = F.coalesce((F.col("__time") >= first) & (F.col("__time") < last), F.lit(False))
    checked = picked.withColumn("__time", F.when(inside, F.col("__time")).otherwise(F.raise_error(F.concat(
        F.lit("outside the interval: "), F.coalesce(F.col("__time").cast("string"), F.lit("no time"))))))
    part = write_part(checked.withColumn("__load", F.lit(load_id)), spec, path)
    folders = manifest.written(spark, path, part)
    _, after = enter(spark, path, lambda state: {
        "drop": [start.isoformat(), end.isoformat()], "load": load_id, "folders": folders})
    kept = read_folders(spark, spec, path, {k: f for k, f in after.folders.items() if k[0] == part}).count()
    return LoadReport(load_id, kept, kept, tuple(sorted(manifest.key_of(f)[1] for f in folders)))
