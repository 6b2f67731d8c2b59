"""Sliding-window counts per device and the alerts drawn from them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.time import duration_micros, time_literal
from .spread import DEFAULT_SALTS, spread_join

# Counting slide-wide panes first costs a second shuffle. It pays when every event
# would otherwise be counted in at least this many windows.
PANES_FROM = 6


def count_by_hop(events: DataFrame, keys: list[str], time: str, size: str, slide: str,
                 panes: bool | None = None, key_first: bool = False) -> DataFrame:
    """``total_count`` per sliding window and keys.

    Windows start at multiples of ``slide`` since the epoch; the start belongs to
    the window, the end does not. Every event is in size/slide windows. On a stream
    the window is a struct ``window``; in batch it is ``window_start``, a plain key
    that groups and joins faster (``with_bounds`` gives both bounds for either).

    ``panes`` counts slide-wide panes first and adds them up to windows, for a size
    that is a multiple of the slide; by default when size/slide is large. On a stream
    these are two stateful operators: events are held once, in panes that close with the
    watermark, and only closed panes are copied to their windows. ``key_first`` hashes a
    stream by the keys before the window.
    """
    number = F.count("*").alias("total_count")
    length, step = duration_micros(size), duration_micros(slide)
    per_event, whole = -(-length // step), length % step == 0
    if panes and not whole:
        raise ValueError("panes need a size that is a multiple of the slide")
    if panes is None:
        panes = whole and per_event >= PANES_FROM
    if events.isStreaming:
        moment = F.col(time)
        if panes:
            pane = F.window(time, slide).alias("_pane")
            by_pane = [*keys, pane] if key_first else [pane, *keys]
            events = events.groupBy(*by_pane).agg(F.count("*").alias("_n"))
            moment, number = F.window_time("_pane"), F.sum("_n").alias("total_count")
        window = F.window(moment, size, slide).alias("window")
        grouping = [*keys, window] if key_first else [window, *keys]
        return events.groupBy(*grouping).agg(number)

    # The start of the slide an event is in, and from it the starts of its windows.
    pane = F.window(time, slide)["start"].alias("_pane")
    first = F.col("_pane") - _micros(step * (per_event - 1))
    starts = F.explode(F.sequence(first, F.col("_pane"), _micros(step))).alias("window_start")
    if panes:
        parts = events.select(pane, *keys).groupBy("_pane", *keys).agg(F.count("*").alias("_n"))
        rows, number = parts.select(starts, *keys, "_n"), F.sum("_n").alias("total_count")
    elif whole:
        rows = events.select(pane, *keys).select(starts, *keys)
    else:
        timed = events.select(pane, *keys, F.col(time).alias("_time"))
        rows = timed.select(starts, *keys, "_time").where(
            F.col("_time") < F.col("window_start") + _micros(length))
    return rows.groupBy("window_start", *keys).agg(number)


def _micros(amount: int) -> Column:
    return F.expr(f"INTERVAL {amount} MICROSECOND")


def with_bounds(rows: DataFrame, size: str) -> DataFrame:
    """``window_start`` and ``window_end`` in front of the other columns."""
    if "window" in rows.columns:
        start, end, others = F.col("window.start"), F.col("window.end"), rows.drop("window").columns
    else:
        start, others = F.col("window_start"), rows.drop("window_start").columns
        end = start + _micros(duration_micros(size))
    return rows.select(start.alias("window_start"), end.alias("window_end"), *others)


def hop_counts(events: DataFrame, keys: list[str], time: str, size: str, slide: str,
               panes: bool | None = None) -> DataFrame:
    """``count_by_hop`` with the window bounds as columns."""
    return with_bounds(count_by_hop(events, keys, time, size, slide, panes), size)


def _window_key(counts: DataFrame) -> str:
    return "window" if "window" in counts.columns else "window_start"


def window_stats(counts: DataFrame, integer_stats: bool = True) -> DataFrame:
    """Mean and sample deviation of ``total_count`` over the rows of a window.

    Computed from exact sums, so the result does not depend on how rows were
    spread over tasks: a deviation that is exactly 2 never truncates to 1. With
    ``integer_stats`` both are cut to BIGINT. The deviation of a single row is NULL.
    """
    window, c = _window_key(counts), F.col("total_count")
    square = c.cast("decimal(19,0)") * c.cast("decimal(19,0)")
    sums = counts.groupBy(window).agg(F.count("*").alias("_n"), F.sum(c).alias("_s1"),
                                      F.sum(square).alias("_s2"))
    n, s1, s2 = F.col("_n"), F.col("_s1").cast("decimal(19,0)"), F.col("_s2")
    spread = (n.cast("decimal(10,0)") * s2 - s1 * s1).cast("double")
    pairs = n.cast("double") * (n - 1)
    deviation = F.sqrt(spread / F.nullif(pairs, F.lit(0.0)))
    if integer_stats:
        mean, deviation = F.expr("_s1 div _n"), deviation.cast("bigint")
    else:
        mean = F.col("_s1").cast("double") / n
    return sums.select(window, mean.alias("avg_error_count"), deviation.alias("std_error_count"))


def closed_before(rows: DataFrame, watermark: Column | datetime) -> DataFrame:
    """Rows of windows that have ended by the watermark."""
    return rows.where(F.col("window_end") <= watermark)


def _judged(counts: DataFrame, stats: DataFrame, keys: list[str], size: str, k: float,
            floor: float, salts: int) -> DataFrame:
    over = F.col("total_count") > (F.col("avg_error_count")
                                   + F.lit(k) * F.col("std_error_count") + F.lit(floor))
    alerts = spread_join(counts, stats, [_window_key(counts)], keys, salts, where=over)
    return with_bounds(alerts, size).select(
        F.col("window_start").cast("timestamp_ntz").alias("window_start"),
        F.col("window_end").cast("timestamp_ntz").alias("window_end"),
        F.col("total_count").alias("total_count_per_deviceid"),
        *keys, "avg_error_count", "std_error_count")


def alerts_from_counts(counts: DataFrame, keys: list[str], size: str = "1 minute", k: float = 3,
                       floor: float = 5, integer_stats: bool = True,
                       salts: int = DEFAULT_SALTS) -> DataFrame:
    """The alerts of whole windows, from a batch of ``window_start``, keys and
    ``total_count``."""
    counts = counts.select("window_start", *keys, "total_count")
    return _judged(counts, window_stats(counts, integer_stats), keys, size, k, floor, salts)


def _counted(events: DataFrame, time: str, where: Column | None, delay: str) -> DataFrame:
    """The events to count; on a stream with a watermark that all events advance."""
    if events.isStreaming:
        events = events.withWatermark(time, delay)
        if where is not None:
            # A filter that does not read the event time would be moved below the
            # watermark, which then only counted events would advance.
            where = F.when(F.col(time).isNotNull(), where)
    return events if where is None else events.where(where)


def closed_counts(events: DataFrame, *, key: str = "deviceId",
                  also: tuple[str, ...] = ("deviceLocation",), time: str = "eventTimestamp",
                  where: Column | None = None, size: str = "1 minute",
                  slide: str = "30 seconds", delay: str = "5 seconds") -> DataFrame:
    """``hop_counts`` of the picked events; on a stream, of windows that have closed.
    All rows of a window leave the stream in the same micro-batch."""
    return hop_counts(_counted(events, time, where, delay), [key, *also], time, size, slide)


def deviation_alerts(events: DataFrame, *, key: str = "deviceId",
                     also: tuple[str, ...] = ("deviceLocation",),
                     time: str = "eventTimestamp", where: Column | None = None,
                     size: str = "1 minute", slide: str = "30 seconds",
                     k: float = 3, floor: float = 5, integer_stats: bool = True,
                     delay: str = "5 seconds",
                     time_range: tuple[datetime, datetime] | None = None,
                     salts: int = DEFAULT_SALTS) -> DataFrame:
    """Devices whose count in a window exceeds mean + k deviations + floor.

    ``where`` picks the events that are counted. ``also`` are further grouping
    columns: a device that moves counts once per location. A window with a single
    row has no deviation and raises no alert.

    Counts and statistics are joined on the window, with the counts of a window
    spread over ``salts`` tasks. For batch input, ``time_range`` (start, end) picks
    the windows that lie in it as a whole, so that each is judged by all its events;
    only events of that range are read.

    On a stream a watermark ``delay`` behind the newest event of any kind closes
    windows, and alerts are appended when their window closes.
    """
    streaming = events.isStreaming
    if streaming and time_range:
        raise ValueError("time_range is for batch input")
    keys = [key, *also]
    if time_range:
        kind = events.schema[time].dataType
        start, end = (time_literal(moment, kind) for moment in time_range)
        events = events.where((F.col(time) >= start) & (F.col(time) < end))
    events = _counted(events, time, where, delay)
    counts = count_by_hop(events, keys, time, size, slide)
    if time_range:
        counts = counts.where((F.col("window_start") >= start)
                              & (F.col("window_start") + _micros(duration_micros(size)) <= end))
    # A stream has to shuffle twice: a reused exchange hides the watermark from the
    # operators above it, and their windows would never close. With the keys in
    # another order the two shuffles differ.
    again = count_by_hop(events, keys, time, size, slide, key_first=True) if streaming else counts
    stats = window_stats(again, integer_stats)
    return _judged(counts, stats, keys, size, k, floor, salts)
