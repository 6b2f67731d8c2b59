import statistics
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from fleetlens import operators as op

BASE = datetime(2024, 1, 1)
SECONDS = st.lists(st.tuples(st.integers(0, 300), st.integers(0, 4)), max_size=60)


def frame(spark, rows, kind="TIMESTAMP_NTZ"):
    """Rows of (seconds after BASE, device number)."""
    data = [(f"d{d}", "here", BASE + timedelta(seconds=s)) for s, d in rows]
    return spark.createDataFrame(
        data, "deviceId STRING, deviceLocation STRING, t TIMESTAMP_NTZ").select(
        "deviceId", "deviceLocation", F.col("t").cast(kind).alias("eventTimestamp"))


def counted(rows):
    return Counter({(r["window_start"], r["deviceId"]): r["total_count"] for r in rows.collect()})


def expected(rows, size=60, slide=30):
    out = Counter()
    for s, d in rows:
        start = s // slide * slide
        while start > s - size:
            out[BASE + timedelta(seconds=start), f"d{d}"] += 1
            start -= slide
    return out


@settings(max_examples=15, deadline=None)
@given(rows=SECONDS, panes=st.booleans())
def test_hop_counts(spark, rows, panes):
    got = op.hop_counts(frame(spark, rows), ["deviceId"], "eventTimestamp", "1 minute",
                        "30 seconds", panes=panes)
    assert counted(got) == expected(rows)
    assert sum(counted(got).values()) == 2 * len(rows)


@pytest.mark.parametrize("kind", ["TIMESTAMP", "TIMESTAMP_NTZ"])
@pytest.mark.parametrize("size, slide", [("1 minute", "1 minute"), ("50 seconds", "20 seconds"), ("45 seconds", "30 seconds"),
                                         ("2 minutes", "10 seconds")])
def test_other_sizes(spark, kind, size, slide):
    from fleetlens.functions import duration_micros
    rows = [(0, 0), (29, 0), (30, 0), (59, 1), (60, 1), (61, 0), (119, 2)]
    got = op.hop_counts(frame(spark, rows, kind), ["deviceId"], "eventTimestamp", size, slide)
    got = got.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))
    assert counted(got) == expected(rows, duration_micros(size) // 10 ** 6,
                                    duration_micros(slide) // 10 ** 6)


def test_a_window_has_its_start_and_not_its_end(spark):
    times = [(BASE + timedelta(seconds=0),), (BASE + timedelta(milliseconds=29999),),
             (BASE + timedelta(seconds=30),)]
    rows = spark.createDataFrame(times, "t TIMESTAMP_NTZ")
    got = op.hop_counts(rows, [], "t", "1 minute", "30 seconds")
    assert {(r[0] - BASE).total_seconds(): r["total_count"] for r in got.collect()} == {
        -30: 2, 0: 3, 30: 1}
    assert all(r["window_end"] - r["window_start"] == timedelta(minutes=1) for r in got.collect())


def test_rows_without_a_time_are_in_no_window(spark):
    rows = frame(spark, [(1, 0)]).withColumn("eventTimestamp", F.lit(None).cast("timestamp_ntz"))
    assert op.hop_counts(rows, ["deviceId"], "eventTimestamp", "1 minute", "30 seconds").count() == 0


def test_panes_are_refused_where_they_cannot_be(spark):
    with pytest.raises(ValueError):
        op.hop_counts(frame(spark, []), ["deviceId"], "eventTimestamp", "50 seconds", "20 seconds",
                      panes=True)


@settings(max_examples=15, deadline=None)
@given(counts=st.lists(st.integers(1, 10 ** 9), min_size=1, max_size=12))
def test_window_stats_are_exact(spark, counts):
    rows = spark.createDataFrame([(BASE, c) for c in counts], "window_start TIMESTAMP_NTZ, total_count BIGINT")
    cut, full = (op.window_stats(rows, integer_stats=i).first() for i in (True, False))
    assert cut["avg_error_count"] == sum(counts) // len(counts)
    if len(counts) == 1:
        assert cut["std_error_count"] is None and full["std_error_count"] is None
    else:
        n, s1, s2 = len(counts), sum(counts), sum(c * c for c in counts)
        square = (n * s2 - s1 * s1) / (n * (n - 1))
        assert cut["std_error_count"] == int(square ** 0.5)
        assert full["std_error_count"] == pytest.approx(statistics.stdev(counts), rel=1e-9)


def test_a_whole_deviation_is_not_cut(spark):
    rows = spark.createDataFrame([(BASE, c) for c in (1, 3, 5) * 1], "window_start TIMESTAMP_NTZ, total_count BIGINT")
    assert op.window_stats(rows).first()["std_error_count"] == 2


def alerts(spark, rows, **settings_):
    return op.deviation_alerts(frame(spark, rows), **settings_)


def brute_force(rows, k, floor):
    windows = defaultdict(dict)
    for (start, d), n in expected(rows).items():
        windows[start][d] = n
    out = set()
    for start, counts in windows.items():
        if len(counts) < 2:
            continue
        mean, deviation = int(statistics.mean(counts.values())), int(statistics.stdev(counts.values()) + 1e-9)
        out |= {(start, d, n, mean, deviation) for d, n in counts.items() if n > mean + k * deviation + floor}
    return out


def seen(rows):
    return {(r["window_start"], r["deviceId"], r["total_count_per_deviceid"], r["avg_error_count"],
             r["std_error_count"]) for r in rows.collect()}


@settings(max_examples=15, deadline=None)
@given(rows=SECONDS, k=st.sampled_from([0, 1, 3]), floor=st.sampled_from([0, 2]),
       salts=st.sampled_from([1, 16]))
def test_alerts(spark, rows, k, floor, salts):
    assert seen(alerts(spark, rows, k=k, floor=floor, salts=salts)) == brute_force(rows, k, floor)


def test_alerts_shrink_as_the_threshold_grows(spark):
    rows = [(s, 0) for s in range(0, 120, 2)] + [(s, d) for s in range(0, 120, 15) for d in range(1, 5)]
    sizes = [seen(alerts(spark, rows, k=k, floor=f)) for k, f in [(0, 0), (1, 0), (1, 3), (1, 9), (3, 9)]]
    assert sizes[0] and all(a >= b for a, b in zip(sizes, sizes[1:]))


def test_a_lone_device_raises_no_alert(spark):
    assert alerts(spark, [(s, 0) for s in range(120)], floor=0).count() == 0


def test_a_device_that_moves_counts_twice(spark):
    rows = frame(spark, [(1, 0), (2, 0)]).withColumn(
        "deviceLocation", F.when(F.col("eventTimestamp") > F.lit("2024-01-01 00:00:01").cast("timestamp_ntz"),
                                 "there").otherwise("here"))
    got = op.hop_counts(rows, ["deviceId", "deviceLocation"], "eventTimestamp", "1 minute", "30 seconds")
    assert {r["total_count"] for r in got.collect()} == {1}


def test_time_range_picks_whole_windows(spark):
    rows = [(s, d) for s in range(0, 300, 3) for d in range(5)] + [(s, 0) for s in range(300)]
    span = (BASE + timedelta(seconds=60), BASE + timedelta(seconds=240))
    got = alerts(spark, rows, k=1, floor=0, time_range=span)
    want = {r for r in brute_force(rows, 1, 0)
            if span[0] <= r[0] and r[0] + timedelta(seconds=60) <= span[1]}
    assert seen(got) == want and want


@pytest.mark.parametrize("slide", ["30 seconds", "5 seconds", "25 seconds"])
def test_events_are_read_and_shuffled_once(spark, tmp_path, slide):
    path = str(tmp_path / "events")
    frame(spark, [(s, s % 5) for s in range(200)]).write.parquet(path)
    got = op.deviation_alerts(spark.read.parquet(path), where=F.col("deviceId") != "d9", slide=slide, floor=0)
    got.collect()
    plan = got._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan") == 1
    assert "ReusedExchange" in plan


def test_closed_before(spark):
    rows = op.hop_counts(frame(spark, [(0, 0), (100, 0)]), ["deviceId"], "eventTimestamp",
                         "1 minute", "30 seconds")
    done = op.closed_before(rows, F.lit(BASE + timedelta(seconds=95)).cast("timestamp_ntz"))
    assert max(r["window_end"] for r in done.collect()) == BASE + timedelta(seconds=60)


def test_alerts_from_counts_are_the_same(spark):
    rows = [(s, s * s % 5) for s in range(200)] + [(s, 0) for s in range(0, 200, 2)]
    counts = op.closed_counts(frame(spark, rows))
    got = op.alerts_from_counts(counts, ["deviceId", "deviceLocation"], k=1, floor=0)
    assert seen(got) == brute_force(rows, 1, 0)
    assert got.columns == alerts(spark, rows).columns
