import json
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fleetlens import plans, storage
from fleetlens.plans import manifest
from fleetlens.session import scratch_dir

from fixtures import device, values


def enriched(device_id, stamp, loc="47.37,8.52", status="accessRejected"):
    return json.dumps({"deviceId": device_id, "deviceCity": "Zürich", "deviceRegion": "Zurich",
                       "deviceLocation": loc, "messageName": "m", "eventNotificationName": status,
                       "timestamp": stamp, "eventTimestamp": stamp})


FOUR_DAYS = [enriched(f"d{n}", f"2024-03-0{day}T12:00:0{n}.000Z") for day in range(1, 5) for n in range(3)]


@pytest.fixture
def events_table(spark):
    path = scratch_dir(spark, "events")
    plans.load(values(spark, FOUR_DAYS), plans.EVENTS_GEO, path, "a")
    return path


def test_scratch_is_below_the_shared_folder(spark):
    assert scratch_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


def test_devices_are_flattened(spark):
    rows = plans.shape(values(spark, [device(1, "47.3757424811726,8.5"), device(2, "junk")]), plans.DEVICES)
    assert rows.dtypes == [
        ("__time", "timestamp"), ("payload.location.city", "string"),
        ("payload.location.countryCode", "string"), ("location", "string"),
        ("payload.location.region", "string"), ("payload.location.timezone", "string"),
        ("deviceId", "string"), ("latitude", "float"), ("longitude", "float")]
    first, second = rows.collect()
    assert first["__time"] == datetime(2010, 1, 1)
    assert (first["payload.location.city"], first["location"]) == ("Zürich", "47.3757424811726,8.5")
    assert str(first["latitude"])[:9] == "47.375743" and first["longitude"] == 8.5
    assert second["latitude"] is None and second["location"] == "junk"


def test_rows_without_a_readable_time_are_skipped(spark):
    texts = [enriched("d1", "2024-03-01T00:00:00Z"), enriched("d2", "soon"), enriched("d3", None), "bad{"]
    rows, read, kept = plans.shape_counted(values(spark, texts), plans.EVENTS_GEO)
    assert [r["deviceId"] for r in rows.collect()] == ["d1"]
    assert (read.get["n"], kept.get["n"]) == (4, 1)


def test_only_listed_columns_are_kept(spark):
    rows = plans.shape(values(spark, FOUR_DAYS), plans.EVENTS_GEO)
    assert rows.columns == ["__time", *[d.name for d in plans.EVENTS_GEO.dimensions]]
    assert "deviceLocation" not in rows.columns and "eventTimestamp" not in rows.columns


def test_alert_columns_are_typed(spark):
    text = json.dumps({"window_start": "2023-06-15T09:45:00", "window_end": "2023-06-15T09:46:00",
                       "total_count_per_deviceid": 12, "deviceId": "d1", "deviceLocation": "47.1,-8.2",
                       "avg_error_count": "3", "std_error_count": 2.9})
    row = plans.shape(values(spark, [text]), plans.ALERTS).first()
    assert row["__time"] == datetime(2023, 6, 15, 9, 46)
    assert (row["total_count_per_deviceid"], row["avg_error_count"], row["std_error_count"]) == (12, 3, 2)
    assert row["window_start"] == "2023-06-15T09:45:00" and row["deviceLongitude"] < -8.19


def test_several_values_in_one_column(spark):
    spec = plans.IngestSpec("T", "t", (plans.Dimension("tags", multi_value=True),))
    texts = [json.dumps({"t": "2024-01-01", "tags": v}) for v in (["b", "a", "b"], "one", None)]
    assert [r["tags"] for r in plans.shape(values(spark, texts), spec).collect()] == [
        ["a", "b", "b"], ["one"], None]


def test_bad_specs_are_refused():
    with pytest.raises(ValueError, match="rollup"):
        replace(plans.EVENTS_GEO, rollup=True)
    with pytest.raises(ValueError, match="duplicate"):
        plans.IngestSpec("T", "t", (plans.Dimension("a"), plans.Dimension("a")))
    with pytest.raises(ValueError, match="__time"):
        plans.IngestSpec("T", "t", (plans.Dimension("t"),))


def test_loading_twice_adds_nothing(spark, events_table):
    plans.load(values(spark, FOUR_DAYS), plans.EVENTS_GEO, events_table, "a")
    assert plans.read_table(spark, plans.EVENTS_GEO, events_table).count() == 12
    plans.load(values(spark, FOUR_DAYS[:2]), plans.EVENTS_GEO, events_table, "b")
    assert plans.read_table(spark, plans.EVENTS_GEO, events_table).count() == 14


def test_early_and_late_rows_can_be_turned_away(spark):
    path = scratch_dir(spark, "ranged")
    plans.load(values(spark, FOUR_DAYS), plans.EVENTS_GEO, path, "a",
               start=datetime(2024, 3, 2), end=datetime(2024, 3, 4))
    assert plans.list_days(spark, path) == [date(2024, 3, 2), date(2024, 3, 3)]


def test_files_hold_no_more_rows_than_the_spec_says(spark):
    path = scratch_dir(spark, "capped")
    plans.load(values(spark, FOUR_DAYS), replace(plans.EVENTS_GEO, rows_per_file=2), path, "a")
    files = spark.read.parquet(path).groupBy(F.input_file_name()).count().collect()
    assert max(r["count"] for r in files) <= 2 and sum(r["count"] for r in files) == 12


def test_scan_reads_only_the_days_asked_for(spark, events_table):
    rows = plans.scan(spark, plans.EVENTS_GEO, events_table, datetime(2024, 3, 2),
                      datetime(2024, 3, 4))
    assert rows.count() == 6
    folders = rows.select(F.input_file_name()).distinct().collect()
    assert all("__date=2024-03-02" in f[0] or "__date=2024-03-03" in f[0] for f in folders)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    # An end at midnight does not open the next day.
    assert "2024-03-04" not in plan.split("Location")[1].split("]")[0]


def test_scan_lists_only_the_days_asked_for(spark, events_table):
    rows = plans.scan(spark, plans.EVENTS_GEO, events_table, datetime(2024, 3, 2), datetime(2024, 3, 3))
    assert all("__date=2024-03-02" in f for f in rows.inputFiles()) and rows.count() == 3
    assert plans.scan(spark, plans.EVENTS_GEO, events_table, datetime(2025, 1, 1),
                      datetime(2025, 1, 2)).count() == 0


def test_a_repeated_load_replaces_all_its_days(spark, events_table):
    count = lambda: plans.read_table(spark, plans.EVENTS_GEO, events_table).count()
    plans.load(values(spark, FOUR_DAYS[:1]), plans.EVENTS_GEO, events_table, "b")
    plans.load(values(spark, FOUR_DAYS[:2]), plans.EVENTS_GEO, events_table, "a")
    assert count() == 3
    plans.load(values(spark, []), plans.EVENTS_GEO, events_table, "a")
    assert count() == 1


def test_a_view_follows_loads_and_deletions(spark, events_table):
    plans.enable(spark, plans.EVENTS_GEO, events_table)
    count = lambda: spark.sql("SELECT count(*) FROM EVENTS_GEO").first()[0]
    assert count() == 12
    plans.load(values(spark, FOUR_DAYS[:2]), plans.EVENTS_GEO, events_table, "more")
    assert count() == 14
    plans.delete_interval(spark, plans.EVENTS_GEO, events_table, date(2024, 3, 1), date(2024, 3, 3))
    assert count() == 6
    plans.delete_all(spark, events_table)
    assert count() == 0
    plans.disable(spark, plans.EVENTS_GEO)


def test_a_table_without_days_is_emptied_as_a_whole(spark):
    path = scratch_dir(spark, "devices")
    for load_id in ("a", "b"):
        plans.load(values(spark, [device(1)]), plans.DEVICES, path, load_id)
    with pytest.raises(ValueError, match="delete_all"):
        plans.delete_interval(spark, plans.DEVICES, path, date(1000, 1, 1), date(3000, 1, 1))
    plans.delete_all(spark, path)
    plans.load(values(spark, [device(1)]), plans.DEVICES, path, "c")
    assert plans.read_table(spark, plans.DEVICES, path).count() == 1


def test_filters_do_not_blow_files_up(spark):
    texts = [enriched(f"device-{n}", f"2024-03-{1 + n % 20:02d}T12:00:00Z") for n in range(3000)]
    sizes = {}
    for label, expected in (("with", 150), ("without", 0)):
        path = scratch_dir(spark, label)
        plans.load(values(spark, texts), replace(plans.EVENTS_GEO, values_per_file=expected), path, "a")
        files = plans.read_table(spark, plans.EVENTS_GEO, path).inputFiles()
        sizes[label] = sum(Path(f.removeprefix("file://")).stat().st_size for f in files)
    assert sizes["with"] <= 1.3 * sizes["without"]


def test_scan_takes_times_with_a_zone(spark, events_table):
    zone = timezone(timedelta(hours=14))
    rows = plans.scan(spark, plans.EVENTS_GEO, events_table, datetime(2024, 3, 3, 1, tzinfo=zone),
                      datetime(2024, 3, 3, 3, tzinfo=zone))
    assert {r["__date"] for r in rows.collect()} == {date(2024, 3, 2)}


def test_delete_interval(spark, events_table):
    gone = plans.delete_interval(spark, plans.EVENTS_GEO, events_table, date(1000, 1, 1), date(2024, 3, 3))
    assert gone == [date(2024, 3, 1), date(2024, 3, 2)]
    left = plans.read_table(spark, plans.EVENTS_GEO, events_table)
    assert left.count() == 6 and left.agg(F.min("__date")).first()[0] == date(2024, 3, 3)
    assert plans.delete_interval(spark, plans.EVENTS_GEO, events_table, date(2025, 1, 1), date(2026, 1, 1)) == []
    assert plans.delete_interval(spark, plans.EVENTS_GEO, scratch_dir(spark, "none"), date(2025, 1, 1), date(2026, 1, 1)) == []


def test_disable_keeps_the_data(spark, events_table):
    plans.enable(spark, plans.EVENTS_GEO, events_table)
    found = plans.query_messages(spark, "SELECT deviceId FROM EVENTS_GEO WHERE deviceId = 'd1'")
    assert [r[0] for r in found.collect()] == ['{"deviceId":"d1"}'] * 4
    assert plans.disable(spark, plans.EVENTS_GEO) and not plans.disable(spark, plans.EVENTS_GEO)
    with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
        spark.sql("SELECT * FROM EVENTS_GEO")
    assert plans.read_table(spark, plans.EVENTS_GEO, events_table).count() == 12


def test_rejected_over_time(spark):
    texts = [enriched("d1", "2024-03-01T12:00:10Z"), enriched("d2", "2024-03-01T12:00:50Z", status="accessGranted"),
             enriched("d3", "2024-03-01T12:01:10Z"), enriched("d4", "2024-03-01T12:00:10Z", loc="47.9,8.9")]
    rows = plans.rejected_over_time(plans.shape(values(spark, texts), plans.EVENTS_GEO), area=("deviceLatitude",))
    got = {(r["bucket_start"], round(r["deviceLatitude"], 2)): (r["rejected"], r["total"]) for r in rows.collect()}
    assert got == {(datetime(2024, 3, 1, 12, 0), 47.37): (1, 2), (datetime(2024, 3, 1, 12, 1), 47.37): (1, 1),
                   (datetime(2024, 3, 1, 12, 0), 47.9): (1, 1)}


def test_save_result(spark, tmp_path):
    plans.save_result(spark.range(5), "kept_rows", str(tmp_path / "kept"))
    assert spark.table("kept_rows").count() == 5
    with pytest.raises(Exception, match="ALREADY_EXISTS"):
        plans.save_result(spark.range(5), "kept_rows", str(tmp_path / "kept"))


def test_device_column_has_a_bloom_filter(spark):
    import duckdb
    events_table = scratch_dir(spark, "filtered")
    plans.load(values(spark, FOUR_DAYS), replace(plans.EVENTS_GEO, values_per_file=100), events_table, "a")
    found = duckdb.sql(f"""
        SELECT path_in_schema, bool_and(bloom_filter_offset IS NOT NULL) AS has
        FROM parquet_metadata('{events_table}/**/*.parquet') GROUP BY 1""").fetchall()
    assert {name for name, has in found if has} == {"deviceId"}


def test_without_rebalance_the_rows_are_the_same(spark, events_table):
    path = scratch_dir(spark, "plain")
    plans.load(values(spark, FOUR_DAYS), plans.EVENTS_GEO, path, "a", rebalance=False)
    a, b = (sorted(map(tuple, plans.read_table(spark, plans.EVENTS_GEO, p).collect()))
            for p in (path, events_table))
    assert a == b


# The log ---------------------------------------------------------------------------

def stored(spark, path):
    return sorted((r["deviceId"], r["__time"]) for r in plans.read_table(spark, plans.EVENTS_GEO, path).collect())


def test_load_names():
    names = manifest.LoadNames.of("s-3") | manifest.LoadNames.of("x") | manifest.LoadNames.of("s-5")
    names = names | manifest.LoadNames.of("s-4") | manifest.LoadNames.of("s-4")
    assert names.names == {"-s": [[3, 5]], "=x": []}
    assert all(n in names for n in ("s-3", "s-4", "s-5", "x"))
    assert not any(n in names for n in ("s-2", "s-6", "s-04", "s", "y", "t-4"))


def file_system_calls(spark, monkeypatch, work):
    """Calls of ours, and files that Spark has listed."""
    calls, found = [], spark._jvm.org.apache.spark.metrics.source.HiveCatalogMetrics.METRIC_FILES_DISCOVERED()
    real = storage.file_system

    def counted(session, path):
        calls.append(path)
        return real(session, path)

    for module in (storage, manifest):
        monkeypatch.setattr(module, "file_system", counted)
    before = found.getCount()
    work()
    monkeypatch.undo()
    return len(calls), found.getCount() - before


def test_a_load_costs_the_same_however_many_days_there_are(spark, monkeypatch):
    costs = {}
    for days in (2, 25):
        path = scratch_dir(spark, f"days-{days}")
        texts = [enriched("d", f"2024-03-{d:02d}T12:00:00Z") for d in range(1, days + 1)]
        plans.load(values(spark, texts), plans.EVENTS_GEO, path, "history")
        plans.enable(spark, plans.EVENTS_GEO, path)
        costs[days] = file_system_calls(spark, monkeypatch, lambda: plans.load(
            values(spark, FOUR_DAYS[:1]), plans.EVENTS_GEO, path, "more"))
        assert spark.sql("SELECT count(*) FROM EVENTS_GEO").first()[0] == days + 1
        plans.disable(spark, plans.EVENTS_GEO)
    assert costs[2] == costs[25]


def test_a_view_lists_the_days_a_query_asks_for(spark, events_table):
    plans.enable(spark, plans.EVENTS_GEO, events_table)
    rows = spark.sql("SELECT * FROM EVENTS_GEO WHERE __date = DATE'2024-03-02'")
    assert rows.count() == 3
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(__date" in plan
    plans.disable(spark, plans.EVENTS_GEO)


def test_two_sessions_have_tables_of_one_name(spark, events_table):
    other, path = spark.newSession(), scratch_dir(spark, "other")
    plans.load(values(spark, FOUR_DAYS[:2]), plans.EVENTS_GEO, path, "a")
    plans.enable(spark, plans.EVENTS_GEO, events_table)
    plans.enable(other, plans.EVENTS_GEO, path)
    plans.load(values(spark, FOUR_DAYS[:1]), plans.EVENTS_GEO, path, "b")
    assert [s.sql("SELECT count(*) FROM EVENTS_GEO").first()[0] for s in (spark, other)] == [12, 3]
    plans.disable(other, plans.EVENTS_GEO)
    assert spark.sql("SELECT count(*) FROM EVENTS_GEO").first()[0] == 12
    plans.disable(spark, plans.EVENTS_GEO)


def test_the_log_is_read_anew_and_stays_short(spark, monkeypatch):
    monkeypatch.setattr(manifest, "SNAPSHOT_EVERY", 4)
    path = scratch_dir(spark, "log")
    for n in range(11):
        plans.load(values(spark, FOUR_DAYS[n:n + 1]), plans.EVENTS_GEO, path, f"s-{n}")
    names = storage.names(spark, f"{path}/_loads")
    assert len([n for n in names if n.endswith(".json")]) <= 2 * 4 + 2
    known = manifest.current(spark, path)
    manifest._KNOWN.clear()
    again = manifest.current(spark, path)
    assert (again.version, again.folders, again.recent) == (11, known.folders, known.recent)
    assert len(stored(spark, path)) == 11


def test_of_two_writers_both_are_entered(spark, events_table, monkeypatch):
    """Another process takes the number that this one was about to take."""
    real, taken = manifest.write_json_new, []

    def raced(session, folder, name, content):
        if not taken:
            taken.append(name)
            real(session, folder, name, {"load": "theirs", "folders": {}, "at": "", "read": 5, "kept": 0})
        return real(session, folder, name, content)

    monkeypatch.setattr(manifest, "write_json_new", raced)
    plans.load(values(spark, FOUR_DAYS[:1]), plans.EVENTS_GEO, events_table, "ours")
    assert [r.load_id for r in plans.load_history(spark, events_table)] == ["a", "theirs", "ours"]
    assert len(stored(spark, events_table)) == 13


def test_what_is_not_entered_is_not_there(spark, events_table, monkeypatch):
    def fails(*_):
        raise OSError("no connection")

    monkeypatch.setattr(manifest, "write_json_new", fails)
    with pytest.raises(OSError):
        plans.load(values(spark, FOUR_DAYS), plans.EVENTS_GEO, events_table, "b")
    monkeypatch.undo()
    assert len(stored(spark, events_table)) == 12
    assert plans.remove_unused(spark, events_table) == 0  # it may still be entered
    assert plans.remove_unused(spark, events_table, timedelta(0)) == 1
    assert len(stored(spark, events_table)) == 12


def test_compaction(spark):
    path = scratch_dir(spark, "compacted")
    for n, text in enumerate(FOUR_DAYS):
        plans.load(values(spark, [text]), plans.EVENTS_GEO, path, f"s-{n}")
    before = stored(spark, path)
    earlier = plans.read_table(spark, plans.EVENTS_GEO, path)
    assert plans.compact(spark, plans.EVENTS_GEO, path, before=date(2024, 3, 3)) == [date(2024, 3, 1), date(2024, 3, 2)]
    assert stored(spark, path) == before
    assert len(plans.read_table(spark, plans.EVENTS_GEO, path).inputFiles()) == 2 + 6
    assert earlier.count() == 12  # a reader that began before the swap
    assert plans.compact(spark, plans.EVENTS_GEO, path, before=date(2024, 3, 3)) == []
    # A load that was compacted with others is made again, in a view too.
    plans.enable(spark, plans.EVENTS_GEO, path)
    plans.load(values(spark, [enriched("new", "2024-03-02T00:00:00Z")]), plans.EVENTS_GEO, path, "s-1")
    want = sorted([r for r in before if r != ("d1", datetime(2024, 3, 1, 12, 0, 1))]
                  + [("new", datetime(2024, 3, 2))])
    seen = spark.sql("SELECT deviceId, __time FROM EVENTS_GEO").collect()
    assert stored(spark, path) == sorted(map(tuple, seen)) == want
    plans.load(values(spark, []), plans.EVENTS_GEO, path, "s-0")
    plans.load(values(spark, []), plans.EVENTS_GEO, path, "s-2")
    plans.compact(spark, plans.EVENTS_GEO, path)
    assert stored(spark, path) == [r for r in want if r[1].day > 1] and len(want) == 12
    assert spark.sql("SELECT count(*) FROM EVENTS_GEO").first()[0] == 10
    plans.disable(spark, plans.EVENTS_GEO)
    assert plans.remove_unused(spark, path, timedelta(0)) > 0
    assert len(stored(spark, path)) == 10


def test_compaction_leaves_days_alone_that_change_meanwhile(spark, monkeypatch):
    path = scratch_dir(spark, "raced")
    for n, text in enumerate(FOUR_DAYS):
        plans.load(values(spark, [text]), plans.EVENTS_GEO, path, f"s-{n}")
    from fleetlens.plans import maintenance
    real = maintenance.write_part

    def slow(*args):
        part = real(*args)
        plans.load(values(spark, []), plans.EVENTS_GEO, path, "s-0")
        plans.delete_interval(spark, plans.EVENTS_GEO, path, date(2024, 3, 2), date(2024, 3, 3))
        return part

    monkeypatch.setattr(maintenance, "write_part", slow)
    done = plans.compact(spark, plans.EVENTS_GEO, path)
    assert done == [date(2024, 3, 3), date(2024, 3, 4)]
    assert [t.day for _, t in stored(spark, path)].count(1) == 2 and len(stored(spark, path)) == 8


def test_compaction_of_a_table_without_days(spark):
    path = scratch_dir(spark, "devices")
    for n in range(3):
        plans.load(values(spark, [device(n)]), plans.DEVICES, path, f"s-{n}")
    assert plans.compact(spark, plans.DEVICES, path, before=date(2024, 1, 1)) == []
    rows = plans.read_table(spark, plans.DEVICES, path)
    assert rows.count() == 3 and len(rows.inputFiles()) == 1
    plans.enable(spark, plans.DEVICES, path)
    assert spark.sql("SELECT `payload.location.city` FROM DEVICES").count() == 3
    plans.disable(spark, plans.DEVICES)


def test_replace_interval(spark, events_table):
    days = (date(2024, 3, 2), date(2024, 3, 4))
    one = spark.createDataFrame([(datetime(2024, 3, 3), "only", 1)], "__time TIMESTAMP, DEVICEID STRING, x INT")
    report = plans.replace_interval(spark, plans.EVENTS_GEO, events_table, one, *days, "fix")
    assert (report.kept, report.days) == (1, (date(2024, 3, 3),))
    assert [d for d, _ in stored(spark, events_table)].count("only") == 1 and len(stored(spark, events_table)) == 7
    for wrong in (datetime(2024, 3, 4), None):
        rows = spark.createDataFrame([(wrong, "d")], "__time TIMESTAMP, deviceId STRING")
        with pytest.raises(Exception, match="outside the interval"):
            plans.replace_interval(spark, plans.EVENTS_GEO, events_table, rows, *days, "fix")
    assert len(stored(spark, events_table)) == 7
    plans.replace_interval(spark, plans.EVENTS_GEO, events_table, one.limit(0), *days, "fix")
    assert len(stored(spark, events_table)) == 6
    with pytest.raises(ValueError, match="no days"):
        plans.replace_interval(spark, plans.DEVICES, events_table, one, *days, "fix")


def test_loads_report_what_they_have_dropped(spark):
    path = scratch_dir(spark, "counted")
    texts = [*FOUR_DAYS[:4], "bad{", enriched("d", "soon")]
    report = plans.load(values(spark, texts), plans.EVENTS_GEO, path, "a", end=datetime(2024, 3, 2))
    assert (report.read, report.kept, report.dropped, report.days) == (6, 3, 3, (date(2024, 3, 1),))
    assert plans.load(values(spark, []), plans.EVENTS_GEO, path, "b").read == 0
    assert [(r.load_id, r.dropped) for r in plans.load_history(spark, path)] == [("a", 3), ("b", 0)]


# Sketches and lookups ---------------------------------------------------------------

def test_sketches_of_days_add_up(spark):
    rows = spark.range(30_000).selectExpr("date_add(DATE'2024-03-01', CAST(id % 3 AS INT)) AS __date",
                                          "CAST(id % 2 AS STRING) AS `a.b`", "id % 1000 AS device", "id AS value")
    sketches = plans.day_sketches(rows, ["a.b"], ["device"], ["value"])
    assert sketches.count() == 6 and sketches.agg(F.sum("rows")).first()[0] == 30_000
    found = plans.merged(sketches).select("rows", plans.distinct_count("device").alias("n"),
                                          plans.quantile("value", 0.25).alias("q")).first()
    assert found["rows"] == 30_000 and abs(found["n"] - 1000) < 50 and abs(found["q"] - 7500) < 1500
    some = plans.merged(sketches.where("`a.b` = '1'"), ["__date"]).select(plans.distinct_count("device").alias("n"))
    assert all(abs(r["n"] - 500) < 30 for r in some.collect())


def test_sketches_of_nothing(spark):
    rows = spark.createDataFrame([(date(2024, 3, 1), None, None)], "__date DATE, device STRING, value DOUBLE")
    found = plans.merged(plans.day_sketches(rows, (), ["device"], ["value"])).select(
        "rows", plans.distinct_count("device").alias("n"), plans.quantile("value", 0.5).alias("q")).first()
    assert tuple(found) == (1, 0, None)
    assert plans.day_sketches(rows.limit(0), (), ["device"], ["value"]).count() == 0


def test_lookup(spark):
    lookup = plans.Lookup(scratch_dir(spark, "lookup"), "k", keep=2)
    with pytest.raises(ValueError, match="nothing published"):
        lookup.rows(spark)
    version = lambda *names: spark.createDataFrame(list(enumerate(names)), "k INT, name STRING")
    assert lookup.publish(version("a", "b")) == 1
    begun = lookup.rows(spark)
    assert lookup.publish(version("x")) == 2
    rows = spark.createDataFrame([(0, "r"), (1, "s"), (None, "t")], "k INT, row STRING")
    assert sorted((r["row"], r["name"]) for r in lookup.join(rows).collect()) == [("r", "x"), ("s", None), ("t", None)]
    assert sorted(r["name"] for r in begun.collect()) == ["a", "b"]
    shuffled = lookup.join(rows, limit=0)
    assert shuffled.count() == 3 and shuffled.columns == ["k", "row", "name"]
    for wrong in (version("a").unionByName(version("b")), spark.createDataFrame([(None, "z")], "k INT, name STRING")):
        with pytest.raises(ValueError, match="null or repeated"):
            lookup.publish(wrong)
    assert [lookup.publish(version("y")) for _ in range(2)] == [3, 4] and lookup.versions(spark) == [3, 4]
