"""Day tables: only touched days are rewritten, batches count once, readers see
one version, marks and sums."""

import os

import pytest
from pyspark.sql import functions as F

from streetpulse.streaming.day_table import DayTable, summed

SCHEMA = "sensor_id string, window_start timestamp_ntz, v double"


def rows(spark, *items):
    """(sensor, 'day hour', value) rows."""
    return spark.createDataFrame([(s, t, v) for s, t, v in items], "sensor_id string, t string, v double").select(
        "sensor_id", F.col("t").cast("timestamp_ntz").alias("window_start"), "v")


def view(df):
    return sorted((r.sensor_id, str(r.window_start)[5:13], r.v) for r in df.collect())


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.fixture()
def table(spark, tmp_path):
    return DayTable(spark, str(tmp_path / "t"), ["sensor_id", "window_start"], "window_start")


def test_second_fold_rewrites_the_new_day_only(spark, table):
    table.append(rows(spark, ("a", "2024-01-01 10:00:00", 1.0), ("a", "2024-01-02 10:00:00", 2.0)), 0, "q")
    assert table.fold()["days"] == ["2024-01-01", "2024-01-02"]
    before = files(table.path + "/data")
    table.append(rows(spark, ("a", "2024-01-03 10:00:00", 3.0)), 1, "q")
    read = table._merged(table.snapshot(), {"2024-01-03"}, table._pending("tail", table.snapshot()), {}).inputFiles()
    assert read and all("day=2024-01-03" in f for f in read)
    assert table.fold() == {"version": 2, "days": ["2024-01-03"]}
    after = files(table.path + "/data")
    assert before.items() <= after.items() and all("day=2024-01-03" in f for f in set(after) - set(before))
    assert view(table.read()) == [("a", "01-01 10", 1.0), ("a", "01-02 10", 2.0), ("a", "01-03 10", 3.0)]
    assert table.fold() == {"version": 2, "days": []}


def test_merge_on_read_equals_fold_and_replays_count_once(spark, table):
    table.append(rows(spark, ("a", "2024-01-01 10:00:00", 1.0), ("b", "2024-01-01 10:00:00", 5.0)), 0, "q")
    table.append(rows(spark, ("a", "2024-01-01 10:00:00", 2.0)), 1, "q")
    table.append(rows(spark, ("a", "2024-01-01 10:00:00", 3.0)), 1, "q")          # replay of batch 1
    want = [("a", "01-01 10", 3.0), ("b", "01-01 10", 5.0)]
    assert view(table.read()) == want
    table.fold()
    assert view(table.read()) == want
    table.append(rows(spark, ("a", "2024-01-01 10:00:00", 9.0)), 1, "q")          # replay of a folded batch
    assert view(table.read()) == want
    table.append(rows(spark, ("b", "2024-01-01 10:00:00", 6.0)), 0, "other")      # another job's first batch
    assert view(table.read()) == [("a", "01-01 10", 3.0), ("b", "01-01 10", 6.0)]


def test_a_reader_sees_one_version_during_a_fold(spark, table):
    table.append(rows(spark, ("a", "2024-01-01 10:00:00", 1.0)), 0, "q")
    table.fold()
    table.append(rows(spark, ("a", "2024-01-01 10:00:00", 2.0)), 1, "q")
    reader = table.read()
    table.append(rows(spark, ("a", "2024-01-01 11:00:00", 3.0)), 2, "q")
    table.fold()
    assert view(reader) == [("a", "01-01 10", 2.0)]
    assert view(table.read()) == [("a", "01-01 10", 2.0), ("a", "01-01 11", 3.0)]
    table.vacuum(keep=1)
    assert view(table.read()) == [("a", "01-01 10", 2.0), ("a", "01-01 11", 3.0)]
    assert len(files(table.path + "/tail")) == 0 and len({f.split("fold=")[1][:2] for f in files(table.path + "/data")}) == 1


def test_a_failed_fold_changes_nothing(spark, table, monkeypatch):
    table.append(rows(spark, ("a", "2024-01-01 10:00:00", 1.0)), 0, "q")
    monkeypatch.setattr(table.files, "put", lambda *a: False)                     # lost the race for the manifest
    with pytest.raises(RuntimeError):
        table.fold()
    monkeypatch.undo()
    assert view(table.read()) == [("a", "01-01 10", 1.0)]
    table.fold()
    assert view(table.read()) == [("a", "01-01 10", 1.0)]


def test_days_restrict_the_files_and_old_days_go(spark, table):
    table.append(rows(spark, *[("a", f"2024-01-0{d} 10:00:00", float(d)) for d in range(1, 6)]), 0, "q")
    table.fold()
    some = table.read(days=["2024-01-02", "2024-01-04"])
    assert view(some) == [("a", "01-02 10", 2.0), ("a", "01-04 10", 4.0)] and len(some.inputFiles()) == 2
    assert table.drop_days("2024-01-04")["days"] == ["2024-01-01", "2024-01-02", "2024-01-03"]
    assert view(table.read()) == [("a", "01-04 10", 4.0), ("a", "01-05 10", 5.0)]


def test_marks_write_keys_only_and_fold_in(spark, tmp_path):
    table = DayTable(spark, str(tmp_path / "alerts"), ["alert_id"], "timestamp", mark="resolved")
    df = spark.createDataFrame([("x", "2024-01-01 10:00:00", False), ("y", "2024-01-02 10:00:00", False)],
                               "alert_id string, t string, resolved boolean").select(
        "alert_id", F.col("t").cast("timestamp_ntz").alias("timestamp"), "resolved")
    table.append(df, 0, "q")
    table.fold()
    data = files(table.path + "/data")
    table.mark_keys(spark.createDataFrame([("x",), ("unknown",)], "alert_id string"), 0, "r")
    assert files(table.path + "/data") == data
    assert set(spark.read.parquet(table.path + "/marks").columns) == {"alert_id", "written_at", "query", "batch_id", "day"}
    want = [("x", True), ("y", False)]
    assert sorted((r.alert_id, r.resolved) for r in table.read().collect()) == want
    assert table.fold()["days"] == ["2024-01-01"]
    assert sorted((r.alert_id, r.resolved) for r in table.read().collect()) == want


def test_sums_merge(spark, tmp_path):
    table = DayTable(spark, str(tmp_path / "p"), ["sensor_id", "window_start"], "window_start",
                     summed(["sensor_id", "window_start"], ["v"]))
    for i in range(3):
        table.append(rows(spark, ("a", "2024-01-01 10:00:00", 1.0 + i), ("b", f"2024-01-0{i + 1} 10:00:00", 1.0)), i, "q")
        if i == 1:
            table.fold()
    want = [("a", "01-01 10", 6.0), ("b", "01-01 10", 1.0), ("b", "01-02 10", 1.0), ("b", "01-03 10", 1.0)]
    assert view(table.read()) == want
    table.fold()
    assert view(table.read()) == want
