"""One-pass ingestion, paged tables, clustered tables, redelivered alerts."""

import json

from pyspark.sql import functions as F

from streetpulse import schema
from streetpulse.operators.pages import PagedTable
from streetpulse.sources.clustered import clustered, write_clustered
from streetpulse.streaming import alerting as SA
from streetpulse.streaming import ingest as SI


def message(**fields):
    return json.dumps({"sensor_id": "Loop-0001", "ts": "2024-01-01T10:00:00Z", "metric": "avg_speed", "value": 50.0, **fields})


MESSAGES = {
    1: (message(), "good"), 2: (message(value=500.0), "invalid"), 3: ("{broken", "dead"), 4: ("", "dead"), 5: (None, "dead"),
    6: (message(sensor_id=None), "dead"), 7: (message(ts="noon"), "dead"), 8: (message(value="many"), "dead"),
    9: ('["a list"]', "dead"), 10: (message(metric="queue_len", value=5), "good"), 11: (message(value=1e15), "dead"),
    12: ('{"sensor_id": "Loop-0001", "ts": "2024-01-01T10:00:00Z", "metric": "avg_speed", "value": 5', "dead")}


def test_every_message_is_in_one_table_and_dead_text_is_kept(spark, tmp_path):
    src, base = str(tmp_path / "src"), str(tmp_path)
    df = spark.createDataFrame([(i, t) for i, (t, _) in MESSAGES.items()], "offset long, value string")
    df.repartition(3).write.parquet(src)
    stream = spark.readStream.schema(df.schema).parquet(src)
    for _ in range(2):      # a restart adds nothing
        SI.start_ingest(stream, schema.valid_ranges(spark), base + "/t", base + "/c").awaitTermination()
    got = {o: {r.offset: r for r in SI.read_outcome(spark, base + "/t", o).collect()} for o in SI.OUTCOMES}
    assert {o: set(rows) for o, rows in got.items()} == {o: {i for i, (_, x) in MESSAGES.items() if x == o} for o in SI.OUTCOMES}
    assert all(got["dead"][i].raw == MESSAGES[i][0] and got["dead"][i].reason for i in got["dead"])
    assert got["dead"][7].reason == "missing or unreadable: ts" and got["dead"][3].reason == "not a message"
    assert got["invalid"][2].reason.startswith("Out of range") and got["good"][10].value == 5.0


def table(spark, path, n=1000, rows_per_part=90):
    df = spark.range(n).select((F.col("id") * 37 % n).alias("a"), F.col("id").cast("string").alias("b"))
    return PagedTable.write(df, path, ["-a", "b"], rows_per_part)


def test_pages_by_number_and_by_key(spark, tmp_path):
    t = table(spark, str(tmp_path / "p"))
    want = list(range(999, -1, -1))
    for number in (1, 2, 17, 34):
        assert [r.a for r in t.page(number).collect()] == want[(number - 1) * 30:number * 30]
    assert t.page(35).count() == 0
    seen, key = [], None
    while True:
        rows = (t.page(1) if key is None else t.after(key)).collect()
        if not rows:
            break
        seen += [r.a for r in rows]
        key = (-rows[-1].a, rows[-1].b)
    assert seen == want
    assert t.after((-500, "zzz")).first().a == 499 and t.after((5, "")).count() == 0 and t.after((-2000, "")).first().a == 999
    assert t.total().first().asDict() == {"total": 1000, "pages": 34, "per_page": 30}


def test_a_deep_page_reads_few_parts_and_sorts_no_more(spark, tmp_path):
    t = table(spark, str(tmp_path / "p"), 2000, 100)
    page = t.page(50)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "part#" in plan.split("PartitionFilters: ")[1][:60] and "rangepartitioning" not in plan
    scanned = spark.read.parquet(t.path + "/rows").where(F.col("part").isin(
        [r.part for r in t.fences().where("before < 1500 AND before + n > 1470").collect()]))
    assert scanned.select("part").distinct().count() <= 2


def test_empty_paged_table(spark, tmp_path):
    t = table(spark, str(tmp_path / "p"), 0)
    assert t.page(1).count() == 0 and t.after((0, "")).count() == 0 and t.total().first().pages == 0


def test_clustered_tables_join_without_an_exchange_and_skip_files(spark, tmp_path):
    minutes = spark.range(5000).selectExpr("concat('s', id % 50) AS sensor_id", "id AS window_start", "id * 1.0 AS v")
    sensors = spark.range(50).selectExpr("concat('s', id) AS sensor_id", "IF(id % 2 = 0, 'x', 'y') AS type")
    write_clustered(minutes, "t_minutes", str(tmp_path / "m"), "window_start", 4)
    write_clustered(sensors, "t_sensors", str(tmp_path / "s"), None, 4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        joined = clustered(spark, "t_minutes").join(clustered(spark, "t_sensors").where("type = 'x'"), "sensor_id", "left_semi")
        assert joined.count() == 2500
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    one = clustered(spark, "t_minutes").where("sensor_id = 's7'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert one.count() == 100 and "EqualTo(sensor_id,s7)" in plan
    files = [clustered(spark, "t_minutes").inputFiles(), [r[0] for r in one.select(F.input_file_name()).distinct().collect()]]
    assert [len(f) for f in files] == [4, 1]
    for t in ("t_minutes", "t_sensors"):
        spark.sql(f"DROP TABLE {t}")


def test_redelivered_alerts_are_notified_once(spark, tmp_path):
    src = str(tmp_path / "src")
    df = spark.createDataFrame([("a", "2024-01-01 10:00:00"), ("b", "2024-01-01 10:05:00")], "alert_id string, t string").select(
        "alert_id", F.col("t").cast("timestamp_ntz").alias("timestamp"))
    for i in range(3):
        df.where("alert_id = 'a' OR " + str(i > 0).lower()).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    q = (SA.once_each(stream).writeStream.format("parquet").option("path", str(tmp_path / "out")).outputMode("append")
         .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r.alert_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]
