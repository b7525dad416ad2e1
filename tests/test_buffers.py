"""Stateful sensor buffers: any order within a batch, bounded memory, restarts,
timers, and plain versions of the rules."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from streetpulse.streaming import buffers as SB
from streetpulse.streaming import sinks as SK

START = pd.Timestamp("2024-01-01").value // 1000


def made(n, sensors=1, seed=0, span_h=40):
    rng = np.random.default_rng(seed)
    ts = START + np.sort(rng.integers(0, span_h * 3_600_000_000, n))
    return pd.DataFrame({"event_id": np.arange(n), "sensor_id": [f"Loop-{i}" for i in rng.integers(0, sensors, n)],
                         "ts": ts.astype("datetime64[us]"), "metric": rng.choice(["avg_speed", "wait_time_s"], n),
                         "value": rng.choice([1.0, 2.0, 5.0, 40.0], n)})


def plain(pdf, n=20):
    """Spikes (event_id, mean) and the newest statistics (sensor, metric) -> row."""
    spikes, stats = [], {}
    for sensor, own in pdf.sort_values(["ts", "event_id"]).groupby("sensor_id"):
        for _, m in own.groupby("metric"):
            v, ids = m["value"].to_numpy(), m["event_id"].to_numpy()
            for i in range(2, len(v)):
                mean = (v[i - 2] + v[i - 1] + v[i]) / 3.0
                if v[i] > 2 * mean:
                    spikes.append((int(ids[i]), mean))
        last = own.tail(n)
        for metric, m in last.groupby("metric"):
            stats[sensor, metric] = (m["value"].mean(), m["value"].min(), m["value"].max(), len(m), len(last),
                                     last["ts"].min(), last["ts"].max())
    return sorted(spikes), stats


def run(spark, src, base, **more):
    stream = (spark.readStream.schema("event_id long, sensor_id string, ts timestamp_ntz, metric string, value double")
              .option("maxFilesPerTrigger", 1).parquet(src))
    SB.start_buffers(stream, lambda df, i: SK.write_batch(df, base + "/t", i), base + "/c", retention="2000 hours",
                     **more).awaitTermination()
    rows = SK.read_versions(spark, base + "/t")
    spikes = sorted((r.event_id, r.avg_value) for r in rows.where("kind = 'spike'").collect())
    newest = SK.newest_rows(rows.where("kind = 'stats'")).collect()
    return spikes, {(r.sensor_id, r.metric): (r.avg_value, r.min_value, r.max_value, r["count"], r.window_size,
                                              pd.Timestamp(r.range_start), pd.Timestamp(r.range_end)) for r in newest}


def files(spark, pdf, src, parts, shuffled=False):
    for i in range(parts):
        own = pdf.iloc[len(pdf) * i // parts:len(pdf) * (i + 1) // parts]
        own = own.sample(frac=1, random_state=i) if shuffled else own
        df = spark.createDataFrame(own).select(*[F.col(c) if c != "ts" else F.col(c).cast("timestamp_ntz") for c in own.columns])
        df.coalesce(1).write.mode("append").parquet(src)


@pytest.mark.parametrize("spool_rows", [200_000, 50])
def test_any_order_within_a_batch(spark, tmp_path, spool_rows):
    pdf = made(3000, sensors=3)
    files(spark, pdf, str(tmp_path / "src"), 2, shuffled=True)
    assert run(spark, str(tmp_path / "src"), str(tmp_path), spool_rows=spool_rows) == plain(pdf)


def test_restart_goes_on_with_the_state(spark, tmp_path):
    pdf, src = made(400, sensors=2, seed=1), str(tmp_path / "src")
    files(spark, pdf.iloc[:150], src, 2)
    assert run(spark, src, str(tmp_path)) == plain(pdf.iloc[:150])
    files(spark, pdf.iloc[150:], src, 2)
    assert run(spark, src, str(tmp_path)) == plain(pdf)
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    assert "RocksDB" not in before      # the session's own setting is back


class Held(dict):
    """State variables in memory."""

    def get(self, *key):
        return super().get(*key) if key else iter(self.setdefault("list", []))

    def put(self, values):
        self["list"] = values

    def iterator(self):
        return iter(self.items())

    def updateValue(self, key, value):
        self[key] = value

    def getValue(self, key):
        return self[key]

    def removeKey(self, key):
        del self[key]


class Handle:
    def __init__(self):
        self.timers, self.states = [], {}

    def getListState(self, name, schema):
        return self.states.setdefault(name, Held())

    def getMapState(self, name, *schemas):
        return self.states.setdefault(name, Held())

    def registerTimer(self, at):
        self.timers.append(at)


class Expired:
    def __init__(self, at):
        self.at = at

    def getExpiryTimeInMs(self):
        return self.at


def test_a_million_readings_of_one_sensor_are_never_in_memory_together(monkeypatch):
    processor, handle = SB.SensorBuffer(20, 3_600_000, spool_rows=50_000), Handle()
    processor.init(handle)
    sizes, together = [], SB._together
    monkeypatch.setattr(SB, "_together", lambda parts: (lambda out: (sizes.append(len(out[0])), out)[1])(together(parts)))
    pdf = made(1_000_000, span_h=100)
    parts = (pdf.iloc[i:i + 10_000] for i in range(0, len(pdf), 10_000))
    out = pd.concat(list(processor.handleInputRows(("Loop-0",), parts, None)))
    assert max(sizes) < 75_000 and not handle.states["spool"]
    assert (out["kind"] == "spike").sum() == len(plain(pdf)[0])
    assert len(handle.states["recent"]["list"]) == 20 and len(handle.states["tails"]) == 2


def test_timer_moves_on_and_drops_idle_state():
    processor, handle = SB.SensorBuffer(5, 1000), Handle()
    processor.init(handle)
    for at in (0, 10):
        pdf = made(30, seed=at)
        pdf["ts"] = (START + at * 1_000_000 + np.arange(30)).astype("datetime64[us]")
        list(processor.handleInputRows(("Loop-0",), iter([pdf]), None))
    assert handle.timers == [START // 1000 + 1000]
    list(processor.handleExpiredTimer(("Loop-0",), None, Expired(handle.timers[0])))
    assert handle.timers[1] == START // 1000 + 11_000 and handle.states["recent"]["list"]
    list(processor.handleExpiredTimer(("Loop-0",), None, Expired(handle.timers[1])))
    assert not handle.states["recent"] and not handle.states["tails"]


def test_a_sensor_sends_one_frame_a_batch(spark):
    processor, handle = SB.SensorBuffer(20, 3_600_000), Handle()
    processor.init(handle)
    pdf = made(400, sensors=1)
    frames = list(processor.handleInputRows(("Loop-0",), iter([pdf.iloc[:200], pdf.iloc[200:]]), None))
    assert len(frames) == 1 and set(frames[0]["kind"]) == {"spike", "stats"}
    rows = spark.createDataFrame(frames[0].astype(object).where(frames[0].notna(), None), SB.OUTPUT_SCHEMA).collect()
    spikes, stats = ([r for r in rows if r.kind == k] for k in ("spike", "stats"))
    assert sorted((r.event_id, r.avg_value) for r in spikes) == plain(pdf)[0]
    assert all(r.ts is not None and r.window_size is None and r.range_start is None for r in spikes)
    assert all(r.ts is None and r.event_id is None and r.window_size == 20 and r.range_end is not None for r in stats)


def test_a_call_works_on_all_sensors_of_its_group():
    """Before, every sensor was a key: a call, its state calls and a frame for each, each micro-batch."""
    processor, handle = SB.SensorBuffer(20, 3_600_000), Handle()
    processor.init(handle)
    pdf = made(4000, sensors=60, seed=3)
    out = pd.concat([frame for part in (pdf.iloc[:2500], pdf.iloc[2500:])
                     for frame in processor.handleInputRows((7,), iter([part.sample(frac=1, random_state=1)]), None)])
    spikes, stats = plain(pdf)
    got = out[out["kind"] == "spike"]
    assert sorted(zip(got["event_id"], got["avg_value"])) == spikes
    newest = out[out["kind"] == "stats"].groupby(["sensor_id", "metric"]).last()
    assert {k: (r.avg_value, r.min_value, r.max_value, r["count"], r.window_size, r.range_start, r.range_end)
            for k, r in newest.iterrows()} == stats
    assert len(handle.states["recent"]["list"]) == 20 and len(handle.states["tails"]) == 2
    assert len(handle.timers) == 1


def test_sensors_of_a_group_are_dropped_one_by_one():
    processor, handle = SB.SensorBuffer(5, 1000), Handle()
    processor.init(handle)
    for sensor, at in (("Loop-1", 50), ("Loop-0", 10), ("Loop-2", 60)):     # Loop-0 is due before the timer that is set
        pdf = made(9, seed=at).assign(sensor_id=sensor, ts=(START + at * 1_000_000 + np.arange(9)).astype("datetime64[us]"))
        list(processor.handleInputRows((7,), iter([pdf]), None))
    assert handle.timers == [START // 1000 + 51_000, START // 1000 + 11_000]

    def held():
        return {s for v in handle.states["recent"].get() for s in SB._unpacked(v)[5]}
    list(processor.handleExpiredTimer((7,), None, Expired(handle.timers[1])))
    assert held() == {"Loop-1", "Loop-2"} and handle.timers[2] == START // 1000 + 51_000
    list(processor.handleExpiredTimer((7,), None, Expired(handle.timers[2])))
    assert held() == {"Loop-2"} and {s for v in handle.states["tails"].values() for s in SB._unpacked(v)[5]} == {"Loop-2"}
    list(processor.handleExpiredTimer((7,), None, Expired(handle.timers[3])))
    assert not handle.states["recent"] and not handle.states["tails"]
