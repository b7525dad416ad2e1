"""Count-based state per sensor (T4) with the running spike check.

A stateful processor keeps, per sensor, the last ``n`` readings across all
metrics (ordered by event time, ties by event_id) and the last three values per
metric. Each micro-batch emits the buffer's per-metric statistics of every sensor
it has readings of (``kind = 'stats'``, the on-demand aggregates of A2) and every
reading that is a spike (``kind = 'spike'``, the Q4 rule checked on every
reading). State lives in the RocksDB store; an event-time timer drops a sensor's
after ``retention`` without data (T5).

A call of the processor costs some milliseconds, however few rows it has. So the
sensors are dealt by a hash into ``groups``, and a call works on all readings of
a group at once, as arrays: what a micro-batch costs follows its readings, not
its sensors times a call. The state of a group is a list of the newest, second
newest, ... reading of each sensor and a map of each metric's last readings, as
Arrow blobs. ``groups`` belongs to the checkpoint: it must not change.

A group's readings of a micro-batch arrive as a stream of Arrow batches in any
order. The newest ``n`` are kept as they pass. The spike rule needs event-time
order: up to ``spool_rows`` readings are sorted in memory; what is beyond goes to
a map state keyed by time bucket, on the store's disk, and is taken back bucket
by bucket, so a group with any number of readings in one batch holds
``spool_rows`` plus one bucket in memory. Readings older than the buffer's
oldest are dropped when it is full, so for on-time data the result equals the
batch operators Q3/A2/Q4.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..session import rocksdb_state, state_partitions

OUTPUT_SCHEMA = ("kind string, sensor_id string, metric string, event_id long, ts timestamp, value double, "
                 "avg_value double, min_value double, max_value double, count long, window_size long, "
                 "range_start timestamp, range_end timestamp")
_NAT = np.iinfo(np.int64).min    # the number of a missing time
_BLOB = "readings binary"
_KINDS = (np.int64, np.int64, object, np.float64, bool, object)
_STORED = ("event_id", "ts_us", "metric", "value", "old", "sensor_id")
SPIKE_VALUES = 3
GROUPS = 512


def _arrays(*columns) -> list[np.ndarray]:
    """Readings as arrays event_id, ts_us, metric, value, old, sensor_id."""
    return [np.asarray(c, dtype=k) for c, k in zip(columns, _KINDS)]


_NONE = _arrays(*[[]] * 6)


def _together(parts: list) -> list[np.ndarray]:
    return [np.concatenate(c) for c in zip(*parts)] if parts else _NONE


def _taken(readings: list[np.ndarray], which) -> list[np.ndarray]:
    return [c[which] for c in readings]


def _packed(readings: list[np.ndarray]) -> tuple[bytes]:
    """Readings as a state value."""
    batch = pa.record_batch([pa.array(c) if c.dtype != object else pa.array(c, pa.string()) for c in readings], names=_STORED)
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as writer:
        writer.write_batch(batch)
    return (out.getvalue().to_pybytes(),)


def _unpacked(value) -> list[np.ndarray]:
    table = pa.ipc.open_stream(pa.py_buffer(bytes(value[0]))).read_all()
    return _arrays(*[c.to_numpy() for c in table.columns])


def _by(readings: list[np.ndarray], per_metric: bool) -> tuple[list[np.ndarray], np.ndarray]:
    """Readings ordered by sensor (and metric) and time, ties by event_id, and
    where each sensor (and metric) starts in that order."""
    own = pd.factorize(readings[5])[0]
    if per_metric:
        kind, kinds = pd.factorize(readings[2])
        own = own * (len(kinds) + 1) + kind
    order = np.lexsort((readings[0], readings[1], own))
    own = own[order]
    return _taken(readings, order), np.flatnonzero(np.concatenate([[True], own[1:] != own[:-1]])[:len(own)])


def _age(starts: np.ndarray, rows: int) -> np.ndarray:
    """Of ordered readings: how many of its sensor (and metric) are newer."""
    ends = np.append(starts, rows)[1:]
    return np.repeat(ends, ends - starts) - 1 - np.arange(rows)


def newest(readings: list[np.ndarray], n: int, per_metric: bool = False) -> list[np.ndarray]:
    """The last ``n`` readings of each sensor (and metric), ordered by sensor and time."""
    readings, starts = _by(readings, per_metric)
    return _taken(readings, _age(starts, len(readings[0])) < n)


def find_spikes(readings: list[np.ndarray]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """The spikes among the readings that are not old, with the mean of the last
    three as last column, and each sensor's and metric's last readings."""
    readings, starts = _by(readings, per_metric=True)
    value, old, rows = readings[3], readings[4], len(readings[0])
    place = np.arange(rows) - np.repeat(starts, np.diff(np.append(starts, rows)))
    recent = (value[:-2] + value[1:-1] + value[2:]) / 3.0
    hit = np.flatnonzero((place[2:] >= 2) & ~old[2:] & (value[2:] > recent * 2))
    last = _taken(readings, _age(starts, rows) < SPIKE_VALUES)
    last[4] = np.ones(len(last[0]), bool)
    return [*_taken(readings, hit + 2), recent[hit]], last


class SensorBuffer(StatefulProcessor):
    def __init__(self, n: int, retention_ms: int, spool_rows: int = 200_000, bucket_us: int = 3_600_000_000):
        self.n, self.retention_ms, self.spool_rows, self.bucket_us = n, retention_ms, spool_rows, bucket_us

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.recent = handle.getListState("recent", _BLOB)
        self.tails = handle.getMapState("tails", "metric string", _BLOB)
        self.spool = handle.getMapState("spool", "bucket long, seq long", _BLOB)

    def close(self) -> None:
        pass

    def _to_spool(self, parts: list, buckets: dict) -> None:
        readings = _together(parts)
        bucket = readings[1] // self.bucket_us
        order = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[order])) + 1
        for own in np.split(order, cuts):
            key = int(bucket[own[0]])
            seq = buckets.get(key, 0)
            self.spool.updateValue((key, seq), _packed(_taken(readings, own)))
            buckets[key] = seq + 1

    def _from_spool(self, bucket: int, parts: int) -> list[np.ndarray]:
        taken = []
        for seq in range(parts):
            taken.append(_unpacked(self.spool.getValue((bucket, seq))))
            self.spool.removeKey((bucket, seq))
        return _together(taken)

    def _put_recent(self, recent: list[np.ndarray]) -> None:
        """The k-th value of the list: the k-th newest reading of each sensor."""
        recent, starts = _by(recent, per_metric=False)
        age = _age(starts, len(recent[0]))
        self.recent.put([_packed(_taken(recent, age == k)) for k in range(int(age.max()) + 1)])

    def _due(self, recent: list[np.ndarray]) -> pd.Series:
        """When each sensor's state is dropped, if nothing more comes."""
        return pd.Series(recent[1]).groupby(recent[5]).max() // 1000 + self.retention_ms

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        recent = newest(_together([_unpacked(v) for v in self.recent.get()]), self.n)
        due = self._due(recent)
        tails = [_unpacked(v) for _, v in list(self.tails.iterator())] if len(due) else []
        pending, waiting, buckets = list(tails), 0, {}
        sensors, metrics = set(), set()
        for pdf in rows:
            ts = pdf["ts"].to_numpy().astype("datetime64[us]").astype(np.int64)
            new = _arrays(pdf["event_id"], ts, pdf["metric"], pdf["value"], np.zeros(len(pdf), bool), pdf["sensor_id"])
            recent = newest(_together([recent, new]), self.n)
            sensors.update(pd.unique(new[5]))
            metrics.update(pd.unique(new[2]))
            pending.append(new)
            waiting += len(pdf)
            if waiting > self.spool_rows:
                self._to_spool(pending, buckets)
                pending, waiting = [], 0
        if buckets:
            spikes, last = None, _NONE
            if pending:
                self._to_spool(pending, buckets)
            for bucket in sorted(buckets):
                found, last = find_spikes(_together([last, self._from_spool(bucket, buckets[bucket])]))
                if len(found[0]):
                    yield _frame(found)
        else:
            spikes, last = find_spikes(_together(pending))
        for metric in sorted(metrics):
            self.tails.updateValue((metric,), _packed(_taken(last, last[2] == metric)))
        recent[4] = np.ones(len(recent[0]), bool)
        self._put_recent(recent)
        # One timer a group, moved on when it expires; none of its sensors is due before it.
        first = self._due(recent).drop(due.index).min()
        if not first >= due.min() and first == first:
            self.handle.registerTimer(int(first))
        yield _frame(spikes, _taken(recent, pd.Series(recent[5]).isin(sensors).to_numpy()))  # one frame: each costs more than its rows

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        recent = newest(_together([_unpacked(v) for v in self.recent.get()]), self.n)
        due = self._due(recent)
        over = due.index[due <= expiredTimerInfo.getExpiryTimeInMs()]
        if len(over) == len(due):
            self.recent.clear()
            self.tails.clear()
            return iter([])
        if len(over):
            self._put_recent(_taken(recent, ~pd.Series(recent[5]).isin(over).to_numpy()))
            for (metric,), value in list(self.tails.iterator()):
                last = _unpacked(value)
                left = _taken(last, ~pd.Series(last[5]).isin(over).to_numpy())
                if len(left[0]):
                    self.tails.updateValue((metric,), _packed(left))
                else:
                    self.tails.removeKey((metric,))
        self.handle.registerTimer(int(due.drop(over).min()))
        return iter([])


def _frame(spikes: list[np.ndarray] | None, recent: list[np.ndarray] = _NONE) -> pd.DataFrame:
    """Output rows: the spikes, then the buffers' statistics per sensor and
    metric. Columns a row does not have are null."""
    ids, at, metric, value, _, sensor, mean = spikes if spikes is not None else [*_NONE, _NONE[3]]
    n = len(ids)
    by_time, first = _by(recent, per_metric=False)
    sizes = np.diff(np.append(first, len(by_time[0])))
    windows = pd.DataFrame({"size": sizes, "start": by_time[1][first], "end": by_time[1][first + sizes - 1]}, by_time[5][first])
    own, starts = _by(recent, per_metric=True)
    k = len(starts)
    counts = np.diff(np.append(starts, len(own[0])))
    window = windows.loc[own[5][starts]]

    def stat(how):
        return how.reduceat(own[3], starts) if k else _NONE[3]

    def column(spike, stats, dtype=object):
        """A column of the spikes' and the statistics' values; None: all null."""
        empty = np.nan if dtype is np.float64 else None
        return np.concatenate([np.full(m, empty, dtype) if c is None else np.asarray(c).astype(dtype)
                               for c, m in ((spike, n), (stats, k))])

    def times(spike, stats):
        return np.concatenate([np.full(m, _NAT, np.int64) if c is None else np.asarray(c, np.int64)
                               for c, m in ((spike, n), (stats, k))]).view("datetime64[us]")
    return pd.DataFrame({
        "kind": column(np.full(n, "spike", object), np.full(k, "stats", object)), "sensor_id": column(sensor, own[5][starts]),
        "metric": column(metric, own[2][starts]), "event_id": column(ids, None), "ts": times(at, None),
        "value": column(value, None, np.float64),
        "avg_value": column(mean, stat(np.add) / counts, np.float64),
        "min_value": column(None, stat(np.minimum), np.float64),
        "max_value": column(None, stat(np.maximum), np.float64),
        "count": column(None, counts), "window_size": column(None, window["size"]),
        "range_start": times(None, window["start"]), "range_end": times(None, window["end"])}, copy=False)


def buffered_stream(readings: DataFrame, n: int = 20, retention: str = "24 hours", spool_rows: int = 200_000,
                    groups: int = GROUPS) -> DataFrame:
    """T4/T6 over a readings stream (``ts`` cast to TIMESTAMP, watermarked by
    the retention so that idle sensors' state times out). Start it within
    ``rocksdb_state``, or with ``start_buffers``."""
    r = (readings.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", retention)
         .select("sensor_id", "event_id", "ts", "metric", "value", F.pmod(F.xxhash64("sensor_id"), F.lit(groups)).alias("part")))
    kept = pd.Timedelta(retention)  # fails on a text that is no duration
    processor = SensorBuffer(n, int(kept.total_seconds() * 1000), spool_rows)
    return r.groupBy("part").transformWithStateInPandas(processor, OUTPUT_SCHEMA, "Append", "EventTime")


def start_buffers(readings: DataFrame, sink, checkpoint: str, n: int = 20, retention: str = "24 hours",
                  spool_rows: int = 200_000, trigger: dict | None = None, groups: int = GROUPS):
    """Run T4/T6; ``sink(df, batch_id)`` takes each micro-batch's rows."""
    stream = buffered_stream(readings, n, retention, spool_rows, groups)
    with rocksdb_state(readings.sparkSession), state_partitions(readings.sparkSession):
        return (stream.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"availableNow": True})).start())
