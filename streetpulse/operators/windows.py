"""Time and row windows: per-minute means (A1) laid out wide (P9), the minute
table (D3) with status and breaches (B1), last-N readings (Q3, A2), latest row
(Q1), newest-N (Q2), spike rule (Q4), sliding windows (T3) and retention (T5).

Scale notes
* Aggregations are hash aggregations with a map-side partial step, so a hot
  sensor is pre-aggregated on every map task before the shuffle.
* "Latest row" is ``max_by`` in an aggregation (partial, no per-key sort).
* "Newest N" filters ``row_number() <= N``: Spark plans a per-partition group
  limit before the shuffle, so at most N rows per key and map task move.
* Running windows over a key's whole history (Q3 running form, Q4): keys with
  more than a million rows are split into hour buckets with a halo of the
  previous rows, so a hot key is spread over many tasks; other keys are not
  split (no halo overhead for sparse keys).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schema
from ..functions.columns import mean, minute_floor, time_floor
from ..sources.fixtures import sensor_type_from_id

HOT_KEY_ROWS = 1_000_000  # a key above this many rows is split into time buckets

# --------------------------------------------------------------------------- A1
def minute_means(valid: DataFrame) -> DataFrame:
    """A1 (long form): mean, count per (sensor_id, window_start, metric)."""
    return (valid.groupBy("sensor_id", minute_floor("ts").alias("window_start"), "metric")
            .agg(mean("value").alias("mean_value"), F.count("*").alias("n")))


def _reading_type(metric: str) -> Column:
    """Type a reading of ``metric`` has (P3): id prefix, else by metric."""
    if metric in schema.AIR_METRICS:
        fallback = "air_quality"
    elif metric in schema.NOISE_METRICS:
        fallback = "noise"
    else:
        fallback = "traffic_loop"
    return F.coalesce(sensor_type_from_id(F.col("sensor_id")), F.lit(fallback))


def breach_severity(value: Column, warning: float, critical: float, direction: str) -> Column:
    """P5 rule on one value: 'critical' | 'warning' | null."""
    if direction == "low":
        return F.when(value <= critical, "critical").when(value <= warning, "warning")
    return F.when(value >= critical, "critical").when(value >= warning, "warning")


# ----------------------------------------------------------------- P9 + B1 (D3)
def aggregates_minute(valid: DataFrame, limits=None, event_time_window: bool = False) -> DataFrame:
    """D3 rows from valid readings in ONE aggregation (one shuffle on
    (sensor_id, window_start)): wide per-minute means (P9), and from the limits
    (D9) the breached metrics (``breaches``, sorted set) and ``status``
    (ALERT if any critical, WARN if any warning, else OK) (B1).

    ``event_time_window``: group by ``window(ts, '1 minute')`` (needed by a
    watermarked stream, T1); ``ts`` must then be a TIMESTAMP."""
    aggs = [mean(F.when(F.col("metric") == m, F.col("value"))).alias(m) for m in minute_metrics(limits)]
    if event_time_window:
        g = (valid.groupBy("sensor_id", F.window("ts", "1 minute").alias("_w")).agg(*aggs)
             .withColumn("window_start", F.col("_w.start").cast("timestamp_ntz")).drop("_w"))
    else:
        g = valid.groupBy("sensor_id", minute_floor("ts").alias("window_start")).agg(*aggs)
    return minute_rows(g, limits)


def minute_metrics(limits=None) -> list[str]:
    """Metrics a minute row needs: those of its columns and those with limits."""
    wide_metrics = [m for m, _ in schema.WIDE_COLUMNS]
    return wide_metrics + sorted({m for _, m, *_ in (limits if limits is not None else schema.ALERT_LIMITS)} - set(wide_metrics))


def minute_rows(g: DataFrame, limits=None) -> DataFrame:
    """D3 rows from one row per (sensor_id, window_start) with a mean per metric
    (P9), with the breached metrics and the status of the means (B1)."""
    limits = list(limits if limits is not None else schema.ALERT_LIMITS)
    sev_terms, rank_terms = [], []
    for stype, metric, warning, critical, direction in limits:
        sev = F.when(_reading_type(metric) == stype,
                     breach_severity(F.col(metric), warning, critical, direction))
        sev_terms.append(F.when(sev.isNotNull(), F.lit(metric)))
        rank_terms.append(F.coalesce(F.when(sev == "critical", 2).when(sev == "warning", 1), F.lit(0)))
    breaches = F.array_sort(F.array_distinct(F.array_compact(F.array(*sev_terms))))
    rank = F.greatest(*rank_terms) if len(rank_terms) > 1 else rank_terms[0]
    status = F.when(rank == 2, "ALERT").when(rank == 1, "WARN").otherwise("OK")
    wide = [F.col(m).alias(c) for m, c in schema.WIDE_COLUMNS]
    return g.select("sensor_id", "window_start", *wide, status.alias("status"), breaches.alias("breaches"))


MEASURES = [c for _, c in schema.WIDE_COLUMNS]


# --------------------------------------------------------------------------- Q1
def latest_per_sensor(agg: DataFrame, ts_col: str = "window_start") -> DataFrame:
    """Q1: newest row per sensor, as a partial aggregation (``max_by``): one
    scan, and each map task ships one row per sensor, whatever the skew.
    (The struct buffer makes it a sort-based aggregation; a max + semi-join
    variant was measured no faster and reads the input twice.)"""
    cols = [c for c in agg.columns if c != "sensor_id"]
    s = F.max_by(F.struct(*cols), F.col(ts_col))
    return agg.groupBy("sensor_id").agg(s.alias("_r")).select("sensor_id", "_r.*")


# --------------------------------------------------------------------------- Q2
GROUP_LIMIT_MAX = 1000  # Spark plans a map-side group limit up to this n


def newest_n(df: DataFrame, n: int, key: str = "sensor_id", order=("window_start",),
             bucket_unit: str = "hour") -> DataFrame:
    """Q2: newest ``n`` rows per key (rank column ``rn``, 1 = newest).

    Small ``n``: ``row_number() <= n``, which Spark runs with a per-task group
    limit before the shuffle (each task ships <= n rows per key).
    Large ``n`` (row budgets up to 10,080): rows are counted per (key, hour);
    from those counts (one row per key and hour) each key's cut-off hour is
    found, newer hours are kept and rows are ranked within (key, hour). All
    heavy work is partitioned by (key, hour), so a hot key is spread over
    its hours instead of one task."""
    desc = [F.col(c).desc() for c in order]
    if n <= GROUP_LIMIT_MAX:
        w = Window.partitionBy(key).orderBy(*desc)
        return df.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)
    b = df.withColumn("_b", time_floor(order[0], bucket_unit))
    counts = b.groupBy(key, "_b").agg(F.count("*").alias("_c"))
    newer = Window.partitionBy(key).orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    keep = (counts.withColumn("_before", F.coalesce(F.sum("_c").over(newer), F.lit(0)))
            .filter(F.col("_before") < n).drop("_c"))
    w = Window.partitionBy(key, "_b").orderBy(*desc)
    return (b.join(keep, [key, "_b"])
            .withColumn("rn", (F.col("_before") + F.row_number().over(w)).cast("int"))
            .filter(F.col("rn") <= n).drop("_b", "_before"))


# Row budgets by sensor type and period (rows, not time).
PERIOD_ROWS = {
    "traffic_loop": {"hour": 60, "day": 1440, "2days": 2880, "week": 10080},
    "air_quality": {"hour": 60, "day": 1440, "week": 10080},
    "noise": {"hour": 60, "day": 1440, "week": 10080},
}
PERIOD_SYNONYMS = {"1hour": "hour", "1day": "day", "1week": "week"}  # R7


def period_budget(period: str, stype: str = "traffic_loop", cap: int | None = None) -> int:
    """Q2 rows of a period for a sensor type. ``cap``: an upper bound such as
    the traffic history's 10,000 rows, if the caller wants one."""
    rows = PERIOD_ROWS[stype].get(PERIOD_SYNONYMS.get(period, period))
    if rows is None:
        raise ValueError(f"unknown period {period!r} for {stype}")
    return min(rows, cap) if cap else rows


# --------------------------------------------------------------------- Q3 / A2
def last_readings(readings: DataFrame, n: int = 20) -> DataFrame:
    """Q3: last ``n`` readings per sensor across all its metrics (by event time,
    ties by event_id)."""
    w = Window.partitionBy("sensor_id").orderBy(F.col("ts").desc(), F.col("event_id").desc())
    return readings.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n)


def last_readings_stats(valid: DataFrame, n: int = 20) -> DataFrame:
    """A2: avg/min/max/count per metric over each sensor's last ``n`` readings,
    with the buffer size and its time range."""
    last = last_readings(valid, n)
    per_metric = last.groupBy("sensor_id", "metric").agg(
        mean("value").alias("avg_value"), F.min("value").alias("min_value"),
        F.max("value").alias("max_value"), F.count("*").alias("count"),
        F.min("ts").alias("_first"), F.max("ts").alias("_last"))
    w = Window.partitionBy("sensor_id")
    return per_metric.select(
        "sensor_id", "metric", "avg_value", "min_value", "max_value", "count",
        F.sum("count").over(w).alias("window_size"),
        F.min("_first").over(w).alias("range_start"),
        F.max("_last").over(w).alias("range_end"))


def running_buffer_stats(valid: DataFrame, n: int = 20, bucket_unit: str = "hour",
                         hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Q3 running form: at every reading, the sensor's last ``n`` readings
    (itself included, all metrics, ordered by event time then event_id):
    buffer size, and per wide metric the mean and count inside the buffer.

    Hot sensors are evaluated per (sensor, hour) with a halo of the ``n - 1``
    preceding readings (see ``halo_partitioned``), so they are spread over
    their hours; equal to ``rowsBetween(-(n-1), 0)`` over the whole history."""
    keys, order = ["sensor_id"], ["ts", "event_id"]
    base = valid.select("event_id", "sensor_id", "ts", "metric", "value")
    parts = halo_partitioned(base, keys, order, time_floor("ts", bucket_unit), n - 1, hot_rows)
    w = Window.partitionBy("sensor_id", "_bucket").orderBy(*order).rowsBetween(-(n - 1), 0)
    cols = [F.count("*").over(w).alias("buffer_size")]
    for m, _ in schema.WIDE_COLUMNS:
        hit = F.col("metric") == m
        held = F.when(hit, F.col("value"))
        cols += [F.avg(held).over(w).alias(f"{m}_avg"), F.count(held).over(w).alias(f"{m}_count")]
    return (parts.select("event_id", "sensor_id", "ts", "metric", "value", "_halo", *cols)
            .filter(~F.col("_halo")).drop("_halo"))


# --------------------------------------------------------------------------- Q4
def halo_partitioned(df: DataFrame, keys: list[str], order: list[str], bucket: Column,
                     halo: int, hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Prepare a running window ``rowsBetween(-halo, 0)`` per key so that no
    task holds a hot key's whole history.

    Keys with more than ``hot_rows`` rows (found by a partial aggregation; at
    most total rows / ``hot_rows`` of them) are split into time buckets
    (``bucket``); every bucket gets the last ``halo`` rows that precede it
    (flag ``_halo``), taken from the tails of its ``halo`` previous non-empty
    buckets. Other keys keep one bucket (null) and get no halo rows. A window
    partitioned by (keys, ``_bucket``) then equals the window over the key's
    whole history for the non-halo rows."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("_n"))
    hot = counts.filter(F.col("_n") > hot_rows).select(*keys, F.lit(True).alias("_hot"))
    # The hot keys grow with the data: the join is left to the measured sizes.
    tagged = (df.join(hot, keys, "left")
              .withColumn("_bucket", F.when(F.col("_hot"), bucket))
              .drop("_hot"))
    split = tagged.filter(F.col("_bucket").isNotNull())
    tail_w = Window.partitionBy(*keys, "_bucket").orderBy(*[F.col(c).desc() for c in order])
    tails = (split.withColumn("_rk", F.row_number().over(tail_w))
             .filter(F.col("_rk") <= halo).drop("_rk"))
    buckets = split.select(*keys, "_bucket").distinct()
    bw = Window.partitionBy(*keys).orderBy("_bucket")
    nexts = buckets.select(*keys, F.col("_bucket").alias("_src"),
                           F.array(*[F.lead("_bucket", k).over(bw) for k in range(1, halo + 1)])
                           .alias("_dst"))
    moved = (tails.withColumnRenamed("_bucket", "_src").join(nexts, keys + ["_src"])
             .select("*", F.explode(F.array_compact("_dst")).alias("_bucket"))
             .drop("_src", "_dst"))
    # at most ``halo`` halo rows per bucket: the newest ones before it
    cap = Window.partitionBy(*keys, "_bucket").orderBy(*[F.col(c).desc() for c in order])
    moved = (moved.withColumn("_rk", F.row_number().over(cap)).filter(F.col("_rk") <= halo)
             .drop("_rk").withColumn("_halo", F.lit(True)))
    return tagged.withColumn("_halo", F.lit(False)).unionByName(moved)


def spikes(valid: DataFrame, bucket_unit: str = "hour", hot_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """Q4: readings whose value exceeds twice the mean of the last three values
    (itself included) of the same sensor and metric, when three exist."""
    keys, order = ["sensor_id", "metric"], ["ts", "event_id"]
    base = valid.select("event_id", "sensor_id", "metric", "ts", "value")
    parts = halo_partitioned(base, keys, order, time_floor("ts", bucket_unit), 2, hot_rows)
    w = Window.partitionBy(*keys, "_bucket").orderBy(*order)
    return (parts
            .withColumn("recent_avg", (F.lag("value", 2).over(w) + F.lag("value", 1).over(w) + F.col("value")) / 3.0)
            .filter(~F.col("_halo") & (F.col("value") > F.col("recent_avg") * 2))
            .select("event_id", "sensor_id", "metric", "ts", "value", "recent_avg"))


def segments(df: DataFrame, keys: list[str], order: list[str], bucket: Column, carry: int, held: list[str],
             also: dict[str, Column] | None = None, keep: Column | None = None) -> DataFrame:
    """Two-phase scan of each key's rows in order, from one read of ``df``: one
    row per (key, time bucket) with ``rows`` (its rows as sorted structs) and
    ``before`` (the ``carry`` rows that precede them, from earlier buckets).

    A bucket's tail is a mergeable value: only tails, never rows, meet in the
    window over a key, so a hot key is spread over its buckets. The rows stay in
    the exchange of the first phase, which the second one reads again. ``also``
    adds aggregates; ``keep`` says which rows are held. Rows without a key or a
    time are left out."""
    row = F.struct(*[F.col(c) for c in [*order, *held]])
    for k in keys:   # both phases then have the same filters, and share one exchange
        df = df.filter(F.col(k).isNotNull())
    g = df.withColumn("_bucket", bucket).filter("_bucket IS NOT NULL").groupBy(*keys, "_bucket").agg(
        F.array_sort(F.collect_list(row if keep is None else F.when(keep, row))).alias("rows"),
        *[c.alias(n) for n, c in (also or {}).items()])
    tails = g.select(*keys, "_bucket", F.slice("rows", F.greatest(F.size("rows") - carry + 1, F.lit(1)), carry).alias("_tail")) \
        .filter(F.size("_tail") > 0)
    # ``carry`` buckets with rows hold at least ``carry`` rows
    w = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(-carry, -1)
    seen = F.flatten(F.collect_list("_tail").over(w))
    before = tails.withColumn("_seen", seen).select(
        *keys, "_bucket", F.slice("_seen", F.greatest(F.size("_seen") - carry + 1, F.lit(1)), carry).alias("before"))
    joined = g.join(before, [*keys, "_bucket"], "left")
    return joined.withColumn("before", F.coalesce("before", F.slice("rows", 1, 0)))


def _spike_structs() -> Column:
    """Of a segment: its spikes as structs with ``recent_avg``."""
    every, p = F.concat("before", "rows"), F.size("before")
    def value(i):
        return F.get(every, i)["value"]
    with_mean = F.transform("rows", lambda r, i: F.struct(
        r.alias("r"), ((value(p + i - 2) + value(p + i - 1) + r["value"]) / 3.0).alias("recent_avg")))
    return F.filter(with_mean, lambda x: F.coalesce(x["r"]["value"] > x["recent_avg"] * 2, F.lit(False)))


def spikes_scanned(valid: DataFrame, bucket_unit: str = "minute") -> DataFrame:
    """Q4 as a two-phase scan: one read of the readings."""
    s = segments(valid, ["sensor_id", "metric"], ["ts", "event_id"], time_floor("ts", bucket_unit), 2, ["value"])
    return s.select("sensor_id", "metric", F.explode(_spike_structs()).alias("s")).select(
        "s.r.event_id", "sensor_id", "metric", "s.r.ts", "s.r.value", "s.recent_avg")


def counters_scanned(validated: DataFrame, bucket_unit: str = "minute") -> DataFrame:
    """A20 as a two-phase scan: valid and invalid readings and spikes from one
    read of the validated readings."""
    s = segments(validated, ["sensor_id", "metric"], ["ts", "event_id"], time_floor("ts", bucket_unit), 2, ["value"],
                 {"n_valid": F.count_if("is_valid"), "n_invalid": F.count_if(~F.col("is_valid"))}, F.col("is_valid"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return s.agg(total("n_valid").alias("messages_processed"), total("n_invalid").alias("validation_errors"),
                 total(F.size(_spike_structs())).alias("anomalies_detected"))


# --------------------------------------------------------------------------- T3
def sliding_windows(valid: DataFrame, size: str = "10 minutes", slide: str = "1 minute") -> DataFrame:
    """T3 batch form: sliding-window avg/min/max/count per sensor and metric."""
    # Partial sums per slide first: the tenfold expansion then only meets those.
    part = valid.groupBy("sensor_id", "metric", F.window("ts", slide).alias("p")).agg(
        F.sum("value").alias("s"), F.min("value").alias("lo"), F.max("value").alias("hi"), F.count("*").alias("n"))
    part = part.select("sensor_id", "metric", slide_number(F.col("p.start"), slide).alias("at"), "s", "lo", "hi", "n")
    start = slide_start(F.col("first"), slide)
    return (dealt_windows(part, size, slide).groupBy("sensor_id", "metric", "block", "first")
            .agg((F.sum("s") / F.sum("n")).alias("avg_value"), F.min("lo").alias("min_value"),
                 F.max("hi").alias("max_value"), F.sum("n").alias("count"))
            .select("sensor_id", "metric", start.alias("window_start"), (start + F.expr(f"INTERVAL {size}")).alias("window_end"),
                    "avg_value", "min_value", "max_value", "count"))


def micros(text: str) -> int:
    return pd.Timedelta(text).value // 1000


def slide_number(start: Column, slide: str) -> Column:
    """Number of the slide that starts then, counted from the epoch."""
    return (F.unix_micros(start.cast("timestamp")) / micros(slide)).cast("bigint")


def slide_start(number: Column, slide: str) -> Column:
    return F.timestamp_micros(number * micros(slide)).cast("timestamp_ntz")


def dealt_windows(part: DataFrame, size: str, slide: str) -> DataFrame:
    """Partials of slide number ``at``, once per sliding window that holds them
    (``first``: the window's first slide). They are dealt by sensor, metric and
    the hour's ``block`` of windows (a few go to two) and expanded only behind
    that exchange, which also serves groups of them by block and window."""
    each, back = max(1, 3_600_000_000 // micros(slide)), -(-micros(size) // micros(slide)) - 1

    def block(number):
        return number - F.pmod(number, F.lit(each))
    blocks = F.sequence(block(F.col("at") - back), block(F.col("at")), F.lit(each).cast("bigint"))
    dealt = part.withColumn("block", F.explode(blocks)).repartition("sensor_id", "metric", "block")
    return (dealt.withColumn("first", F.explode(F.expr(f"sequence(at, at - {back}L, -1L)")))
            .filter((F.col("first") >= F.col("block")) & (F.col("first") < F.col("block") + each)))


# --------------------------------------------------------------------------- T5
def retained(readings: DataFrame, hours: int = 24, limits=None) -> DataFrame:
    """T5 batch form: minute rows within ``hours`` of the newest minute. The
    cut-off comes from the narrow time column, and only readings after it are
    aggregated."""
    newest = minute_floor(readings.agg(F.max("ts")).scalar())  # scalar subquery, no join
    return aggregates_minute(readings.filter(F.col("ts") >= F.timestamp_add("HOUR", F.lit(-hours), newest)), limits)
