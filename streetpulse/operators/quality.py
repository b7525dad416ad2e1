"""Data quality: completeness gate (S2), timestamp parse (S3), range validation
(P1), valid/invalid split (P2) and processing counters (A20)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema
from ..functions.columns import number_text

# The keys a reading must have.
REQUIRED_KEYS = ("sensor_id", "ts", "metric", "value")
LARGEST_VALUE = 1e12  # no measure of any metric is larger; beyond it, or not finite, a reading is quarantined


def finite(value: Column) -> Column:
    """True for a usable number, false for null, NaN, infinite or absurd ones."""
    return F.coalesce(~F.isnan(value) & (F.abs(value) <= LARGEST_VALUE), F.lit(False))


def completeness(df: DataFrame, strict_text: bool = False) -> Column:
    """S2 predicate. Pipeline form: the four keys are present. Alert form
    (``strict_text``): sensor_id and metric non-empty and value non-null."""
    if strict_text:
        return (F.coalesce(F.col("sensor_id") != "", F.lit(False))
                & F.coalesce(F.col("metric") != "", F.lit(False))
                & finite(F.col("value")))
    cond = finite(F.col("value"))
    for k in REQUIRED_KEYS[:-1]:
        cond = cond & F.col(k).isNotNull()
    return cond


def split_complete(df: DataFrame, strict_text: bool = False) -> tuple[DataFrame, DataFrame]:
    """(complete rows, quarantined rows)."""
    ok = completeness(df, strict_text)
    return df.filter(ok), df.filter(~F.coalesce(ok, F.lit(False)))


def parse_iso_ts(col) -> Column:
    """S3: ISO-8601 text (trailing 'Z' or '+00:00') -> UTC timestamp_ntz; bad text -> null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c).cast("timestamp_ntz")


def validate(df: DataFrame, ranges: DataFrame) -> DataFrame:
    """Add ``is_valid`` and ``validation_msg``.

    ``ranges`` is the valid-range table (D8: one row per metric, a fixed
    handful of rows), so it is broadcast; the readings are never shuffled.
    Unknown metrics are valid ("Unknown metric").
    """
    r = F.broadcast(ranges.select(F.col("metric").alias("_rm"), "min_value", "max_value"))
    j = df.join(r, df["metric"] == r["_rm"], "left")
    known = F.col("_rm").isNotNull()
    inside = (F.col("value") >= F.col("min_value")) & (F.col("value") <= F.col("max_value"))
    msg = F.concat(F.lit("Out of range: "), F.col("value").cast("string"), F.lit(" not in ["),
                   number_text("min_value"), F.lit(", "), number_text("max_value"), F.lit("]"))
    return (j.withColumn("is_valid", ~known | F.coalesce(inside, F.lit(False)))
             .withColumn("validation_msg",
                         F.when(~known, "Unknown metric").when(inside, "Valid").otherwise(msg))
             .drop("_rm", "min_value", "max_value"))


def split_valid(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid rows, invalid rows) of a P1 output."""
    return validated.filter("is_valid"), validated.filter("NOT is_valid")


def processing_counters(validated: DataFrame, spikes: DataFrame | None = None) -> DataFrame:
    """A20 batch form: messages processed (valid), validation errors, anomalies
    (spikes, Q4). One pass over each input, no collect."""
    flags = validated.select(F.col("is_valid").alias("_valid"), F.lit(False).alias("_spike"))
    if spikes is not None:
        flags = flags.unionByName(spikes.select(F.lit(None).cast("boolean").alias("_valid"),
                                                F.lit(True).alias("_spike")))
    return flags.agg(F.count_if(F.col("_valid")).alias("messages_processed"),
                     F.count_if(~F.col("_valid")).alias("validation_errors"),
                     F.count_if(F.col("_spike")).alias("anomalies_detected"))


def valid_readings(readings: DataFrame, ranges: DataFrame) -> DataFrame:
    complete, _ = split_complete(readings)
    valid, _ = split_valid(validate(complete, ranges))
    return valid


__all__ = ["completeness", "split_complete", "parse_iso_ts", "validate", "split_valid",
           "processing_counters", "valid_readings", "schema"]
