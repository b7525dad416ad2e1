import datetime as dt

from pyspark.sql import functions as F

READING_SCHEMA = "event_id long, sensor_id string, ts timestamp_ntz, metric string, value double"


def T(s):
    return dt.datetime.fromisoformat(s)


def readings_df(spark, rows):
    return spark.createDataFrame(rows, READING_SCHEMA)


def rows(df, *cols):
    d = df.select(*cols) if cols else df
    return [tuple(r) for r in d.collect()]


def one(df):
    r = df.collect()
    assert len(r) == 1
    return r[0].asDict()


__all__ = ["T", "readings_df", "rows", "one", "F"]
