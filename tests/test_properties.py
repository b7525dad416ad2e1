"""Property tests: bands against a plain-Python definition, histogram and
split totals, and order-independent means."""

from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from streetpulse import schema
from streetpulse.functions.columns import banded, mean
from streetpulse.operators import dashboards as DB
from streetpulse.operators import quality as QU

values = st.lists(st.one_of(st.none(), st.integers(-2000, 20000).map(lambda i: i / 100.0)), min_size=1, max_size=60)
SETTINGS = dict(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def py_band(x, spec):
    if x is None:
        return None
    for label, upper, inclusive in spec:
        if upper is None or (x <= upper if inclusive else x < upper):
            return label


@settings(**SETTINGS)
@given(values)
def test_bands_match_definition(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for spec in (DB.SPEED_BANDS_CURRENT, DB.TEMP_BANDS, DB.AIR_LEVELS, DB.NOISE_LEVELS, DB.CONGESTION_LEVELS):
        got = [r[0] for r in df.select(banded("x", spec)).collect()]
        assert got == [py_band(x, spec) for x in xs]


@settings(**SETTINGS)
@given(values)
def test_zero_filled_histogram_sums_to_rows(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "avg_speed_kmh double")
    h = DB.zero_filled_histogram(df.filter("avg_speed_kmh IS NOT NULL"),
                                 banded("avg_speed_kmh", DB.SPEED_BANDS_HISTORY), [s[0] for s in DB.SPEED_BANDS_HISTORY])
    rows = h.collect()
    assert len(rows) == 5 and sum(r["count"] for r in rows) == sum(x is not None for x in xs)


@settings(**SETTINGS)
@given(values, st.sampled_from(["vehicle_count", "noise_db", "temp_c", "queue_len"]))
def test_valid_split_halves_sum_to_input(spark, xs, metric):
    df = spark.createDataFrame([(i, "Loop-1", metric, x) for i, x in enumerate(xs) if x is not None],
                               "event_id long, sensor_id string, metric string, value double")
    good, bad = QU.split_valid(QU.validate(df, schema.valid_ranges(spark)))
    assert good.count() + bad.count() == df.count()


@settings(**SETTINGS)
@given(st.lists(st.integers(-10 ** 6, 10 ** 6).map(lambda i: i / 1000.0), min_size=1, max_size=80),
       st.integers(1, 7))
def test_mean_keeps_all_digits(spark, xs, parts):
    df = spark.createDataFrame([(x / 7,) for x in xs], "v double").repartition(parts)
    got = df.agg(mean("v")).collect()[0][0]
    exact = sum(Fraction(x / 7) for x in xs) / len(xs)
    assert abs(got - float(exact)) <= 1e-12 * max(1.0, max(abs(x) for x in xs))
