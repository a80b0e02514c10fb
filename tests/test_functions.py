import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txscore import functions as fn
from txscore.constants import EXPLORATION_BUCKETS


def one(df, column):
    return df.select(column.alias("x")).first()["x"]


@pytest.fixture(scope="module")
def unit(spark):
    return spark.range(1)


def distance(unit, *degrees):
    return one(unit, fn.haversine(*[F.lit(d).cast("double") for d in degrees]))


def test_haversine_known_distance(unit):
    # One degree along the equator.
    assert distance(unit, 0, 0, 0, 1) == pytest.approx(2 * math.pi * 6371 / 360)


def test_haversine_antipodes_are_not_nan(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame({"lat": rng.uniform(-90, 90, 5000), "lon": rng.uniform(-180, 180, 5000)})
    df = spark.createDataFrame(pdf).withColumns({"lat2": -F.col("lat"), "lon2": F.col("lon") + 180})
    d = df.select(fn.haversine(*[F.col(c) for c in ("lat", "lon", "lat2", "lon2")]).alias("d"))
    low, bad = d.agg(F.min("d"), F.count_if(F.isnan("d"))).first()
    assert bad == 0
    assert low == pytest.approx(math.pi * 6371)


def test_haversine_missing_stays_missing(unit):
    assert distance(unit, None, 0, 0, 1) is None
    assert math.isnan(distance(unit, float("nan"), 0, 0, 1))


@settings(max_examples=15, deadline=None)
@given(st.tuples(*[st.floats(-90, 90), st.floats(-180, 180)] * 2))
def test_haversine_is_symmetric_and_not_negative(spark, point):
    unit = spark.range(1)
    a, b, c, d = point
    there, back = distance(unit, a, b, c, d), distance(unit, c, d, a, b)
    assert there >= 0
    assert there == pytest.approx(back, abs=1e-6)


def test_bad_timestamp_is_null(unit):
    assert one(unit, fn.parse_ts(F.lit("not a date"))) is None
    assert one(unit, fn.parse_ts(F.lit("1980-06-15"))) == dt.datetime(1980, 6, 15)


def test_three_weekday_conventions(unit):
    sunday = fn.parse_ts(F.lit("2024-01-07 13:45:10"))
    assert one(unit, fn.dow_sunday1(sunday)) == 1
    assert one(unit, fn.dow_monday0(sunday)) == 6
    assert one(unit, fn.dow_sunday0(sunday)) == 0
    assert one(unit, fn.day_name(fn.dow_sunday0(sunday))) == "Sunday"
    assert one(unit, fn.day_name(F.lit(None).cast("int"))) is None
    assert one(unit, fn.hour_of_day(sunday)) == 13
    assert one(unit, fn.hour_start(sunday)) == dt.datetime(2024, 1, 7, 13)


@pytest.mark.parametrize("ts, birth", [
    ("2024-01-07 13:45:10", "1980-06-15"), ("2024-06-15 00:00:00", "1980-06-15"),
    ("2024-06-14 23:59:59", "1980-06-15"), ("1980-01-01 00:00:00", "1980-06-15"),
])
def test_two_ages(unit, ts, birth):
    got = one(unit, fn.age_fractional(fn.parse_ts(F.lit(ts)), fn.parse_ts(F.lit(birth))))
    want = max((pd.Timestamp(ts) - pd.Timestamp(birth)).days / 365.25, 0)
    assert got == pytest.approx(want)
    years = one(unit, fn.age_by_year(fn.parse_ts(F.lit(ts)), fn.parse_ts(F.lit(birth))))
    assert years == float(int(ts[:4]) - int(birth[:4]))


def test_age_of_missing_birth_is_null(unit):
    ts, none = fn.parse_ts(F.lit("2024-01-07")), F.lit(None).cast("timestamp")
    assert one(unit, fn.age_fractional(ts, none)) is None


def test_ratio(unit):
    lit = lambda v: F.lit(v).cast("double")
    assert one(unit, fn.ratio_to_average(lit(10), lit(5), lit(70))) == 2
    assert one(unit, fn.ratio_to_average(lit(70), lit(None), lit(70))) == 1
    assert one(unit, fn.ratio_to_average(lit(70), lit(0), lit(70))) is None


@pytest.mark.parametrize("prediction, flag", [(None, 0), (0.0, 0), (0.99, 0), (1.0, 1), (2.0, 1)])
def test_flag(unit, prediction, flag):
    assert one(unit, fn.fraud_flag(F.lit(prediction).cast("double"))) == flag


def test_percent_rounds_like_numpy(spark):
    values = np.linspace(0, 1, 4001)
    df = spark.createDataFrame(pd.DataFrame({"i": range(len(values)), "p": values}))
    got = [r["x"] for r in df.orderBy("i").select(fn.amount_percent(F.col("p")).alias("x")).collect()]
    assert got == list(pd.Series(values * 100).round(2))


def test_missing_probability_is_zero_percent(unit):
    assert one(unit, fn.amount_percent(F.lit(None).cast("double"))) == 0.0


AMOUNTS = [-1.0, 0.0, 0.01, 9.99, 10.0, 50.0, 99.99, 100.0, 200.0, 499.0, 500.0, 999.0, 1000.0, 5000.0, None]


def test_right_closed_buckets_like_pandas(spark):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(AMOUNTS)], "i INT, amt DOUBLE")
    got = [r["x"] for r in df.orderBy("i").select(fn.amount_bucket(F.col("amt")).alias("x")).collect()]
    bins = [low for low, _, _ in EXPLORATION_BUCKETS] + [np.inf]
    want = pd.cut(pd.Series(AMOUNTS, dtype=float), bins, labels=[n for _, _, n in EXPLORATION_BUCKETS])
    assert got == [None if pd.isna(w) else w for w in want]


def test_left_closed_ranges(spark):
    df = spark.createDataFrame([(a,) for a in (99.99, 100.0, 500.0, 1000.0, None)], "amt DOUBLE")
    got = [r["x"] for r in df.select(fn.amount_range_label(F.col("amt")).alias("x")).collect()]
    assert got == ["Less than $100", "$100-$500", "$500-$1000", "Over $1000", "Over $1000"]


def test_probability_vector(unit):
    vector = fn.probability_vector(F.lit(0.25))
    assert list(one(unit, vector)) == [0.75, 0.25]
    assert one(unit, fn.class_probability(vector, 1)) == 0.25


def test_threshold(unit):
    assert one(unit, fn.threshold_label(F.lit(0.5))) == 1.0
    assert one(unit, fn.threshold_label(F.lit(0.4999))) == 0.0
