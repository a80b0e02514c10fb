import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from txscore.operators import exploration, percentiles, profiling
from txscore.schema import SCORED


def frame(spark, values):
    return spark.createDataFrame([(v,) for v in values], "x DOUBLE")


@settings(max_examples=20, deadline=None)
@given(st.lists(st.floats(-1e6, 1e6), min_size=1, max_size=60),
       st.sampled_from([0.0, 0.25, 0.5, 0.99, 1.0]))
def test_percentile_like_numpy(spark, values, p):
    got = percentiles.percentile(frame(spark, values), "x", p).first()[0]
    assert got == pytest.approx(np.quantile(values, p), rel=1e-9, abs=1e-9)


@pytest.fixture
def coarse(monkeypatch):
    """Sketches that are off by much, brackets that miss, and hardly any values counted one by one."""
    monkeypatch.setattr(percentiles, "SKETCH_K", 8)
    monkeypatch.setattr(percentiles, "FEW", 300)
    monkeypatch.setattr(percentiles, "SALTS", (3, 2))
    return lambda margin: monkeypatch.setattr(percentiles, "MARGIN", margin)


PROBABILITIES = [0.0, 0.01, 0.3, 0.5, 0.62, 0.75, 0.99, 0.9999, 1.0]


@pytest.mark.parametrize("margin", [0.0, 0.05])
def test_percentile_with_a_coarse_sketch_and_a_hot_value(spark, coarse, margin):
    # A third of the rows share one value; without a margin most brackets miss: still exact.
    coarse(margin)
    rng = np.random.default_rng(3)
    values = np.concatenate([np.full(5000, 40.0), rng.exponential(30, 10000)])
    df = spark.createDataFrame(pd.DataFrame({"x": values, "y": rng.integers(0, 2, len(values)) * 1.0,
                                             "z": np.arange(len(values)) * 1e300 / len(values)})).repartition(8)
    got = percentiles.percentiles(df, {"x": F.col("x"), "y": F.col("y"), "z": F.col("z")}, PROBABILITIES).toPandas()
    assert len(got) == 3 * len(PROBABILITIES)
    pdf = df.toPandas()
    for row in got.itertuples():
        assert row.percentile == pytest.approx(np.quantile(pdf[row.name], row.probability), rel=1e-12)


def test_a_missed_bracket_goes_on_beside_it():
    w = percentiles._Wanted("x", 50, inside=100)
    w.bracket = (10.0, 20.0)
    assert not w.narrow(60, 1, 9, 1) and (w.low, w.high, w.before, w.inside) == (None, 10.0, 0, 60)
    w.bracket = (1.0, 5.0)
    assert not w.narrow(20, 5, 20, 3) and (w.low, w.high, w.before, w.inside) == (5.0, 10.0, 48, 12)
    w.bracket = (6.0, 6.0)
    assert not w.narrow(49, 4, 0, 4) and w.value == 6.0


def test_no_step_takes_a_sketch_from_every_task(spark):
    df = spark.range(0, 1000, numPartitions=40).select(
        (F.col("id") % 2).cast("string").alias("name"), F.col("id").cast("double").alias("value"))
    tree = percentiles.in_a_tree(df, [percentiles._sketch(F.col("value")).alias("s"), F.count("*").alias("n")],
                                 [F.kll_merge_agg_double("s").alias("s"), F.sum("n").alias("n")])
    text = tree._jdf.queryExecution().executedPlan().toString()
    # By task and name, by salt and name, and only then by name.
    assert [x.split(", 4)")[0].count(",") for x in text.split("Exchange hashpartitioning(")[1:]] == [0, 1, 1]
    rows = tree.select("n", F.kll_sketch_get_n_double("s").alias("m")).collect()
    assert [(r["n"], r["m"]) for r in rows] == [(500, 500)] * 2


def test_percentile_of_nothing_has_no_row(spark):
    assert percentiles.percentile(frame(spark, [None, float("nan")]), "x", 0.5).count() == 0


def test_trim(spark):
    kept = percentiles.percentile_trim(frame(spark, [float(v) for v in range(101)]), "x", 0.99)
    assert kept.agg(F.max("x")).first()[0] == 99


def test_profile_like_pandas(spark):
    pdf = pd.DataFrame({
        "a": [1.0, np.nan, np.nan, 2.0, 0.0, -0.0], "b": ["x", None, "x", "y", "", ""],
        "c": [1, 1, 1, 1, 1, 1]})
    df = spark.createDataFrame(pdf)
    got = {r["column"]: (r["missing_count"], r["missing_pct"], r["nunique"])
           for r in profiling.profile(df).collect()}
    want = {c: (int(pdf[c].isna().sum()), round(pdf[c].isna().mean() * 100, 2),
                pdf[c].nunique(dropna=False)) for c in pdf}
    assert got == want
    assert [r["column"] for r in profiling.top_profile(df, 2).collect()] == ["a", "b"]


def test_repeats_and_checks(spark):
    df = spark.createDataFrame(
        [("k", 1.0), ("k", 1.0), ("k", 2.0), (None, 1.0), (None, 1.0)], "trans_num STRING, amt DOUBLE")
    assert profiling.duplicate_rows(df).first()[0] == 2
    assert profiling.duplicate_keys(df).first()[0] == 3
    dated = df.withColumns({
        "trans_date_trans_time": F.lit(None).cast("timestamp"), "dob": F.current_timestamp()})
    checks = {r["check"]: r["count"] for r in profiling.quality_checks(dated).collect()}
    assert checks == {"missing_trans_time": 5, "missing_dob": 0, "negative_amounts": 0,
                      "duplicate_trans_num": 3}
    unkeyed = {r["check"]: r["count"] for r in profiling.quality_checks(dated.drop("trans_num")).collect()}
    assert unkeyed["duplicate_trans_num"] is None
    assert profiling.duplicate_rows(df.limit(0)).first()[0] == 0


def test_schema_difference_and_drift(spark):
    left = spark.createDataFrame([(1, "a", 1)], "x INT, y STRING, z INT")
    right = spark.createDataFrame([(1, "a"), (2, None)], "x INT, w STRING")
    diff = {(r["column"], r["side"]) for r in profiling.schema_difference(spark, left, right).collect()}
    assert diff == {("y", "left"), ("z", "left"), ("w", "right")}
    assert [tuple(r) for r in profiling.drift(left, right).collect()] == [("x", 1, 2)]
    assert profiling.one_sided_profile(spark, left, left).count() == 0


def test_table_contract(spark, make_scored):
    assert all(r["matches"] for r in profiling.table_contract(spark, make_scored({}), SCORED).collect())
    changed = make_scored({}).withColumn("amt", F.lit("1")).drop("prob_0").withColumn("new", F.lit(1))
    wrong = {r["column"] for r in profiling.table_contract(spark, changed, SCORED).collect() if not r["matches"]}
    assert wrong == {"amt", "prob_0", "new"}


def test_observed_rows_need_no_extra_pass(spark):
    counted, seen = profiling.observe_rows(spark.range(10), "stage")
    counted.filter("id > 7").collect()
    assert seen.get["rows"] == 10


def labelled(spark):
    rng = np.random.default_rng(7)
    return pd.DataFrame({"x": rng.gamma(2.0, 50.0, 400), "is_fraud": rng.integers(0, 2, 400)})


def test_histogram_like_numpy(spark):
    pdf = labelled(spark)
    kept = pdf[pdf.x <= pdf.x.quantile(0.99)]
    edges = np.histogram_bin_edges(kept.x, 30)
    rows = exploration.histogram_by_class(spark.createDataFrame(pdf), "x").collect()
    for label in (0, 1):
        counts, _ = np.histogram(kept.x[kept.is_fraud == label], edges)
        got = {r["bin"]: r["count"] for r in rows if r["is_fraud"] == label}
        assert [got.get(i, 0) for i in range(30)] == list(counts)
        assert sum(r["percent"] for r in rows if r["is_fraud"] == label) == pytest.approx(100)


def test_histogram_of_a_constant(spark):
    rows = exploration.histogram_by_class(
        spark.createDataFrame([(5.0, 0), (5.0, 0)], "x DOUBLE, is_fraud INT"), "x").collect()
    assert [(r["bin"], r["count"], r["percent"]) for r in rows] == [(15, 2, 100.0)]  # as numpy


def test_density_like_numpy(spark):
    pdf = labelled(spark)
    rows = exploration.density_by_class(spark.createDataFrame(pdf), "x", points=20).collect()
    for row in rows:
        x = pdf.x[pdf.is_fraud == row["is_fraud"]]
        h = x.std() * len(x) ** -0.2
        want = np.exp(-0.5 * ((row["x"] - x) / h) ** 2).sum() / (len(x) * h * np.sqrt(2 * np.pi))
        assert row["density"] == pytest.approx(want)
    assert len(rows) == 40 and max(r["x"] for r in rows) == pytest.approx(pdf.x.quantile(0.99))


def test_density_evaluates_only_points_in_reach(spark):
    # Two tight heaps far apart, a class far beyond the grid, and one value out on its own.
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(10, 0.5, 3000), rng.normal(12, 0.5, 3000), [400.0]])
    pdf = pd.DataFrame({"x": x, "is_fraud": np.zeros(len(x), int)})
    pdf = pd.concat([pdf, pd.DataFrame({"x": [1e6, 1e6 + 1], "is_fraud": [1, 1]})])
    df = spark.createDataFrame(pdf)
    spread, _, _ = exploration.kernel_rows(df, "x", upto=0.9997)
    assert spread.count() < 0.8 * 200 * df.distinct().count()
    rows = exploration.density_by_class(df, "x", upto=0.9997).collect()
    assert len(rows) == 400
    for r in rows:
        own = pdf[pdf.is_fraud == r["is_fraud"]].x.to_numpy()
        h = own.std(ddof=1) * len(own) ** -0.2
        want = np.exp(-0.5 * ((r["x"] - own) / h) ** 2).sum() / (len(own) * h * np.sqrt(2 * np.pi))
        assert r["density"] == pytest.approx(want, rel=1e-9, abs=1e-300)


def test_moments_keep_their_digits(spark, monkeypatch):
    monkeypatch.setattr(percentiles, "SALTS", (5, 2))
    values = 1e9 + np.random.default_rng(1).normal(0, 1.0, 2000)
    df = frame(spark, [float(v) for v in values]).repartition(16)
    row = exploration.moments(percentiles.long_values(df, {"x": F.col("x")})).first()
    assert row["std"] == pytest.approx(values.std(ddof=1), rel=1e-6)
    assert (row["count"], row["min"], row["max"]) == (2000, values.min(), values.max())
    one = exploration.moments(percentiles.long_values(frame(spark, [3.0]), {"x": F.col("x")})).first()
    assert (one["mean"], one["std"]) == (3.0, None)


def test_density_without_spread_is_null(spark):
    df = spark.createDataFrame([(1.0, 0), (1.0, 0), (2.0, 1)], "x DOUBLE, is_fraud INT")
    assert {r["density"] for r in exploration.density_by_class(df, "x", points=3).collect()} == {None}


def test_bucket_summary_keeps_empty_buckets(spark):
    df = spark.createDataFrame(
        [(5.0, 0, 1.0), (5.0, 1, 3.0), (0.0, 1, 9.0), (5000.0, 1, 2.0)],
        "amt DOUBLE, is_fraud INT, distance_km DOUBLE")
    rows = exploration.bucket_summary(spark, df).collect()
    assert [r["total_transactions"] for r in rows] == [2, 0, 0, 0, 0, 0, 1]
    assert (rows[0]["fraud_rate"], rows[0]["median_distance_km"]) == (0.5, 2.0)
    assert rows[1]["fraud_rate"] is None


def test_describe_like_pandas(spark):
    pdf = pd.DataFrame({"x": [1.0, 2.0, np.nan, 10.0], "y": [3.0, 3.0, 3.0, 4.0]})
    got = exploration.describe(spark.createDataFrame(pdf), ["x", "y"]).toPandas().set_index("column")
    want = pdf.describe().T
    assert np.allclose(got.loc[["x", "y"]].to_numpy(float),
                       want[["count", "mean", "std", "min", "25%", "50%", "75%", "max"]].to_numpy())


def test_value_share_leaves_missing_out(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (None,), (0,)], "is_fraud INT")
    assert [tuple(r) for r in exploration.value_share(df).collect()] == [(0, 3, 75.0), (1, 1, 25.0)]
