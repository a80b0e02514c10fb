import pytest
from pyspark.sql import functions as F

from txscore import fixtures
from txscore.constants import ORDINAL
from txscore.operators import cleaning, features


def keys(df):
    return sorted(r["trans_num"] for r in df.select("trans_num").collect())


def test_null_and_nan_are_dropped(make):
    df = make({}, {"trans_num": "T2", "amt": None}, {"trans_num": "T3", "amt": float("nan")},
              {"trans_num": "T4", "job": None})
    assert keys(cleaning.drop_missing(df)) == ["T1"]
    assert keys(cleaning.drop_missing(df, ["trans_num", "amt"])) == ["T1", "T4"]


def test_three_orders_differ(spark, make):
    # The first copy has no amount, the second is good.
    df = make({"amt": None, "unix_time": 1}, {"amt": 5.0, "unix_time": 2},
              {"trans_num": "T2", "amt": -1.0}, {"trans_num": "T3", "amt": 3.0})
    assert keys(cleaning.clean_stream(df)) == ["T1", "T3"]
    assert keys(cleaning.clean_train(df, order=["unix_time"])) == ["T3"]
    assert keys(cleaning.clean_explore(df, order=["unix_time"])) == ["T1", "T3"]


def test_orders_on_the_dirty_table(spark, sf_dir):
    dirty = fixtures.tx_dirty(spark, "/root/testdata/sf0.01")
    known = cleaning.dedup(cleaning.drop_missing(dirty))
    first = cleaning.drop_missing(cleaning.dedup_first(dirty, ["trans_num"], ["copy_no"]))
    assert (known.count(), first.count()) == (9470, 9411)


def test_clean_train_drops_ordinal_and_derives_features(make):
    df = make({}).withColumn(ORDINAL, F.lit(7))
    row = cleaning.clean_train(df).first().asDict()
    assert ORDINAL not in row
    assert (row["hour"], row["day_of_week"], row["month"], row["age"]) == (13, 1, 1, 44.0)
    assert row["distance"] == pytest.approx(156, abs=1)


def test_keep_first_follows_the_ordinal(make):
    df = make({"amt": 2.0}, {"amt": 1.0}, {"amt": 3.0}).withColumn(
        ORDINAL, F.when(F.col("amt") == 3.0, 0).otherwise(F.col("amt").cast("int")))
    cleaned = cleaning.clean_explore(df)
    assert ORDINAL not in cleaned.columns
    assert [r["amt"] for r in cleaned.collect()] == [3.0]


def test_without_key_whole_rows_are_deduplicated(make):
    df = make({}, {}, {"amt": 1.0}).drop("trans_num")
    assert cleaning.clean_explore(df).count() == 2


def test_absent_columns_are_skipped(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "x INT, y STRING")
    assert cleaning.clean_explore(df).count() == 2


def test_coercion(spark):
    df = spark.createDataFrame(
        [("2024-01-07 10:00:00", "12.5"), ("soon", "many"), (None, None)],
        "trans_date_trans_time STRING, amt STRING")
    rows = cleaning.coerce_numbers(cleaning.coerce_timestamps(df)).collect()
    assert [r["amt"] for r in rows] == [12.5, None, None]
    assert [r["trans_date_trans_time"] is None for r in rows] == [False, True, True]


def test_range_filters_differ_on_missing(make):
    df = make({}, {"trans_num": "T2", "amt": None}, {"trans_num": "T3", "city_pop": -1})
    assert keys(cleaning.non_negative(df)) == ["T1"]
    assert keys(cleaning.non_negative_or_missing(df)) == ["T1", "T2"]


def test_bad_date_gives_an_unscorable_row(make):
    df = make({}, {"trans_num": "T2", "dob": "unknown"})
    rows = features.prepare_features(df, features.fit_reference(df))
    assert rows.filter(cleaning.missing_features(rows)).count() == 1
    assert keys(cleaning.drop_unscorable(rows)) == ["T1"]


def test_reference_from_one_pass(make):
    df = make({"amt": 10.0}, {"amt": 20.0}, {"category": "gas", "amt": 60.0},
              {"category": None, "amt": 10.0})
    reference = features.fit_reference(df)
    assert reference.fallback == 25.0
    assert {r["category"]: r["avg_amt"] for r in reference.averages.collect()} == {
        "grocery": 15.0, "gas": 60.0, None: 10.0}
    new = make({"trans_num": "N1", "amt": 30.0}, {"trans_num": "N2", "category": "new", "amt": 50.0},
               {"trans_num": "N3", "category": None, "amt": 25.0})
    ratios = {r["trans_num"]: r["amt_vs_category_avg"]
              for r in features.with_relative_amount(new, reference).collect()}
    assert ratios == {"N1": 2.0, "N2": 2.0, "N3": 1.0}
    mapped = {r["trans_num"]: r["category_avg_amt"]
              for r in features.with_mapped_average(new, reference).collect()}
    assert mapped == {"N1": 15.0, "N2": None, "N3": None}


def test_fallback_when_there_is_nothing_to_average(make):
    assert features.fit_reference(make({"amt": 0.0})).fallback == 70.0
    assert features.fit_reference(make({}).limit(0)).fallback == 70.0


def test_large_reference_is_not_broadcast(make, monkeypatch):
    df = make({"amt": 10.0}, {"trans_num": "T2", "category": "gas", "amt": 60.0})
    small = features.fit_reference(df)
    assert small.small
    monkeypatch.setattr(features, "BROADCAST_ROWS", 1)
    assert not small.small
    joined = features.join_reference(df, small)
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()
    assert {r["trans_num"]: r["avg_amt"] for r in joined.collect()} == {"T1": 10.0, "T2": 60.0}


def test_label_split(make):
    df = make({}, {"trans_num": "T2", "is_fraud": 1}, {"trans_num": "T3", "is_fraud": None})
    positives, negatives = cleaning.label_split(df)
    assert (keys(positives), keys(negatives)) == (["T2"], ["T1"])


def first_child_of_union(df):
    """The lines of a plan below the first child of its union."""
    lines = df._jdf.queryExecution().executedPlan().toString().split("\n")
    at = next(k for k, line in enumerate(lines) if line.strip().split("- ")[-1].startswith("Union"))
    column = lines[at + 1].index(":-")
    own = [lines[at + 1]]
    for line in lines[at + 2:]:
        if line[column] != ":":
            break
        own.append(line)
    return "\n".join(own)


@pytest.mark.parametrize("broadcast", [True, False])
def test_rows_of_single_keys_are_not_sorted(spark, sf_dir, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(cleaning, "BROADCAST_ROWS", 0)
    dirty = fixtures.tx_dirty(spark, sf_dir)
    for df in (cleaning.clean_stream(dirty, order=["copy_no"]), cleaning.dedup(dirty)):
        text = first_child_of_union(df)
        assert "LeftAnti" in text and "Sort " not in text and "SortAggregate" not in text
        assert ("Exchange hashpartitioning" not in text) == broadcast
        assert df.count() == df.select("trans_num").distinct().count()


@pytest.mark.parametrize("broadcast", [True, False])
def test_survivors_among_repeats_nulls_and_hot_keys(spark, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr(cleaning, "BROADCAST_BYTES", 0)
    rows = [(None, 1, 5), (None, 1, 4), (1, None, 3), (1, None, 2), (1, 1, 1), (2, 2, 9), (2, 2, 8)]
    rows += [(7, 7, k) for k in range(100, 200)] + [(8, k, 0) for k in range(50)]
    df = spark.createDataFrame(rows, "a int, b int, n int").repartition(3)
    least = {}
    for a, b, n in rows:
        least[a, b] = min(n, least.get((a, b), n))
    got = cleaning.dedup_first(df, ["a", "b"], ["n"]).collect()
    assert sorted(map(str, got)) == sorted(str(type(got[0])(a=a, b=b, n=n)) for (a, b), n in least.items())
    anyone = cleaning.dedup(df, ["a", "b"]).collect()
    assert {(r.a, r.b) for r in anyone} == set(least) and len(anyone) == len(least)
    assert {tuple(r) for r in anyone} <= set(rows)


def test_a_table_without_repeats_passes_as_it_is(spark):
    df = spark.range(5).selectExpr("id", "id * 2 as x")
    assert cleaning.dedup(df, ["id"]) is df
    assert cleaning.dedup(df.limit(0), ["id"]).collect() == []
    assert cleaning.dedup(df.select("id").union(df.select("id")), ["id"]).count() == 5
