import datetime as dt

import pytest
from pyspark.sql import functions as F

from txscore.operators import cleaning, serving
from txscore.sources import readers, writers


def names(df):
    return [r["trans_num"] for r in df.collect()]


def test_status(make_scored):
    df = make_scored({"prediction": 1.0, "prob_1": 0.12345}, {"prediction": None, "prob_1": None})
    rows = serving.with_status(df).collect()
    assert [(r["fraud_signal"], r["fraud_probability"], r["status"]) for r in rows] == [
        (1, 12.34, "ALERT"), (0, 0.0, "CLEAR")]


def test_latest_sorts_the_text_and_filters_first(make_scored):
    df = make_scored(
        {"trans_num": "A", "trans_date_trans_time": "2024-01-01 00:00:00", "prediction": 1.0},
        {"trans_num": "B", "trans_date_trans_time": "2024-01-03 00:00:00"},
        {"trans_num": "C", "trans_date_trans_time": "2024-01-02 00:00:00", "prediction": 1.0})
    assert names(serving.latest(df, 2)) == ["B", "C"]
    assert names(serving.latest(df, 1, fraud_only=True)) == ["C"]
    assert serving.lookup_one(serving.latest(df), "C").count() == 1


@pytest.fixture
def stored(spark, make_scored, tmp_path):
    """Forty rows on twenty days, every fifth one predicted positive, and two without a day."""
    rows = [{"trans_num": f"A{k:02}", "trans_date_trans_time": f"2024-01-{1 + k // 2:02} {k % 24:02}:00:00",
             "prediction": float(k % 5 == 0)} for k in range(40)]
    rows += [{"trans_num": "B0", "trans_date_trans_time": "no date"},
             {"trans_num": "B1", "trans_date_trans_time": "", "prediction": 1.0}]
    writers.write_scored(make_scored(*rows), str(tmp_path / "scored"))
    return readers.read_scored(spark, str(tmp_path / "scored"))


@pytest.mark.parametrize("fraud_only", [False, True])
@pytest.mark.parametrize("limit", [1, 2, 3, 9, 40, 1000])
def test_latest_of_a_stored_table_is_that_of_all_rows(stored, limit, fraud_only):
    got = serving.latest_stored(stored, limit, fraud_only).collect()
    assert got == serving.latest(stored, limit, fraud_only).collect()


def test_latest_of_a_stored_table_reads_the_newest_days(stored):
    def days(rows):
        return {r[0] for r in rows.select("trans_day").distinct().collect()} - {None}

    def folders(rows):
        return {r[0].split("trans_day=")[1].split("/")[0] for r in rows.select(F.input_file_name()).distinct().collect()}

    one = serving.newest_days(stored, 2)
    assert folders(one) == {"2024-01-20", "__HIVE_DEFAULT_PARTITION__"}
    text = one._jdf.queryExecution().executedPlan().toString()
    assert "trans_day" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert len(days(serving.newest_days(stored, 3))) == 3  # one day, then two
    assert len(days(serving.newest_days(stored, 1, fraud_only=True))) <= 3
    known = stored.filter("trans_day is not null")
    assert folders(serving.newest_days(known, 1)) == {"2024-01-20"}


def test_days_come_from_folder_names(spark, stored):
    days = serving.stored_days(stored)
    assert days[0] == dt.date(2024, 1, 20) and days[19] == dt.date(2024, 1, 1) and days[20:] == [None]
    assert spark.conf.get("spark.sql.optimizer.metadataOnly") == "false"
    assert serving.latest_stored(stored.limit(0)).collect() == []


def test_search_wildcards_and_bounds(make_scored):
    df = make_scored(
        {"trans_num": "A", "merchant": "Fraud_Store", "amt": 10.0, "cc_num": 5},
        {"trans_num": "B", "merchant": "fraudXstore", "amt": 20.0},
        {"trans_num": "C", "merchant": "other", "amt": 2_000_000.0})
    # An underscore in the text stands for any character.
    assert sorted(names(serving.search(df, merchant="D_S"))) == ["A", "B"]
    assert names(serving.search(df, merchant="100%")) == []
    assert names(serving.search(df, cc_num="5")) == ["A"]
    assert names(serving.search(df, amount_min=20.0, amount_max=20.0)) == ["B"]
    # The default upper bound does not apply as a filter.
    assert len(names(serving.search(df))) == 3
    assert len(names(serving.search(df, amount_max=999_999.0))) == 2
    assert names(serving.search(df, fraud_only=True)) == []


def test_trailing_window_includes_its_lower_bound_and_has_no_upper(make_scored):
    df = make_scored(
        {"trans_num": "A", "trans_date_trans_time": "2024-01-01 12:00:00"},
        {"trans_num": "B", "trans_date_trans_time": "2024-01-01 11:59:59"},
        {"trans_num": "C", "trans_date_trans_time": "2030-01-01 00:00:00"})
    as_of = F.lit("2024-01-02 12:00:00").cast("timestamp")
    assert sorted(names(serving.trailing_window(df, 24, as_of))) == ["A", "C"]
    assert names(serving.report(df, as_of=as_of)) == ["C", "A"]
    stored = serving.with_event_time(df)
    assert sorted(names(serving.trailing_window(stored, 24, as_of))) == ["A", "C"]
    assert names(serving.trailing_window(df.filter("trans_num != 'C'"))) == []


def test_stats_of_an_empty_table_are_zero(make_scored):
    row = serving.overall_stats(make_scored({}).limit(0)).first()
    assert list(row) == [0, 0, 0.0, 0.0, 0.0]


def test_missing_prediction_counts_as_not_predicted(make_scored):
    row = serving.overall_stats(make_scored({"prediction": 1.0}, {"prediction": None})).first()
    assert (row["predicted_fraud_transactions"], row["predicted_fraud_rate"]) == (1, 50.0)


def test_only_known_attributes(make_scored):
    with pytest.raises(ValueError, match="Unsupported attribute: state"):
        serving.distribution(make_scored({}), "state")


def test_ranking_and_pivot(make_scored):
    df = make_scored(
        {"category": "a", "prediction": 1.0}, {"category": "a"}, {"category": "b", "prediction": 1.0})
    assert [r["category"] for r in serving.top_categories(df, 1).collect()] == ["b"]
    pivot = serving.day_hour_pivot(serving.day_hour_rates(df)).first().asDict()
    assert (pivot["day_of_week"], pivot["day_name"], pivot["12"]) == (0, "Sunday", None)
    assert pivot["13"] == pytest.approx(200 / 3)


def test_hourly(make_scored):
    df = make_scored({"prediction": 1.0}, {"trans_date_trans_time": "2024-01-07 13:59:59"})
    series = serving.hourly_series(df, 24, F.lit("2024-01-07 20:00:00").cast("timestamp"))
    row = serving.with_hourly_rate(series).first()
    assert row["hour"] == dt.datetime(2024, 1, 7, 13)
    assert (row["total_count"], row["predicted_fraud_count"], row["predicted_fraud_rate"]) == (2, 1, 50.0)


def test_bucket_totals_add_up(make_scored):
    df = make_scored(*[{"amt": a} for a in (1.0, 150.0, 700.0, 5000.0, None)])
    assert sum(r["total_count"] for r in serving.amount_distribution(df).collect()) == 5


def test_display(make_scored):
    shown = cleaning.project_display(serving.latest(make_scored({})))
    assert shown.columns[0] == "Transaction Number" and len(shown.columns) == 8
