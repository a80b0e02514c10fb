"""The shape of physical plans: what keeps them fit for large tables."""

import pytest

from txscore import fixtures
from txscore.operators import cleaning
from txscore.plans import ORACLES, PLANS

TRAINED = {
    "rf_train_score", "gbt_train_score", "grid_search", "ensemble_train_score", "external_test", "full_mode",
    "model_export", "stream_score", "noisy_label_train",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def planned(spark, sf_dir):
    return lambda name: plan(PLANS[name](spark, sf_dir))


@pytest.mark.parametrize("name", [
    "latest", "latest_positive", "search", "search_card", "project_display", "top_merchants",
    "top_categories", "category_risk", "top_profile"])
def test_top_k_does_not_sort_everything(planned, name):
    text = planned(name)
    assert "TakeOrderedAndProject" in text and "rangepartitioning" not in text


def test_keep_first_limits_before_the_shuffle(planned):
    text = planned("dedup_first_lineitem")
    assert text.count("WindowGroupLimit") == 2
    assert text.index("Final") < text.index("hashpartitioning") < text.index("Partial")


@pytest.mark.parametrize("name", ["flagship_category_features", "amount_ratio", "mapped_average"])
def test_small_lookup_is_broadcast(planned, name):
    assert "BroadcastHashJoin" in planned(name)


def test_grouped_rates_aggregate_before_the_shuffle(planned):
    for name in ("by_merchant", "dow_hour_rates", "by_amount", "overall_stats", "hour_share"):
        assert "partial_" in planned(name)


def test_null_rule_reaches_the_scan(spark, sf_dir):
    events = fixtures.read_table(spark, sf_dir, "events")
    text = plan(cleaning.drop_missing(events, ["user_id", "value"]).select("event_id"))
    assert "IsNotNull(user_id), IsNotNull(value)" in text
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in text


def test_only_needed_columns_are_read(planned):
    assert "ReadSchema: struct<value:double>" in planned("amount_bucket4").replace(
        "event_id:bigint,", "")
    assert "struct<l_orderkey:bigint,l_linenumber:int>" in planned("dedup_lineitem")


def test_day_partitions_are_pruned(planned):
    text = planned("scored_roundtrip")
    assert "trans_day" in text.split("PartitionFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(trans_ts" in text


@pytest.mark.parametrize("name", sorted(
    n for n in set(PLANS) - TRAINED if not n.startswith("stream_")))
def test_no_python_and_no_cartesian_step(planned, name):
    text = planned(name)
    for step in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert step not in text, step


def test_every_plan_has_sql():
    assert set(PLANS) == set(ORACLES)


def test_features_start_from_cleaned_files(planned):
    """The dedup's shuffle of whole rows runs before; only the summary is shuffled here."""
    text = planned("flagship_category_features")
    assert text.count("Exchange hashpartitioning") == 1 and "trans_num" not in text.split("Exchange")[1][:60]
