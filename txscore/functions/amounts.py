"""Amount ratios, buckets and score labels."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from txscore.constants import EXPLORATION_BUCKETS, SERVING_BUCKET_REST, SERVING_BUCKETS
from txscore.functions.numeric import round_even


def ratio_to_average(amt: Column, average: Column, fallback: Column) -> Column:
    """Amount over the category average, or over the fallback where there is none."""
    return F.try_divide(amt, F.coalesce(average, fallback))


def fraud_flag(prediction: Column) -> Column:
    """1 when predicted positive; a missing prediction counts as 0."""
    return F.when(prediction >= 1, F.lit(1)).otherwise(F.lit(0))


def amount_percent(probability: Column) -> Column:
    """Probability in percent, two places, missing as 0."""
    return round_even(F.coalesce(probability, F.lit(0.0)) * 100.0, 2)


def status(flag: Column) -> Column:
    return F.when(flag == 1, F.lit("ALERT")).otherwise(F.lit("CLEAR"))


def amount_range_label(amt: Column) -> Column:
    """Four left-closed ranges; a missing amount falls into the last."""
    label = F.when(amt < SERVING_BUCKETS[0][0], F.lit(SERVING_BUCKETS[0][1]))
    for upper, name in SERVING_BUCKETS[1:]:
        label = label.when(amt < upper, F.lit(name))
    return label.otherwise(F.lit(SERVING_BUCKET_REST))


def amount_bucket(amt: Column) -> Column:
    """Seven right-closed ranges; null outside of them, so for 0 and below."""
    bounds = [
        ((amt > low) & (amt <= high) if high is not None else (amt > low), name)
        for low, high, name in EXPLORATION_BUCKETS
    ]
    label = F.when(amt.isNull() | F.isnan(amt), F.lit(None).cast("string"))
    for inside, name in bounds:
        label = label.when(inside, F.lit(name))
    return label


def threshold_label(probability: Column, threshold: float = 0.5) -> Column:
    return F.when(probability >= threshold, F.lit(1.0)).otherwise(F.lit(0.0))
