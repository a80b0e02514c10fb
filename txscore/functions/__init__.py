"""Column functions, shared by batch and stream."""

from txscore.functions.amounts import (
    amount_bucket, amount_percent, amount_range_label, fraud_flag, ratio_to_average, status,
    threshold_label,
)
from txscore.functions.calendar import (
    age_by_year, age_fractional, day_name, dow_monday0, dow_sunday0, dow_sunday1, hour_of_day,
    hour_start, month_of_year, parse_ts,
)
from txscore.functions.geo import haversine
from txscore.functions.numeric import percent, round_even
from txscore.functions.vectors import class_probability, probability_vector

__all__ = [
    "age_by_year", "age_fractional", "amount_bucket", "amount_percent", "amount_range_label",
    "class_probability", "day_name", "dow_monday0", "dow_sunday0", "dow_sunday1", "fraud_flag",
    "haversine", "hour_of_day", "hour_start", "month_of_year", "parse_ts", "percent",
    "probability_vector", "ratio_to_average", "round_even", "status", "threshold_label",
]
