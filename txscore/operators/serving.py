"""Questions asked of the table of scored transactions."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txscore.constants import (
    DISTRIBUTION_ATTRIBUTES, LATEST_LIMIT, SEARCH_LIMIT, SEARCH_MAX, SEARCH_MIN, TOP_CATEGORIES,
    TOP_MERCHANTS,
)
from txscore.functions import (
    amount_percent, amount_range_label, day_name, dow_sunday0, fraud_flag, hour_of_day, hour_start,
    parse_ts, percent, status,
)
from txscore.schema import SCORED


def with_status(df: DataFrame) -> DataFrame:
    # One projection: a second one on top of it would keep a sort with a limit below from
    # being planned as a top-k.
    flag = fraud_flag(F.col("prediction"))
    return df.withColumns({
        "fraud_signal": flag,
        "fraud_probability": amount_percent(F.col("prob_1")),
        "status": status(flag),
    })


def event_ts(df: DataFrame) -> Column:
    """The stored timestamp where the table has one, else the parsed text.

    Only the stored one lets a time filter reach the file scan.
    """
    return F.col("trans_ts") if "trans_ts" in df.columns else parse_ts(F.col("trans_date_trans_time"))


def with_event_time(df: DataFrame) -> DataFrame:
    """Add the timestamp and the day the stored table is partitioned by."""
    return df.withColumn("trans_ts", parse_ts(F.col("trans_date_trans_time"))).withColumn(
        "trans_day", F.to_date("trans_ts"))


def predicted_positive(df: DataFrame) -> DataFrame:
    return df.filter(F.col("prediction") >= 1)


def newest(df: DataFrame, limit: int) -> DataFrame:
    """The newest rows by the text time; the key breaks ties."""
    return df.orderBy(F.desc("trans_date_trans_time"), F.asc("trans_num")).limit(limit)


def latest(df: DataFrame, limit: int = LATEST_LIMIT, fraud_only: bool = False) -> DataFrame:
    rows = predicted_positive(df) if fraud_only else df
    return with_status(newest(rows.select(*SCORED.names), limit))


def stored_days(stored: DataFrame) -> list[datetime.date | None]:
    """The days a stored table is partitioned by, newest first, rows without one last.

    For a table as it was read they come from the names of its folders: no file is opened.
    """
    conf = stored.sparkSession.conf
    before = conf.get("spark.sql.optimizer.metadataOnly", "false")
    conf.set("spark.sql.optimizer.metadataOnly", "true")
    try:
        days = [row[0] for row in stored.select("trans_day").distinct().collect()]
    finally:
        conf.set("spark.sql.optimizer.metadataOnly", before)
    known = sorted((day for day in days if day is not None), reverse=True)
    return known + [None] * (None in days)


def newest_days(stored: DataFrame, limit: int, fraud_only: bool = False) -> DataFrame:
    """The rows of so many of the newest days that `limit` rows are among them.

    The newest day is counted first, then older ones, twice as many each time, until there are
    enough; a count stops at the rows that are still wanted. A row whose time is no time has no
    day and may sort anywhere by its text, so these rows stay.
    """
    rows = predicted_positive(stored) if fraud_only else stored
    days = stored_days(stored)
    dated = [day for day in days if day is not None]
    day, wanted, taken, step = F.col("trans_day"), limit, 0, 1
    while wanted > 0 and taken < len(dated):
        some = dated[taken:taken + step]
        wanted -= rows.filter(day.between(F.lit(some[-1]), F.lit(some[0]))).limit(wanted).count()
        taken, step = taken + len(some), step * 2
    since = day >= F.lit(dated[taken - 1]) if taken else F.lit(False)
    return rows.filter(since | day.isNull() if None in days else since)


def latest_stored(stored: DataFrame, limit: int = LATEST_LIMIT, fraud_only: bool = False) -> DataFrame:
    """`latest` on a table stored by day: only the newest days are read."""
    return with_status(newest(newest_days(stored, limit, fraud_only).select(*SCORED.names), limit))


def card_is(number: str) -> Column:
    return F.col("cc_num") == F.lit(int(number))


def merchant_contains(text: str) -> Column:
    """Case-insensitive substring; `%` and `_` in the text act as wildcards."""
    return F.col("merchant").ilike(f"%{text}%")


def amount_between(low: float = SEARCH_MIN, high: float = SEARCH_MAX) -> list[Column]:
    """Inclusive bounds, each only when it narrows the default range."""
    conditions = []
    if low > SEARCH_MIN:
        conditions.append(F.col("amt") >= low)
    if high < SEARCH_MAX:
        conditions.append(F.col("amt") <= high)
    return conditions


def search(
    df: DataFrame, cc_num: str | None = None, merchant: str | None = None,
    amount_min: float = SEARCH_MIN, amount_max: float = SEARCH_MAX, fraud_only: bool = False,
    limit: int = SEARCH_LIMIT,
) -> DataFrame:
    """The newest rows that meet every given condition."""
    conditions = amount_between(amount_min, amount_max)
    if cc_num:
        conditions.append(card_is(cc_num))
    if merchant:
        conditions.append(merchant_contains(merchant))
    rows = predicted_positive(df) if fraud_only else df
    for condition in conditions:
        rows = rows.filter(condition)
    return with_status(newest(rows.select(*SCORED.names), limit))


def lookup_one(shown: DataFrame, trans_num: str) -> DataFrame:
    """The first match among the shown rows."""
    return shown.filter(F.col("trans_num") == trans_num).limit(1)


def trailing_window(df: DataFrame, hours: int = 24, as_of: Column | None = None) -> DataFrame:
    """Rows of the last hours, lower bound included, no upper bound."""
    moment = as_of if as_of is not None else F.current_timestamp()
    start = moment - F.make_dt_interval(hours=F.lit(hours))
    rows = df.filter(event_ts(df) >= start)
    if "trans_day" in df.columns:
        rows = rows.filter(F.col("trans_day") >= F.to_date(start))
    return rows


def report(df: DataFrame, hours: int = 24, as_of: Column | None = None) -> DataFrame:
    """All columns of the last hours, newest first."""
    return trailing_window(df, hours, as_of).orderBy(
        F.desc("trans_date_trans_time"), F.asc("trans_num"))


def _rates() -> list[Column]:
    total = F.count("*")
    positive = F.sum(fraud_flag(F.col("prediction")))
    return [
        total.alias("total_count"),
        positive.alias("predicted_fraud_count"),
        (F.avg("prob_1") * 100).alias("avg_fraud_probability"),
        percent(positive, total).alias("predicted_fraud_rate"),
    ]


def overall_stats(df: DataFrame) -> DataFrame:
    """One row; zeros on an empty table."""
    total = F.count("*")
    positive = F.coalesce(F.sum(fraud_flag(F.col("prediction"))), F.lit(0))
    zero = F.lit(0.0)
    return df.agg(
        total.alias("total_transactions"),
        positive.alias("predicted_fraud_transactions"),
        F.coalesce(percent(positive, total), zero).alias("predicted_fraud_rate"),
        F.coalesce(F.avg("amt"), zero).alias("avg_transaction_amount"),
        F.coalesce(F.avg("prob_1") * 100, zero).alias("avg_fraud_probability"),
    )


def hourly_series(df: DataFrame, hours: int = 24, as_of: Column | None = None) -> DataFrame:
    window = trailing_window(df, hours, as_of)
    return (
        window.groupBy(hour_start(event_ts(window)).alias("hour"))
        .agg(
            F.count("*").alias("total_count"),
            F.sum(fraud_flag(F.col("prediction"))).alias("predicted_fraud_count"),
        )
        .orderBy("hour")
    )


def with_hourly_rate(series: DataFrame) -> DataFrame:
    return series.withColumn("predicted_fraud_rate", F.coalesce(
        percent(F.col("predicted_fraud_count"), F.col("total_count")), F.lit(0.0)))


def distribution(df: DataFrame, attribute: str) -> DataFrame:
    """Counts and rates per category or merchant, highest rate first."""
    if attribute not in DISTRIBUTION_ATTRIBUTES:
        raise ValueError(f"Unsupported attribute: {attribute}")
    return df.groupBy(attribute).agg(*_rates()).orderBy(
        F.desc("predicted_fraud_rate"), F.asc(attribute))


def amount_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy(amount_range_label(F.col("amt")).alias("amount_category")).agg(
        *_rates()).orderBy(F.desc("predicted_fraud_rate"), F.asc("amount_category"))


def top_categories(df: DataFrame, limit: int = TOP_CATEGORIES) -> DataFrame:
    return distribution(df, "category").limit(limit)


def top_merchants(df: DataFrame, limit: int = TOP_MERCHANTS) -> DataFrame:
    return distribution(df, "merchant").limit(limit)


def day_hour_rates(df: DataFrame) -> DataFrame:
    """Totals and rate per weekday (0 = Sunday) and hour."""
    ts = event_ts(df)
    total = F.count("*")
    positive = F.sum(fraud_flag(F.col("prediction")))
    return df.groupBy(dow_sunday0(ts).alias("day_of_week"), hour_of_day(ts).alias("hour_of_day")).agg(
        total.alias("total_count"),
        positive.alias("predicted_fraud_count"),
        percent(positive, total).alias("predicted_fraud_rate"),
    ).orderBy("day_of_week", "hour_of_day")


def day_hour_pivot(rates: DataFrame) -> DataFrame:
    """Day rows with their name, one column per hour; absent cells are null."""
    return (
        rates.groupBy("day_of_week")
        .pivot("hour_of_day", list(range(24)))
        .agg(F.first("predicted_fraud_rate"))
        .withColumn("day_name", day_name(F.col("day_of_week")))
        .orderBy("day_of_week")
    )
