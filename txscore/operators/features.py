"""Features, category averages and the lookup join."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txscore.constants import DEFAULT_AVERAGE
from txscore.functions import (
    age_by_year, age_fractional, dow_monday0, dow_sunday1, haversine, hour_of_day, month_of_year,
    parse_ts, ratio_to_average,
)
from txscore.session import written_table

# A lookup is broadcast only when counted and measured below these.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 16 * 1024 * 1024


def with_distance(df: DataFrame, name: str = "distance") -> DataFrame:
    return df.withColumn(name, haversine(
        F.col("lat"), F.col("long"), F.col("merch_lat"), F.col("merch_long")))


def with_time_features(df: DataFrame) -> DataFrame:
    """Hour, weekday (1 = Sunday), month and age from the two text dates."""
    ts, birth = F.col("trans_date"), parse_ts(F.col("dob").cast("string"))
    return df.withColumn("trans_date", parse_ts(F.col("trans_date_trans_time"))).withColumns({
        "hour": hour_of_day(ts),
        "day_of_week": dow_sunday1(ts),
        "month": month_of_year(ts),
        "age": age_by_year(ts, birth),
    })


#: What the features that need no lookup are made from.
FEATURE_SOURCES = ("trans_date_trans_time", "dob", "lat", "long", "merch_lat", "merch_long")


def with_model_features(df: DataFrame) -> DataFrame:
    """The features that need no lookup. A table without one of their sources is refused: a model
    would be trained or asked without them."""
    absent = [name for name in FEATURE_SOURCES if name not in df.columns]
    if absent:
        raise ValueError(f"features need the columns {', '.join(absent)}")
    return with_distance(with_time_features(df))


def with_exploration_features(df: DataFrame) -> DataFrame:
    """Features of the exploration table, whose two date columns are timestamps."""
    ts, birth = F.col("trans_date_trans_time"), F.col("dob")
    return with_distance(df, "distance_km").withColumns({
        "hour": hour_of_day(ts),
        "day_of_week": dow_monday0(ts),
        "month": month_of_year(ts),
        "age": age_fractional(ts, birth),
    })


def category_avg(df: DataFrame, category: str = "category", amt: str = "amt") -> DataFrame:
    return df.groupBy(category).agg(F.avg(amt).alias("avg_amt"))


def global_avg(df: DataFrame, amt: str = "amt") -> DataFrame:
    """One row; use `.scalar()` to put it into another plan."""
    return df.agg(F.avg(amt).alias("avg_amt"))


@dataclass(frozen=True)
class CategoryReference:
    """Category averages with a fallback, measured so a join can tell how to use them."""

    sums: DataFrame
    fallback: float
    rows: int
    key_bytes: int

    @property
    def averages(self) -> DataFrame:
        return self.sums.select("category", F.try_divide("_sum", "_count").alias("avg_amt"))

    @property
    def small(self) -> bool:
        return self.rows <= BROADCAST_ROWS and self.key_bytes <= BROADCAST_BYTES


def fit_reference(df: DataFrame, default: float = DEFAULT_AVERAGE) -> CategoryReference:
    """Averages per category and overall from one pass over `df`.

    Both come out of one grouped sum and count, written to the shared folder: nothing stays
    in executor storage, and no later plan picks up what an earlier one left. Only the
    overall average and the size of the table reach the driver.
    """
    sums = written_table(df.groupBy("category").agg(
        F.sum("amt").alias("_sum"), F.count("amt").alias("_count")), "averages")
    facts = sums.agg(
        F.try_divide(F.sum("_sum"), F.sum("_count")).alias("average"),
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.octet_length("category")), F.lit(0)).alias("key_bytes"),
    ).first()
    return CategoryReference(
        sums, float(facts["average"] or default), facts["rows"], facts["key_bytes"])


def join_reference(df: DataFrame, reference: CategoryReference) -> DataFrame:
    """Left join with the averages, for a batch or a stream.

    A measured small table is broadcast, so the big side is not shuffled. A larger one
    goes to a shuffled join, where adaptive execution splits hot categories.
    """
    averages = F.broadcast(reference.averages) if reference.small else reference.averages
    return df.join(averages, on="category", how="left")


def with_relative_amount(df: DataFrame, reference: CategoryReference) -> DataFrame:
    """Amount over its category average, or over the overall average."""
    return (
        join_reference(df, reference)
        .withColumn("amt_vs_category_avg", ratio_to_average(
            F.col("amt"), F.col("avg_amt"), F.lit(float(reference.fallback))))
        .drop("avg_amt")
    )


def with_mapped_average(df: DataFrame, reference: CategoryReference) -> DataFrame:
    """As above but keeping the average itself; a category without one stays null."""
    return join_reference(df, reference).withColumnRenamed("avg_amt", "category_avg_amt").withColumn(
        "amt_vs_category_avg", ratio_to_average(
            F.col("amt"), F.col("category_avg_amt"), F.lit(float(reference.fallback))))


def prepare_features(df: DataFrame, reference: CategoryReference) -> DataFrame:
    """All model features on cleaned rows; the same function serves batch and stream."""
    return with_relative_amount(with_model_features(df), reference)
