"""Distributions of the cleaned transactions."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txscore.constants import DESCRIBED, EXPLORATION_BUCKETS, LABEL, TOP_RISK
from txscore.functions import amount_bucket, percent
from txscore.operators.percentiles import grouped_percentiles, in_a_tree, long_values, percentile
from txscore.session import written_table

#: Bandwidths beyond which a kernel's value is zero in double precision.
KERNEL_REACH = 38.61


def category_risk(df: DataFrame, label: str = LABEL, limit: int | None = TOP_RISK) -> DataFrame:
    """Size, label rate and average amount per category, riskiest first."""
    risk = df.groupBy("category").agg(
        F.count("*").alias("total_transactions"),
        F.avg(label).alias("fraud_rate"),
        F.avg("amt").alias("avg_amount"),
    ).orderBy(F.desc("fraud_rate"), F.asc("category"))
    return risk if limit is None else risk.limit(limit)


def label_mean_pivot(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Mean of the label by weekday (rows, 0 = Monday) and hour (columns)."""
    return (
        df.groupBy("day_of_week").pivot("hour", list(range(24))).agg(F.avg(label))
        .orderBy("day_of_week")
    )


def bucket_summary(
    spark: SparkSession, df: DataFrame, label: str = LABEL, distance: str = "distance_km"
) -> DataFrame:
    """Size, label rate and median distance per amount bucket; empty buckets stay, size 0."""
    bucketed = df.select(
        amount_bucket(F.col("amt")).alias("amount_bucket"),
        F.col(label).alias("_label"), F.col(distance).alias("_distance"))
    names = [name for _, _, name in EXPLORATION_BUCKETS]
    sizes = bucketed.groupBy("amount_bucket").agg(
        F.count("*").alias("_size"), F.avg("_label").alias("fraud_rate"))
    distances = bucketed.select(
        F.col("amount_bucket").alias("name"), F.col("_distance").cast("double").alias("value"))
    known = F.col("name").isNotNull() & F.col("value").isNotNull() & ~F.isnan("value")
    medians = grouped_percentiles(distances.filter(known), [0.5]).select(
        F.col("name").alias("amount_bucket"), F.col("percentile").alias("median_distance_km"))
    buckets = spark.createDataFrame(
        list(enumerate(names)), "bucket_no INT, amount_bucket STRING")
    return (
        buckets.join(sizes, "amount_bucket", "left").join(medians, "amount_bucket", "left")
        .select(
            "bucket_no", "amount_bucket",
            F.coalesce("_size", F.lit(0)).alias("total_transactions"),
            "fraud_rate", "median_distance_km")
        .orderBy("bucket_no")
    )


def label_counts(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("count"))


def value_share(df: DataFrame, column: str = LABEL) -> DataFrame:
    """Counts by value with their percent of all counted rows; missing is not counted."""
    known = df.select(column).filter(F.col(column).isNotNull())
    total = known.agg(F.count("*").alias("total")).scalar()
    return known.groupBy(column).agg(F.count("*").alias("count")).withColumn(
        "share", percent(F.col("count"), total)).orderBy(column)


def moments(values: DataFrame) -> DataFrame:
    """Rows (name, count, mean, std, min, max) of rows (name, value), from one pass.

    Means and squared deviations of groups of tasks are merged pair by pair, which keeps the
    digits that a sum of squares loses; no step takes a row from every task.
    """
    value = F.col("value")
    own = F.struct(F.count("*").cast("double").alias("n"), F.avg(value).alias("mean"),
                   (F.var_pop(value) * F.count("*")).alias("off"))

    def joined(a: Column, b: Column) -> Column:
        n, gap = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"), (a["mean"] + gap * b["n"] / n).alias("mean"),
            (a["off"] + b["off"] + gap * gap * a["n"] * b["n"] / n).alias("off"))

    nothing = F.struct(*(F.lit(0.0).alias(name) for name in ("n", "mean", "off")))
    # As many as there are salts.
    merged = F.aggregate(F.sort_array(F.collect_list("own")), nothing, joined)
    found = in_a_tree(
        values, [own.alias("own"), F.min(value).alias("min"), F.max(value).alias("max")],
        [merged.alias("own"), F.min("min").alias("min"), F.max("max").alias("max")])
    return found.select(
        "name", F.col("own.n").cast("bigint").alias("count"), F.col("own.mean").alias("mean"),
        F.when(F.col("own.n") > 1, F.sqrt(F.col("own.off") / (F.col("own.n") - 1))).alias("std"), "min", "max")


def describe(df: DataFrame, columns: Sequence[str] = tuple(DESCRIBED)) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles, one row per column.

    The described values are written once, so that features are not derived again in each pass.
    """
    values = written_table(long_values(df, {name: F.col(name) for name in columns}), "described")
    known = written_table(moments(values), "moments")
    sizes = {row["name"]: row["count"] for row in known.select("name", "count").collect()}
    quartiles = grouped_percentiles(values, [0.25, 0.5, 0.75], sizes).groupBy("name").agg(*[
        F.max(F.when(F.col("probability") == p, F.col("percentile"))).alias(alias)
        for p, alias in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
    ])
    # Both sides have one row per described column.
    return known.join(F.broadcast(quartiles), "name").select(
        F.col("name").alias("column"), "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def histogram_by_class(
    df: DataFrame, column: str, label: str = LABEL, bins: int = 30, trim: float | None = 0.99
) -> DataFrame:
    """Percent of each class per equal-width bin over the common range, last bin closed.

    With `trim` only rows up to that percentile of the column take part.
    """
    rows = df.select(F.col(column).alias("_x"), F.col(label).alias(label)).filter(
        F.col("_x").isNotNull() & ~F.isnan("_x"))
    if trim is not None:
        rows = rows.filter(F.col("_x") <= percentile(df, column, trim).scalar())
    # One pass for both ends: equal subqueries run once.
    ends = rows.agg(F.struct(F.min("_x").alias("low"), F.max("_x").alias("high")).alias("ends")).scalar()
    low, high = ends.getField("low"), ends.getField("high")
    # A column with a single value gets a range of 1 around it.
    spread = high > low
    start = F.when(spread, low).otherwise(low - 0.5)
    width = F.when(spread, (high - low) / float(bins)).otherwise(1.0 / bins)
    index = F.floor((F.col("_x") - start) / width)
    counted = rows.groupBy(label, F.least(index, F.lit(bins - 1).cast("bigint")).alias("bin")).agg(
        F.count("*").alias("count"))
    return _with_class_percent(counted, label).select(
        label, "bin", (start + F.col("bin") * width).alias("bin_start"), "count", "percent")


def hour_share_by_class(df: DataFrame, label: str = LABEL) -> DataFrame:
    """Percent of each class per hour of day."""
    counted = df.groupBy(label, "hour").agg(F.count("*").alias("count"))
    return _with_class_percent(counted, label)


def _with_class_percent(counted: DataFrame, label: str) -> DataFrame:
    # At most one row per class and bin reaches this window.
    total = F.sum("count").over(Window.partitionBy(label))
    return counted.withColumn("percent", percent(F.col("count"), total))


def kernel_rows(
    df: DataFrame, column: str, label: str = LABEL, points: int = 200, upto: float = 0.99
) -> tuple[DataFrame, DataFrame, Column]:
    """Distinct values of each class with the grid points that they reach, the classes, and the
    grid's step.

    A value joins the grid by range: only points within `KERNEL_REACH` bandwidths, beyond which
    the kernel adds nothing at all.
    """
    rows = df.select(F.col(column).alias("_x"), F.col(label).alias(label)).filter(
        F.col("_x").isNotNull() & ~F.isnan("_x") & F.col(label).isNotNull())
    step = percentile(df, column, upto).scalar() / float(points - 1)
    deviation, size = F.stddev_samp("_x"), F.count("*").cast("double")
    # Null for a class without spread.
    inverse = F.try_divide(F.lit(1.0), deviation * F.pow(size, F.lit(-0.2)))
    classes = rows.groupBy(label).agg(
        inverse.alias("_inverse"),
        (inverse / (size * math.sqrt(2.0 * math.pi))).alias("_scale"))
    # One row per class: the label of a two-class problem.
    counted = rows.groupBy(label, "_x").agg(F.count("*").alias("_n"))
    reach = KERNEL_REACH / F.col("_inverse")

    def point(at: Column) -> Column:
        """The grid's place, one beyond an end at most; zero where the grid is a single point."""
        place = F.coalesce(F.try_divide(at, step), F.lit(0.0))
        return F.greatest(F.lit(-1.0), F.least(F.lit(float(points)), place))

    first = F.greatest(F.ceil(point(F.col("_x") - reach)), F.lit(0)).cast("int")
    last = F.least(F.floor(point(F.col("_x") + reach)), F.lit(points - 1)).cast("int")
    whole = F.col("_inverse").isNull() | (step <= 0)
    first = F.when(whole, F.lit(0)).otherwise(first)
    last = F.when(whole, F.lit(points - 1)).otherwise(last)
    joined = counted.join(F.broadcast(classes), label).withColumns({"_first": first, "_last": last})
    return joined.filter("_first <= _last").withColumn(
        "point", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last"), classes, step


def density_by_class(
    df: DataFrame, column: str, label: str = LABEL, points: int = 200, upto: float = 0.99
) -> DataFrame:
    """Gaussian kernel density per class on an even grid from 0 to the percentile.

    Bandwidth by Scott's rule per class. Equal values of a class are counted first; each
    distinct one is evaluated at the grid points that it reaches, and the sums are partial
    aggregates. Points that no value reaches have density 0.
    """
    spread, classes, step = kernel_rows(df, column, label, points, upto)
    z = (F.col("point") * step - F.col("_x")) * F.col("_inverse")
    sums = spread.groupBy(F.col(label).alias("_label"), F.col("point").alias("_point")).agg(
        F.sum(F.exp(z * z * -0.5) * F.col("_scale") * F.col("_n")).alias("density"))
    grid = classes.select(label, F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
    at = (F.col(label) == F.col("_label")) & (F.col("point") == F.col("_point"))
    density = F.when(F.col("_label").isNull(), F.lit(0.0)).otherwise(F.col("density"))
    # One row per class and point on both sides.
    return grid.join(F.broadcast(sums), at, "left").select(
        label, "point", (F.col("point") * step).alias("x"), density.alias("density"))


def union_splits(*splits: DataFrame) -> DataFrame:
    """Tagged splits one below the other, matched by column name."""
    combined = splits[0]
    for split in splits[1:]:
        combined = combined.unionByName(split)
    return combined
