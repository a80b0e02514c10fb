"""Distributions of the cleaned transactions."""

from txscore import fixtures
from txscore.operators import exploration, percentiles
from txscore.operators.cleaning import coerce_timestamps
from txscore.operators.features import fit_reference, with_exploration_features, with_mapped_average
from txscore.operators.sampling import hash_split
from txscore.plans.oracle import EXPLORE, TX, WIDE, over, r6
from txscore.plans.registry import query
from txscore.sources.readers import tag_split

_WITH = over(TX, EXPLORE)


def explored(spark, sf_dir):
    rows = coerce_timestamps(fixtures.tx(spark, sf_dir))
    return with_mapped_average(with_exploration_features(rows), fit_reference(rows))


def timed(spark, sf_dir):
    """Exploration rows without the averages, for plans that do not use them."""
    return with_exploration_features(coerce_timestamps(fixtures.tx(spark, sf_dir)))


@query("category_risk", over(TX) + f"""
SELECT category, count(*) AS total_transactions, {r6("avg(is_fraud)")} AS fraud_rate,
       {r6("avg(amt)")} AS avg_amount
FROM tx GROUP BY category ORDER BY avg(is_fraud) DESC, category LIMIT 12""")
def category_risk(spark, sf_dir):
    return exploration.category_risk(fixtures.tx(spark, sf_dir))


@query("category_risk_wide", over(TX, WIDE) + f"""
SELECT category, count(*) AS total_transactions, {r6("avg(is_fraud)")} AS fraud_rate,
       {r6("avg(amt)")} AS avg_amount
FROM wide GROUP BY category ORDER BY avg(is_fraud) DESC, category LIMIT 12""")
def category_risk_wide(spark, sf_dir):
    """Twenty categories, of which twelve are shown."""
    return exploration.category_risk(fixtures.tx_wide(spark, sf_dir))


@query("label_mean_pivot", _WITH + "SELECT day_of_week, " + ", ".join(
    f'{r6(f"avg(is_fraud) FILTER (hour = {h})")} AS "{h}"' for h in range(24)) + """
FROM explore GROUP BY day_of_week""")
def label_mean_pivot(spark, sf_dir):
    return exploration.label_mean_pivot(timed(spark, sf_dir))


@query("bucket_summary", _WITH + f"""
, buckets(bucket_no, low, high, amount_bucket) AS (VALUES
  (0, 0, 10, '0-10'), (1, 10, 50, '10-50'), (2, 50, 100, '50-100'), (3, 100, 200, '100-200'),
  (4, 200, 500, '200-500'), (5, 500, 1000, '500-1000'), (6, 1000, 'infinity'::DOUBLE, '1000+'))
SELECT bucket_no, amount_bucket, count(trans_num) AS total_transactions,
       {r6("avg(is_fraud)")} AS fraud_rate,
       {r6("quantile_cont(distance_km, 0.5)")} AS median_distance_km
FROM buckets LEFT JOIN explore ON amt > low AND amt <= high GROUP BY bucket_no, amount_bucket""")
def bucket_summary(spark, sf_dir):
    return exploration.bucket_summary(spark, timed(spark, sf_dir))


_EXPLORE_WIDE = EXPLORE.replace("explore AS", "explore_wide AS").replace("tx", "wide")


@query("bucket_summary_wide", over(TX, WIDE, _EXPLORE_WIDE) + f"""
, buckets(bucket_no, low, high, amount_bucket) AS (VALUES
  (0, 0, 10, '0-10'), (1, 10, 50, '10-50'), (2, 50, 100, '50-100'), (3, 100, 200, '100-200'),
  (4, 200, 500, '200-500'), (5, 500, 1000, '500-1000'), (6, 1000, 'infinity'::DOUBLE, '1000+'))
SELECT bucket_no, amount_bucket, count(trans_num) AS total_transactions,
       {r6("avg(is_fraud)")} AS fraud_rate,
       {r6("quantile_cont(distance_km, 0.5)")} AS median_distance_km
FROM buckets LEFT JOIN explore_wide ON amt > low AND amt <= high GROUP BY bucket_no, amount_bucket""")
def bucket_summary_wide(spark, sf_dir):
    """Amounts of all seven buckets."""
    rows = with_exploration_features(coerce_timestamps(fixtures.tx_wide(spark, sf_dir)))
    return exploration.bucket_summary(spark, rows)


@query("label_counts", over(TX) + "SELECT is_fraud, count(*) AS count FROM tx GROUP BY is_fraud")
def label_counts(spark, sf_dir):
    return exploration.label_counts(fixtures.tx(spark, sf_dir))


@query("value_share", over(TX) + f"""
SELECT category, count(*) AS count,
       {r6("100.0::DOUBLE * count(*) / (SELECT count(*) FROM tx)")} AS share
FROM tx GROUP BY category""")
def value_share(spark, sf_dir):
    return exploration.value_share(fixtures.tx(spark, sf_dir), "category")


@query("describe", _WITH + "\nUNION ALL\n".join(f"""
SELECT '{c}' AS "column", count({c}) AS count, {r6(f"avg({c})")} AS mean,
       {r6(f"stddev_samp({c})")} AS std, {r6(f"min({c})")} AS min,
       {r6(f"quantile_cont({c}, 0.25)")} AS q25, {r6(f"quantile_cont({c}, 0.5)")} AS q50,
       {r6(f"quantile_cont({c}, 0.75)")} AS q75, {r6(f"max({c})")} AS max
FROM explore""" for c in ("amt", "hour", "age", "distance_km", "amt_vs_category_avg")))
def describe(spark, sf_dir):
    return exploration.describe(explored(spark, sf_dir))


@query("percentile", over(TX) + f"SELECT {r6('quantile_cont(amt, 0.99)')} AS percentile FROM tx")
def percentile(spark, sf_dir):
    return percentiles.percentile(fixtures.tx(spark, sf_dir), "amt", 0.99)


@query("percentile_price", "SELECT " + r6("quantile_cont(l_extendedprice, 0.99)") + """
  AS percentile FROM lineitem""")
def percentile_price(spark, sf_dir):
    return percentiles.percentile(
        fixtures.read_table(spark, sf_dir, "lineitem"), "l_extendedprice", 0.99)


@query("percentile_trim", over(TX) + """
SELECT trans_num, amt FROM tx WHERE amt <= (SELECT quantile_cont(amt, 0.99) FROM tx)""")
def percentile_trim(spark, sf_dir):
    return percentiles.percentile_trim(
        fixtures.tx(spark, sf_dir).select("trans_num", "amt"), "amt")


@query("histogram_class", over(TX, """
kept AS (SELECT amt, is_fraud FROM tx WHERE amt <= (SELECT quantile_cont(amt, 0.99) FROM tx)),
edges AS (SELECT min(amt) AS low, (max(amt) - min(amt)) / 30.0::DOUBLE AS width FROM kept),
counted AS (SELECT is_fraud, CAST(least(floor((amt - low) / width), 29) AS BIGINT) AS bin,
                   low, width, count(*) AS count FROM kept, edges GROUP BY ALL)""") + f"""
SELECT is_fraud, bin, {r6("low + bin * width")} AS bin_start, count,
       {r6("100.0::DOUBLE * count / sum(count) OVER (PARTITION BY is_fraud)")} AS percent
FROM counted""")
def histogram_class(spark, sf_dir):
    return exploration.histogram_by_class(fixtures.tx(spark, sf_dir), "amt")


@query("hour_share", _WITH + f"""
SELECT is_fraud, hour, count(*) AS count,
       {r6("100.0::DOUBLE * count(*) / sum(count(*)) OVER (PARTITION BY is_fraud)")} AS percent
FROM explore GROUP BY is_fraud, hour""")
def hour_share(spark, sf_dir):
    return exploration.hour_share_by_class(timed(spark, sf_dir))


@query("density_grid", _WITH + f"""
, classes AS (SELECT is_fraud, count(*) AS n,
                     stddev_samp(distance_km) * pow(count(*), -0.2::DOUBLE) AS h
              FROM explore GROUP BY is_fraud),
grid AS (SELECT CAST(i AS INTEGER) AS point,
                i * ((SELECT quantile_cont(distance_km, 0.99) FROM explore) / 199.0::DOUBLE) AS x
         FROM range(200) r(i))
SELECT e.is_fraud, point, {r6("x")} AS x,
       {r6("sum(exp(-0.5::DOUBLE * pow((x - distance_km) / h, 2))) / (n * h * sqrt(2 * pi()))")}
         AS density
FROM explore e JOIN classes c ON e.is_fraud = c.is_fraud, grid
GROUP BY e.is_fraud, point, x, n, h""")
def density_grid(spark, sf_dir):
    return exploration.density_by_class(timed(spark, sf_dir), "distance_km")


_BUCKET = "('0x' || substr(md5(trans_num), 1, 8))::BIGINT % 10000"


@query("union_splits", over(TX) + f"""
SELECT split, count(*) AS "rows", CAST(sum(is_fraud) AS BIGINT) AS positives FROM (
  SELECT *, CASE WHEN {_BUCKET} < 8000 THEN 'train' ELSE 'test' END AS split FROM tx)
GROUP BY split""")
def union_splits(spark, sf_dir):
    from pyspark.sql import functions as F

    train, test = hash_split(fixtures.tx(spark, sf_dir))
    both = exploration.union_splits(tag_split(train, "train"), tag_split(test, "test"))
    return both.groupBy("split").agg(
        F.count("*").alias("rows"), F.sum("is_fraud").alias("positives"))
