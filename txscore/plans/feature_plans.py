"""Features, category averages and the flagship query."""

from pyspark.sql import functions as F

from txscore import fixtures
from txscore.functions import (
    age_fractional, amount_bucket, amount_range_label, class_probability, day_name, dow_monday0,
    dow_sunday0, dow_sunday1, fraud_flag, hour_start, parse_ts, percent, probability_vector,
    threshold_label,
)
from txscore.operators import features
from txscore.operators.cleaning import clean_stream
from txscore.operators.serving import with_status
from txscore.plans.oracle import DISTANCE, FEATURES, SCORED, TIME, TX, over, r6
from txscore.plans.registry import query
from txscore.session import written_table


def model_rows(spark, sf_dir):
    """Cleaned transactions with all model features; averages from the same table.

    The cleaned rows are written once: averages and features start from the files, so the
    dedup's shuffle of whole rows runs once."""
    clean = written_table(clean_stream(fixtures.tx(spark, sf_dir)), "clean")
    reference = features.fit_reference(clean)
    return features.prepare_features(clean, reference)


@query("flagship_category_features", over(TX, FEATURES) + f"""
SELECT category, count(*) AS total_count,
       CAST(sum(is_fraud) AS BIGINT) AS fraud_count,
       {r6("100.0::DOUBLE * sum(is_fraud) / count(*)")} AS fraud_rate,
       {r6("avg(amt)")} AS avg_amt, {r6("avg(distance)")} AS avg_distance,
       {r6("avg(age)")} AS avg_age, {r6("avg(amt_vs_category_avg)")} AS avg_ratio,
       {r6("avg(hour)")} AS avg_hour
FROM features WHERE amt >= 0 AND city_pop >= 0 GROUP BY category""")
def flagship(spark, sf_dir):
    rows = model_rows(spark, sf_dir)
    return rows.groupBy("category").agg(
        F.count("*").alias("total_count"),
        F.sum("is_fraud").alias("fraud_count"),
        percent(F.sum("is_fraud"), F.count("*")).alias("fraud_rate"),
        F.avg("amt").alias("avg_amt"),
        F.avg("distance").alias("avg_distance"),
        F.avg("age").alias("avg_age"),
        F.avg("amt_vs_category_avg").alias("avg_ratio"),
        F.avg("hour").alias("avg_hour"),
    )


@query("haversine", over(TX) + f"SELECT trans_num, {r6(DISTANCE)} AS distance FROM tx")
def haversine(spark, sf_dir):
    return features.with_distance(fixtures.tx(spark, sf_dir)).select("trans_num", "distance")


@query("time_features", over(TX) + f"""
SELECT trans_num, {TIME} AS trans_date, CAST(hour({TIME}) AS INTEGER) AS hour,
       CAST(dayofweek({TIME}) + 1 AS INTEGER) AS day_of_week,
       CAST(month({TIME}) AS INTEGER) AS month,
       CAST(year({TIME}) - year(dob::DATE) AS DOUBLE) AS age
FROM tx""")
def time_features(spark, sf_dir):
    return features.with_time_features(fixtures.tx(spark, sf_dir)).select(
        "trans_num", "trans_date", "hour", "day_of_week", "month", "age")


@query("weekday_conventions", over(TX) + f"""
SELECT trans_num, CAST(dayofweek({TIME}) + 1 AS INTEGER) AS sunday1,
       CAST(isodow({TIME}) - 1 AS INTEGER) AS monday0,
       CAST(dayofweek({TIME}) AS INTEGER) AS sunday0, dayname({TIME}) AS day_name,
       date_trunc('hour', {TIME}) AS hour_start
FROM tx""")
def weekday_conventions(spark, sf_dir):
    ts = parse_ts(F.col("trans_date_trans_time"))
    return fixtures.tx(spark, sf_dir).select(
        "trans_num", dow_sunday1(ts).alias("sunday1"), dow_monday0(ts).alias("monday0"),
        dow_sunday0(ts).alias("sunday0"), day_name(dow_sunday0(ts)).alias("day_name"),
        hour_start(ts).alias("hour_start"))


@query("age_years", over(TX) + f"""
SELECT trans_num, {r6(f'''greatest(floor(date_diff('second', dob::TIMESTAMP, {TIME})
       / 86400.0::DOUBLE) / 365.25::DOUBLE, 0.0::DOUBLE)''')} AS age
FROM tx""")
def age_years(spark, sf_dir):
    ts, birth = parse_ts(F.col("trans_date_trans_time")), parse_ts(F.col("dob"))
    return fixtures.tx(spark, sf_dir).select("trans_num", age_fractional(ts, birth).alias("age"))


@query("amount_ratio", over(TX, FEATURES) + f"""
SELECT trans_num, {r6("amt_vs_category_avg")} AS amt_vs_category_avg FROM features""")
def amount_ratio(spark, sf_dir):
    rows = fixtures.tx(spark, sf_dir)
    return features.with_relative_amount(rows, features.fit_reference(rows)).select(
        "trans_num", "amt_vs_category_avg")


@query("mapped_average", """
WITH averages AS (
  SELECT o_orderpriority, avg(o_totalprice) AS avg_amt FROM orders GROUP BY o_orderpriority)
SELECT o_orderkey, """ + r6("avg_amt") + """ AS category_avg_amt,
       """ + r6("o_totalprice / coalesce(avg_amt, (SELECT avg(o_totalprice) FROM orders))") + """
         AS amt_vs_category_avg
FROM orders LEFT JOIN averages USING (o_orderpriority)""")
def mapped_average(spark, sf_dir):
    orders = fixtures.read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", F.col("o_orderpriority").alias("category"),
        F.col("o_totalprice").alias("amt"))
    reference = features.fit_reference(orders)
    return features.with_mapped_average(orders, reference).select(
        "o_orderkey", "category_avg_amt", "amt_vs_category_avg")


_SEEN = "seen AS (SELECT * FROM tx WHERE category <> 'view')"


@query("ratio_on_another_table", over(TX, _SEEN) + f"""
SELECT trans_num, {r6("avg_amt")} AS category_avg_amt,
       {r6("amt / coalesce(avg_amt, (SELECT avg(amt) FROM seen))")} AS amt_vs_category_avg,
       {r6("amt / 70.0::DOUBLE")} AS amt_vs_default
FROM tx LEFT JOIN (SELECT category, avg(amt) AS avg_amt FROM seen GROUP BY category) USING (category)""")
def ratio_on_another_table(spark, sf_dir):
    """Averages of a training table applied to one with a category more: its rows have no
    average of their own and take that of the training table; of an empty one, the default."""
    rows = fixtures.tx(spark, sf_dir)
    seen = features.fit_reference(rows.filter(F.col("category") != "view"))
    empty = features.fit_reference(rows.limit(0))
    mapped = features.with_mapped_average(rows, seen).select(
        "trans_num", "category", "amt", "category_avg_amt", "amt_vs_category_avg")
    return features.with_relative_amount(
        mapped.withColumnRenamed("amt_vs_category_avg", "_seen"), empty).select(
        "trans_num", "category_avg_amt", F.col("_seen").alias("amt_vs_category_avg"),
        F.col("amt_vs_category_avg").alias("amt_vs_default"))


@query("category_average", over(TX) + f"""
SELECT category, {r6("avg(amt)")} AS avg_amt FROM tx GROUP BY category""")
def category_average(spark, sf_dir):
    return features.category_avg(fixtures.tx(spark, sf_dir))


@query("global_average", over(TX) + f"SELECT {r6('avg(amt)')} AS avg_amt FROM tx")
def global_average(spark, sf_dir):
    return features.global_avg(fixtures.tx(spark, sf_dir))


@query("model_features", over(TX, FEATURES) + f"""
SELECT trans_num, amt, city_pop, age, hour, month, day_of_week, {r6("distance")} AS distance,
       {r6("amt_vs_category_avg")} AS amt_vs_category_avg, merchant, category, gender, job, is_fraud
FROM features WHERE amt >= 0 AND city_pop >= 0""")
def model_features(spark, sf_dir):
    return model_rows(spark, sf_dir).select(
        "trans_num", "amt", "city_pop", "age", "hour", "month", "day_of_week", "distance",
        "amt_vs_category_avg", "merchant", "category", "gender", "job", "is_fraud")


@query("status_columns", over(TX, SCORED) + """
SELECT trans_num, CAST(coalesce(prediction, 0) >= 1 AS INTEGER) AS fraud_signal,
       round_even(coalesce(prob_1, 0) * 100 * 100, 0) / 100.0::DOUBLE AS fraud_probability,
       CASE WHEN coalesce(prediction, 0) >= 1 THEN 'ALERT' ELSE 'CLEAR' END AS status
FROM scored""")
def status_columns(spark, sf_dir):
    return with_status(fixtures.scored(spark, sf_dir)).select(
        "trans_num", "fraud_signal", "fraud_probability", "status")


@query("amount_bucket4", over(TX) + """
SELECT trans_num, CASE WHEN amt < 100 THEN 'Less than $100' WHEN amt < 500 THEN '$100-$500'
       WHEN amt < 1000 THEN '$500-$1000' ELSE 'Over $1000' END AS amount_category
FROM tx""")
def amount_bucket4(spark, sf_dir):
    return fixtures.tx(spark, sf_dir).select(
        "trans_num", amount_range_label(F.col("amt")).alias("amount_category"))


@query("amount_bucket7", over(TX) + """
SELECT trans_num, CASE WHEN amt <= 0 THEN NULL WHEN amt <= 10 THEN '0-10' WHEN amt <= 50 THEN '10-50'
       WHEN amt <= 100 THEN '50-100' WHEN amt <= 200 THEN '100-200' WHEN amt <= 500 THEN '200-500'
       WHEN amt <= 1000 THEN '500-1000' WHEN amt > 1000 THEN '1000+' END AS amount_bucket
FROM tx""")
def amount_bucket7(spark, sf_dir):
    return fixtures.tx(spark, sf_dir).select(
        "trans_num", amount_bucket(F.col("amt")).alias("amount_bucket"))


@query("vector_elements", over(TX, SCORED) + f"""
SELECT trans_num, {r6("1 - prob_1")} AS p0, {r6("prob_1")} AS p1,
       CASE WHEN prob_1 >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS vote,
       CAST(prediction >= 1 AS INTEGER) AS flag
FROM scored""")
def vector_elements(spark, sf_dir):
    vector = probability_vector(F.col("prob_1"))
    return fixtures.scored(spark, sf_dir).select(
        "trans_num", class_probability(vector, 0).alias("p0"),
        class_probability(vector, 1).alias("p1"), threshold_label(F.col("prob_1")).alias("vote"),
        fraud_flag(F.col("prediction")).alias("flag"))
