"""Questions to the table of scored transactions."""

from pyspark.sql import functions as F

from txscore import fixtures
from txscore.operators import serving
from txscore.plans.oracle import SCORED, SCORED_WIDE, TIME, TX, WIDE, over, r6
from txscore.plans.registry import query

AS_OF = "2024-01-30 12:00:00"
_SINCE = f"{TIME} >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR"
_WITH = over(TX, SCORED)
_NEWEST = "ORDER BY trans_date_trans_time DESC, trans_num"
_STATUS = """SELECT trans_num, trans_date_trans_time, cc_num, amt, merchant, category, is_fraud,
       prediction, round_even(prob_0 * 1e6, 0) / 1e6 AS prob_0,
       round_even(prob_1 * 1e6, 0) / 1e6 AS prob_1,
       CAST(prediction >= 1 AS INTEGER) AS fraud_signal,
       round_even(prob_1 * 100 * 100, 0) / 100.0::DOUBLE AS fraud_probability,
       CASE WHEN prediction >= 1 THEN 'ALERT' ELSE 'CLEAR' END AS status
"""
_RATES = f"""count(*) AS total_count,
       count(*) FILTER (prediction >= 1) AS predicted_fraud_count,
       {r6("avg(prob_1) * 100")} AS avg_fraud_probability,
       {r6("100.0::DOUBLE * count(*) FILTER (prediction >= 1) / count(*)")}
         AS predicted_fraud_rate"""


def as_of():
    return F.lit(AS_OF).cast("timestamp")


def newest_sql(limit: int, where: str = "") -> str:
    return _WITH + _STATUS + f"FROM scored {where} {_NEWEST} LIMIT {limit}"


@query("latest", newest_sql(1000))
def latest(spark, sf_dir):
    return serving.latest(fixtures.scored(spark, sf_dir))


@query("latest_positive", newest_sql(50, "WHERE prediction >= 1"))
def latest_positive(spark, sf_dir):
    return serving.latest(fixtures.scored(spark, sf_dir), 50, fraud_only=True)


@query("predicted_positive", _WITH + f"""
SELECT trans_num, amt, {r6("prob_1")} AS prob_1 FROM scored WHERE prediction >= 1""")
def predicted_positive(spark, sf_dir):
    return serving.predicted_positive(fixtures.scored(spark, sf_dir)).select(
        "trans_num", "amt", "prob_1")


@query("search", _WITH + _STATUS + f"""
FROM scored WHERE merchant ILIKE '%CHANT_1%' AND amt >= 20 AND amt <= 250 {_NEWEST} LIMIT 100""")
def search(spark, sf_dir):
    return serving.search(
        fixtures.scored(spark, sf_dir), merchant="CHANT_1", amount_min=20.0, amount_max=250.0)


@query("search_card", _WITH + _STATUS + f"""
FROM scored WHERE cc_num = 4000000000000042 {_NEWEST} LIMIT 100""")
def search_card(spark, sf_dir):
    return serving.search(fixtures.scored(spark, sf_dir), cc_num="4000000000000042")


@query("search_fraud", _WITH + _STATUS + f"""
FROM scored WHERE merchant ILIKE '%t_7%' AND prediction >= 1 {_NEWEST} LIMIT 100""")
def search_fraud(spark, sf_dir):
    return serving.search(fixtures.scored(spark, sf_dir), merchant="t_7", fraud_only=True)


@query("lookup_one", _WITH + _STATUS + f"""
FROM (SELECT * FROM scored {_NEWEST} LIMIT 1000)
WHERE trans_num = (SELECT trans_num FROM scored {_NEWEST} LIMIT 1)""")
def lookup_one(spark, sf_dir):
    shown = serving.latest(fixtures.scored(spark, sf_dir))
    first = serving.newest(fixtures.scored(spark, sf_dir), 1).first()
    return serving.lookup_one(shown, first["trans_num"])


@query("trailing_window", _WITH + f"SELECT trans_num, amt FROM scored WHERE {_SINCE}")
def trailing_window(spark, sf_dir):
    return serving.trailing_window(fixtures.scored(spark, sf_dir), 24, as_of()).select(
        "trans_num", "amt")


@query("report", _WITH + f"""
SELECT * REPLACE ({r6("prob_0")} AS prob_0, {r6("prob_1")} AS prob_1)
FROM scored WHERE {_SINCE} {_NEWEST}""")
def report(spark, sf_dir):
    return serving.report(fixtures.scored(spark, sf_dir), as_of=as_of())


@query("overall_stats", _WITH + f"""
SELECT count(*) AS total_transactions,
       count(*) FILTER (prediction >= 1) AS predicted_fraud_transactions,
       {r6("100.0::DOUBLE * count(*) FILTER (prediction >= 1) / count(*)")}
         AS predicted_fraud_rate,
       {r6("avg(amt)")} AS avg_transaction_amount,
       {r6("avg(prob_1) * 100")} AS avg_fraud_probability
FROM scored""")
def overall_stats(spark, sf_dir):
    return serving.overall_stats(fixtures.scored(spark, sf_dir))


@query("hourly_series", _WITH + f"""
SELECT date_trunc('hour', {TIME}) AS hour, count(*) AS total_count,
       count(*) FILTER (prediction >= 1) AS predicted_fraud_count
FROM scored WHERE {TIME} >= TIMESTAMP '{AS_OF}' - INTERVAL 72 HOUR GROUP BY 1""")
def hourly_series(spark, sf_dir):
    return serving.hourly_series(fixtures.scored(spark, sf_dir), 72, as_of())


@query("hourly_rate", _WITH + f"""
SELECT date_trunc('hour', {TIME}) AS hour, count(*) AS total_count,
       count(*) FILTER (prediction >= 1) AS predicted_fraud_count,
       {r6("100.0::DOUBLE * count(*) FILTER (prediction >= 1) / count(*)")}
         AS predicted_fraud_rate
FROM scored WHERE {_SINCE} GROUP BY 1""")
def hourly_rate(spark, sf_dir):
    return serving.with_hourly_rate(
        serving.hourly_series(fixtures.scored(spark, sf_dir), 24, as_of()))


@query("by_category", _WITH + f"SELECT category, {_RATES} FROM scored GROUP BY category")
def by_category(spark, sf_dir):
    return serving.distribution(fixtures.scored(spark, sf_dir), "category")


@query("by_merchant", _WITH + f"SELECT merchant, {_RATES} FROM scored GROUP BY merchant")
def by_merchant(spark, sf_dir):
    return serving.distribution(fixtures.scored(spark, sf_dir), "merchant")


@query("top_categories", _WITH + f"""
SELECT category, {_RATES} FROM scored GROUP BY category
ORDER BY count(*) FILTER (prediction >= 1) / count(*)::DOUBLE DESC, category
LIMIT 15""")
def top_categories(spark, sf_dir):
    return serving.top_categories(fixtures.scored(spark, sf_dir))


@query("top_merchants", _WITH + f"""
SELECT merchant, {_RATES} FROM scored GROUP BY merchant
ORDER BY count(*) FILTER (prediction >= 1) / count(*)::DOUBLE DESC, merchant
LIMIT 10""")
def top_merchants(spark, sf_dir):
    return serving.top_merchants(fixtures.scored(spark, sf_dir))


@query("by_amount", _WITH + f"""
SELECT CASE WHEN amt < 100 THEN 'Less than $100' WHEN amt < 500 THEN '$100-$500'
       WHEN amt < 1000 THEN '$500-$1000' ELSE 'Over $1000' END AS amount_category, {_RATES}
FROM scored GROUP BY 1""")
def by_amount(spark, sf_dir):
    return serving.amount_distribution(fixtures.scored(spark, sf_dir))


def scored_wide(spark, sf_dir):
    return fixtures.scored_from(fixtures.tx_wide(spark, sf_dir))


_WITH_WIDE = over(TX, WIDE, SCORED_WIDE)


@query("by_amount_wide", _WITH_WIDE + f"""
SELECT CASE WHEN amt < 100 THEN 'Less than $100' WHEN amt < 500 THEN '$100-$500'
       WHEN amt < 1000 THEN '$500-$1000' ELSE 'Over $1000' END AS amount_category, {_RATES}
FROM scored_wide GROUP BY 1""")
def by_amount_wide(spark, sf_dir):
    """Amounts of all four buckets."""
    return serving.amount_distribution(scored_wide(spark, sf_dir))


@query("top_categories_wide", _WITH_WIDE + f"""
SELECT category, {_RATES} FROM scored_wide GROUP BY category
ORDER BY count(*) FILTER (prediction >= 1) / count(*)::DOUBLE DESC, category LIMIT 15""")
def top_categories_wide(spark, sf_dir):
    """Twenty categories, of which fifteen are shown."""
    return serving.top_categories(scored_wide(spark, sf_dir))


_DAY_HOUR = f"""rates AS (
  SELECT CAST(dayofweek({TIME}) AS INTEGER) AS day_of_week,
         CAST(hour({TIME}) AS INTEGER) AS hour_of_day, count(*) AS total_count,
         count(*) FILTER (prediction >= 1) AS predicted_fraud_count,
         {r6("100.0::DOUBLE * count(*) FILTER (prediction >= 1) / count(*)")}
           AS predicted_fraud_rate
  FROM scored GROUP BY 1, 2)"""


@query("dow_hour_rates", over(TX, SCORED, _DAY_HOUR) + "SELECT * FROM rates")
def dow_hour_rates(spark, sf_dir):
    return serving.day_hour_rates(fixtures.scored(spark, sf_dir))


@query("dow_hour_pivot", over(TX, SCORED, _DAY_HOUR) + "SELECT day_of_week, " + ", ".join(
    f'max(predicted_fraud_rate) FILTER (hour_of_day = {h}) AS "{h}"' for h in range(24)) + """,
  CASE day_of_week WHEN 0 THEN 'Sunday' WHEN 1 THEN 'Monday' WHEN 2 THEN 'Tuesday'
       WHEN 3 THEN 'Wednesday' WHEN 4 THEN 'Thursday' WHEN 5 THEN 'Friday' ELSE 'Saturday' END
    AS day_name
FROM rates GROUP BY day_of_week""")
def dow_hour_pivot(spark, sf_dir):
    return serving.day_hour_pivot(serving.day_hour_rates(fixtures.scored(spark, sf_dir)))
