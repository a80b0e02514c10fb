"""Building blocks of the check SQL (DuckDB)."""

from __future__ import annotations

TX = """tx AS (
  SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS trans_date_trans_time,
         4000000000000000 + user_id AS cc_num,
         concat('merchant_', CAST((event_id * 7) % 53 AS VARCHAR)) AS merchant,
         event_type AS category,
         value AS amt,
         concat('F', CAST(user_id AS VARCHAR)) AS first,
         concat('L', CAST(user_id AS VARCHAR)) AS last,
         CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
         concat(CAST(user_id AS VARCHAR), ' Main St') AS street,
         concat('city_', CAST(user_id % 40 AS VARCHAR)) AS city,
         concat('S', CAST(user_id % 10 AS VARCHAR)) AS state,
         CAST(10000 + user_id AS INTEGER) AS zip,
         CAST((user_id * 7919) % 180 - 90 AS DOUBLE) AS lat,
         CAST((user_id * 104729) % 360 - 180 AS DOUBLE) AS long,
         CAST((user_id * 7919) % 100000 AS INTEGER) AS city_pop,
         concat('job_', CAST(user_id % 20 AS VARCHAR)) AS job,
         concat(CAST(1950 + user_id % 50 AS VARCHAR), '-06-15') AS dob,
         concat('T', CAST(event_id AS VARCHAR)) AS trans_num,
         CAST(event_id AS BIGINT) AS unix_time,
         CAST((event_id * 31) % 180 - 90 AS DOUBLE) AS merch_lat,
         CAST((event_id * 17) % 360 - 180 AS DOUBLE) AS merch_long,
         CAST(value >= 150 AS INTEGER) AS is_fraud
  FROM events)"""

DIRTY = """dirty AS (
  SELECT trans_num, category, unix_time, is_fraud,
         CASE WHEN unix_time % 17 = 0 THEN NULL
              WHEN unix_time % 23 = 0 THEN -amt ELSE amt END AS amt,
         CASE WHEN unix_time % 29 = 0 THEN -1 ELSE city_pop END AS city_pop,
         0 AS copy_no
  FROM tx
  UNION ALL
  SELECT trans_num, category, unix_time, is_fraud, amt + 1 AS amt, city_pop, 1 AS copy_no
  FROM tx WHERE unix_time % 10 = 0)"""

WIDE = """wide AS (
  SELECT * REPLACE (amt * (1 + unix_time % 7) AS amt,
                    concat(category, '_', CAST(unix_time % 4 AS VARCHAR)) AS category,
                    CAST((amt * (1 + unix_time % 7) >= 400
                          AND CAST(substr(trans_date_trans_time, 12, 2) AS INTEGER) >= 8)
                         <> (unix_time % 19 = 0) AS INTEGER) AS is_fraud)
  FROM tx)"""

SPOILED = """spoiled AS (
  SELECT * REPLACE (
           CASE WHEN unix_time % 13 = 0 THEN 'no date' ELSE trans_date_trans_time END AS trans_date_trans_time,
           CASE WHEN unix_time % 31 = 0 THEN 'unknown' ELSE dob END AS dob,
           CASE WHEN unix_time % 17 = 0 THEN NULL WHEN unix_time % 19 = 0 THEN 'nan'::DOUBLE
                WHEN unix_time % 23 = 0 THEN -amt ELSE amt END AS amt,
           CASE WHEN unix_time % 29 = 0 THEN -1 ELSE city_pop END AS city_pop,
           CASE WHEN unix_time % 37 = 0 THEN NULL ELSE merchant END AS merchant,
           CASE WHEN unix_time % 43 = 0 THEN 'nan'::DOUBLE ELSE lat END AS lat), 0 AS copy_no FROM tx
  UNION ALL SELECT * REPLACE (amt + 1 AS amt), 1 AS copy_no FROM tx WHERE unix_time % 10 = 0)"""

REPEATED = """repeated AS (
  SELECT * FROM tx UNION ALL SELECT * FROM tx WHERE unix_time % 10 = 0)"""

SCORED = """scored AS (
  SELECT trans_num, trans_date_trans_time, cc_num, amt, merchant, category, is_fraud,
         CASE WHEN amt >= 200 THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS prediction,
         CAST(1.0 AS DOUBLE) - least(CAST(0.99 AS DOUBLE), amt / CAST(400.0 AS DOUBLE)) AS prob_0,
         least(CAST(0.99 AS DOUBLE), amt / CAST(400.0 AS DOUBLE)) AS prob_1
  FROM tx)"""


#: The scored table of the wide transactions.
SCORED_WIDE = SCORED.replace("scored AS", "scored_wide AS").replace("FROM tx", "FROM wide")


def r6(expression: str) -> str:
    """Six places, half to even."""
    return f"round_even(({expression}) * 1e6, 0) / 1e6"


# Distance with the same clamp against rounding above 1.
DISTANCE = """2 * 6371.0::DOUBLE * asin(sqrt(least(1.0::DOUBLE,
    pow(sin((radians(lat) - radians(merch_lat)) / 2), 2)
    + cos(radians(lat)) * cos(radians(merch_lat))
      * pow(sin((radians(long) - radians(merch_long)) / 2), 2))))"""

TIME = "trans_date_trans_time::TIMESTAMP"

# Rows with all model features.
FEATURES = f"""features AS (
  SELECT tx.*,
         CAST(hour({TIME}) AS INTEGER) AS hour,
         CAST(dayofweek({TIME}) + 1 AS INTEGER) AS day_of_week,
         CAST(month({TIME}) AS INTEGER) AS month,
         CAST(year({TIME}) - year(dob::DATE) AS DOUBLE) AS age,
         {DISTANCE} AS distance,
         amt / coalesce(avg_amt, (SELECT avg(amt) FROM tx)) AS amt_vs_category_avg
  FROM tx LEFT JOIN (SELECT category, avg(amt) AS avg_amt FROM tx GROUP BY category) a
    USING (category))"""

# Rows of the exploration table (weekday 0 = Monday, age in fractional years).
EXPLORE = f"""explore AS (
  SELECT tx.*,
         CAST(hour({TIME}) AS INTEGER) AS hour,
         CAST(isodow({TIME}) - 1 AS INTEGER) AS day_of_week,
         CAST(month({TIME}) AS INTEGER) AS month,
         greatest(floor(date_diff('second', dob::TIMESTAMP, {TIME}) / 86400.0::DOUBLE) / 365.25::DOUBLE,
                  0.0::DOUBLE) AS age,
         {DISTANCE} AS distance_km,
         avg_amt AS category_avg_amt,
         amt / coalesce(avg_amt, (SELECT avg(amt) FROM tx)) AS amt_vs_category_avg
  FROM tx LEFT JOIN (SELECT category, avg(amt) AS avg_amt FROM tx GROUP BY category) a
    USING (category))"""


def over(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
