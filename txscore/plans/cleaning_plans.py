"""Cleaning orders, deduplication, coercion and projections."""

from pyspark.sql import functions as F

from txscore import fixtures
from txscore.constants import COERCED_NUMERIC
from txscore.functions import probability_vector
from txscore.operators import cleaning
from txscore.operators.serving import latest
from txscore.plans.oracle import DIRTY, DISTANCE, REPEATED, SCORED, SPOILED, TX, over, r6
from txscore.plans.registry import query

_DIRTY_COLUMNS = f"trans_num, category, unix_time, is_fraud, {r6('amt')} AS amt, city_pop, copy_no"
_FIRST_COPY = "row_number() OVER (PARTITION BY trans_num ORDER BY copy_no)"


# A NaN is no number to compare or print: it stands as -999 in results.
_PLAIN = "CASE WHEN isnan({0}) THEN -999 ELSE {0} END"
_NO_GAP = "amt IS NOT NULL AND NOT isnan(amt) AND merchant IS NOT NULL AND NOT isnan(lat)"


@query("clean_stream", over(TX, SPOILED) + f"""
SELECT trans_num, category, unix_time, is_fraud, trans_date_trans_time, dob, merchant, {r6("amt")} AS amt,
       city_pop, lat, copy_no
FROM (SELECT *, {_FIRST_COPY} AS n FROM spoiled WHERE {_NO_GAP})
WHERE n = 1 AND amt >= 0 AND city_pop >= 0""")
def clean_stream(spark, sf_dir):
    """Rows without null or NaN, the first copy that is left, no negatives; bad dates stay."""
    return cleaning.clean_stream(fixtures.tx_spoiled(spark, sf_dir), order=["copy_no"]).select(
        "trans_num", "category", "unix_time", "is_fraud", "trans_date_trans_time", "dob", "merchant", "amt",
        "city_pop", "lat", "copy_no")


@query("clean_train", over(TX, SPOILED) + f"""
, timed AS (SELECT *, try_cast(trans_date_trans_time AS TIMESTAMP) AS t, try_cast(dob AS DATE) AS born,
                   {_FIRST_COPY} AS n FROM spoiled)
SELECT trans_num, category, unix_time, is_fraud, {r6("amt")} AS amt, city_pop, copy_no,
       CAST(hour(t) AS INTEGER) AS hour, CAST(dayofweek(t) + 1 AS INTEGER) AS day_of_week,
       CAST(month(t) AS INTEGER) AS month, CAST(year(t) - year(born) AS DOUBLE) AS age,
       {r6(DISTANCE)} AS distance
FROM timed WHERE n = 1 AND {_NO_GAP} AND amt >= 0 AND city_pop >= 0""")
def clean_train(spark, sf_dir):
    """The first copy of each row, without null or NaN, with features; bad dates give none."""
    return cleaning.clean_train(fixtures.tx_spoiled(spark, sf_dir), order=["copy_no"]).select(
        "trans_num", "category", "unix_time", "is_fraud", "amt", "city_pop", "copy_no",
        "hour", "day_of_week", "month", "age", "distance")


@query("clean_explore", over(TX, SPOILED) + f"""
, typed AS (SELECT * REPLACE (try_cast(trans_date_trans_time AS TIMESTAMP) AS trans_date_trans_time,
                              try_cast(dob AS TIMESTAMP) AS dob), {_FIRST_COPY} AS n FROM spoiled)
SELECT trans_num, trans_date_trans_time, dob, merchant, copy_no,
       {r6("CASE WHEN unix_time % 41 = 0 AND copy_no = 0 THEN NULL ELSE " + _PLAIN.format("amt") + " END")} AS amt,
       {_PLAIN.format("lat")} AS lat, CAST(city_pop AS DOUBLE) AS city_pop, merch_long,
       CAST(unix_time AS DOUBLE) AS unix_time
FROM typed WHERE n = 1 AND (coalesce(amt, 0) >= 0 OR (unix_time % 41 = 0 AND copy_no = 0)) AND city_pop >= 0""")
def clean_explore(spark, sf_dir):
    """All numbers come as text here, some of them unreadable, as from a file without a schema."""
    rows = fixtures.tx_spoiled(spark, sf_dir)
    text = rows.withColumns({name: F.col(name).cast("string") for name in COERCED_NUMERIC}).withColumn(
        "amt", F.expr("CASE WHEN unix_time % 41 = 0 AND copy_no = 0 THEN 'n/a' ELSE amt END"))
    clean = cleaning.clean_explore(text, order=["copy_no"])
    plain = {name: F.when(F.isnan(name), -999.0).otherwise(F.col(name)) for name in ("amt", "lat")}
    return clean.withColumns(plain).select(
        "trans_num", "trans_date_trans_time", "dob", "merchant", "copy_no", "amt", "lat", "city_pop", "merch_long",
        "unix_time")


@query("drop_missing", over(TX, DIRTY) + f"SELECT {_DIRTY_COLUMNS} FROM dirty WHERE amt IS NOT NULL")
def drop_missing(spark, sf_dir):
    return cleaning.drop_missing(fixtures.tx_dirty(spark, sf_dir))


@query("range_filter", over(TX, DIRTY) + f"""
SELECT {_DIRTY_COLUMNS} FROM dirty WHERE amt >= 0 AND city_pop >= 0""")
def range_filter(spark, sf_dir):
    return cleaning.non_negative(fixtures.tx_dirty(spark, sf_dir))


@query("range_filter_tolerant", over(TX, DIRTY) + f"""
SELECT {_DIRTY_COLUMNS} FROM dirty WHERE coalesce(amt, 0) >= 0 AND coalesce(city_pop, 0) >= 0""")
def range_filter_tolerant(spark, sf_dir):
    return cleaning.non_negative_or_missing(fixtures.tx_dirty(spark, sf_dir))


@query("dedup_lineitem", "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem")
def dedup_lineitem(spark, sf_dir):
    lines = fixtures.read_table(spark, sf_dir, "lineitem")
    return cleaning.dedup(lines, ["l_orderkey", "l_linenumber"]).select("l_orderkey", "l_linenumber")


@query("dedup_first_lineitem", """
SELECT l_orderkey, l_linenumber, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS n FROM lineitem)
WHERE n = 1""")
def dedup_first_lineitem(spark, sf_dir):
    order = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    keys = ["l_orderkey", "l_linenumber"]
    lines = fixtures.read_table(spark, sf_dir, "lineitem").select(*keys, *order)
    return cleaning.dedup_first(lines, keys, order)


@query("dedup_rows", over(TX, REPEATED) + "SELECT DISTINCT * FROM repeated")
def dedup_rows(spark, sf_dir):
    return cleaning.dedup_rows(fixtures.tx_repeated(spark, sf_dir))


_SPOILED_NUMBERS = dict(zip(COERCED_NUMERIC, (19, 23, 29, 31, 37, 41, 43)))


@query("coerce_text", over(TX) + """
SELECT trans_num,
       CASE WHEN unix_time % 13 = 0 THEN NULL ELSE trans_date_trans_time::TIMESTAMP END
         AS trans_date_trans_time,
       dob::TIMESTAMP AS dob, """ + ", ".join(
    f"CASE WHEN unix_time % {k} = 0 THEN NULL ELSE CAST({c} AS DOUBLE) END AS {c}"
    for c, k in _SPOILED_NUMBERS.items()) + " FROM tx")
def coerce_text(spark, sf_dir):
    """Every date and number column as text, each with unreadable values of its own."""
    text = fixtures.tx(spark, sf_dir).select(
        "trans_num", "dob",
        F.expr("CASE WHEN unix_time % 13 = 0 THEN 'no date' ELSE trans_date_trans_time END")
        .alias("trans_date_trans_time"),
        *(F.expr(f"CASE WHEN unix_time % {k} = 0 THEN 'n/a' ELSE CAST({c} AS STRING) END").alias(c)
          for c, k in _SPOILED_NUMBERS.items()))
    return cleaning.coerce_numbers(cleaning.coerce_timestamps(text))


@query("project_scored", over(TX, SCORED) + f"""
SELECT trans_num, trans_date_trans_time, cc_num, amt, merchant, category, is_fraud, prediction,
       {r6("1 - prob_1")} AS prob_0, {r6("prob_1")} AS prob_1
FROM scored""")
def project_scored(spark, sf_dir):
    predictions = fixtures.scored(spark, sf_dir).withColumn(
        "probability", probability_vector(F.col("prob_1")))
    return cleaning.project_scored(predictions)


@query("project_display", over(TX, SCORED) + """
SELECT trans_num AS "Transaction Number", trans_date_trans_time AS "Time",
       cc_num AS "Credit Card Number", amt AS "Amount", merchant AS "Merchant",
       category AS "Category",
       round_even(prob_1 * 100 * 100, 0) / 100.0::DOUBLE AS "Fraud Probability (%)",
       CASE WHEN prediction >= 1 THEN 'ALERT' ELSE 'CLEAR' END AS "Status"
FROM scored ORDER BY trans_date_trans_time DESC, trans_num LIMIT 20""")
def project_display(spark, sf_dir):
    return cleaning.project_display(latest(fixtures.scored(spark, sf_dir), 20))


@query("label_split_union", over(TX) + """
SELECT trans_num, is_fraud, amt, 'positive' AS part FROM tx WHERE is_fraud = 1
UNION ALL SELECT trans_num, is_fraud, amt, 'negative' AS part FROM tx WHERE is_fraud = 0""")
def label_split_union(spark, sf_dir):
    rows = fixtures.tx(spark, sf_dir).select("trans_num", "is_fraud", "amt")
    positives, negatives = cleaning.label_split(rows)
    return positives.withColumn("part", F.lit("positive")).unionByName(
        negatives.withColumn("part", F.lit("negative")))
