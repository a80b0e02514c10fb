"""Transaction tables derived from the `events` table (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txscore.schema import SCORED, TRANSACTION

EVENT_SCHEMA = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"

_TX_COLUMNS = {
    "trans_date_trans_time": "date_format(ts, 'yyyy-MM-dd HH:mm:ss')",
    "cc_num": "4000000000000000 + user_id",
    "merchant": "concat('merchant_', CAST((event_id * 7) % 53 AS STRING))",
    "category": "event_type",
    "amt": "value",
    "first": "concat('F', CAST(user_id AS STRING))",
    "last": "concat('L', CAST(user_id AS STRING))",
    "gender": "CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END",
    "street": "concat(CAST(user_id AS STRING), ' Main St')",
    "city": "concat('city_', CAST(user_id % 40 AS STRING))",
    "state": "concat('S', CAST(user_id % 10 AS STRING))",
    "zip": "CAST(10000 + user_id AS INT)",
    "lat": "CAST((user_id * 7919) % 180 - 90 AS DOUBLE)",
    "long": "CAST((user_id * 104729) % 360 - 180 AS DOUBLE)",
    "city_pop": "CAST((user_id * 7919) % 100000 AS INT)",
    "job": "concat('job_', CAST(user_id % 20 AS STRING))",
    "dob": "concat(CAST(1950 + user_id % 50 AS STRING), '-06-15')",
    "trans_num": "concat('T', CAST(event_id AS STRING))",
    "unix_time": "CAST(event_id AS BIGINT)",
    "merch_lat": "CAST((event_id * 31) % 180 - 90 AS DOUBLE)",
    "merch_long": "CAST((event_id * 17) % 360 - 180 AS DOUBLE)",
    "is_fraud": "CAST(value >= 150 AS INT)",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole `events` table as a file stream."""
    return (
        spark.readStream.schema(EVENT_SCHEMA)
        .option("pathGlobFilter", "events.parquet")
        .parquet(sf_dir)
    )


def transactions_from(events: DataFrame) -> DataFrame:
    """Clean transactions, one per event; works on a batch or a stream."""
    return events.selectExpr(*[f"{_TX_COLUMNS[name]} AS `{name}`" for name in TRANSACTION.names])


def tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transactions_from(read_table(spark, sf_dir, "events"))


def tx_dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nulls, negatives and conflicting repeats; `copy_no` orders the repeats."""
    clean = tx(spark, sf_dir)
    amt = F.expr(
        "CASE WHEN unix_time % 17 = 0 THEN NULL WHEN unix_time % 23 = 0 THEN -amt ELSE amt END")
    city_pop = F.expr("CASE WHEN unix_time % 29 = 0 THEN -1 ELSE city_pop END")
    keep = ["trans_num", "category", "unix_time", "is_fraud"]
    first = clean.select(
        *keep, amt.alias("amt"), city_pop.alias("city_pop"), F.lit(0).alias("copy_no"))
    again = clean.filter("unix_time % 10 = 0").select(
        *keep, (F.col("amt") + 1).alias("amt"), "city_pop", F.lit(1).alias("copy_no"))
    return first.unionByName(again)


def tx_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions whose amounts reach every bucket, in twenty categories, and whose label follows
    amount and hour but for one row in nineteen, which no feature tells apart."""
    amt = F.expr("amt * (1 + unix_time % 7)")
    risky = F.expr("amt * (1 + unix_time % 7) >= 400 AND CAST(substring(trans_date_trans_time, 12, 2) AS INT) >= 8")
    flipped = F.expr("unix_time % 19 = 0")
    return tx(spark, sf_dir).withColumns({
        "amt": amt,
        "category": F.expr("concat(category, '_', CAST(unix_time % 4 AS STRING))"),
        "is_fraud": (risky != flipped).cast("int"),
    })


def tx_spoiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of transactions with nulls, NaN, dates that are none, negatives and conflicting
    repeats; `copy_no` orders the repeats."""
    clean = tx(spark, sf_dir)
    spoiled = clean.withColumns({
        "trans_date_trans_time": F.expr("CASE WHEN unix_time % 13 = 0 THEN 'no date' ELSE trans_date_trans_time END"),
        "dob": F.expr("CASE WHEN unix_time % 31 = 0 THEN 'unknown' ELSE dob END"),
        "amt": F.expr("CASE WHEN unix_time % 17 = 0 THEN NULL WHEN unix_time % 19 = 0 THEN double('NaN') "
                      "WHEN unix_time % 23 = 0 THEN -amt ELSE amt END"),
        "city_pop": F.expr("CASE WHEN unix_time % 29 = 0 THEN -1 ELSE city_pop END"),
        "merchant": F.expr("CASE WHEN unix_time % 37 = 0 THEN NULL ELSE merchant END"),
        "lat": F.expr("CASE WHEN unix_time % 43 = 0 THEN double('NaN') ELSE lat END"),
    }).withColumn("copy_no", F.lit(0))
    again = clean.filter("unix_time % 10 = 0").withColumns({"amt": F.col("amt") + 1, "copy_no": F.lit(1)})
    return spoiled.unionByName(again)


def tx_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transactions with every tenth row repeated exactly."""
    clean = tx(spark, sf_dir)
    return clean.unionByName(clean.filter("unix_time % 10 = 0"))


def scored_from(transactions: DataFrame) -> DataFrame:
    """Serving rows whose scores follow a rule instead of a trained model."""
    risk = F.least(F.lit(0.99), F.col("amt") / F.lit(400.0))
    return transactions.withColumns({
        "prediction": F.when(F.col("amt") >= 200, F.lit(1.0)).otherwise(F.lit(0.0)),
        "prob_0": F.lit(1.0) - risk,
        "prob_1": risk,
    }).select(*SCORED.names)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_from(tx(spark, sf_dir))
