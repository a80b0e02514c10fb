"""Sources and sinks, written and read back."""

from pyspark.sql import functions as F

from txscore import fixtures
from txscore.constants import ORDINAL
from txscore.operators import serving
from txscore.operators.serving import trailing_window
from txscore.plans.oracle import SCORED, TIME, TX, over, r6
from txscore.plans.registry import query
from txscore.plans.serving_plans import AS_OF, as_of, newest_sql
from txscore.session import shared_dir
from txscore.schema import SCORED as SCORED_SCHEMA
from txscore.schema import TRANSACTION
from txscore.sources import readers, writers

_SINCE = f"{TIME} >= TIMESTAMP '{AS_OF}' - INTERVAL 24 HOUR"


@query("json_roundtrip", over(TX) + "SELECT * FROM tx")
def json_roundtrip(spark, sf_dir):
    return readers.decode_messages(writers.encode_messages(fixtures.tx(spark, sf_dir)))


@query("props_decode", """
SELECT CAST(props->>'$.k' AS INTEGER) AS k, count(*) AS count FROM events GROUP BY 1""")
def props_decode(spark, sf_dir):
    from pyspark.sql.types import IntegerType, StructField, StructType

    messages = fixtures.read_table(spark, sf_dir, "events").select(F.col("props").alias("value"))
    decoded = readers.decode_messages(messages, StructType([StructField("k", IntegerType())]))
    return decoded.groupBy("k").agg(F.count("*").alias("count"))


@query("bad_messages", over(TX) + """
SELECT concat('junk ', trans_num) AS message FROM tx WHERE unix_time % 11 = 0""")
def bad_messages(spark, sf_dir):
    good = writers.encode_messages(fixtures.tx(spark, sf_dir))
    spoiled = good.select(F.when(
        F.get_json_object("value", "$.unix_time").cast("bigint") % 11 == 0,
        F.concat(F.lit("junk "), F.col("key"))).otherwise(F.col("value")).alias("value"))
    return readers.bad_messages(spoiled)


def _write_csv(spark, sf_dir):
    path = shared_dir(spark, "csv")
    rows = fixtures.tx(spark, sf_dir)
    rows.select(F.col("unix_time").cast("int").alias(ORDINAL), *TRANSACTION.names).write.csv(
        path, header=True)
    return path


@query("csv_roundtrip", over(TX) + "SELECT * FROM tx")
def csv_roundtrip(spark, sf_dir):
    return readers.read_transactions_csv(spark, _write_csv(spark, sf_dir))


@query("csv_inferred", over(TX) + "SELECT trans_num, cc_num, amt, city_pop, merchant FROM tx")
def csv_inferred(spark, sf_dir):
    return readers.read_csv_inferred(spark, _write_csv(spark, sf_dir)).select(
        "trans_num", "cc_num", "amt", "city_pop", "merchant")


def stored(spark, sf_dir):
    """The scored table, written by day and read back."""
    path = shared_dir(spark, "scored")
    writers.write_scored(fixtures.scored(spark, sf_dir), path)
    return readers.read_scored(spark, path)


@query("scored_roundtrip", over(TX, SCORED) + f"""
SELECT trans_num, {TIME} AS trans_ts, amt FROM scored WHERE {_SINCE}""")
def scored_roundtrip(spark, sf_dir):
    return trailing_window(stored(spark, sf_dir), 24, as_of()).select("trans_num", "trans_ts", "amt")


@query("latest_stored", newest_sql(1000))
def latest_stored(spark, sf_dir):
    """As `latest`, from the newest days of the stored table."""
    return serving.latest_stored(stored(spark, sf_dir))


@query("latest_stored_positive", newest_sql(50, "WHERE prediction >= 1"))
def latest_stored_positive(spark, sf_dir):
    return serving.latest_stored(stored(spark, sf_dir), 50, fraud_only=True)


@query("report_stored", over(TX, SCORED) + f"""
SELECT * REPLACE ({r6("prob_0")} AS prob_0, {r6("prob_1")} AS prob_1) FROM scored WHERE {_SINCE}""")
def report_stored(spark, sf_dir):
    return serving.report(stored(spark, sf_dir), as_of=as_of()).select(*SCORED_SCHEMA.names)


@query("hourly_stored", over(TX, SCORED) + f"""
SELECT date_trunc('hour', {TIME}) AS hour, count(*) AS total_count,
       count(*) FILTER (prediction >= 1) AS predicted_fraud_count,
       {r6("100.0::DOUBLE * count(*) FILTER (prediction >= 1) / count(*)")} AS predicted_fraud_rate
FROM scored WHERE {TIME} >= TIMESTAMP '{AS_OF}' - INTERVAL 72 HOUR GROUP BY 1""")
def hourly_stored(spark, sf_dir):
    return serving.with_hourly_rate(serving.hourly_series(stored(spark, sf_dir), 72, as_of()))


@query("report_export", over(TX, SCORED) + f"""
SELECT * REPLACE ({r6("prob_0")} AS prob_0, {r6("prob_1")} AS prob_1) FROM scored WHERE {_SINCE}""")
def report_export(spark, sf_dir):
    path = shared_dir(spark, "report")
    writers.export_report(
        fixtures.scored(spark, sf_dir), path, as_of())
    return spark.read.csv(path, header=True, schema=SCORED_SCHEMA)
