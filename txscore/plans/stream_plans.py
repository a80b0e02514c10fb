"""Streaming over the whole `events` table as a file stream of JSON messages."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import functions as F

from txscore import fixtures
from txscore.operators import modeling
from txscore.operators.cleaning import clean_stream, project_scored
from txscore.operators.features import fit_reference, prepare_features
from txscore.plans.model_plans import agreement, split_sets, written_clean, written_features
from txscore.plans.oracle import FEATURES, SCORED, TX, over, r6
from txscore.plans.registry import query
from txscore.session import shared_dir
from txscore.schema import TRANSACTION
from txscore.sources.readers import decode_messages, read_committed
from txscore.sources.writers import encode_messages, manifest_writer, parquet_writer
from txscore.streaming import scoring
from txscore.streaming.expiry import dedup_for

#: Tasks that encode and decode messages, for each core.
TASKS_A_CORE = 3


def message_stream(spark, sf_dir):
    """The files' row groups give few and uneven tasks, so events are dealt out before they get wide."""
    events = fixtures.stream_events(spark, sf_dir).repartition(TASKS_A_CORE * spark.sparkContext.defaultParallelism)
    return encode_messages(fixtures.transactions_from(events))


def doubled_messages(spark, sf_dir):
    """Every message twice, and one unreadable one in between; each is encoded once."""
    junk = F.concat(F.lit("junk "), F.col("key"))
    return message_stream(spark, sf_dir).select(F.inline(F.array(
        F.struct("key", "value"), F.struct("key", junk.alias("value")), F.struct("key", "value"))))


def run(spark, df, path: str, checkpoint: str, writer=parquet_writer, trigger: str | None = None):
    """Process what is there and stop; returns the stopped query.

    State partitions are fixed in the checkpoint; here they follow the cores at hand.
    """
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    try:
        stream = scoring.start_scoring(df, writer(path), checkpoint, trigger=trigger)
        if trigger:
            stream.processAllAvailable()
            stream.stop()
        else:
            stream.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    return stream


def written(spark, df, name: str):
    path, checkpoint = shared_dir(spark, name), shared_dir(spark, f"{name}-checkpoint")
    run(spark, df, path, checkpoint)
    return spark.read.parquet(path)


@query("stream_features", over(TX, FEATURES) + f"""
SELECT trans_num, amt, city_pop, age, hour, month, day_of_week, {r6("distance")} AS distance,
       {r6("amt_vs_category_avg")} AS amt_vs_category_avg, merchant, category, gender, job, is_fraud
FROM features WHERE amt >= 0 AND city_pop >= 0""")
def stream_features(spark, sf_dir):
    reference = fit_reference(clean_stream(fixtures.tx(spark, sf_dir)))
    features = scoring.stream_features(doubled_messages(spark, sf_dir), reference)
    return written(spark, features, "features").select(
        "trans_num", "amt", "city_pop", "age", "hour", "month", "day_of_week", "distance",
        "amt_vs_category_avg", "merchant", "category", "gender", "job", "is_fraud")


@query("stream_dedup_replay", over(TX) + "SELECT trans_num, amt, city_pop FROM tx")
def stream_dedup_replay(spark, sf_dir):
    """Every message twice, then a restart from the same checkpoint: still one row each."""
    path, checkpoint = shared_dir(spark, "dedup"), shared_dir(spark, "dedup-checkpoint")
    for _ in range(2):
        rows = scoring.clean_incoming(decode_messages(doubled_messages(spark, sf_dir)))
        run(spark, rows, path, checkpoint)
    return spark.read.parquet(path).select("trans_num", "amt", "city_pop")


@query("stream_dedup_watermark", over(TX) + "SELECT trans_num, amt FROM tx")
def stream_dedup_watermark(spark, sf_dir):
    rows = scoring.clean_incoming(decode_messages(doubled_messages(spark, sf_dir)), "1 hour")
    return written(spark, rows, "watermark").select("trans_num", "amt")


@query("stream_rule_score", over(TX, SCORED) + f"""
SELECT trans_num, amt, prediction, {r6("prob_0")} AS prob_0, {r6("prob_1")} AS prob_1 FROM scored""")
def stream_rule_score(spark, sf_dir):
    """The stream to serving rows with the rule as the model: the sink path with a check."""
    clean = scoring.clean_incoming(decode_messages(doubled_messages(spark, sf_dir)))
    return written(spark, fixtures.scored_from(clean), "rule").select(
        "trans_num", "amt", "prediction", "prob_0", "prob_1")


@query("stream_score", over(TX) + """
SELECT count(*) AS "rows", 0::BIGINT AS differing, TRUE AS good FROM tx
WHERE amt >= 0 AND city_pop >= 0""")
def stream_score(spark, sf_dir):
    """The stream scored by a forest trained on the batch: every row as the batch scores it."""
    clean = written_clean(clean_stream(fixtures.tx(spark, sf_dir)))
    reference = fit_reference(clean)
    rows = written_features(prepare_features(clean, reference))
    train, _ = split_sets(rows)
    fitted = modeling.train_forest(train)
    scored = scoring.score_stream(doubled_messages(spark, sf_dir), reference, fitted.model)
    return agreement(written(spark, scored, "scored"),
                     project_scored(modeling.score(rows, fitted.model)))


_LATER = "strftime(trans_date_trans_time::TIMESTAMP + INTERVAL {} MINUTE, '%Y-%m-%d %H:%M:%S')"


@query("stream_dedup_expiry", over(TX) + f"""
SELECT trans_num, trans_date_trans_time, amt FROM tx
UNION ALL SELECT trans_num, {_LATER.format(180)}, amt FROM tx WHERE unix_time % 7 = 0""")
def stream_dedup_expiry(spark, sf_dir):
    """A time to live of an hour: a copy ten minutes on is dropped, one three hours on comes
    through, whether it arrives with the first or after a restart."""
    once = fixtures.transactions_from(fixtures.stream_events(spark, sf_dir))
    moved = {minutes: F.date_format(F.col("trans_date_trans_time").cast("timestamp")
                                    + F.make_dt_interval(mins=F.lit(minutes)), "yyyy-MM-dd HH:mm:ss")
             for minutes in (10, 180)}
    early = once.filter("unix_time % 5 = 0").withColumn("trans_date_trans_time", moved[10])
    late = once.filter("unix_time % 7 = 0").withColumn("trans_date_trans_time", moved[180])
    path, checkpoint = shared_dir(spark, "expiry"), shared_dir(spark, "expiry-checkpoint")
    scoring.configure_state(spark)
    rows = once.unionByName(early).unionByName(late)
    run(spark, dedup_for(rows.select(*TRANSACTION.names), timedelta(hours=1)), path, checkpoint)
    return spark.read.parquet(path).select("trans_num", "trans_date_trans_time", "amt")


_UNSCORABLE = "unix_time % 31 = 0 OR unix_time % 37 = 0"


@query("stream_progress", over(TX) + f"""
SELECT CAST(unix_time % 2 AS INTEGER) AS run, 3::BIGINT AS batches, count(*) AS input_rows,
       count(*) FILTER ({_UNSCORABLE}) AS unscorable, count(*) FILTER (NOT ({_UNSCORABLE})) AS scored
FROM tx GROUP BY 1""")
def stream_progress(spark, sf_dir):
    """Two runs by the clock over one checkpoint, three batches each, as their progress records
    them: rows read, rows without a full set of features, and rows written."""
    topic, path = shared_dir(spark, "topic"), shared_dir(spark, "progress")
    checkpoint = shared_dir(spark, "progress-checkpoint")
    clean = fixtures.tx(spark, sf_dir)
    reference = fit_reference(clean)
    spoiled = clean.withColumns({
        "dob": F.expr("CASE WHEN unix_time % 31 = 0 THEN 'unknown' ELSE dob END"),
        "trans_date_trans_time": F.expr(
            "CASE WHEN unix_time % 37 = 0 THEN 'no date' ELSE trans_date_trans_time END")})
    found = []
    for part in range(2):
        # Dealt by hash, so each of the three files has rows.
        encode_messages(spoiled.filter(F.col("unix_time") % 2 == part)).repartition(3, "key").write.mode(
            "append").parquet(topic)
        messages = spark.readStream.schema("key STRING, value STRING").option("maxFilesPerTrigger", 1).parquet(topic)
        stream = run(spark, scoring.stream_features(messages, reference), path, checkpoint, manifest_writer, "1 second")
        found += [(part, *row) for row in scoring.progress_rows(stream)]
    progress = spark.createDataFrame(found, "run INT, batch_id LONG, input_rows LONG, counter STRING, n LONG")
    written = read_committed(spark, path).groupBy((F.col("unix_time") % 2).cast("int").alias("run")).agg(
        F.count("*").alias("scored"))
    return progress.filter("counter = 'unscorable'").groupBy("run").agg(
        F.countDistinct("batch_id").alias("batches"), F.sum("input_rows").alias("input_rows"),
        F.sum("n").alias("unscorable")).join(written, "run")
