from datetime import timedelta

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from txscore import fixtures
from txscore.operators import modeling, sampling
from txscore.operators.cleaning import clean_stream, project_scored
from txscore.operators.features import fit_reference, prepare_features
from txscore.sources.readers import decode_messages, read_committed
from txscore.sources.writers import compact_committed, encode_messages, manifest_writer, parquet_writer
from txscore.streaming import scoring
from txscore.streaming.expiry import dedup_for


@pytest.fixture
def topic(spark, tmp_path):
    """A folder of message files and the stream of it."""
    folder = tmp_path / "topic"
    folder.mkdir()

    class Topic:
        def send(self, name, *texts):
            (folder / name).write_text("".join(t + "\n" for t in texts))

        def stream(self):
            return spark.readStream.format("text").option("maxFilesPerTrigger", 1).load(str(folder))

    return Topic()


def texts(df):
    return [r["value"] for r in encode_messages(df).collect()]


@pytest.fixture
def drain(tmp_path):
    def run(df, writer=None):
        out = str(tmp_path / "out")
        query = scoring.start_scoring(
            df, writer or parquet_writer(out), str(tmp_path / "checkpoint"), trigger=None)
        query.awaitTermination()
        return out

    return run


def keys(spark, path):
    return sorted(r["trans_num"] for r in spark.read.parquet(path).select("trans_num").collect())


def test_repeats_across_batches_restart_and_replay(spark, make, topic, drain):
    first = texts(make({}, {"trans_num": "T2"}, {}))
    topic.send("a", *first)
    topic.send("b", *texts(make({}, {"trans_num": "T3"})))
    clean = lambda: scoring.clean_incoming(decode_messages(topic.stream()))
    path = drain(clean())
    assert keys(spark, path) == ["T1", "T2", "T3"]
    # Same checkpoint, the first file again under a new name, and one new row.
    topic.send("c", *first, *texts(make({"trans_num": "T4"})))
    assert keys(spark, drain(clean())) == ["T1", "T2", "T3", "T4"]
    assert keys(spark, drain(clean())) == ["T1", "T2", "T3", "T4"]


def test_watermark_forgets_old_keys(spark, make, topic, drain):
    later = {"trans_num": "T9", "trans_date_trans_time": "2024-01-09 00:00:00"}
    topic.send("a", *texts(make({})))
    topic.send("b", *texts(make({}, later)))
    topic.send("c", *texts(make(later, {**later, "trans_date_trans_time": "2024-01-09 00:30:00"})))
    path = drain(scoring.clean_incoming(decode_messages(topic.stream()), "1 hour"))
    assert keys(spark, path) == ["T1", "T9"]


def test_a_bad_row_does_not_stop_the_stream(spark, make, topic, drain):
    reference = fit_reference(make({}))
    topic.send("a", "junk", *texts(make({}, {"trans_num": "T2", "dob": "unknown"})))
    assert keys(spark, drain(scoring.stream_features(topic.stream(), reference))) == ["T1"]


def test_unscorable_rows_are_counted(spark, make, topic, drain):
    seen = []

    class Listener(StreamingQueryListener):
        def onQueryStarted(self, event):
            pass

        def onQueryProgress(self, event):
            row = event.progress.observedMetrics.get("unscorable")
            if row is not None:
                seen.append(row["rows"])

        def onQueryTerminated(self, event):
            pass

    listener = Listener()
    spark.streams.addListener(listener)
    try:
        topic.send("a", *texts(make({}, {"trans_num": "T2", "dob": "unknown"})))
        drain(scoring.stream_features(topic.stream(), fit_reference(make({}))))
        for _ in range(100):
            if seen:
                break
            import time
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert max(seen) == 1


def test_a_failed_write_is_not_committed(spark, make, topic, drain, tmp_path):
    topic.send("a", *texts(make({})))

    def fail(batch, number):
        raise OSError("database is away")

    rows = lambda: scoring.clean_incoming(decode_messages(topic.stream()))
    with pytest.raises(Exception, match="database is away"):
        drain(rows(), fail)
    assert keys(spark, drain(rows())) == ["T1"]


def test_stream_scores_like_batch(spark, sf_dir, topic, drain):
    tx = fixtures.tx(spark, sf_dir)
    reference = fit_reference(clean_stream(tx))
    features = prepare_features(clean_stream(tx), reference)
    model = modeling.fit(
        sampling.with_class_weight(features), modeling.random_forest(numTrees=3, maxDepth=3))
    assert isinstance(model, PipelineModel)
    topic.send("a", *texts(tx))
    path = drain(scoring.score_stream(topic.stream(), reference, model))
    columns = ["trans_num", "prediction", F.round("prob_1", 9).alias("p")]
    batch = project_scored(model.transform(features)).select(*columns)
    streamed = spark.read.parquet(path).select(*columns)
    assert batch.exceptAll(streamed).isEmpty() and streamed.exceptAll(batch).isEmpty()
    assert streamed.count() == tx.count()


def test_trigger_interval(spark, make, topic, tmp_path):
    topic.send("a", *texts(make({})))
    query = scoring.start_scoring(
        scoring.clean_incoming(decode_messages(topic.stream())), parquet_writer(str(tmp_path / "out")),
        str(tmp_path / "checkpoint"), trigger="1 second", name="timed")
    try:
        query.processAllAvailable()
        assert query.isActive and query.name == "timed"
    finally:
        query.stop()
    assert keys(spark, str(tmp_path / "out")) == ["T1"]


def test_state_settings(spark, make, topic, drain):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        scoring.configure_state(spark, 3)
        assert "RocksDB" in spark.conf.get("spark.sql.streaming.stateStore.providerClass")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        topic.send("a", *texts(make({}, {}, {"trans_num": "T2"})))
        topic.send("b", *texts(make({"trans_num": "T2"})))
        path = drain(scoring.clean_incoming(decode_messages(topic.stream())))
        assert keys(spark, path) == ["T1", "T2"]
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)
        spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_two_checkpoints_write_side_by_side(spark, make, topic, tmp_path):
    """Both count their batches from 0; neither may take the other's folder."""
    topic.send("a", *texts(make({}, {"trans_num": "T2"})))
    out = str(tmp_path / "out")
    for name in ("one", "two"):
        scoring.start_scoring(
            scoring.clean_incoming(decode_messages(topic.stream())), parquet_writer(out),
            str(tmp_path / name), trigger=None).awaitTermination()
    assert keys(spark, out) == ["T1", "T1", "T2", "T2"]


def test_a_reader_during_a_replay_sees_each_batch_once(spark, make_scored, tmp_path):
    out = str(tmp_path / "out")
    first = make_scored({}, {"trans_num": "T2"})
    write = manifest_writer(out, run="r")
    write(first, 0)
    write(make_scored({"trans_num": "T3"}), 1)
    assert keys_of(read_committed(spark, out)) == ["T1", "T2", "T3"]
    before = read_committed(spark, out)  # begins here, reads during and after the replay
    # The replay of batch 0 has written its rows, and is not committed yet.
    half = f"{out}/run_id=r/batch_id=0/attempt={2 ** 62}"
    from txscore.sources.writers import commits_of, write_scored
    write_scored(make_scored({"trans_num": "T9"}), half)
    assert keys_of(read_committed(spark, out)) == ["T1", "T2", "T3"]
    assert keys_of(spark.read.parquet(out)) == ["T1", "T2", "T3", "T9"]  # without the manifest
    spark.createDataFrame([("r", 0, 2 ** 62)], "run_id STRING, batch_id BIGINT, attempt BIGINT").write.mode(
        "append").parquet(commits_of(out))
    assert keys_of(read_committed(spark, out)) == ["T3", "T9"]
    assert keys_of(before) == ["T1", "T2", "T3"]
    compact_committed(spark, out, str(tmp_path / "days"))
    assert keys(spark, str(tmp_path / "days")) == ["T3", "T9"]
    manifest_writer(out, run="7")(first, 0)  # another run, with a name that looks like a number
    assert keys_of(read_committed(spark, out)) == ["T1", "T2", "T3", "T9"]


def keys_of(df):
    return sorted(r["trans_num"] for r in df.select("trans_num").collect())


def test_a_failed_attempt_leaves_no_commit(spark, make_scored, tmp_path, monkeypatch):
    import txscore.sources.writers as module

    out = str(tmp_path / "out")
    manifest_writer(out, run="r")(make_scored({}), 0)
    monkeypatch.setattr(module, "write_scored", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
    with pytest.raises(OSError):
        manifest_writer(out, run="r")(make_scored({"trans_num": "T2"}), 1)
    assert keys_of(read_committed(spark, out)) == ["T1"]


def at(minutes, **more):
    return {"trans_date_trans_time": f"2024-01-07 {minutes // 60:02}:{minutes % 60:02}:00", **more}


def test_keys_live_for_a_time_and_repeats_are_counted(spark, make, topic, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        scoring.configure_state(spark, 2)
        topic.send("a", *texts(make(at(0), at(50), at(0, trans_num="T2"))))
        topic.send("b", *texts(make(at(30), at(61), at(5, trans_num="T3"))))
        topic.send("c", *texts(make(at(119), at(122), at(1, trans_num="T3", trans_date_trans_time="no date"),
                                    at(200, trans_num="T2", job=None))))
        query = scoring.start_scoring(
            dedup_for(decode_messages(topic.stream()), timedelta(hours=1)),
            manifest_writer(str(tmp_path / "out")), str(tmp_path / "checkpoint"), trigger=None)
        query.awaitTermination()
        got = read_committed(spark, str(tmp_path / "out")).collect()
        assert sorted((r["trans_num"], r["trans_date_trans_time"][11:16]) for r in got) == [
            ("T1", "00:00"), ("T1", "01:01"), ("T1", "02:02"), ("T2", "00:00"), ("T2", "03:20"), ("T3", "00:05")]
        assert {r["job"] for r in got if r["trans_date_trans_time"][11:16] == "03:20"} == {None}
        counted = [(batch, n) for batch, _, name, n in scoring.progress_rows(query) if name == "repeats"]
        assert counted[:3] == [(0, 1), (1, 1), (2, 2)]
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_a_call_to_the_state_serves_many_keys(spark, tmp_path):
    """Far fewer groups than keys: rows come through as they are, state goes by a timer a group."""
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    own = tmp_path / "own"
    schema = "trans_num STRING, trans_date_trans_time STRING, amt DOUBLE, cc BIGINT, odd STRUCT<x: DECIMAL(20, 3), y: TIMESTAMP>"
    odd = "named_struct('x', 12345678901234567.125BD, 'y', timestamp'2024-01-01 00:00:00.123456')"
    first = spark.range(300).selectExpr(
        "IF(id = 7, NULL, concat('T', id)) AS trans_num", "'2024-01-07 00:00:00' AS trans_date_trans_time",
        "CASE id WHEN 1 THEN NULL WHEN 2 THEN double('NaN') WHEN 3 THEN double('-Infinity') ELSE id / 3 END AS amt",
        "IF(id = 4, NULL, 9007199254740993 + id) AS cc", f"IF(id = 5, NULL, {odd}) AS odd")
    again = first.withColumn("trans_date_trans_time", F.lit("2024-01-07 00:30:00"))
    later = first.withColumn("trans_date_trans_time", F.lit("2024-01-07 05:00:00")).limit(10)
    try:
        scoring.configure_state(spark, 2)
        for batch in (first.unionByName(again), later):
            batch.coalesce(1).write.mode("append").parquet(str(own))
            query = scoring.start_scoring(
                dedup_for(spark.readStream.schema(schema).parquet(str(own)), timedelta(hours=1), groups=8),
                manifest_writer(str(tmp_path / "out")), str(tmp_path / "checkpoint"), trigger=None)
            query.awaitTermination()
        got = read_committed(spark, str(tmp_path / "out")).select(*first.columns)
        wanted = first.unionByName(later)
        assert got.exceptAll(wanted).count() == wanted.exceptAll(got).count() == 0
        state = query.lastProgress["stateOperators"][0]
        assert state["numRowsTotal"] <= 3 * 8
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_messages_are_encoded_once(spark, tmp_path):
    import datetime

    import pyarrow as pa
    import pyarrow.parquet as pq

    from txscore.plans.stream_plans import doubled_messages

    pq.write_table(pa.table({
        "event_id": pa.array(range(5), pa.int64()), "ts": pa.array([datetime.datetime(2024, 1, 1, 10)] * 5, pa.timestamp("us")),
        "user_id": pa.array([3] * 5, pa.int64()), "event_type": ["view"] * 5, "value": [1.5] * 5, "props": ["{}"] * 5}),
        tmp_path / "events.parquet")
    messages = doubled_messages(spark, str(tmp_path))
    assert messages._jdf.queryExecution().analyzed().toString().count("to_json") == 1
    messages.writeStream.format("parquet").trigger(availableNow=True).option("path", str(tmp_path / "out")).option(
        "checkpointLocation", str(tmp_path / "checkpoint")).start().awaitTermination()
    counts = spark.read.parquet(str(tmp_path / "out")).groupBy("key", F.substring("value", 1, 7).alias("begin")).count()
    assert sorted(map(tuple, counts.collect())) == sorted(
        x for k in range(5) for x in ((f"T{k}", f"junk T{k}", 1), (f"T{k}", '{"trans', 2)))


def test_text_without_a_brace_is_not_parsed(spark):
    odd = ["junk T1", "", " ", None, "null", "12", '"a"', "[]", "[1]", "{", "}", "{}", ' {"trans_num": "T2"}',
           '[{"trans_num": "T3"}]', '{"trans_num": "T4", "amt": "x"}', 'x{"trans_num": "T5"}']
    messages = spark.createDataFrame([(x,) for x in odd], "value STRING")
    plain = messages.select(F.inline(F.array(F.from_json("value", decode_messages(messages).schema))))
    as_rows = lambda df: sorted(map(str, df.collect()))
    assert as_rows(decode_messages(messages)) == as_rows(plain)
    assert "Contains(value" in decode_messages(messages)._jdf.queryExecution().optimizedPlan().toString()
