import json

import pytest
from pyspark.sql import functions as F

from txscore.constants import ORDINAL
from txscore.schema import SCORED, TRANSACTION
from txscore.session import shared_dir, size_for
from txscore.sources import readers, writers


def keys(df):
    return sorted(r["trans_num"] for r in df.select("trans_num").collect())


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value STRING")


def test_json_round_trip(make):
    df = make({}, {"trans_num": "T2", "amt": None})
    back = readers.decode_messages(writers.encode_messages(df))
    assert back.schema == TRANSACTION
    assert df.exceptAll(back).isEmpty() and back.exceptAll(df).isEmpty()


def test_message_carries_all_fields_and_its_key(make):
    row = writers.encode_messages(make({"job": None})).first()
    assert row["key"] == "T1"
    assert json.loads(row["value"])["job"] is None
    assert len(json.loads(row["value"])) == 22
    assert writers.encode_messages(make({}), key=None).columns == ["value"]


def test_bad_messages_become_nulls_and_can_be_seen(spark, make):
    from txscore.operators.cleaning import clean_stream

    good = writers.encode_messages(make({})).first()["value"]
    not_a_number = good.replace('"amt":12.5', '"amt":NaN')
    wrong_type = good.replace('"amt":12.5', '"amt":"many"')
    absent = good.replace('"job":"J",', "")
    df = messages(spark, "junk", not_a_number, wrong_type, absent, good)
    decoded = readers.decode_messages(df)
    assert decoded.count() == 5
    assert clean_stream(decoded).count() == 1
    assert {r["message"] for r in readers.bad_messages(df).collect()} == {"junk", wrong_type}


def test_csv_with_and_without_ordinal(spark, make, tmp_path):
    df = make({}, {"trans_num": "T2"})
    plain, numbered = str(tmp_path / "plain"), str(tmp_path / "numbered")
    df.write.csv(plain, header=True)
    df.select(F.lit(0).alias(ORDINAL), "*").write.csv(numbered, header=True)
    assert keys(readers.read_transactions_csv(spark, numbered)) == ["T1", "T2"]
    assert keys(readers.read_transactions_csv(spark, plain, ordinal=False)) == ["T1", "T2"]
    assert readers.read_transactions_csv(spark, numbered).schema == TRANSACTION
    assert readers.read_transactions_csv_with_ordinal(spark, numbered).columns[0] == ORDINAL
    # One column too many or too few would shift every field into null.
    with pytest.raises(ValueError, match="does not match"):
        readers.read_transactions_csv(spark, plain)
    with pytest.raises(ValueError, match="does not match"):
        readers.read_transactions_csv(spark, numbered, ordinal=False)


def test_csv_with_an_unnamed_ordinal(spark, make, tmp_path):
    path = tmp_path / "file.csv"
    make({}).toPandas().to_csv(path)
    row = readers.read_transactions_csv(spark, str(path)).first()
    assert (row["trans_num"], row["amt"], row["is_fraud"]) == ("T1", 12.5, 0)


def test_csv_folder_with_one_different_file(spark, make, tmp_path):
    """Each file's header counts: a shorter file must not be read with its values shifted."""
    path = tmp_path / "mixed"
    path.mkdir()
    numbered = make({}, {"trans_num": "T2"}).toPandas()
    numbered.to_csv(path / "a.csv")
    assert keys(readers.read_transactions_csv(spark, str(path))) == ["T1", "T2"]
    numbered.to_csv(path / "b.csv", index=False)
    with pytest.raises(Exception, match="header|HEADER|does not match"):
        readers.read_transactions_csv(spark, str(path)).collect()


def test_csv_inferred(spark, make, tmp_path):
    make({}).write.csv(str(tmp_path / "x"), header=True)
    types = dict(readers.read_csv_inferred(spark, str(tmp_path / "x")).dtypes)
    assert (types["amt"], types["cc_num"], types["city_pop"]) == ("double", "bigint", "int")


def test_split_tag(make):
    assert readers.tag_split(make({}), "train").first()["split"] == "train"


def test_replayed_batch_replaces_its_rows(spark, make_scored, tmp_path):
    path = str(tmp_path / "scored")
    write = writers.parquet_writer(path, "run-a")
    write(make_scored({}, {"trans_num": "T2"}), 0)
    write(make_scored({"trans_num": "T3", "trans_date_trans_time": "2024-02-01 00:00:00"}), 1)
    write(make_scored({}, {"trans_num": "T2"}), 0)
    stored = readers.read_scored(spark, path)
    assert keys(stored) == ["T1", "T2", "T3"]
    # Another checkpoint counts its batches from 0 too.
    writers.parquet_writer(path, "run-b")(make_scored({"trans_num": "T4"}), 0)
    stored = readers.read_scored(spark, path)
    assert keys(stored) == ["T1", "T2", "T3", "T4"]
    with pytest.raises(ValueError, match="name the run"):
        writers.parquet_writer(path)(make_scored({}), 0)
    writers.compact(spark, path, path + "-compact")
    assert keys(readers.read_scored(spark, path + "-compact")) == ["T1", "T2", "T3", "T4"]
    assert set(SCORED.names) <= set(stored.columns)
    assert [str(r["trans_day"]) for r in stored.select("trans_day").distinct().orderBy(
        "trans_day").collect()] == ["2024-01-07", "2024-02-01"]


def test_empty_batch_is_skipped_and_errors_come_through(make_scored):
    seen = []
    write = writers.skip_if_empty(lambda batch, number: seen.append((number, batch.count())))
    write(make_scored({}).limit(0), 0)
    write(make_scored({}), 1)
    assert seen == [(1, 1)]

    def fail(batch, number):
        raise OSError("no space")

    batch = make_scored({})
    with pytest.raises(OSError):
        writers.skip_if_empty(fail)(batch, 2)
    assert not batch.is_cached


def test_report_export_is_sorted(spark, make_scored, tmp_path):
    df = make_scored(
        {"trans_num": "A", "trans_date_trans_time": "2024-01-01 12:00:00"},
        {"trans_num": "B", "trans_date_trans_time": "2024-01-01 13:00:00"},
        {"trans_num": "C", "trans_date_trans_time": "2023-01-01 13:00:00"})
    path = str(tmp_path / "report")
    writers.export_report(df, path, F.lit("2024-01-02 00:00:00").cast("timestamp"))
    rows = spark.read.csv(path, header=True).coalesce(1).collect()
    assert [r["trans_num"] for r in rows] == ["B", "A"] and len(rows[0]) == 10


class Recorder:
    """Stands in for a DataFrameWriter: there is no database to write to here."""

    def __init__(self):
        self.calls = {}

    def format(self, name):
        self.calls["format"] = name
        return self

    def mode(self, name):
        self.calls["mode"] = name
        return self

    def options(self, **options):
        self.calls.update(options)
        return self

    def save(self):
        self.calls["saved"] = True


class Batch:
    def __init__(self):
        self.write = Recorder()


def test_jdbc_append_options():
    batch = Batch()
    writers.jdbc_writer("jdbc:x:y", "scored", {"user": "u"})(batch, 3)
    assert batch.write.calls == {
        "format": "jdbc", "mode": "append", "url": "jdbc:x:y", "dbtable": "scored", "user": "u",
        "numPartitions": "16", "saved": True}


def test_half_written_batch_is_completed(make_scored):
    batch = make_scored({}, {"trans_num": "T2"})
    stored = make_scored({}, {"trans_num": "T9"}).withColumn(
        "batch_id", F.lit(3).cast("bigint")).withColumn("run_id", F.lit("run-a"))
    stored = stored.withColumn("trans_num", F.lit("T1"))
    rest = writers.not_yet_written(batch, stored, 3, "run-a")
    assert keys(rest) == ["T2"] and rest.first()["batch_id"] == 3
    assert keys(writers.not_yet_written(batch, stored, 4, "run-a")) == ["T1", "T2"]
    assert keys(writers.not_yet_written(batch, stored, 3, "run-b")) == ["T1", "T2"]
    assert rest.columns == [*SCORED.names, "batch_id", "run_id"]


def test_shared_dir_follows_the_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    path = shared_dir(spark, "x")
    assert path != shared_dir(spark, "x")
    if root:
        assert path.startswith(root)


def test_sizes_follow_the_input(spark):
    names = ["spark.sql.adaptive.coalescePartitions.initialPartitionNum",
             "spark.sql.files.maxPartitionBytes"]
    before = {n: spark.conf.get(n, None) for n in names}
    try:
        size_for(spark, 1000)
        assert spark.conf.get(names[0]) == "4"
        assert spark.conf.get(names[1]) == str(256 * 1024 ** 2)
        size_for(spark, 10 * 1024 ** 4)
        assert spark.conf.get(names[0]) == "40960"
        assert spark.conf.get(names[1]) == str(256 * 1024 * 1024)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
