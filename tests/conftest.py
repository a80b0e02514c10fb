import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from txscore.session import build_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


TRANSACTION = {
    "trans_date_trans_time": "2024-01-07 13:45:10", "cc_num": 4000000000000001,
    "merchant": "fraud_Kirlin and Sons", "category": "grocery", "amt": 12.5, "first": "A",
    "last": "B", "gender": "F", "street": "1 Road", "city": "C", "state": "S", "zip": 10001,
    "lat": 10.0, "long": 20.0, "city_pop": 1000, "job": "J", "dob": "1980-06-15",
    "trans_num": "T1", "unix_time": 1, "merch_lat": 11.0, "merch_long": 21.0, "is_fraud": 0,
}


@pytest.fixture
def make(spark):
    """Rows of transactions from the fields that matter to a test."""
    from txscore.schema import TRANSACTION as SCHEMA

    def build(*changes):
        rows = [{**TRANSACTION, **change} for change in changes]
        return spark.createDataFrame([tuple(r[n] for n in SCHEMA.names) for r in rows], SCHEMA)

    return build


@pytest.fixture
def make_scored(spark):
    from txscore.schema import SCORED

    base = {
        "trans_num": "T1", "trans_date_trans_time": "2024-01-07 13:45:10",
        "cc_num": 4000000000000001, "amt": 12.5, "merchant": "m", "category": "c", "is_fraud": 0,
        "prediction": 0.0, "prob_0": 0.9, "prob_1": 0.1,
    }

    def build(*changes):
        rows = [{**base, **change} for change in changes]
        return spark.createDataFrame([tuple(r[n] for n in SCORED.names) for r in rows], SCORED)

    return build
