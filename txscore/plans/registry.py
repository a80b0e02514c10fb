"""The list of registered queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txscore.functions import round_even
from txscore.session import tune

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Doubles to six places and timestamps without a zone, as the SQL side has them."""
    columns = []
    for name, dtype in df.dtypes:
        column = F.col(f"`{name}`")
        if dtype == "double":
            column = round_even(column, 6)
        elif dtype == "timestamp":
            column = column.cast("timestamp_ntz")
        columns.append(column.alias(name))
    return df.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan; `sql` is the same question for another engine."""

    def register(plan: Plan) -> Plan:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(plan(tune(spark), sf_dir))

        PLANS[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return plan

    return register
