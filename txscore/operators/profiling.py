"""Column profiles and data quality."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txscore.constants import DRIFT_ROWS, KEY, LABEL, PROFILE_ROWS
from txscore.functions import percent, round_even
from txscore.functions.numeric import missing


def _values_by_column(df: DataFrame) -> DataFrame:
    """Rows (column_no, value, n): every distinct value of every column, missing as null.

    The first aggregation is keyed by the value, so no column is a hot key, and a
    frequent value is counted in each task before it is shuffled.
    """
    cells = []
    for number, (name, dtype) in enumerate(df.dtypes):
        column = F.col(f"`{name}`")
        known = column + F.lit(0.0) if dtype in ("double", "float") else column  # -0.0 equals 0.0
        cells.append(F.struct(
            F.lit(number).alias("column_no"),
            F.when(~missing(name, dtype), known.cast("string")).alias("value")))
    return df.select(F.inline(F.array(*cells))).groupBy("column_no", "value").agg(
        F.count("*").alias("_rows"))


def profile(df: DataFrame) -> DataFrame:
    """Type, missing count and share, and distinct count (missing is a value) per column."""
    labels = F.array(*[
        F.struct(F.lit(name).alias("column"), F.lit(dtype).alias("dtype"))
        for name, dtype in df.dtypes
    ])
    missing_rows = F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("_rows"))), F.lit(0))
    return (
        _values_by_column(df).groupBy("column_no")
        .agg(
            missing_rows.alias("missing_count"),
            round_even(percent(missing_rows, F.sum("_rows")), 2).alias("missing_pct"),
            F.count("*").alias("nunique"))
        .select(labels[F.col("column_no")].alias("_label"), "missing_count", "missing_pct", "nunique")
        .select("_label.*", "missing_count", "missing_pct", "nunique")
    )


def top_profile(df: DataFrame, limit: int = PROFILE_ROWS) -> DataFrame:
    """The columns with most missing, then most distinct values."""
    return profile(df).orderBy(
        F.desc("missing_pct"), F.desc("nunique"), F.asc("column")).limit(limit)


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows after the first of each identical group, as one row."""
    return _repeats(df, df.columns).select(F.col("repeats").alias("duplicate_rows"))


def duplicate_keys(df: DataFrame, key: str = KEY) -> DataFrame:
    """Rows after the first of each key (null is one key), as one row."""
    return _repeats(df, [key]).select(F.col("repeats").alias("duplicate_keys"))


def _repeats(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(
        F.count("*").alias("_copies")).agg(
        F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("repeats"))


def label_rate(df: DataFrame, label: str = LABEL) -> DataFrame:
    return df.agg((F.avg(label) * 100).alias("fraud_rate_pct"))


def schema_difference(spark: SparkSession, left: DataFrame, right: DataFrame) -> DataFrame:
    """Columns found in one side only: (column, side)."""
    only = [(c, "left") for c in sorted(set(left.columns) - set(right.columns))]
    only += [(c, "right") for c in sorted(set(right.columns) - set(left.columns))]
    return spark.createDataFrame(only, "column STRING, side STRING")


def one_sided_profile(spark: SparkSession, left: DataFrame, right: DataFrame) -> DataFrame:
    """The profile of the columns only one side has."""
    only = schema_difference(spark, left, right)
    left_names = [c for c in left.columns if c not in right.columns]
    right_names = [c for c in right.columns if c not in left.columns]
    parts = [
        profile(side.select(*names)).withColumn("side", F.lit(tag))
        for side, names, tag in ((left, left_names, "left"), (right, right_names, "right")) if names
    ]
    if not parts:
        return only.select("column", "side", F.lit(None).cast("long").alias("missing_count"),
                           F.lit(None).cast("long").alias("nunique"))
    profiles = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    return only.join(profiles, ["column", "side"], "left").select(
        "column", "side", "missing_count", "nunique")


def drift(train: DataFrame, test: DataFrame) -> DataFrame:
    """Distinct counts of all common columns by name, side by side; a page shows the first
    `DRIFT_ROWS` of them."""
    common = sorted(set(train.columns) & set(test.columns))
    sides = [
        profile(df.select(*common)).select("column", F.col("nunique").alias(name))
        for df, name in ((train, "train_nunique"), (test, "test_nunique"))
    ]
    return sides[0].join(sides[1], "column").orderBy("column")


def quality_checks(df: DataFrame) -> DataFrame:
    """Missing dates, negative amounts and repeated keys: (check, count)."""
    flat = df.agg(
        F.count_if(F.col("trans_date_trans_time").isNull()).alias("missing_trans_time"),
        F.count_if(F.col("dob").isNull()).alias("missing_dob"),
        F.count_if(F.col("amt") < 0).alias("negative_amounts"),
    ).unpivot([], ["missing_trans_time", "missing_dob", "negative_amounts"], "check", "count")
    if KEY not in df.columns:
        return flat.unionByName(flat.sparkSession.createDataFrame(
            [("duplicate_trans_num", None)], "check STRING, count LONG"))
    return flat.unionByName(duplicate_keys(df).select(
        F.lit("duplicate_trans_num").alias("check"), F.col("duplicate_keys").alias("count")))


def table_contract(spark: SparkSession, df: DataFrame, expected: T.StructType) -> DataFrame:
    """Expected against found column types, with the row count of the table."""
    found = dict(df.dtypes)
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    names = list(wanted) + [c for c in df.columns if c not in wanted]
    rows = [(n, wanted.get(n), found.get(n), wanted.get(n) == found.get(n)) for n in names]
    return spark.createDataFrame(
        rows, "column STRING, expected STRING, found STRING, matches BOOLEAN"
    ).withColumn("row_count", df.agg(F.count("*").alias("n")).scalar())


def observe_rows(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count the rows of a stage while another action runs it: no extra pass."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def stage_counts(stages: dict[str, DataFrame]) -> DataFrame:
    """Row counts of several stages, one row each."""
    parts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("stage"), "rows")
        for name, df in stages.items()
    ]
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return combined
