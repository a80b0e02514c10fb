"""Cleaning: null, duplicate and range rules in three orders that give different rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txscore.constants import (
    CATEGORICAL_FEATURES, COERCED_NUMERIC, DISPLAY_TITLES, KEY, LABEL, NUMERIC_FEATURES, ORDINAL,
)
from txscore.functions import class_probability, parse_ts
from txscore.functions.numeric import missing
from txscore.operators.features import BROADCAST_BYTES, BROADCAST_ROWS, with_model_features
from txscore.schema import SCORED
from txscore.session import written_table


def drop_missing(df: DataFrame, required: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with a null or NaN, in all columns unless `required` names fewer.

    With all columns every one of them has to be read; `required` keeps the scan narrow.
    One condition per column instead of `dropna`: its single condition over all columns
    does not reach a file scan, and over derived columns the optimizer rewrites it once
    per subset of them.
    """
    types = dict(df.dtypes)
    present = [~missing(name, types[name]) for name in required or df.columns]
    return df.filter(reduce(and_, present))


def drop_column_if_present(df: DataFrame, name: str = ORDINAL) -> DataFrame:
    return df.drop(name)


def pick_among_repeated(
    df: DataFrame, keys: Sequence[str], pick: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """`pick` a survivor per key where there is a choice; rows of single keys pass as they are.

    The first phase counts the keys alone and writes those that repeat. In the second, rows
    whose key is not among them are neither sorted nor, while the repeated keys are few by
    count and size, shuffled; more of them are hashed in a shuffled join. Only rows of repeated
    keys reach `pick`. Null is a key like others. `df` is read three times, once for its keys
    only, so it should be a table at rest and give the same rows each time.
    """
    counted = df.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1").drop("_n")
    repeated = written_table(counted.toDF(*[f"_key_{k}" for k in range(len(keys))]), "repeated-keys")
    size = F.coalesce(F.sum(reduce(lambda x, y: x + y, [
        F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0)) for name in repeated.columns])), F.lit(0))
    rows, key_bytes = repeated.agg(F.count("*"), size).first()
    if not rows:
        return df
    small = rows <= BROADCAST_ROWS and key_bytes <= BROADCAST_BYTES
    repeated = F.broadcast(repeated) if small else repeated.hint("shuffle_hash")
    same = reduce(and_, [F.col(name).eqNullSafe(F.col(f"_key_{k}")) for k, name in enumerate(keys)])
    return df.join(repeated, same, "left_anti").unionByName(pick(df.join(repeated, same, "left_semi")))


def dedup(df: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """One row per key, any of them; on a stream for the life of the query.

    Partial aggregation keeps a hot key to one row per task.
    """
    if df.isStreaming:
        return df.dropDuplicates(list(keys))
    if set(df.columns) == set(keys):  # no row is wider than its key
        return df.distinct()
    return pick_among_repeated(df, keys, lambda rows: rows.dropDuplicates(list(keys)))


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The first row per key; `order` should be unique within a key.

    Spark applies the limit of one row per key before the shuffle as well, so a hot
    key sends one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return pick_among_repeated(df, keys, lambda rows: (
        rows.withColumn("_position", F.row_number().over(window))
        .filter(F.col("_position") == 1)
        .drop("_position")))


def dedup_rows(df: DataFrame) -> DataFrame:
    return df.dropDuplicates()


def non_negative(df: DataFrame, columns: Sequence[str] = ("amt", "city_pop")) -> DataFrame:
    """Keep rows whose columns are all >= 0; null fails."""
    for name in columns:
        df = df.filter(F.col(name) >= 0)
    return df


def non_negative_or_missing(df: DataFrame, columns: Sequence[str] = ("amt", "city_pop")) -> DataFrame:
    """Keep rows whose columns are >= 0 or missing; absent columns are not checked."""
    for name in columns:
        if name in df.columns:
            df = df.filter(F.coalesce(F.col(name), F.lit(0)) >= 0)
    return df


def coerce_timestamps(
    df: DataFrame, columns: Sequence[str] = ("trans_date_trans_time", "dob")
) -> DataFrame:
    """Parse text columns to timestamps, bad text to null; absent columns are skipped."""
    return df.withColumns({name: parse_ts(F.col(name)) for name in columns if name in df.columns})


def coerce_numbers(df: DataFrame, columns: Sequence[str] = tuple(COERCED_NUMERIC)) -> DataFrame:
    """Text to double, bad text to null; numeric and absent columns are left alone."""
    types = dict(df.dtypes)
    return df.withColumns({
        name: F.col(name).try_cast("double") for name in columns if types.get(name) == "string"
    })


def clean_stream(
    df: DataFrame, required: Sequence[str] | None = None,
    order: Sequence[str | Column] | None = None,
) -> DataFrame:
    """Drop missing, then one row per transaction, then the range filter.

    The filter stays after the dedup: when copies disagree, the order decides
    whether the key survives. On a batch, `order` makes the first copy the survivor.
    """
    known = drop_missing(df, required)
    return non_negative(dedup(known) if order is None else dedup_first(known, [KEY], order))


def clean_train(df: DataFrame, order: Sequence[str | Column] | None = None) -> DataFrame:
    """One row per transaction, drop missing, derive features, then the range filter.

    With `order` the surviving copy is the first one instead of any.
    """
    if order is None:
        unique = dedup(drop_column_if_present(df))
    else:
        unique = drop_column_if_present(dedup_first(df, [KEY], order))
    return non_negative(with_model_features(drop_missing(unique)))


def clean_explore(df: DataFrame, order: Sequence[str | Column] | None = None) -> DataFrame:
    """Coerce times, keep the first copy, coerce numbers, drop negatives but keep missing.

    `order` says what "first" means, by default the file ordinal. Without either the
    surviving copy is any. Steps whose column is absent are skipped.
    """
    if order is None and ORDINAL in df.columns:
        order = [ORDINAL]
    coerced = coerce_timestamps(df)
    if KEY in df.columns:
        unique = dedup_first(coerced, [KEY], order) if order else dedup(coerced)
        unique = drop_column_if_present(unique)
    else:
        unique = dedup_rows(drop_column_if_present(coerced))
    return non_negative_or_missing(coerce_numbers(unique))


def drop_unscorable(df: DataFrame) -> DataFrame:
    """Drop rows with a missing feature, such as a date that did not parse.

    The feature assembler refuses such a row, and one would stop a stream.
    """
    return drop_missing(df, NUMERIC_FEATURES + CATEGORICAL_FEATURES)


def missing_features(df: DataFrame) -> Column:
    """True for the rows `drop_unscorable` drops."""
    types = dict(df.dtypes)
    return reduce(or_, [
        missing(name, types[name]) for name in NUMERIC_FEATURES + CATEGORICAL_FEATURES])


def project_scored(predictions: DataFrame) -> DataFrame:
    """The serving columns of model output: eight as they are, two class probabilities."""
    return predictions.select(
        *SCORED.names[:8],
        class_probability(F.col("probability"), 0).alias("prob_0"),
        class_probability(F.col("probability"), 1).alias("prob_1"),
    )


def project_display(df: DataFrame) -> DataFrame:
    """The eight display columns under their titles."""
    return df.select(*DISPLAY_TITLES).withColumnsRenamed(DISPLAY_TITLES)


def label_split(df: DataFrame, label: str = LABEL) -> tuple[DataFrame, DataFrame]:
    """Positive and negative rows."""
    return df.filter(F.col(label) == 1), df.filter(F.col(label) == 0)
