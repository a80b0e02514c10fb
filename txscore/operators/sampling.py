"""Splits, undersampling and class weights for an imbalanced label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txscore.constants import KEY, LABEL, NEGATIVE_SHARE, SEED, TRAIN_SHARE
from txscore.operators.cleaning import label_split

BUCKETS = 10_000


def random_split(
    df: DataFrame, share: float = TRAIN_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """Seeded random split. The rows drawn depend on how the data is partitioned."""
    train, valid = df.randomSplit([share, 1.0 - share], seed=seed)
    return train, valid


def hash_bucket(key: Column, salt: str = "") -> Column:
    """A bucket from 0 to 9999 that depends on the key alone."""
    digest = F.md5(F.concat(F.lit(salt), key.cast("string")))
    return (F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % BUCKETS).cast("int")


def hash_split(
    df: DataFrame, share: float = TRAIN_SHARE, key: str = KEY, salt: str = ""
) -> tuple[DataFrame, DataFrame]:
    """Split by key: the same rows whatever the partitioning, also after a lost executor."""
    limit = round(share * BUCKETS)
    bucket = F.coalesce(hash_bucket(F.col(key), salt), F.lit(0))
    return df.filter(bucket < limit), df.filter(bucket >= limit)


def undersample(
    df: DataFrame, share: float = NEGATIVE_SHARE, label: str = LABEL, seed: int = SEED
) -> DataFrame:
    """All positives and a seeded random share of the negatives, without replacement."""
    positives, negatives = label_split(df, label)
    return positives.unionByName(negatives.sample(False, share, seed=seed))


def hash_undersample(
    df: DataFrame, share: float = NEGATIVE_SHARE, label: str = LABEL, key: str = KEY,
    salt: str = "negatives",
) -> DataFrame:
    """As above, drawing by key. One filter, so one pass instead of two."""
    limit = round(share * BUCKETS)
    bucket = F.coalesce(hash_bucket(F.col(key), salt), F.lit(0))
    return df.filter((F.col(label) == 1) | ((F.col(label) == 0) & (bucket < limit)))


def class_weight_of(df: DataFrame, label: str = LABEL) -> float:
    """Negatives per positive, 1.0 without positives. One row reaches the driver."""
    counts = df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label) == 1).alias("positives")).first()
    return counts["negatives"] / counts["positives"] if counts["positives"] else 1.0


def with_class_weight(df: DataFrame, positive: float = 1.0, label: str = LABEL) -> DataFrame:
    """Weight of the positives; validation and test rows keep the default of 1.0."""
    return df.withColumn("classWeight", F.when(
        F.col(label) == 1, F.lit(float(positive))).otherwise(F.lit(1.0)))
