"""Quality of predictions, comparison of models and the voting ensemble."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txscore.constants import BOOSTED_NAME, ENSEMBLE_NAME, FOREST_NAME, KEY, LABEL, METRICS
from txscore.functions import class_probability, probability_vector, threshold_label
from txscore.schema import METRICS_RECORD
from txscore.session import written_table

# Areas use every distinct score; a number of bins makes the curve an approximation.
CURVE_BINS = 0
#: Distinct scores that a task puts in order.
SCORES_A_TASK = 1_000_000


def _count_where(label: str, actual: int, predicted: int, weight: Column) -> Column:
    hit = (F.col(label) == actual) & (F.col("prediction") == predicted)
    return F.coalesce(F.sum(F.when(hit, weight).otherwise(F.lit(0))), F.lit(0))


def confusion(
    predictions: DataFrame, label: str = LABEL, weight: Column | None = None
) -> DataFrame:
    """One row: tp, tn, fp, fn; zeros on an empty table."""
    each = F.lit(1) if weight is None else weight
    return predictions.agg(
        _count_where(label, 1, 1, each).alias("tp"),
        _count_where(label, 0, 0, each).alias("tn"),
        _count_where(label, 0, 1, each).alias("fp"),
        _count_where(label, 1, 0, each).alias("fn"),
    )


def with_precision_recall(counts: DataFrame) -> DataFrame:
    """Precision, recall and F1 of confusion counts; zero where undefined."""
    tp = F.col("tp").cast("double")
    precision, recall = F.col("precision"), F.col("recall")
    return counts.withColumns({
        "precision": tp / F.greatest(F.col("tp") + F.col("fp"), F.lit(1)),
        "recall": tp / F.greatest(F.col("tp") + F.col("fn"), F.lit(1)),
    }).withColumn(
        "f1", 2 * precision * recall / F.greatest(precision + recall, F.lit(1e-12)))


def positive_score(predictions: DataFrame, raw_col: str) -> Column:
    """The score of class 1, from a vector or a plain number."""
    if dict(predictions.dtypes)[raw_col] == "vector":
        return class_probability(F.col(raw_col), 1)
    return F.col(raw_col).cast("double")


def score_counts(
    predictions: DataFrame, raw_col: str = "rawPrediction", label: str = LABEL
) -> DataFrame:
    """Rows counted per (label, prediction, score): all that the metrics need.

    The model runs once instead of once per metric. A small forest gives few distinct scores
    and the counts are far smaller than the predictions; with many trees nearly every row has
    a score of its own, and the shuffle carries that many narrow rows.
    """
    return predictions.groupBy(
        F.col(label).cast("double").alias(label), F.col("prediction"),
        positive_score(predictions, raw_col).alias("score"),
    ).agg(F.count("*").cast("double").alias("weight"))


def area(
    counts: DataFrame, metric: str, label: str = LABEL, bins: int = CURVE_BINS
) -> float:
    """areaUnderROC or areaUnderPR of counted scores; bins=0 uses every distinct score."""
    return BinaryClassificationEvaluator(
        labelCol=label, rawPredictionCol="score", weightCol="weight", metricName=metric,
        numBins=bins).evaluate(counts)


def _prefix_sums(counts: DataFrame, label: str) -> DataFrame:
    """For each distinct score its positives and negatives, those with a higher score, and all.

    The scores are dealt by range, summed up within each range in its own task, and the sums of
    the ranges before are added: one sort, whatever the number of areas that follow.
    """
    positive = F.when(F.col(label) == 1, F.col("weight")).otherwise(F.lit(0.0))
    by_score = counts.groupBy("score").agg(
        F.sum(positive).alias("p"), F.sum(F.col("weight") - positive).alias("n"))
    parts = max(1, -(-counts.count() // SCORES_A_TASK))
    if parts == 1:
        dealt = by_score.withColumn("part", F.lit(0))
    else:
        dealt = written_table(by_score.repartitionByRange(parts, F.desc("score")).withColumn(
            "part", F.spark_partition_id()), "scores-by-range")
    sums = dealt.groupBy("part").agg(F.sum("p").alias("part_p"), F.sum("n").alias("part_n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(0))
    # One row per range.
    before = sums.select("part", *(F.coalesce(F.sum(f"part_{c}").over(earlier), F.lit(0.0)).alias(f"before_{c}")
                                   for c in "pn"), *(F.sum(f"part_{c}").over(every).alias(f"all_{c}") for c in "pn"))
    higher = Window.partitionBy("part").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumns({
        f"within_{c}": F.coalesce(F.sum(c).over(higher), F.lit(0.0)) for c in "pn"
    }).join(F.broadcast(before), "part").select(
        "p", "n", *((F.col(f"before_{c}") + F.col(f"within_{c}")).alias(f"higher_{c}") for c in "pn"),
        "all_p", "all_n")


def with_areas(counts: DataFrame, label: str = LABEL) -> DataFrame:
    """One row (auc_roc, auc_pr) of counted scores, both by the trapezoids between all distinct
    scores; without positives both are 0, without negatives both are 1."""
    p, n, tp, fp = (F.col(c) for c in ("p", "n", "higher_p", "higher_n"))
    all_p, all_n = F.max("all_p"), F.max("all_n")
    after = F.try_divide(tp + p, tp + p + fp + n)
    # The curve starts at the precision of the highest score.
    before = F.when(tp + fp > 0, F.try_divide(tp, tp + fp)).otherwise(after)
    below = F.sum(n * (tp + p * 0.5))
    lifted = F.sum(p * (before + after) * 0.5)
    return _prefix_sums(counts, label).agg(
        F.when(F.coalesce(all_p, F.lit(0.0)) == 0, F.lit(0.0)).when(all_n == 0, F.lit(1.0))
        .otherwise(below / (all_p * all_n)).alias("auc_roc"),
        F.coalesce(F.try_divide(lifted, all_p), F.lit(0.0)).alias("auc_pr"))


def areas(counts: DataFrame, label: str = LABEL) -> tuple[float, float]:
    """areaUnderROC and areaUnderPR of counted scores, exact."""
    row = with_areas(written_table(counts, "score-counts"), label).first()
    return row["auc_roc"], row["auc_pr"]


def evaluate(
    predictions: DataFrame, name: str, raw_col: str = "rawPrediction", label: str = LABEL,
    train_seconds: float | None = None, bins: int = CURVE_BINS,
) -> DataFrame:
    """The metrics record of one model as one row.

    The counted scores are written once; areas and confusion counts come from them in one plan.
    With bins the areas are Spark's approximation.
    """
    counts = written_table(score_counts(predictions, raw_col, label), "score-counts")
    cells = with_precision_recall(confusion(counts, label, F.col("weight")))
    if bins:
        both = counts.sparkSession.range(1).select(
            F.lit(area(counts, "areaUnderROC", label, bins)).alias("auc_roc"),
            F.lit(area(counts, "areaUnderPR", label, bins)).alias("auc_pr"))
    else:
        both = with_areas(counts, label)
    row = cells.withColumn("areas", both.select(F.struct("auc_roc", "auc_pr")).scalar()).first()
    record = (
        name, row["areas"]["auc_roc"], row["areas"]["auc_pr"], row["precision"], row["recall"], row["f1"],
        int(row["tp"]), int(row["tn"]), int(row["fp"]), int(row["fn"]), train_seconds)
    return predictions.sparkSession.createDataFrame([record], METRICS_RECORD)


def join_predictions(first: DataFrame, second: DataFrame, key: str = KEY) -> DataFrame:
    """Two tables of predictions, one row per key each, brought together by key."""
    left = first.select(
        key, LABEL, positive_score(first, "probability").alias("rf_prob"))
    right = second.select(key, positive_score(second, "probability").alias("gbt_prob"))
    return left.join(right, on=key, how="inner")


def soft_vote(both: DataFrame) -> DataFrame:
    """Mean of the two probabilities, thresholded, with its probability vector."""
    mean = (F.col("rf_prob") + F.col("gbt_prob")) / 2.0
    return both.withColumn("fraud_probability", mean).withColumns({
        "prediction": threshold_label(F.col("fraud_probability")),
        "probability": probability_vector(F.col("fraud_probability")),
    })


def evaluate_ensemble(both: DataFrame, bins: int = CURVE_BINS) -> DataFrame:
    return evaluate(soft_vote(both), ENSEMBLE_NAME, raw_col="probability", bins=bins)


def compare(*records: DataFrame) -> DataFrame:
    """Metrics records of several models, best first."""
    combined = records[0]
    for record in records[1:]:
        combined = combined.unionByName(record)
    return combined.orderBy(F.desc("auc_pr"), F.desc("f1"), F.asc("model"))


def best_of(comparison: DataFrame, names: tuple[str, ...] = (FOREST_NAME, BOOSTED_NAME)) -> DataFrame:
    """The best ranked among the named models, one row."""
    return comparison.filter(F.col("model").isin(*names)).orderBy(
        F.desc("auc_pr"), F.desc("f1"), F.asc("model")).limit(1)


def metrics_long(comparison: DataFrame) -> DataFrame:
    """One row per model and metric."""
    return comparison.unpivot(["model"], METRICS, "metric", "value")
