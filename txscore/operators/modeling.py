"""Feature stages, tree models, grid search, scoring and export."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from itertools import chain

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txscore.constants import (
    BOOSTED_GRID_FAST, CATEGORICAL_FEATURES, FIT_PARALLELISM, FOREST_GRID_FAST, KEY, LABEL,
    MAX_BINS, NUMERIC_FEATURES, SEED, TRAIN_SHARE,
)
from txscore.functions import class_probability
from txscore.operators.boosting import BinnedGBTClassifier
from txscore.operators.evaluation import areas, score_counts
from txscore.operators.features import BROADCAST_BYTES, BROADCAST_ROWS
from txscore.operators.forests import cut_forest
from txscore.operators.sampling import hash_split
from txscore.session import written_table

#: Labels of an index that a task ranks.
LABELS_A_TASK = 500_000
#: Rows that a task of a fit goes over in each pass.
TRAINING_ROWS_A_TASK = 2_000_000


def index_names(columns: Sequence[str] = tuple(CATEGORICAL_FEATURES)) -> list[str]:
    return [f"{name}_idx" for name in columns]


def string_indexer() -> StringIndexer:
    """The four text features by falling frequency; unseen and null get an extra index.

    One stage with four columns counts all of them in one pass.
    """
    return StringIndexer(
        inputCols=CATEGORICAL_FEATURES, outputCols=index_names(), handleInvalid="keep")


def frequency_index(df: DataFrame, column: str) -> DataFrame:
    """(label, index, labels): the values of a column by falling frequency, ties by value, and how
    many there are.

    As the indexer above has it, for columns with more values than a driver or a task should
    hold: the counts are dealt by range of rank, each range is numbered in its own task, and only
    the sizes of the ranges meet.
    """
    label = F.col(column).cast("string")
    counts = written_table(df.filter(F.col(column).isNotNull()).groupBy(label.alias("label")).agg(
        F.count("*").alias("n")), "label-counts")
    parts = max(1, -(-counts.count() // LABELS_A_TASK))
    order = [F.desc("n"), F.asc("label")]
    dealt = written_table(counts.repartitionByRange(parts, *order).withColumn(
        "part", F.spark_partition_id()), "ranked-labels")
    sizes = dealt.groupBy("part").agg(F.count("*").alias("size"))
    # One row per range.
    before = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("before"),
                          F.sum("size").over(Window.partitionBy(F.lit(0))).alias("labels"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    return dealt.withColumn("own", own).join(F.broadcast(before), "part").select(
        "label", (F.col("before") + F.col("own")).cast("double").alias("index"),
        F.col("labels").cast("double").alias("labels"))


def with_frequency_index(df: DataFrame, column: str, index: DataFrame) -> DataFrame:
    """Add `<column>_idx`; null and values that the index has not seen get the number of labels.

    A small index, by rows and bytes, goes to every task; a larger one is joined by a shuffle, in
    which adaptive execution splits hot values.
    """
    index = written_table(index, "index")
    rows, size, labels = index.agg(
        F.count("*"), F.coalesce(F.sum(F.octet_length("label")), F.lit(0)), F.max("labels")).first()
    own = index.select(F.col("label").alias("_label"), F.col("index").alias(f"{column}_idx"))
    if rows <= BROADCAST_ROWS and size <= BROADCAST_BYTES:
        own = F.broadcast(own)
    joined = df.join(own, F.col(column).cast("string") == F.col("_label"), "left").drop("_label")
    return joined.withColumn(f"{column}_idx", F.coalesce(f"{column}_idx", F.lit(float(labels or 0))))


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=NUMERIC_FEATURES + index_names(), outputCol="features")


def random_forest(max_bins: int = MAX_BINS, seed: int = SEED, **params) -> RandomForestClassifier:
    """`max_bins` must exceed the size of the largest category."""
    return RandomForestClassifier(
        labelCol=LABEL, featuresCol="features", weightCol="classWeight", seed=seed,
        maxBins=max_bins, **params)


def boosted_trees(max_bins: int = MAX_BINS, seed: int = SEED, **params) -> GBTClassifier:
    return BinnedGBTClassifier(
        labelCol=LABEL, featuresCol="features", weightCol="classWeight", seed=seed,
        maxBins=max_bins, **params)


def pipeline(classifier) -> Pipeline:
    return Pipeline(stages=[string_indexer(), assembler(), classifier])


def param_grid(classifier, values: Mapping[str, Sequence]) -> list[dict]:
    builder = ParamGridBuilder()
    for name, options in values.items():
        builder = builder.addGrid(classifier.getParam(name), list(options))
    return builder.build()


@dataclass(frozen=True)
class Fitted:
    """The best pipeline of a search, with the metric of every grid point."""

    model: PipelineModel
    metrics: list[float]
    seconds: float


def dealt_for_training(df: DataFrame) -> DataFrame:
    """The rows dealt evenly by hash, in a number of parts that keeps all cores busy, and in order
    within each.

    A fit goes over its rows hundreds of times, and files give it as many tasks, of as many rows, as
    they happen to have row groups. What is drawn for a row follows its place in a part, so the same
    rows in as many parts also give the same model.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    parts = cores * max(1, -(-df.count() // (cores * TRAINING_ROWS_A_TASK)))
    return df.repartition(parts, *df.columns).sortWithinPartitions(*df.columns)


def boosted_prefix(model, trees: int, df: DataFrame) -> DataFrame:
    """`df` scored by the first trees of a boosted model: what a fit of that many answers.

    Boosting adds tree after tree, so a longer fit on the same rows starts with the trees of a
    shorter one.
    """
    margin = F.lit(0.0)
    kept = df.columns
    for k, (tree, weight) in enumerate(zip(model.trees[:trees], model.treeWeights[:trees])):
        df = tree.copy().setFeaturesCol("features").setPredictionCol(f"_tree_{k}").transform(df)
        margin = margin + F.col(f"_tree_{k}") * F.lit(float(weight))
    return df.select(*kept, margin.alias("rawPrediction")).withColumn(
        "prediction", F.when(F.col("rawPrediction") > 0, F.lit(1.0)).otherwise(F.lit(0.0)))


def longest_fits(points: Sequence[dict], classifier) -> list[list[int]]:
    """The numbers of the points, those together that one fit serves: points of a boosted model that
    differ in the number of trees alone, the most trees first."""
    if not isinstance(classifier, GBTClassifier):
        return [[k] for k in range(len(points))]
    trees = [point.get(classifier.maxIter, classifier.getMaxIter()) for point in points]
    together: dict[tuple, list[int]] = {}
    for k, point in enumerate(points):
        rest = tuple(sorted((p.name, v) for p, v in point.items() if p != classifier.maxIter))
        together.setdefault(rest, []).append(k)
    return [sorted(own, key=lambda k: -trees[k]) for own in together.values()]


def largest_fits(points: Sequence[dict], classifier) -> list[list[int]]:
    """As above, and of a forest those points together that differ in the number and depth of the trees
    alone, the largest first. One tree is grown by other rules than several."""
    if not isinstance(classifier, RandomForestClassifier):
        return longest_fits(points, classifier)
    trees = [point.get(classifier.numTrees, classifier.getNumTrees()) for point in points]
    depths = [point.get(classifier.maxDepth, classifier.getMaxDepth()) for point in points]
    together: dict[tuple, list[int]] = {}
    for k, point in enumerate(points):
        rest = tuple(sorted((p.name, v) for p, v in point.items() if p.name not in ("numTrees", "maxDepth")))
        together.setdefault((trees[k] == 1, rest), []).append(k)
    return [sorted(own, key=lambda k: (-trees[k], -depths[k])) for own in together.values()]


def smaller_model(model, point: dict, classifier, df: DataFrame) -> DataFrame:
    """`df` scored by what the fit of a smaller point would be, out of the model of a larger one."""
    if isinstance(classifier, GBTClassifier):
        return boosted_prefix(model, point.get(classifier.maxIter, classifier.getMaxIter()), df)
    return cut_forest(model, point.get(classifier.numTrees, classifier.getNumTrees()),
                      point.get(classifier.maxDepth, classifier.getMaxDepth())).transform(df)


def grid_search(
    train: DataFrame, classifier, grid: Mapping[str, Sequence],
    parallelism: int = FIT_PARALLELISM, seed: int = SEED,
) -> Fitted:
    """Single hold-out search decided by the area under the precision-recall curve.

    Indexers and assembler are fitted once, for all points and the final model, and the rows of
    vectors are dealt evenly and kept for all fits. The hold-out is drawn by key, so metrics do not
    depend on how rows are dealt. Points that differ in the number of boosted trees alone, or in the
    number and depth of a forest's trees, come from one fit. The best point, the first among equals,
    is fitted again on all rows.
    """
    started = time.monotonic()
    needed = [KEY, LABEL, "classWeight", *NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
    train = train.select(*[c for c in needed if c in train.columns])
    stages = Pipeline(stages=[string_indexer(), assembler()]).fit(train)
    rows = stages.transform(dealt_for_training(train)).select(
        KEY, LABEL, "classWeight", "features").persist(StorageLevel.MEMORY_AND_DISK)
    points = param_grid(classifier, grid)
    fitting, held_out = hash_split(rows, TRAIN_SHARE, salt=f"grid-{seed}")

    def metrics_of(own: list[int]) -> list[tuple[int, float]]:
        model = without_summary(classifier.copy(points[own[0]]).fit(fitting))
        found = [(own[0], areas(score_counts(model.transform(held_out)))[1])]
        for k in own[1:]:
            found.append((k, areas(score_counts(smaller_model(model, points[k], classifier, held_out)))[1]))
        return found

    try:
        fits = largest_fits(points, classifier)
        with ThreadPoolExecutor(min(parallelism, len(fits))) as pool:
            by_point = dict(chain.from_iterable(
                pool.map(inheritable_thread_target(train.sparkSession)(metrics_of), fits)))
        metrics = [by_point[k] for k in range(len(points))]
        best = points[metrics.index(max(metrics))]
        model = classifier.copy(best).fit(rows)
    finally:
        rows.unpersist()
    # As an unfitted pipeline's model would be: the fitted stages, then the classifier.
    return Fitted(without_summary(PipelineModel([*stages.stages, model])), metrics, time.monotonic() - started)


def without_summary(model):
    """The same model without its training summary.

    A fresh forest's summary holds the session, and once the session has observed a query
    that cannot be sent to tasks. A copy leaves it out, as does saving and loading.
    """
    return model.copy()


def fit(train: DataFrame, classifier) -> PipelineModel:
    """Indexers, assembler and classifier fitted once, without a search."""
    return without_summary(pipeline(classifier).fit(train))


def train_forest(train: DataFrame, grid: Mapping[str, Sequence] = FOREST_GRID_FAST, **params) -> Fitted:
    return grid_search(train, random_forest(**params), grid)


def train_boosted(train: DataFrame, grid: Mapping[str, Sequence] = BOOSTED_GRID_FAST, **params) -> Fitted:
    return grid_search(train, boosted_trees(**params), grid)


def score(df: DataFrame, model) -> DataFrame:
    return model.transform(df)


def score_both(df: DataFrame, first, second) -> DataFrame:
    """Positive probability of two models side by side without a join.

    Where both score the same rows this replaces the join of their predictions.
    """
    keep = df.columns
    one = first.transform(df).select(
        *keep, class_probability(F.col("probability"), 1).alias("rf_prob"))
    return second.transform(one).select(
        *keep, "rf_prob", class_probability(F.col("probability"), 1).alias("gbt_prob"))


def differing(df: DataFrame, first, second) -> DataFrame:
    """The rows that two models answer differently: both score the same row, so nothing is
    shuffled."""
    keep = df.columns
    answers = [F.col("prediction"), class_probability(F.col("probability"), 1)]
    one = first.transform(df).select(*keep, *(c.alias(f"_first_{k}") for k, c in enumerate(answers)))
    both = second.transform(one)
    return both.filter(~F.equal_null("_first_0", answers[0]) | ~F.equal_null("_first_1", answers[1])).select(*keep)


def export_model(model: PipelineModel, path: str, sample: DataFrame | None = None) -> PipelineModel:
    """Save over `path` and load it back; with a sample, both must predict the same."""
    model.write().overwrite().save(path)
    loaded = PipelineModel.load(path)
    if sample is not None:
        if not differing(sample, model, loaded).isEmpty():
            raise ValueError(f"the model saved to {path} does not predict the same")
    return loaded
