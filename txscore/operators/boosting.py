"""Spark's boosted trees, grown over rows of bins.

Spark's own fit keeps an object per row and goes through it value by value. Here a row is two bytes
per feature, rows lie together in chunks, and a task counts a chunk column by column. Bins, gains,
leaves and weights of trees are those of Spark's classifier, and the model is Spark's.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Executors need not have the package: what tasks run is sent with them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows in a chunk.
CHUNK_ROWS = 1 << 16
#: Bytes of counts that a task makes at once, and that the driver gets unadded.
COUNT_BYTES = 64 << 20
#: Bins have two bytes.
MOST_BINS = 1 << 16
#: Rows, weight, sum and sum of squares of a bin.
STATS = 4
EPSILON = float(np.finfo(float).eps)
#: Variance as a share of the mean square, below which sums over millions of rows cannot tell it from none.
ALIKE = 1e-12


@dataclass(frozen=True)
class Bins:
    """Thresholds of each feature, or the number of its categories."""

    thresholds: list[np.ndarray]
    categories: list[int]

    @property
    def sizes(self) -> list[int]:
        return [c or len(t) + 1 for t, c in zip(self.thresholds, self.categories)]

    @property
    def starts(self) -> np.ndarray:
        return np.concatenate([[0], np.cumsum(self.sizes)])


@dataclass
class Tree:
    """Nodes numbered as in a heap from 1 on: the split of those that have one, and all their figures."""

    feature: np.ndarray
    left: np.ndarray  # of each node and bin
    stats: np.ndarray
    gain: np.ndarray

    @classmethod
    def of(cls, depth: int, width: int) -> Tree:
        n = 1 << (depth + 1)
        return cls(np.full(n, -1, np.int16), np.zeros((n, width), bool), np.zeros((n, STATS)), np.zeros(n))

    @property
    def predictions(self) -> np.ndarray:
        return np.divide(self.stats[:, 2], self.stats[:, 1], out=np.zeros(len(self.stats)), where=self.stats[:, 1] > 0)

    def leaves(self, bins: np.ndarray, depth: int) -> np.ndarray:
        """The node in which each row is after `depth` levels."""
        rows, width = bins.shape[1], self.left.shape[1]
        node, split = np.ones(rows, np.int64), self.feature >= 0
        following = np.arange(len(split), dtype=np.int32)[:, None] + np.zeros(width, np.int32)
        inner = np.flatnonzero(split)
        following[inner] = 2 * inner[:, None] + 1 - self.left[inner]
        following, each = following.ravel(), bins.ravel()
        start = np.where(split, self.feature, 0).astype(np.int64) * rows
        for level in range(depth):
            if not split[1 << level:2 << level].any():
                break
            at = start.take(node)
            at += np.arange(rows)
            node *= width
            node += each.take(at)
            node = following.take(node).astype(np.int64)
        return node


def thresholds_of(values: np.ndarray, weights: np.ndarray, splits: int) -> np.ndarray:
    """Thresholds between distinct values in order: all, or about `splits` with as much weight between each."""
    middles = (values[:-1] + values[1:]) / 2.0
    if len(middles) <= splits:
        return middles
    stride = weights.sum() / (splits + 1)
    upto = np.cumsum(weights).tolist()
    kept, target = [], stride
    for k in range(1, len(upto)):
        if abs(upto[k - 1] - target) < abs(upto[k] - target):
            kept.append(k - 1)
            target += stride
    return middles[kept]


def find_thresholds(df: DataFrame, continuous: list[int], rows: int, most_bins: int, seed: int) -> dict[int, np.ndarray]:
    """Thresholds of the continuous features from as many rows as Spark takes for that."""
    needed = max(most_bins * most_bins, 10_000)
    sampled = df if rows <= needed else df.sample(False, needed / rows, seed)
    splits = min(most_bins, rows) - 1

    def of_feature(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("value")
        found = thresholds_of(pdf["value"].to_numpy(), pdf["weight"].to_numpy(), splits)
        return pd.DataFrame({"feature": pdf["feature"].iloc[:1], "thresholds": [found.tolist()]})

    each = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col("features")[f].alias("value"))
                               for f in continuous]))
    counted = sampled.select("weight", each.alias("_each")).select("weight", "_each.*").groupBy(
        "feature", "value").agg(F.sum("weight").alias("weight"))
    found = counted.groupBy("feature").applyInPandas(of_feature, "feature int, thresholds array<double>").collect()
    return {r["feature"]: np.array(r["thresholds"], float) for r in found}


def chunks_of(df: DataFrame, bins: Bins) -> RDD:
    """(bins, signs of the label, weights, margins) of many rows at once."""
    features = len(bins.categories)

    def chunk(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        flat = pa.concat_arrays([c.flatten() for c in table.column("features").chunks]).to_numpy(zero_copy_only=False)
        values = flat.reshape(-1, features)
        if not np.isfinite(values).all():
            raise ValueError("features must not be NaN or infinite")
        out = np.empty((features, len(values)), np.uint16)
        for f, (thresholds, categories) in enumerate(zip(bins.thresholds, bins.categories)):
            own = np.ascontiguousarray(values[:, f])
            out[f] = own if categories else np.searchsorted(thresholds, own, side="left")
        sign = table.column("label").to_numpy() * 2.0 - 1.0
        weight = table.column("weight").to_numpy()
        return pa.RecordBatch.from_pydict({
            "rows": [len(values)], "bins": [out.tobytes()], "sign": [sign.astype(np.int8).tobytes()],
            "weight": [weight.tobytes()]})

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= CHUNK_ROWS:
                yield chunk(held)
                held, rows = [], 0
        if rows:
            yield chunk(held)

    def arrays(row):
        return (np.frombuffer(row["bins"], np.uint16).reshape(features, row["rows"]),
                np.frombuffer(row["sign"], np.int8), np.frombuffer(row["weight"], float), np.zeros(row["rows"]))

    return df.mapInArrow(work, "rows bigint, bins binary, sign binary, weight binary").rdd.map(arrays)


def add_tree(chunks: RDD, tree: Tree, depth: int, weight: float) -> RDD:
    """The chunks with the margins after one more tree."""
    values = tree.predictions * weight

    def added(chunk):
        bins, sign, own, margin = chunk
        return bins, sign, own, margin + values[tree.leaves(bins, depth)]

    return chunks.map(added)


def count_bins(chunks: RDD, bins: Bins, tree: Tree, level: int, nodes: np.ndarray, first: bool) -> np.ndarray:
    """STATS of each of the nodes, which are of one level, and each bin of all features.

    What the trees follow is the label's sign at first, then the negative gradient of the loss.
    """
    sizes, starts = bins.sizes, bins.starts
    slot_of = np.full(len(tree.feature), -1, np.int64)
    slot_of[nodes] = np.arange(len(nodes))

    def counted(part: Iterator) -> Iterator[np.ndarray]:
        found = np.zeros((STATS, len(nodes), starts[-1]))
        for own, sign, weight, margin in part:
            slot = slot_of[tree.leaves(own, level)]
            if (slot < 0).any():
                kept = np.flatnonzero(slot >= 0)
                own, slot, sign, weight, margin = own[:, kept], slot[kept], sign[kept], weight[kept], margin[kept]
            target = sign.astype(float)
            if not first:
                with np.errstate(over="ignore"):
                    target = 4.0 * target / (1.0 + np.exp(2.0 * target * margin))
            weighted = weight * target
            squares = weighted * target
            for f, size in enumerate(sizes):
                at = slot * size
                at += own[f]
                for k, each in enumerate((None, weight, weighted, squares)):
                    found[k, :, starts[f]:starts[f + 1]] += np.bincount(
                        at, each, len(nodes) * size).reshape(len(nodes), size)
        yield found

    each = chunks.mapPartitions(counted)
    if each.getNumPartitions() * STATS * len(nodes) * int(starts[-1]) * 8 > COUNT_BYTES:
        return each.treeReduce(np.add)
    return sum(each.collect())


def impurity(stats: np.ndarray) -> np.ndarray:
    """The variance of weight, sum and sum of squares."""
    with np.errstate(invalid="ignore", divide="ignore"):
        return (stats[3] - stats[2] * stats[2] / stats[1]) / stats[1]


def best_splits(counts: np.ndarray, bins: Bins, least_rows: int, least_weight: float, least_gain: float):
    """(gain, feature, bins that go left, figures of the left, of the right) of each node; a gain of
    -inf where no split is valid. The first among equals wins."""
    n, width = counts.shape[1], max(bins.sizes)
    starts, nodes = bins.starts, np.arange(counts.shape[1])
    own = counts[:, :, starts[0]:starts[1]].sum(axis=2)
    before = impurity(own)
    best, feature = np.full(n, -np.inf), np.full(n, -1)
    left, sides = np.zeros((n, width), bool), np.zeros((2, STATS, n))
    for f, (size, categories) in enumerate(zip(bins.sizes, bins.categories)):
        if size < 2:
            continue
        each = counts[:, :, starts[f]:starts[f + 1]]
        order = np.broadcast_to(np.arange(size), (n, size))
        if categories:
            # Categories in order of their means, those without rows last.
            means = np.divide(each[2], each[1], out=np.full((n, size), np.finfo(float).max), where=each[0] > 0)
            order = np.argsort(means, axis=1, kind="stable")
            each = np.take_along_axis(each, order[None], axis=2)
        upto = np.cumsum(each, axis=2)
        low, high = upto[:, :, :-1], upto[:, :, -1:] - upto[:, :, :-1]
        weight = np.maximum(low[1] + high[1], np.finfo(float).tiny)
        with np.errstate(invalid="ignore"):
            gain = before[:, None] - low[1] / weight * impurity(low) - high[1] / weight * impurity(high)
            valid = ((low[0] >= least_rows) & (high[0] >= least_rows) & (low[1] >= least_weight)
                     & (high[1] >= least_weight) & (gain >= least_gain))
        gain = np.where(valid, gain, -np.inf)
        at = gain.argmax(axis=1)
        better = gain[nodes, at] > best
        best = np.where(better, gain[nodes, at], best)
        feature = np.where(better, f, feature)
        sides[0][:, better], sides[1][:, better] = low[:, nodes, at][:, better], high[:, nodes, at][:, better]
        for k in np.flatnonzero(better):
            left[k] = False
            left[k, order[k, :at[k] + 1]] = True
    return own, best, feature, left, sides


def grow_tree(chunks: RDD, bins: Bins, depth: int, first: bool, settings: dict) -> Tree:
    """One tree, level by level, as many nodes at once as memory is granted for."""
    tree = Tree.of(depth, max(bins.sizes))
    at_once = max(1, int(min(settings["memory"], COUNT_BYTES) // (bins.starts[-1] * STATS * 8)))
    nodes = np.array([1])
    for level in range(depth):
        following = []
        for start in range(0, len(nodes), at_once):
            some = nodes[start:start + at_once]
            counts = count_bins(chunks, bins, tree, level, some, first)
            own, gain, feature, left, sides = best_splits(
                counts, bins, settings["least_rows"], settings["least_weight"], settings["least_gain"])
            tree.stats[some] = own.T
            for k in np.flatnonzero(gain > 0):
                node = int(some[k])
                tree.feature[node], tree.left[node], tree.gain[node] = feature[k], left[k], gain[k]
                for child, side in ((2 * node, sides[0][:, k]), (2 * node + 1, sides[1][:, k])):
                    tree.stats[child] = side
                    # Less variance than rounding leaves is none: the rows are alike.
                    if impurity(side) > max(EPSILON, ALIKE * side[3] / side[1]):
                        following.append(child)
        nodes = np.array(following)
        if not len(nodes):
            break
    return tree


def root_of(jvm, gateway, tree: Tree, bins: Bins):
    """The tree as Spark's nodes; leaves beside each other that answer alike are one."""
    nodes = jvm.org.apache.spark.ml.tree
    predictions = tree.predictions

    def doubles(values):
        out = gateway.new_array(jvm.double, len(values))
        for k, value in enumerate(values):
            out[k] = float(value)
        return out

    def built(k: int):
        stats = tree.stats[k]
        figures = jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(doubles(stats[1:]), int(stats[0]))
        facts = float(predictions[k]), float(impurity(stats))
        if tree.feature[k] >= 0:
            (one, one_leaf), (other, other_leaf) = built(2 * k), built(2 * k + 1)
            if not (one_leaf and other_leaf and predictions[2 * k] == predictions[2 * k + 1]):
                f = int(tree.feature[k])
                goes_left = np.flatnonzero(tree.left[k])
                split = (nodes.CategoricalSplit(f, doubles(goes_left), bins.categories[f]) if bins.categories[f]
                         else nodes.ContinuousSplit(f, float(bins.thresholds[f][goes_left[-1]])))
                return nodes.InternalNode(*facts, float(tree.gain[k]), one, other, split, figures), False
        return nodes.LeafNode(*facts, figures), True

    return built(1)[0]


def categories_of(df: DataFrame, column: str) -> list[int] | None:
    """The number of categories of each feature, 0 for a continuous one, as the assembler has noted them."""
    noted = df.schema[column].metadata.get("ml_attr", {})
    if "attrs" not in noted:
        return None
    found = [0] * noted["num_attrs"]
    for kind, attributes in noted["attrs"].items():
        for attribute in attributes:
            n = len(attribute.get("vals", ())) or attribute.get("num_vals", 0)
            if kind == "nominal" and not n:
                return None
            found[attribute["idx"]] = n if kind == "nominal" else 2 if kind == "binary" else 0
    # One category alone is as good as a number.
    return [0 if n == 1 else n for n in found]


class BinnedGBTClassifier(GBTClassifier):
    """Spark's boosted trees with a fit that keeps bins instead of objects.

    What it does not do (samples of rows or features, validation rows, no levels, weights of zero, labels
    or features it cannot read) Spark's own fit does, or refuses.
    """

    def _fit(self, dataset):
        categories = categories_of(dataset, self.getFeaturesCol())
        plain = (self.getSubsamplingRate() == 1.0 and self.getFeatureSubsetStrategy() in ("auto", "all")
                 and not self.isDefined("validationIndicatorCol") and self.getMaxDepth() > 0
                 and not self.isDefined("thresholds") and not self.getLeafCol() and self.getMaxBins() <= MOST_BINS)
        if categories and plain:
            weight = F.col(self.getWeightCol()) if self.isDefined("weightCol") and self.getWeightCol() else F.lit(1.0)
            rows = dataset.select(
                F.col(self.getLabelCol()).cast("double").alias("label"), weight.cast("double").alias("weight"),
                vector_to_array(F.col(self.getFeaturesCol())).alias("features"))
            known = F.col("label").isin(0.0, 1.0) & (F.col("weight") > 0) & (F.col("weight") < float("inf")) & F.col("features").isNotNull()
            n, fit, total = rows.agg(F.count("*"), F.count_if(known), F.sum("weight")).first()
            if n and n == fit and max(categories) <= min(n, self.getMaxBins()):
                return self._boosted(rows, categories, n, total)
        return super()._fit(dataset)

    def _boosted(self, rows: DataFrame, categories: list[int], n: int, total: float):
        continuous = [f for f, c in enumerate(categories) if not c]
        found = find_thresholds(rows, continuous, n, self.getMaxBins(), self.getSeed()) if continuous else {}
        bins = Bins([found.get(f, np.zeros(0)) for f in range(len(categories))], categories)
        depth = self.getMaxDepth()
        settings = {
            "memory": self.getMaxMemoryInMB() << 20, "least_rows": self.getMinInstancesPerNode(),
            "least_weight": self.getMinWeightFractionPerNode() * total, "least_gain": self.getMinInfoGain()}
        weights = [1.0] + [self.getStepSize()] * (self.getMaxIter() - 1)
        trees: list[Tree] = []
        chunks = chunks_of(rows, bins).persist(StorageLevel.MEMORY_AND_DISK)
        kept = [chunks]
        try:
            for weight in weights:
                tree = grow_tree(chunks, bins, depth, not trees, settings)
                trees.append(tree)
                if len(kept) > 1:  # the first pass of this tree has made the chunks anew
                    kept.pop(0).unpersist()
                chunks = add_tree(chunks, tree, depth, weight).persist(StorageLevel.MEMORY_AND_DISK)
                kept.append(chunks)
        finally:
            for each in kept:
                each.unpersist()
        return self._model_of(rows, trees, weights, bins)

    def _model_of(self, rows: DataFrame, trees: list[Tree], weights: list[float], bins: Bins):
        context = rows.sparkSession.sparkContext
        jvm, gateway = context._jvm, context._gateway
        models = jvm.org.apache.spark.ml
        features = len(bins.categories)
        of_trees = gateway.new_array(models.regression.DecisionTreeRegressionModel, len(trees))
        of_weights = gateway.new_array(jvm.double, len(trees))
        for k, (tree, weight) in enumerate(zip(trees, weights)):
            of_trees[k] = models.regression.DecisionTreeRegressionModel(
                f"{self.uid}_{k}", root_of(jvm, gateway, tree, bins), features)
            of_weights[k] = weight
        self._transfer_params_to_java()
        model = models.classification.GBTClassificationModel(self.uid, of_trees, of_weights, features, 2)
        self._java_obj.copyValues(model, models.param.ParamMap.empty())
        model.setParent(self._java_obj)
        return self._copyValues(self._create_model(model))
