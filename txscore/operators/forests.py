"""Smaller forests out of a larger one."""

from __future__ import annotations

import json
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from txscore.session import shared_dir

# Executors need not have the package: what tasks run is sent with them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def cut_nodes(tree: pd.DataFrame, depth: int) -> pd.DataFrame:
    """The nodes of one tree that are left down to `depth`, with their new numbers.

    Leaves beside each other that predict the same become one, as in a fit.
    """
    tree = tree.sort_values("id")
    left, right, answer = (tree[c].tolist() for c in ("leftChild", "rightChild", "prediction"))
    level, leaf, kept = [0] * len(left), [x < 0 for x in left], [True] * len(left)
    inner = [k for k in range(len(left)) if left[k] >= 0]
    for k in inner:  # a parent comes before its children
        level[left[k]] = level[right[k]] = level[k] + 1
        leaf[k] = level[k] >= depth
    for k in reversed(inner):
        if leaf[left[k]] and leaf[right[k]] and answer[left[k]] == answer[right[k]]:
            leaf[k] = True
    for k in inner:
        kept[left[k]] = kept[right[k]] = kept[k] and not leaf[k]
    number = np.cumsum(kept) - 1
    return pd.DataFrame({
        "treeID": tree["treeID"].tolist(), "id": range(len(left)), "newId": number,
        "newLeft": [-1 if leaf[k] else number[left[k]] for k in range(len(left))],
        "newRight": [-1 if leaf[k] else number[right[k]] for k in range(len(left))]})[kept]


def cut_forest(model: RandomForestClassificationModel, trees: int, depth: int) -> RandomForestClassificationModel:
    """The first trees of a forest, down to `depth`: a forest of that number and depth.

    Trees are grown apart from each other, and a split depends on what is above it alone. So down to
    its depth a tree is one that a fit of less depth grows, and the first trees of many are drawn as
    those of a smaller forest are, though a fit of fewer trees would draw other rows for each.
    """
    spark = SparkSession.active()
    whole, cut = shared_dir(spark, "forest"), shared_dir(spark, "forest")
    model.write().save(whole)
    facts = json.loads(spark.read.text(f"{whole}/metadata").first()[0])
    facts["numTrees"] = facts["paramMap"]["numTrees"] = trees
    facts["paramMap"]["maxDepth"] = depth
    spark.createDataFrame([(json.dumps(facts),)], "value string").coalesce(1).write.text(f"{cut}/metadata")
    spark.read.parquet(f"{whole}/treesMetadata").filter(F.col("_1") < trees).write.parquet(f"{cut}/treesMetadata")
    nodes = spark.read.parquet(f"{whole}/data").filter(F.col("treeID") < trees)
    split_type = nodes.schema["nodeData"].dataType["split"].dataType.simpleString()
    shape = nodes.select("treeID", "nodeData.id", "nodeData.leftChild", "nodeData.rightChild", "nodeData.prediction")
    kept = shape.groupBy("treeID").applyInPandas(
        lambda tree: cut_nodes(tree, depth), "treeID int, id int, newId int, newLeft int, newRight int")
    leaf = F.col("newLeft") < 0
    no_split = F.struct(F.lit(-1), F.array().cast("array<double>"), F.lit(-1)).cast(split_type)
    nodes.withColumn("id", F.col("nodeData.id")).join(kept, ["treeID", "id"]).select(
        "treeID", F.col("nodeData").withField("id", F.col("newId")).withField("leftChild", F.col("newLeft"))
        .withField("rightChild", F.col("newRight"))
        .withField("gain", F.when(leaf, F.lit(-1.0)).otherwise(F.col("nodeData.gain")))
        .withField("split", F.when(leaf, no_split).otherwise(F.col("nodeData.split"))).alias("nodeData"),
    ).write.parquet(f"{cut}/data")
    return RandomForestClassificationModel.load(cut)
