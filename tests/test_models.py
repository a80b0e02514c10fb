import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from txscore.constants import BOOSTED_NAME, FOREST_NAME
from txscore.functions import class_probability
from txscore.operators import evaluation, modeling, sampling
from txscore.operators.profiling import observe_rows
from txscore.sources.readers import load_model


@pytest.fixture(scope="module")
def rows(spark):
    """Feature rows with a label that follows from amount and hour."""
    rng = np.random.default_rng(11)
    n = 3000
    amt, hour = rng.gamma(1.5, 60.0, n), rng.integers(0, 24, n)
    pdf = pd.DataFrame({
        "trans_num": [f"T{i}" for i in range(n)], "amt": amt, "hour": hour,
        "city_pop": rng.integers(100, 10000, n), "age": rng.integers(18, 90, n).astype(float),
        "month": rng.integers(1, 13, n), "day_of_week": rng.integers(1, 8, n),
        "distance": rng.random(n) * 100, "amt_vs_category_avg": amt / 90,
        "merchant": [f"m{i}" for i in rng.integers(0, 40, n)],
        "category": [f"c{i}" for i in rng.integers(0, 5, n)],
        "gender": [("F", "M")[i] for i in rng.integers(0, 2, n)],
        "job": [f"j{i}" for i in rng.integers(0, 9, n)], "is_fraud": ((amt > 150) & (hour >= 12)).astype("int32")})
    return spark.createDataFrame(pdf).repartition(4).cache()


@pytest.fixture(scope="module")
def parts(rows):
    train, valid = sampling.hash_split(rows)
    return sampling.with_class_weight(train, sampling.class_weight_of(train)), valid


@pytest.fixture(scope="module")
def forest(parts):
    return modeling.train_forest(parts[0], {"numTrees": [10], "maxDepth": [5]})


@pytest.fixture(scope="module")
def boosted(parts):
    return modeling.train_boosted(parts[0], {"maxIter": [5], "maxDepth": [3]})


def test_splits_are_disjoint_complete_and_stable(rows):
    train, valid = sampling.hash_split(rows)
    assert train.join(valid, "trans_num").count() == 0
    assert train.unionByName(valid).count() == rows.count()
    assert 0.75 < train.count() / rows.count() < 0.85
    again, _ = sampling.hash_split(rows.repartition(7))
    assert again.select("trans_num").exceptAll(train.select("trans_num")).isEmpty()
    left, right = sampling.random_split(rows)
    assert left.count() + right.count() == rows.count()
    null_key, rest = sampling.hash_split(rows.withColumn("trans_num", F.lit(None).cast("string")))
    assert null_key.count() + rest.count() == rows.count()


@pytest.mark.parametrize("sampler", [sampling.undersample, sampling.hash_undersample])
def test_undersampling_keeps_all_positives(rows, sampler):
    sampled = sampler(rows, 0.08)
    counts = {r["is_fraud"]: r["count"] for r in sampled.groupBy("is_fraud").count().collect()}
    before = {r["is_fraud"]: r["count"] for r in rows.groupBy("is_fraud").count().collect()}
    assert counts[1] == before[1]
    assert 0.04 < counts[0] / before[0] < 0.12


def test_class_weight(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "is_fraud INT")
    assert sampling.class_weight_of(df) == 3.0
    assert sampling.class_weight_of(df.filter("is_fraud = 0")) == 1.0
    weighted = sampling.with_class_weight(df, 3.0)
    assert {(r[0], r[1]) for r in weighted.collect()} == {(0, 1.0), (1, 3.0)}
    assert {r[1] for r in sampling.with_class_weight(df).collect()} == {1.0}


def test_indexer_orders_by_frequency_and_keeps_unseen(spark):
    seen = spark.createDataFrame(
        [("b", "x", "F", "j"), ("b", "x", "F", "j"), ("a", "x", "F", "j")],
        "merchant STRING, category STRING, gender STRING, job STRING")
    new = spark.createDataFrame(
        [("b", "x", "F", "j"), ("a", "x", "F", "j"), ("z", "x", None, "j")], seen.schema)
    got = modeling.string_indexer().fit(seen).transform(new).collect()
    assert [r["merchant_idx"] for r in got] == [0.0, 1.0, 2.0]
    assert got[2]["gender_idx"] == 1.0


def test_forest_learns_and_metrics_agree_with_numpy(parts, forest):
    predictions = modeling.score(parts[1], forest.model)
    record = evaluation.evaluate(predictions, FOREST_NAME, train_seconds=forest.seconds).first()
    assert record["auc_roc"] > 0.95 and record["auc_pr"] > 0.5 and record["train_seconds"] > 0
    pdf = predictions.select(
        "is_fraud", "prediction", class_probability(F.col("rawPrediction"), 1).alias("s")).toPandas()
    assert record["tp"] == ((pdf.is_fraud == 1) & (pdf.prediction == 1)).sum()
    assert record["tp"] + record["tn"] + record["fp"] + record["fn"] == len(pdf)
    ranks = pdf.s.rank()
    p, n = (pdf.is_fraud == 1).sum(), (pdf.is_fraud == 0).sum()
    auc = (ranks[pdf.is_fraud == 1].sum() - p * (p + 1) / 2) / (p * n)
    assert record["auc_roc"] == pytest.approx(auc, abs=1e-9)


def test_metrics_of_counted_scores_equal_those_of_rows(parts, forest):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    predictions = modeling.score(parts[1], forest.model).cache()
    record = evaluation.evaluate(predictions, "x").first()
    for name, metric in (("auc_roc", "areaUnderROC"), ("auc_pr", "areaUnderPR")):
        plain = BinaryClassificationEvaluator(
            labelCol="is_fraud", rawPredictionCol="rawPrediction", metricName=metric)
        assert record[name] == pytest.approx(plain.evaluate(predictions), abs=1e-12)


def test_training_and_scoring_after_an_observed_query(spark, parts):
    counted, seen = observe_rows(spark.range(5), "before")
    counted.collect()
    assert seen.get["rows"] == 5
    grid = {"numTrees": [2], "maxDepth": [2, 3]}
    fitted = modeling.grid_search(parts[0], modeling.random_forest(), grid)
    single = modeling.fit(parts[0], modeling.random_forest(numTrees=2, maxDepth=2))
    for model in (fitted.model, single):
        assert modeling.score(parts[1], model).select("prediction", "probability").collect()


def test_metrics_guards(spark):
    none = spark.createDataFrame([(0, 0.0)], "is_fraud INT, prediction DOUBLE")
    row = evaluation.with_precision_recall(evaluation.confusion(none)).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)
    empty = evaluation.confusion(none.limit(0)).first()
    assert tuple(empty) == (0, 0, 0, 0)


def test_grid_search_picks_the_best_point(parts):
    fitted = modeling.grid_search(
        parts[0], modeling.random_forest(), {"numTrees": [2], "maxDepth": [1, 5]})
    assert len(fitted.metrics) == 2
    best = fitted.model.stages[-1].getOrDefault("maxDepth")
    assert best == (1, 5)[int(np.argmax(fitted.metrics))]


def test_ensemble_with_and_without_a_join(parts, forest, boosted):
    valid = parts[1]
    joined = evaluation.soft_vote(evaluation.join_predictions(
        modeling.score(valid, forest.model), modeling.score(valid, boosted.model)))
    chained = evaluation.soft_vote(modeling.score_both(valid, forest.model, boosted.model))
    columns = ["trans_num", "is_fraud", F.round("fraud_probability", 12).alias("p"), "prediction"]
    a, b = joined.select(*columns), chained.select(*columns)
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert a.count() == valid.count()


def test_comparison_and_external_test(rows, parts, forest, boosted):
    records = [
        evaluation.evaluate(modeling.score(parts[1], forest.model), FOREST_NAME),
        evaluation.evaluate(modeling.score(parts[1], boosted.model), BOOSTED_NAME),
        evaluation.evaluate_ensemble(modeling.score_both(parts[1], forest.model, boosted.model))]
    ranked = evaluation.compare(*records)
    found = ranked.collect()
    assert [r["auc_pr"] for r in found] == sorted((r["auc_pr"] for r in found), reverse=True)
    best = evaluation.best_of(ranked).first()["model"]
    assert best == next(r["model"] for r in found if r["model"] in (FOREST_NAME, BOOSTED_NAME))
    assert evaluation.metrics_long(ranked).count() == 15
    model = {FOREST_NAME: forest, BOOSTED_NAME: boosted}[best].model
    assert evaluation.evaluate(modeling.score(rows, model), f"{best} Test").first()["auc_roc"] > 0.9


def test_export_and_reload(parts, forest, tmp_path):
    path = str(tmp_path / "model")
    modeling.export_model(forest.model, path, sample=parts[1])
    modeling.export_model(forest.model, path)  # over the first
    loaded = load_model(path)
    assert loaded.transform(parts[1]).select("prediction").exceptAll(
        forest.model.transform(parts[1]).select("prediction")).isEmpty()


def test_undersampling_treats_a_null_key_as_the_split_does(spark):
    from txscore.operators.sampling import hash_undersample

    df = spark.createDataFrame([(None, 0)] * 5 + [("T1", 1)], "trans_num string, is_fraud int")
    assert hash_undersample(df, 1.0).count() == 6 and hash_undersample(df, 0.0).count() == 1


def plain_areas(scores):
    """Both areas from every threshold, highest first."""
    p, n = sum(y for _, y in scores), sum(1 - y for _, y in scores)
    roc, pr = [(0.0, 0.0)], []
    for t in sorted({s for s, _ in scores}, reverse=True):
        tp, fp = sum(y for s, y in scores if s >= t), sum(1 - y for s, y in scores if s >= t)
        roc.append((fp / n if n else 0.0, tp / p if p else 0.0))
        pr.append((tp / p if p else 0.0, tp / (tp + fp)))
    roc.append((1.0, 1.0))
    pr.insert(0, (0.0, pr[0][1]))
    return [sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(line, line[1:])) for line in (roc, pr)]


@pytest.mark.parametrize("a_task", [7, 1_000_000])
def test_areas_from_prefix_sums(spark, monkeypatch, a_task):
    monkeypatch.setattr(evaluation, "SCORES_A_TASK", a_task)
    rng = np.random.default_rng(4)
    for digits, share in ((1, 0.3), (6, 0.02), (2, 1.0), (2, 0.0)):
        scores = [(float(round(s, digits)), int(y)) for s, y in zip(rng.random(120), rng.random(120) < share)]
        df = spark.createDataFrame([(y, 0.0, s) for s, y in scores], "is_fraud INT, prediction DOUBLE, p DOUBLE")
        got = evaluation.areas(evaluation.score_counts(df.repartition(3), "p"))
        assert got == pytest.approx(plain_areas(scores), abs=1e-12)
    empty = evaluation.score_counts(df.limit(0), "p")
    assert evaluation.areas(empty) == (0.0, 0.0)


def test_only_sizes_of_ranges_meet(spark, monkeypatch):
    monkeypatch.setattr(evaluation, "SCORES_A_TASK", 10)
    df = spark.range(100).select((F.col("id") % 2).alias("is_fraud"), F.lit(1.0).alias("prediction"),
                                 F.col("id").cast("double").alias("p"))
    sums = evaluation._prefix_sums(evaluation.score_counts(df, "p"), "is_fraud")
    assert sums.count() == 100 and sums.agg(F.max("higher_p"), F.max("all_n")).first()[:] == (50.0, 50.0)
    text = sums._jdf.queryExecution().executedPlan().toString()
    single = [line for line in text.split("\n") if "Exchange SinglePartition" in line]
    assert len(single) <= 2 and "score" in text.split("Sort [part")[1][:40] and "rangepartitioning" not in text


@pytest.mark.parametrize("a_task", [3, 500_000])
def test_frequency_index_is_that_of_the_indexer(spark, monkeypatch, a_task):
    from pyspark.ml.feature import StringIndexer

    monkeypatch.setattr(modeling, "LABELS_A_TASK", a_task)
    values = ["b", "a", "b", None, "c", "a", "", "zz", "é"] + ["hot"] * 20 + [f"v{k}" for k in range(30)]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "n int, v string").repartition(4)
    plain = StringIndexer(inputCol="v", outputCol="i", handleInvalid="keep").fit(df).transform(df)
    index = modeling.frequency_index(df, "v")
    got = modeling.with_frequency_index(df, "v", index)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, plain.collect()), key=lambda r: r[0])
    new = spark.createDataFrame([(1, "unseen"), (2, None), (3, "hot")], df.schema)
    assert [r["v_idx"] for r in modeling.with_frequency_index(new, "v", index).orderBy("n").collect()] == [37.0, 37.0, 0.0]
    monkeypatch.setattr(modeling, "BROADCAST_ROWS", 0)
    shuffled = modeling.with_frequency_index(df, "v", index)
    assert sorted(map(tuple, shuffled.collect())) == sorted(map(tuple, got.collect()))
    none = modeling.frequency_index(df.limit(0), "v")
    assert none.collect() == [] and modeling.with_frequency_index(new, "v", none).first()["v_idx"] == 0.0


def test_search_does_not_depend_on_how_rows_are_dealt(parts):
    grid = {"maxIter": [2], "maxDepth": [1, 3]}
    one = modeling.grid_search(parts[0], modeling.boosted_trees(), grid)
    other = modeling.grid_search(parts[0].repartition(9), modeling.boosted_trees(), grid)
    # Trees choose splits from a sample of rows, so they may differ a little; the hold-out does not.
    assert one.metrics == pytest.approx(other.metrics, abs=0.05)
    labels = [m.model.stages[0].labelsArray for m in (one, other)]
    assert labels[0] == labels[1]
    assert [type(s).__name__ for s in one.model.stages] == [
        "StringIndexerModel", "VectorAssembler", "GBTClassificationModel"]


def test_rows_of_a_fit_are_dealt_evenly_and_always_alike(spark, rows, monkeypatch):
    def dealt(df):
        parts = modeling.dealt_for_training(df).withColumn("part", F.spark_partition_id()).collect()
        return [[r["trans_num"] for r in parts if r["part"] == k] for k in range(max(r["part"] for r in parts) + 1)]

    cores = spark.sparkContext.defaultParallelism
    one = dealt(rows.coalesce(1))
    assert len(one) == cores and max(map(len, one)) < 1.5 * rows.count() / cores
    assert sum(map(len, one)) == rows.count() and one == dealt(rows.repartition(9))
    monkeypatch.setattr(modeling, "TRAINING_ROWS_A_TASK", 200)
    assert len(dealt(rows)) == cores * -(-rows.count() // (cores * 200))


def test_fewer_boosted_trees_come_from_the_fit_of_most(parts, monkeypatch):
    from pyspark.ml.classification import GBTClassifier

    own, fits = GBTClassifier.fit, []
    monkeypatch.setattr(GBTClassifier, "fit", lambda self, df, *a: fits.append(self.getMaxIter()) or own(self, df, *a))
    noisy = parts[0].withColumn("is_fraud", F.when(F.crc32("trans_num") % 5 == 0, 1).otherwise(F.col("is_fraud")))
    found = modeling.grid_search(noisy, modeling.boosted_trees(), {"maxIter": [1, 4], "maxDepth": [2]})
    assert fits == [4, found.model.stages[-1].getNumTrees]
    each = [modeling.grid_search(noisy, modeling.boosted_trees(), {"maxIter": [n], "maxDepth": [2]}).metrics[0]
            for n in (1, 4)]
    assert found.metrics == pytest.approx(each, abs=1e-12) and len(set(each)) == 2
    assert modeling.longest_fits([{}, {}], modeling.random_forest()) == [[0], [1]]


def test_first_trees_answer_as_a_shorter_fit(parts):
    classifier = modeling.boosted_trees()
    df = modeling.Pipeline(stages=[modeling.string_indexer(), modeling.assembler()]).fit(parts[0]).transform(parts[0])
    short, long = (classifier.copy({classifier.maxIter: n, classifier.maxDepth: 3}).fit(df) for n in (2, 5))
    plain = evaluation.score_counts(short.transform(df))
    assert sorted(plain.collect()) == sorted(evaluation.score_counts(modeling.boosted_prefix(long, 2, df)).collect())


def test_training_rows_are_written_once(spark):
    from txscore.plans.model_plans import split_sets, written_clean

    rows = spark.range(400).selectExpr("concat('T', id) AS trans_num", "CAST(id % 4 = 0 AS INT) AS is_fraud",
                                       "id * 1.0D AS amt", "'x' AS street")
    train, valid = split_sets(written_clean(rows))
    assert train.inputFiles() and all("/train-" in x for x in train.inputFiles())
    assert "md5" not in train._jdf.queryExecution().optimizedPlan().toString()
    assert "street" not in train.columns
    assert train.intersect(valid.select(train.columns)).isEmpty()
    kept, _ = split_sets(rows, undersampled=False)
    assert kept.count() + valid.count() == 400 and train.count() < kept.count()


@pytest.fixture(scope="module")
def vectors(parts):
    """Vectors in the order of a fit, with a label that no feature tells for certain: among rows that are all
    alike, rounding decides whether a split has a gain."""
    noisy = parts[0].withColumn("is_fraud", F.when(F.crc32("trans_num") % 5 == 0, 1 - F.col("is_fraud")).otherwise(F.col("is_fraud")))
    stages = modeling.Pipeline(stages=[modeling.string_indexer(), modeling.assembler()]).fit(noisy)
    return stages.transform(modeling.dealt_for_training(noisy)).select(
        "trans_num", "is_fraud", "classWeight", "features").cache()


def answers(model, df):
    return sorted(map(tuple, model.transform(df).select("trans_num", "rawPrediction", "prediction").collect()))


def test_a_cut_forest_is_that_of_less_depth(vectors, tmp_path):
    classifier = modeling.random_forest(numTrees=5)
    deep, flat = (modeling.without_summary(classifier.copy({classifier.maxDepth: d}).fit(vectors)) for d in (7, 3))
    cut = modeling.cut_forest(deep, 5, 3)
    assert cut.toDebugString.split("\n")[1:] == flat.toDebugString.split("\n")[1:]
    assert answers(cut, vectors) == answers(flat, vectors) != answers(deep, vectors)
    assert (cut.getNumTrees, cut.getOrDefault("maxDepth")) == (5, 3)
    fewer = modeling.cut_forest(deep, 2, 7)
    assert [t.toDebugString.split("\n")[1:] for t in fewer.trees] == [
        t.toDebugString.split("\n")[1:] for t in deep.trees[:2]]
    assert modeling.cut_forest(deep, 5, 0).totalNumNodes == 5
    modeling.export_model(modeling.PipelineModel([cut]), str(tmp_path / "cut"), sample=vectors)


def test_one_forest_serves_the_points_of_less_depth_and_fewer_trees(parts, monkeypatch):
    from pyspark.ml.classification import RandomForestClassifier

    own, fits = RandomForestClassifier.fit, []
    monkeypatch.setattr(RandomForestClassifier, "fit", lambda self, df, *a: fits.append(
        (self.getNumTrees(), self.getMaxDepth())) or own(self, df, *a))
    noisy = parts[0].withColumn("is_fraud", F.when(F.crc32("trans_num") % 5 == 0, 1).otherwise(F.col("is_fraud")))
    found = modeling.grid_search(noisy, modeling.random_forest(), {"numTrees": [3, 6], "maxDepth": [1, 5]})
    best = found.model.stages[-1]
    assert fits == [(6, 5), (best.getNumTrees, best.getOrDefault("maxDepth"))] and len(set(found.metrics)) == 4
    # Depth alone leaves every draw as it was.
    alone = modeling.grid_search(noisy, modeling.random_forest(), {"numTrees": [6], "maxDepth": [1]})
    assert found.metrics[2] == pytest.approx(alone.metrics[0], abs=1e-12)
    classifier = modeling.random_forest()
    points = modeling.param_grid(classifier, {"numTrees": [1, 2], "maxDepth": [3, 4], "maxBins": [64, 128]})
    groups = modeling.largest_fits(points, classifier)
    assert sorted(k for own in groups for k in own) == list(range(8)) and len(groups) == 4
    assert all(points[own[0]][classifier.maxDepth] == 4 for own in groups)


def test_boosted_trees_are_those_of_sparks_own_fit(vectors, tmp_path):
    from pyspark.ml.classification import GBTClassifier

    params = {"labelCol": "is_fraud", "weightCol": "classWeight", "seed": 42, "maxIter": 4, "maxDepth": 4}
    # In a node of few rows, splits of equal gain are decided by the last digit, which follows the order of sums.
    params |= {"minInstancesPerNode": 30}
    for more in ({"maxBins": 1024}, {"maxBins": 64, "minWeightFractionPerNode": 0.02, "minInfoGain": 0.01},
                 {"maxBins": 64, "maxMemoryInMB": 0}):
        plain, binned = (c(**params, **more).fit(vectors) for c in (GBTClassifier, modeling.BinnedGBTClassifier))
        shape = [[line.split("Predict")[0] for line in m.toDebugString.split("\n")[1:]] for m in (plain, binned)]
        assert shape[0] == shape[1] and plain.treeWeights == binned.treeWeights
        one, other = answers(plain, vectors), answers(binned, vectors)
        for a, b in zip(one, other):
            assert a[0] == b[0] and a[2] == b[2] and a[1][1] == pytest.approx(b[1][1], abs=1e-9)
        assert plain.featureImportances.toArray() == pytest.approx(binned.featureImportances.toArray(), abs=1e-9)
        assert {p.name: v for p, v in plain.extractParamMap().items()} == {
            p.name: v for p, v in binned.extractParamMap().items()}
    modeling.export_model(modeling.PipelineModel([binned]), str(tmp_path / "boosted"), sample=vectors)


def test_boosted_trees_in_many_parts_and_chunks(vectors, monkeypatch):
    from txscore.operators import boosting

    classifier = modeling.boosted_trees(maxIter=3, maxDepth=3)
    one = classifier.fit(vectors)
    monkeypatch.setattr(boosting, "CHUNK_ROWS", 100)
    monkeypatch.setattr(boosting, "COUNT_BYTES", 0)
    other = classifier.fit(vectors)
    assert one.toDebugString.count("If") == other.toDebugString.count("If")
    for a, b in zip(answers(one, vectors), answers(other, vectors)):
        assert a[1][1] == pytest.approx(b[1][1], abs=1e-9)


def test_rows_alike_are_not_split(vectors, monkeypatch):
    from txscore.operators import boosting

    own, nodes = boosting.count_bins, []
    monkeypatch.setattr(boosting, "count_bins", lambda *a: nodes.append(a[4].tolist()) or own(*a))
    told = vectors.withColumn("is_fraud", (vector_to_array("features")[0] > 100).cast("int"))
    model = modeling.boosted_trees(maxIter=4, maxDepth=3).fit(told.withColumn("classWeight", F.lit(0.1)))
    assert nodes == [[1]] * 4 and model.totalNumNodes == 12


def test_boosted_fit_leaves_to_spark_what_it_does_not_do(vectors, monkeypatch):
    from txscore.operators import boosting

    monkeypatch.setattr(modeling.BinnedGBTClassifier, "_boosted", lambda *a: pytest.fail("binned"))
    small = {"maxIter": 1, "maxDepth": 1}
    zero = vectors.withColumn("classWeight", F.when(F.col("is_fraud") == 1, 0.0).otherwise(1.0))
    assert modeling.boosted_trees(**small).fit(zero).getNumTrees == 1
    assert modeling.boosted_trees(subsamplingRate=0.5, **small).fit(vectors).getNumTrees == 1
    with pytest.raises(Exception, match="maxBins"):
        modeling.boosted_trees(max_bins=16, **small).fit(vectors)
    with pytest.raises(Exception, match="(?i)label"):
        modeling.boosted_trees(**small).fit(vectors.withColumn("is_fraud", F.lit(3)))
    assert boosting.categories_of(vectors.select(F.col("features").alias("f", metadata={})), "f") is None


def test_thresholds_split_the_weight_evenly():
    from txscore.operators.boosting import thresholds_of

    few = thresholds_of(np.array([1.0, 2.0, 4.0]), np.ones(3), 5)
    assert few.tolist() == [1.5, 3.0] and thresholds_of(np.array([7.0]), np.ones(1), 5).tolist() == []
    many = thresholds_of(np.arange(1000.0), np.ones(1000), 9)
    assert len(many) == 9 and max(np.diff(many)) <= 101
    heavy = thresholds_of(np.arange(100.0), np.r_[np.ones(99), 1000.0], 3)
    assert heavy.tolist() == [98.5]
