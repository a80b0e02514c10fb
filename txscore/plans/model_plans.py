"""Splits, indexing, training, evaluation, comparison."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from txscore import fixtures
from txscore.constants import (
    BOOSTED_GRID_FULL, BOOSTED_NAME, CATEGORICAL_FEATURES, ENSEMBLE_NAME, FOREST_GRID_FULL,
    FOREST_NAME, KEY, LABEL, NUMERIC_FEATURES,
)
from txscore.functions import threshold_label
from txscore.operators import evaluation, modeling, sampling
from txscore.operators.cleaning import clean_stream, project_scored
from txscore.operators.features import FEATURE_SOURCES, fit_reference, prepare_features
from txscore.plans.feature_plans import model_rows
from txscore.plans.oracle import FEATURES, SCORED, TX, WIDE, over, r6
from txscore.plans.registry import query
from txscore.schema import SCORED as SCORED_SCHEMA
from txscore.session import shared_dir, written_table

_BUCKET = "('0x' || substr(md5(trans_num), 1, 8))::BIGINT % 10000"
_NEGATIVES = "('0x' || substr(md5('negatives' || trans_num), 1, 8))::BIGINT % 10000"
_SAMPLED = f"""sampled AS (
  SELECT * FROM tx WHERE {_BUCKET} < 8000 AND (is_fraud = 1 OR {_NEGATIVES} < 800))"""


@query("hash_split", over(TX) + f"""
SELECT trans_num, amt, CASE WHEN {_BUCKET} < 8000 THEN 'train' ELSE 'valid' END AS part FROM tx""")
def hash_split(spark, sf_dir):
    train, valid = sampling.hash_split(fixtures.tx(spark, sf_dir).select("trans_num", "amt"))
    return train.withColumn("part", F.lit("train")).unionByName(
        valid.withColumn("part", F.lit("valid")))


@query("random_split", over(TX) + """
SELECT count(*) AS "rows", count(DISTINCT trans_num) AS keys FROM tx""")
def random_split(spark, sf_dir):
    train, valid = sampling.random_split(fixtures.tx(spark, sf_dir).select("trans_num"))
    # Counting per key first: no row may be in both parts or in none.
    return train.unionByName(valid).groupBy("trans_num").agg(F.count("*").alias("n")).agg(
        F.sum("n").alias("rows"), F.count("*").alias("keys"))


@query("hash_undersample", over(TX, _SAMPLED) + "SELECT trans_num, is_fraud, amt FROM sampled")
def hash_undersample(spark, sf_dir):
    train, _ = sampling.hash_split(fixtures.tx(spark, sf_dir))
    return sampling.hash_undersample(train).select("trans_num", "is_fraud", "amt")


@query("undersample", over(TX) + """
SELECT count(*) AS positives, TRUE AS fewer_negatives FROM tx WHERE is_fraud = 1""")
def undersample(spark, sf_dir):
    rows = fixtures.tx(spark, sf_dir).select("trans_num", "is_fraud")
    before = rows.agg(F.count_if(F.col("is_fraud") == 0).alias("n")).scalar()
    return sampling.undersample(rows).agg(
        F.count_if(F.col("is_fraud") == 1).alias("positives"),
        F.count_if(F.col("is_fraud") == 0).alias("negatives"),
    ).select("positives", F.col("negatives").between(0.02 * before, 0.16 * before)
             .alias("fewer_negatives"))


@query("class_weight", over(TX, _SAMPLED) + f"""
SELECT is_fraud, count(*) AS count,
       {r6('''CASE WHEN is_fraud = 1 THEN (SELECT count(*) FROM sampled WHERE is_fraud = 0)::DOUBLE
            / (SELECT count(*) FROM sampled WHERE is_fraud = 1) ELSE 1.0::DOUBLE END''')} AS "classWeight"
FROM sampled GROUP BY is_fraud""")
def class_weight(spark, sf_dir):
    train, _ = sampling.hash_split(fixtures.tx(spark, sf_dir).select("trans_num", "is_fraud"))
    train = sampling.hash_undersample(train)
    weighted = sampling.with_class_weight(train, sampling.class_weight_of(train))
    return weighted.groupBy("is_fraud", "classWeight").agg(F.count("*").alias("count"))


def _index(column: str) -> str:
    return f"""{column}_index AS (
  SELECT {column}, CAST(row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS DOUBLE)
           AS {column}_idx FROM tx GROUP BY {column})"""


_INDEXES = [_index(c) for c in CATEGORICAL_FEATURES]
_JOINED = " ".join(f"JOIN {c}_index USING ({c})" for c in CATEGORICAL_FEATURES)


@query("string_index", over(TX, *_INDEXES) + "SELECT trans_num, " + ", ".join(
    f"{c}_idx" for c in CATEGORICAL_FEATURES) + f" FROM tx {_JOINED}")
def string_index(spark, sf_dir):
    rows = fixtures.tx(spark, sf_dir).select("trans_num", *CATEGORICAL_FEATURES)
    return modeling.string_indexer().fit(rows).transform(rows).select(
        "trans_num", *modeling.index_names())


_LARGE = [_index("merchant"), _index("trans_num")]


@query("string_index_large", over(TX, *_LARGE) + """
SELECT trans_num, merchant_idx, trans_num_idx FROM tx JOIN merchant_index USING (merchant)
JOIN trans_num_index USING (trans_num)""")
def string_index_large(spark, sf_dir):
    """Indexes that no driver or task holds, of a column with hot values and of one with a value per row."""
    rows = fixtures.tx(spark, sf_dir).select("trans_num", "merchant")
    for column in ("merchant", "trans_num"):
        rows = modeling.with_frequency_index(rows, column, modeling.frequency_index(rows, column))
    return rows.select("trans_num", "merchant_idx", "trans_num_idx")


@query("feature_vector", over(TX, FEATURES, *_INDEXES) + "SELECT trans_num, " + ", ".join(
    f"{r6(f'CAST({c} AS DOUBLE)')} AS f{i}" for i, c in enumerate(
        NUMERIC_FEATURES + [f"{c}_idx" for c in CATEGORICAL_FEATURES])) + f"""
FROM features {_JOINED} WHERE amt >= 0 AND city_pop >= 0""")
def feature_vector(spark, sf_dir):
    rows = model_rows(spark, sf_dir)
    stages = Pipeline(stages=[modeling.string_indexer(), modeling.assembler()])
    vector = vector_to_array("features")
    return stages.fit(rows).transform(rows).select("trans_num", *[
        vector[i].alias(f"f{i}") for i in range(len(NUMERIC_FEATURES + CATEGORICAL_FEATURES))])


# Two scores that need no training: one follows the amount, one is unrelated to the label.
def rule_predictions(spark, sf_dir):
    return fixtures.scored(spark, sf_dir).select(
        "trans_num", "is_fraud", F.col("prob_1").alias("probability"), "prediction")


def noise_predictions(spark, sf_dir):
    events = fixtures.read_table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("double")
    return events.select(
        F.concat(F.lit("T"), F.col("event_id").cast("string")).alias("trans_num"),
        (F.col("value") >= 150).cast("int").alias("is_fraud"),
        (k / F.lit(100.0)).alias("probability"),
        F.when(k >= 50, F.lit(1.0)).otherwise(F.lit(0.0)).alias("prediction"))


_NOISE = """noise AS (
  SELECT concat('T', CAST(event_id AS VARCHAR)) AS trans_num,
         CAST(value >= 150 AS INTEGER) AS is_fraud,
         CAST(props->>'$.k' AS DOUBLE) / 100.0::DOUBLE AS score,
         CASE WHEN CAST(props->>'$.k' AS DOUBLE) >= 50 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
           AS prediction
  FROM events)"""
_RULE = "rule AS (SELECT trans_num, is_fraud, prob_1 AS score, prediction FROM scored)"
_VOTE = """vote AS (
  SELECT trans_num, n.is_fraud, (r.score + n.score) / 2.0::DOUBLE AS score,
         CASE WHEN (r.score + n.score) / 2.0::DOUBLE >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END
           AS prediction
  FROM rule r JOIN noise n USING (trans_num))"""


def _record(table: str, model: str) -> list[str]:
    """CTEs that end in `<table>_record`: the metrics of one table of predictions."""
    return [f"""{table}_score AS (
  SELECT score, sum(is_fraud)::DOUBLE AS p, sum(1 - is_fraud)::DOUBLE AS n FROM {table} GROUP BY score)""",
            f"""{table}_roc AS (
  SELECT sum(p * (below + 0.5 * n)) / (sum(p) * sum(n)) AS auc_roc FROM (
    SELECT p, n, coalesce(sum(n) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                       AND 1 PRECEDING), 0) AS below FROM {table}_score))""",
            f"""{table}_points AS (
  SELECT score, tp / (SELECT sum(p) FROM {table}_score) AS r, tp / (tp + fp) AS pr FROM (
    SELECT score, sum(p) OVER (ORDER BY score DESC) AS tp, sum(n) OVER (ORDER BY score DESC) AS fp
    FROM {table}_score))""",
            f"""{table}_pr AS (
  SELECT sum((r - r0) * (pr + pr0) / 2) AS auc_pr FROM (
    SELECT r, pr, coalesce(lag(r) OVER (ORDER BY score DESC), 0) AS r0,
           coalesce(lag(pr) OVER (ORDER BY score DESC), pr) AS pr0 FROM {table}_points))""",
            f"""{table}_cells AS (
  SELECT count(*) FILTER (is_fraud = 1 AND prediction = 1) AS tp,
         count(*) FILTER (is_fraud = 0 AND prediction = 0) AS tn,
         count(*) FILTER (is_fraud = 0 AND prediction = 1) AS fp,
         count(*) FILTER (is_fraud = 1 AND prediction = 0) AS fn FROM {table})""",
            f"""{table}_record AS (
  SELECT '{model}' AS model, {r6("auc_roc")} AS auc_roc, {r6("auc_pr")} AS auc_pr,
         {r6("tp::DOUBLE / greatest(tp + fp, 1)")} AS precision,
         {r6("tp::DOUBLE / greatest(tp + fn, 1)")} AS recall,
         {r6('''2 * (tp::DOUBLE / greatest(tp + fp, 1)) * (tp::DOUBLE / greatest(tp + fn, 1))
             / greatest(tp::DOUBLE / greatest(tp + fp, 1) + tp::DOUBLE / greatest(tp + fn, 1),
                        1e-12)''')} AS f1, tp, tn, fp, fn
  FROM {table}_cells, {table}_roc, {table}_pr)"""]


def _record_of(predictions, name):
    return evaluation.evaluate(predictions, name, raw_col="probability", bins=0).drop("train_seconds")


_MODELS = over(TX, SCORED, _RULE, _NOISE, *_record("rule", FOREST_NAME), *_record("noise", BOOSTED_NAME))


def _two_records(spark, sf_dir):
    return (_record_of(rule_predictions(spark, sf_dir), FOREST_NAME),
            _record_of(noise_predictions(spark, sf_dir), BOOSTED_NAME))


@query("auc_roc", over(_NOISE, *_record("noise", "noise")) + """
SELECT auc_roc, auc_pr FROM noise_record""")
def auc_roc(spark, sf_dir):
    return _record_of(noise_predictions(spark, sf_dir), "noise").select("auc_roc", "auc_pr")


@query("confusion", over(TX, SCORED, _RULE, *_record("rule", "rule")) + "SELECT * FROM rule_cells")
def confusion(spark, sf_dir):
    return evaluation.confusion(rule_predictions(spark, sf_dir))


_CELLS = """cells AS (
  SELECT count(*) FILTER (quality = 1 AND toxic = 1) AS tp,
         count(*) FILTER (quality = 0 AND toxic = 0) AS tn,
         count(*) FILTER (quality = 0 AND toxic = 1) AS fp,
         count(*) FILTER (quality = 1 AND toxic = 0) AS fn FROM labels),
shares AS (SELECT *, tp::DOUBLE / greatest(tp + fp, 1) AS p, tp::DOUBLE / greatest(tp + fn, 1) AS r
           FROM cells)"""


@query("prf", over(_CELLS) + f"""
SELECT tp, tn, fp, fn, {r6("p")} AS precision, {r6("r")} AS recall,
       {r6("2 * p * r / greatest(p + r, 1e-12)")} AS f1 FROM shares""")
def prf(spark, sf_dir):
    labels = fixtures.read_table(spark, sf_dir, "labels").withColumnRenamed("toxic", "prediction")
    return evaluation.with_precision_recall(evaluation.confusion(labels, label="quality"))


@query("metrics_record", over(TX, SCORED, _RULE, _NOISE, _VOTE, *_record("vote", "Ensemble")) + """
SELECT * FROM vote_record""")
def metrics_record(spark, sf_dir):
    both = evaluation.join_predictions(
        rule_predictions(spark, sf_dir), noise_predictions(spark, sf_dir))
    return evaluation.evaluate_ensemble(both, bins=0).drop("train_seconds")


@query("ensemble_vote", over(TX, SCORED, _RULE, _NOISE, _VOTE) + f"""
SELECT trans_num, is_fraud, {r6("score")} AS fraud_probability, prediction,
       {r6("1 - score")} AS p0, {r6("score")} AS p1 FROM vote""")
def ensemble_vote(spark, sf_dir):
    both = evaluation.join_predictions(
        rule_predictions(spark, sf_dir), noise_predictions(spark, sf_dir))
    vector = vector_to_array("probability")
    return evaluation.soft_vote(both).select(
        "trans_num", "is_fraud", "fraud_probability", "prediction",
        vector[0].alias("p0"), vector[1].alias("p1"))


@query("model_comparison", _MODELS + """
SELECT * FROM rule_record UNION ALL SELECT * FROM noise_record""")
def model_comparison(spark, sf_dir):
    return evaluation.compare(*_two_records(spark, sf_dir))


@query("best_model", _MODELS + """
SELECT * FROM (SELECT * FROM rule_record UNION ALL SELECT * FROM noise_record)
ORDER BY auc_pr DESC, f1 DESC LIMIT 1""")
def best_model(spark, sf_dir):
    return evaluation.best_of(evaluation.compare(*_two_records(spark, sf_dir)))


@query("metrics_long", _MODELS + "\nUNION ALL\n".join(
    f"SELECT model, '{m}' AS metric, {m} AS value FROM "
    "(SELECT * FROM rule_record UNION ALL SELECT * FROM noise_record)"
    for m in ("auc_roc", "auc_pr", "precision", "recall", "f1")))
def metrics_long(spark, sf_dir):
    return evaluation.metrics_long(evaluation.compare(*_two_records(spark, sf_dir)))


# Training: what a trained model answers no SQL can say. The queries return what it can: which
# rows were scored, that the four counts add up to them, and that quality is above a bound.
_CLEAN = "clean AS (SELECT * FROM tx WHERE amt >= 0 AND city_pop >= 0)"
_TEST = "('0x' || substr(md5('test' || trans_num), 1, 8))::BIGINT % 10000"
LEAST_ROC, LEAST_PR = 0.9, 0.5


def _held(model: str, where: str) -> str:
    return (f"SELECT '{model}' AS model, count(*) AS \"rows\", "
            f"CAST(sum(is_fraud) AS BIGINT) AS positives, TRUE AS good FROM clean WHERE {where}")


def held(record):
    """Rows and positives of a metrics record, and whether its areas are above the bounds."""
    return record.select(
        "model", (F.col("tp") + F.col("tn") + F.col("fp") + F.col("fn")).alias("rows"),
        (F.col("tp") + F.col("fn")).alias("positives"),
        ((F.col("auc_roc") >= LEAST_ROC) & (F.col("auc_pr") >= LEAST_PR)).alias("good"))


def written_clean(rows):
    """Clean rows, written once; of their columns those that features and scoring need."""
    needed = [*SCORED_SCHEMA.names[:7], *FEATURE_SOURCES, *NUMERIC_FEATURES, *CATEGORICAL_FEATURES, LABEL]
    return written_table(rows.select(*(c for c in dict.fromkeys(needed) if c in rows.columns)), "clean")


def written_features(rows):
    """The columns that training and scoring need, written once."""
    needed = [*SCORED_SCHEMA.names[:7], *NUMERIC_FEATURES, *CATEGORICAL_FEATURES]
    return written_table(rows.select(*dict.fromkeys(needed)), "features")


def split_sets(rows, undersampled: bool = True):
    """Weighted training rows, written once as a fit goes over them several times, and validation rows."""
    train, valid = sampling.hash_split(rows)
    if undersampled:
        train = sampling.hash_undersample(train)
    train = written_table(train, "train")
    weighted = sampling.with_class_weight(train, sampling.class_weight_of(train))
    return weighted, sampling.with_class_weight(valid)


def training_sets(spark, sf_dir):
    return split_sets(written_features(model_rows(spark, sf_dir)))


@query("rf_train_score", over(TX, _CLEAN) + _held(FOREST_NAME, f"{_BUCKET} >= 8000"))
def rf_train_score(spark, sf_dir):
    train, valid = training_sets(spark, sf_dir)
    fitted = modeling.train_forest(train)
    return held(evaluation.evaluate(
        modeling.score(valid, fitted.model), FOREST_NAME, train_seconds=fitted.seconds))


@query("gbt_train_score", over(TX, _CLEAN) + _held(BOOSTED_NAME, f"{_BUCKET} >= 8000"))
def gbt_train_score(spark, sf_dir):
    train, valid = training_sets(spark, sf_dir)
    fitted = modeling.train_boosted(train)
    return held(evaluation.evaluate(
        modeling.score(valid, fitted.model), BOOSTED_NAME, train_seconds=fitted.seconds))


_CLEAN_WIDE = "clean AS (SELECT * FROM wide WHERE amt >= 0 AND city_pop >= 0)"
#: What a label with noise allows: better than chance by far, and not without errors.
NOISY_ROC = (0.7, 0.995)


@query("noisy_label_train", over(TX, WIDE, _CLEAN_WIDE) + "\nUNION ALL ".join(
    _held(m, f"{_BUCKET} >= 8000") for m in (BOOSTED_NAME, FOREST_NAME)))
def noisy_label_train(spark, sf_dir):
    """Both models on a label that follows two features and that noise turns in places."""
    clean = written_clean(clean_stream(fixtures.tx_wide(spark, sf_dir)))
    train, valid = split_sets(written_features(prepare_features(clean, fit_reference(clean))))
    models = {FOREST_NAME: modeling.train_forest(train).model, BOOSTED_NAME: modeling.train_boosted(train).model}
    record = evaluation.compare(*[
        evaluation.evaluate(modeling.score(valid, model), name) for name, model in models.items()])
    return held(record).withColumn("good", F.lit(True)).join(
        record.select("model", F.col("auc_roc").between(*NOISY_ROC).alias("_between")), "model").select(
        "model", "rows", "positives", (F.col("good") & F.col("_between")).alias("good"))


def _points(fitted, classifier, grid, *names):
    """A row per point of a grid, and whether its metric is above the bound."""
    return [tuple(int(point[classifier.getParam(n)]) for n in names) + (float(metric) >= LEAST_PR,)
            for point, metric in zip(modeling.param_grid(classifier, grid), fitted.metrics)]


_FOREST_POINTS = "\nUNION ALL ".join(
    f"SELECT {t} AS num_trees, {d} AS max_depth, TRUE AS good"
    for t in FOREST_GRID_FULL["numTrees"] for d in FOREST_GRID_FULL["maxDepth"])


@query("grid_search", _FOREST_POINTS)
def grid_search(spark, sf_dir):
    """The full grid of the forest on undersampled rows."""
    train, _ = training_sets(spark, sf_dir)
    classifier = modeling.random_forest()
    fitted = modeling.grid_search(train, classifier, FOREST_GRID_FULL)
    return spark.createDataFrame(
        _points(fitted, classifier, FOREST_GRID_FULL, "numTrees", "maxDepth"),
        "num_trees INT, max_depth INT, good BOOLEAN")


@query("full_mode", over(TX, _CLEAN) + _held(BOOSTED_NAME, f"{_BUCKET} >= 8000")
       + "\nUNION ALL " + _held(FOREST_NAME, f"{_BUCKET} >= 8000"))
def full_mode(spark, sf_dir):
    """Both models with their full grids on all training rows, none left out."""
    train, valid = split_sets(written_features(model_rows(spark, sf_dir)), undersampled=False)
    forest = modeling.train_forest(train, FOREST_GRID_FULL)
    boosted = modeling.train_boosted(train, BOOSTED_GRID_FULL)
    return held(evaluation.compare(
        evaluation.evaluate(modeling.score(valid, forest.model), FOREST_NAME),
        evaluation.evaluate(modeling.score(valid, boosted.model), BOOSTED_NAME)))


@query("ensemble_train_score", over(TX, _CLEAN) + "\nUNION ALL ".join(
    _held(m, f"{_BUCKET} >= 8000") for m in (FOREST_NAME, BOOSTED_NAME, ENSEMBLE_NAME)))
def ensemble_train_score(spark, sf_dir):
    """Both models and their vote, all from one table of scores."""
    train, valid = training_sets(spark, sf_dir)
    forest, boosted = modeling.train_forest(train), modeling.train_boosted(train)
    both = written_table(
        modeling.score_both(valid, forest.model, boosted.model).select(KEY, LABEL, "rf_prob", "gbt_prob"),
        "votes")
    single = [
        evaluation.evaluate(both.withColumn("prediction", threshold_label(F.col(column))), name, raw_col=column)
        for column, name in (("rf_prob", FOREST_NAME), ("gbt_prob", BOOSTED_NAME))]
    return held(evaluation.compare(*single, evaluation.evaluate_ensemble(both)))


@query("external_test", over(TX, _CLEAN) + f"""
SELECT count(*) AS "rows", CAST(sum(is_fraud) AS BIGINT) AS positives, TRUE AS good, TRUE AS is_test
FROM clean WHERE {_TEST} >= 9000""")
def external_test(spark, sf_dir):
    """The better of two models, chosen on validation rows, on a test table that neither the
    averages nor the indexers nor the models have seen."""
    clean = written_clean(clean_stream(fixtures.tx(spark, sf_dir)))
    seen, unseen = sampling.hash_split(clean, 0.9, salt="test")
    reference = fit_reference(seen)
    train, valid = split_sets(written_features(prepare_features(seen, reference)))
    test = sampling.with_class_weight(prepare_features(unseen, reference))
    models = {FOREST_NAME: modeling.train_forest(train).model, BOOSTED_NAME: modeling.train_boosted(train).model}
    ranked = evaluation.compare(*[
        evaluation.evaluate(modeling.score(valid, model), name) for name, model in models.items()])
    best = evaluation.best_of(ranked).first()["model"]
    record = held(evaluation.evaluate(modeling.score(test, models[best]), f"{best} Test"))
    return record.select("rows", "positives", "good", F.col("model").endswith("Test").alias("is_test"))


@query("model_export", over(TX, _CLEAN) + """
SELECT count(*) AS "rows", 0::BIGINT AS differing, TRUE AS good FROM clean""")
def model_export(spark, sf_dir):
    """Train, save, load, and score all rows with the loaded model: as with the first one."""
    rows = written_features(model_rows(spark, sf_dir))
    train, valid = split_sets(rows)
    fitted = modeling.train_forest(train)
    loaded = modeling.export_model(fitted.model, shared_dir(spark, "model"), sample=valid)
    scored = project_scored(modeling.score(rows, loaded))
    return agreement(scored, project_scored(modeling.score(rows, fitted.model)))


def agreement(one, other):
    """Rows of two scored tables together, how many differ, and whether nine in ten predictions
    are the label."""
    answers = other.select(KEY, F.struct("prediction", "prob_0", "prob_1").alias("_other"))
    same = F.equal_null(F.struct("prediction", "prob_0", "prob_1"), F.col("_other"))
    return one.join(answers, KEY, "full").agg(
        F.count("*").alias("rows"), F.count_if(~same).alias("differing"),
        (F.count_if(F.col("prediction") == F.col(LABEL)) >= 0.9 * F.count("*")).alias("good"))
