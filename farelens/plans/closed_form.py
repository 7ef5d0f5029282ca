"""Every model family on an input for which SQL can state the whole answer.

One yes-or-no feature: a tree of depth 1, a forest of one such tree without resampling
and boosting by one such tree all predict the mean (or majority) of the rows on their
side, and so does a linear or logistic fit. Rows are split and dealt to folds by the
same key hash as for the large fits, and the same functions fit, search, reduce, disturb
and measure. Slot names follow from the categories' counts alone.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.ml import evaluate, explain, scenarios
from farelens.ml import train as training
from farelens.ml.features import FeatureSet, feature_pipeline, slot_names
from farelens.functions.keys import fold_of
from farelens.operators.sampling import train_test_split
from farelens.plans.profile import UNIT_HASH
from farelens.plans.sql_views import sql
from farelens.sources import line_charges, trips

KEY = "l_orderkey * 8 + l_linenumber"
SIDE = "tip_amount > 2500"
HIGH = "fare_amount > 50000"
STUMP = {"maxDepth": 1, "seed": 42}
ONE_TREE = {**STUMP, "numTrees": 1, "bootstrap": False, "featureSubsetStrategy": "all"}
BOOSTED = {**STUMP, "maxIter": 1, "stepSize": 1.0}
SETTINGS = {"decision_tree": STUMP, "random_forest": ONE_TREE, "gbt": BOOSTED}


SLOTS = FeatureSet(numeric=("passenger_count", "trip_distance"),
                   one_hot=("VendorID", "store_and_fwd_flag", "payment_type"))


def _sides(spark: SparkSession, folder: str, label: str) -> DataFrame:
    return line_charges(spark, folder).select(
        F.expr(f"CAST({SIDE} AS DOUBLE)").alias("side"), F.expr(f"CAST({label} AS DOUBLE)").alias("label"),
        F.expr(KEY).alias("row_key"))


def _rows(spark: SparkSession, folder: str, label: str) -> tuple[DataFrame, DataFrame]:
    """Train and test rows (side, features, label, row_key, fold)."""
    rows = VectorAssembler(inputCols=["side"], outputCol="features").transform(
        _sides(spark, folder, label))
    return train_test_split(rows.withColumn("fold", fold_of("row_key", 3)), "row_key")


def regressors(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _rows(spark, folder, "total_amount")
    settings = {"linear_regression": {"solver": "normal"}, **SETTINGS}
    for name in training.REGRESSORS:
        model, _ = training.timed_fit(training.regressor(name, **settings[name]), train)
        test = model.setPredictionCol(name).transform(test)
    long = test.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("model"), F.col("label"), F.col(name).alias("prediction"))
        for name in training.REGRESSORS])))
    found = evaluate.regression_metrics(long, by=["model"])
    return found.select("model", *[F.round(c, 2).alias(c) for c in ("rmse", "mae")], F.round("r2", 4).alias("r2"))


def classifiers(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _rows(spark, folder, HIGH)
    settings = {"logistic_regression": {"maxIter": 50}, **SETTINGS}
    parts = []
    for name in training.CLASSIFIERS:
        model, _ = training.timed_fit(training.classifier(name, **settings[name]), train)
        parts.append(training.class_report(model, test, name, 0.0).select(
            "model", "accuracy", "precision", "recall", "f1", "roc_auc", "TP", "TN", "FP", "FN"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def search(spark: SparkSession, folder: str) -> DataFrame:
    """Cross-validated error of a tree without and with a split, and which one wins."""
    train, _ = _rows(spark, folder, "total_amount")
    estimator = training.regressor("decision_tree", **STUMP)
    grid = training.param_grid(estimator, {"maxDepth": [0, 1]})
    found = training.cross_validate(train, estimator, grid, 3)
    rows = [(point["maxDepth"], error, point == found.best_params) for point, error in found.scores]
    return spark.createDataFrame(rows, "depth INT, error DOUBLE, best BOOLEAN").withColumn(
        "error", F.round("error", 2))


def importance(spark: SparkSession, folder: str) -> DataFrame:
    """A feature that says nothing beside one that splits the rows."""
    train, _ = _rows(spark, folder, "total_amount")
    both = VectorAssembler(inputCols=["nothing", "side"], outputCol="pair").transform(
        train.withColumn("nothing", F.lit(1.0))).select(F.col("pair").alias("features"), "label")
    model = training.regressor("decision_tree", **STUMP).fit(both)
    return explain.top_features(explain.importances(spark, ["nothing", "side"], model), 15)


def reductions(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of refits on less training data and of the full fit on moved test rows."""
    data = training.prepare(_sides(spark, folder, HIGH), FeatureSet(numeric=("side",), scaled=False),
                            "label", "row_key").cached()
    try:
        return scenarios.classifier_scenarios(
            data, ("logistic_regression", "decision_tree"), ("side",)).drop("train_seconds")
    finally:
        data.release()


def slots(spark: SparkSession, folder: str) -> DataFrame:
    """The name of every feature slot, in the encoders' order by the training rows."""
    train, _ = train_test_split(trips(spark, folder), "trip_id")
    names = slot_names(feature_pipeline(SLOTS).fit(train).transform(train))
    return spark.createDataFrame(list(enumerate(names)), "slot INT, feature STRING")


QUERIES = {
    "closed_form_regressors": regressors,
    "closed_form_classifiers": classifiers,
    "closed_form_search": search,
    "closed_form_importance": importance,
    "closed_form_scenarios": reductions,
    "feature_slots": slots,
}

# a whole number from -1000 to 1000 for each row
NOISE = f"CAST((((({KEY}) % 2147483648) * 7919 + 104729) % 2147483648 * 48271) % 2001 AS BIGINT) - 1000"
LINES = f"""lines AS (
  SELECT CAST({SIDE} AS DOUBLE) AS side, total_amount AS y, CAST({HIGH} AS DOUBLE) AS high,
    {UNIT_HASH.format(f"({KEY})")} AS u, {NOISE} AS noise,
    CAST(floor({UNIT_HASH.format(f"({KEY})").replace("2654435761", "2246822519")} * 3) AS INTEGER) AS fold
  FROM bills)"""
MEANS = """means AS (SELECT side, AVG(y) AS y_mean, CAST(AVG(high) > 0.5 AS INTEGER) AS guess,
    AVG(high) AS share FROM lines WHERE u < 0.8 GROUP BY side)"""

CONFUSION = """confusion AS (
  SELECT CAST(COUNT(*) FILTER (WHERE high = 1 AND guess = 1) AS DOUBLE) AS tp,
    CAST(COUNT(*) FILTER (WHERE high = 0 AND guess = 0) AS DOUBLE) AS tn,
    CAST(COUNT(*) FILTER (WHERE high = 0 AND guess = 1) AS DOUBLE) AS fp,
    CAST(COUNT(*) FILTER (WHERE high = 1 AND guess = 0) AS DOUBLE) AS fn
  FROM lines JOIN means USING (side) WHERE u >= 0.8)"""
SIDES = """sides AS (
  SELECT CAST(COUNT(*) FILTER (WHERE high = 1 AND share = top) AS DOUBLE) AS p_top,
    CAST(COUNT(*) FILTER (WHERE high = 0 AND share = top) AS DOUBLE) AS n_top,
    CAST(COUNT(*) FILTER (WHERE high = 1 AND share < top) AS DOUBLE) AS p_low,
    CAST(COUNT(*) FILTER (WHERE high = 0 AND share < top) AS DOUBLE) AS n_low
  FROM lines JOIN (SELECT *, MAX(share) OVER () AS top FROM means) USING (side) WHERE u >= 0.8)"""

# Test rows of every scenario: the training share behind each side's guess, and how far noise
# moves a row up or down in the order of the scores.
SCENARIOS = f"""fits AS (
  SELECT scenario, side, AVG(high) AS share, CAST(AVG(high) > 0.5 AS INTEGER) AS guess
  FROM lines, (VALUES ('Original', CAST(1 AS DOUBLE)), ('90% Data', CAST(0.9 AS DOUBLE)),
    ('80% Data', CAST(0.8 AS DOUBLE)), ('Noise Injection', CAST(1 AS DOUBLE))) AS kept(scenario, part)
  WHERE u < CAST(0.8 AS DOUBLE) * part GROUP BY ALL),
tested AS (
  SELECT scenario, model, high, guess, share,
    CASE WHEN scenario = 'Noise Injection' AND model = 'logistic_regression'
      THEN noise * (CASE WHEN rising THEN 1 ELSE -1 END) ELSE 0 END AS shift
  FROM lines JOIN (SELECT *, arg_max(side, share) OVER (PARTITION BY scenario) = 1 AS rising FROM fits) USING (side),
    (SELECT UNNEST(['logistic_regression', 'decision_tree']) AS model)
  WHERE u >= 0.8),
steps AS (
  SELECT scenario, model, share, shift, CAST(SUM(high) AS DOUBLE) AS p, CAST(SUM(1 - high) AS DOUBLE) AS n
  FROM tested GROUP BY ALL),
areas AS (
  SELECT scenario, model, SUM(p * (below + n / 2)) / (SUM(p) * SUM(n)) AS area
  FROM (SELECT *, SUM(n) OVER (PARTITION BY scenario, model ORDER BY share, shift) - n AS below FROM steps)
  GROUP BY ALL),
cells AS (
  SELECT scenario, model, CAST(COUNT(*) FILTER (WHERE high = 1 AND guess = 1) AS DOUBLE) AS tp,
    CAST(COUNT(*) FILTER (WHERE high = 0 AND guess = 0) AS DOUBLE) AS tn,
    CAST(COUNT(*) FILTER (WHERE high = 0 AND guess = 1) AS DOUBLE) AS fp,
    CAST(COUNT(*) FILTER (WHERE high = 1 AND guess = 0) AS DOUBLE) AS fn
  FROM tested GROUP BY ALL)"""
SLOT_COUNTS = "counts AS (" + " UNION ALL ".join(
    f"SELECT {block} AS block, '{c}' AS name, CAST({c} AS VARCHAR) AS value, COUNT(*) AS n FROM trips "
    f"WHERE {UNIT_HASH.format('trip_id')} < 0.8 AND {c} IS NOT NULL GROUP BY ALL"
    for block, c in enumerate(SLOTS.one_hot, len(SLOTS.numeric))) + ")"

ORACLE = {
    "closed_form_regressors": sql("""
        SELECT model, ROUND(SQRT(AVG(e * e)), 2) AS rmse, ROUND(AVG(ABS(e)), 2) AS mae,
          ROUND(1 - AVG(e * e) / VAR_POP(y), 4) AS r2
        FROM (SELECT y, y - y_mean AS e FROM lines JOIN means USING (side) WHERE u >= 0.8),
          (SELECT UNNEST(['linear_regression', 'decision_tree', 'random_forest', 'gbt']) AS model)
        GROUP BY model""", LINES, MEANS),
    "closed_form_classifiers": sql("""
        SELECT model, ROUND((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
          ROUND(((tp + fn) * COALESCE(tp / NULLIF(tp + fp, 0), 0)
                 + (tn + fp) * COALESCE(tn / NULLIF(tn + fn, 0), 0)) / (tp + tn + fp + fn), 6) AS precision,
          ROUND(((tp + fn) * COALESCE(tp / NULLIF(tp + fn, 0), 0)
                 + (tn + fp) * COALESCE(tn / NULLIF(tn + fp, 0), 0)) / (tp + tn + fp + fn), 6) AS recall,
          ROUND(((tp + fn) * 2 * tp / NULLIF(2 * tp + fp + fn, 0)
                 + (tn + fp) * 2 * tn / NULLIF(2 * tn + fp + fn, 0)) / (tp + tn + fp + fn), 6) AS f1,
          ROUND((p_top * n_low + (p_top * n_top + p_low * n_low) / 2)
                / ((p_top + p_low) * (n_top + n_low)), 9) AS roc_auc,
          CAST(tp AS BIGINT) AS TP, CAST(tn AS BIGINT) AS TN, CAST(fp AS BIGINT) AS FP,
          CAST(fn AS BIGINT) AS FN
        FROM confusion, sides,
          (SELECT UNNEST(['logistic_regression', 'decision_tree', 'random_forest', 'gbt']) AS model)""",
        LINES, MEANS, CONFUSION, SIDES),
    "closed_form_search": sql("""
        SELECT depth, ROUND(error, 2) AS error, error = MIN(error) OVER () AS best FROM (
          SELECT depth, AVG(fold_error) AS error FROM (
            SELECT depth, held, SQRT(AVG((y - CASE depth WHEN 0 THEN m0 ELSE m1 END) ** 2)) AS fold_error
            FROM (SELECT l.y, l.fold AS held, a.m AS m0, b.m AS m1 FROM lines l
              JOIN (SELECT f.fold AS held, AVG(y) AS m FROM lines, (SELECT UNNEST([0, 1, 2]) AS fold) f
                    WHERE u < 0.8 AND lines.fold <> f.fold GROUP BY 1) a ON a.held = l.fold
              JOIN (SELECT f.fold AS held, side, AVG(y) AS m FROM lines,
                      (SELECT UNNEST([0, 1, 2]) AS fold) f
                    WHERE u < 0.8 AND lines.fold <> f.fold GROUP BY 1, 2) b
                ON b.held = l.fold AND b.side = l.side
              WHERE l.u < 0.8), (SELECT CAST(UNNEST([0, 1]) AS INTEGER) AS depth)
            GROUP BY depth, held) GROUP BY depth)""", LINES),
    "closed_form_importance": sql("""
        SELECT feature, CAST(CASE feature WHEN 'side' THEN m0 <> m1 ELSE FALSE END AS DOUBLE) AS importance
        FROM (SELECT MIN(y_mean) AS m0, MAX(y_mean) AS m1 FROM means),
          (SELECT UNNEST(['side', 'nothing']) AS feature)""", LINES, MEANS),
    "closed_form_scenarios": sql("""
        SELECT scenario, model, ROUND((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
          ROUND(((tp + fn) * COALESCE(tp / NULLIF(tp + fp, 0), 0)
                 + (tn + fp) * COALESCE(tn / NULLIF(tn + fn, 0), 0)) / (tp + tn + fp + fn), 6) AS precision,
          ROUND(((tp + fn) * COALESCE(tp / NULLIF(tp + fn, 0), 0)
                 + (tn + fp) * COALESCE(tn / NULLIF(tn + fp, 0), 0)) / (tp + tn + fp + fn), 6) AS recall,
          ROUND(((tp + fn) * 2 * tp / NULLIF(2 * tp + fp + fn, 0)
                 + (tn + fp) * 2 * tn / NULLIF(2 * tn + fp + fn, 0)) / (tp + tn + fp + fn), 6) AS f1,
          ROUND(area, 9) AS roc_auc
        FROM cells JOIN areas USING (scenario, model)""", LINES, SCENARIOS),
    "feature_slots": sql(f"""
        SELECT CAST(ROW_NUMBER() OVER (ORDER BY block, n DESC, value) - 1 AS INTEGER) AS slot,
          CASE WHEN value IS NULL THEN name ELSE concat(name, '_vec_', value) END AS feature
        FROM (SELECT * FROM counts UNION ALL SELECT block - 1, name, NULL, 1
              FROM (SELECT UNNEST({list(SLOTS.numeric)}) AS name, UNNEST({list(range(1, len(SLOTS.numeric) + 1))}) AS block))""",
        SLOT_COUNTS),
}
