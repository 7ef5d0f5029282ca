"""Model metrics on formula scores, where every number can be checked by SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.ml import evaluate
from farelens.ml.stability import predictions_long
from farelens.operators import ranking
from farelens.operators.quantiles import median
from farelens.plans.features import CATEGORY_SQL
from farelens.plans.sql_views import sql
from farelens.sources import line_charges, trips

# rivals: four price formulas standing for four models of the total amount
RIVALS = {
    "flat": "fare_amount",
    "average_terms": "fare_amount * 0.988",
    "tip_aware": "fare_amount - tip_amount",
    "all_terms": "fare_amount - tip_amount + tolls_amount",
}
SCORE = "fare_amount / 120000 - tip_amount / 200000"


def rival_predictions(spark: SparkSession, folder: str) -> DataFrame:
    return predictions_long(line_charges(spark, folder), "total_amount", {
        ("baseline", name): F.expr(formula) for name, formula in RIVALS.items()})


def rival_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return evaluate.regression_metrics(rival_predictions(spark, folder), by=["model"])


def scored_bills(spark: SparkSession, folder: str) -> DataFrame:
    """1 for totals above their median, with a score between 0 and 1."""
    lines = line_charges(spark, folder)
    threshold = median(lines, "total_amount").scalar()
    return lines.select(
        (F.col("total_amount") > threshold).cast("int").alias("label"),
        F.expr(SCORE).alias("score"))


def confusion_counts(spark: SparkSession, folder: str) -> DataFrame:
    guesses = scored_bills(spark, folder).withColumn(
        "prediction", (F.col("score") > 0.4).cast("int"))
    return evaluate.confusion_binary(guesses)


def fare_guesses(spark: SparkSession, folder: str) -> DataFrame:
    """A rough fare guess from the distance, for the four-category matrix."""
    return trips(spark, folder).select(
        F.col("fare_amount").alias("label"),
        (F.col("fare_amount") * 0.8 + F.col("trip_distance")).alias("prediction"))


QUERIES = {
    "regression_metrics": rival_metrics,
    "model_ranking": lambda spark, folder: ranking.rank_models(rival_metrics(spark, folder)),
    "best_worst_model": lambda spark, folder: ranking.best_and_worst(rival_metrics(spark, folder)),
    "confusion_binary": confusion_counts,
    "classification_metrics": lambda spark, folder: evaluate.classification_metrics(
        confusion_counts(spark, folder)),
    "roc_auc": lambda spark, folder: evaluate.curve_areas(scored_bills(spark, folder)),
    "roc_curve": lambda spark, folder: evaluate.roc_curve(scored_bills(spark, folder)),
    "pr_curve": lambda spark, folder: evaluate.pr_curve(scored_bills(spark, folder)),
    "roc_curve_thin": lambda spark, folder: evaluate.thin_roc_curve(scored_bills(spark, folder)),
    "pr_curve_thin": lambda spark, folder: evaluate.thin_pr_curve(scored_bills(spark, folder)),
    "confusion_multiclass": lambda spark, folder: evaluate.confusion_multiclass(
        fare_guesses(spark, folder)),
    "multiclass_metrics": lambda spark, folder: evaluate.multiclass_metrics(
        fare_guesses(spark, folder)),
}

RIVALS_SQL = "rivals AS (" + " UNION ALL ".join(
    f"SELECT '{name}' AS model, total_amount AS label, total_amount - ({formula}) AS e FROM bills"
    for name, formula in RIVALS.items()) + ")"
METRICS_SQL = """measured AS (
  SELECT model, ROUND(SQRT(AVG(e * e)), 6) AS rmse, ROUND(AVG(ABS(e)), 6) AS mae,
    ROUND(AVG(e * e), 6) AS mse, ROUND(1 - AVG(e * e) / VAR_POP(label), 6) AS r2
  FROM rivals GROUP BY model)"""
SCORED_SQL = f"""scored AS (
  SELECT CAST(total_amount > m AS INTEGER) AS label, {SCORE} AS score
  FROM bills, (SELECT quantile_cont(total_amount, 0.5) AS m FROM bills))"""
CONFUSION_SQL = """confusion AS (
  SELECT COUNT(*) FILTER (WHERE label = 1 AND score > 0.4) AS TP,
    COUNT(*) FILTER (WHERE label = 0 AND score <= 0.4) AS TN,
    COUNT(*) FILTER (WHERE label = 0 AND score > 0.4) AS FP,
    COUNT(*) FILTER (WHERE label = 1 AND score <= 0.4) AS FN
  FROM scored)"""
STEPS_SQL = """steps AS (
  SELECT score, pos, neg, SUM(pos) OVER down AS tp, SUM(neg) OVER down AS fp,
    SUM(pos) OVER () AS p, SUM(neg) OVER () AS n
  FROM (SELECT score, COUNT(*) FILTER (WHERE label = 1) AS pos,
          COUNT(*) FILTER (WHERE label = 0) AS neg FROM scored GROUP BY score)
  WINDOW down AS (ORDER BY score DESC))"""
PAIRS_SQL = f"""pairs AS (
  SELECT {CATEGORY_SQL.format('fare_amount')} AS actual,
    {CATEGORY_SQL.format('(fare_amount * 0.8 + trip_distance)')} AS predicted
  FROM trips)"""


def _macro_sql(hit: str, whole: str) -> str:
    return f"ROUND(AVG(COALESCE({hit} / NULLIF({whole}, 0), 0)), 6)"


ORACLE = {
    "regression_metrics": sql("SELECT * FROM measured", RIVALS_SQL, METRICS_SQL),
    "model_ranking": sql(
        "SELECT *, CAST(RANK() OVER (ORDER BY rmse) AS INTEGER) AS model_rank FROM measured",
        RIVALS_SQL, METRICS_SQL),
    "best_worst_model": sql(
        "SELECT arg_min(model, rmse) AS best_model, MIN(rmse) AS best_value, "
        "arg_max(model, rmse) AS worst_model, MAX(rmse) AS worst_value FROM measured",
        RIVALS_SQL, METRICS_SQL),
    "confusion_binary": sql("SELECT * FROM confusion", SCORED_SQL, CONFUSION_SQL),
    "classification_metrics": sql("""
        SELECT ROUND((TP + TN) / t, 6) AS accuracy,
          ROUND(((TP + FN) * (TP / (TP + FP)) + (TN + FP) * (TN / (TN + FN))) / t, 6)
            AS "precision",
          ROUND(((TP + FN) * (TP / (TP + FN)) + (TN + FP) * (TN / (TN + FP))) / t, 6) AS recall,
          ROUND(((TP + FN) * (2 * TP / (2 * TP + FP + FN))
            + (TN + FP) * (2 * TN / (2 * TN + FP + FN))) / t, 6) AS f1,
          ROUND(TN / (TN + FP), 6) AS specificity, ROUND(TP / (TP + FN), 6) AS sensitivity,
          ROUND(FP / (TN + FP), 6) AS fpr, ROUND(FN / (TP + FN), 6) AS fnr, TP, TN, FP, FN
        FROM (SELECT *, CAST(TP + TN + FP + FN AS DOUBLE) AS t FROM confusion)""",
        SCORED_SQL, CONFUSION_SQL),
    "roc_auc": sql("""
        SELECT ROUND(CAST(SUM(neg * (tp - pos / 2)) AS DOUBLE) / (MAX(p) * CAST(MAX(n) AS DOUBLE)),
            9) AS roc_auc,
          ROUND(SUM(pos * (tp / (tp + fp) + CASE WHEN tp + fp > pos + neg
            THEN (tp - pos) / (tp + fp - pos - neg) ELSE tp / (tp + fp) END) / 2) / MAX(p), 9)
            AS pr_auc
        FROM steps""", SCORED_SQL, STEPS_SQL),
    "roc_curve": sql("""
        SELECT score AS threshold, ROUND(fp / n, 9) AS fpr, ROUND(tp / p, 9) AS tpr FROM steps
        UNION ALL SELECT NULL, 0, 0""", SCORED_SQL, STEPS_SQL),
    "pr_curve": sql("""
        SELECT score AS threshold, ROUND(tp / p, 9) AS recall,
          ROUND(tp / (tp + fp), 9) AS "precision" FROM steps
        UNION ALL (SELECT NULL, 0, ROUND(tp / (tp + fp), 9) FROM steps ORDER BY score DESC LIMIT 1)
        """, SCORED_SQL, STEPS_SQL),
    "roc_curve_thin": sql("""
        SELECT threshold, ROUND(fpr, 9) AS fpr, ROUND(tpr, 9) AS tpr, ROUND(gap, 9) AS gap
        FROM (SELECT threshold, fpr, tpr,
                GREATEST(MAX(fpr) OVER here - MIN(fpr) OVER here, MAX(tpr) OVER here - MIN(tpr) OVER here) AS gap,
                place = MIN(place) OVER here OR place = MAX(place) OVER here AS taken
              FROM (SELECT score AS threshold, tp + fp AS place, fp / n AS fpr, tp / p AS tpr,
                      LEAST(floor((fp / n + tp / p) / 2 * 499), 498) AS part FROM steps)
              WINDOW here AS (PARTITION BY part))
        WHERE taken UNION ALL SELECT NULL, 0, 0, 0""", SCORED_SQL, STEPS_SQL),
    "pr_curve_thin": sql("""
        SELECT threshold, ROUND(recall, 9) AS recall, ROUND("precision", 9) AS "precision",
          ROUND(gap, 9) AS gap
        FROM (SELECT *, MAX(recall) OVER here - MIN(recall) OVER here AS gap,
                1 IN (ROW_NUMBER() OVER (PARTITION BY part ORDER BY place),
                      ROW_NUMBER() OVER (PARTITION BY part ORDER BY place DESC),
                      ROW_NUMBER() OVER (PARTITION BY part ORDER BY "precision", place),
                      ROW_NUMBER() OVER (PARTITION BY part ORDER BY "precision" DESC, place)) AS taken
              FROM (SELECT score AS threshold, tp + fp AS place, tp / p AS recall,
                      tp / (tp + fp) AS "precision", LEAST(floor(tp / p * 249), 248) AS part FROM steps)
              WINDOW here AS (PARTITION BY part))
        WHERE taken
        UNION ALL (SELECT NULL, 0, ROUND(tp / (tp + fp), 9), 0 FROM steps ORDER BY score DESC LIMIT 1)
        """, SCORED_SQL, STEPS_SQL),
    "confusion_multiclass": sql(
        "SELECT actual, " + ", ".join(
            f"COUNT(*) FILTER (WHERE predicted = '{c}') AS {c}" for c in evaluate.CATEGORY_NAMES)
        + " FROM pairs GROUP BY actual", PAIRS_SQL),
    "multiclass_metrics": sql(
        "SELECT ROUND(SUM(hit) / MAX(t), 6) AS accuracy, "
        f"{_macro_sql('hit', 'guess')} AS macro_precision, "
        f"{_macro_sql('hit', 'real')} AS macro_recall, "
        f"{_macro_sql('(2 * hit)', '(real + guess)')} AS macro_f1 "
        "FROM (SELECT c, COUNT(*) FILTER (WHERE actual = c AND predicted = c) AS hit, "
        "COUNT(*) FILTER (WHERE actual = c) AS real, COUNT(*) FILTER (WHERE predicted = c) "
        "AS guess, COUNT(*) AS t FROM pairs, (VALUES ('Low'), ('Medium'), ('High'), ('Premium')) "
        "AS categories(c) GROUP BY c)", PAIRS_SQL),
}
