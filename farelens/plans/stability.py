"""Disturbed inputs, compared with the baseline, on formula models."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farelens.ml import evaluate, stability
from farelens.plans.evaluation import RIVALS
from farelens.plans.sql_views import sql
from farelens.sources import line_charges

MOVED = ["fare_amount", "tip_amount"]
LINE_KEY = "l_orderkey * 8 + l_linenumber"


def _measure(rows: DataFrame) -> DataFrame:
    long = stability.predictions_long(rows, "total_amount", {
        ("", name): F.expr(formula) for name, formula in RIVALS.items()})
    return evaluate.regression_metrics(long, by=["model"])


def _scenarios(spark: SparkSession, folder: str, levels: dict[str, float],
               dropped: str | None = None) -> DataFrame:
    """Metrics of every formula in every scenario, all in one scan: the moved columns by
    noise level, and ``tip_amount`` without information under the name ``dropped``."""
    lines = line_charges(spark, folder)
    spread = lines.agg(F.struct(*[F.stddev(c).alias(c) for c in MOVED]).alias("s")).scalar()
    noise = [stability.repeatable_noise(F.expr(LINE_KEY), place) for place in range(len(MOVED))]
    scenarios = [F.struct(F.lit(name).alias("scenario"), *[
        (F.col(c) + level * spread[c] * n).alias(c) for c, n in zip(MOVED, noise)])
        for name, level in levels.items()]
    if dropped:
        scenarios.append(F.struct(F.lit(dropped).alias("scenario"), F.col("fare_amount"),
                                  F.lit(0.0).alias("tip_amount")))
    moved = lines.select("total_amount", "tolls_amount", F.inline(F.array(*scenarios)))
    long = moved.select("scenario", F.inline(F.array(*[
        F.struct(F.lit(name).alias("model"), F.col("total_amount").alias("label"),
                 F.expr(formula).alias("prediction")) for name, formula in RIVALS.items()])))
    return evaluate.regression_metrics(long, by=["scenario", "model"])


def noise_injection(spark: SparkSession, folder: str) -> DataFrame:
    """Metrics of every formula at every noise level."""
    return _scenarios(spark, folder, {
        "baseline": 0.0, **{f"noise_{level:.2f}": level for level in stability.NOISE_LEVELS}})


def feature_dropout(spark: SparkSession, folder: str) -> DataFrame:
    return _measure(stability.with_dropout(line_charges(spark, folder), "tip_amount"))


def stability_union(spark: SparkSession, folder: str) -> DataFrame:
    return _scenarios(spark, folder, {"baseline": 0.0, "noise": 0.05}, dropped="dropout")


def stability_compare(spark: SparkSession, folder: str) -> DataFrame:
    return stability.compare_to_baseline(noise_injection(spark, folder))


def stability_tier(spark: SparkSession, folder: str) -> DataFrame:
    """The strongest noise only: model, rmse change and tier."""
    strongest = stability_compare(spark, folder).where(
        F.col("scenario") == f"noise_{max(stability.NOISE_LEVELS):.2f}")
    return strongest.select("model", "rmse_change", "stability")


def most_stable_model(spark: SparkSession, folder: str) -> DataFrame:
    return stability.mean_change(stability_compare(spark, folder))


QUERIES = {
    "noise_injection": noise_injection,
    "feature_dropout": feature_dropout,
    "stability_union": stability_union,
    "stability_compare": stability_compare,
    "stability_tier": stability_tier,
    "insight_most_stable": most_stable_model,
}



def _noise(place: int) -> str:
    mixed = f"(({LINE_KEY}) % 2147483648) * 7919 + {(place + 1) * 104729}"
    return f"(((({mixed}) % 2147483648) * 48271 % 2001) - 1000) / 1000.0::DOUBLE"


def _scenario(name: str, fare: str, tip: str) -> str:
    return (f"SELECT '{name}' AS scenario, total_amount, tolls_amount, {fare} AS fare_amount, "
            f"{tip} AS tip_amount FROM bills, spread")


def _moved(name: str, level: float) -> str:
    return _scenario(name, f"fare_amount + {level} * sd_fare * {_noise(0)}",
                     f"tip_amount + {level} * sd_tip * {_noise(1)}")


SPREAD = """spread AS (SELECT STDDEV_SAMP(fare_amount) AS sd_fare,
  STDDEV_SAMP(tip_amount) AS sd_tip FROM bills)"""


def _measured(scenarios: list[str]) -> tuple[str, ...]:
    errors = " UNION ALL ".join(
        f"SELECT scenario, '{name}' AS model, total_amount AS label, "
        f"total_amount - ({formula}) AS e FROM scenarios" for name, formula in RIVALS.items())
    return (SPREAD, "scenarios AS (" + " UNION ALL ".join(scenarios) + ")",
            f"errors AS ({errors})", """measured AS (
              SELECT scenario, model, ROUND(SQRT(AVG(e * e)), 6) AS rmse,
                ROUND(AVG(ABS(e)), 6) AS mae, ROUND(AVG(e * e), 6) AS mse,
                ROUND(1 - AVG(e * e) / VAR_POP(label), 6) AS r2
              FROM errors GROUP BY scenario, model)""")


LEVELS = _measured([_moved("baseline", 0.0)] + [
    _moved(f"noise_{level:.2f}", level) for level in stability.NOISE_LEVELS])
DROPPED = _scenario("dropout", "fare_amount", "0")
COMPARED = """compared AS (
  SELECT m.scenario, m.model, b.rmse AS base_rmse, m.rmse, b.r2 AS base_r2, m.r2,
    100.0 * (m.rmse - b.rmse) / NULLIF(b.rmse, 0) AS rmse_move,
    100.0 * (m.r2 - b.r2) / NULLIF(b.r2, 0) AS r2_move
  FROM measured m JOIN measured b USING (model)
  WHERE b.scenario = 'baseline' AND m.scenario <> 'baseline')"""
TIER = ("CASE WHEN ABS(rmse_move) < 5 THEN 'High' WHEN ABS(rmse_move) < 15 THEN 'Medium' "
        "WHEN rmse_move IS NOT NULL THEN 'Low' END AS stability")

ORACLE = {
    "noise_injection": sql("SELECT * FROM measured", *LEVELS),
    "feature_dropout": sql("SELECT * EXCLUDE (scenario) FROM measured", *_measured([DROPPED])),
    "stability_union": sql("SELECT * FROM measured", *_measured(
        [_moved("baseline", 0.0), _moved("noise", 0.05), DROPPED])),
    "stability_compare": sql(
        "SELECT scenario, model, base_rmse, rmse, base_r2, r2, ROUND(rmse_move, 6) AS rmse_change, "
        f"ROUND(r2_move, 6) AS r2_change, {TIER} FROM compared", *LEVELS, COMPARED),
    "stability_tier": sql(
        f"SELECT model, ROUND(rmse_move, 6) AS rmse_change, {TIER} FROM compared "
        "WHERE scenario = 'noise_0.10'", *LEVELS, COMPARED),
    "insight_most_stable": sql(
        "SELECT model, ROUND(AVG(ABS(ROUND(rmse_move, 6))), 6) AS mean_change FROM compared "
        "GROUP BY model", *LEVELS, COMPARED),
}
