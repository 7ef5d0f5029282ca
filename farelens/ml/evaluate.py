"""Model metrics as aggregates: one pass for all metrics of all models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.functions.fares import FARE_CATEGORIES, fare_category
from farelens.operators.quantiles import with_running_totals

CATEGORY_NAMES = [name for _, name in FARE_CATEGORIES]


def regression_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
                       by: Sequence[str] = ()) -> DataFrame:
    """rmse, mae, mse and r2; r2 is null when the label does not vary."""
    error = F.col(label) - F.col(prediction)
    sums = df.groupBy(*by).agg(
        F.avg(error * error).alias("mse"),
        F.avg(F.abs(error)).alias("mae"),
        F.var_pop(label).alias("_variance"))
    return sums.select(
        *by,
        F.round(F.sqrt("mse"), 6).alias("rmse"),
        F.round("mae", 6).alias("mae"),
        F.round("mse", 6).alias("mse"),
        F.round(1 - F.try_divide(F.col("mse"), F.col("_variance")), 6).alias("r2"))


def confusion_binary(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     by: Sequence[str] = ()) -> DataFrame:
    actual, guess = F.col(label) == 1, F.col(prediction) == 1
    return df.groupBy(*by).agg(
        F.count_if(actual & guess).alias("TP"),
        F.count_if(~actual & ~guess).alias("TN"),
        F.count_if(~actual & guess).alias("FP"),
        F.count_if(actual & ~guess).alias("FN"))


def _ratio(part: Column, whole: Column) -> Column:
    """0 where nothing was there to count."""
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def classification_metrics(confusion: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy and the support-weighted precision, recall and F1, plus the four rates."""
    tp, tn, fp, fn = (F.col(c).cast("double") for c in ("TP", "TN", "FP", "FN"))
    total = tp + tn + fp + fn
    positive, negative = tp + fn, tn + fp

    def weighted(for_positive: Column, for_negative: Column) -> Column:
        return F.try_divide(positive * for_positive + negative * for_negative, total)

    def f1(hit: Column, wrong: Column) -> Column:
        return _ratio(2 * hit, 2 * hit + wrong)

    sensitivity, specificity = _ratio(tp, positive), _ratio(tn, negative)
    measures = {
        "accuracy": F.try_divide(tp + tn, total),
        "precision": weighted(_ratio(tp, tp + fp), _ratio(tn, tn + fn)),
        "recall": weighted(sensitivity, specificity),
        "f1": weighted(f1(tp, fp + fn), f1(tn, fp + fn)),
        "specificity": specificity,
        "sensitivity": sensitivity,
        "fpr": _ratio(fp, negative),
        "fnr": _ratio(fn, positive),
    }
    return confusion.select(
        *by, *[F.round(value, 6).alias(name) for name, value in measures.items()],
        "TP", "TN", "FP", "FN")


def _score_steps(df: DataFrame, label: str, score: str, by: Sequence[str]) -> DataFrame:
    """One row per distinct score, best first, with positives and negatives before it."""
    counts = df.dropna(subset=[label, score]).groupBy(*by, F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"),
        F.count_if(F.col(label) != 1).alias("neg"))
    return with_running_totals(counts, "score", ["pos", "neg"], by, descending=True)


def _precision(tp: Column, fp: Column) -> Column:
    return F.try_divide(tp, tp + fp)


def roc_curve(df: DataFrame, label: str = "label", score: str = "score",
              by: Sequence[str] = ()) -> DataFrame:
    """Every point (threshold, fpr, tpr), starting at (0, 0) without a threshold."""
    steps = _score_steps(df, label, score, by)
    return _curve(steps, by, {
        "fpr": (F.lit(0.0), F.try_divide(F.col("neg_before") + F.col("neg"), F.col("neg_total"))),
        "tpr": (F.lit(0.0), F.try_divide(F.col("pos_before") + F.col("pos"), F.col("pos_total"))),
    })


def pr_curve(df: DataFrame, label: str = "label", score: str = "score",
             by: Sequence[str] = ()) -> DataFrame:
    """Every point (threshold, recall, precision), starting at recall 0 with the
    first point's precision."""
    steps = _score_steps(df, label, score, by)
    tp, fp = F.col("pos_before") + F.col("pos"), F.col("neg_before") + F.col("neg")
    return _curve(steps, by, {
        "recall": (F.lit(0.0), F.try_divide(tp, F.col("pos_total"))),
        "precision": (_precision(tp, fp), _precision(tp, fp)),
    })


def _curve(steps: DataFrame, by: Sequence[str], axes: dict[str, tuple[Column, Column]]) -> DataFrame:
    def point(threshold: Column, side: int) -> Column:
        return F.struct(
            threshold.alias("threshold"),
            *[F.round(ends[side], 9).alias(name) for name, ends in axes.items()])

    here = point(F.col("score"), 1)
    start = point(F.lit(None).cast("double"), 0)
    first = (F.col("pos_before") == 0) & (F.col("neg_before") == 0)
    return steps.select(*by, F.inline(F.when(first, F.array(start, here)).otherwise(F.array(here))))


#: Points of a thinned curve at most, with those of its two ends.
CURVE_POINTS = 1_000


def _thinned(steps: DataFrame, by: Sequence[str], along: Column, axes: dict[str, Column],
             first: dict[str, Column], kept: Sequence[str], points: int) -> DataFrame:
    """The steps of a curve in ranges of ``along`` (0 to 1), each with its first and last step
    and those with the least and greatest value of the axes in ``kept``.

    The line through these crosses every value that a left out step has, inside its
    range, so no step is farther from the line than the range is wide. ``gap`` is the
    greatest width of that range on any axis outside ``kept``. One aggregate of single
    numbers; its rows are bounded by ``points``.
    """
    ranges = (points - 2) // (2 + 2 * len(kept))
    place = F.col("pos_before") + F.col("pos") + F.col("neg_before") + F.col("neg")
    rows = steps.select(
        *by, F.col("score").alias("threshold"), place.alias("_place"),
        F.least(F.floor(along * ranges), F.lit(ranges - 1)).cast("int").alias("_range"),
        *[axis.alias(name) for name, axis in axes.items()])
    order = {"first": (F.min_by, F.col("_place")), "last": (F.max_by, F.col("_place"))}
    for name in kept:
        # of equal values the earliest step
        order |= {f"least_{name}": (F.min_by, F.struct(name, "_place")),
                  f"most_{name}": (F.max_by, F.struct(name, -F.col("_place")))}
    chosen = rows.groupBy(*by, "_range").agg(
        *[pick(F.struct("_place", "threshold", *axes), key).alias(f"_{which}")
          for which, (pick, key) in order.items()],
        F.greatest(F.lit(0.0), *[F.max(name) - F.min(name) for name in axes if name not in kept],
                   F.lit(0.0)).alias("gap"))
    picked = chosen.select(*by, "gap", F.explode(F.array_distinct(F.array(*[f"_{w}" for w in order])))
                           .alias("_at"))
    found = picked.select(*by, F.col("_at.threshold").alias("threshold"),
                          *[F.round(f"_at.{name}", 9).alias(name) for name in axes],
                          F.round("gap", 9).alias("gap"))
    least = rows.groupBy(*by).agg(F.min_by(F.struct(*axes), "_place").alias("_at"))
    start = least.select(*by, F.lit(None).cast("double").alias("threshold"),
                         *[F.round(value, 9).alias(name) for name, value in first.items()],
                         F.lit(0.0).alias("gap"))
    return start.unionByName(found)


def thin_roc_curve(df: DataFrame, label: str = "label", score: str = "score",
                   by: Sequence[str] = (), points: int = CURVE_POINTS) -> DataFrame:
    """As ``roc_curve`` with at most ``points`` points a group; ``gap`` bounds how far the left
    out points near a point are from the thinned line. Both rates only grow."""
    fpr = F.try_divide(F.col("neg_before") + F.col("neg"), F.col("neg_total"))
    tpr = F.try_divide(F.col("pos_before") + F.col("pos"), F.col("pos_total"))
    along = (F.coalesce(fpr, F.lit(0.0)) + F.coalesce(tpr, F.lit(0.0))) / 2
    zero = F.lit(0.0)
    return _thinned(_score_steps(df, label, score, by), by, along, {"fpr": fpr, "tpr": tpr},
                    {"fpr": zero, "tpr": zero}, (), points)


def thin_pr_curve(df: DataFrame, label: str = "label", score: str = "score",
                  by: Sequence[str] = (), points: int = CURVE_POINTS) -> DataFrame:
    """As ``pr_curve`` with at most ``points`` points a group. Recall only grows; precision goes
    up and down, so each range keeps its least and greatest."""
    tp, fp = F.col("pos_before") + F.col("pos"), F.col("neg_before") + F.col("neg")
    recall = F.try_divide(tp, F.col("pos_total"))
    return _thinned(_score_steps(df, label, score, by), by, F.coalesce(recall, F.lit(0.0)),
                    {"recall": recall, "precision": _precision(tp, fp)},
                    {"recall": F.lit(0.0), "precision": F.col("_at.precision")}, ("precision",), points)


def curve_areas(df: DataFrame, label: str = "label", score: str = "score",
                by: Sequence[str] = ()) -> DataFrame:
    """Exact roc_auc and pr_auc by trapezoids between distinct scores."""
    pos, neg = F.col("pos"), F.col("neg")
    before, fp_before = F.col("pos_before"), F.col("neg_before")
    roc_part = neg * (before + pos / 2.0)
    precision = _precision(before + pos, fp_before + neg)
    previous = F.coalesce(_precision(before, fp_before), precision)
    pr_part = pos * (precision + previous) / 2.0
    sums = _score_steps(df, label, score, by).groupBy(*by).agg(
        F.sum(roc_part).alias("_roc"), F.sum(pr_part).alias("_pr"),
        F.max("pos_total").alias("_pos"), F.max("neg_total").alias("_neg"))
    return sums.select(
        *by,
        F.round(F.try_divide(F.col("_roc"), F.col("_pos").cast("double") * F.col("_neg")), 9)
         .alias("roc_auc"),
        F.round(F.try_divide(F.col("_pr"), F.col("_pos")), 9).alias("pr_auc"))


def _category_pairs(df: DataFrame, label: str, prediction: str) -> DataFrame:
    return df.select(
        fare_category(label).alias("actual"), fare_category(prediction).alias("predicted")
    ).dropna()


def confusion_multiclass(df: DataFrame, label: str = "label", prediction: str = "prediction"
                         ) -> DataFrame:
    """Actual fare category against the predicted one, a column per predicted category."""
    return (
        _category_pairs(df, label, prediction)
        .groupBy("actual").pivot("predicted", CATEGORY_NAMES).count()
        .na.fill(0, CATEGORY_NAMES))


def multiclass_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction"
                       ) -> DataFrame:
    """Accuracy and macro averages over the four fare categories."""
    actual, predicted = F.col("actual"), F.col("predicted")
    n = F.col("_n")
    cells = _category_pairs(df, label, prediction).groupBy("actual", "predicted").agg(
        F.count("*").alias("_n"))
    table = cells.agg(
        F.sum(n).alias("_total"),
        *[F.coalesce(F.sum(F.when(condition, n)), F.lit(0)).alias(f"_{kind}_{c}")
          for c in CATEGORY_NAMES
          for kind, condition in (
              ("hit", (actual == c) & (predicted == c)),
              ("actual", actual == c), ("predicted", predicted == c))])

    def macro(measure) -> Column:
        parts = [measure(*(F.col(f"_{kind}_{c}") for kind in ("hit", "actual", "predicted")))
                 for c in CATEGORY_NAMES]
        return F.round(sum(parts[1:], parts[0]) / len(parts), 6)

    hits = sum((F.col(f"_hit_{c}") for c in CATEGORY_NAMES[1:]), F.col(f"_hit_{CATEGORY_NAMES[0]}"))
    return table.select(
        F.round(F.try_divide(hits, F.col("_total")), 6).alias("accuracy"),
        macro(lambda hit, real, guess: _ratio(hit, guess)).alias("macro_precision"),
        macro(lambda hit, real, guess: _ratio(hit, real)).alias("macro_recall"),
        macro(lambda hit, real, guess: _ratio(2 * hit, real + guess)).alias("macro_f1"))
