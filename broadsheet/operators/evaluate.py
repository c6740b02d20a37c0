"""Evaluation tables from (fold, label, pred) rows, and threshold tables from scores."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.operators.keyed import exact_quantiles, running_totals
from broadsheet.operators.profile import histogram


def cell_counts(preds: DataFrame) -> DataFrame:
    """The one aggregate all F1 tables start from."""
    return preds.groupBy("fold", "label", "pred").agg(F.count(F.lit(1)).alias("n"))


def _ratio(a, b):
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _per_label(cells: DataFrame) -> DataFrame:
    """True, predicted and correct rows per (fold, label) for every label that is true or predicted in the fold."""
    sides = cells.select("fold", F.inline(F.array(
        F.struct(F.col("label").alias("label"), F.col("n").alias("n_true"), F.lit(0).cast("bigint").alias("n_pred"),
                 F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("pred").alias("label"), F.lit(0).cast("bigint").alias("n_true"), F.col("n").alias("n_pred"),
                 F.lit(0).cast("bigint").alias("tp")),
    )))
    return sides.groupBy("fold", "label").agg(*[F.sum(c).alias(c) for c in ("n_true", "n_pred", "tp")])


def _prf(n_true, n_pred, tp):
    return _ratio(tp, n_pred), _ratio(tp, n_true), _ratio(2 * tp, n_true + n_pred)


def fold_f1(preds: DataFrame) -> DataFrame:
    """Macro, micro and weighted F1 per fold; macro runs over labels true or predicted in that fold."""
    cells = cell_counts(preds)
    total = cells.agg(F.sum("n")).scalar()
    _, _, f1 = _prf(F.col("n_true"), F.col("n_pred"), F.col("tp"))
    return _per_label(cells).groupBy("fold").agg(
        F.avg(f1).alias("macro_f1"),
        (F.sum("tp") / F.sum("n_true")).alias("micro_f1"),
        (F.sum(f1 * F.col("n_true")) / F.sum("n_true")).alias("weighted_f1"),
        F.sum("n_true").alias("n_valid"),
    ).withColumn("n_train", total - F.col("n_valid")).orderBy("fold")


def per_class_metrics(preds: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per fold for every true label of the whole table; 0/0 is 0."""
    cells = cell_counts(preds)
    labels = cells.agg(F.array_sort(F.collect_set("label"))).scalar()  # one entry per class
    grid = cells.groupBy("fold").agg(F.count(F.lit(1)).alias("_n")).select("fold", F.explode(labels).alias("label"))
    n = lambda c: F.coalesce(c, F.lit(0).cast("bigint"))
    precision, recall, f1 = _prf(n("n_true"), n("n_pred"), n("tp"))
    return grid.join(_per_label(cells), ["fold", "label"], "left").select(
        "fold", "label", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), n("n_true").alias("support")
    )


def per_class_mean(preds: DataFrame) -> DataFrame:
    return per_class_metrics(preds).groupBy("label").agg(
        *[F.avg(c).alias(c) for c in ("precision", "recall", "f1")]
    ).orderBy("label")


def confusion_matrix(preds: DataFrame, labels: list[int] | None = None) -> DataFrame:
    """Label by label counts over all folds; columns ``pred_<label>`` for the true labels."""
    cells = cell_counts(preds)
    if labels is None:
        labels = [r[0] for r in cells.select("label").distinct().orderBy("label").collect()]
    return cells.groupBy("label").agg(*[
        F.coalesce(F.sum(F.when(F.col("pred") == c, F.col("n"))), F.lit(0)).alias(f"pred_{c}") for c in labels
    ]).orderBy("label")


def cv_summary(preds: DataFrame) -> DataFrame:
    return fold_f1(preds).agg(
        F.count(F.lit(1)).alias("folds"), F.avg("macro_f1").alias("macro_f1_mean"),
        F.coalesce(F.stddev_samp("macro_f1"), F.lit(0.0)).alias("macro_f1_std"),
    )


def true_pred_counts(preds: DataFrame) -> DataFrame:
    """True and predicted rows per true label; labels that are only predicted are left out."""
    return _per_label(cell_counts(preds)).groupBy("label").agg(
        F.sum("n_true").alias("true_count"), F.sum("n_pred").alias("pred_count")
    ).where("true_count > 0").withColumn("pred_per_true", F.col("pred_count") / F.col("true_count")).orderBy("label")


def oof_counts(preds: DataFrame) -> DataFrame:
    counts = true_pred_counts(preds)
    true_total, pred_total = (counts.agg(F.sum(c)).scalar() for c in ("true_count", "pred_count"))
    return counts.select(
        F.col("label").cast("string").alias("label"), "true_count", "pred_count", "pred_per_true",
        (F.col("true_count") / true_total).alias("true_share"), (F.col("pred_count") / pred_total).alias("pred_share"),
    ).orderBy("label")


def label_f1(preds: DataFrame) -> DataFrame:
    """F1 per true label over the whole table."""
    totals = _per_label(cell_counts(preds)).groupBy("label").agg(
        *[F.sum(c).alias(c) for c in ("n_true", "n_pred", "tp")]
    ).where("n_true > 0")
    _, _, f1 = _prf(F.col("n_true"), F.col("n_pred"), F.col("tp"))
    return totals.select(F.col("label").cast("string").alias("label"), f1.alias("f1"))


def weak_labels(preds: DataFrame, k: int = 2, among: list[str] | None = None) -> DataFrame:
    """The ``k`` labels (at least one) with the lowest F1."""
    scored = label_f1(preds)
    if among is not None:
        scored = scored.where(F.col("label").isin(among))
    return scored.orderBy("f1", "label").limit(max(1, k))


# Score tables. ``scores`` has one row per (row, class): class, score, is_pos.

def class_scores(long: DataFrame) -> DataFrame:
    """Scores of classes with both positive and negative rows; null scores dropped."""
    return long.select(
        F.col("class").cast("string").alias("class"), F.col("score").cast("double").alias("score"),
        (F.col("label").cast("string") == F.col("class").cast("string")).alias("is_pos"),
    ).where(F.col("score").isNotNull() & ~F.isnan("score"))


def _ranked(long: DataFrame) -> DataFrame:
    per_score = class_scores(long).groupBy("class", "score").agg(
        F.count(F.when(F.col("is_pos"), 1)).alias("tp_here"), F.count(F.lit(1)).alias("n_here")
    )
    ranked = running_totals(per_score, ["class"], "score", ["tp_here", "n_here"], descending=True)
    pos = F.col("total_tp_here")
    return ranked.where((pos > 0) & (pos < F.col("total_n_here"))).select(
        "class", "score", "tp_here", pos.alias("pos"),
        (F.col("cum_tp_here") / F.col("cum_n_here")).alias("precision"), (F.col("cum_tp_here") / pos).alias("recall"),
    )


def pr_curve(long: DataFrame) -> DataFrame:
    """Precision and recall at every distinct score, then the closing point (1, 0) without a threshold."""
    ranked = _ranked(long)
    points = ranked.select("class", F.col("score").alias("threshold"), "precision", "recall")
    closing = points.groupBy("class").agg(
        F.lit(None).cast("double").alias("threshold"), F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall")
    )
    return points.unionByName(closing)


def average_precision(long: DataFrame) -> DataFrame:
    """Sum of precision times the recall gained at each threshold (a step sum, no trapezoid)."""
    return _ranked(long).groupBy("class").agg(
        F.sum(F.col("precision") * F.col("tp_here") / F.col("pos")).alias("ap")
    )


def best_f1_threshold(long: DataFrame) -> DataFrame:
    """Highest F1 over the thresholds; the lowest threshold wins ties."""
    p, r = F.col("precision"), F.col("recall")
    f1 = 2.0 * p * r / (p + r + 1e-12)
    return _ranked(long).groupBy("class").agg(
        F.max(F.struct(f1.alias("f1"), (-F.col("score")).alias("neg"))).alias("best")
    ).select("class", F.col("best.f1").alias("best_f1"), (-F.col("best.neg")).alias("best_thr"))


def pr_summary(long: DataFrame, preds: DataFrame) -> DataFrame:
    f1 = label_f1(preds).select(F.col("label").alias("class"), F.col("f1").alias("f1_pred"))
    return average_precision(long).join(best_f1_threshold(long), "class").join(f1, "class", "left").select(
        F.col("class").alias("label"), F.round("ap", 4).alias("ap"), F.round("f1_pred", 4).alias("f1_pred"),
        F.round("best_f1", 4).alias("best_f1"), F.round("best_thr", 6).alias("best_thr"),
    ).orderBy("label")


def _of_labels(long: DataFrame, labels: list[str] | None) -> DataFrame:
    scores = class_scores(long)
    return scores.where(F.col("class").isin(labels)) if labels is not None else scores


def score_separation(long: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Mean and 90th percentile of the scores of positives and negatives per class; classes with one side are skipped."""
    scores = _of_labels(long, labels)
    means = scores.groupBy("class", "is_pos").agg(F.avg("score").alias("mean"), F.count(F.lit(1)).alias("n"))
    p90 = exact_quantiles(scores, ["class", "is_pos"], "score", [0.9])
    sides = means.join(p90, ["class", "is_pos"])
    pick = lambda side, c: F.max(F.when(F.col("is_pos") == side, F.col(c)))
    return sides.groupBy("class").agg(
        pick(True, "mean").alias("pos_mean"), pick(False, "mean").alias("neg_mean"),
        pick(True, "q0").alias("pos_p90"), pick(False, "q0").alias("neg_p90"),
    ).where("pos_mean is not null and neg_mean is not null")


def score_histogram(long: DataFrame, labels: list[str] | None = None, bins: int = 40) -> DataFrame:
    """Density histogram of each side over its own range."""
    return histogram(_of_labels(long, labels), "score", bins, density=True, by=["class", "is_pos"])
