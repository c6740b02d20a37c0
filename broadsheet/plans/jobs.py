"""The jobs: clean, cross-validate, train on everything, score a new table, save and load."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass

import numpy as np
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.operators import dedup, drift, evaluate, folds, profile
from broadsheet.operators.design import (
    Features, assembler, fit_features, packed, prepare, term_counter, token_assembler, tokenized, unpacked)
from broadsheet.operators.linear import LinearModel, train
from broadsheet.operators.measures import with_measures, without_measures
from broadsheet.params import JobParams
from broadsheet.plans import cache
from broadsheet.sources import sinks
from broadsheet.sources.articles import score_rows


def clean_development(dev: DataFrame, eva: DataFrame | None, p: JobParams) -> tuple[DataFrame, dict[str, DataFrame]]:
    """The labelled table without leaked (if asked) and contradictory rows, and the two one-row reports.

    The table is stored with the keys of its texts, so that they are normalised once for all steps and reports.
    """
    if not p.clean:
        return dev, {}
    keyed = sinks.stored(dedup.with_key(dev), "keyed")
    kept, reports = keyed, {}
    if eva is not None:
        other = sinks.stored(dedup.with_key(eva).select(dedup.KEY), "keys")
        kept, reports["leakage_report"] = dedup.drop_overlap(keyed, other, drop=p.drop_overlap)
    kept, reports["dedup_report"] = dedup.drop_cross_label_duplicates(kept, drop_same_label=p.drop_same_label)
    return kept.drop(dedup.KEY), reports


def _label_counts(rows: DataFrame, models: list[int]) -> dict[int, dict[int, int]]:
    cells = rows.groupBy("fold", "label").agg(F.count(F.lit(1)).alias("n")).collect()
    out: dict[int, dict[int, int]] = {m: {} for m in models}
    for m in models:
        for r in cells:
            if m < 0 or r["fold"] != m:
                out[m][r["label"]] = out[m].get(r["label"], 0) + r["n"]
    return out


@dataclass
class FittedModel:
    features: Features
    linear: LinearModel

    def score(self, df: DataFrame) -> DataFrame:
        """(id, prediction, scores) for new articles."""
        rows = prepare(df.drop("label", "fold"), self.features.params)
        return self.linear.score(tokenized(rows, self.features), token_assembler(self.features)).select("id", "prediction", "scores")

    def save(self, spark: SparkSession, path: str) -> None:
        cache.save_features(spark, self.features, path)
        rows = [
            (m, q, [float(v) for v in self.linear.weights[i, q]])
            for i, m in enumerate(self.linear.models) for q in range(self.linear.weights.shape[1])
        ]
        spark.createDataFrame(rows, "model int, problem int, weights array<double>").write.mode("overwrite").parquet(
            f"{path}/coefficients")
        sinks.write_summary(spark, {"kind": self.linear.kind, "classes": self.linear.classes}, f"{path}/classifier")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "FittedModel":
        features = cache.load_features(spark, path)
        classifier = spark.read.json(f"{path}/classifier").first()
        rows = spark.read.parquet(f"{path}/coefficients").orderBy("model", "problem").collect()
        order = {m: i for i, m in enumerate(features.models)}
        weights = np.zeros((len(order), 1 + max(r["problem"] for r in rows), features.size + 1))
        for r in rows:
            weights[order[r["model"]], r["problem"]] = r["weights"]
        return cls(features, LinearModel(classifier["kind"], json.loads(classifier["classes"]), features.models, weights))


def _fit(rows: DataFrame, p: JobParams, models: list[int]) -> tuple[Features, LinearModel, DataFrame, Callable]:
    """The features, the model, and the cached rows with what turns their batches into batches of the design matrix."""
    f = cache.fitted(rows, p, models) if p.cache else fit_features(rows, p, models)
    plain, from_tokens = tokenized(rows, f), token_assembler(f)
    if len(models) == 1:  # its design matrix is as large as the counts, and then no pass assembles it again
        x, expand = packed(plain, from_tokens), unpacked
    else:
        assemble = assembler(f)
        x, expand = packed(plain, term_counter(f)), lambda batches: assemble(unpacked(batches))
    x = x.persist(StorageLevel.MEMORY_AND_DISK)
    linear = train(plain, f.size, models, _label_counts(rows, models), p.model, from_tokens, f.dense, cached=(x, expand))
    return f, linear, x, expand


@dataclass
class CrossValidation:
    """Out-of-fold predictions (id, fold, label, pred, score_<class>), the cleaning reports and the fold models."""

    preds: DataFrame
    reports: dict[str, DataFrame]
    model: LinearModel
    seconds: float


def cross_validation(dev: DataFrame, eva: DataFrame | None, p: JobParams = JobParams()) -> CrossValidation:
    """Predict every row of the cleaned table by a model that has not seen it.

    Vocabularies, idf, kept sources, medians, scales, weights and coefficients of a fold come from its training rows
    only; all folds are fitted in the same passes over the data.
    """
    started = time.time()
    cleaned, reports = clean_development(dev, eva, p)
    folded = folds.stratified_folds(cleaned.withColumn("label", F.col("label").cast("int")), p.k, p.seed)
    rows = sinks.stored(prepare(folded, p.text), "prepared")
    f, linear, x, expand = _fit(rows, p, list(range(p.k)))
    held_out = linear.score(x, lambda batches: (b.filter(pc.equal(b.column("fold"), b.column("model"))) for b in expand(batches)))
    scores = _score_columns(linear)
    out = sinks.stored(held_out.select("id", "fold", "label", F.col("prediction").alias("pred"), *scores), "oof")
    x.unpersist()
    sinks.discard(rows)
    return CrossValidation(out, reports, linear, time.time() - started)


def cross_validate(dev: DataFrame, eva: DataFrame | None, p: JobParams = JobParams()) -> DataFrame:
    """The out-of-fold predictions of ``cross_validation``."""
    return cross_validation(dev, eva, p).preds


def _score_columns(linear: LinearModel):
    if linear.weights.shape[1] == 1:
        return [F.get("scores", F.lit(0)).alias(f"score_{linear.classes[1]}")]
    return [F.get("scores", F.lit(i)).alias(f"score_{c}") for i, c in enumerate(linear.classes)]


def evaluation_tables(preds: DataFrame) -> dict[str, DataFrame]:
    return {
        "folds": evaluate.fold_f1(preds),
        "per_class_mean": evaluate.per_class_mean(preds),
        "confusion_matrix": evaluate.confusion_matrix(preds),
        "oof_true_pred_counts": evaluate.true_pred_counts(preds),
    }


def _train_final(dev: DataFrame, eva: DataFrame | None, p: JobParams) -> tuple[FittedModel, dict[str, DataFrame]]:
    cleaned, reports = clean_development(dev, eva, p)
    rows = sinks.stored(prepare(cleaned.withColumn("label", F.col("label").cast("int")), p.text), "prepared")
    f, linear, x, _ = _fit(rows, p, [-1])
    x.unpersist()
    sinks.discard(rows)
    return FittedModel(f, linear), reports


def train_final(dev: DataFrame, eva: DataFrame | None, p: JobParams = JobParams()) -> FittedModel:
    """One model on all rows of the cleaned table."""
    return _train_final(dev, eva, p)[0]


def run_cv(dev: DataFrame, eva: DataFrame | None, out: str, p: JobParams = JobParams()) -> DataFrame:
    """Cross-validate and write predictions, cleaning reports, metric tables and a summary under ``out``."""
    started = time.time()
    done = cross_validation(dev, eva, p)
    preds = done.preds
    sinks.write_csv(preds, f"{out}/oof_predictions")
    sinks.write_metrics(done.reports | evaluation_tables(preds), out)
    summary = evaluate.cv_summary(preds).first()
    sinks.write_summary(dev.sparkSession, {
        "stage": "cv", "k": p.k, "seed": p.seed, "model": asdict(p.model), "text": asdict(p.text),
        "n_dev": dev.count(), "n_eval": eva.count() if eva is not None else 0, "n_cleaned": preds.count(),
        "macro_f1_mean": summary["macro_f1_mean"], "macro_f1_std": summary["macro_f1_std"],
        # all folds are trained together, so they share passes and seconds
        "passes": done.model.passes, "converged": bool(done.model.converged.all()), "train_seconds": done.seconds,
        "total_seconds": time.time() - started,
    }, f"{out}/cv_summary")
    return preds


def train_and_score(dev: DataFrame, eva: DataFrame, out: str, p: JobParams = JobParams()) -> DataFrame:
    """Train on everything, save the model, score ``eva`` and write predictions, cleaning reports, label counts and a
    summary."""
    spark, started = dev.sparkSession, time.time()
    model, reports = _train_final(dev, eva, p)
    trained = time.time()
    model.save(spark, f"{out}/model")
    scored = sinks.stored(model.score(eva), "scored")
    sinks.write_predictions(scored, f"{out}/submission")
    counts = profile.pred_label_counts(scored)
    sinks.write_metrics(reports | {"pred_label_counts": counts}, out)
    sinks.write_summary(spark, {
        "stage": "final_train_and_predict", "model": asdict(p.model), "text": asdict(p.text),
        "n_dev": model.features.n_docs[-1], "n_eval": scored.count(), "passes": model.linear.passes,
        "converged": bool(model.linear.converged.all()), "train_seconds": trained - started,
        "predict_seconds": time.time() - trained, "total_seconds": time.time() - started,
        "model_path": f"{out}/model", "submission_path": f"{out}/submission",
    }, f"{out}/test_summary")
    return scored


def oof_tables(preds: DataFrame, k: int = 2) -> dict[str, DataFrame]:
    """Diagnostics of out-of-fold predictions: counts, the summary of precision and recall, and for the ``k`` weakest
    labels that have scores their score separation and histograms."""
    long = score_rows(preds)
    scored = [r["class"] for r in long.select("class").distinct().orderBy("class").collect()]  # one row a class
    weak = evaluate.weak_labels(preds, k, among=scored)
    names = [r["label"] for r in weak.collect()]
    return {
        "oof_counts": evaluate.oof_counts(preds), "pr_summary": evaluate.pr_summary(long, preds), "weak_labels": weak,
        "score_separation": evaluate.score_separation(long, names), "score_histogram": evaluate.score_histogram(long, names),
    }


def eda_tables(dev: DataFrame, eva: DataFrame | None) -> dict[str, DataFrame]:
    """All profiles of the labelled table, those that need no label of the other one, and their comparison.

    Each profile reads the table's columns it needs, so the tables should be columnar or cached, ``with_measures``.
    """
    free = {
        "missingness": lambda d: profile.missingness(without_measures(d)), "text_missingness": profile.text_missingness, "id_checks": profile.id_checks,
        "duplicate_counts": lambda d: profile.duplicate_counts(without_measures(d)), "timestamp_summary": profile.timestamp_summary,
        "counts_by_year": profile.counts_by_year, "counts_by_hour": profile.counts_by_hour,
        "text_length_summary": profile.text_length_summary, "pattern_prevalence": profile.pattern_prevalence,
        "source_pagerank": profile.source_pagerank, "shortest_longest": profile.shortest_longest,
        "random_sample": profile.random_sample, "gotchas": profile.gotchas,
        "table_profile": lambda d: profile.table_profile(without_measures(d)),
        "categorical_summary": lambda d: profile.categorical_summary(d, "source"),
        "numeric_summary": lambda d: profile.numeric_summary(d, "page_rank"),
    }
    labelled = {
        "label_summary": profile.label_summary, "majority_baseline": profile.majority_baseline,
        "missing_article_by_label": profile.missing_article_by_label, "missing_ts_by_label": profile.missing_timestamp_by_label,
        "label_ts_missingness": profile.label_timestamp_missingness, "label_text_missingness": profile.label_text_missingness,
        "label_text_lengths": profile.label_text_lengths, "label_pattern_prevalence": profile.label_pattern_prevalence,
        "label_year_counts": profile.label_time_counts, "label_month_counts": lambda d: profile.label_time_counts(d, "month"),
        "top_sources_per_label": profile.top_sources_per_label, "duplicate_groups": dedup.duplicate_groups,
        "duplicate_groups_near": lambda d: dedup.duplicate_groups(d, near_dup=True),
        "cross_label_dup_by_label": lambda d: dedup.cross_label_dup_by_label(d, near_dup=True),
        "cross_label_examples": lambda d: dedup.cross_label_examples(d, near_dup=True),
    }
    out = {name: fn(dev) for name, fn in (free | labelled).items()}
    if eva is not None:
        out |= {f"eval_{name}": fn(eva) for name, fn in free.items()}
        both = {
            "id_overlap": drift.id_overlap, "source_overlap": drift.source_overlap, "unseen_sources": drift.unseen_sources,
            "content_overlap": drift.content_overlap, "js_divergence": drift.js_divergence,
        }
        out |= {name: fn(dev, eva) for name, fn in both.items()}
        out["word_len_histogram"] = drift.word_len_histogram(dev)
        out["eval_word_len_histogram"] = drift.word_len_histogram(eva)
    return out


def run_eda(dev: DataFrame, eva: DataFrame | None, out: str) -> dict[str, str]:
    """Write all profiles under ``out``; the inputs are cached with their measures while that runs."""
    dev, eva = (df if df is None else with_measures(df).persist(StorageLevel.MEMORY_AND_DISK) for df in (dev, eva))
    cached = [df for df in (dev, eva) if df is not None]
    try:
        for df in cached:
            df.count()  # else several jobs would fill the same cache
        return sinks.write_metrics(eda_tables(dev, eva), out)
    finally:
        for df in cached:
            df.unpersist()


def run_oof_report(preds: DataFrame, out: str, k: int = 2) -> dict[str, str]:
    """Write the diagnostics of out-of-fold predictions under ``out``."""
    return sinks.write_metrics(oof_tables(preds, k), out)
