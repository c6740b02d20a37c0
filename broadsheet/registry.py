"""The registered queries: every operator on the given tables, whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.fixtures import news_dev, news_eval, predictions
from broadsheet.functions import canonical, text, times
from broadsheet.operators import dedup, drift, evaluate, folds, profile
from broadsheet.sources import articles, sinks

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[
        F.round(f.name, digits).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name)
        for f in df.schema.fields
    ])


def on_dev(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(fn(news_dev(spark, sf_dir)))


def on_both(fn: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(fn(news_dev(spark, sf_dir), news_eval(spark, sf_dir)))


def on_preds(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: rounded(fn(predictions(spark, sf_dir)))


def on_scores(fn: Callable[[DataFrame], DataFrame]) -> Query:
    return on_preds(lambda preds: fn(articles.score_rows(preds)))


# Sources and sinks

def _csv(spark: SparkSession, df: DataFrame, name: str) -> str:
    return sinks.write_csv(df, sinks.new_path(spark, name))


def scan_dev(spark, sf_dir):
    dev = news_dev(spark, sf_dir).withColumnRenamed("id", "Id")
    return articles.read_development(spark, _csv(spark, dev, "development.csv"))


def scan_eval(spark, sf_dir):
    return articles.read_evaluation(spark, _csv(spark, news_eval(spark, sf_dir), "evaluation.csv"))


def scan_dev_ranges(spark, sf_dir):
    """CSV files with line breaks in their texts, as many as there are tasks to write them, each read by ranges of 64 kB."""
    return articles.read_development(spark, _csv(spark, news_dev(spark, sf_dir), "whole.csv"), range_bytes=1 << 16)


def standardize_columns(spark, sf_dir):
    dev = news_dev(spark, sf_dir)
    raw = dev.toDF(*[" Id " if c == "id" else f" {c}" for c in dev.columns])
    return articles.standardize_columns(raw)


def na_tokens(spark, sf_dir):
    return articles.na_tokens_to_null(news_dev(spark, sf_dir)).select("id", "source", "title", "article", "timestamp")


def schema_check(spark, sf_dir):
    dev = articles.enforce_schema(news_dev(spark, sf_dir), articles.DEV_COLUMNS, "news_dev")
    return articles.schema_report(dev.drop("page_rank").withColumn("lang", F.lit("xx")), articles.DEV_COLUMNS)


def scan_predictions(spark, sf_dir):
    preds = predictions(spark, sf_dir).withColumnsRenamed({"label": "y_true", "pred": "prediction"})
    df = articles.score_rows(articles.read_predictions(spark, _csv(spark, preds, "oof.csv")))
    return df.select(
        F.col("id").cast("bigint"), F.col("label").cast("int"), F.col("pred").cast("int"), "class",
        F.round("score", 6).alias("score"),
    )


def write_predictions(spark, sf_dir):
    path = sinks.write_predictions(predictions(spark, sf_dir), sinks.new_path(spark, "submission.csv"), "pred")
    return spark.read.schema("Id bigint, Predicted int").csv(path, header=True)


def metric_sinks(spark, sf_dir):
    preds = predictions(spark, sf_dir)
    tables = {
        "folds": evaluate.fold_f1(preds), "per_class_mean": evaluate.per_class_mean(preds),
        "confusion_matrix": evaluate.confusion_matrix(preds), "oof_true_pred_counts": evaluate.true_pred_counts(preds),
        "pred_label_counts": profile.pred_label_counts(preds, "pred"),
    }
    paths = sinks.write_metrics(tables, sinks.new_path(spark, "metrics"))
    out = None
    for name, path in paths.items():
        back = spark.read.csv(path, header=True)
        cells = tables[name].select(*[F.col(c).cast("string") for c in tables[name].columns])
        # every row that only one side has, whatever its order
        odd = back.exceptAll(cells).unionByName(cells.exceptAll(back)).agg(F.count(F.lit(1)).alias("differing"))
        row = back.agg(F.count(F.lit(1)).alias("rows")).crossJoin(odd).select(  # one row each
            F.lit(name).alias("table_name"), "rows", F.lit(len(back.columns)).alias("n_cols"), "differing")
        out = row if out is None else out.unionByName(row)
    return out


def run_summary(spark, sf_dir):
    preds = predictions(spark, sf_dir)
    row = evaluate.cv_summary(preds).first()
    values = {"stage": "cv", "k": row["folds"], "n": preds.count(), "macro_f1_mean": round(row["macro_f1_mean"], 6)}
    return spark.read.schema("stage string, k bigint, n bigint, macro_f1_mean double").json(
        sinks.write_summary(spark, values, sinks.new_path(spark, "summary.json")))


# Joins

def union_folds(spark, sf_dir):
    """All folds' predictions are one table here, so their union is that table, read once."""
    return predictions(spark, sf_dir).groupBy("label", "pred").agg(F.count(F.lit(1)).alias("n"))


def row_rules() -> dict[str, list[Column]]:
    """Scalar rules, one value or a few per row."""
    T = text
    return {
        "missing_like": [*[T.missing_like(c).alias(c) for c in ("source", "title", "article")]],
        "missing_indicator": [T.missing_indicator("article").alias("article_missing")],
        "clean_text": [*[canonical.clean_text(c).alias(c) for c in ("title", "article")]],
        "strip_ad_prefix": [*[T.strip_ad_prefix(c).alias(c) for c in ("title", "article")]],
        "join_text": [T.join_text("title", "article", 2).alias("joined")],
        "text_column": [T.text_column("title").alias("title"),
                               T.text_column("article", T.MISSING_ARTICLE).alias("article")],
        "text_pattern_features": [*T.text_pattern_features()],
        "numeric_coerce": [T.numeric_or_zero("page_rank").alias("page_rank"),
                                  T.numeric_or_zero("source").alias("source_number"),
                                  T.numeric_or_zero(F.substring("timestamp", 1, 4)).alias("year_number")],
        "parse_timestamp": [times.parse_timestamp("timestamp").cast("string").alias("ts")],
        "timestamp_missing": [times.timestamp_missing("timestamp").alias("ts_missing")],
        "eda_timestamp": [times.eda_timestamp("timestamp").cast("string").alias("ts")],
        "normalize_near_dup": [*[T.normalize_near_dup(c).alias(c) for c in ("title", "article")]],
        "content_hash": [T.content_hash().alias("raw"), T.content_hash(near_dup=True).alias("near")],
        "text_lengths": [*[f(c).alias(f"{c}_{n}") for c in ("title", "article")
                                  for n, f in (("chars", T.char_count), ("words", T.word_count))]],
        "pattern_flags": [*[f.alias(f"{c}_{n}") for c in ("title", "article") for n, f in T.pattern_flags(c).items()]],
        "shorten": [T.shorten("article", 160).alias("article"), T.shorten("title", 40).alias("title")],
    }


ROW_RULES = (
    "missing_like", "missing_indicator", "clean_text", "strip_ad_prefix", "join_text", "text_column",
    "text_pattern_features", "numeric_coerce", "parse_timestamp", "timestamp_missing", "eda_timestamp",
    "normalize_near_dup", "content_hash", "text_lengths", "pattern_flags", "shorten",
)


def per_row(name: str) -> Query:
    return on_dev(lambda dev: dev.select("id", *row_rules()[name]))


def _kept(df: DataFrame) -> DataFrame:
    return df.select("id", "label", "source", "title")


def queries() -> dict[str, Query]:
    T = text
    found = {
        # sources and sinks
        "scan_dev": scan_dev,
        "scan_eval": scan_eval,
        "scan_dev_ranges": scan_dev_ranges,
        "standardize_columns": standardize_columns,
        "na_tokens": na_tokens,
        "schema_check": schema_check,
        "scan_predictions": scan_predictions,
        "write_predictions": write_predictions,
        "metric_sinks": metric_sinks,
        "run_summary": run_summary,
        # scalar rules
        **{name: per_row(name) for name in ROW_RULES},
        "canonical_text": on_both(lambda dev, eva: dev.select("id", "title", "article").unionByName(
            eva.select("id", "title", "article")).select(
            "id", *[canonical.canonical_text(c).alias(c) for c in ("title", "article")])),
        "clean_pages": lambda s, p: s.read.parquet(f"{p}/pages.parquet").select(
            "page_id", canonical.clean_text("html").alias("text")),
        "select_features": on_dev(lambda d: d.select(F.col("label").cast("int").alias("y"), *articles.EVAL_COLUMNS)),
        "filter_rows": on_dev(lambda d: d.where(
            T.missing_like("article") | times.eda_timestamp("timestamp").isNotNull()).select("id", "label")),
        # joins and sets
        "leakage_semi": on_both(lambda d, e: _kept(dedup.overlap_rows(d, e))),
        "leakage_anti": on_both(lambda d, e: _kept(dedup.without_overlap(d, e))),
        "cross_label_anti": on_dev(lambda d: _kept(dedup.without_cross_label(d))),
        "cross_label_rows": on_dev(lambda d: _kept(dedup.cross_label_rows(d))),
        "id_overlap": on_both(drift.id_overlap),
        "source_overlap": on_both(drift.source_overlap),
        "unseen_sources": on_both(drift.unseen_sources),
        "content_overlap": on_both(drift.content_overlap),
        "share_of_label": on_dev(lambda d: profile.with_share(
            d.groupBy("label", "page_rank").agg(F.count(F.lit(1)).alias("n")), ["label"])),
        "true_pred_counts": on_preds(evaluate.true_pred_counts),
        "bin_alignment": on_both(drift.bin_alignment),
        "union_folds": union_folds,
        # profiles
        "label_summary": on_dev(profile.label_summary),
        "majority_baseline": on_dev(profile.majority_baseline),
        "class_weights": on_dev(lambda d: folds.class_weight_table(d, 0.7)),
        "missingness": on_dev(profile.missingness),
        "missingness_eval": lambda s, p: rounded(profile.missingness(news_eval(s, p))),
        "text_missingness": on_dev(lambda d: profile.text_missingness(d)),
        "missing_article_by_label": on_dev(profile.missing_article_by_label),
        "missing_ts_by_label": on_dev(profile.missing_timestamp_by_label),
        "label_ts_missingness": on_dev(profile.label_timestamp_missingness),
        "label_text_missingness": on_dev(lambda d: profile.label_text_missingness(d)),
        "id_checks": on_dev(profile.id_checks),
        "duplicate_counts": on_dev(profile.duplicate_counts),
        "categorical_summary": on_dev(lambda d: profile.categorical_summary(d, "source")),
        "numeric_summary": on_dev(lambda d: profile.numeric_summary(d, "page_rank")),
        "numeric_summary_events": lambda s, p: rounded(
            profile.numeric_summary(s.read.parquet(f"{p}/events.parquet"), "value")),
        "numeric_summary_lineitem": lambda s, p: rounded(
            profile.numeric_summary(s.read.parquet(f"{p}/lineitem.parquet"), "l_extendedprice")),
        "categorical_summary_events": lambda s, p: rounded(
            profile.categorical_summary(s.read.parquet(f"{p}/events.parquet"), "user_id")),
        "timestamp_summary": on_dev(lambda d: profile.timestamp_summary(d).withColumns(
            {c: F.col(c).cast("string") for c in ("ts_min", "ts_max")})),
        "counts_by_year": on_dev(profile.counts_by_year),
        "counts_by_hour": on_dev(profile.counts_by_hour),
        "text_length_summary": on_dev(lambda d: profile.text_length_summary(d)),
        "pattern_prevalence": on_dev(lambda d: profile.pattern_prevalence(d)),
        "source_pagerank": on_dev(profile.source_pagerank),
        "label_text_lengths": on_dev(lambda d: profile.label_text_lengths(d)),
        "label_pattern_prevalence": on_dev(lambda d: profile.label_pattern_prevalence(d)),
        "label_year_counts": on_dev(lambda d: profile.label_time_counts(d, "year")),
        "label_month_counts": on_dev(lambda d: profile.label_time_counts(d, "month")),
        "duplicate_groups": on_dev(dedup.duplicate_groups),
        "duplicate_groups_near": on_dev(lambda d: dedup.duplicate_groups(d, near_dup=True)),
        "cross_label_dup_by_label": on_dev(lambda d: dedup.cross_label_dup_by_label(d, near_dup=True)),
        "leakage_report": on_both(lambda d, e: dedup.leakage_report(d, e, drop=True)),
        "dedup_report": on_dev(lambda d: dedup.dedup_report(d, drop_same_label=True)),
        "js_divergence": on_both(drift.js_divergence),
        "word_len_histogram": on_dev(lambda d: drift.word_len_histogram(d)),
        "table_profile": lambda s, p: profile.table_profile(s.read.parquet(f"{p}/documents.parquet")),
        "gotchas": on_dev(profile.gotchas),
        "histogram": on_dev(lambda d: profile.histogram(
            d.select(T.word_count("article").alias("w")), "w", 60)),
        "histogram_events": lambda s, p: rounded(
            profile.histogram(s.read.parquet(f"{p}/events.parquet"), "value", 50)),
        "top_bar_counts": on_dev(lambda d: profile.top_bar_counts(d, "source")),
        "top_bar_years": on_dev(lambda d: profile.top_bar_counts(
            d, F.year(times.eda_timestamp("timestamp")), by_value=True)),
        "pred_label_counts": on_preds(lambda p: profile.pred_label_counts(p, "pred")),
        # top-k, samples, folds
        "dedup_keep_first": on_dev(lambda d: _kept(dedup.keep_first(d))),
        "top_sources_per_label": on_dev(profile.top_sources_per_label),
        "shortest_longest": on_dev(lambda d: profile.shortest_longest(d)),
        "random_sample": on_dev(lambda d: profile.random_sample(d)),
        "cross_label_examples": on_dev(lambda d: dedup.cross_label_examples(d, near_dup=True)),
        "stratified_folds": on_dev(lambda d: folds.stratified_folds(d, 5, 42).select("id", "label", "fold")),
        "weak_labels": on_preds(lambda p: evaluate.weak_labels(p, 2)),
        # evaluation
        "fold_f1": on_preds(evaluate.fold_f1),
        "per_class_metrics": on_preds(evaluate.per_class_metrics),
        "per_class_mean": on_preds(evaluate.per_class_mean),
        "confusion_matrix": on_preds(lambda p: evaluate.confusion_matrix(p, [0, 1, 2, 3])),
        "cv_summary": on_preds(evaluate.cv_summary),
        "oof_counts": on_preds(evaluate.oof_counts),
        "pr_curve": on_scores(evaluate.pr_curve),
        "average_precision": on_scores(evaluate.average_precision),
        "best_f1_threshold": on_scores(evaluate.best_f1_threshold),
        "pr_summary": on_preds(lambda p: evaluate.pr_summary(articles.score_rows(p), p)),
        "score_separation": on_scores(evaluate.score_separation),
        "score_histogram": on_scores(lambda s: evaluate.score_histogram(s, ["0", "1"])),
    }
    from broadsheet import registry_features

    found.update(registry_features.queries())
    return found
