"""Registered queries of the feature, training and scoring operators."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.fixtures import news_dev, news_eval, predictions
from broadsheet.operators import columns as C
from broadsheet.operators import design as D
from broadsheet.operators import evaluate
from broadsheet.operators import terms as W
from broadsheet.params import CHARS, PLAIN, TITLE, WORDS, JobParams, ModelParams, Ngrams, TextParams
from broadsheet.plans import jobs
from broadsheet.sources import sinks

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.round(f.name, 6).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f.name)
        for f in df.schema.fields
    ])


def _term_table(grams: Ngrams) -> Query:
    def run(spark, sf_dir):
        docs = news_dev(spark, sf_dir).withColumn("fold", F.lit(-1)).withColumn("text", W.document_text(TextParams()))
        stats = W.term_stats(docs.select("fold", "text"), grams, [-1])
        return stats.select("term", F.col("tf_all").alias("tf"), F.col("df_all").alias("df"))

    return run


def vocabulary(spark, sf_dir):
    p = TextParams()
    docs = news_dev(spark, sf_dir).withColumn("fold", F.lit(-1)).withColumn("text", W.document_text(p)).select("fold", "text")
    n = docs.count()
    stats = W.term_stats(docs, p.words, [-1])
    return W.vocabulary(stats, -1, n, p.words.min_df, p.max_df, p.words.limit)


def _weights(block: str, p: TextParams) -> Query:
    return lambda spark, sf_dir: _rounded(D.term_weights(news_dev(spark, sf_dir), JobParams(text=p), block))


def source_binner(spark, sf_dir):
    dev = news_dev(spark, sf_dir)
    return C.bin_sources(dev.select("id", "source"), C.fit_sources(dev, JobParams().source)).select("id", "source_bin")


def source_onehot(spark, sf_dir):
    """(id, category) of every 1 in the one-hot block: sources kept in the labelled table, applied to the unlabelled one."""
    dev, eva = news_dev(spark, sf_dir), news_eval(spark, sf_dir)
    kept = C.fit_sources(dev, JobParams().source)
    seen = C.bin_sources(dev.select("id", "source"), kept).select("source_bin").distinct()
    return C.bin_sources(eva.select("id", "source"), kept).join(seen, "source_bin", "left_semi").select(
        "id", F.col("source_bin").alias("category"))


def assemble(spark, sf_dir):
    """Per row: number of features set, and squared length of the text blocks."""
    p = JobParams()
    rows = sinks.stored(D.prepare(news_dev(spark, sf_dir), p.text), "prepared")
    f = D.fit_features(rows, p, [-1])
    text_size = sum(len(b.terms) for b in f.blocks)
    squares = F.zip_with("idx", "val", lambda i, v: F.when(i < text_size, v * v).otherwise(0.0))
    squared = F.aggregate(squares, F.lit(0.0), lambda a, x: a + x)
    return D.design(rows, f).select("id", "label", F.size("idx").alias("n_set"), F.round(squared, 6).alias("text_norm"))


def _trained(kind: str) -> Query:
    """Rows trained on per label, and whether the gradients of all problems have shrunk by the tolerance."""
    def run(spark, sf_dir):
        dev = news_dev(spark, sf_dir)
        p = JobParams(model=ModelParams(type=kind))
        cleaned, _ = jobs.clean_development(dev, news_eval(spark, sf_dir), p)
        model = jobs.train_final(dev, news_eval(spark, sf_dir), p)
        trained = model.score(cleaned).select("id").join(cleaned.select("id", "label"), "id")
        return trained.groupBy("label").agg(F.count(F.lit(1)).alias("n")).withColumn(
            "converged", F.lit(bool(model.linear.converged.all())))

    return run


def _answers(scored: DataFrame, model) -> DataFrame:
    return scored.select(
        "id", F.size("scores").alias("n_scores"), F.col("prediction").isin(model.linear.classes).alias("known_class"),
        F.lit(bool(model.linear.converged.all())).alias("converged"))


def predict(spark, sf_dir):
    eva = news_eval(spark, sf_dir)
    model = jobs.train_final(news_dev(spark, sf_dir), eva, JobParams(model=ModelParams(type="ridge")))
    return _answers(model.score(eva), model)


def _validated(dev: DataFrame, eva: DataFrame | None, p: JobParams) -> DataFrame:
    done = jobs.cross_validation(dev, eva, p)
    return evaluate.fold_f1(done.preds).select(
        "fold", "n_valid", "n_train", F.col("macro_f1").between(0, 1).alias("in_range"),
        F.lit(bool(done.model.converged.all())).alias("converged"))


def cross_validate(spark, sf_dir):
    return _validated(news_dev(spark, sf_dir), news_eval(spark, sf_dir), JobParams())


def train_and_score(spark, sf_dir):
    """The summary that the job writes, and the rows it scored."""
    out = sinks.new_path(spark, "run")
    p = JobParams(model=ModelParams(type="logreg"), drop_overlap=True, drop_same_label=True)
    scored = jobs.train_and_score(news_dev(spark, sf_dir), news_eval(spark, sf_dir), out, p)
    written = spark.read.json(f"{out}/test_summary").select("n_dev", "n_eval", "converged")
    return written.crossJoin(scored.agg(F.count(F.lit(1)).alias("n_scored")))  # one row each


def plain_cv(spark, sf_dir):
    return _validated(news_dev(spark, sf_dir), None, replace(PLAIN, model=replace(PLAIN.model, type="ridge")))


def plain_train_predict(spark, sf_dir):
    """Train without cleaning, save, load as a separate job would, and score."""
    p = replace(PLAIN, model=replace(PLAIN.model, type="ridge"))
    path = sinks.new_path(spark, "model")
    model = jobs.train_final(news_dev(spark, sf_dir), None, p)
    model.save(spark, path)
    return _answers(jobs.FittedModel.load(spark, path).score(news_eval(spark, sf_dir)), model)


def model_save_load(spark, sf_dir):
    """Rows scored by a model and by its saved and loaded copy, and how many of them differ in prediction or scores."""
    eva = news_eval(spark, sf_dir)
    model = jobs.train_final(news_dev(spark, sf_dir), eva, JobParams(model=ModelParams(type="ridge")))
    path = sinks.new_path(spark, "model")
    model.save(spark, path)
    again = jobs.FittedModel.load(spark, path).score(eva).select(
        "id", F.col("prediction").alias("again"), F.col("scores").alias("scores_again"))
    apart = F.exists(F.zip_with("scores", "scores_again", lambda a, b: F.abs(a - b)), lambda d: d > 1e-9)
    both = model.score(eva).join(again, "id")
    return both.agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when((F.col("prediction") != F.col("again")) | apart, 1)).alias("differing"))


def pipeline_model(spark, sf_dir):
    """Columns added by a pipeline of stages that was fitted, saved and loaded again."""
    from pyspark.ml import Pipeline, PipelineModel

    from broadsheet.operators import stages as S

    dev = news_dev(spark, sf_dir)
    stages = [S.JoinText(out="joined"), S.MissingIndicator("article", "article_missing"), S.TextPatterns(), S.SourceBins(JobParams().source),
              S.TfIdf(WORDS, "joined", "word")]
    path = sinks.new_path(spark, "pipeline")
    Pipeline(stages=stages).fit(dev).save(path)
    out = PipelineModel.load(path).transform(dev)
    squares = F.aggregate("word_val", F.lit(0.0), lambda a, v: a + v * v)
    return out.select("id", "joined", "article_missing", *C.X.PATTERN_FEATURES, "source_bin",
                      (F.abs(squares - 1.0) < 1e-9).alias("unit_length"))


def _row_counts(spark, paths: dict[str, str]) -> DataFrame:
    out = None
    for name, path in paths.items():
        # only rows are counted; with a schema, no job reads the header first
        part = spark.read.schema("first string").csv(path, header=True, multiLine=True, quote='"', escape='"').agg(
            F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = part if out is None else out.unionByName(part)
    return out


def eda_report(spark, sf_dir):
    """Tables that the profiling job wrote, and their rows."""
    return _row_counts(spark, jobs.run_eda(news_dev(spark, sf_dir), news_eval(spark, sf_dir), sinks.new_path(spark, "eda")))


def oof_report(spark, sf_dir):
    return _row_counts(spark, jobs.run_oof_report(predictions(spark, sf_dir), sinks.new_path(spark, "oof")))


def feature_cache(spark, sf_dir):
    """The prepared table written to shared storage once and read back, per fold."""
    from broadsheet.operators.folds import stratified_folds

    folded = stratified_folds(news_dev(spark, sf_dir), 5, 42)
    rows = sinks.stored(D.prepare(folded, TextParams()), "prepared")
    return rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars"))


def fitted_cache(spark, sf_dir):
    """Per model the documents of features fitted twice with a cache, and whether the second came from it, unchanged."""
    from broadsheet.plans import cache

    p = JobParams(text=TextParams(chars=None), cache=sinks.new_path(spark, "features"))
    rows = sinks.stored(D.prepare(news_dev(spark, sf_dir), p.text), "prepared")
    first = cache.fitted(rows, p, [-1])
    entry = f"{p.cache}/features-{cache.entry_name(rows.repartition(3), p, [-1])}"
    again = cache.find(spark, entry)
    same = again is not None and again.names() == first.names() and all(
        (a.weights == b.weights).all() for a, b in zip(first.blocks, again.blocks))
    none = cache.find(spark, f"{p.cache}/features-{cache.entry_name(rows.limit(1), p, [-1])}")
    out = [(first.n_docs[-1], len(first.blocks[0].terms), same, none is None)]
    return spark.createDataFrame(out, "n_docs bigint, n_terms bigint, found boolean, other_not_found boolean")


def queries() -> dict[str, Query]:
    return {
        "timestamp_features": lambda s, p: _rounded(C.timestamp_features(news_dev(s, p), include_missing=True)),
        "word_ngrams": _term_table(WORDS),
        "char_wb_ngrams": _term_table(CHARS),
        "vocabulary": vocabulary,
        "tfidf": _weights("word", TextParams()),
        "title_char_tfidf": _weights("title", TextParams(title=TITLE)),
        "source_binner": source_binner,
        "source_onehot": source_onehot,
        "scale_no_mean": lambda s, p: _rounded(C.scaled_columns(news_dev(s, p))),
        "assemble": assemble,
        "feature_cache": feature_cache,
        "fitted_cache": fitted_cache,
        "train_linearsvc": _trained("linearsvc"),
        "train_logreg": _trained("logreg"),
        "train_ridge": _trained("ridge"),
        "predict": predict,
        "cross_validate": cross_validate,
        "train_and_score": train_and_score,
        "plain_cv": plain_cv,
        "plain_train_predict": plain_train_predict,
        "model_save_load": model_save_load,
        "pipeline_model": pipeline_model,
        "eda_report": eda_report,
        "oof_report": oof_report,
    }
