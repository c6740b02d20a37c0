"""The features as stages for Spark ML pipelines: transformers for those that need no fitting, estimators for the others.

Each ``fit`` reads its input in one or two aggregates; the fitted stages add columns and keep all others. All stages have
Params and can be saved, alone or in a pipeline, and loaded by another session: settings as JSON, fitted tables as parquet.
"""

from __future__ import annotations

from dataclasses import asdict

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, StructType

from broadsheet.functions import canonical, text
from broadsheet.functions.times import PARTS, TIME_FEATURES, calendar_parts, parse_timestamp, time_features, timestamp_missing
from broadsheet.operators import columns as C
from broadsheet.operators import design, terms
from broadsheet.params import Ngrams, SourceParams
from broadsheet.sources.sinks import stored


def _param(name: str, doc: str) -> Param:
    return Param(Params._dummy(), name, doc)


class _Settings(DefaultParamsReadable, DefaultParamsWritable):
    """A stage whose whole state is in its Params."""

    def _given(self, **values) -> None:
        self._set(**{k: v for k, v in values.items() if v is not None})

    def value(self, name: str):
        return self.getOrDefault(name) if self.isDefined(name) else None


class _FittedWriter(MLWriter):
    def __init__(self, stage: "_Fitted"):
        super().__init__()
        self.stage = stage

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.stage, path, self.sparkSession)
        self.stage._table(self.sparkSession).write.parquet(f"{path}/data")


class _FittedReader(MLReader):
    def __init__(self, kind: type):
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> "_Fitted":
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        stage = self.kind()
        stage._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(stage, metadata)
        stage._restore(self.sparkSession.read.parquet(f"{path}/data"))
        return stage


class _Fitted(MLReadable, MLWritable):
    """A fitted stage that has a table besides its Params."""

    def write(self) -> MLWriter:
        return _FittedWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _FittedReader(cls)

    def value(self, name: str):
        return self.getOrDefault(name) if self.isDefined(name) else None


class _Adds(Transformer, _Settings):
    """Adds ``out``, computed from ``column``."""

    column = _param("column", "the column that is read")
    out = _param("out", "the column that is added")

    def __init__(self, column: str | None = None, out: str | None = None, **settings):
        super().__init__()
        self._given(column=column, out=out or column, **settings)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.value("out"), self._made(F.col(self.value("column"))))


class MissingIndicator(_Adds):
    """1.0 for null, blank or placeholder texts."""

    def _made(self, c):
        return text.missing_indicator(c)


class CanonicalText(_Adds):
    """The form that duplicates are found by."""

    def _made(self, c):
        return canonical.canonical_text(c)


class CleanText(_Adds):
    lowercase = _param("lowercase", "whether letters are made small")
    accents = _param("accents", "unicode, ascii or unset")

    def __init__(self, column: str | None = None, out: str | None = None, lowercase: bool = False, accents: str | None = None):
        super().__init__(column, out, lowercase=lowercase, accents=accents)

    def _made(self, c):
        return canonical.clean_text(c, lowercase=bool(self.value("lowercase")), accents=self.value("accents"))


class StripAdPrefix(_Adds):
    def _made(self, c):
        return text.strip_ad_prefix(c)


class TextColumn(_Adds):
    """The text; null, blank and placeholder texts become ``missingToken`` if that is set."""

    missingToken = _param("missingToken", "what stands for a missing text")

    def __init__(self, column: str | None = None, out: str | None = None, missing_token: str | None = None):
        super().__init__(column, out, missingToken=missing_token)

    def _made(self, c):
        return text.text_column(c, self.value("missingToken"))


class NumericCoerce(_Adds):
    """The number, or null."""

    def _made(self, c):
        return text.numeric_coerce(c)


class TimestampMissing(_Adds):
    """1.0 where no time can be read."""

    def _made(self, c):
        return timestamp_missing(c)


class JoinText(Transformer, _Settings):
    """Adds ``out``: the title some times, then the article, or a token where that is missing."""

    title = _param("title", "the column of titles")
    article = _param("article", "the column of articles")
    out = _param("out", "the column that is added")
    titleRepeat = _param("titleRepeat", "how often the title comes")
    missingToken = _param("missingToken", "what stands for a missing article")

    def __init__(self, title: str = "title", article: str = "article", out: str = "text", title_repeat: int = 2,
                 missing_token: str | None = text.MISSING_ARTICLE):
        super().__init__()
        self._given(title=title, article=article, out=out, titleRepeat=title_repeat)
        self._set(missingToken=missing_token)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        joined = text.join_text(self.value("title"), self.value("article"), self.value("titleRepeat"), self.value("missingToken"))
        return dataset.withColumn(self.value("out"), joined)


class TextPatterns(Transformer, _Settings):
    """Adds the 14 features of lengths and patterns."""

    title = _param("title", "the column of titles")
    article = _param("article", "the column of articles")

    def __init__(self, title: str = "title", article: str = "article"):
        super().__init__()
        self._given(title=title, article=article)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.select("*", *text.text_pattern_features(self.value("title"), self.value("article")))


class SourceBins(Estimator, _Settings):
    """Adds ``out``: the source if it was frequent enough in the fitted table, else the token for rare ones."""

    limits = _param("limits", "the fields of SourceParams")
    out = _param("out", "the column that is added")

    def __init__(self, params: SourceParams = SourceParams(), out: str = "source_bin"):
        super().__init__()
        self._given(limits=asdict(params), out=out)

    def _fit(self, dataset: DataFrame) -> "SourceBinsModel":
        return SourceBinsModel(stored(C.fit_sources(dataset, SourceParams(**self.value("limits"))), "sources"), self.value("out"))


class SourceBinsModel(Model, _Fitted):
    out = _param("out", "the column that is added")

    def __init__(self, kept: DataFrame | None = None, out: str = "source_bin"):
        super().__init__()
        self.kept = kept
        self._set(out=out)

    def _table(self, spark: SparkSession) -> DataFrame:
        return self.kept

    def _restore(self, table: DataFrame) -> None:
        self.kept = table

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return C.bin_sources(dataset, self.kept, self.value("out"))


class TimeFeatures(Estimator, _Settings):
    """Adds the 12 calendar features of ``column``; gaps take the medians of the fitted table."""

    column = _param("column", "the column of times as text")

    def __init__(self, column: str = "timestamp"):
        super().__init__()
        self._given(column=column)

    def _fit(self, dataset: DataFrame) -> "TimeFeaturesModel":
        parts = calendar_parts(parse_timestamp(self.value("column")))
        rows = dataset.select(*[p.cast("int").alias(f"ts_{n}") for n, p in parts.items()])
        return TimeFeaturesModel(self.value("column"), C.fit_time_fill(rows, []).first().asDict())


class TimeFeaturesModel(Model, _Settings):
    column = _param("column", "the column of times as text")
    fill = _param("fill", "what stands for missing calendar parts")

    def __init__(self, column: str | None = None, fill: dict[str, int] | None = None):
        super().__init__()
        self._given(column=column, fill=fill)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        parts, fill = calendar_parts(parse_timestamp(self.value("column"))), self.value("fill")
        filled = {n: F.coalesce(parts[n].cast("int"), F.lit(fill[n])) for n in PARTS}
        return dataset.select("*", *[f.alias(n) for f, n in zip(time_features(filled), TIME_FEATURES)])


class Scaled(Estimator, _Settings):
    """Divides number columns by their population deviation in the fitted table; constant ones stay."""

    names = _param("names", "the columns")

    def __init__(self, names: list[str] | None = None):
        super().__init__()
        self._given(names=names)

    def _fit(self, dataset: DataFrame) -> "ScaledModel":
        names = self.value("names")
        found = dataset.agg(*[F.stddev_pop(c).alias(c) for c in names]).first()
        return ScaledModel({c: found[c] or 1.0 for c in names})


class ScaledModel(Model, _Settings):
    scales = _param("scales", "the deviation of each column")

    def __init__(self, scales: dict[str, float] | None = None):
        super().__init__()
        self._given(scales=scales)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumns({c: F.col(c) / F.lit(s) for c, s in self.value("scales").items()})


class TfIdf(Estimator, _Settings):
    """Adds ``<name>_idx`` and ``<name>_val``: weights of a text's terms with unit length, terms in alphabetical order. A null
    text has no terms."""

    grams = _param("grams", "the fields of Ngrams")
    column = _param("column", "the column of texts")
    name = _param("name", "what the added columns begin with")
    maxDf = _param("maxDf", "the greatest share of texts that a term may be in")
    sublinear = _param("sublinear", "whether counts enter by their logarithm")
    stopWords = _param("stopWords", "words that are no terms")

    def __init__(self, grams: Ngrams | None = None, column: str = "text", name: str = "terms", max_df: float = 0.95,
                 sublinear: bool = True, stop_words: tuple[str, ...] | None = None):
        super().__init__()
        self._given(grams=asdict(grams) if grams else None, column=column, name=name, maxDf=max_df, sublinear=sublinear,
                    stopWords=list(stop_words) if stop_words else None)

    def _fit(self, dataset: DataFrame) -> "TfIdfModel":
        column, stop = self.value("column"), self.value("stopWords")
        docs = dataset.select(F.col(column), F.lit(-1).alias("fold"))
        block = terms.TermBlock.fit(
            self.value("name"), docs, column, Ngrams(**self.value("grams")), [-1], {-1: docs.count()}, self.value("maxDf"),
            tuple(stop) if stop else None)
        model = TfIdfModel(block)
        model._given(**{k: self.value(k) for k in ("grams", "column", "name", "sublinear", "stopWords")})
        return model


class TfIdfModel(Model, _Fitted):
    grams = _param("grams", "the fields of Ngrams")
    column = _param("column", "the column of texts")
    name = _param("name", "what the added columns begin with")
    sublinear = _param("sublinear", "whether counts enter by their logarithm")
    stopWords = _param("stopWords", "words that are no terms")

    def __init__(self, block: terms.TermBlock | None = None):
        super().__init__()
        self.block = block

    def _given(self, **values) -> None:
        self._set(**{k: v for k, v in values.items() if v is not None})

    def _table(self, spark: SparkSession) -> DataFrame:
        rows = [(i, t, float(w)) for i, (t, w) in enumerate(zip(self.block.terms, self.block.weights[0]))]
        return spark.createDataFrame(rows, "idx int, term string, weight double")

    def _restore(self, table: DataFrame) -> None:
        rows = table.orderBy("idx").collect()  # bounded by the vocabulary's limit
        weights = np.array([[r["weight"] for r in rows]])
        self.block = terms.TermBlock.of_terms(table.sparkSession, self.value("name"), [r["term"] for r in rows], weights)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        name, order, weights, sublinear = self.block.name, self.block.order, self.block.weights[0], bool(self.value("sublinear"))
        stop = self.value("stopWords")
        grams = terms.ngrams(self.value("column"), Ngrams(**self.value("grams")), tuple(stop) if stop else None)
        counted = self.block.count(dataset, grams)

        def run(batches):
            for b in batches:
                at = b.schema.get_field_index(f"{name}_tf")
                idx, lengths = design._lists(b.column(at).field("indices"))
                tf, _ = design._lists(b.column(at).field("values"))
                row, cols, vals = design._tfidf(
                    order[idx], tf, np.repeat(np.arange(b.num_rows), lengths), b.num_rows, weights, sublinear)
                ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=b.num_rows))]).astype(np.int32)
                rest = [(f, c) for i, (f, c) in enumerate(zip(b.schema.names, b.columns)) if i != at]
                yield pa.RecordBatch.from_arrays(
                    [c for _, c in rest] + [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (cols.astype(np.int32), vals)],
                    names=[f for f, _ in rest] + [f"{name}_idx", f"{name}_val"])

        schema = StructType(dataset.schema.fields)
        schema = schema.add(f"{name}_idx", ArrayType(IntegerType())).add(f"{name}_val", ArrayType(DoubleType()))
        return counted.mapInArrow(run, schema)
