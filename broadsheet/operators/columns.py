"""Metadata features: sources, page rank, calendar, missingness; fitted state and scaling."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions import text as X
from broadsheet.functions.times import PARTS, TIME_FEATURES, calendar_parts, parse_timestamp, time_features, timestamp_missing
from broadsheet.operators.keyed import hot_keys
from broadsheet.params import SourceParams

# Tokens for rare and missing sources; the dense features in vector order around the source block.
OTHER = "__OTHER__"
MISSING = "__MISSING__"
AFTER_SOURCE = ("page_rank", *TIME_FEATURES, "timestamp_missing", "article_missing")
DENSE = (*X.PATTERN_FEATURES, *AFTER_SOURCE)
UNSCALED = ("timestamp_missing",)


def source_value(c: str = "source") -> Column:
    s = X.strip(F.coalesce(F.col(c).cast("string"), F.lit("")))
    return F.when(s.isin("", X.MARKER), F.lit(MISSING)).otherwise(s)


def source_threshold(p: SourceParams, n: int) -> int:
    share = math.ceil(p.min_frac * n) if p.min_frac is not None else 1
    return max(1, share, p.min_count or 1)


def kept_sources(rows: DataFrame, p: SourceParams, models: list[int], n_docs: dict[int, int]) -> tuple[DataFrame, list[bool]]:
    """(value, k0, k1, ...): the sources that are frequent enough outside fold m for any model m, with a flag per model, and
    whether each model sees others. ``rows`` has ``source_value`` and ``fold``; of more than ``p.limit``, the most frequent
    (ties by value) are kept for all models, and the rest counts as rare; without a limit all are."""
    limits = {m: source_threshold(p, n_docs[m]) for m in models}
    n = {m: F.sum(F.when(F.col("fold") != m, 1).otherwise(0)) if m >= 0 else F.count(F.lit(1)) for m in models}
    counts = rows.groupBy(F.col("source_value").alias("value")).agg(*[n[m].alias(f"n{i}") for i, m in enumerate(models)])
    enough = [(F.col(f"n{i}") >= limits[m]).alias(f"k{i}") for i, m in enumerate(models)]
    counts = counts.select("*", *enough)
    any_enough = F.greatest(*[F.col(f"k{i}") for i in range(len(models))], F.lit(False))
    rare = [F.coalesce(F.max((F.col(f"n{i}") > 0) & ~F.col(f"k{i}")), F.lit(False)) for i in range(len(models))]
    *others, found = counts.agg(*rare, F.count(F.when(any_enough, 1))).first()
    flags = ["value", *[f"k{i}" for i in range(len(models))]]
    kept = counts.where(any_enough)
    if p.limit is not None and found > p.limit:
        largest = F.greatest(*[F.col(f"n{i}") for i in range(len(models))], F.lit(0))
        kept, others = kept.orderBy(F.desc(largest), "value").limit(p.limit), [True] * len(models)
    return kept.select(*flags), others


def fit_sources(df: DataFrame, p: SourceParams) -> DataFrame:
    """The sources (as ``value``) frequent enough to be kept, as ``kept_sources`` finds them for a model of all rows."""
    rows = df.select(source_value().alias("source_value"), F.lit(-1).alias("fold"))
    return kept_sources(rows, p, [-1], {-1: df.count()})[0].select("value")


def bin_sources(df: DataFrame, kept: DataFrame, out: str = "source_bin") -> DataFrame:
    """Replace sources that are not in ``kept`` by the token for rare ones.

    The most frequent sources, at most 1,024, are answered from a broadcast of that many rows, so one source with most
    of the rows does not end up in one task; Spark picks the join of the others by measured size.
    """
    keyed = df.withColumn("_value", source_value())
    marked = kept.select(F.col("value").alias("_kept"))
    counts = keyed.groupBy("_value").agg(F.count(F.lit(1)).alias("n"))
    hot = hot_keys(counts, "_value").select("_value").join(marked, F.col("_value") == F.col("_kept"), "left").select(
        F.col("_value").alias("_hot"), F.col("_kept").alias("_hot_kept"))
    tagged = keyed.join(F.broadcast(hot), F.col("_value") == F.col("_hot"), "left")
    # a leading line break never starts a stripped source, so spread rows match nothing
    spread = F.concat(F.lit("\n"), F.monotonically_increasing_id().cast("string"))
    probe = F.when(F.col("_hot").isNull(), F.col("_value")).otherwise(spread)
    joined = tagged.withColumn("_probe", probe).join(marked, F.col("_probe") == F.col("_kept"), "left")
    return joined.select(*df.columns, F.coalesce("_hot_kept", "_kept", F.lit(OTHER)).alias(out))


def raw_columns() -> list[Column]:
    """Per row, before fitting: 14 pattern features, page rank, calendar parts (null if missing), two flags."""
    parts = calendar_parts(parse_timestamp("timestamp"))
    return [
        *X.text_pattern_features("title", "article"),
        X.numeric_or_zero("page_rank").alias("page_rank"),
        *[part.cast("int").alias(f"ts_{name}") for name, part in parts.items()],
        timestamp_missing("timestamp").alias("timestamp_missing"),
        X.missing_indicator("article").alias("article_missing"),
    ]


def fit_time_fill(rows: DataFrame, by: list[str]) -> DataFrame:
    """Whole-number median of every calendar part over the valid rows. A part has at most a few hundred values, so the
    exact percentile's buffer is small."""
    return rows.groupBy(*by).agg(*[
        F.coalesce(F.percentile(F.col(f"ts_{p}"), 0.5).cast("int"), F.lit(default)).alias(p)
        for p, default in PARTS.items()
    ])


def dense_columns(fill: dict[str, Column]) -> list[Column]:
    """The dense features of one row in vector order, calendar gaps filled."""
    filled = {p: F.coalesce(F.col(f"ts_{p}"), fill[p]) for p in PARTS}
    return [
        *[F.col(c) for c in X.PATTERN_FEATURES], F.col("page_rank"), *time_features(filled),
        F.col("timestamp_missing"), F.col("article_missing"),
    ]


def fit_scales(rows: DataFrame, fill: dict[str, Column], by: list[str]) -> DataFrame:
    """Population deviation of every dense feature; 1 where it is constant or not scaled."""
    out = []
    for name, value in zip(DENSE, dense_columns(fill)):
        deviation = F.stddev_pop(value)
        scale = F.lit(1.0) if name in UNSCALED else F.when(deviation > 0, deviation).otherwise(1.0)
        out.append(scale.alias(name))
    return rows.groupBy(*by).agg(*out)


def timestamp_features(df: DataFrame, include_missing: bool = False) -> DataFrame:
    """id and the 12 time features, with gaps filled by the medians of the same table."""
    parts = calendar_parts(parse_timestamp("timestamp"))
    rows = df.select("id", *[part.cast("int").alias(f"ts_{n}") for n, part in parts.items()])
    fill = fit_time_fill(rows, []).first()
    filled = {p: F.coalesce(F.col(f"ts_{p}"), F.lit(fill[p])) for p in PARTS}
    missing = [F.col("ts_year").isNull().cast("double").alias("is_missing")] if include_missing else []
    return rows.select("id", *missing, *time_features(filled))


def scaled_columns(df: DataFrame) -> DataFrame:
    """id and the scaled dense features, fitted on the same table."""
    rows = df.select("id", *raw_columns())
    fill = {p: F.lit(v) for p, v in fit_time_fill(rows, []).first().asDict().items()}
    scales = fit_scales(rows, fill, []).first()
    return rows.select("id", *[(c / F.lit(scales[n])).alias(n) for n, c in zip(DENSE, dense_columns(fill))])
