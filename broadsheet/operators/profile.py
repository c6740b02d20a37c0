"""Profiles of one table. Every function returns a small table and reads its input in as few passes as it can."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.functions import text as X
from broadsheet.functions.times import PLACEHOLDERS, eda_timestamp
from broadsheet.operators import measures as M
from broadsheet.operators.folds import seeded_order
from broadsheet.operators.keyed import digest, exact_quantiles, with_share

# Percentiles of every numeric summary.
PERCENTILES = (0.01, 0.05, 0.25, 0.5, 0.75, 0.95, 0.99)
PERCENTILE_NAMES = ("p01", "p05", "p25", "p50", "p75", "p95", "p99")


def _rows() -> Column:
    return F.count(F.lit(1))


def _count_if(cond: Column) -> Column:
    return F.count(F.when(cond, F.lit(1)))


def _per_row(n: Column, rows: Column) -> Column:
    return n / F.greatest(F.lit(1), rows)


def _spread(df: DataFrame, structs: list[Column]) -> DataFrame:
    """One aggregate row of structs becomes one row per struct."""
    return df.agg(F.array(*structs).alias("r")).select(F.inline("r"))


TEXTS = M.TEXTS


def by_field(df: DataFrame, cols: tuple[str, ...], *keep: str) -> DataFrame:
    """(field, text) of several text columns in one pass, with the columns in ``keep``."""
    return df.select(*keep, F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("text")) for c in cols])))


def text_missing_flags(c: str) -> dict[str, Column]:
    s = F.col(c).cast("string")
    na = s.isNull()
    empty = X.is_blank(s)
    placeholder = X.is_any_of(s, (X.MARKER,))
    return {"na": na, "empty_str": empty, "placeholder": placeholder, "missing_like": na | empty | placeholder}


def missingness(df: DataFrame) -> DataFrame:
    """Per column: nulls, blank texts, placeholders and their union, as counts and shares; one pass for all columns."""
    out = []
    for field in df.schema.fields:
        c = field.name
        if c == "timestamp":
            flags = text_missing_flags(c)
            flags["placeholder"] = X.is_any_of(F.col(c).cast("string"), (*PLACEHOLDERS, X.MARKER))
            unparsed = eda_timestamp(F.col(c).cast("string")).isNull()
            flags["missing_like"] = unparsed | flags["empty_str"] | flags["placeholder"]
        elif isinstance(field.dataType, T.StringType):
            flags = text_missing_flags(c)
        else:
            na = F.col(c).isNull()
            flags = {"na": na, "empty_str": F.lit(False), "placeholder": F.lit(False), "missing_like": na}
        values = [F.lit(c).alias("col")]
        for name, cond in flags.items():
            values += [_count_if(cond).alias(name), _per_row(_count_if(cond), _rows()).alias(f"{name}_share")]
        out.append(F.struct(*values))
    return _spread(df, out).orderBy(F.desc("na"), F.desc("empty_str"), "col")


def text_missingness(df: DataFrame, cols: tuple[str, ...] = TEXTS) -> DataFrame:
    """Per text column: nulls, blank texts, placeholders and their union, as counts and shares."""
    return _spread(df, [
        F.struct(F.lit(c).alias("field"), *[
            e for name, cond in text_missing_flags(c).items()
            for e in (_count_if(cond).alias(name), _per_row(_count_if(cond), _rows()).alias(f"{name}_share"))
        ]) for c in cols
    ])


def _missing_by_label(df: DataFrame, missing: Column) -> DataFrame:
    counts = df.where(missing).groupBy("label").agg(_rows().alias("missing_count"))
    return with_share(counts, [], "missing_count", "share_of_missing")


def missing_article_by_label(df: DataFrame, c: str = "article") -> DataFrame:
    return _missing_by_label(df, X.missing_like(c))


def missing_timestamp_by_label(df: DataFrame, c: str = "timestamp") -> DataFrame:
    return _missing_by_label(df, eda_timestamp(c).isNull())


def label_timestamp_missingness(df: DataFrame, c: str = "timestamp") -> DataFrame:
    gone = eda_timestamp(c).isNull()
    return df.where("label is not null").groupBy("label").agg(
        _count_if(X.is_any_of(c, PLACEHOLDERS)).alias("placeholder"),
        _count_if(gone).alias("missing_like"),
        _rows().alias("total"),
        (_count_if(gone) / _rows()).alias("missing_like_share"),
    )


def label_text_missingness(df: DataFrame, cols: tuple[str, ...] = TEXTS) -> DataFrame:
    flags = text_missing_flags("text")
    return by_field(df.where("label is not null"), cols, "label").groupBy("field", "label").agg(
        *[_count_if(cond).alias(name) for name, cond in flags.items()], _rows().alias("total")
    )


def id_checks(df: DataFrame, c: str = "id") -> DataFrame:
    """Missing and repeated ids (a null is one value), and the range of numeric ids."""
    rows, present = _rows(), F.count(c)
    distinct = F.count_distinct(c) + F.when(rows > present, 1).otherwise(0)
    extra = [F.min(c).alias("id_min"), F.max(c).alias("id_max")]
    if isinstance(df.schema[c].dataType, T.StringType):
        extra = []
    return df.agg(
        rows.alias("rows"), (rows - present).alias("missing"), (rows - distinct).alias("duplicates"),
        F.count_distinct(c).alias("distinct_ids"), *extra,
    )


def duplicate_counts(df: DataFrame) -> DataFrame:
    """Rows beyond the first of their kind, over all columns, (title, article) and title; null equals null."""
    kinds = {"all_columns": df.columns, "title_article": ["title", "article"], "title": ["title"]}
    keys = df.select(*[digest(*cols).alias(kind) for kind, cols in kinds.items()])
    return _spread(keys, [
        F.struct(
            F.lit(kind).alias("kind"), (_rows() - F.count_distinct(kind)).alias("duplicates"),
            _per_row(_rows() - F.count_distinct(kind), _rows()).alias("share"),
        ) for kind in kinds
    ])


def categorical_summary(df: DataFrame, c: str, topn: int = 10) -> DataFrame:
    """The ``topn`` most frequent values (null included) with share, and the number of distinct non-null values."""
    counts = df.groupBy(F.col(c).alias("value")).agg(_rows().alias("n"))
    distinct = counts.agg(F.count("value")).scalar()
    total = counts.agg(F.sum("n")).scalar()
    top = counts.orderBy(F.desc("n"), F.asc_nulls_last("value")).limit(topn)
    return top.select("value", "n", (F.col("n") / total).alias("share"), distinct.alias("n_distinct"))


def _describe(df: DataFrame, c: str, exact: bool) -> list[Column]:
    value = F.col(c)
    picked = F.percentile if exact else F.percentile_approx
    quantiles = picked(value, F.array(*[F.lit(p) for p in PERCENTILES]))
    return [
        F.count(value).alias("count"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        *[quantiles[i].cast("double").alias(name) for i, name in enumerate(PERCENTILE_NAMES)],
        F.max(value).alias("max"),
    ]


def numeric_summary(df: DataFrame, c: str, mode: str = "distributed") -> DataFrame:
    """Count, mean, sample deviation, range and seven percentiles of a column coerced to numbers.

    ``distributed`` finds exact percentiles by bucketed ranking, whatever the number of distinct values.
    ``compact`` is exact as well but keeps the distinct values in one buffer (lengths, ranks); ``approx`` is not exact.
    """
    values = df.select(X.numeric_coerce(c).alias("v"))
    if mode != "distributed":
        return values.agg(*_describe(values, "v", mode == "compact"))
    moments = values.agg(
        F.count("v").alias("count"), F.avg("v").alias("mean"), F.stddev_samp("v").alias("std"),
        F.min("v").alias("min"), F.max("v").alias("max"),
    ).withColumn("_one", F.lit(1))
    ranks = exact_quantiles(values.withColumn("_one", F.lit(1)), ["_one"], "v", list(PERCENTILES))
    named = [F.col(f"q{i}").alias(name) for i, name in enumerate(PERCENTILE_NAMES)]
    return moments.join(ranks, "_one", "left").select("count", "mean", "std", "min", *named, "max")


def timestamp_summary(df: DataFrame, c: str = "timestamp") -> DataFrame:
    ts = eda_timestamp(c)
    placeholder = F.coalesce(F.col(c).isin(*PLACEHOLDERS), F.lit(False))
    return df.agg(
        _rows().alias("rows"), _count_if(placeholder).alias("placeholder"), _count_if(ts.isNull()).alias("invalid"),
        F.min(ts).alias("ts_min"), F.max(ts).alias("ts_max"),
    )


def counts_by_year(df: DataFrame, c: str = "timestamp") -> DataFrame:
    """Valid rows per year; the share is of all rows."""
    counts = df.groupBy(F.year(eda_timestamp(c)).alias("year")).agg(_rows().alias("n"))
    return with_share(counts, []).where("year is not null")


def counts_by_hour(df: DataFrame, c: str = "timestamp") -> DataFrame:
    """Valid rows per hour; the share is of the valid rows."""
    ts = eda_timestamp(c)
    counts = df.where(ts.isNotNull()).groupBy(F.hour(ts).alias("hour")).agg(_rows().alias("n"))
    return with_share(counts, [])


def text_length_summary(df: DataFrame, cols: tuple[str, ...] = TEXTS) -> DataFrame:
    """describe() of characters and words per text column. Lengths have few distinct values, so the compact percentile
    fits."""
    lengths = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("field"), F.lit(name).alias("measure"), count(df, c).alias("v"))
        for c in cols for name, count in (("chars", M.char_count), ("words", M.word_count))
    ])))
    return lengths.groupBy("field", "measure").agg(*_describe(lengths, "v", True))


def pattern_prevalence(df: DataFrame, cols: tuple[str, ...] = TEXTS) -> DataFrame:
    return _spread(df, [
        F.struct(F.lit(c).alias("field"), F.lit(name).alias("pattern"), _count_if(cond).alias("n"),
                 _per_row(_count_if(cond), _rows()).alias("share"))
        for c in cols for name, cond in M.pattern_flags(df, c).items()
    ]).orderBy("field", F.desc("share"), "pattern")


def label_pattern_prevalence(df: DataFrame, cols: tuple[str, ...] = TEXTS) -> DataFrame:
    flags = F.inline(F.array(*[
        F.struct(F.lit(c).alias("field"), found["contains_html_tag"].alias("html"), found["contains_url"].alias("url"))
        for c in cols for found in (M.pattern_flags(df, c),)
    ]))
    return df.where("label is not null").select("label", flags).groupBy("field", "label").agg(
        F.avg(F.col("html").cast("int")).alias("has_html"), F.avg(F.col("url").cast("int")).alias("has_url"))


def _ranks_per_source(df: DataFrame) -> DataFrame:
    pairs = df.select("source", X.numeric_coerce("page_rank").alias("page_rank")).dropna()
    return pairs.groupBy("source").agg(F.count_distinct("page_rank").alias("n_page_ranks"))


def source_pagerank(df: DataFrame, topn: int = 10) -> DataFrame:
    """Sources with more than one page rank, the ``topn`` most varied, and how many such sources there are."""
    ranks = _ranks_per_source(df)
    varying = ranks.where("n_page_ranks > 1")
    n_varying = varying.agg(_rows()).scalar()
    n_sources = df.agg(F.count_distinct("source")).scalar()
    return varying.orderBy(F.desc("n_page_ranks"), "source").limit(topn).select(
        "source", "n_page_ranks", n_varying.alias("n_varying"), n_sources.alias("n_sources")
    )


def label_summary(df: DataFrame) -> DataFrame:
    counts = df.groupBy("label").agg(_rows().alias("n"))
    return with_share(counts, [])


def majority_baseline(df: DataFrame) -> DataFrame:
    """Macro F1 of always answering the most frequent label; no row for a single label."""
    counts = df.groupBy("label").agg(_rows().alias("n"))
    p = F.max("n") / F.sum("n")
    k = F.count("label")
    return counts.agg(
        p.alias("majority_share"), k.alias("k"), (2.0 * p / (p + 1.0)).alias("f1_majority"),
        (2.0 * p / (p + 1.0) / k).alias("macro_f1"),
    ).where("k > 1")


def label_text_lengths(df: DataFrame, cols: tuple[str, ...] = TEXTS) -> DataFrame:
    lengths = df.where("label is not null").select("label", F.inline(F.array(*[
        F.struct(F.lit(c).alias("field"), M.char_count(df, c).alias("chars"), M.word_count(df, c).alias("words")) for c in cols])))
    out = [_rows().alias("n")]
    for m in ("chars", "words"):
        out.append(F.round(F.avg(m), 2).alias(f"{m}_mean"))
        out += [F.round(F.percentile(m, q), 2).alias(f"{m}_{name}") for q, name in ((0.5, "p50"), (0.9, "p90"))]
    return lengths.groupBy("field", "label").agg(*out)


def top_sources_per_label(df: DataFrame, topn: int = 5) -> DataFrame:
    from pyspark.sql.window import Window

    counts = df.where("label is not null").groupBy("label", F.coalesce("source", F.lit("")).alias("source")).agg(
        _rows().alias("n")
    )
    shares = with_share(counts, ["label"])
    order = Window.partitionBy("label").orderBy(F.desc("n"), "source")
    return shares.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= topn)


def label_time_counts(df: DataFrame, part: str = "year", max_rows: int = 60, c: str = "timestamp") -> DataFrame:
    """Valid rows per (label, year or month) with share of the label; the ``max_rows`` largest if there are more."""
    ts = eda_timestamp(c)
    value = {"year": F.year, "month": F.month}[part](ts)
    counts = df.where(ts.isNotNull() & F.col("label").isNotNull()).groupBy("label", value.alias(part)).agg(
        _rows().alias("n")
    )
    return with_share(counts, ["label"]).orderBy(F.desc("n"), "label", part).limit(max_rows).orderBy("label", part)


def shortest_longest(df: DataFrame, cols: tuple[str, ...] = TEXTS, k: int = 3) -> DataFrame:
    """The ``k`` shortest and ``k`` longest texts of each column; the lowest id wins ties.

    Tasks rank (id, length) and pass on ``k`` rows a column and end; the chosen ids pick their texts.
    """
    from pyspark.sql.window import Window

    sizes = df.select("id", F.inline(F.array(*[F.struct(F.lit(c).alias("field"), M.char_count(df, c).alias("chars")) for c in cols])))
    ends = sizes.select("*", F.inline(F.array(
        F.struct(F.lit("shortest").alias("kind"), F.col("chars").alias("_o")),
        F.struct(F.lit("longest").alias("kind"), (-F.col("chars")).alias("_o")))))
    order = Window.partitionBy("field", "kind").orderBy("_o", "id")
    picked = ends.withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= k).select("field", "kind", "id", "chars")
    # 2 * k rows a column
    texts = by_field(df, cols, "id").withColumnsRenamed({"id": "_id", "field": "_field"})
    joined = texts.join(F.broadcast(picked), (F.col("_id") == F.col("id")) & (F.col("_field") == F.col("field")))
    return joined.select("field", "kind", "id", "chars", X.shorten("text").alias("example"))


def random_sample(df: DataFrame, cols: tuple[str, ...] = TEXTS, k: int = 3, seed: int = 0, max_len: int = 220) -> DataFrame:
    """``k`` rows chosen by a seeded hash of the id, with all their texts: the same rows under any partitioning."""
    picked = df.select("id", *cols).orderBy(seeded_order(seed), "id").limit(k)
    return by_field(picked, cols, "id").select("field", "id", X.shorten("text", max_len).alias("example"))


def table_profile(df: DataFrame) -> DataFrame:
    """Rows, columns, types, and a fingerprint of the whole table that does not depend on row order: sum and exclusive or
    of 60 bits of each row's md5, over its values as text with their lengths."""
    types = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
    parts = [F.coalesce(F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string")), F.lit("-"))
             for c in df.columns]
    mark = F.conv(F.substring(F.md5(F.concat_ws("|", *parts).cast("binary")), 1, 15), 16, 10).cast("bigint")
    return df.select(mark.alias("_m")).agg(
        _rows().alias("rows"), F.lit(len(df.columns)).alias("n_cols"), F.lit(types).alias("columns"),
        F.bit_xor("_m").alias("fingerprint_xor"),
        F.sum(F.col("_m").cast("decimal(38,0)")).cast("string").alias("fingerprint_sum"),
    )


def gotchas(df: DataFrame) -> DataFrame:
    """Warning rules: what was measured, the threshold, and whether it fired."""
    zero = F.coalesce(F.col("timestamp") == PLACEHOLDERS[0], F.lit(False))
    rules = [("timestamp_placeholder", F.avg(zero.cast("int")), 0.01)]
    for c in ("title", "article"):
        flags = M.pattern_flags(df, c)
        rules.append((f"{c}_html", F.avg(flags["contains_html_tag"].cast("int")), 0.05))
        rules.append((f"{c}_url", F.avg(flags["contains_url"].cast("int")), 0.05))
    measured = _spread(df, [
        F.struct(F.lit(name).alias("rule"), value.alias("value"), F.lit(limit).alias("threshold"))
        for name, value, limit in rules
    ])
    varying = _ranks_per_source(df).agg(F.avg((F.col("n_page_ranks") > 1).cast("int")).alias("value")).select(
        F.lit("source_page_rank_varies").alias("rule"), "value", F.lit(0.001).alias("threshold")
    )
    return measured.unionByName(varying).withColumn("fired", F.coalesce(F.col("value") > F.col("threshold"), F.lit(False)))


def histogram(df: DataFrame, c: str, bins: int = 50, density: bool = False, by: list[str] | None = None) -> DataFrame:
    """Equal-width bins between minimum and maximum, the last one closed; empty bins are listed."""
    by = by or []
    values = df.select(*by, X.numeric_coerce(c).alias("v"))
    ranges = values.groupBy(*by).agg(F.min("v").alias("lo"), F.max("v").alias("hi"), F.count("v").alias("total"))
    flat = F.col("lo") == F.col("hi")
    ranges = ranges.where("lo is not null").select(
        *by, F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"), "total",
    )
    edge = lambda i: F.when(i >= bins, F.col("hi")).otherwise(
        F.col("lo") + i * ((F.col("hi") - F.col("lo")) / F.lit(float(bins))))
    if by:
        # groups are classes and sides of score columns: their number is bounded by the input's columns
        binned = values.join(F.broadcast(ranges), by)
    else:
        limits = ranges.select(F.struct("lo", "hi").alias("s")).scalar()
        binned = values.select("v", limits.alias("s")).select("v", "s.lo", "s.hi")
    guess = F.floor((F.col("v") - F.col("lo")) / (F.col("hi") - F.col("lo")) * F.lit(float(bins))).cast("int")
    binned = binned.withColumn("bin", F.least(guess, F.lit(bins - 1)))
    fixed = F.when(F.col("v") < edge(F.col("bin")), F.col("bin") - 1).when(
        (F.col("bin") < bins - 1) & (F.col("v") >= edge(F.col("bin") + 1)), F.col("bin") + 1
    ).otherwise(F.col("bin"))
    counts = binned.select(*by, fixed.alias("bin")).groupBy(*by, "bin").agg(_rows().alias("n"))
    grid = ranges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    out = grid.join(counts, [*by, "bin"], "left").withColumn("n", F.coalesce("n", F.lit(0).cast("bigint")))
    cols = [*by, "bin", edge(F.col("bin")).alias("left"), edge(F.col("bin") + 1).alias("right"), "n"]
    if density:
        cols.append((F.col("n") / (F.col("total") * (edge(F.col("bin") + 1) - edge(F.col("bin"))))).alias("density"))
    return out.select(*cols)


def top_bar_counts(df: DataFrame, c: Column | str, top: int = 15, by_value: bool = False) -> DataFrame:
    """The first ``top`` values of a non-null column, by count or by value."""
    counts = df.groupBy((F.col(c) if isinstance(c, str) else c).alias("value")).agg(_rows().alias("n"))
    order = ["value"] if by_value else [F.desc("n"), "value"]
    return counts.where("value is not null").orderBy(*order).limit(top)


def pred_label_counts(df: DataFrame, c: str = "prediction") -> DataFrame:
    return df.groupBy(F.col(c).cast("int").alias("label")).agg(_rows().alias("n")).orderBy("label")
