"""Comparison of two tables: shared ids, sources and contents, and drift of distributions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from broadsheet.functions import text as X
from broadsheet.functions.times import eda_timestamp
from broadsheet.operators import measures as M
from broadsheet.operators.keyed import with_share
from broadsheet.sources.articles import whole_number

# Edges of the word-length bins; left-closed, the last bin closed.
WORD_EDGES = (0, 5, 10, 20, 40, 80, 160, 320, 10000)
EPS = 1e-12


def _both(dev: DataFrame, other: DataFrame) -> DataFrame:
    return dev.withColumn("in_dev", F.lit(1)).withColumn("in_eval", F.lit(0)).unionByName(
        other.withColumn("in_dev", F.lit(0)).withColumn("in_eval", F.lit(1))
    )


def _membership(dev: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of both tables and where they occur; one shuffle of keys already reduced per task."""
    return _both(dev, other).groupBy(*keys).agg(F.max("in_dev").alias("in_dev"), F.max("in_eval").alias("in_eval"))


def id_overlap(dev: DataFrame, other: DataFrame, c: str = "id") -> DataFrame:
    def keys(df: DataFrame) -> DataFrame:
        exact = isinstance(df.schema[c].dataType, IntegralType)
        return df.select((F.col(c).cast("bigint") if exact else whole_number(c)).alias("k")).dropna()

    found = _membership(keys(dev), keys(other), ["k"])
    return found.agg(F.count(F.when((F.col("in_dev") + F.col("in_eval")) == 2, 1)).alias("overlapping_ids"))


def source_overlap(dev: DataFrame, other: DataFrame) -> DataFrame:
    key = X.strip("source").alias("source")
    found = _membership(dev.select(key).dropna(), other.select(key).dropna(), ["source"])
    unseen = F.count(F.when(F.col("in_dev") == 0, 1))
    return found.agg(
        F.coalesce(F.sum("in_dev"), F.lit(0)).alias("dev_sources"),
        F.coalesce(F.sum("in_eval"), F.lit(0)).alias("eval_sources"),
        unseen.alias("unseen_in_dev"),
        (unseen / F.greatest(F.lit(1), F.sum("in_eval"))).alias("unseen_share"),
    )


def unseen_sources(dev: DataFrame, other: DataFrame, top: int = 15) -> DataFrame:
    key = X.strip("source").alias("source")
    found = _membership(dev.select(key).dropna(), other.select(key).dropna(), ["source"])
    return found.where("in_dev = 0").select("source").orderBy("source").limit(top)


def content_overlap(dev: DataFrame, other: DataFrame, cols: tuple[str, ...] = ("title", "article")) -> DataFrame:
    hashes = F.inline(F.array(*[F.struct(F.lit(c).alias("field"), X.text_hash(c).alias("h")) for c in cols]))
    found = _membership(dev.select(hashes), other.select(hashes), ["field", "h"])
    return found.groupBy("field").agg(
        F.count(F.when((F.col("in_dev") + F.col("in_eval")) == 2, 1)).alias("shared_hashes")
    )


def word_len_bin(words):
    """Index of the word-length bin, null beyond the last edge."""
    def choose(w):
        out = F.when(w == WORD_EDGES[-1], len(WORD_EDGES) - 2)
        for i, (low, high) in enumerate(zip(WORD_EDGES, WORD_EDGES[1:])):
            out = out.when((w >= low) & (w < high), i)
        return out

    # bound once as a lambda variable, so that the words are counted once per row
    return F.get(F.transform(F.array(words), choose), F.lit(0))


def word_len_histogram(df: DataFrame, cols: tuple[str, ...] = ("title", "article")) -> DataFrame:
    """Per text column, rows and density (rows over rows in range times bin width) per word-length bin that occurs."""
    cells = F.inline(F.array(*[F.struct(F.lit(c).alias("field"), word_len_bin(M.word_count(df, c)).alias("bin")) for c in cols]))
    counts = df.select(cells).where("bin is not null").groupBy("field", "bin").agg(F.count(F.lit(1)).alias("n"))
    edges = F.array(*[F.lit(e) for e in WORD_EDGES])
    left, right = F.get(edges, F.col("bin")), F.get(edges, F.col("bin") + 1)
    return with_share(counts, ["field"]).select(
        "field", "bin", left.alias("left"), right.alias("right"), "n", (F.col("share") / (right - left)).alias("density")
    )


def _binned(df: DataFrame) -> DataFrame:
    def cell(feature, value):
        return F.struct(F.lit(feature).alias("feature"), value.cast("double").alias("bin"))

    cells = [cell("page_rank", X.numeric_coerce("page_rank")), cell("timestamp.year", F.year(eda_timestamp("timestamp")))]
    cells += [cell(f"{c}.word_len", word_len_bin(M.word_count(df, c))) for c in ("title", "article")]
    return df.select(F.inline(F.array(*cells))).where("bin is not null")


def bin_alignment(dev: DataFrame, other: DataFrame) -> DataFrame:
    """Counts of both tables over the union of their bins, a missing bin counting 0, for every drift feature."""
    counts = _both(_binned(dev), _binned(other)).groupBy("feature", "bin").agg(
        F.sum("in_dev").alias("n_dev"), F.sum("in_eval").alias("n_eval")
    )
    widths = F.array(*[F.lit(float(b - a)) for a, b in zip(WORD_EDGES, WORD_EDGES[1:])])
    width = F.when(F.col("feature").endswith("word_len"), F.get(widths, F.col("bin").cast("int"))).otherwise(1.0)
    return counts.select("feature", "bin", width.alias("width"), "n_dev", "n_eval")


def js_divergence(dev: DataFrame, other: DataFrame) -> DataFrame:
    """Jensen-Shannon divergence (natural log) per feature, highest first.

    Word lengths are compared by density, not by share, before both sides are normalised. Bins empty on both sides are
    not listed; with the 1e-12 added to every bin they would change the result by no more than that.
    """
    cells = bin_alignment(dev, other)
    totals = cells.groupBy("feature").agg(F.sum("n_dev").alias("t_dev"), F.sum("n_eval").alias("t_eval"))
    cells = cells.join(totals, "feature").select(
        "feature", (F.col("n_dev") / F.col("t_dev") / F.col("width") + EPS).alias("p"),
        (F.col("n_eval") / F.col("t_eval") / F.col("width") + EPS).alias("q"),
    )
    sums = cells.groupBy("feature").agg(F.sum("p").alias("sp"), F.sum("q").alias("sq"))
    p, q = F.col("p") / F.col("sp"), F.col("q") / F.col("sq")
    m = 0.5 * (p + q)
    return cells.join(sums, "feature").groupBy("feature").agg(
        (0.5 * F.sum(p * F.log(p / m)) + 0.5 * F.sum(q * F.log(q / m))).alias("js_div")
    ).orderBy(F.desc("js_div"))
