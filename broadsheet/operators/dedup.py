"""Overlap between two tables of articles, and duplicates inside one, on the canonical (title, article) pair."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.canonical import canonical_text
from broadsheet.functions.text import shorten
from broadsheet.operators.keyed import digest, flag_rows
from broadsheet.operators.measures import content_hash
from broadsheet.sources.sinks import stored

KEY = "_key"


def with_key(df: DataFrame, on: tuple[str, str] = ("title", "article"), **canonical) -> DataFrame:
    """Add a 256-bit digest of the canonical texts, so that shuffles carry 32 bytes instead of the texts."""
    if KEY in df.columns:
        return df
    missing = [c for c in on if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for duplicate detection: {missing}")
    return df.withColumn(KEY, digest(*[canonical_text(c, **canonical) for c in on]))


def _stored_key(df: DataFrame, **options) -> DataFrame:
    """The table with its key in shared storage: steps that read it twice normalise the texts once."""
    return df if KEY in df.columns else stored(with_key(df, **options), "keyed")


def _shared_keys(dev_keyed: DataFrame, other_keyed: DataFrame) -> DataFrame:
    """Keys of both tables with their rows ``n`` and ``n_other``; one shuffle of keys already reduced per task."""
    both = dev_keyed.select(KEY, F.lit(1).alias("d"), F.lit(0).alias("o")).unionByName(
        other_keyed.select(KEY, F.lit(0).alias("d"), F.lit(1).alias("o")))
    return both.groupBy(KEY).agg(F.sum("d").alias("n"), F.sum("o").alias("n_other"))


def flag_overlap(dev: DataFrame, other: DataFrame, flag: str = "in_eval", **options) -> DataFrame:
    """``dev`` (with its key) plus a flag: does the row's content occur in ``other``?"""
    keyed = _stored_key(dev, **options)
    keys = _shared_keys(keyed, with_key(other, **options)).where("n > 0")
    return flag_rows(keyed, keys.select(KEY, "n", (F.col("n_other") > 0).alias(flag)), KEY, flag)


def overlap_rows(dev: DataFrame, other: DataFrame, **options) -> DataFrame:
    return flag_overlap(dev, other, **options).where("in_eval").select(dev.columns)


def without_overlap(dev: DataFrame, other: DataFrame, **options) -> DataFrame:
    return flag_overlap(dev, other, **options).where("not in_eval").select(dev.columns)


def leakage_report(dev: DataFrame, other: DataFrame, drop: bool = False, **options) -> DataFrame:
    """One row: sizes and overlap. Only keys are matched, never rows."""
    both = _shared_keys(with_key(dev, **options), with_key(other, **options))
    n_dev = F.coalesce(F.sum("n"), F.lit(0))
    overlap = F.coalesce(F.sum(F.when(F.col("n_other") > 0, F.col("n"))), F.lit(0))
    removed = overlap if drop else F.lit(0).cast("bigint")
    return both.agg(
        n_dev.alias("n_dev_before"),
        F.coalesce(F.sum("n_other"), F.lit(0)).alias("n_eval"),
        overlap.alias("n_overlap_with_eval"),
        removed.alias("n_removed_from_dev"),
        (n_dev - removed).alias("n_dev_after"),
        (100.0 * overlap / F.greatest(F.lit(1), n_dev)).alias("pct_overlap_in_dev"),
        (100.0 * removed / F.greatest(F.lit(1), n_dev)).alias("pct_removed_from_dev"),
    )


def drop_overlap(dev: DataFrame, other: DataFrame, drop: bool = False, **options) -> tuple[DataFrame, DataFrame]:
    """(table, one-row report). Rows are removed only if ``drop``."""
    report = leakage_report(dev, other, drop, **options)
    return (without_overlap(dev, other, **options) if drop else dev), report


def _crossed() -> Column:
    """Do the labels of a group differ? A missing label counts as a value of its own."""
    known = F.count("label")
    return ((F.min("label") != F.max("label")) & (known > 0)) | ((known > 0) & (known < F.count(F.lit(1))))


def _label_stats(keyed: DataFrame) -> DataFrame:
    """Per key: rows, and whether its labels differ."""
    return keyed.groupBy(KEY).agg(F.count(F.lit(1)).alias("n"), F.coalesce(_crossed(), F.lit(False)).alias("crossed"))


def cross_label_rows(dev: DataFrame, **options) -> DataFrame:
    """Rows of duplicate groups that carry more than one label."""
    return _flag_cross_label(dev, **options).where("crossed_group").select(dev.columns)


def without_cross_label(dev: DataFrame, **options) -> DataFrame:
    return _flag_cross_label(dev, **options).where("not crossed_group").select(dev.columns)


def _flag_cross_label(dev: DataFrame, **options) -> DataFrame:
    keyed = _stored_key(dev, **options)
    return flag_rows(keyed, _label_stats(keyed).withColumnRenamed("crossed", "crossed_group"), KEY, "crossed_group")


def keep_first(dev: DataFrame, **options) -> DataFrame:
    """No cross-label group, and of every other duplicate group the row with the lowest id (ids are unique).

    One aggregation of (key, id, label) with buffers of fixed size, so that no text is sorted; the ids that stay pick
    their rows.
    """
    keys = with_key(dev, **options).groupBy(KEY).agg(F.min("id").alias("_first"), F.coalesce(_crossed(), F.lit(False)).alias("_crossed"))
    firsts = keys.where("not _crossed").select("_first")
    return dev.join(firsts, F.col("id") == F.col("_first"), "left_semi")


def dedup_report(dev: DataFrame, drop_same_label: bool = False, **options) -> DataFrame:
    """One row about duplicate groups and the rows removed."""
    stats = _label_stats(with_key(dev, **options))
    total = lambda cond, value: F.coalesce(F.sum(F.when(cond, value)), F.lit(0))
    dup, crossed = F.col("n") > 1, F.col("crossed")
    one, n = F.lit(1), F.col("n")
    before = F.coalesce(F.sum("n"), F.lit(0))
    cross_rows = total(crossed, n)
    same_removed = total(dup & ~crossed, n - 1) if drop_same_label else F.lit(0).cast("bigint")
    after = before - cross_rows - same_removed
    return stats.agg(
        before.alias("n_dev_before"),
        after.alias("n_dev_after"),
        total(dup, one).cast("bigint").alias("dup_groups"),
        total(crossed, one).cast("bigint").alias("cross_label_groups"),
        cross_rows.alias("cross_label_rows"),
        total(dup & ~crossed, one).cast("bigint").alias("same_label_groups"),
        total(dup & ~crossed, n).alias("same_label_rows"),
        cross_rows.alias("rows_removed_cross_label"),
        same_removed.alias("rows_removed_same_label"),
        (100.0 * (before - after) / F.greatest(F.lit(1), before)).alias("pct_removed_from_dev"),
    )


def drop_cross_label_duplicates(
    dev: DataFrame, drop_same_label: bool = False, **options
) -> tuple[DataFrame, DataFrame]:
    """(table, one-row report)."""
    if "label" not in dev.columns:
        raise ValueError("a label column is needed to compare duplicates by label")
    out = keep_first(dev, **options) if drop_same_label else without_cross_label(dev, **options)
    return out, dedup_report(dev, drop_same_label, **options)


# Profiling variants: raw or near-duplicate content hash, missing labels are no value.

def _hashed(df: DataFrame, near_dup: bool) -> DataFrame:
    return df.withColumn("content_hash", content_hash(df, near_dup))


def _all_hash_groups(hashed: DataFrame) -> DataFrame:
    return hashed.groupBy("content_hash").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("label").alias("low"),
        F.max("label").alias("high"),
    ).select("content_hash", "n", (F.col("low") != F.col("high")).alias("crossed"))


def _hash_groups(hashed: DataFrame) -> DataFrame:
    return _all_hash_groups(hashed).where("n > 1")


def duplicate_groups(df: DataFrame, near_dup: bool = False) -> DataFrame:
    """Groups and rows of duplicate content, split by whether labels agree."""
    groups = _all_hash_groups(_hashed(df, near_dup))
    count = lambda cond: F.count(F.when(cond, 1))
    rows = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0))
    any_, crossed = F.col("n") > 1, F.col("crossed")
    kinds = (("dup", any_), ("same_label", any_ & ~crossed), ("cross_label", any_ & crossed))
    # groups of one row count too, so the same aggregate knows the number of rows
    out = groups.agg(
        F.greatest(F.lit(1), F.sum("n")).alias("_n"),
        *[f(c).alias(f"{name}_{what}") for name, c in kinds for what, f in (("groups", count), ("rows", rows))]
    )
    return out.select(*[c for c in out.columns if c != "_n"], *[(F.col(f"{k}_rows") / F.col("_n")).alias(f"{k}_share") for k, _ in kinds])


def cross_label_dup_by_label(df: DataFrame, near_dup: bool = False) -> DataFrame:
    """Rows in cross-label groups per label, and their share of the label's rows."""
    per_group = _hashed(df, near_dup).groupBy("content_hash", "label").agg(F.count(F.lit(1)).alias("n"))
    crossed = per_group.groupBy("content_hash").agg(
        F.min("label").alias("low"), F.max("label").alias("high")
    ).where("low <> high").select("content_hash")
    # one row per (hash, label) is left, so no hash can dominate this join
    marked = per_group.join(crossed.withColumn("crossed", F.lit(True)), "content_hash", "left")
    by_label = marked.groupBy("label").agg(
        F.sum(F.when(F.col("crossed"), F.col("n"))).alias("cross_dup_rows"), F.sum("n").alias("total")
    )
    return by_label.where("cross_dup_rows > 0").select(
        "label", "cross_dup_rows", (F.col("cross_dup_rows") / F.col("total")).alias("share_of_label")
    )


def cross_label_examples(df: DataFrame, top: int = 5, near_dup: bool = False) -> DataFrame:
    """The ``top`` largest cross-label groups: rows per label and the title of the lowest id."""
    hashed = _hashed(df, near_dup)
    largest = _hash_groups(hashed).where("crossed").orderBy(F.desc("n"), "content_hash").limit(top)
    per_label = hashed.join(F.broadcast(largest.select("content_hash", "n")), "content_hash").groupBy(
        "content_hash", "n", "label"
    ).agg(F.count(F.lit(1)).alias("label_rows"), F.min(F.struct("id", "title")).alias("first"))
    return per_label.groupBy("content_hash", "n").agg(
        F.concat_ws(", ", F.transform(
            F.array_sort(F.collect_list(F.struct("label", "label_rows"))),
            lambda x: F.concat(x["label"].cast("string"), F.lit(": "), x["label_rows"].cast("string")),
        )).alias("labels"),
        F.min("first").alias("first"),
    ).select("content_hash", "n", "labels", shorten("first.title").alias("title"))
