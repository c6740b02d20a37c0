"""Exact duplicates: texts that are equal without white space, one row kept of each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import BLANK_CLASS, plain, stored, text_of

HOT = 4096


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_of(column), BLANK_CLASS + "+", "")


def _best() -> Column:
    """The longest original text first, then the smallest id; a null id comes last. A buffer of fixed size."""
    return F.max(F.struct(
        F.col("n_points"), F.col("doc_id").isNotNull().alias("has_id"), (-F.col("doc_id")).alias("neg_id"),
        F.col("doc_id").alias("id")))


def exact_duplicates(docs: DataFrame, digest_bytes: int = 16) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every row of ``docs`` (doc_id bigint, text).

    Rows are grouped by a 128-bit hash of the normalised text; of a group the row with the most code points in its
    original text, then the smallest id, is kept. Where a hash has several rows, every row's text is compared byte by
    byte with the kept row's; a hash under which texts differ is split by a 256-bit digest and the length, so that a
    collision never joins two texts. ``digest_bytes`` shortens the hash (tests force collisions with it).

    Null text: empty. Null id: a row like any other, kept only if no row of the same length has an id. Rows that
    repeat one id and text: all carry the same ``kept``. Empty table: no rows.
    """
    texts = plain(docs, "doc_id", "text").withColumn("norm", normalised()).select(
        "doc_id", F.length(text_of()).cast("bigint").alias("n_points"), "norm",
        F.substring(F.unhex(F.md5(F.col("norm").cast("binary"))), 1, digest_bytes).alias("key"))
    keyed = stored(texts.select(
        "doc_id", "n_points", "key", F.sha2(F.col("norm").cast("binary"), 256).alias("text_sha256"),
        F.length("norm").alias("n_norm")), "exact-keys")

    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), _best().alias("best")).where("n > 1")
    shared = stored(shared.select("key", "best.id", F.col("best.n_points").alias("points")), "exact-shared")
    # Only texts whose hash has several rows go on. Merge joins at every size, so that a plan seen on little data is
    # that for much; no aggregate stands over them, so a hot hash can be split.
    members = stored(texts.join(shared.hint("merge"), "key"), "exact-members")
    first = members.where(F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("n_points") == F.col("points")))
    first = stored(first.groupBy("key").agg(F.first("norm").alias("kept_norm")), "exact-first")
    differing = members.select("key", "norm").join(first.hint("merge"), "key").where("norm != kept_norm")
    collided = stored(stored(differing.select("key"), "exact-differing").distinct(), "exact-collided")

    split = F.when(F.col("differs"), F.concat("key", F.unhex("text_sha256"), F.unhex(F.hex("n_norm")))).otherwise(F.col("key"))
    rows = keyed.join(collided.withColumn("differs", F.lit(True)), "key", "left").select(
        "doc_id", "n_points", "text_sha256", split.alias("group"))
    groups = stored(rows.groupBy("group").agg(F.count(F.lit(1)).alias("size"), _best().alias("best")), "exact-groups")
    return _answered(rows, groups)


def _answered(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows with their group's answer. At most 4,096 groups can hold a 4,096th of the rows each: these are answered
    from a broadcast, and the join of the others has no hot key."""
    total = groups.agg(F.sum("size")).first()[0] or 0
    hot = groups.where(F.col("size") * HOT >= F.lit(total)).where("size > 1")
    cold = groups.where(~((F.col("size") * HOT >= F.lit(total)) & (F.col("size") > 1)))
    tagged = rows.join(F.broadcast(hot.select("group", F.col("size").alias("hot_size"), F.col("best").alias("hot_best"))), "group", "left")
    tagged = tagged.withColumn("probe", F.when(F.col("hot_size").isNull(), F.col("group")))
    # a null probe meets nothing, so rows of hot groups stay where the outer join deals them by their own id
    probe = F.coalesce("probe", F.concat(F.lit("-"), F.xxhash64("doc_id", "n_points").cast("string")).cast("binary"))
    joined = tagged.withColumn("probe", probe).join(cold.withColumnRenamed("group", "probe"), "probe", "left")
    size, best = F.coalesce("hot_size", "size"), F.coalesce("hot_best", "best")
    return joined.select("doc_id", "n_points", "text_sha256", size.alias("size"), best.alias("best")).select(
        "doc_id", F.col("best.id").alias("keep_id"), F.col("size").cast("bigint").alias("group_size"),
        (F.col("doc_id").eqNullSafe(F.col("best.id")) & (F.col("n_points") == F.col("best.n_points"))).alias("kept"),
        "text_sha256")
