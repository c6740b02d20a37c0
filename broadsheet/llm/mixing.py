"""Mixing sources to target weights: capped water-filling, then seeded whole and fractional repetitions. JVM only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from broadsheet.llm.common import BLANKS, BLANK_CLASS, packed, plain, stored, text_of, unpacked, word_count

SALTS = 64
BUCKETS = 4096


def shuffle_key(seed: int, *columns: str) -> Column:
    """A non-negative 48-bit number from an md5 of the seed and the values; any engine with md5 gets the same one."""
    parts = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return F.conv(F.substring(F.md5(parts.cast("binary")), 1, 12), 16, 10).cast("bigint")


def _ranked(sources: DataFrame) -> DataFrame:
    """Sources numbered from 0 by code point, null last: range partitions give offsets, no task sorts them all."""
    dealt = sources.repartitionByRange(F.col("source").isNull(), "source").sortWithinPartitions(F.col("source").isNull(), "source")
    placed = stored(dealt.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "mix-placed")
    counts = placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # a row for each partition
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(F.broadcast(offsets), "part").withColumn("rank", F.col("offset") + inside)


def water_fill(sources: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), epochs: float = 3.0) -> DataFrame:
    """Add ``target`` to (source, source_size): shares of all sizes by weight, none above ``epochs`` times its size.

    Round by round, sources whose share is above their limit are fixed at it and the rest is shared again by weight,
    until no share is above its limit. A round is one aggregate; only three sums reach the driver. Sources of size 0
    are fixed at 0 by the first round.
    """
    table = _ranked(sources).select("source", "source_size", (F.pmod("rank", F.lit(len(weights)))).alias("slot"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("slot") + 1).cast("int"))
    table = stored(table.withColumn("weight", weight).withColumn("limit", F.lit(float(epochs)) * F.col("source_size")), "mix-sources")
    level, fixed = None, -1
    while True:
        clamped = F.lit(False) if level is None else F.col("weight") * F.lit(level) >= F.col("limit")
        total, held, free, n = table.agg(
            F.sum("source_size"), F.coalesce(F.sum(F.when(clamped, F.col("limit"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~clamped, F.col("weight"))), F.lit(0.0)), F.count(F.when(clamped, 1))).first()
        if n == fixed or not free:
            break
        # shares only grow from round to round, so what is fixed stays fixed
        fixed, level = n, max(0.0, (float(total or 0) - held) / free)
    share = F.col("weight") * F.lit(level if level is not None else 0.0)
    return table.select("source", "source_size", F.least("limit", share).alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = (5.0, 2.0, 1.0), epochs: float = 3.0, seed: int = 17) -> DataFrame:
    """(doc_id, source, size, source_size, target, whole, part, taken) of every row of ``docs`` (doc_id, source, text).

    A source's target, rounded to whole words, is its size times a whole number of repetitions plus a rest. The rest
    is filled with its documents in the order of a seeded hash; the document in which it ends gives only its first
    words. ``taken`` sums to the rounded target exactly, and no document gives more than ``epochs`` times its size.
    The order is made of hash buckets: their sums, at most 4,096 a source, show in which bucket the rest ends, and
    only that bucket's documents are sorted.

    Null text: size 0, nothing taken. Null source: a source of its own, last in order. Rows that repeat an id count
    each; equal rows are interchangeable. Empty table: no rows.
    """
    sized = stored(plain(docs, "doc_id", "source", "text").select(
        "doc_id", "source", word_count(text_of()).alias("size"), shuffle_key(seed, "doc_id").alias("key")), "mix-sizes")
    bucket = F.pmod("key", F.lit(BUCKETS)).cast("int")
    cells = stored(sized.groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words")), "mix-cells")
    sources = water_fill(cells.groupBy("source").agg(F.sum("words").alias("source_size")), weights, epochs)
    budget = F.round("target").cast("bigint")
    plan = sources.withColumn("whole", F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)))
    plan = stored(plan.withColumn("rest", budget - F.col("whole") * F.col("source_size")), "mix-plan")

    # the bucket in which each source's rest ends, and what the buckets before it hold
    running = Window.partitionBy("source").orderBy("bucket")
    # a source has at most 4,096 buckets, so this window is small however large the source
    sums = cells.select("source", "bucket", "words", F.sum("words").over(running).alias("upto"))
    ends = sums.join(plan, sums["source"].eqNullSafe(plan["source"])).where("upto - words < rest and upto >= rest").select(
        sums["source"].alias("s"), F.col("bucket").alias("end"), (F.col("rest") - F.col("upto") + F.col("words")).alias("left"))
    plan = stored(plan.join(ends, plan["source"].eqNullSafe(ends["s"]), "left").drop("s"), "mix-ends")

    salt = F.pmod(F.xxhash64("doc_id", "size"), F.lit(SALTS)).cast("int")
    spread = plan.select(F.col("source").alias("s"), "source_size", "target", "whole", "end", "left", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("t"))
    rows = sized.withColumn("salt", salt).withColumn("bucket", bucket)
    rows = rows.join(spread, F.col("source").eqNullSafe(F.col("s")) & (F.col("salt") == F.col("t"))).drop("s", "t", "salt")
    order = Window.partitionBy("source").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = rows.where("bucket = end").select(
        "*", F.greatest(F.lit(0), F.least("size", F.col("left") - F.coalesce(F.sum("size").over(order), F.lit(0)))).alias("part"))
    outside = rows.where("end is null or bucket != end").withColumn(
        "part", F.when(F.col("bucket") < F.col("end"), F.col("size")).otherwise(F.lit(0)))
    return outside.unionByName(inside).select(
        "doc_id", "source", "size", "source_size", "target", F.col("whole").cast("int").alias("whole"), F.col("part").cast("bigint").alias("part"),
        (F.col("size") * F.col("whole") + F.col("part")).cast("bigint").alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: rows of ``docs`` repeated as often as taken; a fractional repetition holds the first words taken.

    Joined by id and size; rows that repeat both are first made one. Columns are those of ``docs``, ``n_chars`` of a
    shortened text counted anew.
    """
    taken = mix(docs, **options).where("taken > 0").select("doc_id", "size", "whole", "part", "source").dropDuplicates(["doc_id", "size", "source"])
    taken = taken.select(F.col("doc_id").alias("_id"), F.col("size").alias("_size"), F.col("source").alias("_source"), "whole", "part")
    rows = packed(docs, "doc_id", "source", "text").withColumn("_words", word_count(text_of()))
    joined = rows.join(taken, F.col("doc_id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source")) & (F.col("_words") == F.col("_size")))
    copies = F.flatten(F.array(
        F.array_repeat(F.lit(-1).cast("bigint"), F.col("whole") + F.when(F.col("part") == F.col("_words"), 1).otherwise(0)),
        F.when((F.col("part") > 0) & (F.col("part") < F.col("_words")), F.array("part")).otherwise(F.array().cast("array<bigint>"))))
    out = joined.withColumn("_take", F.explode(copies))
    # a fractional repetition: the first words, parted by single spaces
    words = F.slice(F.split(F.btrim("text", F.lit(BLANKS)), BLANK_CLASS + "+"), F.lit(1), F.greatest(F.col("_take"), F.lit(0)).cast("int"))
    text = F.when(F.col("_take") >= 0, F.array_join(words, " ")).otherwise(F.col("text"))
    new = {"text": text}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.length(text).cast(docs.schema["n_chars"].dataType)
    return out.select(*unpacked(docs.columns, ("doc_id", "source", "text"), **new))
