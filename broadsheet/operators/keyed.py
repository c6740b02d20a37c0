"""Building blocks for grouping and matching that keep every task small when one key holds much of the data."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The 1,024 most frequent keys are matched through a broadcast of at most that many rows. Any key outside them holds
# less than 1/1,024 of the rows. At very large sizes that share is still much for one task; Spark's adaptive execution
# splits such partitions of the join, over which no aggregate stands.
HOT_KEYS = 1024


def digest(*cols: Column | str) -> Column:
    """256-bit key of several nullable values; lengths keep neighbouring values apart, nulls equal nulls only."""
    parts = []
    for c in cols:
        s = (F.col(c) if isinstance(c, str) else c).cast("string")
        parts.append(F.coalesce(F.concat(F.length(s).cast("string"), F.lit(":"), s), F.lit("-")))
    # never null, and said so: a join would otherwise filter on it and evaluate the whole expression once more
    return F.coalesce(F.unhex(F.sha2(F.concat_ws("|", *parts), 256)), F.lit(b""))


def hot_keys(counts: DataFrame, key: str, n: str = "n") -> DataFrame:
    return counts.orderBy(F.desc(n), F.asc(key)).limit(HOT_KEYS)


def flag_rows(rows: DataFrame, keys: DataFrame, key: str, flag: str) -> DataFrame:
    """Add the flag of its key to every row.

    ``keys`` has every key of ``rows`` once, with its number of rows ``n`` and the boolean ``flag``. Rows with a hot
    key take their flag from a broadcast of at most ``HOT_KEYS`` rows and are spread over the join by a key that
    matches nothing; of the other keys only the flagged ones are joined.
    """
    hot = hot_keys(keys, key).select(F.col(key).alias("_hot"), F.col(flag).alias("_hot_flag"))
    tagged = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot"), "left")
    tagged = tagged.withColumn(
        "_probe",
        F.when(F.col("_hot").isNull(), F.col(key)).otherwise(F.unhex(F.hex(F.monotonically_increasing_id()))),
    )
    # n is tested so that both uses of ``keys`` need the same columns and Spark runs its aggregate once
    cold = keys.where(F.col(flag) & (F.col("n") > 0)).select(F.col(key).alias("_member"), F.lit(True).alias("_in"))
    joined = tagged.join(cold, F.col("_probe") == F.col("_member"), "left")
    answer = F.coalesce("_hot_flag", "_in", F.lit(False))
    return joined.select(*[F.col(c) for c in rows.columns], answer.alias(flag))


def with_share(counts: DataFrame, by: list[str], n: str = "n", share: str = "share") -> DataFrame:
    """Divide ``n`` by its total over ``by`` (over everything if empty). ``counts`` is an aggregate, not row data."""
    if not by:
        total = counts.agg(F.sum(n)).scalar()
        return counts.withColumn(share, F.col(n) / total)
    totals = counts.groupBy(*[F.col(c).alias(f"_t_{c}") for c in by]).agg(F.sum(n).alias("_total"))
    same = [F.col(c).eqNullSafe(F.col(f"_t_{c}")) for c in by]
    joined = counts.join(totals, same, "left")
    return joined.select(*counts.columns, (F.col(n) / F.col("_total")).alias(share))


def running_totals(
    df: DataFrame, by: list[str], order: str, sums: list[str], descending: bool = False, buckets: int | None = None
) -> DataFrame:
    """Inclusive running sums of ``sums`` per ``by`` along ``order``, as ``cum_<name>``, and the group's ``total_<name>``.

    ``df`` holds one row per (by, order), ``by`` without nulls. No group is sorted in one task: ``order`` is cut into buckets at approximate
    quantiles (as many as the session's shuffle can use), bucket totals give every bucket its offset, and the fine
    window runs inside (by, bucket).
    """
    spark = df.sparkSession
    buckets = buckets or max(64, 2 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = df.agg(F.percentile_approx(order, [i / buckets for i in range(1, buckets)], 10 * buckets)).first()[0]
    splits = [-math.inf, *sorted({float(c) for c in cuts or [0.0]}), math.inf]
    # a binary search per row in the JVM; the cuts are literals, so every use of the buckets sees the same ones
    cutter = Bucketizer(splits=splits, inputCol="_order", outputCol="_at", handleInvalid="keep")
    bucketed = cutter.transform(df.withColumn("_order", F.col(order).cast("double")))
    bucketed = bucketed.select(*df.columns, (-F.col("_at") if descending else F.col("_at")).alias("_bucket"))

    totals = bucketed.groupBy(*by, "_bucket").agg(*[F.sum(s).alias(f"_sum_{s}") for s in sums])
    group = Window.partitionBy(*by)
    before = group.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_bucket",
        *[F.coalesce(F.sum(f"_sum_{s}").over(before), F.lit(0)).alias(f"_off_{s}") for s in sums],
        *[F.sum(f"_sum_{s}").over(group).alias(f"total_{s}") for s in sums],
    )
    direction = F.desc(order) if descending else F.asc(order)
    inside = Window.partitionBy(*by, "_bucket").orderBy(direction).rowsBetween(Window.unboundedPreceding, 0)
    local = bucketed.select("*", *[F.sum(s).over(inside).alias(f"_in_{s}") for s in sums])
    # joined on the window's own partitioning, so the rows are not shuffled again
    return local.join(offsets, [*by, "_bucket"]).select(
        *df.columns, *[(F.col(f"_in_{s}") + F.col(f"_off_{s}")).alias(f"cum_{s}") for s in sums],
        *[f"total_{s}" for s in sums],
    )


def exact_quantiles(df: DataFrame, by: list[str], value: str, qs: list[float], buckets: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles per group as columns ``q0``, ``q1``, ..., for any number of distinct values."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("n"))
    ranked = running_totals(counts, by, value, ["n"], buckets=buckets)
    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n") - 1
    out = []
    for i, q in enumerate(qs):
        position = (F.col("total_n") - 1) * F.lit(q)
        low, high = F.floor(position), F.ceil(position)
        at = lambda rank: F.max(F.when((first <= rank) & (rank <= last), F.col(value)))
        out.append((at(low) + (at(high) - at(low)) * F.max(position - low)).alias(f"q{i}"))
    return ranked.groupBy(*by).agg(*out)
