"""Pieces that several operators share: stored tables, batches as bytes, text columns, connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.sources.sinks import discard, new_path, stored

__all__ = ["BLANKS", "components", "discard", "documents", "freed", "held_out", "map_bytes", "new_path", "packed", "plain", "stored", "text_of", "unpacked", "word_count"]

# The white space of all contracts: space and the control characters 9 to 13.
BLANKS = " \t\n\x0b\f\r"
BLANK_CLASS = "[ \\t\\n\\x0B\\f\\r]"


# Removes what a query shuffled as soon as its result is there; by default it lies on the disks until the driver collects garbage.
FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed(spark: SparkSession) -> Iterator[None]:
    """Tables written inside leave no shuffle files behind."""
    before = spark.conf.get(FREE, "false")
    spark.conf.set(FREE, "true")
    try:
        yield
    finally:
        spark.conf.set(FREE, before)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_of(column: str = "text") -> Column:
    """The text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def plain(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns; whatever else the table has cannot clash with the operators' own."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def packed(df: DataFrame, *names: str) -> DataFrame:
    """The named columns, and all others inside the struct ``_rest``, where their names cannot clash with an operator's own."""
    others = [F.col(f"`{c}`") for c in df.columns if c not in names]
    return df.select(*[F.col(f"`{n}`") for n in names], F.struct(*(others or [F.lit(0).alias("none")])).alias("_rest"))


def unpacked(columns: list[str], names: tuple[str, ...], **new: Column) -> list[Column]:
    """The columns of a table that ``packed`` was given the ``names`` of, in their order, with ``new`` values for some."""
    return [
        new[c].alias(c) if c in new else F.col(f"`{c}`") if c in names else F.col("_rest").getField(c).alias(c) for c in columns]


def held_out(modulus: int, remainder: int = 2, column: str = "doc_id") -> Column:
    """Whether crc32 of the id as text leaves ``remainder``; a null id is never held out."""
    crc = F.crc32(F.col(column).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)) == remainder, F.lit(False))


def word_count(text: Column) -> Column:
    """Number of words, in the JVM: blanks at the ends go, and what remains is split at runs of blanks."""
    trimmed = F.btrim(text, F.lit(BLANKS))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, BLANK_CLASS + "+"))).cast("bigint")


def map_bytes(
    df: DataFrame, fn: Callable[[Iterator[dict]], Iterator[dict]], schema: str, texts: tuple[str, ...] = ("text",), rows: int | None = None,
) -> DataFrame:
    """Run ``fn`` over batches as dicts of lists; the columns in ``texts`` come as UTF-8 bytes (null: empty).

    ``fn`` yields dicts of lists or arrays with the columns of ``schema`` in order. With ``rows``, at most so many rows at
    a time become Python objects, whatever the size of Arrow's batches.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    names = [f.name for f in _parse_datatype_string(schema).fields]
    out = to_arrow_schema(_parse_datatype_string(schema))

    def batches(found):
        for b in (big.slice(a, rows) for big in found for a in range(0, big.num_rows, rows)) if rows else found:
            yield {
                n: [x or b"" for x in c.cast(pa.binary()).to_pylist()] if n in texts else c.to_pylist()
                for n, c in zip(b.schema.names, b.columns)
            }

    def run(found):
        for result in fn(batches(found)):
            arrays = [pa.array(result[n], type=out.field(n).type) for n in names]
            yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return df.mapInArrow(run, schema)


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, component) of every node of the links (a, b); a component is named by its smallest node.

    Alternating large-star and small-star steps: every node's links are moved to the smallest neighbour, first on its
    larger and then on its smaller side, until nothing moves. The number of links never grows, a step is one
    aggregation with map-side minima and one join, and each step starts from files in shared storage.
    """
    links = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u != v").distinct()
    links = stored(links, name)
    mark = None
    while True:
        for step in (_large_star, _small_star):
            before, links = links, stored(step(links), name)
            discard(before)
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    tails = links.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return tails.unionByName(tails.select(F.col("component").alias("node"), "component").distinct())


def _large_star(links: DataFrame) -> DataFrame:
    both = links.select("u", "v").unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = links.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    # a node without a smaller neighbour is its own minimum and keeps its links
    moved = both.where("v > u").join(least, F.col("u") == F.col("c"), "left")
    return moved.select(F.col("v").alias("u"), F.coalesce("m", "u").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    least = links.groupBy(F.col("u").alias("c")).agg(F.min("v").alias("m"))
    moved = links.join(least, F.col("u") == F.col("c"))
    kept = least.select(F.col("c").alias("u"), F.col("m").alias("v"))
    return moved.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(kept).distinct()
