"""Merkle manifest of a dataset: a tree of hashes per source, one over the sources, and a proof per row.

Rows of a source are numbered in order and cut into superblocks of a fixed number of leaves. A superblock becomes one
node; the nodes of all superblocks, few against the rows, form the upper tree, which is cut and reduced the same way as
often as needed. Then every superblock is cogrouped with the path above it: one task reduces its leaves again, joins the
local and the outer part of each proof and folds the proof, all at once. No task holds more than a superblock.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from broadsheet.llm.common import plain, stored

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
RUN = 3
# Levels of a superblock: 3^6 leaves, a few hundred kB.
LEVELS = 6
PATH = "subroot string, before array<string>, after array<string>"


def leaf(**changed: Column) -> Column:
    """Hash of a row: each field as its length in bytes, a colon and its value, or ``-``; a field may be replaced."""
    parts = []
    for name in FIELDS:
        value = changed.get(name, F.col(name)).cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _hash(texts) -> str:
    return sha256("".join(texts).encode()).hexdigest()


def _up(nodes: list[str]) -> list[str]:
    return [_hash(nodes[i:i + RUN]) for i in range(0, len(nodes), RUN)]


def _climb(nodes: list[str], total: int, levels: int) -> tuple[str, list[list[str]]]:
    """The node above one block of a tree with ``total`` nodes, and the levels below it. A block of a larger tree rises
    exactly ``levels`` times; a tree that fits into one block rises until one node remains."""
    below = []
    while total > 1 and len(below) < levels:
        below.append(nodes)
        nodes, total = _up(nodes), -(-total // RUN)
    return nodes[0], below


def _sides(below: list[list[str]], at: int) -> tuple[list[str], list[str]]:
    """Per level the joined siblings to the left and to the right of node ``at`` of the lowest level."""
    before, after = [], []
    for nodes in below:
        first = at - at % RUN
        before.append("".join(nodes[first:at]))
        after.append("".join(nodes[at + 1:first + RUN]))
        at //= RUN
    return before, after


def _blocks(df: pd.DataFrame, levels: int) -> Iterator[tuple[str, int, int, pd.DataFrame]]:
    """(tree, block, nodes of the tree, rows in order) of all blocks in a group."""
    df = df.sort_values(["tree", "pos"], kind="stable")
    tree, block = df["tree"].to_numpy(), df["pos"].to_numpy() // RUN**levels
    ends = np.flatnonzero(np.append((tree[1:] != tree[:-1]) | (block[1:] != block[:-1]), True)) + 1 if len(df) else []
    start = 0
    for end in ends:
        yield tree[start], int(block[start]), int(df["n"].iloc[start]), df.iloc[start:end]
        start = end


def numbered(rows: DataFrame, by: list[Column]) -> DataFrame:
    """Adds ``pos``, the place of a row among those of its ``tree`` in the order of ``by``, and ``n``, their number.

    Rows are dealt by ranges and sorted, counted inside the partitions, and moved up by the partitions before: a tree of
    any size is spread over tasks. Of a tree, the window sees one row per partition.
    """
    def run(batches):
        part, tree, at = TaskContext.get().partitionId(), None, 0
        for b in batches:
            names = b.column("tree").to_pylist()
            local = np.empty(len(names), np.int64)
            for i, t in enumerate(names):
                if t != tree:
                    tree, at = t, 0
                local[i] = at
                at += 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(np.full(len(names), part, np.int32)), pa.array(local)], names=[*b.schema.names, "part", "pos"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    order = [F.col("tree"), *by]
    dealt = stored(rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(run, f"{schema}, part int, pos bigint"), "merkle-dealt")
    counts = dealt.groupBy("tree", "part").agg(F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy("tree")
    upto = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("tree", "part", F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias("first"), F.sum("rows").over(whole).alias("n"))
    return dealt.join(counts, ["tree", "part"]).withColumn("pos", F.col("pos") + F.col("first")).drop("part", "first")


def _small_bins(nodes: DataFrame, levels: int) -> int:
    """In how many bins the small trees go, about a block's rows in each."""
    inside = nodes.where((F.col("n") <= RUN**levels) & (F.col("pos") == 0))
    return max(1, (inside.agg(F.sum("n")).first()[0] or 0) // RUN**levels)


def _bin(levels: int, bins: int, block: Column) -> Column:
    """The block of a tree that has several, else one of the bins of small trees. What meets in a bin is told apart there."""
    few = F.pmod(F.xxhash64("tree"), F.lit(bins))
    return F.when(F.col("n") <= RUN**levels, few).otherwise(F.xxhash64("tree", block)).alias("bin")


def _block(levels: int) -> Column:
    return F.floor(F.col("pos") / RUN**levels)


def paths(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """(tree, pos, subroot, before, after) of every node (tree, pos, n, node): siblings per level up to the tree's root."""
    size, bins = RUN**levels, _small_bins(nodes, levels)
    binned = nodes.select(_bin(levels, bins, _block(levels)), "tree", "pos", "n", "node")
    if (nodes.agg(F.max("n")).first()[0] or 0) <= size:
        return binned.groupBy("bin").applyInPandas(lambda df: _finished(df, None, levels), f"tree string, pos bigint, {PATH}")
    above = _above_blocks(binned, levels).where(F.col("n") > size)
    return binned.groupBy("bin").cogroup(above.select(_bin(levels, bins, F.col("pos")), "*").groupBy("bin")).applyInPandas(
        lambda df, up: _finished(df, up, levels), f"tree string, pos bigint, {PATH}")


def _above_blocks(binned: DataFrame, levels: int) -> DataFrame:
    """(tree, pos, subroot, before, after, n) of every block: the path from its node; ``n`` counts the nodes under all blocks."""
    tops = stored(risen(binned, levels), "merkle-tops")
    n = tops.select("tree", "pos", F.col("below").alias("n"))
    return stored(paths(tops, levels).join(n, ["tree", "pos"]), "merkle-above")


def risen(binned: DataFrame, levels: int) -> DataFrame:
    """(tree, pos, n, node, below): one node per block, numbered in its tree; ``below`` is the number of nodes under all."""
    def run(df):
        out = [(tree, block, -(-n // RUN**levels), _climb(rows["node"].tolist(), n, levels)[0], n) for tree, block, n, rows in _blocks(df, levels)]
        return pd.DataFrame(out, columns=["tree", "pos", "n", "node", "below"])

    return binned.select("bin", "tree", "pos", "n", "node").groupBy("bin").applyInPandas(run, "tree string, pos bigint, n bigint, node string, below bigint")


def _finished(df: pd.DataFrame, up: pd.DataFrame | None, levels: int) -> pd.DataFrame:
    out, above = [], {}
    if up is not None:
        above = {(t, p): path for t, p, *path in zip(*(up[c].tolist() for c in ("tree", "pos", "subroot", "before", "after")))}
    for tree, block, n, rows in _blocks(df, levels):
        top, below = _climb(rows["node"].tolist(), n, levels)
        subroot, before, after = above.get((tree, block), (top, [], []))
        first = block * RUN**levels
        for i in range(len(rows)):
            b, a = _sides(below, i)
            out.append((tree, first + i, subroot, [*b, *before], [*a, *after]))
    return pd.DataFrame(out, columns=["tree", "pos", "subroot", "before", "after"])


def manifest(docs: DataFrame, claimed: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """Per row of ``docs`` (doc_id, source, lang, n_chars, text): its leaf, the root of its source (``subroot``), the root
    of all, its proof (the siblings of every level, joined, left to right), and the check of ``claimed``, a leaf that
    someone presents for the row (default: its own): ``folded_root`` is that leaf folded with the proof, ``verified``
    whether it equals the root.

    Null in a field is a value of its own; null ids come first in their source, null sources form the first source, and
    an empty text is not null. Rows of one id are ordered by their leaves, and equal rows are leaves of their own.
    Texts of any length are hashed in the JVM and never shuffled. Other columns are ignored. Empty table: no rows.
    """
    rows = plain(docs, *FIELDS)
    own = leaf()
    tree = F.coalesce(F.concat(F.lit(":"), F.col("source")), F.lit("-"))  # "-" sorts before ":"
    rows = rows.select(F.col("doc_id").cast("bigint").alias("doc_id"), tree.alias("tree"), own.alias("node"),
                       (own if claimed is None else claimed).alias("claim"))
    rows = stored(rows, "merkle-rows")  # dealing by ranges reads them twice
    leaves = stored(numbered(rows, [F.col("doc_id").asc_nulls_first(), F.col("node")]), "merkle-leaves")
    size, bins = RUN**levels, _small_bins(leaves, levels)
    # ids go as text, since a column with nulls would become floating point
    binned = leaves.select(_bin(levels, bins, _block(levels)), "tree", "pos", "n", F.col("doc_id").cast("string").alias("doc_id"), "node", "claim")
    above = _above_blocks(binned, levels)

    # the tree over the sources
    subroots = above.where("pos = 0").select(F.lit("").alias("tree"), F.col("tree").alias("name"), F.col("subroot").alias("node"))
    subroots = stored(numbered(subroots, [F.col("name")]), "merkle-subroots")
    over = paths(subroots.drop("name"), levels).join(subroots.select("pos", "name"), "pos").select(
        F.col("name").alias("tree"), F.col("subroot").alias("root"), F.col("before").alias("b"), F.col("after").alias("a"))
    above = above.join(over, "tree").select(
        _bin(levels, bins, F.col("pos")), "tree", "pos", "subroot", "root", F.concat("before", "b").alias("before"), F.concat("after", "a").alias("after"))

    def finish(df, up):
        outer = {(t, p): path for t, p, *path in zip(*(up[c].tolist() for c in ("tree", "pos", "subroot", "root", "before", "after")))}
        out = []
        for name, block, n, mine in _blocks(df, levels):
            nodes = mine["node"].tolist()
            _, below = _climb(nodes, n, levels)
            subroot, root, before, after = outer[name, block]
            for i, (doc_id, node, claim) in enumerate(zip(mine["doc_id"], nodes, mine["claim"])):
                b, a = _sides(below, i)
                b, a = [*b, *before], [*a, *after]
                folded = claim
                for left, right in zip(b, a):
                    folded = _hash((left, folded, right))
                out.append((doc_id, name, block * size + i, node, subroot, root, "".join(map(str.__add__, b, a)), folded))
        return pd.DataFrame(out, columns=["doc_id", "tree", "pos", "leaf", "subroot", "root", "proof", "folded_root"])

    done = binned.groupBy("bin").cogroup(above.groupBy("bin")).applyInPandas(
        finish, "doc_id string, tree string, pos bigint, leaf string, subroot string, root string, proof string, folded_root string")
    return done.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.when(F.col("tree") != "-", F.expr("substring(tree, 2)")).alias("source"), "pos", "leaf", "subroot", "root",
        "proof", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
