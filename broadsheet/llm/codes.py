"""Vector codes: every vector's parts named by the nearest entries of codebooks that dual-tree Lloyd rounds fit.

Vectors are stored in portions, each with a tree per part position over the portion's parts. A round walks such a tree
and the tree over the codebook's entries together: bounds between boxes drop pairs of nodes, a node of parts that is left
with one entry is assigned as a whole by its cached sums, and leaves with several entries left are decided by integers.
All bounds and distances are integers, so codes and codebooks are exact. Tasks send sums per entry; the driver holds the
codebooks, whose size does not depend on the number of vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import stored

SCALE = 256
# Integers up to this size have squared distances within 64 bits; larger ones are computed without bound.
SAFE = 1 << 26
# A component beyond this many steps has no squared distance that fits a long; its vector is left out.
MOST = 1 << 53


@dataclass(frozen=True)
class CodeParams:
    """``portion_bytes`` bounds what a task holds at a time, ``leaf`` the parts in a leaf of a tree."""

    parts: int = 16
    entries: int = 64
    rounds: int = 2
    leaf: int = 16
    portion_bytes: int = 8 << 20


def integers(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """(vec_id, label, dim, raw): components as floor(256 x) in 64-bit integers, of the vectors that have finite ones only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v")
            sizes = np.diff(v.offsets.to_numpy())
            flat = v.flatten()
            x = flat.to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(invalid="ignore", over="ignore"):
                steps = np.floor(x * SCALE)
                fine = np.isfinite(steps) & (np.abs(steps) < MOST)
            ends = np.cumsum(sizes)
            wrong = np.concatenate([[0], np.cumsum(~fine)])
            held = (wrong[ends] == wrong[ends - sizes]) & ~v.is_null().to_numpy(zero_copy_only=False)
            whole = np.where(fine, steps, 0).astype(np.int64)
            raw = [whole[e - n:e].tobytes() for e, n, h in zip(ends, sizes, held) if h]
            mask = pa.array(held)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id").filter(mask), b.column("label").filter(mask), pa.array(sizes[held], pa.int32()), pa.array(raw, pa.binary())],
                names=["vec_id", "label", "dim", "raw"])

    rows = vectors.select(
        F.col("vec_id").cast("bigint").alias("vec_id"), F.col("label").cast("string").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "vec_id bigint, label string, dim int, raw binary")


def _edges(n: int, level: int) -> np.ndarray:
    """First rows of the 2^level nodes of a level, and the end; every node has about as many rows."""
    return np.arange((1 << level) + 1) * n >> level


def _depth(n: int, leaf: int) -> int:
    depth = 0
    while n >> depth > leaf:
        depth += 1
    return depth


def tree_order(x: np.ndarray, leaf: int) -> np.ndarray:
    """Order of the rows of ``x`` [row, axis] in a tree that halves every node along its widest axis."""
    n = len(x)
    order = np.arange(n)
    for level in range(_depth(n, leaf)):
        edges = _edges(n, level)
        y, starts = x[order], edges[:-1]
        widest = (np.maximum.reduceat(y, starts) - np.minimum.reduceat(y, starts)).argmax(axis=1)
        node = np.repeat(np.arange(len(starts)), np.diff(edges))
        order = order[np.lexsort((y[np.arange(n), widest[node]], node))]
    return order


def _boxes(x: np.ndarray, depth: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per level the lowest and highest components of its nodes; ``x`` is in tree order."""
    starts = [_edges(len(x), level)[:-1] for level in range(depth + 1)]
    return [(np.minimum.reduceat(x, s), np.maximum.reduceat(x, s)) for s in starts]


def _bounds(a: tuple[np.ndarray, np.ndarray], i: np.ndarray, b: tuple[np.ndarray, np.ndarray], j: np.ndarray):
    """Least and greatest squared distance between boxes i of ``a`` and j of ``b``."""
    low, high = a[0][i] - b[1][j], a[1][i] - b[0][j]
    gap = np.maximum(0, np.maximum(low, -high))
    far = np.maximum(np.abs(low), np.abs(high))
    return (gap * gap).sum(axis=1), (far * far).sum(axis=1)


class Codebook:
    """The entries of one part position, with the tree over them."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        self.order = tree_order(entries, 1)
        self.depth = _depth(len(entries), 1)
        self.boxes = _boxes(entries[self.order], self.depth)


def assign(x: np.ndarray, book: Codebook, leaf: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(entry per row, sums per entry, rows per entry, rows assigned by whole nodes) of one part position. ``x`` [row, axis]
    is in tree order; the nearest entry wins, the lowest of equally near ones."""
    n, k = len(x), len(book.entries)
    depth = _depth(n, leaf)
    boxes, sums = _boxes(x, depth), np.concatenate([np.zeros((1, x.shape[1]), x.dtype), np.cumsum(x, axis=0)])
    code = np.full(n, -1, np.int64)
    total, rows, by_node = np.zeros((k, x.shape[1]), x.dtype), np.zeros(k, np.int64), 0
    node, entry, level = np.zeros(1, np.int64), np.zeros(1, np.int64), 0
    for step in range(max(depth, book.depth) + 1):
        at, over = min(step, depth), min(step, book.depth)
        near, far = _bounds(boxes[at], node, book.boxes[over], entry)
        first = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else np.zeros(0, np.int64)
        best = np.minimum.reduceat(far, first) if len(first) else far
        held = near <= np.repeat(best, np.diff(np.append(first, len(node))))
        node, entry = node[held], entry[held]
        if over == book.depth:
            single = _alone(node) & (np.diff(_edges(k, over))[entry] == 1)
            edges = _edges(n, at)
            for i, e in zip(node[single], book.order[_edges(k, over)[entry[single]]]):
                a, b = edges[i], edges[i + 1]
                code[a:b] = e
                total[e] += sums[b] - sums[a]
                rows[e] += b - a
                by_node += int(b - a)
            node, entry = node[~single], entry[~single]
        level = at, over
        if step < max(depth, book.depth):
            node, entry = _split(node, entry, at < depth, over < book.depth)
    if len(node):
        _leaves(x, code, total, rows, node, entry, _edges(n, level[0]), _edges(k, level[1]), book)
    return code, total, rows, by_node


def _alone(node: np.ndarray) -> np.ndarray:
    """Whether a pair's node of parts, sorted, occurs once."""
    apart = np.append(True, node[1:] != node[:-1]) if len(node) else np.zeros(0, bool)
    return apart & np.append(apart[1:], True) if len(node) else apart


def _split(node: np.ndarray, entry: np.ndarray, nodes: bool, entries: bool) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of the children, sorted by node."""
    if entries:
        node, entry = np.repeat(node, 2), np.stack([2 * entry, 2 * entry + 1], axis=1).ravel()
    if nodes:
        node, entry = np.concatenate([2 * node, 2 * node + 1]), np.concatenate([entry, entry])
        order = np.argsort(node, kind="stable")
        node, entry = node[order], entry[order]
    return node, entry


def _leaves(x, code, total, rows, node, entry, edges, entry_edges, book) -> None:
    """Decide the rows of leaves that several entries remain for, by exact distances to those."""
    first, last = entry_edges[entry], entry_edges[entry + 1]
    count = last - first
    names = book.order[np.repeat(first, count) + _within(count)]
    leaf = np.repeat(node, count)
    order = np.lexsort((names, leaf))
    names, leaf = names[order], leaf[order]
    leaves, start, left = np.unique(leaf, return_index=True, return_counts=True)
    size = edges[leaves + 1] - edges[leaves]
    point = np.repeat(edges[leaves], size) + _within(size)
    each, begin = np.repeat(left, size), np.repeat(start, size)
    tried = names[np.repeat(begin, each) + _within(each)]
    gap = x[np.repeat(point, each)] - book.entries[tried]
    gap = (gap * gap).sum(axis=1)
    starts = np.cumsum(each) - each
    best = np.minimum.reduceat(gap, starts)
    won = np.minimum.reduceat(np.where(gap == np.repeat(best, each), tried, len(book.entries)), starts)
    code[point] = won
    np.add.at(total, won, x[point])
    rows += np.bincount(won, minlength=len(rows))


def _within(count: np.ndarray) -> np.ndarray:
    """0, 1, ... inside each of the runs of the given lengths."""
    return np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)


def _assign_large(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """As ``assign``, in integers without bound, for components that 64 bits might not hold the squares of."""
    x, entries = x.astype(object), entries.astype(object)
    code = np.array([int(((entries - row) ** 2).sum(axis=1).argmin()) for row in x], np.int64)
    total = np.zeros(entries.shape, object)
    np.add.at(total, code, x)
    return code, total, np.bincount(code, minlength=len(entries)), 0


PORTIONS = "ids array<bigint>, labels array<string>, raw binary, trees binary"


def portions(rows: DataFrame, dim: int, p: CodeParams) -> DataFrame:
    """Rows of ``integers`` in portions of bounded size, each with the orders of its trees (one per part position)."""
    most = max(1, min(1 << 16, p.portion_bytes // (8 * dim)))

    def built(ids: list, labels: list, raw: list[bytes]) -> pa.RecordBatch:
        x = _by_part(b"".join(raw), len(raw), p.parts)
        orders = np.stack([tree_order(part, p.leaf) for part in x]).astype(np.uint16)
        return pa.RecordBatch.from_arrays([
            pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.string())), pa.array([b"".join(raw)], pa.binary()),
            pa.array([orders.tobytes()], pa.binary())], names=["ids", "labels", "raw", "trees"])

    def run(batches):
        ids, labels, raw = [], [], []
        for b in batches:
            ids += b.column("vec_id").to_pylist()
            labels += b.column("label").to_pylist()
            raw += b.column("raw").to_pylist()
            while len(raw) >= most:
                yield built(ids[:most], labels[:most], raw[:most])
                ids, labels, raw = ids[most:], labels[most:], raw[most:]
        if raw:
            yield built(ids, labels, raw)

    return rows.mapInArrow(run, PORTIONS)


def _by_part(raw: bytes, n: int, parts: int) -> np.ndarray:
    """Integers [part, row, axis]."""
    return np.ascontiguousarray(np.frombuffer(raw, np.int64).reshape(n, parts, -1).transpose(1, 0, 2))


def _assigned(b: pa.RecordBatch, books: list[Codebook], p: CodeParams) -> Iterator[tuple]:
    """Per portion of a batch: ids, labels, and per part position the rows [row, axis] with what ``assign`` returns, codes
    in the order of the rows."""
    for ids, labels, raw, trees in zip(*(b.column(c) for c in ("ids", "labels", "raw", "trees"))):
        n = len(ids)
        x = _by_part(raw.as_py(), n, p.parts)
        orders = np.frombuffer(trees.as_py(), np.uint16).reshape(p.parts, n)
        out = []
        for part, order, book in zip(x, orders, books):
            if max(np.abs(part).max(), np.abs(book.entries).max()) > SAFE:
                out.append(_assign_large(part, book.entries))
                continue
            code, *rest = assign(part[order], book, p.leaf)
            placed = np.empty(n, np.int64)
            placed[order] = code
            out.append((placed, *rest))
        yield ids, labels, x, out


def _round(trees: DataFrame, books: np.ndarray, p: CodeParams) -> np.ndarray:
    """Codebooks [part, entry, axis] after one round: floors of the means of what is assigned to an entry, if anything is."""
    shared = trees.sparkSession.sparkContext.broadcast(books)

    def run(batches):
        found = [Codebook(x) for x in shared.value]
        sums, counts = np.zeros(books.shape, object), np.zeros(books.shape[:2], object)
        for b in batches:
            for *_, parts in _assigned(b, found, p):
                for i, (_, total, rows, _) in enumerate(parts):
                    sums[i] += total.astype(object)
                    counts[i] += rows.astype(object)
        part, entry = np.nonzero(counts)
        width = books.shape[2]
        values = [Decimal(int(v)) for v in sums[part, entry].ravel()]
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(part, width), pa.int32()), pa.array(np.repeat(entry, width), pa.int32()),
            pa.array(np.tile(np.arange(width), len(part)), pa.int32()), pa.array(np.repeat(counts[part, entry], width).astype(np.int64)),
            pa.array(values, pa.decimal128(38, 0))], names=["part", "entry", "axis", "n", "total"])

    sent = trees.mapInArrow(run, "part int, entry int, axis int, n bigint, total decimal(38,0)")
    means = books.copy()
    # a row per component of the codebooks, however many vectors there are
    for r in sent.groupBy("part", "entry", "axis").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        means[r["part"], r["entry"], r["axis"]] = int(r["total"]) // r["n"]
    shared.unpersist()
    return means


def vector_codes(vectors: DataFrame, p: CodeParams = CodeParams()) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error) of every vector that has a code, and the codebooks [part, entry, axis].

    ``vectors`` has vec_id bigint, embedding and label. Vectors that are null or hold null or non-finite components, or
    ones beyond 2^53 steps, are left out. The dimension is that of the smallest id whose vector divides into ``p.parts``;
    vectors of other lengths are left out too. Codebooks start from the smallest ids (null ids last, equal ids by
    components); with fewer vectors they are shorter. Repeated rows count and return as often as they occur. ``error`` is
    null if it fits no long. Empty table: no rows, empty codebooks. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = stored(integers(vectors), "code-rows")
    order = [F.col("vec_id").asc_nulls_last(), F.col("raw")]
    first = rows.where((F.col("dim") > 0) & (F.col("dim") % p.parts == 0)).orderBy(*order).limit(1).collect()
    if not first:
        return spark.createDataFrame([], "vec_id bigint, label string, code string, error bigint"), np.zeros((p.parts, 0, 0), np.int64)
    dim = first[0]["dim"]
    rows = rows.where(F.col("dim") == dim)
    start = b"".join(r["raw"] for r in rows.orderBy(*order).limit(p.entries).collect())
    books = _by_part(start, len(start) // (8 * dim), p.parts)
    trees = stored(portions(rows.select("vec_id", "label", "raw"), dim, p), "code-trees")
    for _ in range(p.rounds):
        books = _round(trees, books, p)
    shared = spark.sparkContext.broadcast(books)

    def run(batches):
        found = [Codebook(x) for x in shared.value]
        for b in batches:
            for ids, labels, x, parts in _assigned(b, found, p):
                codes = np.stack([code for code, *_ in parts])
                large = max(np.abs(x).max(), np.abs(shared.value).max()) > SAFE
                error = np.zeros(len(ids), object if large else np.int64)
                for part, book, code in zip(x, shared.value, codes):
                    gap = part.astype(error.dtype) - book[code].astype(error.dtype)
                    error += (gap * gap).sum(axis=1)
                digits = np.char.mod("%02x", codes.T)
                yield pa.RecordBatch.from_arrays([
                    pa.array(ids.values), pa.array(labels.values), pa.array(["".join(row) for row in digits]),
                    pa.array([int(e) if e < 1 << 63 else None for e in error] if large else error, pa.int64())],
                    names=["vec_id", "label", "code", "error"])

    return trees.mapInArrow(run, "vec_id bigint, label string, code string, error bigint"), books


def books_digest(books: np.ndarray) -> str:
    """Hash of all components of the codebooks as text, by part, entry and place."""
    return sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(codes: DataFrame) -> DataFrame:
    """Adds ``label_error``: the errors of all vectors with the same label added up, those without one together; null if
    that fits no long."""
    codes = stored(codes.withColumn("_group", F.coalesce(F.concat(F.lit(":"), F.col("label")), F.lit("-"))), "codes")
    sums = codes.groupBy("_group").agg(
        F.when(F.count("error") == F.count(F.lit(1)), F.try_sum("error")).alias("label_error"))
    return codes.join(sums, "_group").drop("_group")
