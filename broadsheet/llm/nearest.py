"""Nearest neighbours through stable projections: few random axes, a kd-tree over them, and a stopping test.

A Gaussian projection to m axes turns a distance d into a projected one whose square over d^2 follows the chi-square law
with m degrees of freedom. So neighbours are tried in the order of projected distance, and a search ends once a vector
nearer than the k-th best so far would have shown up before with probability p. The upper levels of the kd-tree, fitted
on a bounded sample, cut the table into cells; every cell has a tree of its own inside the task that searches it. A
query visits its own cell first, and then, with the bound it got there, only cells that the test does not exclude.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from broadsheet.llm.codes import _depth, _edges, tree_order
from broadsheet.llm.common import stored

# A larger component would overflow when squared; all vectors are then scaled down by a power of two, and results back.
LARGE = 400


@dataclass(frozen=True)
class NearestParams:
    """``axes`` (even) and ``p`` set the projection and the stopping test. ``sample`` bounds the vectors that the upper
    tree is fitted on, ``cell`` is the size of its cells; a task holds ``block`` vectors and ``queries`` queries at most, on average."""

    k: int = 10
    axes: int = 8
    p: float = 0.97
    seed: int = 7
    sample: int = 65_536
    cell: int = 4096
    block: int = 8192
    queries: int = 2048
    leaf: int = 64


def chi_square(x: float, m: int) -> float:
    """Distribution function for an even number of degrees of freedom."""
    term, total = 1.0, 1.0
    for i in range(1, m // 2):
        term *= x / 2 / i
        total += term
    return 1.0 - math.exp(-x / 2) * total


def chi_square_limit(p: float, m: int) -> float:
    """Where the distribution function reaches ``p``: a projected distance whose square exceeds this times the square of
    the k-th best distance ends a search."""
    low, high = 0.0, 1.0
    while chi_square(high, m) < p:
        high *= 2
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if chi_square(middle, m) < p else (low, middle)
    return high


def _numbers(raw, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(raw), kind).reshape(len(raw), -1).astype(np.float64)


def usable(vectors: DataFrame, kind: str, vector: str = "embedding") -> DataFrame:
    """(vec_id, sig, raw, dim, top) of vectors with an id and finite components that are not all zero. ``raw`` holds the
    components, ``sig`` a 128-bit digest of them, ``top`` the greatest magnitude."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = b.column("v")
            sizes = np.diff(v.offsets.to_numpy())
            x = v.flatten().to_numpy(zero_copy_only=False).astype(kind) + 0.0  # -0.0 equals 0.0
            ends = np.cumsum(sizes)
            wrong = np.concatenate([[0], np.cumsum(~np.isfinite(x))])
            other = np.concatenate([[0], np.cumsum(x != 0)])
            held = (wrong[ends] == wrong[ends - sizes]) & (other[ends] > other[ends - sizes])
            held &= ~v.is_null().to_numpy(zero_copy_only=False) & ~b.column("vec_id").is_null().to_numpy(zero_copy_only=False)
            parts = [x[e - n:e] for e, n, h in zip(ends, sizes, held) if h]
            raw = [part.tobytes() for part in parts]
            yield pa.RecordBatch.from_arrays([
                b.column("vec_id").filter(pa.array(held)), pa.array([hashlib.md5(r, usedforsecurity=False).digest() for r in raw], pa.binary()),
                pa.array(raw, pa.binary()), pa.array(sizes[held], pa.int32()), pa.array([float(np.abs(part).max()) for part in parts], pa.float64())],
                names=["vec_id", "sig", "raw", "dim", "top"])

    element = "float" if kind == "<f4" else "double"
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col(vector).cast(f"array<{element}>").alias("v"))
    return rows.mapInArrow(run, "vec_id bigint, sig binary, raw binary, dim int, top double")


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(sig, ids, raw): every vector once, with the ``k`` smallest ids that hold it; more of them can be in no answer."""
    rank = F.row_number().over(Window.partitionBy("sig").orderBy("vec_id"))
    first = rows.select("sig", "vec_id", rank.alias("rank")).where(F.col("rank") <= k)
    groups = first.groupBy("sig").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("vec_id", F.get("ids", F.lit(0)))
    return rows.select("sig", "vec_id", "raw").join(groups, ["sig", "vec_id"]).drop("vec_id")


def _cells(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """(axis, cut) per inner node, the root being node 1 and the children of node i nodes 2 i and 2 i + 1: each halves its
    part of the sample along the widest axis."""
    axis, cut = np.zeros(1 << depth, np.int64), np.full(1 << depth, np.inf)
    held = {1: sample}
    for node in range(1, 1 << depth):
        x = held.pop(node)
        if len(x):
            axis[node] = (x.max(axis=0) - x.min(axis=0)).argmax()
            cut[node] = np.median(x[:, axis[node]])
        right = x[:, axis[node]] >= cut[node]
        held[2 * node], held[2 * node + 1] = x[~right], x[right]
    return axis, cut


def _cell_of(x: np.ndarray, axis: np.ndarray, cut: np.ndarray) -> np.ndarray:
    node = np.ones(len(x), np.int64)
    for _ in range(len(axis).bit_length() - 1):
        node = 2 * node + (x[np.arange(len(x)), axis[node]] >= cut[node])
    return node - len(axis)


def _to_boxes(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distance of every row of ``x`` to every box."""
    out = np.zeros((len(x), len(low)))
    for a in range(x.shape[1]):
        gap = np.maximum(0.0, np.maximum(low[:, a] - x[:, a:a + 1], x[:, a:a + 1] - high[:, a]))
        out += gap * gap
    return out


def _first(distance: np.ndarray, ids: np.ndarray, *more: np.ndarray, k: int) -> list[np.ndarray]:
    """The k smallest columns per row by distance, then id."""
    by_id = np.argsort(ids, axis=1, kind="stable")
    order = np.take_along_axis(by_id, np.argsort(np.take_along_axis(distance, by_id, 1), axis=1, kind="stable"), 1)[:, :k]
    return [np.take_along_axis(v, order, 1) for v in (distance, ids, *more)]


NONE = np.iinfo(np.int64).max


def search(low: np.ndarray, x: np.ndarray, ids: np.ndarray, q_low: np.ndarray, q: np.ndarray, bound: np.ndarray, k: int,
           limit: float, leaf: int = 64) -> tuple[np.ndarray, np.ndarray, int]:
    """(distances, ids) [query, k] of the vectors ``x`` nearest to each of ``q``, padded with infinity, and how many exact
    distances were computed. ``low`` and ``q_low`` are projections, ``ids`` [vector, k] is padded with the largest integer.

    Every query takes the leaves of the kd-tree in the order of their projected distance. In a leaf it verifies the
    vectors that pass the stopping test with its k-th best distance so far (at most ``bound``), and it ends at the first
    leaf that fails the test. All queries step together.
    """
    order = tree_order(low, leaf)
    low, x, ids = low[order], x[order], ids[order]
    edges = _edges(len(x), _depth(len(x), leaf))
    starts, sizes = edges[:-1], np.diff(edges)
    boxes = np.minimum.reduceat(low, starts), np.maximum.reduceat(low, starts)
    far = _to_boxes(q_low, *boxes)
    turn = np.argsort(far, axis=1, kind="stable")
    best = np.full((len(q), k), np.inf)
    first, at = np.full((len(q), k), NONE), np.zeros((len(q), k), np.int64)
    kth, tried = bound.astype(np.float64), 0
    active = np.arange(len(q))
    for j in range(len(starts)):
        active = active[far[active, turn[active, j]] <= limit * kth[active] ** 2]
        if not len(active):
            break
        for part in np.array_split(active, -(-len(active) // 256)):
            leaves = turn[part, j]
            place = starts[leaves][:, None] + np.arange(sizes.max())
            inside = np.arange(sizes.max()) < sizes[leaves][:, None]
            place = np.minimum(place, len(x) - 1)
            near = ((low[place] - q_low[part][:, None]) ** 2).sum(axis=2) <= limit * kth[part][:, None] ** 2
            row, col = np.nonzero(near & inside)
            tried += len(row)
            gap = x[place[row, col]] - q[part[row]]
            found = np.full(place.shape, np.inf)
            found[row, col] = np.sqrt((gap * gap).sum(axis=1))
            pool = np.concatenate([best[part], found], axis=1), np.concatenate([first[part], ids[place, 0]], axis=1)
            best[part], first[part], at[part] = _first(*pool, np.concatenate([at[part], place], axis=1), k=k)
            kth[part] = np.minimum(kth[part], best[part, -1])
    shown = np.where(np.isinf(best)[:, :, None], NONE, ids[at]).reshape(len(q), -1)
    distance = np.where(shown == NONE, np.inf, np.repeat(best, ids.shape[1], axis=1))
    return *_first(distance, shown, k=k), tried


def nearest(vectors: DataFrame, queries: Column, p: NearestParams = NearestParams()) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``vectors`` (vec_id bigint, embedding) where ``queries`` holds, its
    ``p.k`` nearest others by Euclidean distance, nearest first, ties to the smaller id.

    Equal vectors are searched and found once and stand for all their ids. A neighbour is missed with a probability of at
    most 1 - p.p; its score is the exact distance. Vectors that are null, all zero or hold null or non-finite components,
    null ids, and vectors of another length than most (of equally many the longer) take no part. Rows that repeat an id
    and vector count once; an id with several vectors is a candidate, and a query, by each of them, never for itself.
    With fewer candidates, all of those that are found. Empty table: no rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    element = vectors.schema["embedding"].dataType.elementType
    kind = "<f4" if isinstance(element, T.FloatType) else "<f8"
    rows = stored(usable(vectors, kind), "near-rows")
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    lengths = rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), F.max("top").alias("top")).orderBy(F.desc("n"), F.desc("dim")).limit(1).collect()
    if not lengths:
        return empty
    dim, top = lengths[0]["dim"], lengths[0]["top"]
    scale = 2.0 ** -max(0, math.frexp(top)[1] - LARGE)
    rows = stored(rows.where(F.col("dim") == dim).select("vec_id", "sig", "raw").dropDuplicates(["vec_id", "sig"]), "near-distinct")
    most, limit = p.k + 1, chi_square_limit(p.p, p.axes)
    points = stored(distinct_vectors(rows, most), "near-points")
    asked = stored(rows.where(queries).select("vec_id", "sig", "raw"), "near-asked")

    matrix = np.random.default_rng(p.seed).standard_normal((dim, p.axes))
    axes = [f"p{i}" for i in range(p.axes)]
    low_schema = ", ".join(f"{a} double" for a in axes)

    def project(b: pa.RecordBatch) -> np.ndarray:
        return (_numbers(b.column("raw").to_pylist(), kind) * scale) @ matrix

    def sampled(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in project(b).T], names=axes)

    n = points.count()
    share = F.pmod(F.xxhash64("sig"), F.lit(1 << 30)) < int(min(1.0, p.sample / max(1, n)) * (1 << 30))
    sample = points.where(share).select("raw").mapInArrow(sampled, low_schema).toArrow()
    sample = np.stack([c.to_numpy() for c in sample.columns], axis=1) if sample.num_rows else np.zeros((0, p.axes))
    depth = max(0, min(math.ceil(math.log2(max(1, n / p.cell))), math.floor(math.log2(max(1, p.sample / 8)))))
    tree = spark.sparkContext.broadcast(_cells(sample, depth))

    def place(batches):
        for b in batches:
            low = project(b)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *[pa.array(c) for c in low.T], pa.array(_cell_of(low, *tree.value).astype(np.int32))],
                names=[*b.schema.names, *axes, "cell"])

    placed = stored(points.select("sig", "ids", "raw").mapInArrow(place, f"sig binary, ids array<bigint>, raw binary, {low_schema}, cell int"), "near-placed")
    bounds = [f(a).alias(f"{f.__name__}_{a}") for a in axes for f in (F.min, F.max)]
    # one row per cell, of which there are at most an eighth of the sample
    cells = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), *bounds).toPandas().sort_values("cell")
    boxes = spark.sparkContext.broadcast((cells["cell"].to_numpy(), *[cells[[f"{f}_{a}" for a in axes]].to_numpy() for f in ("min", "max")]))
    homes = asked.select("sig", "raw").dropDuplicates(["sig"]).mapInArrow(place, f"sig binary, raw binary, {low_schema}, cell int")
    homes = stored(homes.withColumn("bound", F.lit(math.inf)), "near-homes")

    def visited(pairs: DataFrame) -> DataFrame:
        """(sig, vec_id, score) of the nearest that each query finds in the cells it is paired with."""
        count = pairs.groupBy("cell").agg(F.count(F.lit(1)).alias("q")).toPandas()
        sizes = count.merge(cells[["cell", "n"]], on="cell")
        sizes = pd.DataFrame({"cell": sizes["cell"], "blocks": -(-sizes["n"] // p.block), "turns": -(-sizes["q"] // p.queries)})
        sizes = F.broadcast(spark.createDataFrame(sizes, "cell int, blocks bigint, turns bigint"))
        each = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
        mine = placed.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("sig"), F.col("blocks"))).withColumn("turn", each("turns"))
        theirs = pairs.join(sizes, "cell").withColumn("turn", F.pmod(F.xxhash64("sig"), F.col("turns"))).withColumn("block", each("blocks"))
        keys = ["cell", "block", "turn"]
        both = mine.select(*keys, "ids", "raw", *axes).groupBy(*keys).cogroup(theirs.select(*keys, "sig", "raw", *axes, "bound").groupBy(*keys))
        return both.applyInPandas(found, "sig binary, vec_id bigint, score double")

    def found(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        if not len(mine) or not len(theirs):
            return pd.DataFrame({"sig": [], "vec_id": np.zeros(0, np.int64), "score": np.zeros(0)})
        ids = np.full((len(mine), most), NONE)
        for i, row in enumerate(mine["ids"]):
            ids[i, :len(row)] = row
        x, q = (_numbers(df["raw"].tolist(), kind) * scale for df in (mine, theirs))
        distance, names, _ = search(
            mine[axes].to_numpy(), x, ids, theirs[axes].to_numpy(), q, theirs["bound"].to_numpy(), most, limit, p.leaf)
        row, col = np.nonzero(names != NONE)
        return pd.DataFrame({"sig": theirs["sig"].to_numpy()[row], "vec_id": names[row, col], "score": distance[row, col] / scale})

    def others(batches):
        names, low, high = boxes.value
        for b in batches:
            x = np.stack([b.column(a).to_numpy() for a in axes], axis=1)
            near = _to_boxes(x, low, high) <= limit * (b.column("bound").to_numpy() * scale)[:, None] ** 2
            near &= names != b.column("cell").to_numpy()[:, None]
            row, col = np.nonzero(near)
            kept = b.take(pa.array(row))
            bound = pa.array(kept.column("bound").to_numpy() * scale)
            yield pa.RecordBatch.from_arrays(
                [*[kept.column(c) for c in ("sig", "raw", *axes)], pa.array(names[col].astype(np.int32)), bound],
                names=["sig", "raw", *axes, "cell", "bound"])

    near_home = stored(visited(homes), "near-home")
    bound = near_home.groupBy("sig").agg(F.when(F.count(F.lit(1)) == most, F.max("score")).alias("kth"))
    rest = homes.drop("bound").join(bound, "sig", "left").withColumn("bound", F.coalesce("kth", F.lit(math.inf))).drop("kth")
    pairs = rest.mapInArrow(others, f"sig binary, raw binary, {low_schema}, cell int, bound double")
    everywhere = near_home.unionByName(visited(stored(pairs, "near-pairs")))
    rank = F.row_number().over(Window.partitionBy("sig").orderBy("score", "vec_id"))
    answers = everywhere.withColumn("rank", rank).where(F.col("rank") <= most).groupBy("sig").agg(
        F.sort_array(F.collect_list(F.struct("score", "vec_id"))).alias("near"))
    own = asked.select(F.col("vec_id").alias("query_id"), "sig").join(answers, "sig")
    left = F.slice(F.filter("near", lambda r: r["vec_id"] != F.col("query_id")), 1, p.k)
    return own.select("query_id", F.posexplode(left).alias("rank", "r")).select(
        "query_id", (F.col("rank") + 1).cast("int").alias("rank"), F.col("r.vec_id").alias("vec_id"), F.col("r.score").alias("score"))
