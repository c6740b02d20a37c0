"""Near-equal vectors: tiles of vectors compared along principal axes, most telling ones first."""

from __future__ import annotations

import hashlib
import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import components, map_bytes, plain, stored

# Half of the neighbouring cells; the other half is met from the other side.
HALF = ((0, 0), (0, 1), (1, -1), (1, 0), (1, 1))


def usable(vectors: DataFrame, id_: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(vec_id, label, dim, key, raw) of vectors that can link: label and id given, components finite, not all zero. ``raw``
    holds the components in double precision, ``key`` a 128-bit digest of them."""
    def run(batches):
        for b in batches:
            out = {n: [] for n in ("vec_id", "label", "dim", "key", "raw")}
            for i, group, v in zip(b["vec_id"], b["label"], b["v"]):
                if i is None or group is None or not v or None in v:
                    continue
                x = np.array(v, np.float64)
                if not np.isfinite(x).all() or not x.any():
                    continue
                raw = (x + 0.0).tobytes()  # -0.0 equals 0.0
                for key, value in zip(out, (i, group, len(v), hashlib.md5(raw, usedforsecurity=False).digest(), raw)):
                    out[key].append(value)
            yield out

    rows = vectors.select(F.col(id_).alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("v"))
    return map_bytes(rows, run, "vec_id bigint, label string, dim int, key binary, raw binary", ())


def _unit(raw: list[bytes]) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that squares neither overflow nor vanish
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(rows: DataFrame) -> dict[int, np.ndarray]:
    """Orthonormal axes per vector length, by falling second moment. Tasks send sums of products, whose cells are added
    by an aggregate; the driver gets the square of the length, whatever the number of vectors."""
    def run(batches):
        sums: dict[int, np.ndarray] = {}
        for b in batches:
            for dim in set(b["dim"]):
                u = _unit([r for r, d in zip(b["raw"], b["dim"]) if d == dim])
                sums[dim] = sums.get(dim, 0) + u.T @ u
        for dim, m in sums.items():
            i, j = np.indices(m.shape)
            yield {"dim": np.full(m.size, dim), "i": i.ravel(), "j": j.ravel(), "v": m.ravel()}

    cells = map_bytes(rows.select("dim", "raw"), run, "dim int, i int, j int, v double", ("raw",))
    found = cells.groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).toArrow().to_pandas()
    axes = {}
    for dim, g in found.groupby("dim"):
        m = np.zeros((dim, dim))
        m[g["i"], g["j"]] = g["v"]
        values, vectors = np.linalg.eigh((m + m.T) / 2)
        axes[int(dim)] = vectors[:, np.argsort(-values)]
    return axes


def tile_links(a: np.ndarray, b: np.ndarray, threshold: float, step: int = 16) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row of a, row of b) of unit vectors, given along principal axes, whose product reaches ``threshold``.

    The leading axes are multiplied for the whole tile. What the remaining axes can add is at most the product of both
    remainders' norms, so pairs that cannot reach the threshold are left; the others go on by ``step`` axes.
    """
    def left(x, k):
        return np.sqrt(np.maximum(0.0, (x[:, k:] ** 2).sum(axis=1)))

    dim, low = a.shape[1], threshold - 1e-9
    product = a[:, :step] @ b[:, :step].T
    i, j = np.nonzero(product + np.outer(left(a, step), left(b, step)) >= low)
    s = product[i, j]
    for k in range(step, dim, step):
        s = s + np.einsum("ij,ij->i", a[i, k:k + step], b[j, k:k + step])
        keep = s + left(a, k + step)[i] * left(b, k + step)[j] >= low
        i, j, s = i[keep], j[keep], s[keep]
    return i, j


def smallest_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Per node of a small graph the smallest node of its component."""
    name = np.arange(n)
    while len(i):
        low = np.minimum(name[i], name[j])
        before = name.copy()
        np.minimum.at(name, i, low)
        np.minimum.at(name, j, low)
        name = name[name]
        if (before == name).all():
            break
    return name


def near_vectors(vectors: DataFrame, threshold: float = 0.93, tile: int = 1024) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors`` (vec_id bigint, embedding, label).

    Vectors link if their labels are equal and their cosine, in double precision, reaches ``threshold``. Equal vectors
    are compared once. Along the first two principal axes linked unit vectors differ by less than
    sqrt(2 - 2 threshold); cells of that width meet their neighbours only, cells of more than ``tile`` vectors are cut
    into tiles, and every pair of tiles is a group of bounded size. A tile sends counts and, instead of its pairs, links
    that connect the same vectors, so a group of near copies costs rows in proportion to its vectors.

    Null, zero, non-finite vectors, vectors with null components or without label: no links, their own component.
    Vectors of different length never link. Null id: no links, component null, not kept. Rows that repeat an id are one
    vertex: each has the links of all of them. Empty table: no rows.
    """
    spark = vectors.sparkSession
    rows = stored(usable(vectors), "vec-rows")
    groups = stored(rows.groupBy("label", "dim", "key").agg(
        F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("weight")), "vec-groups")
    # a vertex's vector comes by a join, so it stays out of the aggregate's buffers
    raws = rows.select(F.col("vec_id").alias("node"), "label", "dim", "key", "raw")
    nodes = stored(raws.join(groups, ["label", "dim", "key", "node"]).dropDuplicates(["label", "dim", "key", "node"]), "vec-nodes")

    axes = spark.sparkContext.broadcast(principal_axes(nodes))
    width = math.sqrt(max(0.0, 2 - 2 * threshold)) + 1e-9

    def place(batches):
        for b in batches:
            x = np.zeros(len(b["node"]), np.int64)
            y = x.copy()
            for dim in set(b["dim"]):
                at = [i for i, d in enumerate(b["dim"]) if d == dim]
                c = _unit([b["raw"][i] for i in at]) @ axes.value[dim][:, :2]
                x[at] = np.floor(c[:, 0] / width)
                y[at] = np.floor(c[:, 1] / width) if dim > 1 else 0
            yield {**{n: b[n] for n in ("node", "label", "dim", "weight", "raw")}, "x": x, "y": y}

    placed = stored(map_bytes(
        nodes.select("node", "label", "dim", "weight", "raw"), place,
        "node bigint, label string, dim int, weight bigint, raw binary, x int, y int", ("raw",)), "vec-placed")
    cell = ["label", "dim", "x", "y"]
    cells = stored(placed.groupBy(*cell).agg(F.count(F.lit(1)).alias("n")).withColumn(
        "tiles", F.ceil(F.col("n") / tile).cast("int")).drop("n"), "vec-cells")
    tiled = placed.join(cells, cell).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")).drop("tiles")

    shift = F.explode(F.array(*[F.struct(F.lit(dx).alias("dx"), F.lit(dy).alias("dy")) for dx, dy in HALF])).alias("d")
    half = cells.select("*", shift).select(
        "label", "dim", F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("tiles").alias("n_a"),
        (F.col("x") + F.col("d.dx")).alias("x"), (F.col("y") + F.col("d.dy")).alias("y"))
    pairs = half.join(cells, cell).select("*", F.explode(F.sequence(F.lit(0), F.col("n_a") - 1)).alias("i"))
    pairs = pairs.select("*", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("j"))
    pairs = pairs.where("ax != x or ay != y or i <= j").withColumn("task", F.xxhash64("label", "dim", "ax", "ay", "x", "y", "i", "j"))
    pairs = stored(pairs.select("task", "label", "dim", "ax", "ay", "i", F.col("x").alias("bx"), F.col("y").alias("by"), "j"), "vec-pairs")

    def side(x, y, t, name):
        to = pairs.select("task", "label", "dim", F.col(x).alias("x"), F.col(y).alias("y"), F.col(t).alias("tile"),
                          ((F.col("ax") == F.col("bx")) & (F.col("ay") == F.col("by")) & (F.col("i") == F.col("j"))).alias("same"))
        if name == "b":
            to = to.where("not same")  # a tile with itself needs one side only
        return tiled.join(to, [*cell, "tile"]).select("task", "same", F.lit(name).alias("side"), "dim", "node", "weight", "raw")

    def compare(group):
        a, b = group[group["side"] == "a"], group[group["side"] == "b"]
        same = bool(group["same"].iloc[0])
        b = a if same else b
        if not len(a) or not len(b):
            return _found([], [], [])
        turned = [_unit(list(g["raw"])) @ axes.value[int(group["dim"].iloc[0])] for g in (a, b)]
        i, j = tile_links(*turned, threshold)
        # the decision itself, from the given components
        close = _cosines(list(a["raw"]), list(b["raw"]), i, j) >= threshold
        i, j = i[close], j[close]
        if same:
            i, j = i[i < j], j[i < j]
            ids, weight, shift = a["node"].to_numpy(), a["weight"].to_numpy(), 0
        else:
            ids = np.concatenate([a["node"], b["node"]])
            weight, shift = np.concatenate([a["weight"], b["weight"]]), len(a)
        j = j + shift
        links = np.bincount(i, weight[j], len(ids)) + np.bincount(j, weight[i], len(ids))
        name = smallest_linked(len(ids), i, j)
        at = np.flatnonzero(links > 0)
        return _found(ids[at], links[at].astype(np.int64), ids[name[at]])

    grouped = side("ax", "ay", "i", "a").unionByName(side("bx", "by", "j", "b")).groupBy("task")
    found = stored(grouped.applyInPandas(compare, "node bigint, links bigint, other bigint"), "vec-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    parts = components(found.where("node != other").select(F.col("node").alias("a"), F.col("other").alias("b")), "vec-components")
    return _answer(vectors, rows, groups, links, parts)


def _found(nodes, links, others):
    import pandas as pd

    return pd.DataFrame({"node": np.array(nodes, np.int64), "links": np.array(links, np.int64), "other": np.array(others, np.int64)})


def _cosines(a: list[bytes], b: list[bytes], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    x, y = (np.frombuffer(b"".join(r), np.float64).reshape(len(r), -1) for r in (a, b))
    x, y = (v / np.abs(v).max(axis=1, keepdims=True) for v in (x, y))
    out = np.empty(len(i))
    for k in range(0, len(i), 100_000):
        p, q = x[i[k:k + 100_000]], y[j[k:k + 100_000]]
        out[k:k + 100_000] = (p * q).sum(axis=1) / np.sqrt((p * p).sum(axis=1) * (q * q).sum(axis=1))
    return out


def _answer(vectors: DataFrame, rows: DataFrame, groups: DataFrame, links: DataFrame, parts: DataFrame) -> DataFrame:
    """Results of the vertices back on all rows: per id the sum of its vectors' links."""
    known = groups.join(links, "node", "left").join(parts, "node", "left").select(
        "label", "dim", "key", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"),
        F.coalesce("component", "node").alias("part"))
    known = stored(known, "vec-known")
    each = rows.select("vec_id", "label", "dim", "key").join(known, ["label", "dim", "key"])
    each = each.groupBy("vec_id").agg(F.sum("n").alias("n"), F.min("part").alias("part")).withColumnRenamed("vec_id", "_id")
    joined = plain(vectors, "vec_id").join(each, F.col("vec_id") == F.col("_id"), "left")
    component = F.coalesce("part", "vec_id")
    return joined.select("vec_id", F.coalesce("n", F.lit(0)).alias("n_links"), component.alias("component_id"),
                         F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
