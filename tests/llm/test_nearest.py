"""Nearest neighbours against brute force: exact where the stopping test is sure, recall where it is not."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.llm.nearest import NearestParams, chi_square, chi_square_limit, nearest, search

SCHEMA = "vec_id bigint, embedding array<{}>, label int, sig string, cell int, ids int, raw int, bound string"


def nearest_plain(rows, k, dim):
    ok = {(i, tuple(v)) for i, v in rows if i is not None and v and len(v) == dim and None not in v and all(map(math.isfinite, v)) and any(v)}
    ok = sorted(ok)
    ids, x = np.array([i for i, _ in ok], np.int64), np.array([v for _, v in ok], np.float64).reshape(len(ok), dim)
    out = set()
    for i, v in ok:
        if i % 10 == 0:
            d = np.sqrt(((x - np.array(v)) ** 2).sum(axis=1))
            order = [j for j in np.lexsort((ids, d)) if ids[j] != i][:k]
            out |= {(i, rank, int(ids[j]), float(d[j])) for rank, j in enumerate(order, 1)}
    return out


def vector_rows(seed, n, dim):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    rows = [(int(i), (centres[rng.integers(12)] + rng.normal(size=dim) * rng.choice([0.05, 0.5])).astype(np.float32).astype(float).tolist())
            for i in rng.permutation(n)]
    hot = [2.0] + [1.0] * (dim - 1)
    rows += [(n + i, hot) for i in range(n // 3)] + rows[:3]
    rows += [(10 * n + 10 * i, [float(i), *hot[1:]]) for i in range(4)]
    return rows + [(None, hot), (20 * n, None), (20 * n + 10, [0.0] * dim), (20 * n + 20, [None] * dim), (20 * n + 30, [math.nan] * dim),
                   (20 * n + 40, [math.inf] * dim), (20 * n + 50, []), (20 * n + 60, [1.0]), (20 * n + 70, [-0.0] + hot[1:]), (20 * n + 80, [0.0] + hot[1:])]


def table_of(spark, rows, element="double"):
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4, "y") for r in rows], SCHEMA.format(element)).repartition(3)


@pytest.mark.parametrize("seed,n,dim,element", [(1, 300, 16, "double"), (2, 900, 24, "float")])
def test_nearest_is_exact_when_the_test_is_sure(spark, seed, n, dim, element):
    rows = vector_rows(seed, n, dim)
    p = NearestParams(k=7, p=1 - 1e-12, sample=400, cell=60, block=50, queries=20, leaf=16)
    got = nearest(table_of(spark, rows, element), F.col("vec_id") % 10 == 0, p)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    key = lambda rows: sorted((a, b, c, round(d, 9)) for a, b, c, d in rows)
    assert key(got.collect()) == key(nearest_plain(rows, 7, dim))


def test_nearest_recall_with_production_parameters(spark):
    rng = np.random.default_rng(3)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(9000, 48)) * np.linspace(1.5, 0.3, 48))]
    got = {(r["query_id"], r["vec_id"]) for r in nearest(table_of(spark, rows), F.col("vec_id") % 100 == 0).collect()}
    want = {(a, c) for a, _, c, _ in nearest_plain(rows, 10, 48) if a % 100 == 0}
    assert len(got) == len(want) == 900 and len(got & want) >= 0.9 * len(want)


def test_nearest_few_or_none(spark):
    yes = F.lit(True)
    assert nearest(table_of(spark, []), yes).count() == 0
    assert nearest(table_of(spark, [(1, [1.0, 2.0]), (2, None)]), yes).count() == 0
    pair = nearest(table_of(spark, [(1, [1.0, 2.0]), (2, [4.0, 6.0]), (2, [4.0, 6.0])]), yes)
    assert sorted(map(tuple, pair.collect())) == [(1, 1, 2, 5.0), (2, 1, 1, 5.0)]
    large = nearest(table_of(spark, [(1, [3e300, 1.0]), (2, [0.0, 1.0]), (3, [1e300, 1.0])]), yes).collect()
    assert {(r["query_id"], r["rank"], r["vec_id"]) for r in large} == {(1, 1, 3), (1, 2, 2), (2, 1, 3), (2, 2, 1), (3, 1, 2), (3, 2, 1)}
    assert all(math.isfinite(r["score"]) for r in large)


def test_chi_square():
    rng = np.random.default_rng(1)
    for m in (2, 8, 12):
        drawn = (rng.normal(size=(200_000, m)) ** 2).sum(axis=1)
        for p in (0.5, 0.9, 0.99):
            assert abs((drawn <= chi_square_limit(p, m)).mean() - p) < 0.005 and abs(chi_square(chi_square_limit(p, m), m) - p) < 1e-9


def test_the_stopping_test_leaves_vectors_untried():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(4000, 64)) + 5, rng.normal(size=(4000, 64)) - 5])
    matrix = rng.normal(size=(64, 8))
    ids = np.arange(len(x))[:, None]
    _, found, tried = search(x @ matrix, x, ids, x[:20] @ matrix, x[:20], np.full(20, np.inf), 11, chi_square_limit(0.97, 8))
    assert tried < 20 * 4200 and (found[:, 0] == np.arange(20)).all()
