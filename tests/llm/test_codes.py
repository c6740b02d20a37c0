"""Vector codes against plain Lloyd rounds in unbounded integers."""

import math
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.llm.codes import CodeParams, Codebook, assign, books_digest, tree_order, vector_codes, with_label_error


def codes_plain(rows, parts, entries, rounds):
    """Rows (vec_id, vector, label) in, (results, codebooks) out."""
    kept = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows
            if v is not None and None not in v and all(math.isfinite(x) and abs(256 * x) < 2**53 for x in v)]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0))
    dim = next((len(v) for _, v, _ in order if v and len(v) % parts == 0), 0)
    kept, order = [r for r in kept if len(r[1]) == dim], [r for r in order if len(r[1]) == dim]
    if not dim:
        return [], [[] for _ in range(parts)]
    w = dim // parts
    cut = lambda v: [v[k * w:(k + 1) * w] for k in range(parts)]
    books = [[cut(v)[k] for _, v, _ in order[:entries]] for k in range(parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(book))

    for _ in range(rounds):
        new = []
        for k, book in enumerate(books):
            mine = [nearest(cut(v)[k], book)[1] for _, v, _ in kept]
            means = []
            for j, e in enumerate(book):
                held = [cut(v)[k] for (_, v, _), m in zip(kept, mine) if m == j]
                means.append([sum(c) // len(held) for c in zip(*held)] if held else e)
            new.append(means)
        books = new
    out = []
    for i, v, y in kept:
        found = [nearest(x, book) for x, book in zip(cut(v), books)]
        out.append((i, "".join(f"{j:02x}" for _, j in found), sum(d for d, _ in found), y))
    sums = {}
    for *_, e, y in out:
        sums[y] = sums.get(y, 0) + e
    fits = lambda e: e if e < 2**63 else None
    return [(i, c, fits(e), fits(sums[y])) for i, c, e, y in out], books


def vector_rows(seed, n, dim):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, dim)) * 2
    rows = [(int(i), (centres[rng.integers(30)] + rng.normal(size=dim) * rng.choice([0.0, 0.01, 0.3])).astype(np.float32).astype(float).tolist(),
             None if i % 7 == 0 else int(i % 3)) for i in rng.permutation(n) * 3]
    rows += [(n * 3 + i, [1.0] * dim, 1) for i in range(25)] + rows[:4]
    return rows + [(1, None, 1), (2, [None] + [1.0] * (dim - 1), 1), (4, [math.nan] * dim, 1), (5, [math.inf] * dim, 0), (7, [], 1),
                   (8, [1.0] * (dim + 1), 1), (10, [0.0] * dim, 2), (None, [0.5] * dim, 2), (11, [-0.001] * dim, 9), (13, [1e300] * dim, 1), (16, [1.0] * 2 * dim, 1)]


@pytest.mark.parametrize("seed,dim,n,p", [
    (1, 16, 400, CodeParams()), (2, 64, 300, CodeParams(portion_bytes=64 * 8 * 50, leaf=4)), (3, 24, 200, CodeParams(parts=4, entries=16, rounds=3)),
    (4, 16, 20, CodeParams())])
def test_vector_codes(spark, seed, dim, n, p):
    rows = vector_rows(seed, n, dim)
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(3)
    table = table.withColumns({"_group": F.lit(1), "code": F.lit("clash"), "raw": F.lit(2), "ids": F.lit(3)})
    codes, books = vector_codes(table, p)
    want, plain_books = codes_plain(rows, p.parts, p.entries, p.rounds)
    assert books.tolist() == plain_books
    assert books_digest(books) == sha256(",".join(str(c) for b in plain_books for e in b for c in e).encode()).hexdigest()
    got = with_label_error(codes).select("vec_id", "code", "error", "label_error").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr) and len(want) > n


def test_vector_codes_with_large_components(spark):
    rows = [(i, [float((i * 7919 + j * 104_729) % 997) * 10.0**(i % 9) for j in range(16)], i % 2) for i in range(90)]
    codes, books = vector_codes(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int"))
    want, plain_books = codes_plain(rows, 16, 64, 2)
    assert books.tolist() == plain_books
    got = with_label_error(codes).select("vec_id", "code", "error", "label_error").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_vector_codes_of_nothing(spark):
    for rows in ([], [(1, None, 1)], [(1, [1.0] * 15, 1)]):
        codes, books = vector_codes(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int"))
        assert with_label_error(codes).count() == 0 and books.size == 0


@pytest.mark.parametrize("seed", range(6))
def test_dual_tree_assignment_is_exact_and_takes_whole_nodes(seed):
    rng = np.random.default_rng(seed)
    n, k, d = int(rng.integers(1, 3000)), int(rng.integers(1, 65)), int(rng.integers(1, 6))
    entries = rng.integers(-300, 300, (k, d))
    x = np.concatenate([entries[rng.integers(k, size=n)] + rng.integers(-2, 3, (n, d)), np.repeat(entries[:1], 200, axis=0)])
    x = x[tree_order(x, 16)]
    code, total, rows, by_node = assign(x, Codebook(entries), 16)
    want = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (code == want).all() and (rows == np.bincount(want, minlength=k)).all()
    assert all((total[j] == x[want == j].sum(axis=0)).all() for j in range(k)) and by_node > 0
