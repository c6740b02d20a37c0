"""Joins on shingles and vectors against brute force, and connected components."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.llm.common import components
from broadsheet.llm.embed import near_vectors, smallest_linked, tile_links
from broadsheet.llm.jaccard import JaccardParams, Shingles, jaccard_groups, jaccard_links, keep_one, list_pairs, signature

BLANKS = " \t\n\x0b\f\r"


def components_plain(nodes, edges):
    name = {n: n for n in nodes}

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        name[b] = a
    return {n: find(n) for n in nodes}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5000, i) for i in range(5001, 5100)]
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == components_plain(nodes, [e for e in edges if e[0] != e[1]])
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# shingles

def sets_plain(rows, k):
    out = []
    for doc_id, text in rows:
        words = [w for w in re.split(f"[{BLANKS}]+", (text or "").translate({i: i + 32 for i in range(65, 91)})) if w]
        n = min(k, len(words))
        out.append((doc_id, frozenset(tuple(words[i:i + n]) for i in range(len(words) - n + 1)) if words else frozenset()))
    return out


def jaccard_plain(rows, k, percent):
    sets = sets_plain(rows, k)
    edges = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
             if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y)]
    name = components_plain({a for a, _ in sets if a is not None}, edges)
    return sorted(((a, len(x), name.get(a)) for a, x in sets), key=repr)


def copies(seed, n=260):
    """Families of edited copies, a star whose members are only alike through its centre, chains and shared passages."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = " ".join(word() for _ in range(30))
    rows, bases = [], []
    for i in range(n):
        if bases and rng.random() < 0.6:
            words = list(rng.choice(bases[-12:]))
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                words[rng.randrange(len(words))] = word()
        else:
            words = [word() for _ in range(rng.choice([3, 4, 5, 30, 60, 120]))]
            if rng.random() < 0.4:
                words += passage.split()
        bases.append(words)
        rows.append((i * 3 + 1, rng.choice([" ", "\n", "\t "]).join(words).title()))
    centre = [f"c{i}" for i in range(200)]
    rows.append((90_000, " ".join(centre)))
    for i in range(40):
        words = list(centre)
        for at in rng.sample(range(200), 3):
            words[at] = f"x{i}_{at}"
        rows.append((90_001 + i, " ".join(words)))
    return rows


EDGE = [(2, None), (3, ""), (5, " \n"), (6, "one two"), (8, "ONE\x0btwo"), (9, "one two three"), (11, "one"), (None, "one two"), (12, "\x1cone two")]


@pytest.mark.parametrize("seed,params", [
    (1, JaccardParams()), (2, JaccardParams(words=5, percent=80, tile=7)), (3, JaccardParams(words=2, percent=50, hot=4, salts=2, shared=1))])
def test_jaccard_groups(docs, seed, params):
    rows = copies(seed) + EDGE
    got = jaccard_groups(docs(*rows), params)
    assert got.columns == ["doc_id", "n_shingles", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == jaccard_plain(rows, params.words, params.percent)


@pytest.mark.parametrize("seed,params", [
    (1, JaccardParams()), (2, JaccardParams(words=5, percent=80, tile=7)), (3, JaccardParams(words=2, percent=50, hot=4, salts=2, shared=1))])
def test_jaccard_links(docs, seed, params):
    rows = copies(seed) + EDGE
    sets = sets_plain(rows, params.words)
    links = {a: sum(b is not None and b != a and bool(x and y) and 100 * len(x & y) >= params.percent * len(x | y) for b, y in sets)
             for a, x in sets if a is not None}
    got = jaccard_links(docs(*rows), params)
    assert got.columns == ["doc_id", "n_shingles", "n_links", "component_id"]
    want = sorted(((a, n, links.get(a, 0), c) for a, n, c in jaccard_plain(rows, params.words, params.percent)), key=repr)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want and max(links.values()) > 5


def test_jaccard_repeated_ids_and_empty_tables(docs):
    rows = [(1, "a b c d e f g"), (1, "a b c d e f g"), (2, "a b c d e f g"), (2, "p q r s t u v")]
    got = jaccard_groups(docs(*rows)).collect()
    assert len(got) == 4 and all(r["n_shingles"] == 4 for r in got)
    assert jaccard_groups(docs()).count() == 0
    assert jaccard_groups(docs((1, None), (None, "a"))).count() == 2


def test_a_set_first_seen_under_an_id_that_stands_for_another_keeps_its_links(docs):
    texts = [" ".join(f"{x}{i}" for i in range(60)) for x in "pq"]
    kept, lost = sorted(texts, key=lambda t: signature(Shingles(4)(t.encode())))
    rows = [(1, lost), (1, kept), (2, lost), (3, lost + " more"), (4, kept + " more")]
    got = {(r["doc_id"], r["component_id"], r["n_links"]) for r in jaccard_links(docs(*rows).coalesce(1)).collect()}
    assert got == {(1, 1, 1), (2, 2, 1), (3, 2, 1), (4, 1, 1)}


def test_keep_one(docs):
    rows = copies(5, 80) + EDGE
    table = docs(*rows)
    kept = keep_one(table, jaccard_groups(table)).collect()
    want = {a for a, _, c in jaccard_plain(rows, 4, 85) if a == c}
    assert {r["doc_id"] for r in kept} == want and len(kept[0]) == len(table.columns)


def test_skipped_blocks_hold_no_pair():
    rng = np.random.default_rng(1)
    n = 700
    size = np.sort(rng.integers(10, 400, n))
    pos, part = rng.integers(0, 40, n) % (size // 6 + 1), rng.integers(0, 5, n)
    none = np.full(n, -1)
    room = size - pos
    for shared in (1, 3):
        i, j = list_pairs(size, pos, part, np.arange(n), none, none > 0, 85, shared)
        want = {(a, b) for a in range(n) for b in range(a + 1, n) if part[a] != part[b] and size[a] * 100 >= size[b] * 85
                and (min(room[a], room[b]) + shared - 1) * 185 >= 85 * (size[a] + size[b])}
        assert set(zip(i.tolist(), j.tolist())) == want


# vectors

def vectors_plain(rows, threshold):
    ok = [(i, x, np.array(v, float)) for i, v, x in rows if i is not None and x is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    edges = []
    links = {i: 0 for i, _, _ in rows}
    for k, (i, x, v) in enumerate(ok):
        for j, y, w in ok[:k]:
            if x == y and len(v) == len(w) and v @ w / np.sqrt((v @ v) * (w @ w)) >= threshold:
                edges.append((i, j))
                links[i] += 1
                links[j] += 1
    name = components_plain({i for i, _, _ in rows if i is not None}, edges)
    return sorted(((i, links[i] if i is not None else 0, name.get(i), i is not None and name[i] == i) for i, _, _ in rows), key=repr)


def vector_rows(seed, n=300, dim=24):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    rows = []
    for i in range(n):
        c = centres[rng.integers(8)] + rng.normal(size=dim) * rng.choice([0.0, 0.1, 0.25, 0.5])
        rows.append((int(i * 2), [float(x) for x in c.astype(np.float32)], int(rng.integers(3))))
    rows += [(10_001 + i, [1.0] * dim, 1) for i in range(30)]
    rows += [(20_001, None, 1), (20_003, [0.0] * dim, 1), (20_005, [1.0, None], 1), (20_007, [float("nan")] * dim, 1),
             (20_009, [float("inf")] * dim, 1), (20_011, [1.0] * dim, None), (20_013, [1.0, 2.0], 1), (20_015, [2.0, 4.0], 1),
             (20_017, [1e-30] * dim, 1), (20_019, [3.0], 1), (20_021, [4.0], 1), (20_023, [-4.0], 1), (20_025, [], 1), (None, [1.0] * dim, 1)]
    return rows


@pytest.mark.parametrize("seed,threshold,tile", [(1, 0.93, 1024), (3, 0.8, 20)])
def test_near_vectors(spark, seed, threshold, tile):
    rows = vector_rows(seed)
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    table = table.withColumn("node", F.lit("clash")).withColumn("key", F.lit(1))
    got = near_vectors(table, threshold, tile)
    assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == vectors_plain(rows, threshold)


def test_near_vectors_empty(spark):
    empty = spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")
    assert near_vectors(empty).count() == 0


def test_tile_links_lose_nothing():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(200, 40)) + rng.normal(size=(1, 40)) * 3
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    i, j = tile_links(x[:90], x[90:], 0.9, step=8)
    found = set(zip(i.tolist(), j.tolist()))
    assert {(a, b) for a, b in zip(*np.nonzero(x[:90] @ x[90:].T >= 0.9))} <= found


def test_smallest_linked():
    rng = random.Random(8)
    edges = [(rng.randrange(100), rng.randrange(100)) for _ in range(70)]
    got = smallest_linked(100, *np.array(edges).T)
    assert got.tolist() == [components_plain(range(100), edges)[i] for i in range(100)]


def test_jaccard_join_leaves_little_on_disk(docs, spark):
    """Tables that only lead to others are removed on the way, no set is stored whole, and the session's settings stay."""
    from pathlib import Path

    from broadsheet.llm import jaccard
    from broadsheet.llm.common import FREE
    from broadsheet.sources.sinks import shared_dir

    folder = Path(shared_dir(spark).removeprefix("file:"))
    old, setting = set(folder.glob("broadsheet-*/*")), spark.conf.get(FREE, "false")
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (2, text + " x"), (3, text + " y z"), (3, text + " y z"), (4, "other words of no set at all"), (5, None)]
    got = {r["doc_id"]: (r["n_links"], r["component_id"]) for r in jaccard.jaccard_links(docs(*rows)).collect()}
    assert got == {1: (2, 1), 2: (2, 1), 3: (2, 1), 4: (0, 4), 5: (0, 5)}
    left = {f.name for f in set(folder.glob("broadsheet-*/*")) - old}
    assert "jac-first" in left and not left & {"jac-ids", "jac-shared", "jac-lists", "jac-drawn", "jac-hashes", "jac-tagged", "jac-again"}
    assert spark.conf.get(FREE, "false") == setting
