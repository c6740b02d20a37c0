"""The dataset manifest against a tree built plainly in memory."""

from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from broadsheet.llm.merkle import leaf, manifest

ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, leaf string, tree int, pos int, root string, bin int"


def h(*texts):
    return sha256("".join(texts).encode()).hexdigest()


def leaf_plain(doc_id, source, lang, n_chars, text):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def proof_plain(nodes, at):
    """(root, [(left, right) per level]) by building every level."""
    way = []
    while len(nodes) > 1:
        first = at // 3 * 3
        way.append(("".join(nodes[first:at]), "".join(nodes[at + 1:first + 3])))
        nodes, at = [h(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)], at // 3
    return nodes[0], way


def manifest_plain(rows, changed):
    leaves = [(leaf_plain(i, s, la, n, t), leaf_plain(*changed(i, s, la, n, t)), i, s) for i, t, la, s, n in rows]
    sources = sorted({x[3] for x in leaves}, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted((x for x in leaves if x[3] == s), key=lambda x: (x[2] is not None, x[2] or 0, x[0])) for s in sources}
    subroots = [proof_plain([x[0] for x in trees[s]], 0)[0] for s in sources]
    out = []
    for k, s in enumerate(sources):
        root, above = proof_plain(subroots, k)
        for at, (own, claim, i, _) in enumerate(trees[s]):
            _, way = proof_plain([x[0] for x in trees[s]], at)
            folded = claim
            for left, right in way + above:
                folded = h(left, folded, right)
            out.append((i, s, own, subroots[k], root, "".join(a + b for a, b in way + above), folded, folded == root))
    return sorted(out, key=repr)


def rows_of(n, sources):
    rows = [(i, f"text {i}\nß line\n" if i % 3 else None, "en" if i % 2 else None, sources[i * i % len(sources)], i or None) for i in range(n)]
    return rows + [(None, "", None, None, None), (None, "", None, None, None), (4, "again", "de", "b", 5), (2**60 + 1, "x" * 200_000, "en", "ü", 1)]


@pytest.mark.parametrize("n,levels,sources", [
    (40, 6, ["a"]), (100, 1, ["b", None, "", "é", "a", "-", ":"]), (130, 2, ["hot"] * 9 + ["b"] + [f"s{i}" for i in range(20)]), (0, 6, ["a"])])
def test_manifest(spark, n, levels, sources):
    rows = rows_of(n, sources) if n else [(7, "only", "en", "a", 4)]
    table = spark.createDataFrame([(*r, "clash", 1, 2, "x", 3) for r in rows], ODD).repartition(3)
    claimed = F.when(F.col("doc_id") % 2 == 0, leaf(text=F.replace(F.col("text"), F.lit("\n"), F.lit("")))).otherwise(leaf())
    got = manifest(table, claimed, levels=levels)
    want = manifest_plain(rows, lambda i, s, la, m, t: (i, s, la, m, t.replace("\n", "") if t and i is not None and i % 2 == 0 else t))
    found = [(r["doc_id"], r["source"], r["leaf"], r["subroot"], r["root"], r["proof"], r["folded_root"], r["verified"]) for r in got.collect()]
    assert sorted(found, key=repr) == want
    assert n == 0 or {r[-1] for r in want} == {True, False}


def test_manifest_defaults_and_empty_table(docs):
    assert all(r["verified"] for r in manifest(docs((1, "a"), (2, None), (2, None), (3, ""))).collect())
    assert manifest(docs()).count() == 0
