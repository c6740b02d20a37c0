"""Join of documents whose word shingles overlap: exact, with lists skipped by block and answers taken from similar sets."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import components, discard, freed, map_bytes, plain, stored, text_of

# Odd multipliers of the shingle hash.
MIX = (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
BLOCK = 256
# A set of more than this share of all ids is answered from a broadcast, of at most so many rows.
HOT_SETS = 4096
# Texts that are hashed before their sets are passed on.
SETS = 1024
# Marks elements that a set lacks, among those in which it differs from another.
GONE = 0x8000000000000001


@dataclass(frozen=True)
class JaccardParams:
    """Sets link if 100 * intersection >= percent * union. ``hot`` bounds the table of frequent shingles that every task
    holds; it orders the index. ``shared`` is how many index entries two sets must share to be compared, with as many
    more entries a set. Neither has an influence on results."""

    words: int = 4
    percent: int = 85
    shared: int = 4
    hot: int = 262_144
    salts: int = 16
    tile: int = 512


class Shingles:
    """64-bit hashes of a text's shingles, sorted and distinct; words' hashes are remembered up to ``limit``."""

    def __init__(self, words: int, limit: int = 150_000):
        self.words, self.limit, self.known = words, limit, {}

    def __call__(self, text: bytes) -> np.ndarray:
        import xxhash

        tokens, known = text.lower().split(), self.known
        if not tokens:
            return np.zeros(0, np.uint64)
        if len(known) > self.limit:
            known.clear()
        for w in set(tokens).difference(known):
            known[w] = xxhash.xxh3_64_intdigest(w)
        h = np.fromiter(map(known.__getitem__, tokens), np.uint64, len(tokens))
        k = min(self.words, len(h))
        out = np.full(len(h) - k + 1, k, np.uint64)  # the length keeps short texts apart from others' shingles
        for i in range(k):
            out = (out ^ h[i:len(h) - k + 1 + i]) * np.uint64(MIX[0])
            out = (out ^ (out >> np.uint64(29))) * np.uint64(MIX[1])
        out ^= out >> np.uint64(32)
        out.sort()
        return out[np.r_[True, out[1:] != out[:-1]]]


def signature(hashes: np.ndarray) -> bytes:
    import xxhash

    return xxhash.xxh3_128_digest(hashes.tobytes())


def needed(a, b, percent: int):
    """Smallest intersection with which sets of these sizes link."""
    return -((a + b) * percent // -(100 + percent))


def prefix(n, percent: int, shared: int = 1):
    """So many of the first elements of two linked sets, in any common order, share ``shared`` (or all they must share,
    if that is less): after the last of those, neither set has room for the rest of the smallest intersection."""
    return min(n, n - (-(n * percent // -100)) + shared)


def _sets_and_counts(docs: DataFrame, p: JaccardParams) -> DataFrame:
    """One pass: (doc_id, n, sig) of every row, and (hash, n) of shingles that a task saw in several different sets."""
    def run(batches):
        shingles, seen, held, size = Shingles(p.words), set(), [], 0

        def counts():
            found, n = np.unique(np.concatenate(held), return_counts=True)
            found, n = found[n > 1].view(np.int64), n[n > 1]
            for k in range(0, len(found), 100_000):
                part = slice(k, k + 100_000)
                m = len(found[part])
                yield {"doc_id": [None] * m, "n": n[part], "sig": [None] * m, "hash": found[part]}

        for b in batches:
            out = {"doc_id": b["doc_id"], "n": [], "sig": [], "hash": [None] * len(b["doc_id"])}
            for t in b["text"]:
                h = shingles(t)
                sig = signature(h)
                out["n"].append(len(h))
                out["sig"].append(sig)
                if sig not in seen and len(h):
                    seen.add(sig)
                    held.append(h)
                    size += len(h)
                    if size > 1_000_000:
                        yield from counts()
                        held, size = [], 0
            yield out
        if held:
            yield from counts()

    return stored(map_bytes(plain(docs, "doc_id", "text"), run, "doc_id bigint, n bigint, sig binary, hash bigint"), "jac-sets")


POSTING = "token bigint, doc_id bigint, mark int, at bigint"


def _postings(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray], p: JaccardParams) -> DataFrame:
    """(token, doc_id, mark, at): the prefix of every set, rare shingles first; ``mark`` is part of the set's signature,
    ``at`` holds size and position."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)  # at most ``hot`` entries

    def run(batches):
        shingles, seen = Shingles(p.words), set()
        keys, often = shared.value
        for b in batches:
            tokens, ids, marks, ats = [], [], [], []
            for doc_id, t, odd in zip(b["doc_id"], b["text"], b["odd"]):
                h = shingles(t)
                sig = signature(h)
                if doc_id is None or not len(h) or sig in seen:
                    continue
                if not odd:
                    seen.add(sig)
                n = len(h)
                count = np.zeros(n, np.int64)
                if len(keys):
                    slot = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
                    count = np.where(keys[slot] == h, often[slot], 0)
                # hashes are sorted, so those of equal counts keep their order
                first = np.argsort(count, kind="stable")[:prefix(n, p.percent, p.shared)]
                tokens.append(h[first])
                ids.append(np.full(len(first), doc_id))
                marks.append(np.full(len(first), int.from_bytes(sig[:4], "big", signed=True), np.int32))
                ats.append((n << 32) | np.arange(len(first)))
            if tokens:
                yield {"token": np.concatenate(tokens).view(np.int64), "doc_id": np.concatenate(ids),
                       "mark": np.concatenate(marks), "at": np.concatenate(ats)}

    return map_bytes(plain(docs, "doc_id", "text", "odd"), run, POSTING)


def _shared_only(postings: DataFrame) -> DataFrame:
    """Postings of tokens that stand in several lists' rows; most tokens occur once and end here."""
    def run(batches):
        last, met = None, False  # the row that may still find a neighbour, and whether it has one
        for b in batches:
            rows = [c.to_numpy() for c in b.columns]
            if not len(rows[0]):
                continue
            if last is not None:
                rows = [np.r_[x, y] for x, y in zip(last, rows)]
            same = rows[0][1:] == rows[0][:-1]
            keep = np.r_[False, same] | np.r_[same, False]
            keep[0] |= met
            last, met = [x[-1:] for x in rows], bool(keep[-1])
            keep[-1] = False
            yield pa.RecordBatch.from_arrays([pa.array(x[keep]) for x in rows], schema=b.schema)
        if met:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in last], schema=b.schema)

    dealt = postings.repartition("token").sortWithinPartitions("token")
    return dealt.mapInArrow(run, POSTING)


def list_pairs(size, pos, part, lead, over, near, percent: int, shared: int = 1):
    """Pairs (i, j) of one index list, sorted by size, that may link and do not belong to one component yet.

    The list is taken in blocks; a block skips all others whose sizes or positions cannot reach the needed intersection,
    this entry being one of the first ``shared`` that a pair has in common.
    Where two sets were compared with the same third set, that answer bounds theirs: they share at most what both have
    of it, and of the rest no more than the smaller rest. If both are near it, their own answer is known already.
    """
    out_i, out_j, n = [], [], len(size)
    room = size - pos  # elements from this token on
    for a in range(0, n, BLOCK):
        x = slice(a, min(a + BLOCK, n))
        for b in range(a, n, BLOCK):
            y = slice(b, min(b + BLOCK, n))
            if size[x][-1] * 100 < size[y][0] * percent:
                break  # all later blocks are larger still
            if min(room[x].max(), room[y].max()) + shared - 1 < needed(size[x][0], size[y][0], percent):
                continue
            least = needed(size[x][:, None], size[y][None, :], percent)
            ok = (np.minimum(room[x][:, None], room[y][None, :]) + shared - 1 >= least) & (size[x][:, None] * 100 >= size[y][None, :] * percent)
            ok &= part[x][:, None] != part[y][None, :]
            both = (lead[x][:, None] == lead[y][None, :]) & (over[x][:, None] >= 0) & (over[y][None, :] >= 0)
            ok &= ~(both & near[x][:, None] & near[y][None, :])
            bound = np.minimum(over[x][:, None], over[y][None, :]) + np.minimum((size - over)[x][:, None], (size - over)[y][None, :])
            ok &= ~both | (bound >= least)
            if a == b:
                ok = np.triu(ok, 1)
            i, j = np.nonzero(ok)
            out_i.append(i + a)
            out_j.append(j + b)
    return (np.concatenate(out_i), np.concatenate(out_j)) if out_i else (np.zeros(0, int), np.zeros(0, int))


def _candidates(lists: DataFrame, percent: int, shared: int) -> DataFrame:
    """Pairs (a, b) that share enough entries of the lists of (token, node, size, pos, part, lead, over, near)."""
    names = ["token", "node", "size", "pos", "part", "lead", "over", "near"]

    def pairs(rows):
        cuts = np.flatnonzero(np.r_[True, rows[0][1:] != rows[0][:-1], True])
        held, size_held = [], 0
        for s, e in zip(cuts[:-1], cuts[1:]):
            if e - s > 1:
                _, node, size, pos, part, lead, over, near = (c[s:e] for c in rows)
                i, j = list_pairs(size, pos, part, lead, over, near, percent, shared)
                turn = node[i] > node[j]
                i, j = np.where(turn, j, i), np.where(turn, i, j)
                held.append(np.stack([node[i], node[j], size[i], size[j]], axis=1))
                size_held += len(i)
                if size_held > 500_000:
                    yield from counted(np.concatenate(held))
                    held, size_held = [], 0
        if size_held:
            yield from counted(np.concatenate(held))

    def counted(found):
        found = found[np.lexsort((found[:, 1], found[:, 0]))]
        cuts = np.flatnonzero(np.r_[True, (found[1:, :2] != found[:-1, :2]).any(axis=1)])
        n = np.diff(np.r_[cuts, len(found)])
        for k in range(0, len(cuts), 100_000):
            at = cuts[k:k + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c) for c in found[at].T] + [pa.array(n[k:k + 100_000])], names=["a", "b", "size_a", "size_b", "n"])

    def run(batches):
        held: list[list[np.ndarray]] = []
        for batch in batches:
            rows = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            if not len(rows[0]):
                continue
            # the last token's list may go on in the next batch
            cut = int(np.searchsorted(rows[0], rows[0][-1], side="left"))
            if cut:
                held.append([c[:cut] for c in rows])
                yield from pairs([np.concatenate(x) for x in zip(*held)])
                held = []
            held.append([c[cut:] for c in rows])
        if held:
            yield from pairs([np.concatenate(x) for x in zip(*held)])

    dealt = lists.select(*names).repartition("token").sortWithinPartitions("token", "size", "node")
    pairs = dealt.mapInArrow(run, "a bigint, b bigint, size_a bigint, size_b bigint, n bigint")
    pairs = pairs.groupBy("a", "b", "size_a", "size_b").agg(F.sum("n").alias("n"))
    return pairs.where(F.col("n") >= _fewest("size_a", "size_b", percent, shared)).select("a", "b")


def _needed(a: str, b: str, percent: int) -> Column:
    return F.ceil((F.col(a) + F.col(b)) * F.lit(percent) / F.lit(100 + percent) - F.lit(1e-9))


def _fewest(a: str, b: str, percent: int, shared: int) -> Column:
    """Index entries that linked sets of these sizes share at least."""
    return F.least(F.lit(shared), _needed(a, b, percent))


def overlaps(pairs: DataFrame, docs: DataFrame, names: DataFrame, p: JaccardParams) -> DataFrame:
    """(a, b, common, apart) of pairs (a, b): each b's set comes first in its task, and the sets of its a follow in a
    stream. The partners of one b are spread over ``salts`` keys. ``apart`` holds what only one of two near sets has.

    Texts are joined with the places where their sets are needed and hashed there; sets are shuffled once, never stored.
    """
    salted = pairs.select("a", "b", F.pmod(F.xxhash64("a"), F.lit(p.salts)).cast("int").alias("salt"))
    heads = salted.select("b", "salt").distinct().select(F.col("b").alias("node"), "b", "salt", F.lit(None).cast("bigint").alias("a"))
    needed_at = heads.unionByName(salted.select(F.col("a").alias("node"), "b", "salt", "a")).join(names, "node")

    def run(batches):
        name, head = None, None
        for rows in batches:
            out = {"a": [], "b": [], "common": [], "apart": []}
            for b, salt, a, hashes in zip(rows["b"], rows["salt"], rows["a"], rows["hashes"]):
                here = np.frombuffer(hashes, np.uint64)
                if a is None:
                    name, head = b, here
                elif name == b:
                    at = np.minimum(np.searchsorted(head, here), len(head) - 1)
                    met = head[at] == here
                    n, apart = int(met.sum()), None
                    if 2 * n > len(here) and 2 * n > len(head):
                        gone = np.ones(len(head), bool)
                        gone[at[met]] = False
                        apart = np.concatenate([here[~met], head[gone] ^ np.uint64(GONE)]).tobytes()
                    for key, value in zip(out, (a, b, n, apart)):
                        out[key].append(value)
            yield out

    dealt = _sets_at(docs, needed_at, p).repartition("b", "salt").sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first())
    return map_bytes(dealt, run, "a bigint, b bigint, common bigint, apart binary", ("hashes",))


def near_pair_links(a, b, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Linked pairs (row of a, row of b) of two tables (size, common, apart, size_lead) of sets near the same lead.

    The intersection follows from the answers with the lead and the few elements in which each set differs from it:
    the lead without what either lacks, and what both added.
    """
    sides = [[np.frombuffer(x, np.uint64) for x in t["apart"]] for t in (a, b)]
    flat = [np.concatenate(s) if s else np.zeros(0, np.uint64) for s in sides]
    both = np.intersect1d(*flat)
    shared = np.zeros((len(a), len(b)), np.float32)
    row = [np.repeat(np.arange(len(s)), [len(x) for x in s]) for s in sides]
    place = [np.minimum(np.searchsorted(both, f), max(0, len(both) - 1)) for f in flat]
    held = [both[p] == f if len(both) else np.zeros(len(f), bool) for p, f in zip(place, flat)]
    for k in range(0, len(both), 4096):
        blocks = []
        for s, r, p, h in zip(sides, row, place, held):
            here = h & (p >= k) & (p < k + 4096)
            x = np.zeros((len(s), min(4096, len(both) - k)), np.float32)
            x[r[here], p[here] - k] = 1
            blocks.append(x)
        shared += blocks[0] @ blocks[1].T
    lead, x, y = int(a["size_lead"].iloc[0]), a["common"].to_numpy(), b["common"].to_numpy()
    common = lead - (lead - x)[:, None] - (lead - y)[None, :] + shared.astype(np.int64)
    union = a["size"].to_numpy()[:, None] + b["size"].to_numpy()[None, :] - common
    return np.nonzero(common * 100 >= percent * union)


def _near_links(first: DataFrame, percent: int, tile: int, weights: DataFrame | None = None) -> DataFrame:
    """(a, b, links) that connect all links between sets near one lead, at least one of them not linked with the lead
    itself. With ``weights`` (node, weight) all sets are compared, and ``links`` adds up the weights of those linked with a.

    The sets of a lead are cut into tiles; a task compares two tiles by what its sets differ in, and sends links that
    connect the same sets, never its pairs.
    """
    rows = first.where("apart is not null").select(
        F.col("a").alias("node"), F.col("b").alias("lead"), (~F.col("linked")).cast("int").alias("open"),
        F.col("size_a").alias("size"), "common", "apart", F.col("size_b").alias("size_lead"))
    if weights is None:
        rows = rows.withColumn("weight", F.lit(0).cast("bigint"))
    else:
        rows = rows.withColumn("open", F.lit(1)).join(weights, "node")
    counts = stored(rows.groupBy("lead", "open").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles")), "jac-tiles")
    placed = rows.join(counts, ["lead", "open"]).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int")).drop("tiles")
    left = counts.where("open = 1").select("lead", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("i"))
    right = counts.select("lead", F.col("open").alias("to"), F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("j"))
    tasks = left.join(right, "lead").where("to = 0 or i <= j")

    def side(name):
        own, open_ = ("i", F.lit(1)) if name == "a" else ("j", F.col("to"))
        to = tasks.select("lead", "i", "j", "to", F.col(own).alias("tile"), open_.alias("open"))
        if name == "b":
            to = to.where("to = 0 or i < j")  # a tile with itself needs one side only
        return placed.join(to, ["lead", "tile", "open"]).select(
            "lead", "i", "j", "to", F.lit(name).alias("side"), "node", "size", "common", "apart", "size_lead", "weight")

    def compare(group):
        import pandas as pd

        from broadsheet.llm.embed import smallest_linked

        a, b = group[group["side"] == "a"], group[group["side"] == "b"]
        same = bool((group["to"].iloc[0] == 1) and group["i"].iloc[0] == group["j"].iloc[0])
        b = a if same else b
        if not len(a) or not len(b):
            return pd.DataFrame({x: np.zeros(0, np.int64) for x in ("a", "b", "links")})
        i, j = near_pair_links(a, b, percent)
        if same:
            i, j = i[i < j], j[i < j]
        else:
            j = j + len(a)
        ids, weight = (a[x].to_numpy() if same else np.concatenate([a[x], b[x]]) for x in ("node", "weight"))
        links = np.bincount(i, weight[j], len(ids)) + np.bincount(j, weight[i], len(ids))
        name = smallest_linked(len(ids), i, j)
        at = np.flatnonzero((name != np.arange(len(ids))) | (links > 0))
        return pd.DataFrame({"a": ids[at], "b": ids[name[at]], "links": links[at].astype(np.int64)})

    return side("a").unionByName(side("b")).groupBy("lead", "i", "j", "to").applyInPandas(compare, "a bigint, b bigint, links bigint")


def _linked(percent: int) -> Column:
    return F.col("common") * 100 >= F.lit(percent) * (F.col("size_a") + F.col("size_b") - F.col("common"))


def jaccard_groups(docs: DataFrame, p: JaccardParams = JaccardParams()) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every row of ``docs`` (doc_id bigint, text).

    1. One pass hashes every text's shingles; equal sets become one node, named by its smallest id.
    2. A second pass indexes the first elements of each set in an order that puts frequent shingles last; linked sets
       share one of them.
    3. Every node is compared with the most connected set of its lists, its lead. Nodes near one lead get the answers
       among themselves from the elements in which each differs from it. All these answers form components.
    4. Only sets of different components that share a list are still candidates. Lists are skipped by blocks of size
       and position, and by what the answers of step 3 imply; what remains is compared exactly.

    No text, no word or null id: no links, its own component (null for a null id). Fewer words than a shingle: the whole
    sequence is the one shingle. Rows that repeat an id: one node, whose links are those of its row with the smallest
    set signature. Empty table: no rows.
    """
    return _joined(docs, p, False).select("doc_id", "n_shingles", "component_id")


def jaccard_links(docs: DataFrame, p: JaccardParams = JaccardParams()) -> DataFrame:
    """(doc_id, n_shingles, n_links, component_id) of every row: the groups of ``jaccard_groups``, and with how many
    other ids a row's id is linked.

    Every candidate pair is decided, also inside a component: sets near one lead in the tiles, all others exactly. Equal
    sets are compared once and count with the number of their ids. Null id, no text or no word: 0.
    """
    return _joined(docs, p, True)


def _joined(docs: DataFrame, p: JaccardParams, count: bool) -> DataFrame:
    """The groups, and with ``count`` the links of every id; without, steps 3 and 4 leave out what changes no group.
    Shuffle files and stored tables are removed as soon as nothing reads them any more."""
    with freed(docs.sparkSession):
        return _steps(docs, p, count)


def _steps(docs: DataFrame, p: JaccardParams, count: bool) -> DataFrame:
    slim = plain(docs, "doc_id", "text")
    found = _sets_and_counts(slim, p)
    rows = found.where("sig is not null").select("doc_id", "n", "sig")
    often = found.where("sig is null").groupBy("hash").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "hash").limit(p.hot).toArrow()
    keys = often["hash"].to_numpy().view(np.uint64) if len(often) else np.zeros(0, np.uint64)
    order = np.argsort(keys)
    hot = keys[order], (often["n"].to_numpy() if len(often) else np.zeros(0, np.int64))[order]

    one = rows.where("doc_id is not null and n > 0").groupBy("doc_id").agg(F.min("sig").alias("sig"), (F.min("sig") != F.max("sig")).alias("odd"))
    ids = stored(one, "jac-ids")
    of = stored(_named(ids), "jac-nodes")
    discard(ids)

    # ids with several sets lose the entries of all but one, so those do not make others' entries needless
    odd = of.where("odd").select("doc_id", "odd")
    marked = slim.withColumn("odd", F.lit(False)) if odd.isEmpty() else slim.join(odd, "doc_id", "left")
    shared = stored(_shared_only(_postings(marked, hot, p)), "jac-shared")
    # of rows that repeat an id, the entries of the set that stands for it
    bits = F.conv(F.hex(F.substring("sig", 1, 4)), 16, 10).cast("bigint")
    mark = F.when(bits >= 1 << 31, bits - (1 << 32)).otherwise(bits).cast("int").alias("mark")
    lists = shared.join(of.select("doc_id", "node", mark), ["doc_id", "mark"]).select(
        "token", "node", F.shiftright("at", 32).alias("size"), F.col("at").bitwiseAND(F.lit((1 << 32) - 1)).alias("pos"))
    lists = lists.dropDuplicates(["token", "node"])
    entries = stored(lists, "jac-lists")
    discard(shared)

    # how much of a set's index entries it shares: near one for a text that others were made from
    ties = entries.groupBy("token").agg(F.count(F.lit(1)).alias("m")).where("m > 1")
    lists = entries.join(ties, "token")
    pull = lists.groupBy("node").agg((F.sum("m") / F.max("size")).alias("pull"))
    drawn = stored(lists.join(pull, "node"), "jac-drawn")
    discard(entries)
    leaders = drawn.groupBy("token").agg(F.max(F.struct("pull", F.col("node").alias("lead"))).alias("best")).select("token", "best.lead")
    votes = drawn.join(leaders, "token").where("node != lead").groupBy("node", "lead").agg(
        F.count(F.lit(1)).alias("n"), F.max("size").alias("size"))
    chosen = votes.groupBy("node").agg(F.max(F.struct("n", "lead")).alias("best"), F.max("size").alias("size"))
    chosen = stored(chosen.where(F.col("best.n") >= _fewest("size", "size", p.percent, p.shared)).select("node", "best.lead"), "jac-chosen")

    # a set with fewer entries in common with all others together than it needs with one is linked with none
    sizes = drawn.groupBy("node").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n"))
    least = F.least(F.lit(p.shared), F.ceil(F.col("size") * F.lit(p.percent) / 100 - F.lit(1e-9)))
    sizes = stored(sizes.where(F.col("n") >= least).select("node", "size"), "jac-sizes")
    names, able = of.where("doc_id = node").select("node", "sig"), sizes.select("node")

    first = _compared(chosen.select(F.col("node").alias("a"), F.col("lead").alias("b")).join(able.withColumnRenamed("node", "a"), "a").join(
        able.withColumnRenamed("node", "b"), "b"), slim, names, sizes, p)
    first = stored(first.dropDuplicates(["a", "b"]), "jac-first")
    weights = stored(of.groupBy("node").agg(F.count(F.lit(1)).alias("weight")), "jac-weights") if count else None
    near = stored(_near_links(first, p.percent, p.tile, weights), "jac-near")
    edges = first.where("linked").select("a", "b").unionByName(near.where("a != b").select("a", "b"))
    parts = components(edges, "jac-parts")

    answers = first.select(
        F.col("a").alias("node"), F.col("b").alias("lead"), F.col("common").alias("over"), F.col("apart").isNotNull().alias("near"))
    # a leader is compared with itself
    own = chosen.select(F.col("lead").alias("node")).distinct().join(answers.select("node"), "node", "left_anti").join(sizes, "node").select(
        "node", F.col("node").alias("lead"), F.col("size").alias("over"), F.lit(True).alias("near"))
    known = stored(sizes.select("node").join(answers.unionByName(own), "node", "left").join(parts, "node", "left").select(
        "node", (F.col("node") if count else F.coalesce("component", "node")).alias("part"), F.coalesce("lead", "node").alias("lead"),
        F.coalesce("over", F.lit(-1)).alias("over"), F.coalesce("near", F.lit(False)).alias("near")), "jac-known")
    tagged = stored(drawn.select("token", "node", "size", "pos").join(known, "node"), "jac-tagged")
    discard(drawn)
    mixed = tagged.groupBy("token").agg(F.min("part").alias("low"), F.max("part").alias("high")).where("low != high").select("token")
    rest = _candidates(tagged.join(mixed, "token", "left_semi"), p.percent, p.shared)
    answered = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), "linked").dropDuplicates(["a", "b"])
    if count:
        rest = rest.join(answered, ["a", "b"], "left_anti")
    rest = stored(rest, "jac-candidates")
    discard(tagged)
    second = _compared(rest, slim, names, sizes, p).select("a", "b", "linked").dropDuplicates(["a", "b"])
    second = stored(second, "jac-second")
    final = components(edges.unionByName(second.where("linked").select("a", "b")), "jac-final")

    named = of.join(final, "node", "left").select(F.col("doc_id").alias("_id"), F.coalesce("component", "node").alias("part"))
    if count:
        both = answered.unionByName(second).where("linked")
        ends = both.select(F.col("a").alias("to"), F.col("b").alias("node")).unionByName(both.select(F.col("b").alias("to"), F.col("a").alias("node")))
        links = ends.join(weights, "node").select(F.col("to").alias("node"), F.col("weight").alias("links"))
        links = links.unionByName(near.select(F.col("a").alias("node"), "links")).groupBy("node").agg(F.sum("links").alias("links"))
        total = weights.join(links, "node", "left").select("node", (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
        named = of.join(final, "node", "left").join(total, "node").select(
            F.col("doc_id").alias("_id"), F.coalesce("component", "node").alias("part"), "n_links")
    else:
        named = named.withColumn("n_links", F.lit(0).cast("bigint"))
    out = rows.select("doc_id", F.col("n").alias("n_shingles")).join(named, F.col("doc_id") == F.col("_id"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("part", "doc_id").alias("component_id"))


def _named(one: DataFrame) -> DataFrame:
    """(doc_id, node, sig, odd) of (doc_id, sig, odd): a set's node is its smallest id. At most ``HOT_SETS`` sets can hold so
    great a share of the ids each; their ids never meet in a task, and the join of the others has no hot key."""
    groups = stored(one.groupBy("sig").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("size")), "jac-groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    much = (F.col("size") > 1) & (F.col("size") * HOT_SETS >= F.lit(total))
    hot, cold = groups.where(much).select("sig", "node"), groups.where(~much).select("sig", "node")
    names = ["doc_id", "node", "sig", "odd"]
    rest = one.join(F.broadcast(hot.select("sig")), "sig", "left_anti")
    return one.join(F.broadcast(hot), "sig").select(*names).unionByName(rest.join(cold, "sig").select(*names))


def _sets_at(docs: DataFrame, places: DataFrame, p: JaccardParams) -> DataFrame:
    """(b, salt, a, hashes) of places (node, b, salt, a, sig): the node's set, from the texts of the rows it is named by."""
    def run(batches):
        shingles, last, h = Shingles(p.words), None, None
        for rows in batches:
            out = {"b": [], "salt": [], "a": [], "hashes": []}
            for node, b, salt, a, sig, version, t in zip(*(rows[x] for x in ("node", "b", "salt", "a", "sig", "version", "text"))):
                if (node, version) != last:  # a node's places follow one another
                    h, last = shingles(t), (node, version)
                    h = h.tobytes() if signature(h) == sig else None
                if h is not None:
                    for key, value in zip(out, (b, salt, a, h)):
                        out[key].append(value)
            yield out

    texts = docs.select(F.col("doc_id").alias("node"), text_of().alias("text")).join(places.hint("merge"), "node")
    # equal rows are made one where the join has brought them together
    names = ["node", "version", "b", "salt", "a"]
    texts = texts.withColumn("version", F.xxhash64("text")).dropDuplicates(names)
    return map_bytes(texts.select(*names, "sig", "text"), run, "b bigint, salt int, a bigint, hashes binary", ("text", "sig"), SETS)


def _compared(pairs: DataFrame, docs: DataFrame, names: DataFrame, sizes: DataFrame, p: JaccardParams) -> DataFrame:
    found = overlaps(pairs, docs, names, p)
    a, b = (sizes.select(F.col("node").alias(x), F.col("size").alias(f"size_{x}")) for x in "ab")
    return found.join(a, "a").join(b, "b").select("a", "b", "common", "apart", "size_a", "size_b", _linked(p.percent).alias("linked"))


def keep_one(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows of ``docs`` that name their component: one document of each group, rows without id all."""
    gone = groups.where("doc_id != component_id").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
