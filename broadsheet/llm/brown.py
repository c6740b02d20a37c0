"""Class-based n-gram scores: words exchanged between classes, class transitions, word emissions."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import map_bytes, plain, stored

# Texts that are cut into words at a time, and blocks of neighbour counts on their way into larger ones that are Python objects.
TEXTS, PIECES = 1024, 256


@dataclass(frozen=True)
class BrownParams:
    """``words`` most frequent words are clustered one by one, all others in ``tails`` groups by their last bytes, so that
    every word has a class. ``refine`` then lets each word that occurs ``least`` times choose its own class, in rounds
    until two of them raise the log likelihood by less than the share ``gained`` each. ``known`` words' counts are at hand in every task; the others' are joined."""

    classes: int = 32
    words: int = 768
    tails: int = 256
    tail_bytes: int = 3
    sweeps: int = 6
    smoothing: float = 50.0
    known: int = 131_072
    least: int = 5
    gained: float = 3e-4
    rounds: int = 30


def tokens(text: bytes) -> list[bytes]:
    """Words of a text, A-Z lower-cased (on bytes, both concern ASCII only)."""
    return text.lower().split()


def tail(word: bytes, p: BrownParams) -> int:
    return p.words + zlib.crc32(word[-p.tail_bytes:]) % p.tails


def numbered(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct ``tokens`` of texts, the numbers in them of all tokens, and how many tokens each text has. Arrow cuts and
    numbers the words; none becomes a Python object. Null counts as empty."""
    low = pc.ascii_trim_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    lists = pc.ascii_split_whitespace(low)
    empty = pc.equal(low, "").to_numpy(zero_copy_only=False)
    n = np.where(empty, 0, np.diff(lists.offsets.to_numpy()))
    flat = lists.flatten()
    if empty.any():
        flat = flat.filter(pc.not_equal(flat, ""))
    flat = flat.dictionary_encode()
    return flat.dictionary.cast(pa.binary()), flat.indices.to_numpy().astype(np.int64), n.astype(np.int64)


def places(words: pa.Array, among: pa.Array) -> np.ndarray:
    """Place of each word in ``among``, -1 if it is not there."""
    return pc.fill_null(pc.index_in(words, value_set=among), -1).to_numpy().astype(np.int64)


def tails(words: pa.Array, p: BrownParams) -> np.ndarray:
    """``tail`` of many words; only the distinct last bytes become Python objects."""
    last = pc.binary_slice(words, -p.tail_bytes).dictionary_encode()
    return np.array([tail(w, p) for w in last.dictionary.to_pylist()], np.int64)[last.indices.to_numpy()]


def lined(values: np.ndarray, n: np.ndarray, end: float) -> np.ndarray:
    """The values of all tokens, ``end`` after those of each text."""
    out = np.full(len(values) + len(n), end, values.dtype)
    out[np.arange(len(values)) + np.repeat(np.arange(len(n)), n)] = values
    return out


def _some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (big.slice(a, TEXTS) for big in batches for a in range(0, big.num_rows, TEXTS))


def word_counts(docs: DataFrame) -> DataFrame:
    """(word binary, n) over all words of all texts. Tasks add up what they read and pass on partial counts."""
    def run(batches):
        held, size = [], 0

        def added():
            both = pa.concat_tables(held).group_by("word", use_threads=False).aggregate([("n", "sum")])
            return both.select(["word", "n_sum"]).rename_columns(["word", "n"])

        for b in _some(batches):
            words, code, _ = numbered(b.column("text"))
            held.append(pa.table({"word": words, "n": np.bincount(code, minlength=len(words)).astype(np.int64)}))
            size += len(words)
            if size > 600_000:
                held = [added()]
                size = held[0].num_rows
                if size > 300_000:  # memory; the parts are added by the aggregate
                    yield from held.pop().to_batches(max_chunksize=100_000)
                    size = 0
        if held:
            yield from added().to_batches(max_chunksize=100_000)

    counted = plain(docs, "text").mapInArrow(run, "word binary, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def bigrams(docs: DataFrame, words: list[bytes], p: BrownParams) -> np.ndarray:
    """Counts of neighbouring units, the text's end (the last unit) before the first and after the last word. The
    matrix has (words + tails + 1) squared cells whatever the input; the driver gets their sums."""
    size = p.words + p.tails + 1

    def run(batches):
        frequent, found = pa.array(words, pa.binary()), np.zeros(size * size, np.int64)
        end = np.array([size - 1])
        held, waiting = [end], 0

        def add():
            a = np.concatenate(held)
            found[:] += np.bincount(a[:-1] * size + a[1:], minlength=size * size)

        for b in _some(batches):
            distinct, code, n = numbered(b.column("text"))
            unit = places(distinct, frequent)
            rest = np.flatnonzero(unit < 0)
            unit[rest] = tails(distinct.take(pa.array(rest)), p)
            line = lined(unit[code], n, size - 1)
            held.append(line)
            waiting += len(line)
            if waiting > 1_000_000:
                add()
                held, waiting = [end], 0
        add()
        at = np.flatnonzero(found)
        for k in range(0, len(at), 100_000):
            part = at[k:k + 100_000]
            yield pa.RecordBatch.from_arrays([
                pa.array(part // size, pa.int32()), pa.array(part % size, pa.int32()), pa.array(found[part])], names=["a", "b", "n"])

    cells = plain(docs, "text").mapInArrow(run, "a int, b int, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((size, size), np.int64)
    out[cells["a"].to_numpy(), cells["b"].to_numpy()] = cells["n"].to_numpy()
    return out


def _f(x):
    return x * np.log(np.maximum(x, 1))


def _gain(pairs, total, out, into, self_n, weight) -> np.ndarray:
    """What the likelihood gains per class that a word joins, the word being in none. ``out`` and ``into`` count the
    classes after and before it without itself; the end's class is closed."""
    gain = (_f(pairs + out) - _f(pairs)).sum(axis=1) + (_f(pairs + into[:, None]) - _f(pairs)).sum(axis=0)
    diagonal = np.diagonal(pairs)
    both = _f(diagonal + out + into + self_n) - _f(diagonal)
    gain += both - (_f(diagonal + out) - _f(diagonal)) - (_f(diagonal + into) - _f(diagonal))
    gain -= 2 * (_f(total + weight) - _f(total))
    gain[-1] = -np.inf
    return gain


def _gains(pairs, total, out, into, self_n, now) -> np.ndarray:
    """``_gain`` of many words at once, a row each, every word being taken out of its class ``now`` first. Only the
    classes that a word has as neighbours change anything, so a rare word costs few of them."""
    line, diagonal = np.arange(len(now)), np.diagonal(pairs)
    weight = out.sum(axis=1) + self_n
    gain = np.zeros((len(now), len(pairs)))
    for cells, known, near, far in ((pairs.T, _f(pairs).T, out, into), (pairs, _f(pairs), into, out)):
        row, c = np.nonzero(near)
        x, own = near[row, c], now[row]
        m, f, each = cells[c], known[c], np.arange(len(row))
        m[each, own] -= x
        same = np.flatnonzero(c == own)  # neighbours inside the word's own class
        m[same] -= far[row[same]]
        m[same, own[same]] -= self_n[row[same]]
        f[each, own] = _f(m[each, own])
        f[same] = _f(m[same])
        change = _f(m + x[:, None]) - f
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])[:len(row)]
        if len(starts):
            gain[row[starts]] += np.add.reduceat(change, starts, axis=0)
    d = np.repeat(diagonal[None, :], len(now), axis=0)
    d[line, now] -= out[line, now] + into[line, now] + self_n
    gain += _f(d + out + into + self_n[:, None]) + _f(d) - _f(d + out) - _f(d + into)
    t = np.repeat(total[None, :], len(now), axis=0)
    t[line, now] -= weight
    gain -= 2 * (_f(t + weight[:, None]) - _f(t))
    gain[:, -1] = -np.inf
    return gain


def exchange(counts: np.ndarray, p: BrownParams, of: np.ndarray | None = None, fixed: int = 0) -> np.ndarray:
    """Class of every unit. Units start dealt out by frequency, or from ``of``; then each is taken out of its class and
    put where the likelihood of the class bigrams gains most, sweep by sweep until none moves. The end has the last
    class alone; the ``fixed`` units before it stay where they are."""
    size, k = len(counts), p.classes
    weight = counts.sum(axis=1)
    order = np.argsort(-weight[:size - 1 - fixed], kind="stable")
    if of is None:
        of = np.full(size, k)
        of[order] = np.arange(size - 1) % k
    of = of.copy()
    member = np.zeros((size, k + 1))
    member[np.arange(size), of] = 1
    pairs = member.T @ counts @ member
    total = pairs.sum(axis=1)
    for _ in range(p.sweeps):
        moved = 0
        for u in order:
            if not weight[u]:
                continue
            own, self_n = of[u], counts[u, u]
            out = np.bincount(of, counts[u], k + 1)
            into = np.bincount(of, counts[:, u], k + 1)
            out[own] -= self_n
            into[own] -= self_n
            pairs[own] -= out
            pairs[:, own] -= into
            pairs[own, own] -= self_n
            total[own] -= weight[u]
            gain = _gain(pairs, total, out, into, self_n, weight[u])
            best = int(np.argmax(gain))
            if gain[best] <= gain[own] + 1e-9:
                best = own
            moved += best != own
            of[u] = best
            pairs[best] += out
            pairs[:, best] += into
            pairs[best, best] += self_n
            total[best] += weight[u]
        if not moved:
            break
    return of


@dataclass
class BrownModel:
    params: BrownParams
    words: list[bytes]  # the frequent words, most frequent first
    counts: list[int]
    unit_class: np.ndarray
    step: np.ndarray  # log10 of the class transitions
    spread: np.ndarray  # log10 of what an emission's count + 1 is divided by, per class; the end's is 0
    tokens: int
    distinct: int
    ends: int
    keys: np.ndarray  # hashes of the other words that have a class of their own, ascending, and these classes
    own: np.ndarray

    def others(self, words: list[bytes]) -> np.ndarray:
        """Classes of words that are not among the most frequent: their own, or that of their tail."""
        out = self.unit_class[[tail(w, self.params) for w in words]]
        at, hit = find(self.keys, words)
        out[hit] = self.own[at[hit]]
        return out


def find(keys: np.ndarray, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words' hashes (those of xxhash64 in Spark) in ``keys``, and whether they are there."""
    import xxhash

    h = np.fromiter((xxhash.xxh64_intdigest(w, seed=42) for w in words), np.uint64, len(words))
    if not len(keys):
        return np.zeros(len(h), int), np.zeros(len(h), bool)
    at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
    return at, keys[at] == h


def _tables(cells: np.ndarray, of: np.ndarray, kinds: np.ndarray, p: BrownParams) -> tuple[np.ndarray, np.ndarray]:
    """Transitions and emissions' divisors from the units' bigrams, their classes and how many words each stands for."""
    k = p.classes
    member = np.zeros((len(cells), k + 1))
    member[np.arange(len(cells)), of] = 1
    pairs = member.T @ cells @ member
    tokens_of, kinds_of = cells.sum(axis=0) @ member, kinds @ member
    share = (tokens_of + 1) / (tokens_of.sum() + k + 1)
    step = np.log10((pairs + p.smoothing * share) / (pairs.sum(axis=1, keepdims=True) + p.smoothing))
    spread = np.log10(tokens_of + kinds_of + 1)
    spread[k] = 0.0
    return step, spread


def _by_tail(p: BrownParams):
    return F.pmod(F.crc32(F.substring("word", -p.tail_bytes, p.tail_bytes)), F.lit(p.tails)).cast("int")


def fit(docs: DataFrame, p: BrownParams = BrownParams()) -> tuple[BrownModel, DataFrame]:
    """Model of ``docs`` (text) and the counts of all its words. All statistics cover every word of every text; the
    driver holds ``known`` words and the cells between units, both bounded by the parameters."""
    slim = plain(docs, "text")
    counts = stored(word_counts(slim), "brown-words")
    ends, (distinct, total) = slim.count(), counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    top = counts.orderBy(F.desc("n"), "word").limit(p.known).toArrow()
    words, numbers = top["word"].to_pylist(), top["n"].to_pylist()
    order = sorted(range(len(words)), key=lambda i: (-numbers[i], words[i]))
    words, numbers = [words[i] for i in order], [numbers[i] for i in order]
    cells = bigrams(slim, words[:p.words], p)
    of = exchange(cells, p)
    # distinct words of each unit: one each for the frequent ones, the others are counted by tail
    kinds = np.zeros(len(cells))
    for w in words[:p.words]:
        kinds[tail(w, p)] -= 1
    kinds[:min(len(words), p.words)] += 1
    for r in counts.groupBy(_by_tail(p).alias("t")).agg(F.count(F.lit(1)).alias("n")).collect():
        kinds[p.words + r["t"]] += r["n"]
    step, spread = _tables(cells, of, kinds, p)
    none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return BrownModel(p, words, numbers, of, step, spread, int(total) + ends, int(distinct) + (ends > 0), ends, *none), counts


ENTRIES = "part int, w binary, code binary, n binary"
# the entries that the bigrams are added up from, and those that only repeat one of another word
BLOCKS = "part int, w binary, code binary, n binary, w_again binary, code_again binary, n_again binary"


def contexts(docs: DataFrame, words: list[bytes], keys: np.ndarray, parts: int, p: BrownParams) -> DataFrame:
    """Blocks of neighbour counts (``BLOCKS``), arrays of equal length; all entries of a word are in one block. A block's
    words are equal modulo ``parts``, and in the last bit of a seventh, which is also the last bit of ``part``.

    Words are numbered: the frequent ones, the tails, the end, then those of ``keys``. An entry of one of ``keys`` has
    twice the number of a neighbour, and one more if that comes after it. Neighbours without a word of ``keys`` are
    entries of the first.
    """
    shared = docs.sparkSession.sparkContext.broadcast((words, keys))
    base = p.words + p.tails + 1

    def run(batches):
        words, keys = shared.value
        frequent, dense = pa.array(words, pa.binary()), np.zeros(base * base, np.int64)
        held, waiting = [np.array([base - 1])], 0

        def blocks(w, code, n):
            part = w % parts * 2 + (w // 7 & 1)
            order = np.argsort(part, kind="stable")
            w, code, n, part = w[order], code[order], n[order], part[order]
            cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
            for k in range(0, len(cuts) - 1, 32):
                at = list(zip(cuts[k:k + 32], cuts[k + 1:k + 33]))
                yield {"part": part[[s for s, _ in at]], "w": [w[s:e].astype(np.int32).tobytes() for s, e in at],
                       "code": [code[s:e].astype(np.uint32).tobytes() for s, e in at], "n": [n[s:e].tobytes() for s, e in at]}

        def add():
            x = np.concatenate(held)
            a, b = x[:-1], x[1:]
            both = (a < base) & (b < base)
            dense[:] += np.bincount(a[both] * base + b[both], minlength=base * base)
            right, left = a >= base, b >= base
            found = np.concatenate([a[right] << 32 | b[right] << 1 | 1, b[left] << 32 | a[left] << 1])
            if len(found):
                found, n = np.unique(found, return_counts=True)
                yield from blocks(found >> 32, found & 0xFFFFFFFF, n.astype(np.int64))

        def entries():
            nonlocal held, waiting
            for b in _some(batches):
                distinct, code, n = numbered(b.column("text"))
                number = places(distinct, frequent)
                rest = np.flatnonzero(number < 0)
                others = distinct.take(pa.array(rest))
                at, hit = find(keys, others.to_pylist())
                number[rest] = np.where(hit, at + base, tails(others, p))
                line = lined(number[code], n, base - 1)
                held.append(line)
                waiting += len(line)
                if waiting > 500_000:
                    yield from add()
                    held, waiting = [line[-1:]], 0
            yield from add()
            at = np.flatnonzero(dense)
            if len(at):
                yield from blocks(at // base, (at % base) << 1 | 1, dense[at])

        for found in entries():
            yield pa.RecordBatch.from_arrays([
                pa.array(found[x], kind) for x, kind in (("part", pa.int32()), ("w", pa.binary()), ("code", pa.binary()), ("n", pa.binary()))],
                names=["part", "w", "code", "n"])

    def packed(batches):
        now, held = None, []

        def flush():
            w, code, n = (np.concatenate([np.frombuffer(h[i], t) for h in held]) for i, t in enumerate((np.int32, np.uint32, np.int64)))
            key = w.astype(np.int64) << 32 | code
            order = np.argsort(key, kind="stable")
            key, n = key[order], n[order]
            cuts = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            key, n = key[cuts], np.add.reduceat(n, cuts)
            w, code = (key >> 32).astype(np.int32), (key & 0xFFFFFFFF).astype(np.uint32)
            again = (code & 1 == 0) & (code >> 1 >= base)  # two words of ``keys`` have an entry each
            out = {"part": [now]}
            for end, use in (("", ~again), ("_again", again)):
                out |= {f"w{end}": [w[use].tobytes()], f"code{end}": [code[use].tobytes()], f"n{end}": [n[use].tobytes()]}
            return out

        for b in batches:
            for part, *block in zip(b["part"], b["w"], b["code"], b["n"]):
                if part != now and held:
                    yield flush()
                    held = []
                now = part
                held.append(block)
        if held:
            yield flush()

    found = plain(docs, "text").mapInArrow(run, ENTRIES).repartition("part").sortWithinPartitions("part")
    return stored(map_bytes(found, packed, BLOCKS, (), PIECES), "brown-contexts")


def _entries(b: dict, end: str = "") -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    return [(np.frombuffer(w, np.int32).astype(np.int64), np.frombuffer(c, np.uint32).astype(np.int64), np.frombuffer(n, np.int64))
            for w, c, n in zip(b[f"w{end}"], b[f"code{end}"], b[f"n{end}"])]


def _totals(blocks: DataFrame, own: np.ndarray, p: BrownParams) -> np.ndarray:
    """Bigrams of the units, the words with a class of their own counted as one unit a class before the end."""
    base, size = p.words + p.tails + 1, p.words + p.tails + p.classes + 1
    shared = blocks.sparkSession.sparkContext.broadcast(own)

    def run(batches):
        unit = np.concatenate([np.arange(base - 1), [size - 1], base - 1 + shared.value.astype(np.int64)])
        sums = np.zeros(size * size, np.int64)
        for b in batches:
            for w, code, n in _entries(b):
                right, own, other = (code & 1) == 1, unit[w], unit[code >> 1]
                cells = np.where(right, own * size + other, other * size + own)
                sums += np.bincount(cells, n, size * size).astype(np.int64)  # whole numbers below 2^53
        at = np.flatnonzero(sums)
        yield {"a": at // size, "b": at % size, "n": sums[at]}

    cells = map_bytes(plain(blocks, "w", "code", "n"), run, "a int, b int, n bigint", (), 1).groupBy("a", "b").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros((size, size), np.int64)
    out[cells["a"].to_numpy(), cells["b"].to_numpy()] = cells["n"].to_numpy()
    return out


def _moves(blocks: DataFrame, parts: int, of: np.ndarray, own: np.ndarray, pairs: np.ndarray, turn: int, p: BrownParams) -> np.ndarray:
    """Classes of the words with a class of their own after half of them have chosen the best one. Words that choose at
    the same time do not see each other move, so the halves take turns."""
    base, k = p.words + p.tails + 1, p.classes
    shared = blocks.sparkSession.sparkContext.broadcast((of, own, pairs))

    def run(batches):
        of, own, pairs = shared.value
        class_of, total = np.concatenate([of, own]).astype(np.int64), pairs.sum(axis=1)
        for b in batches:
            out = {"w": [], "class": []}
            for block in zip(_entries(b), _entries(b, "_again")):
                w, code, n = (np.concatenate(x) for x in zip(*block))
                use = w >= base
                w, code, n = w[use], code[use], n[use]
                if not len(w):
                    continue
                low = w.min()
                row = (w - low) // parts  # a block's words are equal modulo ``parts``
                count = int(row.max()) + 1
                itself = code >> 1 == w
                alone = np.bincount(row, n * (itself & (code & 1 == 1)), count)
                seen = np.bincount((row * 2 + (code & 1)) * (k + 1) + class_of[code >> 1], n * ~itself, count * 2 * (k + 1))
                words = np.flatnonzero(np.bincount(row, minlength=count))
                seen, alone, words = seen.reshape(count, 2, k + 1)[words], alone[words], words * parts + low
                for at in range(0, len(words), 2000):
                    part = slice(at, at + 2000)
                    now = class_of[words[part]]
                    gain = _gains(pairs, total, seen[part, 1], seen[part, 0], alone[part], now)
                    best, line = np.argmax(gain, axis=1), np.arange(len(now))
                    better = gain[line, best] > gain[line, now] + 1e-9
                    out["w"].append(words[part][better] - base)
                    out["class"].append(best[better])
            out = {key: np.concatenate(x) if x else [] for key, x in out.items()}
            yield out

    half = blocks.where(F.col("part") % 2 == turn % 2)
    moved = map_bytes(half, run, "w int, class int", (), 1).toArrow()
    own = own.copy()
    own[moved["w"].to_numpy()] = moved["class"].to_numpy()
    return own


def refine(docs: DataFrame, model: BrownModel, counts: DataFrame) -> BrownModel:
    """The model after every word of ``docs`` (text) that occurs ``least`` times has chosen its class by its own neighbours.

    One pass stores each such word's neighbour counts. In every round tasks choose the words' classes against the class
    bigrams, and the frequent words and the tails, which hold only rarer words now, are exchanged again. Rounds end when
    the likelihood hardly rises any more. The driver and the tasks hold nine bytes for each word.
    """
    p = model.params
    base, k = p.words + p.tails + 1, p.classes
    frequent = model.words[:p.words]
    found = counts.where(F.col("n") >= p.least).select(F.xxhash64("word").alias("h"), _by_tail(p).alias("t")).toArrow()
    keys, tails = found["h"].to_numpy().view(np.uint64), found["t"].to_numpy()
    at, hit = find(np.sort(keys), frequent)
    rest = ~np.isin(keys, np.sort(keys)[at[hit]]) if len(keys) else np.zeros(0, bool)
    order = np.argsort(keys[rest])
    keys, tails = keys[rest][order], tails[rest][order]
    if not len(keys):
        return model
    of = np.array(model.unit_class)
    own = of[p.words + tails].astype(np.min_scalar_type(k))
    parts = max(32, model.tokens // 500_000)
    blocks = contexts(docs, frequent, keys, parts, p)
    kinds = np.zeros(base)
    kinds[:len(frequent)] = 1
    few = counts.where(F.col("n") < p.least)
    for r in few.groupBy(_by_tail(p).alias("t")).agg(F.count(F.lit(1)).alias("n")).collect():
        kinds[p.words + r["t"]] += r["n"]
    for w, n in zip(frequent, model.counts):
        if n < p.least:
            kinds[tail(w, p)] -= 1

    best, quiet, groups = None, 0, np.arange(k)
    for turn in range(p.rounds + 1):
        cells = _totals(blocks, own, p)
        units = exchange(cells, p, np.concatenate([of[:-1], groups, of[-1:]]), k)
        of = np.r_[units[:base - 1], units[-1]]
        member = np.zeros((len(cells), k + 1))
        member[np.arange(len(cells)), units] = 1
        pairs = member.T @ cells @ member
        likelihood = _f(pairs).sum() - _f(pairs.sum(axis=1)).sum() - _f(pairs.sum(axis=0)).sum()
        if best is not None:
            if likelihood <= best[0]:
                break
            quiet = quiet + 1 if likelihood - best[0] < p.gained * abs(likelihood) else 0
        best = likelihood, of, own, cells, units
        if quiet == 2 or turn == p.rounds:  # both halves are settled
            break
        own = _moves(blocks, parts, of, own, pairs, turn, p)
    _, of, own, cells, units = best
    step, spread = _tables(cells, units, np.concatenate([kinds[:-1], np.bincount(own, minlength=k)[:k], [0]]), p)
    return replace(model, unit_class=of, step=step, spread=spread, keys=keys, own=own)


def score(docs: DataFrame, model: BrownModel, counts: DataFrame) -> DataFrame:
    """(doc_id, flag, n_tokens, n_known, base_score, score, perplexity) of every row of ``docs`` (doc_id, text, flag).

    One pass adds up transitions, classes and the frequent words' counts, and lists a text's other words; those meet
    the counts by a join on the word. None of them holds a 131,072nd of the training words, so no key of it is hot.
    Null text: only the end. Rows that repeat an id: a result each. Empty table or nothing learned: scores by the
    same formulas, with counts of 0.
    """
    p = model.params
    # one more entry each, for the end
    class_of = np.concatenate([model.unit_class[:len(model.words[:p.words])], model.others(model.words[p.words:]), [p.classes]]).astype(np.int64)
    log_count = np.log10(np.array(model.counts + [model.ends], np.float64) + 1)
    light = replace(model, words=[], counts=[])
    shared = docs.sparkSession.sparkContext.broadcast((light, pa.array(model.words, pa.binary()), class_of, log_count))
    schema = "doc_id bigint, flag boolean, n_tokens bigint, known bigint, base double, score double, rare array<binary>"

    def run(batches):
        m, frequent, class_of, log_count = shared.value
        end, whole = log_count[-1], np.log10(m.tokens + m.distinct + 1)
        for b in _some(batches):
            words, code, n = numbered(b.column("text"))
            at = places(words, frequent)
            rare = np.flatnonzero(at < 0)
            classes, logs = class_of[at], log_count[at]
            logs[rare] = 0.0
            if len(rare):
                classes[rare] = m.others(words.take(pa.array(rare)).to_pylist())
            found, line = lined(logs[code], n, end), lined(classes[code], n, p.classes)
            row, first = np.repeat(np.arange(len(n)), n), np.cumsum(n + 1) - (n + 1)
            before = np.r_[p.classes, line[:-1]]
            counted = np.add.reduceat(found, first)
            # the end is certain in its class, so its count is not part of the score
            score = counted - end + np.add.reduceat(m.step[before, line] - m.spread[line], first)
            missing = at[code] < 0
            lost = np.bincount(row[missing], minlength=len(n))
            listed = pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(lost)], pa.int32()), words.take(pa.array(code[missing])))
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id").cast(pa.int64()), b.column("flag"), pa.array(n + 1), pa.array(n - lost + (m.ends > 0)),
                pa.array(counted - (n + 1) * whole), pa.array(score), listed],
                names=["doc_id", "flag", "n_tokens", "known", "base", "score", "rare"])

    local = stored(plain(docs, "doc_id", "flag", "text").mapInArrow(run, schema).withColumn(
        "row", F.monotonically_increasing_id()), "brown-local")
    rare = local.select("row", F.explode("rare").alias("word"))
    more = rare.join(counts, "word").groupBy("row").agg(
        F.count(F.lit(1)).alias("found"), F.sum(F.log10(F.col("n") + 1.0)).alias("logs"))
    joined = local.drop("rare").join(more, "row", "left")
    logs = F.coalesce("logs", F.lit(0.0))
    total = F.col("score") + logs
    return joined.select(
        "doc_id", "flag", "n_tokens", (F.col("known") + F.coalesce("found", F.lit(0))).alias("n_known"),
        (F.col("base") + logs).alias("base_score"), total.alias("score"),
        F.pow(F.lit(10.0), -total / F.col("n_tokens")).alias("perplexity"))
