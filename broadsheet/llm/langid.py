"""Language identification by cross-parsing: the language whose learned text needs the fewest phrases wins."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from broadsheet.llm.common import map_bytes, plain

# ASCII characters that are no letters become blanks; all other bytes stay.
LETTERS = bytes(i if i >= 128 or chr(i).isalpha() else 32 for i in range(256))
BLOCK = 4096
# Steps of a phrase per byte in which the rates of texts are counted.
RATES = 10_000


def normalise(text: bytes) -> bytes:
    """Lower-case letters, words parted by single spaces; empty if the text has no letter."""
    s = text.decode("utf-8", "replace").lower()
    out = b" ".join(s.encode().translate(LETTERS).split())
    if not re.search(rb"[a-z]", out) and not any(c.isalpha() for c in s):
        return b""
    return out


def suffix_automaton(data: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that reads every substring of ``data``; state 0 is the start."""
    edges: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in data:
        now = len(edges)
        edges.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in edges[p]:
            edges[p][c] = now
            p = link[p]
        if p >= 0:
            q = edges[p][c]
            if length[p] + 1 == length[q]:
                link[now] = q
            else:
                copy = len(edges)
                edges.append(dict(edges[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                link[q] = link[now] = copy
                while p >= 0 and edges[p].get(c) == q:
                    edges[p][c] = copy
                    p = link[p]
        last = now
    return edges


@dataclass
class LanguageModel:
    """Automata of all languages in one table. An entry is 2 * (place of the next state's row) + 1 if a phrase ends."""

    langs: list[str]
    symbols: np.ndarray  # of the 256 bytes; 0: in no learned text
    table: np.ndarray
    roots: np.ndarray  # place of each language's start row
    bits: np.ndarray  # log2 of the learned length: what naming a phrase's place costs
    limits: np.ndarray | None = None  # phrases per byte above which a text is of no learned language; None: no limits

    @classmethod
    def build(cls, samples: dict[str, bytes]) -> "LanguageModel":
        langs = sorted(samples)
        used = sorted(set().union(*[set(samples[x]) for x in langs]))
        symbols = np.zeros(256, np.int64)
        symbols[used] = np.arange(1, len(used) + 1)
        width, at, tables, roots = len(used) + 1, 0, [], []
        for lang in langs:
            edges = suffix_automaton(samples[lang])
            n = len(edges) + 1  # and a state after a byte that no text has
            nowhere = at + (n - 1) * width
            first = np.full(width, nowhere, np.int64)
            for c, q in edges[0].items():
                first[symbols[c]] = at + q * width
            rows = np.tile(first * 2 + 1, (n, 1))
            rows[0] = first * 2
            for s, out in enumerate(edges):
                for c, q in out.items():
                    rows[s, symbols[c]] = (at + q * width) * 2
            tables.append(rows)
            roots.append(at)
            at += n * width
        table = np.concatenate([np.zeros(0, np.int64), *[t.ravel() for t in tables]])
        small = table.astype(np.int32) if len(table) < 1 << 30 else table
        bits = np.array([math.log2(len(samples[x]) + 1) for x in langs])
        return cls(langs, symbols, small, np.array(roots, small.dtype), bits)

    def only(self, i: int) -> LanguageModel:
        """The model of one language, with the same table."""
        return LanguageModel(self.langs[i:i + 1], self.symbols, self.table, self.roots[i:i + 1], self.bits[i:i + 1])

    def phrases(self, texts: list[bytes]) -> np.ndarray:
        """Number of longest-match phrases per (text, language).

        Texts are cut into blocks of 4,096 bytes, which are parsed in step from the start state. Where the block before
        ends inside a phrase, a block is parsed again from there, until both parses are in one state: from then on they
        agree. A block where they never meet hands its new end on. So phrases run over the blocks' edges.
        """
        flat = np.frombuffer(b"".join(texts), np.uint8)
        cuts = [range(0, len(t), BLOCK) for t in texts]
        owner = np.repeat(np.arange(len(texts)), [len(c) for c in cuts])
        inside = np.array([a for c in cuts for a in c], np.int64)
        lengths = np.array([len(t) for t in texts], np.int64)
        starts = (np.cumsum(lengths) - lengths)[owner] + inside
        sizes = np.minimum(BLOCK, lengths[owner] - inside)
        ends = np.zeros((len(owner), len(self.langs)), np.int64)
        last = np.zeros(ends.shape, self.table.dtype)
        order = np.argsort(-sizes, kind="stable")
        for a in range(0, len(order), 2048):
            chosen = order[a:a + 2048]
            ends[chosen], last[chosen] = self._in_step(flat, starts[chosen], sizes[chosen])

        begin = np.tile(self.roots, (len(owner), 1))
        follows = np.r_[owner[1:] == owner[:-1], False]  # whether the next block is of the same text
        block, lang = (x.ravel() for x in np.meshgrid(np.flatnonzero(follows) + 1, np.arange(len(self.langs)), indexing="ij"))
        while len(block):
            new = last[block - 1, lang]
            gain, end = self._again(flat, starts[block], sizes[block], begin[block, lang], new, last[block, lang])
            ends[block, lang] += gain
            begin[block, lang] = new
            moved = (end != last[block, lang]) & follows[block]
            last[block, lang] = end
            block, lang = block[moved] + 1, lang[moved]
        total = np.zeros((len(texts), len(self.langs)), np.int64)
        np.add.at(total, owner, ends)
        return total + (lengths > 0)[:, None]  # the last phrase ends with the text

    def _in_step(self, flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Phrases that end in each block, and the state after it; blocks from long to short."""
        chars = np.zeros((len(starts), sizes[0]), np.uint8)
        for row, a, n in zip(chars, starts, sizes):
            row[:n] = flat[a:a + n]
        steps = self.symbols.astype(self.table.dtype)[chars.T]
        state = np.repeat(self.roots[:, None], len(starts), axis=1)
        ends = np.zeros((len(self.langs), len(starts)), np.int64)
        active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # blocks longer than each step
        for t in range(sizes[0]):
            k = active[t]
            found = self.table[state[:, :k] + steps[t, :k]]
            ends[:, :k] += found & 1
            state[:, :k] = found >> 1
        return ends.T, state.T

    def _again(self, flat, starts, sizes, old, new, last) -> tuple[np.ndarray, np.ndarray]:
        """How many more phrases end in each block if it is entered in state ``new``, not ``old``, and the state after it
        (``last``: the one after ``old``)."""
        gain, end, symbols = np.zeros(len(starts), np.int64), last.copy(), self.symbols.astype(self.table.dtype)
        open_ = np.flatnonzero(old != new)
        old, new, t = old[open_], new[open_], 0
        while len(open_):
            step = symbols[flat[starts[open_] + t]]
            was, now = self.table[old + step], self.table[new + step]
            gain[open_] += (now & 1) - (was & 1)
            old, new, t = was >> 1, now >> 1, t + 1
            over = sizes[open_] == t
            end[open_[over]] = new[over]
            left = ~over & (old != new)
            open_, old, new = open_[left], old[left], new[left]
        return gain, end

    def predict(self, texts: list[bytes]) -> tuple[list[str], list[float], list[float]]:
        """Language, score and phrases per byte of the winner for each normalised text."""
        rates = self.phrases(texts) * self.bits[None, :] if self.langs else np.zeros((len(texts), 0))
        langs, scores, costs = [], [], []
        for text, rate in zip(texts, rates):
            if not text or not len(rate):
                langs.append("und")
                scores.append(0.0)
                costs.append(0.0)
                continue
            best = int(np.argmin(rate))  # of equal ones, the first by name
            others = np.delete(rate, best)
            langs.append(self.langs[best])
            scores.append(float(1 - rate[best] / others.min()) if len(others) else 1.0)
            costs.append(float(rate[best] / self.bits[best] / len(text)))
        return langs, scores, costs


def learn(docs: DataFrame, sample_docs: int = 40, sample_points: int = 1000, check_docs: int | None = None) -> LanguageModel:
    """Fit on ``docs`` (doc_id, text, lang).

    Per language the ``sample_docs`` different spans that come first in the order of their texts' hash are learned, a
    bounded sample, as every task holds what was learned. A text's span is the whole text, or ``sample_points`` code points
    from a place that the hash chooses anywhere in it. All other texts, whole, say how many phrases per byte the language's
    own texts need (``check_docs``: only the next so many of each language; 0: no limits). Rows without language, text or a
    letter teach nothing, and equal texts count once.
    """
    rows = plain(docs, "text", "lang").where("lang is not null and text is not null")
    h, points = F.xxhash64("text"), F.lit(sample_points)
    place = F.pmod(h, F.greatest(F.length("text") - points, F.lit(0)) + 1).cast("int")
    spans = rows.select("lang", h.alias("h"), F.substring("text", place + 1, points).alias("t")).where(F.col("t").rlike("\\p{L}"))
    order = Window.partitionBy("lang").orderBy("h")
    chosen = spans.select("lang", "h").distinct().withColumn("k", F.row_number().over(order)).where(
        F.col("k") <= sample_docs + (check_docs or 0))
    # at most sample_docs + check_docs rows a language
    found = spans.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "h", "k").agg(F.min("t").alias("t"))
    samples: dict[str, list[bytes]] = {}
    learned, checked = set(), set()
    for r in found.orderBy("lang", "k").collect():
        text = normalise(r["t"].encode())
        if r["k"] <= sample_docs:
            learned.add((r["lang"], r["h"]))
            if text:
                samples.setdefault(r["lang"], []).append(text)
        else:
            checked.add((r["lang"], r["h"]))
    model = LanguageModel.build({k: b" ".join(v) for k, v in samples.items()})
    if check_docs != 0:
        model.limits = own_limits(rows, model, learned, checked if check_docs else None)
    return model


def own_limits(
    rows: DataFrame, model: LanguageModel, learned: set[tuple[str, int]], among: set[tuple[str, int]] | None = None,
    fewest: int = 20, times: float = 2.0,
) -> np.ndarray:
    """Phrases per byte that a text of each language may need: ``times`` the median over all different texts of that language
    in ``rows`` (text, lang) but the ``learned`` ones, named by language and hash (``among``: only these). A median, as some labelled texts are
    mixed with other languages or with codes. No limit for a language with less than ``fewest`` of them.

    Every text is parsed whole, by its own language. Rates are counted in steps of 1 / ``RATES``, so the driver gets at most that
    many counts a language, however many texts there are.
    """
    shared = rows.sparkSession.sparkContext.broadcast((model, learned, among))  # bounded by the sample

    def run(batches):
        model, learned, among = shared.value
        one = {lang: model.only(i) for i, lang in enumerate(model.langs)}
        for b in batches:
            asked: dict[str, list[tuple[int, bytes]]] = {}
            for lang, h, text in zip(b["lang"], b["h"], b["text"]):
                if lang in one and (lang, h) not in learned and (among is None or (lang, h) in among):
                    asked.setdefault(lang, []).append((h, normalise(text)))
            out = {"lang": [], "h": [], "step": []}
            for lang, texts in asked.items():
                texts = [(h, t) for h, t in texts if t]
                for (h, t), n in zip(texts, one[lang].phrases([t for _, t in texts])[:, 0] if texts else ()):
                    out["lang"].append(lang), out["h"].append(h), out["step"].append(round((int(n) - 1) / len(t) * RATES))
            yield out

    steps = map_bytes(rows.select("lang", F.xxhash64("text").alias("h"), "text"), run, "lang string, h bigint, step int")
    counts = steps.distinct().groupBy("lang", "step").agg(F.count(F.lit(1)).alias("n")).orderBy("lang", "step").collect()
    limits = np.full(len(model.langs), np.inf)
    for i, lang in enumerate(model.langs):
        step, n = np.array([(r["step"], r["n"]) for r in counts if r["lang"] == lang], np.int64).reshape(-1, 2).T
        upto = np.cumsum(n)
        if len(n) and upto[-1] >= fewest:
            middle = [step[np.searchsorted(upto, k, side="right")] for k in ((upto[-1] - 1) // 2, upto[-1] // 2)]
            limits[i] = times * np.mean(middle) / RATES
    return limits


def identify(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, row_hash, lang_pred, score, phrase_rate) of every row of ``docs`` (doc_id bigint, text).

    All of each text is parsed. ``score`` is the share of phrases that the winner saves against the second, 1 if only
    one language was learned; equal languages: the first by name. Null text or no letter (or nothing learned): ``und``
    and 0. Rows that repeat an id: a result each. Empty table: no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the sample

    def run(batches):
        for b in batches:
            langs, scores, costs = shared.value.predict([normalise(t) for t in b["text"]])
            yield {"doc_id": b["doc_id"], "row_hash": b["row_hash"], "lang_pred": langs, "score": scores, "phrase_rate": costs}

    rows = plain(docs, "doc_id", "text").select("doc_id", F.xxhash64("text").alias("row_hash"), "text")
    return map_bytes(rows, run, "doc_id bigint, row_hash bigint, lang_pred string, score double, phrase_rate double")


def keep_identified(
    docs: DataFrame, model: LanguageModel, langs: list[str] | None = None, max_rate: float = 0.5, spare: int = 8,
) -> DataFrame:
    """Rows of ``docs`` whose language is among ``langs`` (default: all learned ones); columns are those of ``docs``.

    Rejected are null texts, texts without a letter, and texts that no learned language reads: those that need more than
    ``max_rate`` phrases per byte, or more than the limit that the winning language's own labelled texts set, with
    ``spare`` phrases more for short texts. Whole texts are parsed, however long. Ids have no influence: rows that repeat
    one, or lack one, are each judged by their text, and equal texts alike. Columns of any name are kept. Empty table: no rows.
    """
    import pyarrow as pa

    shared, wanted = docs.sparkSession.sparkContext.broadcast(model), set(langs or model.langs)
    limits = dict(zip(model.langs, model.limits if model.limits is not None else [np.inf] * len(model.langs)))

    def run(batches):
        for b in batches:
            texts = [normalise(t or b"") for t in b.column("text").cast(pa.binary()).to_pylist()]
            found, _, rates = shared.value.predict(texts)
            read = [
                lang in wanted and rate <= max_rate and rate * len(t) <= limits[lang] * len(t) + spare
                for lang, rate, t in zip(found, rates, texts)]
            yield b.filter(pa.array(read, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
