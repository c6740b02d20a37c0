"""Byte-pair pieces with seeded merge-dropout: varied segmentations of one text that decode to it exactly."""

from __future__ import annotations

import heapq
import math
import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import map_bytes, plain
from broadsheet.llm.records import portions

MARK = "▁"  # stands for a space inside pieces
NONE = np.int64(1 << 30)
M64 = (1 << 64) - 1
# Odd multipliers of the span hash.
SPAN = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xBF58476D1CE4E5B9)


class MergeModel:
    """Pieces and scores of a model file whose pieces merge pairwise, with byte pieces for characters it lacks."""

    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.width = 2 if n <= 65_536 else 4
        usable = [i for i in range(n) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        self.ids = {sp.id_to_piece(i): i for i in usable}
        self.bytes = {int(sp.id_to_piece(i)[3:5], 16): i for i in range(n) if sp.is_byte(i)}
        if len(self.bytes) < 256:
            raise ValueError("the model has no piece for every byte, so it cannot decode everything")
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in self.ids):
            raise ValueError("the model has pieces that span words")
        self.by_line = not any("\n" in p for p in self.ids)
        # characters that occur only inside pieces are symbols too, but never a result
        symbols = dict(self.ids)
        for piece in self.ids:
            for c in piece:
                symbols.setdefault(c, n + len(symbols))
        self.size = n
        self.table = np.full(0x110000, -1, np.int32)
        for s, i in symbols.items():
            if len(s) == 1:
                self.table[ord(s)] = i
        # in a text a space is what the mark stands for, and the mark itself is a character without a piece
        self.table[0x20], self.table[ord(MARK)] = self.table[ord(MARK)], -1
        order = {s: r for r, s in enumerate(sorted({sp.get_score(i) for i in usable}, reverse=True))}
        pairs = []
        for piece, i in self.ids.items():
            rank = order[sp.get_score(i)]
            for k in range(1, len(piece)):
                a, b = symbols.get(piece[:k]), symbols.get(piece[k:])
                if a is not None and b is not None:
                    pairs.append((a << 32 | b, rank, i))
        pairs.sort()
        self.pairs, self.ranks, self.merged = (np.array(x, np.int64) for x in zip(*pairs))
        # pairs by hash, so that most are found at once; those whose slot another took are searched
        self.shift = np.uint64(64 - (16 * len(pairs)).bit_length())
        self.slots = np.full(1 << (64 - int(self.shift)), -1, np.int32)
        at, slot = np.arange(len(pairs)), self._slot(self.pairs)
        self.slots[slot] = at
        self.lost = at[self.slots[slot] != at]
        self.by_pair = {p: (r, m) for p, r, m in pairs}
        self.plain = [b""] * n
        for piece, i in self.ids.items():
            self.plain[i] = piece.replace(MARK, " ").encode()
        for value, i in self.bytes.items():
            self.plain[i] = bytes([value])

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return pairs.view(np.uint64) * np.uint64(SPAN[0]) >> self.shift

    def find(self, pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places of pairs of symbols in ``pairs`` of the model, and whether they are there."""
        at = self.slots[self._slot(pairs)]
        hit = self.pairs[at] == pairs
        if len(self.lost):
            again = np.flatnonzero(~hit & (at >= 0))
            lost = self.lost[np.minimum(np.searchsorted(self.pairs[self.lost], pairs[again]), len(self.lost) - 1)]
            found = self.pairs[lost] == pairs[again]
            at[again[found]], hit[again[found]] = lost[found], True
        return at, hit

    def decode(self, ids) -> bytes:
        """The text's bytes; the space that encoding puts in front goes."""
        return b"".join([self.plain[i] for i in ids])[1:]


def _mix(x):
    """Finish a 64-bit hash (numpy or int); the same numbers either way."""
    if isinstance(x, np.ndarray):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(SPAN[3])
        return x ^ (x >> np.uint64(29))
    x = ((x ^ x >> 30) * SPAN[3]) & M64
    return x ^ x >> 29


def span_hash(start, mid, stop):
    """Hash of the merge of [start, mid) and [mid, stop), from arrays or ints."""
    if isinstance(start, np.ndarray):
        a, b, c = (v.astype(np.uint64) * np.uint64(m) for v, m in zip((start, mid, stop), SPAN))
        return _mix(a + b + c)
    a, b, c = (v * m & M64 for v, m in zip((start, mid, stop), SPAN))
    return _mix(a + b + c & M64)


def skipped(key, span, dropout: float):
    """Whether the merge of a ``span_hash`` is left out: its hash under a key against ``dropout``."""
    limit = math.ceil(dropout * (1 << 53))
    if isinstance(key, np.ndarray):
        return _mix(key ^ span) >> np.uint64(11) < np.uint64(limit)
    return _mix(key ^ span) >> 11 < limit


def agenda(model: MergeModel, symbols: list[int], key: int, dropout: float) -> list[tuple[int, int, int]]:
    """(symbol, start, stop) after all merges of one piece of text, best score first, then leftmost, from a heap."""
    n = len(symbols)
    sym, stop = list(symbols), list(range(1, n + 1))
    left, right = list(range(-1, n - 1)), [*range(1, n), -1]
    heap: list[tuple[int, int, int, int, int]] = []

    def offer(i):
        j = right[i] if i >= 0 else -1
        if j < 0 or sym[i] < 0 or sym[j] < 0:
            return
        found = model.by_pair.get(sym[i] << 32 | sym[j])
        if found and not (dropout and skipped(key, span_hash(i, j, stop[j]), dropout)):
            heapq.heappush(heap, (found[0], i, j, stop[j], found[1]))

    for i in range(n):
        offer(i)
    alive = [True] * n
    while heap:
        _, i, j, end, merged = heapq.heappop(heap)
        if not alive[i] or not alive[j] or right[i] != j or stop[j] != end:
            continue
        sym[i], stop[i], alive[j] = merged, end, False
        right[i] = right[j]
        if right[i] >= 0:
            left[right[i]] = i
        offer(left[i])
        offer(i)
    return [(sym[i], i, stop[i]) for i in range(n) if alive[i]]


def merge_many(model: MergeModel, sym: np.ndarray, lengths: np.ndarray, keys: np.ndarray, dropout: float, made_by: list | None = None):
    """The same merges for many pieces of text at once: in each round every piece makes the best merge of its agenda.

    Returns (owner, symbol, start, stop) of all remaining symbols in order. A candidate's hash depends on its span
    only, so taking the best candidate that is not skipped equals popping an agenda and passing over skipped ones.
    ``made_by`` gets (owner, start, mid, stop) of the merges of each round.
    """
    own = np.repeat(np.arange(len(lengths)), lengths)
    start = np.arange(len(sym)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    stop, sym = start + 1, sym.astype(np.int64)
    rank, made = np.full(len(sym), NONE), np.zeros(len(sym), np.int64)

    def look(at):
        """Fill rank and made of the pairs that begin at the places ``at``."""
        at = at[(at >= 0) & (at < len(sym) - 1)]
        rank[at] = NONE
        at = at[(own[at] == own[at + 1]) & (sym[at] >= 0) & (sym[at + 1] >= 0)]
        pair = sym[at] << 32 | sym[at + 1]
        slot, hit = model.find(pair)
        at, slot = at[hit], slot[hit]
        if dropout:
            keep = ~skipped(keys[own[at]], span_hash(start[at], start[at + 1], stop[at + 1]), dropout)
            at, slot = at[keep], slot[keep]
        rank[at], made[at] = model.ranks[slot], model.merged[slot]

    look(np.arange(len(sym)))
    done = []
    while len(sym):
        rank[-1] = NONE
        first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        best = np.minimum.reduceat(rank << 32 | np.arange(len(sym)), first)
        open_ = (best >> 32) < NONE
        size = np.diff(np.r_[first, len(sym)])
        if not open_.all():
            rest = np.repeat(open_, size)
            done.append((own[~rest], sym[~rest], start[~rest], stop[~rest]))
            place = np.cumsum(rest) - 1
            own, sym, start, stop, rank, made = (x[rest] for x in (own, sym, start, stop, rank, made))
            at = place[(best & 0xFFFFFFFF)[open_]]
        else:
            at = best & 0xFFFFFFFF
        if not len(sym):
            break
        if made_by is not None:
            made_by.append((own[at], start[at], start[at + 1], stop[at + 1]))
        sym[at], stop[at] = made[at], stop[at + 1]
        keep = np.ones(len(sym), bool)
        keep[at + 1] = False
        own, sym, start, stop, rank, made = (x[keep] for x in (own, sym, start, stop, rank, made))
        at = at - np.arange(len(at))  # one symbol went in each piece before
        look(np.concatenate([at - 1, at]))
    parts = [np.concatenate(x) for x in zip(*done)] if done else [np.zeros(0, np.int64)] * 4
    order = np.argsort(parts[0], kind="stable")
    return [p[order] for p in parts]


def _runs(first: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Places of runs of ``sizes`` entries that begin at ``first``, one run after the other."""
    return np.repeat(first - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())


class DropoutEncoder:
    """Encodes texts. Every candidate merge has a draw of its own: its hash is keyed by seed, document, repetition of the
    document, word position and span. What words give without dropout is kept with the merges that lead there; where a
    draw skips none of these it is the result, all other occurrences are merged anew from the words' symbols.

    ``limit`` bounds the words kept; ``longest`` is the length from which a word is merged on its own with a heap."""

    WORDS = re.compile(rb"\n[^ \n]*| *[^ \n]+| +")
    LONG_LINES = re.compile(rb" *[^ ]+| +")

    def __init__(self, model: MergeModel, dropout: float, seed: int, limit: int = 400_000, longest: int = 48):
        self.model, self.dropout, self.seed = model, dropout, seed
        self.limit, self.longest = limit, longest
        self._forget()

    def _forget(self) -> None:
        self.place: dict[bytes, int] = {}
        self.whole: list[bytes] = []
        self.symbols, self.first_symbol = np.zeros(0, np.int32), np.zeros(1, np.int64)
        self.spans, self.first_span = np.zeros(0, np.uint64), np.zeros(1, np.int64)  # hashes of each word's merges
        self.long = np.zeros(0, bool)

    def words(self, text: bytes) -> list[bytes]:
        """Parts that no merge crosses: a word with the spaces before it, less one; a new line with what follows it."""
        if not text:
            return []
        if self.model.by_line and not (text[:1] in b" \n" or text[-1:] == b" " or b"  " in text or b" \n" in text):
            return text.replace(b"\n", b" \n").split(b" ")
        found = (self.WORDS if self.model.by_line else self.LONG_LINES).findall(b" " + text)
        return [w[1:] if w[:1] == b" " else w for w in found]

    def _text(self, word: bytes) -> str:
        text = word.decode("utf-8", "replace")
        return text if word[:1] == b"\n" and self.model.by_line else " " + text

    def symbols_of(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The words' symbols one after the other, and how many each has."""
        texts = list(map(self._text, words))
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        return self.model.table[np.frombuffer("".join(texts).encode("utf-32-le"), "<u4")], lengths

    def segment(self, words: list[bytes], keys: np.ndarray, at_once: int = 4000) -> list[bytes]:
        """Packed ids of word occurrences, each with its own key, all merged anew."""
        out = []
        for k in range(0, len(words), at_once):
            part = words[k:k + at_once]
            out += self._merged(part, *self.symbols_of(part), keys[k:k + at_once], self.dropout)
        return out

    def _merged(self, words, symbols, lengths, keys, dropout: float, made_by: list | None = None) -> list[bytes]:
        model, out = self.model, [b""] * len(words)
        short = lengths <= self.longest
        few = symbols if short.all() else symbols[np.repeat(short, lengths)]
        own, sym, start, stop = merge_many(model, few, lengths[short], keys[short], dropout, made_by)
        packed = sym.astype(f"<u{model.width}").tobytes()
        edges = (np.searchsorted(own, np.arange(short.sum() + 1)) * model.width).tolist()
        odd = set(own[(sym < 0) | (sym >= model.size)].tolist())
        for n, i in enumerate(np.flatnonzero(short).tolist()):
            if n not in odd:
                out[i] = packed[edges[n]:edges[n + 1]]
            else:
                part = slice(edges[n] // model.width, edges[n + 1] // model.width)
                out[i] = self._packed(self._text(words[i]), zip(sym[part].tolist(), start[part].tolist(), stop[part].tolist()))
        ends = np.cumsum(lengths)
        for i in np.flatnonzero(~short).tolist():
            part = symbols[ends[i] - lengths[i]:ends[i]].tolist()
            out[i] = self._packed(self._text(words[i]), agenda(model, part, int(keys[i]), dropout))
        return out

    def _packed(self, text: str, spans) -> bytes:
        ids = []
        for s, a, b in spans:
            if 0 <= s < self.model.size:
                ids.append(s)
            else:
                ids += [self.model.bytes[x] for x in text[a:b].encode()]
        return np.array(ids, f"<u{self.model.width}").tobytes()

    def _learn(self, words: list[bytes], at_once: int = 4000) -> None:
        """Keep the words' symbols, what they give without dropout, and the merges that lead there. Long words are
        always merged anew."""
        symbols, letters, spans, merges = [self.symbols], [], [self.spans], []
        for k in range(0, len(words), at_once):
            part, made_by = words[k:k + at_once], []
            found, lengths = self.symbols_of(part)
            short = lengths <= self.longest
            some = [w for w, x in zip(part, short.tolist()) if x]
            results = iter(self._merged(
                some, found[np.repeat(short, lengths)], lengths[short], np.zeros(len(some), np.uint64), 0.0, made_by))
            self.whole += [next(results) if x else b"" for x in short.tolist()]
            owner, *span = [np.concatenate(x) for x in zip(*made_by)] if made_by else [np.zeros(0, np.int64)] * 4
            spans.append(span_hash(*span)[np.argsort(owner, kind="stable")])
            n = np.zeros(len(part), np.int64)
            n[short] = np.bincount(owner, minlength=len(some))
            merges.append(n)
            symbols.append(found)
            letters.append(lengths)
        self.place.update(zip(words, range(len(self.place), len(self.place) + len(words))))
        letters = np.concatenate(letters)
        self.symbols, self.spans = np.concatenate(symbols), np.concatenate(spans)
        self.long = np.concatenate([self.long, letters > self.longest])
        self.first_symbol = np.concatenate([self.first_symbol, self.first_symbol[-1] + np.cumsum(letters)])
        self.first_span = np.concatenate([self.first_span, self.first_span[-1] + np.cumsum(np.concatenate(merges))])

    def draw(self, words: list[bytes], keys: np.ndarray, at_once: int = 4000) -> list[bytes]:
        """Packed ids of word occurrences, each with its own key."""
        if new := list(set(words).difference(self.place)):
            if len(self.place) + len(new) > self.limit:
                self._forget()
                new = list(set(words))
            self._learn(new)
        at = np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))
        out, anew = list(map(self.whole.__getitem__, at.tolist())), [np.zeros(0, np.int64)]
        for k in range(0, len(at), 50_000):
            here = at[k:k + 50_000]
            n = self.first_span[here + 1] - self.first_span[here]
            left_out = skipped(np.repeat(keys[k:k + 50_000], n), self.spans[_runs(self.first_span[here], n)], self.dropout)
            skips = self.long[here].copy()
            skips[np.repeat(np.arange(len(here)), n)[left_out]] = True
            anew.append(np.flatnonzero(skips) + k)
        anew = np.concatenate(anew)
        for k in range(0, len(anew), at_once):
            some = anew[k:k + at_once]
            lengths = self.first_symbol[at[some] + 1] - self.first_symbol[at[some]]
            symbols = self.symbols[_runs(self.first_symbol[at[some]], lengths)]
            which = some.tolist()
            for i, packed in zip(which, self._merged([words[i] for i in which], symbols, lengths, keys[some], self.dropout)):
                out[i] = packed
        return out

    def encode(self, doc_ids: list, turns: list[int], texts: list[bytes]) -> list[bytes]:
        """Packed ids of texts; ``turns`` number the rows that repeat an id and text."""
        import xxhash

        split = [self.words(t) for t in texts]
        sizes = np.array([len(w) for w in split], np.int64)
        ends = np.cumsum(sizes)
        base = np.array([xxhash.xxh3_64_intdigest(f"{d}:{k}".encode(), seed=self.seed) for d, k in zip(doc_ids, turns)], np.uint64)
        position = (np.arange(sizes.sum()) - np.repeat(ends - sizes, sizes)).astype(np.uint64)
        found = self.draw([w for words in split for w in words], _mix(np.repeat(base, sizes) + position * np.uint64(SPAN[0])))
        return [b"".join(found[e - n:e]) for e, n in zip(ends.tolist(), sizes.tolist())]


def _encode(docs: DataFrame, model: str, dropout: float, seed: int, schema: str, row) -> DataFrame:
    rows = plain(docs, "doc_id", "text").withColumn("version", F.xxhash64("text"))
    # only rows that repeat an id and text have to meet, to be numbered
    repeats = not rows.groupBy("doc_id", "version").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    if repeats:
        rows = rows.repartition("doc_id", "version")

    def run(batches):
        encoder, met = None, Counter()
        for b in batches:
            turns = [0] * len(b["text"])
            if repeats:
                for i, key in enumerate(zip(b["doc_id"], b["version"])):
                    turns[i] = met[key]
                    met[key] += 1
            for part in portions(b["text"]):
                if encoder is None:
                    loaded = MergeModel(model)
                    encoder = DropoutEncoder(loaded, dropout, seed)
                yield row(loaded, b["doc_id"][part], b["text"][part], encoder.encode(b["doc_id"][part], turns[part], b["text"][part]))

    return map_bytes(rows, run, schema)


def encode_documents(docs: DataFrame, model: str, dropout: float = 0.1, seed: int = 23) -> DataFrame:
    """(doc_id, ids array<int>, n_pieces) of every row of ``docs`` (doc_id bigint, text).

    Null or empty text: no pieces. Null id: an id like the others. Rows that repeat an id and text: a draw each, as every
    occurrence of a word has. Very long texts are taken whole, very long words from a heap. Empty table: no rows.
    ``dropout`` 0 gives the model's own segmentation, but for the mark character, which is written as bytes so that it
    comes back as itself.
    """
    def row(m, doc_ids, texts, packed):
        import pyarrow as pa

        flat = np.frombuffer(b"".join(packed), f"<u{m.width}").astype(np.int32)
        sizes = np.array([len(p) // m.width for p in packed], np.int64)
        offsets = np.r_[0, np.cumsum(sizes)].astype(np.int32)
        return {"doc_id": doc_ids, "ids": pa.ListArray.from_arrays(offsets, flat), "n_pieces": sizes}

    return _encode(docs, model, dropout, seed, "doc_id bigint, ids array<int>, n_pieces bigint", row)


def encoded_digests(docs: DataFrame, model: str, dropout: float = 0.1, seed: int = 23) -> DataFrame:
    """(doc_id, n_pieces, ids_crc32, lossless) of every row: the pieces of ``encode_documents``, and whether decoding
    them gives the text's bytes again."""
    def row(m, doc_ids, texts, packed):
        arrays = [np.frombuffer(p, f"<u{m.width}") for p in packed]
        return {
            "doc_id": doc_ids, "n_pieces": [len(a) for a in arrays],
            "ids_crc32": [zlib.crc32(a.astype("<u4").tobytes()) for a in arrays],
            "lossless": [m.decode(a.tolist()) == t for a, t in zip(arrays, texts)],
        }

    return _encode(docs, model, dropout, seed, "doc_id bigint, n_pieces bigint, ids_crc32 bigint, lossless boolean", row)


def decode_documents(encoded: DataFrame, model: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids)."""
    def run(batches):
        loaded = None
        for b in batches:
            loaded = loaded or MergeModel(model)
            yield {"doc_id": b["doc_id"], "text": [loaded.decode(ids or []).decode("utf-8", "replace") for ids in b["ids"]]}

    return map_bytes(plain(encoded, "doc_id", "ids"), run, "doc_id bigint, text string", ())
