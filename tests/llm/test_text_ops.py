"""Exact dedup, line dedup, mixing, language identification, scoring and toxicity against plain versions."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from broadsheet.llm import brown, langid
from broadsheet.llm.common import map_bytes
from broadsheet.llm.exact import exact_duplicates
from broadsheet.llm.lines import Cuckoo, LineIndex, dedup_lines
from broadsheet.llm.mixing import mix, mixed_documents, water_fill
from broadsheet.llm.toxicity import ChainParams, toxicity

BLANKS = " \t\n\x0b\f\r"


# exact dedup

def exact_plain(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub(f"[{BLANKS}]+", "", text or "")].append((doc_id, len(text or "")))
    out = []
    for doc_id, text in rows:
        norm = re.sub(f"[{BLANKS}]+", "", text or "")
        best = max(groups[norm], key=lambda r: (r[1], r[0] is not None, -(r[0] or 0)))
        out.append((doc_id, best[0], len(groups[norm]), (doc_id, len(text or "")) == best, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=repr)


ROWS = [
    (1, "a b c"), (2, "abc"), (3, "a  b c"), (4, None), (5, ""), (6, " \n\t"), (7, "x" * 50_000), (8, "x " * 50_000),
    (9, "É a"), (10, "é a"), (None, "abc"), (2, "abc"), (11, "a bc"), (12, "\x1cabc"),
]


@pytest.mark.parametrize("digest_bytes", [16, 1, 0])
def test_exact_duplicates(docs, digest_bytes):
    got = exact_duplicates(docs(*ROWS), digest_bytes)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == exact_plain(ROWS)


def test_exact_empty(docs):
    assert exact_duplicates(docs()).count() == 0


# line dedup

def lines_plain(rows, min_docs=5, min_points=40):
    strip = lambda s: s.strip(BLANKS).translate({i: i + 32 for i in range(65, 91)})
    held = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(strip(line)) >= min_points:
                held[strip(line)].add(doc_id)
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        gone = [len(held.get(strip(x), ())) >= min_docs and doc_id != max(i for i in held[strip(x)] if i is not None) for x in lines]
        out.append((doc_id, "\n".join(x for x, g in zip(lines, gone) if not g), len(lines), sum(gone)))
    return sorted(out, key=repr)


LONG = "This very long line stands in many of the documents é"


def line_rows():
    rows = [(i, f"own {i}\n {LONG}\t\n{'Y' * 39}\nend" + ("\n" + LONG.upper().replace("É", "é") if i % 2 else "")) for i in range(8)]
    return rows + [(100, None), (101, ""), (102, "\n\n"), (103, f"{LONG}\n{LONG}"), (None, LONG), (None, "w" * 60), (3, LONG + "?")]


def as_rows(df):
    return sorted(((r["doc_id"], r["kept_text"], r["n_lines"], r["n_dropped"]) for r in df.collect()), key=repr)


def test_line_dedup(docs):
    assert as_rows(dedup_lines(docs(*line_rows()), shards=4)) == lines_plain(line_rows())


def test_line_dedup_empty(docs):
    assert dedup_lines(docs(), shards=2).count() == 0


def test_deleting_documents_undoes_their_insertion(spark, docs):
    first, more = line_rows()[:6], [(i, f"{LONG}\n" + "z" * 45) for i in range(50, 56)]
    index = LineIndex.empty(spark, shards=3).insert(docs(*first))
    state = lambda x: sorted((bytes(r["key"]), r["n_docs"], r["keep"]) for r in x.counts.collect())
    before = state(index)
    both = index.insert(docs(*more))
    assert as_rows(both.clean(docs(*first, *more))) == lines_plain(first + more)
    back = both.delete(docs(*more))
    assert state(back) == before
    assert as_rows(back.clean(docs(*first))) == lines_plain(first)
    fewer = back.delete(docs(first[5], first[4], first[3]))
    assert as_rows(fewer.clean(docs(*first[:3]))) == lines_plain(first[:3])


def test_cuckoo_filter_keeps_and_forgets():
    keys = [hashlib.md5(str(i).encode()).digest() for i in range(3000)]
    filt = Cuckoo.for_keys(len(keys))
    assert all(filt.add(k) for k in keys)
    assert all(k in filt for k in keys)
    others = [hashlib.md5(f"x{i}".encode()).digest() for i in range(20_000)]
    assert sum(k in filt for k in others) < 40
    assert all(filt.remove(k) for k in keys)
    assert not filt.table.any()


# mixing

def targets_plain(sizes, weights=(5, 2, 1), epochs=3):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, fixed = sum(sizes.values()), {s: 0.0 for s in names if not sizes[s]}
    while len(fixed) < len(names):
        free = [s for s in names if s not in fixed]
        level = (left - sum(fixed.values())) / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level >= epochs * sizes[s]]
        if not over:
            return fixed | {s: weight[s] * level for s in free}
        fixed |= {s: epochs * sizes[s] for s in over}
    return fixed


def test_water_filling(spark):
    rng = random.Random(4)
    for _ in range(3):
        sizes = {f"s{i}": rng.choice([0, 1, 5, 40, 900, 7000]) for i in range(9)} | {None: 30}
        table = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
        got = {r["source"]: r["target"] for r in water_fill(table).collect()}
        assert got == pytest.approx(targets_plain(sizes))


def test_mix(docs):
    rng = random.Random(5)
    rows = [(i, " ".join("w" * rng.randint(1, 40)), "en", rng.choice(["a", "b", "c", None, "ä", "a"])) for i in range(300)]
    rows += [(1000, None, "en", "a"), (1001, " \n ", "en", "b"), (1002, "one\x0btwo\x1cthree", None, "zero"), (None, "u v", "en", None), (5, rows[5][1], "en", rows[5][3])]
    table = mix(docs(*rows))
    got = table.collect()
    size = lambda t: len([w for w in re.split(f"[{BLANKS}]+", t or "") if w])
    sizes = Counter()
    for _, text, _, source in rows:
        sizes[source] += size(text)
    want = targets_plain(sizes)
    assert sorted((r["size"] for r in got)) == sorted(size(t) for _, t, _, _ in rows)
    for source in sizes:
        mine = [r for r in got if r["source"] == source]
        assert all(r["target"] == pytest.approx(want[source]) and r["source_size"] == sizes[source] for r in mine)
        assert sum(r["taken"] for r in mine) == round(want[source])
        assert all(0 <= r["taken"] <= 3 * r["size"] for r in mine)
    assert sorted(map(tuple, got), key=repr) == sorted(map(tuple, table.collect()), key=repr)


def test_mixed_documents_hold_the_words_taken(docs):
    rows = [(i, " ".join(f"w{i}" for _ in range(i % 17)), "en", "ab"[i % 2] if i % 10 else None) for i in range(200)]
    table = docs(*rows)
    out = mixed_documents(table)
    assert out.columns == table.columns
    taken = {r["doc_id"]: r["taken"] for r in mix(table).collect() if r["taken"]}
    words = Counter()
    for r in out.collect():
        words[r["doc_id"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert words == taken


def test_mix_empty(docs):
    assert mix(docs()).count() == 0


# language identification

def phrases_plain(learned: bytes, text: bytes) -> int:
    n = i = 0
    while i < len(text):
        k = 1
        while i + k <= len(text) and text[i:i + k] in learned:
            k += 1
        i += max(1, k - 1)
        n += 1
    return n


def test_phrases_equal_longest_matches():
    rng = random.Random(1)
    learned = {x: bytes(rng.choice(abc) for _ in range(600)) for x, abc in (("a", b"abc "), ("b", b"bcde "), ("c", b"a"))}
    model = langid.LanguageModel.build(learned)
    texts = [bytes(rng.choice(b"abcde xz\xc3") for _ in range(n)) for n in (0, 1, 2, 50, 400, 5000, 9000)]
    # phrases longer than a block, over several edges, and parses that never meet
    learned["d"] = bytes(rng.choice(b"ab") for _ in range(10_000))
    learned["e"] = b"a" * 7
    model = langid.LanguageModel.build(learned)
    texts += [b"xx" + learned["d"][50:] + b"b" * 30, b"b" + b"a" * 9001, b"ab" * 4096, learned["a"] * 20]
    want = [[phrases_plain(learned[x], t) for x in model.langs] for t in texts]
    assert model.phrases(texts).tolist() == want


def language_rows():
    rng = random.Random(2)
    parts = {"de": ["sch", "ung", "ein", "ich", "ä"], "en": ["the", "ing", "tion", "wh"], "fr": ["eau", "que", "é", "oi"]}
    word = lambda p: "".join(rng.choice(p) for _ in range(rng.randint(1, 4)))
    return [(i, " ".join(word(parts[x]) for _ in range(rng.randint(5, 60))), x) for i, x in enumerate(rng.choices(list(parts), k=240))]


def test_language_of_held_out_texts(docs):
    rows = language_rows()
    model = langid.learn(docs(*rows[:160]))
    rest = rows[160:] + [(900, None), (901, "12 ;-) 345"), (902, ""), (903, rows[0][1] * 40, None), (None, rows[1][1])]
    got = langid.identify(docs(*rest), model).collect()
    assert len(got) == len(rest)
    by = {r["doc_id"]: r for r in got}
    assert np.mean([by[i]["lang_pred"] == x for i, _, x in rows[160:]]) > 0.95
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (900, 901, 902))
    assert by[903]["lang_pred"] == rows[0][2] and by[None]["lang_pred"] == rows[1][2]
    assert all(0 <= r["score"] <= 1 for r in got)
    kept = langid.keep_identified(docs(*rest, (904, "漢字かな" * 30, "en")), model)
    assert {r["doc_id"] for r in kept.collect()} == {i for i in by} - {900, 901, 902}


def test_spans_of_different_texts_are_learned(docs):
    head = "intro " * 300
    rows = [(1, head + "uniqueword " * 30, "x"), *[(i, "123 456", "x") for i in range(2, 50)], *[(i, "same text", "x") for i in range(50, 99)]]
    model = langid.learn(docs(*rows), sample_docs=2, sample_points=5000, check_docs=0)
    # one long text and one of the equal ones, whole; letterless ones take no place
    assert model.phrases([langid.normalise((head + "uniqueword " * 30).encode()), b"same text"]).tolist() == [[1], [1]]
    seen = langid.learn(docs(*[(i, "abc " * 200 + f"middle{i} " + "abc " * 200, "x") for i in range(30)]), 30, 200)
    assert seen.phrases([b"middle"])[0, 0] == 1  # beyond the first 200 code points of every text


def test_unlearned_language_of_the_same_script_is_rejected(docs):
    rng = random.Random(5)
    sounds = {x: ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(3)) for _ in range(25)] for x in "xyz"}
    text = lambda x: " ".join("".join(rng.choices(sounds[x], k=2)) for _ in range(rng.randint(30, 90)))
    learned = [(i, text("xy"[i % 2]), "xy"[i % 2]) for i in range(240)]
    rest = [(1000 + i, text("xyz"[i % 3]), None) for i in range(90)] + [(2000, sounds["x"][0]), (2001, None), (None, text("x"), None)]
    model = langid.learn(docs(*learned))
    assert np.isfinite(model.limits).all()
    kept = {r["doc_id"] for r in langid.keep_identified(docs(*rest), model).collect()}
    assert kept == {1000 + i for i in range(90) if i % 3 < 2} | {2000, None}


def test_limits_come_from_all_labelled_texts(docs):
    rng = random.Random(8)
    sounds = {x: ["".join(rng.choice("abcdefghilmnoprstu") for _ in range(3)) for _ in range(25)] for x in "xy"}
    rows = [(i, " ".join("".join(rng.choices(sounds["xy"[i % 2]], k=2)) for _ in range(rng.randint(30, 400))), "xy"[i % 2]) for i in range(700)]
    rows += [(9000, rows[5][1], "y"), (9001, "12 34", "x"), (9002, None, "x")]
    df = docs(*rows)
    model = langid.learn(df)
    hashes = {r["text"]: r["h"] for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    for i, lang in enumerate("xy"):
        texts = sorted({t for _, t, x in rows[:700] if x == lang}, key=hashes.get)[40:]
        rates = [(model.phrases([langid.normalise(t.encode())])[0, i] - 1) / len(t) for t in texts]
        assert abs(model.limits[i] - 2 * np.median(rates)) <= 1.01 / langid.RATES


def test_language_of_nothing_learned(docs):
    model = langid.learn(docs((1, "abc", None)))
    assert [tuple(r)[2:4] for r in langid.identify(docs((1, "abc")), model).collect()] == [("und", 0.0)]
    assert langid.identify(docs(), model).count() == 0


# scores by classes

SMALL = brown.BrownParams(classes=4, words=6, tails=3, tail_bytes=2, sweeps=4, known=8)


def brown_plain(train, rows, p, of):
    """Scores from plain dictionaries, given the classes of the units."""
    words = [brown.tokens((t or "").encode()) for t in train]
    counts = Counter(w for ws in words for w in ws)
    top = sorted(counts, key=lambda w: (-counts[w], w))[:p.words]
    cls = lambda w: of[top.index(w)] if w in top else of[p.words + zlib.crc32(w[-p.tail_bytes:]) % p.tails]
    end, total, kinds = len(words), sum(counts.values()) + len(words), len(counts) + (len(words) > 0)
    pairs, tokens, distinct = Counter(), Counter(), Counter(cls(w) for w in counts)
    for ws in words:
        line = [p.classes, *[cls(w) for w in ws], p.classes]
        pairs.update(zip(line, line[1:]))
        tokens.update(line[1:])
    n, out = sum(tokens.values()), []
    for text in rows:
        ws = brown.tokens((text or "").encode())
        base = sum(math.log10((counts[w] + 1) / (total + kinds + 1)) for w in ws) + math.log10((end + 1) / (total + kinds + 1))
        score, before = 0.0, p.classes
        for k, w in [(cls(w), w) for w in ws] + [(p.classes, None)]:
            share = (tokens[k] + 1) / (n + p.classes + 1)
            score += math.log10((pairs[before, k] + p.smoothing * share) / (sum(v for (a, _), v in pairs.items() if a == before) + p.smoothing))
            if w is not None:
                score += math.log10((counts[w] + 1) / (tokens[k] + distinct[k] + 1))
            before = k
        out.append((len(ws) + 1, sum(counts[w] > 0 for w in ws) + (end > 0), base, score))
    return out


def test_gains_of_many_words_equal_those_of_one():
    rng, k = np.random.default_rng(1), 9
    out, into = (rng.poisson(0.7, (200, k + 1)).astype(float) for _ in range(2))
    self_n, now = rng.integers(0, 3, 200).astype(float), rng.integers(0, k, 200)
    pairs = rng.poisson(30, (k + 1, k + 1)).astype(float) * (rng.random((k + 1, k + 1)) < 0.7)
    for i, c in enumerate(now):
        pairs[c] += out[i]
        pairs[:, c] += into[i]
        pairs[c, c] += self_n[i]
    total = pairs.sum(axis=1)
    got = brown._gains(pairs, total, out, into, self_n, now)
    for i, c in enumerate(now):
        m, t, weight = pairs.copy(), total.copy(), out[i].sum() + self_n[i]
        m[c] -= out[i]
        m[:, c] -= into[i]
        m[c, c] -= self_n[i]
        t[c] -= weight
        want = brown._gain(m, t, out[i], into[i], self_n[i], weight)
        assert np.allclose(got[i][:-1], want[:-1], atol=1e-7) and got[i][-1] == -np.inf


def test_brown_reads_words_in_small_portions():
    """Words are cut as ``tokens`` does, and however large Arrow's batches are, few texts are worked on at a time."""
    rng = random.Random(4)
    texts = [None, "", " ", "\x0b\x0c", "É Ab\x1cC\x85 ab", *("".join(rng.choices(" \t\n\r\x0b\x0cabÉ\x1cZ", k=rng.randint(0, 40))) for _ in range(3000))]
    want = [brown.tokens((t or "").encode()) for t in texts]
    words, code, n = brown.numbered(pa.array(texts))
    assert [words[int(i)].as_py() for i in code] == [w for t in want for w in t] and list(n) == [len(t) for t in want]
    assert list(brown.tails(words, SMALL)) == [brown.tail(w, SMALL) for w in words.to_pylist()]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    sizes = [b.num_rows for b in brown._some([batch, batch])]
    assert max(sizes) <= brown.TEXTS and sum(sizes) == 2 * len(texts)


def test_map_bytes_in_portions(docs):
    table = docs(*[(i, str(i)) for i in range(25)]).coalesce(1)
    seen = map_bytes(table.select("text"), lambda bs: ({"n": [len(b["text"])]} for b in bs), "n bigint", rows=4).collect()
    assert sum(r["n"] for r in seen) == 25 and max(r["n"] for r in seen) <= 4


def test_brown_scores(docs):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("The the cat dog\tsat ran on a mat é xyzzy plugh fee fie".split(" ")) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "unseen words\x0bhere"), (None, "the cat"), (3, "the the")]
    table = docs(*rows).withColumn("flag", F.coalesce(F.col("doc_id") >= 40, F.lit(False)))
    model, counts = brown.fit(table.where("not flag"), SMALL)
    train = [t for i, t in rows if i is None or i < 40]
    want = brown_plain(train, [t for _, t in rows], SMALL, list(model.unit_class))
    got = brown.score(table, model, counts).collect()
    assert sorted(map(repr, [(r["doc_id"], r["n_tokens"], r["n_known"]) for r in got])) == sorted(
        map(repr, [(i, w[0], w[1]) for (i, _), w in zip(rows, want)]))
    assert sorted(r["base_score"] for r in got) == pytest.approx(sorted(w[2] for w in want))
    assert sorted(r["score"] for r in got) == pytest.approx(sorted(w[3] for w in want))


def test_exchange_finds_alternating_classes():
    rng = random.Random(6)
    p = brown.BrownParams(classes=2, words=8, tails=2)
    size = p.words + p.tails + 1
    counts = np.zeros((size, size), np.int64)
    at = size - 1
    for _ in range(4000):  # words 0-3 are followed by words 4-7 and the other way round
        now = rng.randrange(4) + (0 if at >= 4 else 4)
        counts[at, now] += 1
        at = now
    of = brown.exchange(counts, p)
    assert len(set(of[:4])) == 1 and len(set(of[4:8])) == 1 and of[0] != of[4]


def test_brown_words_beyond_the_frequent_choose_their_own_class(docs):
    rng = random.Random(9)
    p = brown.BrownParams(classes=3, words=4, tails=2, tail_bytes=1, known=20, rounds=20)
    # words of one kind are followed by words of the other; all end alike, so their tails tell nothing
    kinds = [[f"a{i}z" for i in range(30)], [f"b{i}z" for i in range(30)]]
    rows = [(i, " ".join(rng.choice(kinds[j % 2]) for j in range(30))) for i in range(200)] + [(900, None), (901, "rarez a1z")]
    table = docs(*rows).withColumn("flag", F.lit(False))
    start, counts = brown.fit(table, p)
    model = brown.refine(table, start, counts)
    cls = {w: int(model.unit_class[i]) for i, w in enumerate(model.words[:p.words])}
    more = [w.encode() for k in kinds for w in k if w.encode() not in cls]
    cls |= dict(zip(more, model.others(more).tolist()))
    by_kind = [{cls[w.encode()] for w in k} for k in kinds]
    assert not by_kind[0] & by_kind[1] and len(model.keys) == 56
    # the scores are those of these classes, counted anew
    seen = Counter(w for _, t in rows for w in brown.tokens((t or "").encode()))
    cls[b"rarez"] = int(model.unit_class[brown.tail(b"rarez", p)])
    pairs, into, distinct = Counter(), Counter(), Counter(cls[w] for w in seen)
    for _, t in rows:
        line = [3, *[cls[w] for w in brown.tokens((t or "").encode())], 3]
        pairs.update(zip(line, line[1:]))
        into.update(line[1:])
    got, total = {r["doc_id"]: r for r in brown.score(table, model, counts).collect()}, sum(into.values())
    for i, t in rows:
        words, want, before = brown.tokens((t or "").encode()), 0.0, 3
        for c, w in [(cls[w], w) for w in words] + [(3, None)]:
            share = (into[c] + 1) / (total + 4)
            want += math.log10((pairs[before, c] + p.smoothing * share) / (sum(v for (a, _), v in pairs.items() if a == before) + p.smoothing))
            want += math.log10((seen[w] + 1) / (into[c] + distinct[c] + 1)) if w else 0.0
            before = c
        assert got[i]["score"] == pytest.approx(want)


def test_brown_nothing_learned(docs):
    table = docs((1, "a b"), (2, None)).withColumn("flag", F.lit(True))
    model, counts = brown.fit(table.where("not flag"), SMALL)
    got = {r["doc_id"]: r for r in brown.score(table, model, counts).collect()}
    assert got[1]["base_score"] == 0 and got[1]["n_known"] == 0 and got[2]["n_tokens"] == 1
    assert brown.score(table.where("false"), model, counts).count() == 0


# toxicity

def test_toxic_documents_are_found(spark, docs):
    rng = random.Random(7)
    plain = ["word%d" % i for i in range(60)]
    rows, labels = [], []
    for i in range(400):
        toxic = i % 8 == 0
        words = [rng.choice(plain) for _ in range(rng.randint(5, 80))]
        if toxic:
            words.insert(rng.randrange(len(words)), rng.choice(["Idiot!", "vileness", "vilest", "vilely"]))
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(toxic)))
    rows += [(1000, None), (1001, ""), (None, "idiot")]
    labels += [(5, None, 0), (None, 1, 1), (2000, 1, 1)]
    marks = spark.createDataFrame([x for x in labels if x[0] is None or x[0] < 300 or x[0] > 1000], "doc_id bigint, quality int, toxic int")
    got = {r["doc_id"]: r for r in toxicity(docs(*rows), marks, ChainParams(min_docs=2)).collect()}
    assert len(got) == len(rows)
    wrong = [(i, round(got[i]["toxic_score"], 3), rows[i][1][-200:]) for i in range(300, 400) if got[i]["toxic"] != (i % 8 == 0)]
    assert not wrong
    assert not got[1000]["toxic"] and not got[1001]["toxic"] and got[None]["toxic"]


def test_toxicity_without_labels(spark, docs):
    marks = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert [r["toxic"] for r in toxicity(docs((1, "a")), marks).collect()] == [False]
    assert toxicity(docs(), marks).count() == 0
