"""Word and character n-grams, vocabularies, and TF-IDF weights."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from functools import cached_property
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer, CountVectorizerModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from broadsheet.functions.canonical import clean_text
from broadsheet.functions.text import BLANKS, join_text, strip_ad_prefix, text_column
from broadsheet.params import Ngrams, TextParams

# Fixed value: a token is a run of two or more letters, digits or underscores.
TOKEN = r"[\p{L}\p{N}_]{2,}"
# Rows whose tokens a counting task holds as Python objects, and terms after which it sends on what it has counted.
COUNT_ROWS, COUNT_TERMS = 64, 500_000
# Counted words and pairs that a task sends at a time.
SENT = 50_000
# Terms that are sent to the JVM in one row.
PORTION = 4096


def document_text(p: TextParams) -> Column:
    """The text whose terms are counted: ad prefixes off, title repeated, article, cleaned."""
    joined = join_text(strip_ad_prefix("title"), strip_ad_prefix("article"), p.title_repeat, p.missing_article_token)
    return clean_text(joined, lowercase=p.lowercase, accents=p.accents)


def title_text(p: TextParams) -> Column:
    return clean_text(text_column("title"), lowercase=p.lowercase, accents=p.accents)


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _squeezed(c: Column | str) -> Column:
    return F.trim(F.regexp_replace(_column(c), rf"[{BLANKS}]+", " "))


def word_tokens(c: Column | str, stop_words: tuple[str, ...] | None = None) -> Column:
    tokens = F.regexp_extract_all(_column(c), F.lit(TOKEN), 0)
    if not stop_words:
        return tokens
    if isinstance(stop_words, str):
        raise ValueError("stop words are a list of words; lists have no names here")
    listed = F.array(*[F.lit(w) for w in stop_words])
    return F.filter(tokens, lambda t: ~F.array_contains(listed, t))


def tokens(c: Column | str, p: Ngrams, stop_words: tuple[str, ...] | None = None) -> Column:
    """What terms are made of: words, blank-separated words for ``char_wb``, the whole text for ``char``."""
    if p.analyzer == "word":
        return word_tokens(c, stop_words)
    return F.split(_squeezed(c), " ") if p.analyzer == "char_wb" else F.array(_squeezed(c))


def ngrams(c: Column | str, p: Ngrams, stop_words: tuple[str, ...] | None = None) -> Column:
    """All terms of a text with repetitions, as built-in expressions."""
    if p.analyzer == "word":
        return word_ngrams(c, p.low, p.high, stop_words)
    return char_wb_ngrams(c, p.low, p.high) if p.analyzer == "char_wb" else char_ngrams(c, p.low, p.high)


def char_ngrams(c: Column | str, n_min: int, n_max: int) -> Column:
    """Character n-grams across words, runs of blanks taken as one blank."""
    s = _squeezed(c)
    return F.concat(*[F.regexp_extract_all(s, F.lit(f"(?s)(?=(.{{{n}}}))."), 1) for n in range(n_min, n_max + 1)])


def word_ngrams(c: Column | str, n_min: int = 1, n_max: int = 2, stop_words: tuple[str, ...] | None = None) -> Column:
    def grams(t: Column) -> Column:
        parts = []
        for n in range(n_min, n_max + 1):
            if n == 1:
                parts.append(t)
            else:
                last = F.size(t) - (n - 1)
                starts = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
                parts.append(F.transform(
                    starts, lambda i: F.concat_ws(" ", *[F.get(t, i + (j - 1)) for j in range(n)])))  # noqa: B023
        return F.concat(*parts)

    # bound as a lambda variable, so that the text is tokenised once
    return F.get(F.transform(F.array(word_tokens(c, stop_words)), grams), F.lit(0))


def char_wb_ngrams(c: Column | str, n_min: int = 3, n_max: int = 5) -> Column:
    """Character n-grams inside words padded with one blank on each side.

    Words are set two blanks apart, so an n-gram inside one padded word has at most one blank at either end; a
    lookahead finds the overlapping matches, and every match steps on by one whole character. A padded word shorter than ``n_min`` counts once as a whole.
    """
    s = _squeezed(c)
    padded = F.concat(F.lit(" "), F.replace(s, F.lit(" "), F.lit("  ")), F.lit(" "))
    parts = []
    for n in range(n_min, n_max + 1):
        shapes = [rf" [^ ]{{{n - 1}}}", rf"[^ ]{{{n}}}", rf"[^ ]{{{n - 1}}} "]
        if n > 2:
            shapes.append(rf" [^ ]{{{n - 2}}} ")
        if n == n_min and n > 3:
            shapes.append(rf" [^ ]{{1,{n - 3}}} ")
        parts.append(F.regexp_extract_all(padded, F.lit(f"(?s)(?=({'|'.join(shapes)}))."), 1))
    return F.concat(*parts)


def _word_grams(low: int, high: int) -> Callable[[list[str]], list[str]]:
    return lambda t: [" ".join(t[i:i + n]) for n in range(low, high + 1) for i in range(len(t) - n + 1)]


def _text_grams(p: Ngrams) -> Callable[[list[str]], list[str]]:
    """n-grams of words, or of the characters of a whole text, which is the only token then."""
    if p.analyzer == "word":
        return _word_grams(p.low, p.high)
    return lambda t: [t[0][i:i + n] for n in range(p.low, p.high + 1) for i in range(len(t[0]) - n + 1)]


def _inside_grams(low: int, high: int) -> Callable[[str], tuple[str, ...]]:
    """n-grams of one padded word; a padded word shorter than ``low`` is one as a whole."""
    def grams(word: str) -> tuple[str, ...]:
        w = f" {word} "
        if not word:
            return ()
        return tuple(w[i:i + n] for n in range(low, high + 1) for i in range(len(w) - n + 1)) or (w,)

    return grams


def _counter(p: Ngrams) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts the terms of (fold, tokens), a row per fold and term each time ``COUNT_TERMS`` terms are held. Whatever the size
    of the batches that come in, a few rows at a time become Python objects."""
    low, high, analyzer = p.low, p.high, p.analyzer
    if analyzer == "char_wb":
        return _inside_counter(low, high)
    if analyzer == "word" and high <= 2:
        return _pair_counter(low, high)

    def run(batches):
        tf: dict[int, Counter] = defaultdict(Counter)
        df: dict[int, Counter] = defaultdict(Counter)
        of_text = _text_grams(p)

        def flush():
            for fold, counts in tf.items():
                terms = list(counts)
                yield pa.RecordBatch.from_arrays([
                    pa.array([fold] * len(terms), pa.int32()), pa.array(terms, pa.string()),
                    pa.array([counts[t] for t in terms], pa.int64()), pa.array([df[fold][t] for t in terms], pa.int64())],
                    names=["fold", "term", "tf", "df"])
            tf.clear(), df.clear()

        for b in (big.slice(a, COUNT_ROWS) for big in batches for a in range(0, big.num_rows, COUNT_ROWS)):
            for fold, t in zip(b.column("fold").to_pylist(), b.column("tokens").to_pylist()):
                found = of_text(t)
                tf[fold].update(found)
                df[fold].update(set(found))
            if sum(map(len, df.values())) > COUNT_TERMS:
                yield from flush()
        yield from flush()

    return run


def _pair_counter(low: int, high: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``_counter`` for words and pairs of words. Words are numbered, a pair is two numbers in one, and numpy counts them."""
    def run(batches):
        number: dict[str, int] = {}  # of each word, from 1
        sums: dict[int, list[np.ndarray]] = {}  # per fold: terms, occurrences and documents, not added up yet

        def add_up() -> int:
            for fold, parts in sums.items():
                key, tf, df = np.concatenate(parts, axis=1)
                terms, at = np.unique(key, return_inverse=True)
                out = np.zeros((3, len(terms)), np.int64)
                out[0] = terms
                for k, counts in ((1, tf), (2, df)):
                    out[k] = np.bincount(at, weights=counts, minlength=len(terms))
                sums[fold] = [out]
            return sum(parts[0].shape[1] for parts in sums.values())

        def flush():
            add_up()
            words = pa.array(list(number), pa.string())
            for fold, ((key, tf, df),) in sums.items():
                for part in (slice(k, k + SENT) for k in range(0, len(key), SENT)):
                    first, last = key[part] >> 32, key[part] & 0xFFFFFFFF
                    one = first == 0  # in front of all pairs, as keys ascend
                    pairs = pc.binary_join_element_wise(words.take(pa.array(first[~one] - 1)), words.take(pa.array(last[~one] - 1)), " ")
                    terms = pa.concat_arrays([words.take(pa.array(last[one] - 1)), pairs])
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(terms), fold, np.int32)), terms, pa.array(tf[part]), pa.array(df[part])],
                        names=["fold", "term", "tf", "df"])
            number.clear(), sums.clear()

        waiting = 0
        for b in (big.slice(a, COUNT_ROWS) for big in batches for a in range(0, big.num_rows, COUNT_ROWS)):
            lists = b.column("tokens")
            flat = lists.flatten().dictionary_encode()
            ids = np.array([number.setdefault(w, len(number) + 1) for w in flat.dictionary.to_pylist()], np.int64)
            word = ids[flat.indices.to_numpy()]
            row = np.repeat(np.arange(b.num_rows), np.diff(lists.offsets.to_numpy()))
            next_to = row[1:] == row[:-1]
            key = np.concatenate(([word] if low == 1 else []) + ([(word[:-1] << 32 | word[1:])[next_to]] if high == 2 else []))
            row = np.concatenate(([row] if low == 1 else []) + ([row[1:][next_to]] if high == 2 else []))
            of = b.column("fold").to_numpy(zero_copy_only=False)[row]
            for fold in np.unique(of):
                terms, at, tf = np.unique(key[of == fold], return_inverse=True, return_counts=True)
                seen = np.unique(row[of == fold] * len(terms) + at) % len(terms)
                sums.setdefault(int(fold), []).append(np.array([terms, tf, np.bincount(seen, minlength=len(terms))], np.int64))
                waiting += len(terms)
            if waiting > 2 * COUNT_TERMS or len(number) > COUNT_TERMS:
                waiting = add_up()
                if waiting > COUNT_TERMS or len(number) > COUNT_TERMS:
                    yield from flush()
                    waiting = 0
        yield from flush()

    return run


def _inside_counter(low: int, high: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``_counter`` for n-grams inside words. Each distinct word is cut once; from then on its n-grams are numbers, and
    numpy counts them and the documents that have them."""
    of_word = _inside_grams(low, high)

    def run(batches):
        number: dict[str, int] = {}  # of each n-gram
        cut: dict[str, np.ndarray] = {}  # numbers of a word's n-grams
        sums: dict[int, np.ndarray] = {}  # per fold: occurrences and documents by number

        def flush():
            names = pa.array(list(number), pa.string())
            for fold, (tf, df) in sums.items():
                held = np.flatnonzero(tf[:len(names)])
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(len(held), fold, np.int32)), names.take(pa.array(held)), pa.array(tf[held]), pa.array(df[held])],
                    names=["fold", "term", "tf", "df"])
            number.clear(), cut.clear(), sums.clear()

        for b in (big.slice(a, COUNT_ROWS) for big in batches for a in range(0, big.num_rows, COUNT_ROWS)):
            lists = b.column("tokens")
            flat = lists.flatten().dictionary_encode()
            fold = b.column("fold").to_numpy(zero_copy_only=False)
            lengths = np.diff(lists.offsets.to_numpy())
            words, code = flat.dictionary.to_pylist(), flat.indices.to_numpy()
            parts = []
            for w in words:
                ids = cut.get(w)
                if ids is None:
                    ids = cut[w] = np.array([number.setdefault(g, len(number)) for g in of_word(w)], np.int64)
                parts.append(ids)
            size = np.array([len(x) for x in parts], np.int64)
            start, grams = np.cumsum(size) - size, np.concatenate([np.zeros(0, np.int64), *parts])
            pairs, often = np.unique(np.repeat(np.arange(len(fold)), lengths) * max(1, len(words)) + code, return_counts=True)
            row, word = pairs // max(1, len(words)), pairs % max(1, len(words))
            n = size[word]
            at = np.repeat(start[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            row, ids, often = np.repeat(row, n), grams[at], np.repeat(often, n)
            seen = np.unique(row * (len(number) + 1) + ids)
            seen_row, seen_id = seen // (len(number) + 1), seen % (len(number) + 1)
            for k in np.unique(fold):
                held = sums.get(int(k), np.zeros((2, 0), np.int64))
                if held.shape[1] < len(number):
                    held = sums[int(k)] = np.pad(held, ((0, 0), (0, 2 * len(number) - held.shape[1])))
                mine, mine_seen = fold[row] == k, fold[seen_row] == k
                width = held.shape[1]
                held[0] += np.bincount(ids[mine], weights=often[mine], minlength=width).astype(np.int64)
                held[1] += np.bincount(seen_id[mine_seen], minlength=width)
            if len(number) * max(1, len(sums)) > COUNT_TERMS:
                yield from flush()
        yield from flush()

    return run


def term_stats(docs: DataFrame, p: Ngrams, models: list[int], column: str = "text", stop_words: tuple[str, ...] | None = None) -> DataFrame:
    """Per term and model: occurrences ``tf_<m>`` and documents ``df_<m>`` outside fold m (a fold of -1 is never out).

    One pass for all models. Texts are cut into tokens by built-in expressions; a task counts them, and sends a row per
    fold and term. Characters inside words are looked up once per distinct word, not once per occurrence.
    """
    rows = docs.select(F.col("fold").cast("int"), tokens(column, p, stop_words).alias("tokens")).where("tokens is not null")
    counted = rows.mapInArrow(_counter(p), "fold int, term string, tf bigint, df bigint")
    sums = []
    for m in models:
        for c in ("tf", "df"):
            value = F.col(c) if models == [-1] else F.when(F.col("fold") != m, F.col(c)).otherwise(0)
            sums.append(F.sum(value).alias(f"{c}_{m}".replace("-1", "all")))
    return counted.groupBy("term").agg(*sums)


def vocabulary(stats: DataFrame, model: int, n_docs: int, min_df: int, max_df: float, max_features: int) -> DataFrame:
    """The ``max_features`` most frequent terms with min_df <= documents <= max_df * n_docs; ties go by term.

    A table of frequencies, one row for each, shows from which on all terms fit; only the terms of the next frequency
    are sorted. No task merges candidates for the whole list.
    """
    tag = "all" if model == -1 else str(model)
    tf, df = F.col(f"tf_{tag}"), F.col(f"df_{tag}")
    kept = stats.where((df >= min_df) & (df <= max_df * n_docs)).select("term", tf.alias("tf"), df.alias("df"))
    upto = Window.orderBy(F.desc("tf")).rowsBetween(Window.unboundedPreceding, 0)
    sizes = kept.groupBy("tf").agg(F.count(F.lit(1)).alias("n")).select("tf", "n", F.sum("n").over(upto).alias("upto"))
    first = sizes.where(F.col("upto") > max_features).agg(F.max(F.struct("tf", (F.lit(max_features) - F.col("upto") + F.col("n")).alias("room")))).first()[0]
    if first is None:
        return kept
    ties = kept.where(F.col("tf") == first["tf"]).orderBy("term").limit(first["room"])
    return kept.where(F.col("tf") > first["tf"]).unionByName(ties)


def idf(n_docs: int, df: np.ndarray) -> np.ndarray:
    return np.log((1.0 + n_docs) / (1.0 + df)) + 1.0


def lookup(terms: list[str], p: Ngrams) -> Callable[[pa.Array], tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Counts the listed terms in a column of tokens: (row, place in the list, occurrences), ascending by row and place.

    As when a vocabulary is counted, words are numbered and n-grams of a word looked up once for each distinct word; a few
    rows at a time become Python objects.
    """
    if p.analyzer == "char_wb":
        places = _inside_places(terms, p.low, p.high)
    elif p.analyzer == "word" and p.high <= 2:
        places = _pair_places(terms, p.low, p.high)
    else:
        places = _any_places(terms, p)

    def count(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        found = []
        for a in range(0, len(column), COUNT_ROWS):
            row, at, often = places(column.slice(a, COUNT_ROWS))
            keys, of = np.unique(row * len(terms) + at, return_inverse=True)
            found.append((a + keys // max(1, len(terms)), keys % max(1, len(terms)), np.bincount(of, weights=often, minlength=len(keys))))
        none = np.zeros(0, np.int64)
        return tuple(np.concatenate(x) for x in zip((none, none, np.zeros(0)), *found))

    return count


def _pair_places(terms: list[str], low: int, high: int):
    number: dict[str, int] = {}  # of each word, from 1
    keys = np.zeros(len(terms), np.int64)
    for i, t in enumerate(terms):
        first, _, second = t.partition(" ")
        one = number.setdefault(first, len(number) + 1)
        keys[i] = one << 32 | number.setdefault(second, len(number) + 1) if second else one
    order = np.argsort(keys)
    ascending = np.append(keys[order], np.iinfo(np.int64).max)

    def places(lists):
        flat = lists.flatten().dictionary_encode()
        ids = np.array([number.get(w, 0) for w in flat.dictionary.to_pylist()], np.int64)
        word = ids[flat.indices.to_numpy()]
        row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        parts = [(word, row)] if low == 1 else []
        if high == 2:
            pair = (row[1:] == row[:-1]) & (word[1:] > 0) & (word[:-1] > 0)
            parts.append(((word[:-1] << 32 | word[1:])[pair], row[1:][pair]))
        key, row = (np.concatenate(x) for x in zip(*parts))
        at = np.searchsorted(ascending, key)
        held = ascending[at] == key
        return row[held], order[at[held]], np.ones(held.sum())

    return places


def _inside_places(terms: list[str], low: int, high: int):
    place = {t: i for i, t in enumerate(terms)}
    of_word = _inside_grams(low, high)
    cut: dict[str, np.ndarray] = {}  # places of a word's n-grams

    def places(lists):
        if len(cut) > COUNT_TERMS // 10:
            cut.clear()
        flat = lists.flatten().dictionary_encode()
        words, parts = flat.dictionary.to_pylist(), []
        for w in words:
            at = cut.get(w)
            if at is None:
                at = cut[w] = np.array([place[g] for g in of_word(w) if g in place], np.int64)
            parts.append(at)
        n_words = max(1, len(words))
        size = np.array([len(x) for x in parts], np.int64)
        start, grams = np.cumsum(size) - size, np.concatenate([np.zeros(0, np.int64), *parts])
        row = np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
        pairs, often = np.unique(row * n_words + flat.indices.to_numpy(), return_counts=True)
        row, word = pairs // n_words, pairs % n_words
        n = size[word]
        at = np.repeat(start[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.repeat(row, n), grams[at], np.repeat(often, n)

    return places


def _any_places(terms: list[str], p: Ngrams):
    place = {t: i for i, t in enumerate(terms)}
    of_text = _text_grams(p)

    def places(lists):
        rows = enumerate(lists.to_pylist())
        found = [(row, place[g]) for row, t in rows if t and t[0] is not None for g in of_text(t) if g in place]
        row, at = np.array(found, np.int64).reshape(-1, 2).T
        return row, at, np.ones(len(row))

    return places


class TermBlock:
    """Fitted vocabulary of one text: the terms of all models in alphabetical order, and per model the idf of its own
    terms (0 where the model does not have the term). Its size is bounded by max_features times the models."""

    def __init__(self, name: str, terms: list[str], weights: np.ndarray, spark=None):
        self.name, self.terms, self.weights, self.spark = name, terms, weights, spark

    @classmethod
    def fit(
        cls, name: str, docs: DataFrame, column: str, p: Ngrams, models: list[int], n_docs: dict[int, int], max_df: float,
        stop_words: tuple[str, ...] | None = None,
    ) -> "TermBlock":
        min_df, max_features = p.min_df, p.limit
        stats = term_stats(docs, p, models, column, stop_words)
        often = F.greatest(*[F.col(c) for c in stats.columns if c.startswith("df_")], F.lit(0))
        stats = stats.where(often >= min_df).persist()
        stats.count()
        # as columns: a row object for each term would take many times its size on the driver
        top = lambda m: vocabulary(stats, m, n_docs[m], min_df, max_df, max_features).select("term", "df").toArrow()
        with ThreadPool(len(models)) as pool:  # independent small jobs
            found = {m: dict(zip(*(c.to_pylist() for c in t.columns))) for m, t in zip(models, pool.map(top, models))}
        stats.unpersist()
        union = sorted(set().union(*found.values()))
        weights = np.zeros((len(models), len(union)))
        for i, m in enumerate(models):
            df = np.array([found[m].get(t, 0) for t in union], dtype=np.float64)
            weights[i] = np.where(df > 0, idf(n_docs[m], df), 0.0)
        return cls.of_terms(docs.sparkSession, name, union, weights)

    @classmethod
    def of_terms(cls, spark, name: str, terms: list[str], weights: np.ndarray) -> "TermBlock":
        return cls(name, terms, weights, spark)

    @cached_property
    def counter(self) -> CountVectorizerModel | None:
        """A lookup of the terms in the JVM, made when it is first needed."""
        if not self.terms:
            return None
        # fitted on the terms themselves, sent in portions: ``from_vocabulary`` makes a call to the JVM for each of them
        portions = [(self.terms[a:a + PORTION],) for a in range(0, len(self.terms), PORTION)]
        table = self.spark.createDataFrame(portions, f"{self.name}_terms array<string>")
        fitter = CountVectorizer(inputCol=f"{self.name}_terms", outputCol=f"{self.name}_tf", vocabSize=len(self.terms), minDF=1.0)
        return fitter.fit(table)

    @cached_property
    def order(self) -> np.ndarray:
        """The place in ``terms`` of each index that ``counter`` gives."""
        place = {t: i for i, t in enumerate(self.terms)}
        return np.array([place[t] for t in self.counter.vocabulary] if self.terms else [], dtype=np.int64)

    def count(self, docs: DataFrame, terms: Column) -> DataFrame:
        """Add the sparse counts of the block's terms; a JVM lookup per row, no shuffle. A null text has no terms."""
        if self.counter is None:
            from pyspark.ml.functions import array_to_vector

            return docs.withColumn(f"{self.name}_tf", array_to_vector(F.array().cast("array<double>")))
        return self.counter.transform(docs.withColumn(
            f"{self.name}_terms", F.coalesce(terms, F.array().cast("array<string>")))).drop(f"{self.name}_terms")
