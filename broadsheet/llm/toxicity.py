"""Toxicity by a chain of classifiers: later categories see the probabilities of earlier ones."""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from broadsheet.llm.common import map_bytes, plain, stored

# ASCII characters that are neither letters nor digits part words.
PARTS = bytes(i if i >= 128 or chr(i).isalnum() else 32 for i in range(256))


@dataclass(frozen=True)
class ChainParams:
    """``sample`` bounds the labelled rows that models are fitted on (the first by a hash), ``features`` the words and word
    beginnings chosen for each category, ``prefixes`` the lengths of beginnings in bytes, ``min_gain`` what their likelihood ratio must
    reach (in nats), ``folds`` the parts for out-of-fold probabilities, ``ridge`` the penalty on squared weights."""

    sample: int = 20_000
    features: int = 128
    prefixes: tuple[int, ...] = (4, 5, 6)
    min_docs: int = 5
    min_gain: float = 5.0
    folds: int = 5
    ridge: float = 1.0
    threshold: float = 0.5


def traits(text: bytes, prefixes: tuple[int, ...]) -> list[set[bytes]]:
    """Distinct words of a text, then the distinct beginnings of longer words, a set for each length."""
    words = set(text.lower().translate(PARTS).split())
    return [words] + [{w[:k] for w in words if len(w) > k} for k in prefixes]


def choose_traits(rows: DataFrame, categories: list[str], p: ChainParams) -> list[tuple[int, bytes]]:
    """The (kind, value) that tell most about a category, by the likelihood ratio of their documents' labels."""
    def run(batches):
        counts: dict[tuple[int, bytes], list[int]] = defaultdict(lambda: [0] * (len(categories) + 1))

        def flush():
            keys = list(counts)
            out = {"kind": [k for k, _ in keys], "value": [v for _, v in keys], "n": [counts[k][0] for k in keys]}
            return out | {f"n_{i}": [counts[k][i + 1] for k in keys] for i in range(len(categories))}

        for b in batches:
            for i, t in enumerate(b["text"]):
                marks = [1] + [int(b[c][i]) for c in categories]
                for kind, values in enumerate(traits(t, p.prefixes)):
                    for v in values:
                        found = counts[kind, v]
                        for k, m in enumerate(marks):
                            found[k] += m
                if len(counts) > 200_000:
                    yield flush()
                    counts.clear()
        yield flush()

    schema = "kind int, value binary, n bigint" + "".join(f", n_{i} bigint" for i in range(len(categories)))
    sums = [F.sum("n").alias("n")] + [F.sum(f"n_{i}").alias(f"n_{i}") for i in range(len(categories))]
    table = map_bytes(rows, run, schema).groupBy("kind", "value").agg(*sums).where(F.col("n") >= p.min_docs)
    table = stored(table, "tox-traits")
    totals = rows.agg(F.count(F.lit(1)), *[F.sum(F.col(c).cast("bigint")) for c in categories]).first()
    chosen: dict[tuple[int, bytes], None] = {}
    for i in range(len(categories)):
        share = min(max((totals[i + 1] or 0) / max(1, totals[0]), 1e-6), 1 - 1e-6)
        hit, miss = F.col(f"n_{i}"), F.col("n") - F.col(f"n_{i}")
        part = lambda x, e: F.when(x > 0, x * F.log(x / (F.col("n") * e))).otherwise(F.lit(0.0))
        gain = part(hit, F.lit(share)) + part(miss, F.lit(1 - share))
        best = table.withColumn("gain", gain).where(F.col("gain") >= p.min_gain).orderBy(F.desc("gain"), "kind", "value").limit(p.features).collect()
        chosen |= {(r["kind"], bytes(r["value"])): None for r in best}
    return list(chosen)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float, passes: int = 30) -> np.ndarray:
    """Weights (the last for the constant) of a penalised logistic regression, by Newton steps with halving."""
    x = np.c_[x, np.ones(len(x))]
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])

    def loss(w):
        z = x @ w
        return np.logaddexp(0, z).sum() - z @ y + (penalty * w * w).sum() / 2

    now = loss(w)
    for _ in range(passes):
        q = 1 / (1 + np.exp(-np.clip(x @ w, -35, 35)))
        slope = x.T @ (q - y) + penalty * w
        if np.abs(slope).max() < 1e-6 * max(1, len(y)):
            break
        step = np.linalg.solve((x * (q * (1 - q))[:, None]).T @ x + np.diag(penalty), slope)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        now = loss(w)
    return w


def _probability(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -35, 35)))


@dataclass
class Chain:
    categories: list[str]
    traits: list[tuple[int, bytes]]
    weights: list[np.ndarray]  # one per category: traits, earlier probabilities, constant
    params: ChainParams

    def places(self) -> list[dict[bytes, int]]:
        out: list[dict[bytes, int]] = [{} for _ in range(1 + len(self.params.prefixes))]
        for i, (kind, value) in enumerate(self.traits):
            out[kind][value] = i
        return out

    def matrix(self, hits: list[list[int]]) -> np.ndarray:
        x = np.zeros((len(hits), len(self.traits)))
        for row, h in zip(x, hits):
            row[h] = 1.0
        return x

    def predict(self, x: np.ndarray) -> np.ndarray:
        for w in self.weights:
            x = np.c_[x, _probability(x, w)]
        return x[:, len(self.traits):]


def hits(text: bytes, places: list[dict[bytes, int]], prefixes: tuple[int, ...]) -> list[int]:
    return [found[v] for found, values in zip(places, traits(text, prefixes)) for v in values & found.keys()]


def fit_chain(docs: DataFrame, labels: DataFrame, categories: list[str], p: ChainParams = ChainParams()) -> Chain:
    """Fit on at most ``sample`` rows of ``labels`` (doc_id and a boolean per category; later rows of an id and rows with
    nulls are left) joined with ``docs``. Every model but the first is fitted with the earlier categories' probabilities
    for rows that the model giving them has not seen, as at prediction."""
    rows = labels.select("doc_id", *categories).where(" and ".join(f"{c} is not null" for c in ["doc_id", *categories]))
    rows = rows.groupBy("doc_id").agg(*[F.max(c).alias(c) for c in categories])
    chosen = stored(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(p.sample), "tox-sample")
    # at most ``sample`` short rows
    texts = plain(docs, "doc_id", "text").join(F.broadcast(chosen), "doc_id")
    texts = stored(texts, "tox-texts")
    chain = Chain(categories, choose_traits(texts, categories, p), [], p)
    places, prefixes = chain.places(), p.prefixes

    def run(batches):
        for b in batches:
            yield {"doc_id": b["doc_id"], "hits": [hits(t, places, prefixes) for t in b["text"]], **{c: b[c] for c in categories}}

    schema = "doc_id bigint, hits array<int>" + "".join(f", {c} boolean" for c in categories)
    found = map_bytes(texts, run, schema).orderBy("doc_id").collect()
    x = chain.matrix([r["hits"] for r in found])
    fold = np.arange(len(found)) % p.folds
    for c in categories:
        y = np.array([r[c] for r in found], float)
        outside = np.zeros(len(y))
        for f in range(p.folds):
            seen = fold != f
            if seen.any() and (~seen).any():
                outside[~seen] = _probability(x[~seen], logistic(x[seen], y[seen], p.ridge))
        chain.weights.append(logistic(x, y, p.ridge))
        x = np.c_[x, outside]
    return chain


def score_documents(docs: DataFrame, chain: Chain) -> DataFrame:
    """(doc_id, p_<category>...) of every row of ``docs``. Null or empty text: no traits. Empty table: no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # bounded by the parameters

    def run(batches):
        model = shared.value
        places = model.places()
        for b in batches:
            p = model.predict(model.matrix([hits(t, places, model.params.prefixes) for t in b["text"]]))
            yield {"doc_id": b["doc_id"], **{f"p_{c}": p[:, i] for i, c in enumerate(model.categories)}}

    return map_bytes(plain(docs, "doc_id", "text"), run, "doc_id bigint" + "".join(f", p_{c} double" for c in chain.categories))


def toxicity(docs: DataFrame, labels: DataFrame, p: ChainParams = ChainParams()) -> DataFrame:
    """(doc_id, toxic, toxic_score, low_quality_score) of every row of ``docs``: a chain of low quality, then toxicity,
    learned from ``labels`` (doc_id, quality 0/1, toxic 0/1). Nothing labelled: all scores one half, nothing toxic."""
    marks = labels.select("doc_id", (F.col("quality") == 0).alias("low_quality"), (F.col("toxic") == 1).alias("toxic"))
    chain = fit_chain(docs, marks, ["low_quality", "toxic"], p)
    return score_documents(docs, chain).select(
        "doc_id", (F.col("p_toxic") > p.threshold).alias("toxic"), F.col("p_toxic").alias("toxic_score"),
        F.col("p_low_quality").alias("low_quality_score"))
