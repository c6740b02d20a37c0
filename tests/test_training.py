"""Counting a fitted vocabulary, and what makes training take few and cheap passes."""

import numpy as np
import pyarrow as pa
import pytest

from broadsheet.operators import design as D
from broadsheet.operators import linear
from broadsheet.operators import design as D
from broadsheet.operators import linear
from broadsheet.operators import terms as W
from broadsheet.params import JobParams, Ngrams, TextParams


@pytest.mark.parametrize("p", [
    Ngrams("word", 1, 2, 1, 60), Ngrams("word", 2, 2, 1, 60), Ngrams("word", 1, 3, 1, 60), Ngrams("char_wb", 3, 5, 1, 60), Ngrams("char", 2, 3, 1, 60)])
def test_terms_of_a_vocabulary_are_found_in_one_order(spark, p, monkeypatch):
    """Counts equal those of the JVM's expressions, and come in alphabetical order of the terms however rows are dealt."""
    monkeypatch.setattr(W, "COUNT_ROWS", 3)
    texts = ["ab cd ab é2 ab cd", "", None, "x", "cd ab   zz_zz cd", "abcabcabc ab", "unknown words only"] * 3
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    grams = {r["id"]: r["g"] for r in df.select("id", W.ngrams("text", p).alias("g")).collect()}
    every = sorted({g for found in grams.values() for g in found or []})
    terms = every[::2]
    tokens = [r["t"] or [] for r in df.select(W.tokens("text", p).alias("t"), "id").orderBy("id").collect()]
    row, at, tf = W.lookup(terms, p)(pa.array(tokens, pa.list_(pa.string())))
    assert (np.diff(row * len(terms) + at) > 0).all()
    want = {(i, g): found.count(g) for i, found in grams.items() for g in found or [] if g in terms}
    assert {(int(i), terms[k]): n for i, k, n in zip(row, at, tf)} == want


def test_an_intercept_without_penalty_costs_no_steps():
    """Dense columns far from 0 move it far: counted as penalised, it made conjugate gradients take many more steps."""
    rng = np.random.default_rng(2)
    n, size, dense = 400, 42, np.array([40, 41])
    x = np.where(rng.random((n, size)) < 0.2, rng.random((n, size)), 0.0)
    x[:, 40:] = 100.0 + rng.random((n, 2))
    reg = np.append(np.ones(size), 0.0)
    row, idx = np.nonzero(x)
    solve = linear._Sample(np.zeros(n, int), idx, x[row, idx], np.bincount(row), size, reg, 1.0, dense).solver(np.ones(n))
    whole = np.column_stack([x, np.ones(n)])
    move = np.append(np.zeros(size), -100.0)
    move[40] = 1.0
    product = whole.T @ (whole @ move) + reg * move
    assert solve(product) == pytest.approx(move, rel=0.01, abs=0.01)


def test_margins_of_many_problems_equal_those_of_each():
    rng = np.random.default_rng(3)
    lengths = np.array([3, 1, 5])
    idx, val = np.concatenate([rng.permutation(20)[:k] for k in lengths]).astype(np.int32), rng.standard_normal(9)
    w = rng.standard_normal((21, 6))
    w[:, 4] = 0.0
    whole = linear._margins(w, idx, val, lengths)
    assert whole == pytest.approx(np.concatenate([linear._margins(w[:, [k]], idx, val, lengths) for k in range(6)], axis=1))
    at = np.repeat(np.arange(3), lengths)
    assert whole == pytest.approx(np.stack([val[at == i] @ w[idx[at == i]] + w[-1] for i in range(3)]))


def test_weights_need_no_vocabulary_in_the_jvm(articles, monkeypatch):
    """Neither the driver's nor the executors' JVM holds the terms: they are looked up where they are counted."""
    def refuse(*_, **__):
        raise AssertionError("a vocabulary in the JVM")

    monkeypatch.setattr(W.CountVectorizer, "fit", refuse)
    dev = articles({"article": "red red blue"}, {"article": "blue green"}, {"article": None, "title": "red"})
    p = JobParams(text=TextParams(words=Ngrams("word", 1, 1, 1, 9), chars=None, max_df=1.0))
    found = {(r["id"], r["term"]) for r in D.term_weights(dev, p).collect()}
    assert {(0, "red"), (0, "blue"), (1, "blue"), (1, "green"), (2, "red")} <= found and (1, "red") not in found
