"""The cache of fitted features: found for equal tables and parameters, and for nothing else; unfinished entries do not count."""

from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.operators import design as D
from broadsheet.operators import terms
from broadsheet.params import JobParams, Ngrams, SourceParams, TextParams
from broadsheet.plans import cache, jobs

SMALL = TextParams(words=Ngrams("word", 1, 1, min_df=1, limit=50), chars=None)


@pytest.fixture
def counted(monkeypatch):
    """How often terms were counted."""
    calls, real = [], terms.term_stats
    monkeypatch.setattr(terms, "term_stats", lambda *a, **k: calls.append(1) or real(*a, **k))
    return calls


def _rows(articles, n=12, **last):
    rows = [{"title": f"word{i % 3} title", "article": f"text{i % 4}", "source": f"s{i % 2}", "label": i % 2} for i in range(n)]
    rows[-1] |= last
    return D.prepare(articles(*rows).withColumn("fold", (F.col("id") % 2).cast("int")), SMALL)


def test_the_second_fit_counts_no_terms(articles, tmp_path, counted):
    p = JobParams(text=SMALL, source=SourceParams(min_count=1), cache=str(tmp_path))
    first = cache.fitted(_rows(articles), p, [0, 1])
    assert len(counted) == 1
    again = cache.fitted(_rows(articles).repartition(5).orderBy(F.desc("id")), p, [0, 1])
    assert len(counted) == 1
    assert again.names() == first.names() and again.fills == first.fills and again.scales == first.scales and again.n_docs == first.n_docs
    assert all(np.array_equal(a.weights, b.weights) for a, b in zip(first.blocks, again.blocks))
    assert np.array_equal(first.sources.kept, again.sources.kept) and np.array_equal(first.sources.has_other, again.sources.has_other)
    a, b = (sorted(map(repr, D.design(_rows(articles), f).collect())) for f in (first, again))
    assert a == b


def test_whatever_changes_is_fitted_anew(articles, tmp_path, counted):
    p = JobParams(text=SMALL, cache=str(tmp_path))
    cache.fitted(_rows(articles), p, [0, 1])
    others = [
        (_rows(articles, article="other"), p, [0, 1]), (_rows(articles, n=13), p, [0, 1]), (_rows(articles), p, [-1]),
        (_rows(articles), replace(p, source=SourceParams(min_count=2)), [0, 1]),
        (_rows(articles), replace(p, text=replace(SMALL, max_df=0.5)), [0, 1]),
        (_rows(articles).withColumn("fold", 1 - F.col("fold")), p, [0, 1])]
    for n, case in enumerate(others, 2):
        cache.fitted(*case)
        assert len(counted) == n
    cache.fitted(_rows(articles), replace(p, seed=1), [0, 1])  # fitting does not depend on it
    assert len(counted) == len(others) + 1


def test_unfinished_and_stale_entries_do_not_count(spark, articles, tmp_path, counted, monkeypatch):
    p = JobParams(text=SMALL, cache=str(tmp_path / "a"))
    rows = _rows(articles)

    def dies(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(cache, "_marks", dies)  # after the tables, before the manifest
        with pytest.raises(RuntimeError, match="lost"):
            cache.fitted(rows, p, [-1])
    cache.fitted(rows, p, [-1])
    assert len(counted) == 2
    entry = f"{p.cache}/features-{cache.entry_name(rows, p, [-1])}"
    run = __import__("json").loads(spark.read.parquet(f"{entry}/manifest").first()["manifest"])["run"]
    spark.createDataFrame([("word", 0, "x", [1.0])], "block string, idx int, term string, weights array<double>").write.mode(
        "overwrite").parquet(f"{entry}/{run}/terms")
    spark.catalog.refreshByPath(f"{entry}/{run}/terms")
    assert cache.find(spark, entry) is None
    cache.fitted(rows, p, [-1])
    assert len(counted) == 3 and cache.find(spark, entry) is not None


def test_jobs_use_the_cache(articles, tmp_path, counted):
    dev = articles(*[{"title": f"word{i % 3} title", "article": f"text{i % 4}", "label": i % 2} for i in range(16)])
    p = JobParams(text=SMALL, k=2, clean=False, cache=str(tmp_path))
    a = jobs.train_final(dev, None, p)
    b = jobs.train_final(dev, None, replace(p, model=replace(p.model, C=1.0)))
    assert len(counted) == 1 and not np.allclose(a.linear.weights, b.linear.weights)
