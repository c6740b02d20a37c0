"""Skew-safe matching, running totals, exact quantiles, duplicates and folds against brute force."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.operators import dedup, folds, keyed, profile


@pytest.fixture(params=[1, 1024])
def hot(request, monkeypatch):
    monkeypatch.setattr(keyed, "HOT_KEYS", request.param)
    return request.param


def test_flag_rows_with_one_dominant_key(spark, hot):
    rows = spark.range(400).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"))
    rows = rows.withColumn("_key", keyed.digest("k"))
    for wanted in ([0, 7, 11], [7, 11]):
        keys = rows.groupBy("_key").agg(F.count("*").alias("n"), F.max(F.col("k").isin(wanted)).alias("hit"))
        flagged = keyed.flag_rows(rows, keys, "_key", "hit")
        assert {r["id"] for r in flagged.where("hit").collect()} == {r["id"] for r in rows.where(F.col("k").isin(wanted)).collect()}
        assert flagged.count() == 400


def test_digest_keeps_neighbours_and_nulls_apart(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "x"), ("", "x"), ("-", "x"), (None, "x")], "p string, q string")
    keys = [bytes(r[0]) for r in df.select(keyed.digest("p", "q")).collect()]
    assert len(set(keys)) == 5 and keys[2] == keys[5]


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    rng = np.random.default_rng(1)
    data = {(str(g), float(v)): int(n) for g, v, n in zip(rng.integers(0, 3, 300), rng.integers(0, 90, 300) / 7, rng.integers(1, 5, 300))}
    df = spark.createDataFrame([(g, v, n) for (g, v), n in data.items()], "g string, v double, n bigint")
    for buckets in (2, 16, 256):
        got = {(r["g"], r["v"]): r["cum_n"] for r in keyed.running_totals(df, ["g"], "v", ["n"], descending, buckets).collect()}
        assert got == {
            (g, v): sum(n for (h, w), n in data.items() if h == g and ((w >= v) if descending else (w <= v))) for g, v in data}


def test_exact_quantiles_equal_numpy(spark):
    rng = np.random.default_rng(2)
    values = rng.normal(size=501).tolist() + [3.0] * 200
    df = spark.createDataFrame([(int(i % 2), float(v)) for i, v in enumerate(values)], "g int, v double")
    qs = [0.0, 0.01, 0.37, 0.5, 0.9, 1.0]
    for r in keyed.exact_quantiles(df, ["g"], "v", qs, buckets=8).collect():
        want = np.quantile([v for i, v in enumerate(values) if i % 2 == r["g"]], qs)
        assert np.allclose([r[f"q{i}"] for i in range(len(qs))], want)


def test_numeric_summary_modes_agree(spark):
    df = spark.createDataFrame([(v,) for v in (1.0, 2.0, 2.0, 5.0, None)], "v double")
    assert profile.numeric_summary(df, "v").first() == profile.numeric_summary(df, "v", "compact").first()
    assert profile.numeric_summary(df.where("v > 9"), "v").first()["count"] == 0


ROWS = [
    {"id": 5, "title": "A", "article": "x", "label": 1}, {"id": 3, "title": " a ", "article": "X", "label": 1},
    {"id": 4, "title": "b", "article": "y", "label": 0}, {"id": 6, "title": "B", "article": "y", "label": 2},
    {"id": 7, "title": "c", "article": "z", "label": None}, {"id": 8, "title": "c", "article": "z", "label": 1},
    {"id": 9, "title": "d", "article": "w", "label": 0},
]


def test_cross_label_duplicates(articles, hot):
    dev = articles(*ROWS)
    out, report = dedup.drop_cross_label_duplicates(dev)
    assert sorted(r["id"] for r in out.collect()) == [3, 5, 9]
    assert report.first().asDict() == {
        "n_dev_before": 7, "n_dev_after": 3, "dup_groups": 3, "cross_label_groups": 2, "cross_label_rows": 4,
        "same_label_groups": 1, "same_label_rows": 2, "rows_removed_cross_label": 4, "rows_removed_same_label": 0,
        "pct_removed_from_dev": pytest.approx(400 / 7)}
    out, report = dedup.drop_cross_label_duplicates(dev, drop_same_label=True)
    assert sorted(r["id"] for r in out.collect()) == [3, 9]
    assert out.columns == dev.columns and report.first()["rows_removed_same_label"] == 1
    again, _ = dedup.drop_cross_label_duplicates(out, drop_same_label=True)
    assert again.count() == 2


def test_overlap(articles, hot):
    dev = articles(*ROWS)
    other = articles({"title": "<b>A</b>", "article": "x"}, {"title": "D", "article": "v"}, {"title": "b", "article": "Y "}).drop("label")
    kept, report = dedup.drop_overlap(dev, other, drop=True)
    assert sorted(r["id"] for r in kept.collect()) == [7, 8, 9]
    row = report.first()
    assert (row["n_overlap_with_eval"], row["n_dev_after"], row["n_eval"]) == (4, 3, 3)
    same, report = dedup.drop_overlap(dev, other)
    assert same is dev and report.first()["n_removed_from_dev"] == 0


def test_missing_columns_are_reported(articles):
    with pytest.raises(ValueError, match="title"):
        dedup.with_key(articles(*ROWS).drop("title"))
    with pytest.raises(ValueError, match="label"):
        dedup.drop_cross_label_duplicates(articles(*ROWS).drop("label"))


def test_folds_differ_by_at_most_one_per_label(spark):
    df = spark.range(1003).select("id", (F.col("id") % 10 < 7).cast("int").alias("label"))
    sizes = {}
    for r in folds.stratified_folds(df, 5, 42).groupBy("label", "fold").count().collect():
        sizes.setdefault(r["label"], []).append(r["count"])
    assert all(max(s) - min(s) <= 1 and len(s) == 5 for s in sizes.values())
    a = {r["id"]: r["fold"] for r in folds.stratified_folds(df, 5, 42).collect()}
    b = {r["id"]: r["fold"] for r in folds.stratified_folds(df.repartition(7), 5, 42).collect()}
    c = {r["id"]: r["fold"] for r in folds.stratified_folds(df, 5, 43).collect()}
    assert a == b and a != c


def test_folds_are_even_over_many_labels(spark):
    df = spark.range(700).select("id", (F.col("id") * F.col("id") % 41).cast("int").alias("label"))
    folded = folds.stratified_folds(df, 5, 1)
    assert [r["count"] for r in folded.groupBy("fold").count().collect()] == [140] * 5
    per_label = {}
    for r in folded.groupBy("label", "fold").count().collect():
        per_label.setdefault(r["label"], []).append(r["count"])
    assert all(max(s) - (min(s) if len(s) == 5 else 0) <= 1 for s in per_label.values())
    with pytest.raises(ValueError, match="at least two folds"):
        folds.stratified_folds(df, 1, 1)


def test_histogram_equals_numpy(spark):
    values = np.random.default_rng(3).gamma(2.0, size=400).round(2)
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    rows = profile.histogram(df, "v", 17).orderBy("bin").collect()
    counts, edges = np.histogram(values, bins=17)
    assert [r["n"] for r in rows] == counts.tolist()
    assert np.allclose([r["left"] for r in rows], edges[:-1]) and np.allclose([r["right"] for r in rows], edges[1:])
    flat = profile.histogram(spark.createDataFrame([(2.0,), (2.0,)], "v double"), "v", 2).orderBy("bin").collect()
    assert [(r["left"], r["right"], r["n"]) for r in flat] == [(1.5, 2.0, 0), (2.0, 2.5, 2)]
