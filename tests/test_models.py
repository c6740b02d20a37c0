"""Evaluation tables, fitted features and trainers against brute force."""

from collections import Counter
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from broadsheet.operators import columns as C
from broadsheet.operators import design as D
from broadsheet.operators import dual, evaluate, linear
from broadsheet.operators import terms as W
from broadsheet.params import CHARS, WORDS, JobParams, ModelParams, Ngrams, SourceParams, TextParams
from broadsheet.plans import jobs
from broadsheet.sources import articles as A
from broadsheet.sources import sinks

SMALL = TextParams(words=replace(WORDS, min_df=1), chars=replace(CHARS, min_df=1), max_df=1.0)


def test_evaluation_edge_cases(spark):
    preds = spark.createDataFrame([(0, 0, 0), (0, 1, 2), (0, 1, 1)], "fold int, label int, pred int")
    assert evaluate.cv_summary(preds).first()["macro_f1_std"] == 0.0
    row = evaluate.fold_f1(preds).first()
    assert row["macro_f1"] == pytest.approx((1 + 2 / 3 + 0) / 3) and row["micro_f1"] == pytest.approx(2 / 3)
    assert [r["label"] for r in evaluate.true_pred_counts(preds).collect()] == [0, 1]
    assert evaluate.confusion_matrix(preds).columns == ["label", "pred_0", "pred_1"]
    assert evaluate.weak_labels(preds, 0).count() == 1


def test_pr_tables_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(int(rng.integers(0, 2)), float(rng.integers(0, 12)) / 3) for _ in range(80)]
    df = spark.createDataFrame([(y, y, s, None) for y, s in rows], "label int, pred int, score_1 double, score_7 double")
    long = A.score_rows(df)
    got = {r["threshold"]: (r["precision"], r["recall"]) for r in evaluate.pr_curve(long).collect()}
    pos = sum(y for y, _ in rows)
    want = {None: (1.0, 0.0)}
    for t in {s for _, s in rows}:
        hit = [y for y, s in rows if s >= t]
        want[t] = (sum(hit) / len(hit), sum(hit) / pos)
    assert set(got) == set(want) and all(got[t] == pytest.approx(want[t]) for t in want)
    f1 = {t: 2 * p * r / (p + r + 1e-12) for t, (p, r) in want.items() if t is not None}
    best = evaluate.best_f1_threshold(long).first()
    assert best["best_thr"] == min(t for t in f1 if f1[t] >= max(f1.values()) - 1e-12)
    assert [r["class"] for r in evaluate.average_precision(long).collect()] == ["1"]  # a class without scores is skipped


def test_source_binner(articles):
    df = articles(*[{"source": s} for s in ("a", "a", "a", "b", None)])
    got = C.bin_sources(df, C.fit_sources(df, SourceParams(min_count=3))).orderBy("id").collect()
    assert [r["source_bin"] for r in got] == ["a", "a", "a", "__OTHER__", "__OTHER__"]
    assert C.source_threshold(SourceParams(min_count=None, min_frac=0.3), 5) == 2


def test_time_fill_is_the_truncated_median(articles):
    df = articles({"timestamp": "2005-06-01"}, {"timestamp": "2006-07-01"}, {"timestamp": "N/A"})
    row = C.timestamp_features(df, include_missing=True).where("id = 2").first()
    assert (row["is_missing"], row["year"], row["month"]) == (1.0, 2005.0, 6.0)
    row = C.timestamp_features(articles({"timestamp": None})).first()
    assert (row["year"], row["month"], row["doy"], row["dow"]) == (1970.0, 1.0, 1.0, 0.0)


def _folded(articles):
    rows = []
    for i in range(24):
        word = "held" if i % 4 == 0 else f"common{i % 3}"
        rows.append({"title": f"{word} words", "article": f"text number{i % 5} {word}", "source": "only0" if i % 4 == 0 else "s",
                     "label": i % 3, "timestamp": f"200{i % 4}-0{1 + i % 9}-11"})
    return articles(*rows).withColumn("fold", (F.col("id") % 4).cast("int"))


def test_fitted_state_sees_training_rows_only(articles):
    rows = D.prepare(_folded(articles), SMALL)
    f = D.fit_features(rows, JobParams(text=SMALL, source=SourceParams(min_count=1)), [0, 1, 2, 3])
    word = f.blocks[0]
    held = word.terms.index("held")
    assert word.weights[0][held] == 0.0 and (word.weights[1:, held] > 0).all()
    only = f.sources.values.index("only0")
    assert f.sources.kept[:, only].tolist() == [False, True, True, True]
    assert f.fills[0]["year"] == 2002 and f.n_docs == {0: 18, 1: 18, 2: 18, 3: 18}


def test_text_blocks_have_unit_length(articles):
    rows = D.prepare(_folded(articles), SMALL)
    f = D.fit_features(rows, JobParams(text=SMALL), [0, 1])
    ends = [f.offsets["word"], f.offsets["char"], f.offsets["meta"]]
    for r in D.design(rows, f).collect():
        idx, val = np.array(r["idx"]), np.array(r["val"])
        assert len(set(r["idx"])) == len(idx) and idx.max() < f.size
        for a, b in zip(ends, ends[1:]):
            assert np.linalg.norm(val[(idx >= a) & (idx < b)]) == pytest.approx(1.0)
    assert len(f.names()) == f.size


def _dense_case(spark, k, n=90, d=6):
    rng = np.random.default_rng(7)
    x = rng.normal(size=(n, d))
    y = np.argmax(x[:, :k] + rng.normal(size=(n, k)), axis=1) if k > 2 else (x[:, 0] + rng.normal(size=n) > 0).astype(int)
    rows = [(i, int(y[i]), 0, -1, list(range(d)), [float(v) for v in x[i]]) for i in range(n)]
    df = spark.createDataFrame(rows, "id bigint, label int, fold int, model int, idx array<int>, val array<double>").repartition(3).persist()
    return df, x, y, {-1: {c: int((y == c).sum()) for c in range(k)}}


def _train(df, d, counts, **params):
    return linear.train(df, d, [-1], counts, ModelParams(tol=1e-8, max_iter=300, **params))


@pytest.mark.parametrize("k", [2, 3])
def test_ridge_equals_the_closed_form(spark, k):
    df, x, y, counts = _dense_case(spark, k)
    model = _train(df, 6, counts, type="ridge", ridge_alpha=2.0, class_weight_power=1.0)
    w = np.array([len(y) / (k * counts[-1][c]) for c in y])
    xb = np.hstack([x, np.ones((len(y), 1))])
    a = xb.T @ (xb * w[:, None]) + 2.0 * np.diag([1.0] * 6 + [0.0])
    for p, positive in enumerate(range(k) if k > 2 else [1]):
        t = np.where(y == positive, 1.0, -1.0)
        assert np.allclose(model.weights[0, p], np.linalg.solve(a, xb.T @ (w * t)), atol=1e-4)


@pytest.mark.parametrize("kind", ["linearsvc", "logreg"])
@pytest.mark.parametrize("k", [2, 3])
def test_margin_models_reach_their_minimum(spark, kind, k):
    df, x, y, counts = _dense_case(spark, k)
    model = _train(df, 6, counts, type=kind, C=2.0, class_weight_power=0.7)
    cw = {c: (len(y) / (k * n)) ** 0.7 for c, n in counts[-1].items()}
    xb = np.hstack([x, np.ones((len(y), 1))])
    for p, positive in enumerate(range(k) if k > 2 else [1]):
        t = np.where(y == positive, 1.0, -1.0)
        c = np.array([cw[v] if k == 2 or v == positive else 1.0 for v in y])

        def objective(w):
            z = t * (xb @ w)
            loss = np.maximum(0, 1 - z) ** 2 if kind == "linearsvc" else np.logaddexp(0, -z)
            return 0.5 * w @ w + 2.0 * np.sum(c * loss)

        w, rng = model.weights[0, p], np.random.default_rng(p)
        best = objective(w)
        assert all(objective(w + e * rng.normal(size=7)) >= best - 1e-7 for e in (1e-3, 1e-2, 0.1) for _ in range(40))


@pytest.mark.parametrize("parts", [1, 65, 300])
def test_the_driver_gets_one_vector_per_problem_from_any_number_of_tasks(spark, parts):
    df, _, _, counts = _dense_case(spark, 3)
    problems = linear.Problems.build(ModelParams(), [-1], counts)
    asked = {(0, p): (linear.TRIAL, np.zeros(7), np.ones(7) * (p + 1)) for p in range(3)}
    task = linear._pass_task(problems, 6, spark.sparkContext.broadcast(asked), lambda b: b)
    one = linear._summed(df.coalesce(1).mapInArrow(task, linear.PARTS))
    parts_df = df.repartition(parts).mapInArrow(task, linear.PARTS)
    added = parts_df.repartition("model", "problem", "block").mapInArrow(linear._add_parts, linear.PARTS)
    assert added.count() == 3
    many = linear._summed(parts_df)
    assert set(many) == set(one) and all(np.allclose(many[k], one[k]) for k in one)


@pytest.mark.parametrize("kind", ["linearsvc", "logreg", "ridge"])
def test_a_small_sample_only_slows_training_down(spark, kind, monkeypatch):
    df, _, _, counts = _dense_case(spark, 3)
    full = _train(df, 6, counts, type=kind)
    monkeypatch.setattr(linear, "SAMPLE", 20)
    part = _train(df, 6, counts, type=kind)
    assert full.converged.all() and part.converged.all() and np.allclose(full.weights, part.weights, atol=1e-5)


@pytest.mark.parametrize("kind", ["linearsvc", "logreg", "ridge"])
def test_one_block_is_solved_with_a_proof_and_several_are_a_start(spark, kind, monkeypatch):
    df, _, _, counts = _dense_case(spark, 3)
    whole = linear.train(df, 6, [-1], counts, ModelParams(type=kind))
    assert whole.passes == 2 and (whole.gaps < 1e-8).all() and whole.converged.all()
    for blocks in (256, 0):
        monkeypatch.setattr(dual, "BLOCK_ROWS", 31)
        monkeypatch.setattr(dual, "BLOCKS", blocks)
        parts = _train(df, 6, counts, type=kind)
        assert parts.converged.all() and np.isinf(parts.gaps).all() and np.allclose(whole.weights, parts.weights, atol=1e-5)


@pytest.mark.parametrize("n,d,held", [(40, 300, 0.02), (64, 50, 0.5), (1, 5, 1.0), (130, 7, 0.3)])
def test_products_of_sparse_rows(n, d, held):
    rng = np.random.default_rng(n)
    x = rng.normal(size=(n, d)) * (rng.random((n, d)) < held)
    row, idx = np.nonzero(x)
    assert np.allclose(dual.gram(row, idx, x[row, idx], n), x @ x.T)


@pytest.mark.parametrize("kind", ["linearsvc", "logreg", "ridge"])
def test_a_block_s_answer_is_a_minimum_and_its_gap_is_right(kind):
    rng = np.random.default_rng(3)
    x, z = rng.normal(size=(60, 200)), np.column_stack([rng.normal(size=60) + 900, np.zeros(60), np.ones(60)])
    t, c = np.where(x[:, 0] > 0, 1.0, -1.0), np.where(np.arange(60) % 7, 4.0, 0.0)
    loss, penalised = linear.LOSSES[kind]
    reg = np.array([1.0, 1.0, float(penalised)])
    a, v, gap = dual.solve_rows(kind, loss, x @ x.T, z, reg, t, c)
    assert gap < 1e-8 and (a[c == 0] == 0).all()

    def value(w, v):
        return loss(x @ w + z @ v, t, c)[0] + 0.5 * w @ w + 0.5 * reg @ (v * v)

    w, best = x.T @ a, value(x.T @ a, v)
    for e in (1e-5, 1e-3, 1e-1):
        assert all(value(w + e * rng.normal(size=200), v + e * rng.normal(size=3) / 900) >= best * (1 - 1e-8) for _ in range(30))


def test_unfinished_training_is_reported(spark, monkeypatch):
    monkeypatch.setattr(dual, "BLOCKS", 0)  # no start: small tables would be solved by it
    df, _, _, counts = _dense_case(spark, 3)
    with pytest.warns(UserWarning, match="before its tolerance"):
        model = linear.train(df, 6, [-1], counts, ModelParams(max_iter=2))
    assert not model.converged.any() and model.passes == 2


@pytest.mark.parametrize("kind", ["linearsvc", "logreg", "ridge"])
def test_default_parameters_reach_the_minimum(spark, kind):
    """At the default tolerance the objective is within 0.1 % of a tight run's, and predictions are the same."""
    from broadsheet.fixtures import news_dev

    dev = news_dev(spark, "/root/testdata/sf0.001")
    rows = sinks.stored(D.prepare(dev, TextParams()), "prepared")
    p = JobParams(model=ModelParams(type=kind))
    f = D.fit_features(rows, p, [-1])
    x = D.counted(rows, f).persist()
    counts = jobs._label_counts(rows, [-1])
    usual = linear.train(x, f.size, [-1], counts, p.model, D.assembler(f), f.dense)
    tight = linear.train(x, f.size, [-1], counts, replace(p.model, tol=1e-6, max_iter=400), D.assembler(f), f.dense)
    assert usual.converged.all() and usual.passes < 100
    problems = linear.Problems.build(p.model, [-1], counts)
    design = D.design(rows, f).toArrow().to_batches()
    labels = {}

    def objective(model):
        total = np.zeros(len(problems.signs))
        for b in design:
            y = np.searchsorted(problems.classes, b.column("label").to_numpy())
            for i, _, idx, val, lengths in linear._by_model(b, {-1: 0}):
                m = linear._margins(model.weights[i].T, idx, val, lengths)
                for q in range(len(total)):
                    total[q] += linear.LOSSES[kind][0](m[:, q], problems.signs[q, y], problems.costs[i, q, y])[0]
        reg = np.full(f.size + 1, problems.ridge)
        reg[-1] *= kind != "ridge"
        return total + 0.5 * (reg * model.weights[0] ** 2).sum(axis=1)

    a, b = objective(usual), objective(tight)
    assert (a <= b * 1.001).all()
    for model in (usual, tight):
        labels[model.passes] = [r["prediction"] for r in model.score(D.design(rows, f)).orderBy("id").collect()]
    assert len({tuple(v) for v in labels.values()}) == 1


def test_unknown_model_type():
    with pytest.raises(ValueError, match="unknown model type"):
        linear.Problems.build(ModelParams(type="forest"), [-1], {-1: {0: 1, 1: 1}})


def test_jobs_end_to_end(spark, articles, tmp_path):
    dev = _folded(articles).drop("fold")
    eva = articles({"title": "common1 words", "article": "text number1 common1"}, {"title": "new", "article": None}).drop("label")
    p = JobParams(text=SMALL, model=ModelParams(type="ridge", tol=1e-3), k=3, clean=False)
    out = str(tmp_path / "run")
    preds = jobs.run_cv(dev, eva, f"{out}/cv", p)
    assert preds.count() == 24 and preds.select("fold").distinct().count() == 3
    assert spark.read.csv(f"{out}/cv/folds", header=True).count() == 3
    assert spark.read.json(f"{out}/cv/cv_summary").first()["k"] == 3
    scored = jobs.train_and_score(dev, eva, f"{out}/test", p)
    again = jobs.FittedModel.load(spark, f"{out}/test/model").score(eva)
    a, b = ({r["id"]: (r["prediction"], tuple(np.round(r["scores"], 9))) for r in d.collect()} for d in (scored, again))
    assert a == b and spark.read.csv(f"{out}/test/submission", header=True).columns == ["Id", "Predicted"]


def test_sources(spark, articles, tmp_path):
    df = articles({"title": 'a "q", \n b', "article": "None", "timestamp": "N/A"}, {"title": " x", "article": "\\N"})
    path = sinks.write_csv(df.withColumnRenamed("id", " Id "), str(tmp_path / "dev.csv"))
    rows = A.read_development(spark, path).orderBy("id").collect()
    assert [r["title"] for r in rows] == ['a "q", \n b', " x"] and [r["article"] for r in rows] == [None, "\\N"]
    assert rows[0]["timestamp"] is None and rows[0]["label"] == 0
    with pytest.raises(ValueError, match="label"):
        A.read_development(spark, sinks.write_csv(df.drop("label"), str(tmp_path / "no.csv")))
    with pytest.raises(ValueError, match="extra"):
        A.enforce_schema(df, A.EVAL_COLUMNS, "eval")
    both = spark.createDataFrame([(1, 2)], "Id int, ID int")
    assert A.standardize_columns(both).columns == ["id", "ID"]
    assert A.score_columns(["prob_a", "logit_b", "x"]) == {"a": "prob_a"}
    with pytest.raises(ValueError, match="label"):
        A.resolve_predictions(df.drop("label"))


# ids, folders, options

def test_large_ids_stay_exact(spark, tmp_path):
    from broadsheet.operators import drift

    texts = [("9007199254740993", "7"), ("9007199254740992", "7.9"), ("1e30", "x"), ("12.0", "-3"), ("-", None)]
    raw = spark.createDataFrame(texts, "id string, page_rank string")
    got = A.typed(raw)
    assert [r["id"] for r in got.collect()] == [9007199254740993, 9007199254740992, None, 12, None]
    assert [r["page_rank"] for r in got.collect()] == [7.0, 7.9, None, -3.0, None]
    whole = spark.createDataFrame([(9007199254740993,)], "id bigint")
    assert drift.id_overlap(whole, spark.createDataFrame([(9007199254740992,)], "id bigint")).first()[0] == 0
    assert drift.id_overlap(whole, raw).first()[0] == 1
    path = sinks.write_predictions(whole.withColumn("prediction", F.lit(1)), str(tmp_path / "p"))
    assert spark.read.csv(path, header=True).first()["Id"] == "9007199254740993"
    dev = raw.selectExpr("id", "'s' source", "'t' title", "'a' article", "page_rank", "'2005-01-01' timestamp", "'1' label")
    back = A.read_development(spark, sinks.write_csv(dev, str(tmp_path / "dev")))
    assert back.schema["page_rank"].dataType.simpleString() == "double" and back.where("id = 9007199254740993").count() == 1


def test_intermediate_tables_need_a_shared_folder():
    class Conf:
        def get(self, *_):
            return None

    class Session:
        conf = Conf()
        sparkContext = type("Context", (), {"master": "yarn", "getCheckpointDir": lambda self: None})()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sinks.shared_dir(Session())


def test_stored_tables_can_be_discarded(spark):
    df = sinks.stored(spark.range(5), "gone")
    assert df.count() == 5
    files = df.inputFiles()
    sinks.discard(df)
    assert files and not any(__import__("os").path.exists(f.removeprefix("file://")) for f in files)


TEXTS = ["The cat sat on the mat", "a  b\tééé cat-cat", "", "x", "mat mat mat mat"]


def _plain_terms(text, p):
    import re

    squeezed = re.sub(r"\s+", " ", text).strip()
    if p.analyzer == "word":
        t = re.findall(r"\w{2,}", text)
        return [" ".join(t[i:i + n]) for n in range(p.low, p.high + 1) for i in range(len(t) - n + 1)]
    if p.analyzer == "char":
        return [squeezed[i:i + n] for n in range(p.low, p.high + 1) for i in range(len(squeezed) - n + 1)]
    out = []
    for w in squeezed.split():
        w = f" {w} "
        out += [w[i:i + n] for n in range(p.low, p.high + 1) for i in range(len(w) - n + 1)] if len(w) >= p.low else [w]
    return out


@pytest.mark.parametrize("p", [Ngrams("word", 1, 3, 1, 9), Ngrams("char", 2, 4, 1, 9), Ngrams("char_wb", 2, 5, 1, 9), Ngrams("char_wb", 4, 4, 1, 9)])
def test_terms_and_their_counts_equal_brute_force(spark, p):
    from broadsheet.operators import terms as W

    df = spark.createDataFrame([(t, i % 2) for i, t in enumerate(TEXTS)], "text string, fold int").repartition(3)
    got = {r["text"]: Counter(r["terms"]) for r in df.select("text", W.ngrams("text", p).alias("terms")).collect()}
    assert got == {t: Counter(_plain_terms(t, p)) for t in TEXTS}
    stats = {r["term"]: (r["tf_0"], r["df_0"], r["tf_1"], r["df_1"]) for r in W.term_stats(df, p, [0, 1]).collect()}
    want = {}
    for i, t in enumerate(TEXTS):
        for term, n in Counter(_plain_terms(t, p)).items():
            row = want.setdefault(term, [0, 0, 0, 0])
            out = 2 if i % 2 == 0 else 0  # a fold's own texts count for the other model
            row[out] += n
            row[out + 1] += 1
    assert stats == {k: tuple(v) for k, v in want.items()}


@pytest.mark.parametrize("limit", [1, 3, 4, 50])
def test_the_vocabulary_is_cut_at_its_limit(spark, limit):
    from broadsheet.operators import terms as W

    rows = [(f"t{i}", [9, 5, 5, 5, 2, 1][i % 6], 2) for i in range(18)]
    stats = spark.createDataFrame(rows, "term string, tf_all bigint, df_all bigint")
    got = {r["term"] for r in W.vocabulary(stats, -1, 10, 1, 1.0, limit).collect()}
    assert got == {t for t, _, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[:limit]}


def test_options_that_make_no_sense_are_refused():
    with pytest.raises(ValueError, match="stop words"):
        TextParams(stop_words="english")
    with pytest.raises(ValueError, match="accents"):
        TextParams(accents="latin")
    with pytest.raises(ValueError, match="analyzer"):
        Ngrams("line", 1, 2, 1, 1)
    p = TextParams(title=CHARS, stop_words=("a", "b"))
    from dataclasses import asdict

    assert TextParams.from_dict(__import__("json").loads(__import__("json").dumps(asdict(p)))) == p


def test_accents_and_stop_words(spark):
    from broadsheet.functions.canonical import clean_text
    from broadsheet.operators import terms as W

    df = spark.createDataFrame([("Éa 漢 ß the ﬁn",)], "t string")
    by = {a: df.select(clean_text("t", lowercase=True, accents=a)).first()[0] for a in (None, "unicode", "ascii")}
    assert by == {None: "éa 漢 ß the fin", "unicode": "ea 漢 ß the fin", "ascii": "ea the fin"}
    tokens = df.select(W.word_ngrams("t", 1, 1, ("the",))).first()[0]
    assert tokens == ["Éa", "ﬁn"]


def test_sources_beyond_the_limit_are_rare_ones(articles):
    rows = D.prepare(articles(*[{"source": s} for s in "aaabbbcc"]), SMALL)
    kept = D.SourceBlock.fit(rows, SourceParams(min_count=2, limit=2), [-1], {-1: 8})
    assert kept.values == ["a", "b"] and kept.has_other.tolist() == [True]
    for limit in (3, None):  # exactly as many as there are, and no limit
        all_kept = D.SourceBlock.fit(rows, SourceParams(min_count=2, limit=limit), [-1], {-1: 8})
        assert all_kept.values == ["a", "b", "c"] and all_kept.has_other.tolist() == [False]
    table = articles(*[{"source": s} for s in "aaabbbcc"])
    assert {r["value"] for r in C.fit_sources(table, SourceParams(min_count=2, limit=2)).collect()} == {"a", "b"}


def test_reports_and_profiles_are_written(spark, articles, tmp_path):
    dev = _folded(articles).drop("fold").where("label < 2")
    eva = articles({"title": "common1 words", "article": "text number1 common1"}, {"title": "new", "article": None}).drop("label")
    p = JobParams(text=SMALL, model=ModelParams(type="ridge"), k=2)
    out = str(tmp_path / "run")
    preds = jobs.run_cv(dev, eva, f"{out}/cv", p)
    assert spark.read.csv(f"{out}/cv/leakage_report", header=True).first()["n_eval"] == "2"
    assert spark.read.csv(f"{out}/cv/dedup_report", header=True).count() == 1
    summary = spark.read.json(f"{out}/cv/cv_summary").first()
    assert summary["n_dev"] == dev.count() and summary["passes"] > 0
    jobs.train_and_score(dev, eva, f"{out}/test", p)
    assert spark.read.csv(f"{out}/test/dedup_report", header=True).count() == 1
    assert spark.read.json(f"{out}/test/test_summary").first()["n_dev"] > 0
    written = jobs.run_eda(dev, eva, f"{out}/eda")
    assert {"missingness", "eval_missingness", "js_divergence", "label_summary"} <= set(written)
    assert {r["field"] for r in spark.read.csv(written["text_length_summary"], header=True).collect()} == {"title", "article"}
    assert set(jobs.run_oof_report(preds, f"{out}/oof")) == {"oof_counts", "pr_summary", "weak_labels", "score_separation", "score_histogram"}


def test_stages_fit_on_one_table_and_transform_another(spark, articles):
    from pyspark.ml import Pipeline

    from broadsheet.operators import stages as S

    train = articles(*[{"source": s, "timestamp": t, "title": x} for s, t, x in (
        ("a", "2005-06-01", "red fox"), ("a", "2006-06-02", "red hen"), ("a", None, "blue hen"), ("b", "2007-06-03", "fox"))])
    train = train.withColumn("page_rank", F.col("id").cast("double"))
    other = articles({"source": "b", "timestamp": None, "title": "red red unseen"}, {"source": "a", "title": None})
    other = other.withColumn("page_rank", F.lit(1.0))
    grams = Ngrams("word", 1, 1, min_df=1, limit=10)
    pipeline = Pipeline(stages=[
        S.SourceBins(SourceParams(min_count=2)), S.TimeFeatures(), S.Scaled(["page_rank"]), S.TfIdf(grams, "title", max_df=1.0)])
    rows = pipeline.fit(train).transform(other).orderBy("id").collect()
    assert [r["source_bin"] for r in rows] == ["__OTHER__", "a"]
    assert rows[0]["year"] == 2006.0 and rows[0]["month"] == 6.0
    assert rows[0]["page_rank"] == pytest.approx(1 / np.std([0, 1, 2, 3]))
    assert rows[0]["terms_idx"] == [3] and rows[0]["terms_val"] == pytest.approx([1.0]) and rows[1]["terms_idx"] == []


def test_a_vocabulary_goes_to_the_jvm_in_few_calls(spark, monkeypatch):
    from pyspark.ml.feature import CountVectorizerModel

    def refuse(*_, **__):
        raise AssertionError("a call for each term")

    monkeypatch.setattr(CountVectorizerModel, "_new_java_array", refuse)
    names = sorted(f"t{i}" for i in range(5000))
    block = W.TermBlock.of_terms(spark, "word", names, np.ones((1, len(names))))
    docs = spark.createDataFrame([(["t7", "t4999", "t7", "no"],), (None,)], "t array<string>")
    found = block.count(docs, F.col("t")).select("word_tf").collect()
    assert {names[block.order[i]]: found[0][0][int(i)] for i in found[0][0].indices} == {"t7": 2.0, "t4999": 1.0}
    assert not len(found[1][0].indices)


def test_packed_rows_are_the_same_rows(spark):
    df = spark.createDataFrame([(i, [i, i + 1] if i % 3 else None) for i in range(2000)], "id bigint, v array<bigint>").repartition(3)
    rows = D.packed(df)
    assert rows.count() < 20
    assert sorted(map(tuple, rows.mapInArrow(D.unpacked, df.schema).collect())) == sorted(map(tuple, df.collect()))


def test_a_quadratic_loss_takes_one_newton_step():
    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(300, 40)) * np.logspace(0, 1.5, 40), rng.normal(size=300)
    ones = np.ones(41)
    solver, trials = linear._newton(40, ones, lambda w: lambda v: v, 1e-4, None, True), 0
    z = np.column_stack([x, np.ones(300)])
    ask, done = next(solver), None
    while done is None:
        kind, w, d = ask
        trials += kind == linear.TRIAL
        if kind == linear.PRODUCT:
            total = np.concatenate([z.T @ (z @ d), np.zeros(len(linear.STEPS) + 1)])
        else:
            losses = [0.5 * np.sum((y - z @ (w + a * d)) ** 2) for a in (0.0, *linear.STEPS)]
            total = np.concatenate([z.T @ (z @ (w + d) - y), losses])
        try:
            ask = solver.send(total)
        except StopIteration as end:
            done = end.value
    assert done[1] and trials == 2
    assert np.allclose(done[0], np.linalg.solve(z.T @ z + np.eye(41), z.T @ y), atol=1e-3)


def test_a_counting_task_sends_few_words_and_pairs_at_a_time(monkeypatch):
    import pyarrow as pa

    texts = [[f"w{i % 40}", f"v{i}", "x"] for i in range(300)]
    batch = pa.RecordBatch.from_pydict({"fold": pa.array([0] * 300, pa.int32()), "tokens": texts})
    rows = lambda: [b for b in W._counter(WORDS)(iter([batch]))]
    monkeypatch.setattr(W, "SENT", 10_000)
    whole = sorted(zip(*[pa.Table.from_batches(rows())[c].to_pylist() for c in ("term", "tf", "df")]))
    monkeypatch.setattr(W, "SENT", 100)
    found = rows()
    assert len(found) > 5 and max(b.num_rows for b in found) <= 100
    assert sorted(zip(*[pa.Table.from_batches(found)[c].to_pylist() for c in ("term", "tf", "df")])) == whole


@pytest.mark.parametrize("p", [WORDS, CHARS])
def test_a_counting_task_holds_few_terms_whatever_the_batch(monkeypatch, p):
    import pyarrow as pa

    monkeypatch.setattr(W, "COUNT_TERMS", 500)
    texts = [[f"w{i}x{k}" for k in range(4)] for i in range(3000)]
    batch = pa.RecordBatch.from_pydict({"fold": pa.array([i % 2 for i in range(3000)], pa.int32()), "tokens": texts})
    found = list(W._counter(p)(iter([batch])))
    assert max(b.num_rows for b in found) < 6000
    total = Counter()
    for b in found:
        total.update({(f, t): n for f, t, n in zip(*(b.column(c).to_pylist() for c in ("fold", "term", "tf")))})
    grams = W._word_grams(1, 2) if p is WORDS else lambda t: [g for w in t for g in W._inside_grams(3, 5)(w)]
    assert total == Counter((i % 2, g) for i, t in enumerate(texts) for g in grams(t))


@pytest.mark.parametrize("share", [1.0, 0.25])
def test_steps_follow_dense_columns_that_hang_together_with_all_others(share):
    """The preconditioner inverts the whole curvature, products of dense and sparse columns included."""
    rng = np.random.default_rng(5)
    n, size, dense = 40, 30, np.array([28, 29])
    x = np.where(rng.random((n, size)) < 0.3, rng.random((n, size)), 0.0)
    x[:, 28:] = 1400.0 + rng.random((n, 2))
    row, idx = np.nonzero(x)
    reg = np.full(size + 1, 2.0)
    sample = linear._Sample(np.zeros(n, int), idx, x[row, idx], np.bincount(row), size, reg, share, dense)
    bend = rng.random(n)
    whole = np.column_stack([x, np.ones(n)])
    lift = (1 - share) * linear.RAISE * np.mean(bend / share * (x[:, :28] ** 2).sum(axis=1))
    curvature = np.diag(reg + np.append(np.full(28, lift), [0.0, 0.0, 0.0])) + whole.T @ (whole * (bend / share)[:, None])
    v = rng.standard_normal(size + 1)
    assert curvature @ sample.solver(bend)(v) == pytest.approx(v, abs=1e-5)
    assert sample.solver(bend) is sample.solver(bend.copy())


@pytest.mark.parametrize("p", [Ngrams("word", 1, 1, 1, 9), Ngrams("word", 1, 2, 1, 9), Ngrams("word", 2, 2, 1, 9)])
def test_words_and_pairs_are_counted_without_a_python_object_for_each(monkeypatch, p):
    import pyarrow as pa

    rng = np.random.default_rng(3)
    texts = [[f"w{k}" for k in rng.integers(0, 9, n)] for n in [0, 1, 2, 40, 0, *rng.integers(0, 30, 300)]]
    folds = [i % 3 for i in range(len(texts))]
    batches = [pa.RecordBatch.from_pydict({"fold": pa.array(f, pa.int32()), "tokens": pa.array(t, pa.list_(pa.string()))})
               for f, t in ((folds[:0], texts[:0]), (folds[:5], texts[:5]), (folds[5:], texts[5:]))]
    want_tf, want_df = Counter(), Counter()
    for f, t in zip(folds, texts):
        grams = W._word_grams(p.low, p.high)(t)
        want_tf.update((f, g) for g in grams)
        want_df.update((f, g) for g in set(grams))
    monkeypatch.setattr(W, "COUNT_TERMS", 50)
    monkeypatch.setattr(W, "_word_grams", None)
    tf, df = Counter(), Counter()
    for b in W._counter(p)(iter(batches)):
        for f, t, n, d in zip(*(b.column(c).to_pylist() for c in ("fold", "term", "tf", "df"))):
            tf[f, t] += n
            df[f, t] += d
    assert tf == want_tf and df == want_df


def test_a_step_is_not_solved_further_than_training_needs():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 30)) * np.arange(1, 31) ** -0.5
    y = np.where(x[:, 0] + rng.standard_normal(400) > 0, 1.0, -1.0)
    z, reg, tol = np.column_stack([x, np.ones(400)]), np.ones(31), 1e-4
    solver, left = linear._newton(30, reg, lambda w: lambda v: v, tol), []
    ask = next(solver)
    first = None
    try:
        while True:
            kind, w, d = ask
            c = np.ones(400)
            if kind == linear.PRODUCT:
                total = np.concatenate([z.T @ (linear.logistic(z @ w, y, c)[2] * (z @ d)), np.zeros(len(linear.STEPS) + 1)])
            else:
                slope = z.T @ linear.logistic(z @ (w + d), y, c)[1]
                losses = [linear.logistic(z @ (w + a * d), y, c)[0] for a in (0.0, *linear.STEPS)]
                left.append(np.linalg.norm(slope + reg * (w + d)))
                first = first or left[0]
                total = np.concatenate([slope, losses])
            ask = solver.send(total)
    except StopIteration as end:
        assert end.value[1]
    assert 0.1 * tol * first < left[-1] <= tol * first
