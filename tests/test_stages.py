"""Stages and pipelines of them: saved, loaded in another session, and equal; null and empty texts at every stage."""

import subprocess
import sys

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from broadsheet.functions import text
from broadsheet.operators import stages as S
from broadsheet.params import Ngrams, SourceParams
from tests.conftest import ROOT

WORDS = Ngrams("word", 1, 1, min_df=1, limit=10)


def _pipeline():
    return Pipeline(stages=[
        S.StripAdPrefix("title", "plain"), S.JoinText(title="plain"), S.CleanText("text", "clean", lowercase=True, accents="unicode"),
        S.CanonicalText("article", "canonical"), S.MissingIndicator("article", "gone"), S.TextColumn("article", "shown", "none"),
        S.TextPatterns(), S.NumericCoerce("page_rank", "rank"), S.TimestampMissing("timestamp", "no_time"),
        S.SourceBins(SourceParams(min_count=2)), S.TimeFeatures(), S.Scaled(["rank"]), S.TfIdf(WORDS, "clean", max_df=1.0, stop_words=("the",))])


@pytest.fixture
def rows(articles):
    return articles(
        {"source": "a", "timestamp": "2005-06-01", "title": "Advertisement: The red fox", "page_rank": "3"},
        {"source": "a", "timestamp": "2006-06-02", "title": "red hén", "article": "\\N", "page_rank": "x"},
        {"source": "a", "timestamp": None, "title": None, "article": None, "page_rank": None},
        {"source": "b", "timestamp": "soon", "title": "", "article": ""}, {"source": None, "title": "The", "article": "fox " * 50_000})


def _answers(df):
    return sorted(repr(r.asDict()) for r in df.collect())


def test_a_saved_pipeline_gives_equal_rows(spark, rows, tmp_path):
    fitted = _pipeline().fit(rows)
    want = _answers(fitted.transform(rows))
    fitted.save(str(tmp_path / "fitted"))
    again = PipelineModel.load(str(tmp_path / "fitted"))
    assert _answers(again.transform(rows)) == want and [s.uid for s in again.stages] == [s.uid for s in fitted.stages]
    _pipeline().save(str(tmp_path / "open"))
    assert _answers(Pipeline.load(str(tmp_path / "open")).fit(rows).transform(rows)) == want
    first = fitted.transform(rows).orderBy("id").first()
    assert first["plain"] == " The red fox" and first["clean"] == "the red fox the red fox a" and first["source_bin"] == "a"


def test_a_saved_pipeline_is_loaded_by_another_process(rows, tmp_path):
    fitted = _pipeline().fit(rows)
    fitted.save(str(tmp_path / "fitted"))
    rows.write.parquet(str(tmp_path / "rows"))
    code = f"""
import sys; sys.path.insert(0, {ROOT!r})
from pyspark.ml import PipelineModel
from broadsheet.session import session
spark = session(cores="2", memory="1g")
rows = spark.read.parquet({str(tmp_path / "rows")!r})
PipelineModel.load({str(tmp_path / "fitted")!r}).transform(rows).write.parquet({str(tmp_path / "out")!r})
"""
    subprocess.run([sys.executable, "-c", code], check=True, timeout=300, capture_output=True)
    out = rows.sparkSession.read.parquet(str(tmp_path / "out"))
    assert _answers(out) == _answers(fitted.transform(rows))


def test_stages_have_params_and_can_be_copied(rows):
    stage = S.TextColumn("article", "shown", "none")
    other = stage.copy({stage.missingToken: "nothing"})
    assert stage.value("missingToken") == "none" and other.value("missingToken") == "nothing" and "missingToken" in stage.explainParams()
    got = other.transform(rows).where("id = 1").first()["shown"]
    assert got == "nothing"
    with_none = S.JoinText(missing_token=None).transform(rows).where("id = 1").first()["text"]
    assert with_none == rows.where("id = 1").select(text.join_text("title", "article", 2, None)).first()[0]


def test_empty_tables(rows):
    none = rows.where(F.lit(False))
    assert _pipeline().fit(rows).transform(none).count() == 0
