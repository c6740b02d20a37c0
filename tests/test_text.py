"""Golden values of the text, missing-value and timestamp rules."""

import html
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from broadsheet.functions import canonical, text as X, times
from broadsheet.operators import drift


def values(spark, inputs, *cols):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, c string")
    out = [tuple(r)[1:] for r in df.select("i", *cols).orderBy("i").collect()]
    return [r[0] for r in out] if len(cols) == 1 else out


def test_canonical_text(spark):
    given_ = ["&lt;b&gt;Café&lt;/b&gt;  X", " \\N ", "see HTTP://A.b/c now", None, "a\x1cb", "www.x.y\tEnd", "Ça &amp; là", "ﬁne ①"]
    want = ["cafe x", "", "see __url__ now", "", "a b", "__url__ end", "ca & la", "fine 1"]
    assert values(spark, given_, canonical.canonical_text("c")) == want


def test_canonical_text_keeps_case_and_accents_if_asked(spark):
    col = canonical.canonical_text("c", lowercase=False, strip_accents=False, url_token=" LINK$1 ")
    assert values(spark, ["É http://a B", "E http://a B"], col) == ["É LINK$1 B", "E LINK$1 B"]


def test_clean_text(spark):
    given_ = ["a\x00b <i>C</i>", "é\u200bx&nbsp;y", None, "\\N", "x\u00a0\u3000y"]
    assert values(spark, given_, canonical.clean_text("c")) == ["a b C", "é x y", "", "\\N", "x y"]


def _python_canonical(s):
    s = "" if s.strip() == "\\N" else s
    s = re.sub(r"<[^>]+>", " ", html.unescape(s))
    s = re.sub(r"(?i)https?://\S+|www\.\S+", " __URL__ ", s)
    s = "".join(c for c in unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", s)) if not unicodedata.combining(c))
    return re.sub(r"\s+", " ", s).strip().lower()


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="aB <>&;/:.wéÀ\t\n\x1c\x85\u2003hHttTpPs&lamp\\N", max_size=30), min_size=20, max_size=60))
def test_both_paths_of_canonical_text_agree_with_python(spark, texts):
    texts = [*texts, "http://x", "<a>www.b", " \\N\x1d"]
    assert values(spark, texts, canonical.canonical_text("c")) == [_python_canonical(t) for t in texts]


def test_strip_ad_prefix(spark):
    given_ = ["Advertisements up", "ADV - x", "adv x", " sponsored content: y", None, "Sponsored z"]
    assert values(spark, given_, X.strip_ad_prefix("c")) == ["s up", " x", "adv x", " y", "", "z"]


def test_join_text(spark):
    df = spark.createDataFrame([("T", "\\N"), (None, "b"), ("\\N", " "), ("T", "x")], "t string, a string")
    got = [r[0] for r in df.select(X.join_text("t", "a", 2)).collect()]
    assert got == ["T T  __MISSING_ARTICLE__ ", "  b", "\\N \\N  __MISSING_ARTICLE__ ", "T T x"]
    assert [r[0] for r in df.select(X.join_text("t", "a", 1, None)).collect()] == ["T ", " b", "\\N ", "T x"]


def test_missing_rules(spark):
    given_ = [None, "", " \t", "\\N", " \\N\n", "x", "\u3000", "\\N x"]
    assert values(spark, given_, X.missing_like("c")) == [True] * 5 + [False, True, False]
    assert values(spark, ["0000-00-00 ", "x.y", "x"], X.missing_indicator("c", ("0000-00-00", "x.y"))) == [1.0, 1.0, 0.0]


def test_normalize_near_dup(spark):
    assert values(spark, ["A - b", " É!  x_1 ", None], X.normalize_near_dup("c")) == ["a  b", "é x_1", ""]


def test_words_shorten_and_flags(spark):
    assert values(spark, ["", " a  b\n c", "x\u2003y", None], X.word_count("c")) == [0, 3, 2, 0]
    assert values(spark, ["  a  b ", "x" * 12], X.shorten("c", 10)) == ["a b", "x" * 7 + "..."]
    flags = X.pattern_flags("c")
    assert values(spark, ["HTTP://x", "http://", "&x1;", "&Amp;", "é"], flags["contains_url"]) == [False, True, False, False, False]
    assert values(spark, ["&x1;", "&Amp;"], flags["contains_amp_entity"]) == [False, True]


def test_feature_patterns_differ_from_profile_patterns(spark):
    df = spark.createDataFrame([("HTTP://x", "&#12; \\N"), ("http://", " \\N "), ("Adv: é", None)], "title string, article string")
    rows = [r.asDict() for r in df.select(*X.text_pattern_features()).collect()]
    assert [r["title_url"] for r in rows] == [1.0, 0.0, 0.0]
    assert [r["article_html"] for r in rows] == [1.0, 0.0, 0.0]
    assert [r["article_chars"] for r in rows] == [8.0, 0.0, 0.0]
    assert rows[2]["title_adv"] == rows[2]["any_adv"] == rows[2]["any_non_ascii"] == 1.0
    assert list(rows[0]) == list(X.PATTERN_FEATURES) and len(rows[0]) == 14


def test_numeric_coerce(spark):
    assert values(spark, [" 2.5 ", "x", None, "NaN", "1e3"], X.numeric_or_zero("c")) == [2.5, 0.0, 0.0, 0.0, 1000.0]


def test_timestamps(spark):
    given_ = ["0000-00-00", "N/A", "x", " 2008-02-03 04:05:06 ", "12:00", None, "2008-13-01"]
    got = values(spark, given_, times.parse_timestamp("c").cast("string"))
    assert got == [None, None, None, "2008-02-03 04:05:06", None, None, None]
    eda = values(spark, ["0000-00-00 00:00:00", "2008-02-03"], times.eda_timestamp("c").cast("string"))
    assert eda == [None, "2008-02-03 00:00:00"]


def test_word_length_bins(spark):
    df = spark.createDataFrame([(n,) for n in (0, 4, 5, 319, 320, 10000, 10001)], "n int")
    assert [r[0] for r in df.select(drift.word_len_bin(F.col("n"))).collect()] == [0, 0, 1, 6, 7, 7, None]


@pytest.mark.parametrize("n_min,n_max", [(2, 4), (3, 5), (5, 6)])
def test_char_wb_ngrams_against_brute_force(spark, n_min, n_max):
    from broadsheet.operators.terms import char_wb_ngrams

    def brute(s):
        out = []
        for w in s.split():
            w = f" {w} "
            if len(w) < n_min:
                out.append(w)
            out += [w[i:i + n] for n in range(n_min, n_max + 1) for i in range(len(w) - n + 1)]
        return sorted(out)

    texts = ["a bb ccc dddd", "", "  é𝒳x-y  z ", "one\ttwo"]
    got = values(spark, texts, char_wb_ngrams("c", n_min, n_max))
    assert [sorted(g) for g in got] == [brute(t) for t in texts]


def test_word_ngrams(spark):
    from broadsheet.operators.terms import word_ngrams

    got = values(spark, ["a bc de_f éé 1x", "", "ab"], word_ngrams("c", 1, 2))
    assert got[0] == ["bc", "de_f", "éé", "1x", "bc de_f", "de_f éé", "éé 1x"] and got[1] == [] and got[2] == ["ab"]
    assert values(spark, ["ab cd ef"], word_ngrams("c", 1, 3, ("cd",))) == [["ab", "ef", "ab ef"]]


def test_profiles_read_measures_instead_of_texts(spark, articles, tmp_path):
    """The report's profiles read lengths, flags and hashes that are worked out once, and give the same tables."""
    from broadsheet.operators import dedup, drift, profile
    from broadsheet.operators.measures import with_measures, without_measures

    dev = articles(
        {"title": "Two words", "article": "see <b>this</b> http://x.org &amp; more"}, {"title": None, "article": "\\N"},
        {"title": "two  WORDS", "article": "See <b>this</b> http://x.org &amp; more!", "label": 1}, {"title": "é", "article": None, "label": None})
    stored = with_measures(dev)
    stored.write.parquet(str(tmp_path / "dev"))
    stored = spark.read.parquet(str(tmp_path / "dev"))
    assert without_measures(stored).columns == dev.columns
    tables = {
        "lengths": profile.text_length_summary, "label lengths": profile.label_text_lengths, "patterns": profile.pattern_prevalence,
        "label patterns": profile.label_pattern_prevalence, "words": drift.word_len_histogram, "gotchas": profile.gotchas,
        "near": lambda d: dedup.duplicate_groups(d, near_dup=True), "raw": dedup.duplicate_groups,
        "by label": lambda d: dedup.cross_label_dup_by_label(d, near_dup=True), "drift": lambda d: drift.js_divergence(d, d),
        "ends": profile.shortest_longest,
    }
    for name, fn in tables.items():
        found = fn(stored)
        assert sorted(map(str, found.collect())) == sorted(map(str, fn(dev).collect())), name
        plan = found._jdf.queryExecution().optimizedPlan().toString().lower()
        # examples are shortened and timestamps tested by patterns, which are no measures
        of_texts = ("regexp_extract_all",) if name in ("ends", "drift") else ("regexp_extract_all", "rlike", "md5")
        assert not any(x in plan for x in of_texts), name
