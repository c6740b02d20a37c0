import pytest


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text, lang, source) tuples; shorter ones are filled up, and the other columns clash with
    names that operators use inside."""
    def build(*rows):
        full = []
        for r in rows:
            doc_id, text, lang, source = (*r, *(None, "en", "s")[len(r) - 1:])
            full.append((doc_id, text, lang, source, None if text is None else len(text), "size", 7, "l", 1, 2, 3, "v", "d", "k"))
        return spark.createDataFrame(
            full, "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, node int, "
            "n_lines string, part int, whole int, n_dropped int, _v string, _drops string, kept_text string")

    return build
