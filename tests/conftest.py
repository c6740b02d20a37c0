import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

from broadsheet.session import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return session(cores="4", memory="6g", **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def articles(spark):
    """Builds a small article table; missing fields are filled with plain values."""
    def build(*rows):
        full = []
        for i, r in enumerate(rows):
            base = {"id": i, "source": "s", "title": "t", "article": "a", "page_rank": "1", "timestamp": "2005-01-01", "label": 0}
            base.update(r)
            full.append(tuple(base[c] for c in ("id", "source", "title", "article", "page_rank", "timestamp", "label")))
        return spark.createDataFrame(
            full, "id bigint, source string, title string, article string, page_rank string, timestamp string, label int")

    return build
