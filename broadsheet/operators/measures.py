"""What several profiles read of a row's texts, as columns beside them: a report works them out once per row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions import text as X

TEXTS = ("title", "article")
# Begins the names of the columns that ``with_measures`` adds.
MARK = "_measure_"


def with_measures(df: DataFrame) -> DataFrame:
    """Lengths and pattern flags of the title and the article, and both content hashes."""
    found = {"raw_hash": X.content_hash(), "near_hash": X.content_hash(near_dup=True)}
    for c in TEXTS:
        found |= {f"{c}_chars": X.char_count(c), f"{c}_words": X.word_count(c)}
        found |= {f"{c}_{name}": flag for name, flag in X.pattern_flags(c).items()}
    return df.select("*", *[value.alias(MARK + name) for name, value in found.items()])


def without_measures(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in df.columns if not c.startswith(MARK)])


def _measure(df: DataFrame, name: str, value: Column) -> Column:
    return F.col(MARK + name) if MARK + name in df.columns else value


def char_count(df: DataFrame, c: str) -> Column:
    return _measure(df, f"{c}_chars", X.char_count(c))


def word_count(df: DataFrame, c: str) -> Column:
    return _measure(df, f"{c}_words", X.word_count(c))


def pattern_flags(df: DataFrame, c: str) -> dict[str, Column]:
    return {name: _measure(df, f"{c}_{name}", flag) for name, flag in X.pattern_flags(c).items()}


def content_hash(df: DataFrame, near_dup: bool = False) -> Column:
    return _measure(df, "near_hash" if near_dup else "raw_hash", X.content_hash(near_dup=near_dup))
