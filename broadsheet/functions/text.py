"""Text rules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The blanks that Python's str.isspace() knows, as a regex class body.
BLANKS = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# Patterns of the rules below.
TAG = r"<[^>]+>"
URL = rf"(?iu)(?:https?://[^{BLANKS}]+|www\.[^{BLANKS}]+)"
URL_START = rf"(?iu)(?:https?://|www\.)[^{BLANKS}]"
URL_HINT = r"https?://|www\."
ENTITY = r"(?iu)&(?:nbsp|amp|lt|gt|quot|#\d+);"
NAMED_ENTITY = r"&[a-zA-Z]+;"
AD_PREFIX = (
    rf"(?iu)^[{BLANKS}]*(?:adv[{BLANKS}]*[:\-]|advertisement[{BLANKS}]*[:\-]?"
    rf"|sponsored[{BLANKS}]*(?:content)?[{BLANKS}]*[:\-]?)"
)
MARKER = "\\N"
MISSING_ARTICLE = "__MISSING_ARTICLE__"

# The 14 metadata features, in their vector order.
PATTERN_FEATURES = (
    "title_chars", "article_chars", "title_words", "article_words",
    "title_adv", "article_adv", "any_adv", "title_url", "article_url", "any_url",
    "title_html", "article_html", "any_html", "any_non_ascii",
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), rf"^[{BLANKS}]+|[{BLANKS}]+\z", "")


def squeeze(c: Column | str) -> Column:
    """Runs of blanks become one space, none at the ends."""
    return F.trim(F.regexp_replace(_col(c), rf"[{BLANKS}]+", " "))


def is_blank(c: Column | str) -> Column:
    return F.coalesce(_col(c).rlike(rf"^[{BLANKS}]*+\z"), F.lit(True))


def is_any_of(c: Column | str, values: tuple[str, ...]) -> Column:
    """True where the stripped text equals one of ``values``; the anchored pattern reads no further than it must."""
    body = "|".join(rf"\Q{v}\E" for v in values)
    return F.coalesce(_col(c).rlike(rf"^[{BLANKS}]*+(?:{body})[{BLANKS}]*+\z"), F.lit(False))


def missing_like(c: Column | str, placeholders: tuple[str, ...] = (MARKER,)) -> Column:
    """Null, blank, or a placeholder once stripped."""
    return is_blank(c) | is_any_of(c, placeholders)


def missing_indicator(c: Column | str, placeholders: tuple[str, ...] = (MARKER,)) -> Column:
    return missing_like(c, placeholders).cast("double")


def char_count(c: Column | str) -> Column:
    return F.length(F.coalesce(_col(c), F.lit("")))


def word_count(c: Column | str) -> Column:
    return F.regexp_count(F.coalesce(_col(c), F.lit("")), F.lit(rf"[^{BLANKS}]+"))


def has_non_ascii(c: Column | str) -> Column:
    c = _col(c)
    return F.octet_length(c) > F.length(c)


def pattern_flags(c: Column | str) -> dict[str, Column]:
    """Profiling flags; the link test is case-sensitive and wider than the one used for features."""
    s = F.coalesce(_col(c), F.lit(""))
    return {
        "contains_html_tag": s.rlike(TAG),
        "contains_url": s.rlike(URL_HINT),
        "contains_amp_entity": s.rlike(NAMED_ENTITY),
        "contains_non_ascii": has_non_ascii(s),
    }


def strip_ad_prefix(c: Column | str) -> Column:
    return F.regexp_replace(F.coalesce(_col(c), F.lit("")), AD_PREFIX, "")


def join_text(
    title: Column | str, article: Column | str, title_repeat: int = 2, missing_token: str | None = MISSING_ARTICLE
) -> Column:
    """The title ``title_repeat`` times, then the article, then a token where the article is missing."""
    title = F.coalesce(_col(title), F.lit(""))
    article = F.coalesce(_col(article), F.lit(""))
    gone = missing_like(article)
    tail = F.lit(f" {missing_token} " if missing_token else "")
    head = F.repeat(F.concat(title, F.lit(" ")), F.lit(title_repeat))
    return F.concat(head, F.when(gone, tail).otherwise(article))


def text_column(c: Column | str, missing_token: str | None = None) -> Column:
    s = F.coalesce(_col(c), F.lit(""))
    return F.when(missing_like(s), F.lit(missing_token)).otherwise(s) if missing_token else s


def text_pattern_features(title: Column | str = "title", article: Column | str = "article") -> list[Column]:
    """The 14 metadata features as doubles."""
    found = {}
    for name, c in (("title", title), ("article", article)):
        s = F.coalesce(_col(c), F.lit(""))
        s = F.when(is_any_of(s, (MARKER,)), F.lit("")).otherwise(s)
        found[f"{name}_chars"] = F.length(s)
        found[f"{name}_words"] = F.regexp_count(s, F.lit(rf"[^{BLANKS}]+"))
        found[f"{name}_adv"] = s.rlike(AD_PREFIX)
        found[f"{name}_url"] = s.rlike(URL_START)
        found[f"{name}_html"] = s.rlike(TAG) | s.rlike(ENTITY)
        found[f"{name}_non_ascii"] = has_non_ascii(s)
    for kind in ("adv", "url", "html", "non_ascii"):
        found[f"any_{kind}"] = found[f"title_{kind}"] | found[f"article_{kind}"]
    return [found[name].cast("double").alias(name) for name in PATTERN_FEATURES]


def normalize_near_dup(c: Column | str) -> Column:
    """Lower case, squeezed, then punctuation deleted (blanks around it stay)."""
    s = squeeze(F.lower(F.coalesce(_col(c), F.lit(""))))
    return F.regexp_replace(s, rf"[^\p{{L}}\p{{N}}_{BLANKS}]", "")


def content_hash(title: Column | str = "title", article: Column | str = "article", near_dup: bool = False) -> Column:
    prepare = normalize_near_dup if near_dup else (lambda c: F.coalesce(_col(c), F.lit("")))
    return F.md5(F.concat(prepare(title), F.lit("\n"), prepare(article)))


def text_hash(c: Column | str) -> Column:
    return F.md5(F.coalesce(_col(c), F.lit("")))


def shorten(c: Column | str, max_len: int = 160) -> Column:
    s = squeeze(F.coalesce(_col(c), F.lit("")))
    return F.when(F.length(s) <= max_len, s).otherwise(F.concat(F.substring(s, 1, max_len - 3), F.lit("...")))


def numeric_coerce(c: Column | str) -> Column:
    """Number or null; text that is not a number is null."""
    return F.nanvl(_col(c).try_cast("double"), F.lit(None).cast("double"))


def numeric_or_zero(c: Column | str) -> Column:
    return F.coalesce(numeric_coerce(c), F.lit(0.0))
