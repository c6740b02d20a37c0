"""Text normalisation that needs Python's HTML entity table and Unicode forms.

Plain ASCII text without ``&`` is handled by built-in expressions. Only the other rows carry their text to the Arrow
UDF; for plain rows the UDF receives a null, so nothing but a bitmap crosses to the Python worker.
"""

from __future__ import annotations

import html
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from broadsheet.functions import text as T

URL_TOKEN = " __URL__ "

_TAG = re.compile(T.TAG)
_URL = re.compile(r"https?://\S+|www\.\S+", re.IGNORECASE)
_BLANK_RUN = re.compile(r"\s+")


def _without_marks(s: str) -> str:
    if s.isascii():
        return s
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def _ascii_only(s: str) -> str:
    return s if s.isascii() else unicodedata.normalize("NFKD", s).encode("ascii", "ignore").decode()


# How accents are treated, by name.
ACCENTS = {None: str, "unicode": _without_marks, "ascii": _ascii_only}


def _squeeze(s: str) -> str:
    return _BLANK_RUN.sub(" ", s).strip()


def _visible(s: str) -> str:
    s = _squeeze(s)
    if s.isprintable():
        return s
    return _squeeze("".join(c if c.isprintable() or c.isspace() else " " for c in s))


def _normaliser(url_token: str, lowercase: bool, accents: str | None, drop_unprintable: bool, lower_first: bool):
    tail = [(accents is not None, ACCENTS[accents]), (lowercase, str.lower)]
    if lower_first:
        tail.reverse()
    middle = [_visible] if drop_unprintable else []
    steps = middle + [step for wanted, step in tail if wanted]

    def normalise(s: str) -> str:
        s = _URL.sub(lambda _: url_token, _TAG.sub(" ", html.unescape(s)))
        s = unicodedata.normalize("NFKC", s)
        for step in steps:
            s = step(s)
        return _squeeze(s)

    return normalise


def _java_replacement(s: str) -> str:
    return s.replace("\\", "\\\\").replace("$", "\\$")


def _normalise_column(
    base: Column, url_token: str, lowercase: bool, accents: str | None, drop_unprintable: bool, lower_first: bool
) -> Column:
    normalise = _normaliser(url_token, lowercase, accents, drop_unprintable, lower_first)

    @F.arrow_udf("string")
    def in_python(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else normalise(v) for v in values.to_pylist()], pa.string())

    plain = (F.octet_length(base) == F.length(base)) & (F.instr(base, "&") == 0)
    token = unicodedata.normalize("NFKC", url_token)
    token = ACCENTS[accents](token)
    out = F.regexp_replace(base, T.TAG, " ")
    out = F.regexp_replace(out, T.URL, _java_replacement(token))
    out = F.regexp_replace(out, r"[\x00-\x20\x7f]+" if drop_unprintable else r"[\t-\r\x1c-\x20]+", " ")
    out = F.trim(out)
    out = F.lower(out) if lowercase else out
    return F.when(plain, out).otherwise(in_python(F.when(plain, F.lit(None).cast("string")).otherwise(base)))


def canonical_text(
    c: Column | str,
    url_token: str = URL_TOKEN,
    lowercase: bool = True,
    strip_accents: bool = True,
    placeholders: tuple[str, ...] = (T.MARKER,),
) -> Column:
    """Comparable form of a text: two texts that differ only in markup, links, case, accents or blanks become equal."""
    s = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    base = F.when(T.is_any_of(s, placeholders), F.lit("")).otherwise(s)
    accents = "unicode" if strip_accents else None
    return _normalise_column(base, url_token, lowercase, accents, drop_unprintable=False, lower_first=False)


def clean_text(
    c: Column | str, url_token: str = URL_TOKEN, lowercase: bool = False, accents: str | None = None
) -> Column:
    """Text for feature extraction. ``lowercase`` and ``accents`` (see ``ACCENTS``) add what the term counting expects."""
    base = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    return _normalise_column(base, url_token, lowercase, accents, drop_unprintable=True, lower_first=True)
