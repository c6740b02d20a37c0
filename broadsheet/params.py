"""Parameters of the jobs. The default numbers are fixed values: results are compared with those of the same settings."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class Ngrams:
    """Terms of one text: ``analyzer`` is ``word`` (runs of letters and digits), ``char`` (characters across words) or
    ``char_wb`` (characters inside padded words); ``low`` to ``high`` of them make a term. ``limit`` terms are kept."""

    analyzer: str
    low: int
    high: int
    min_df: int
    limit: int

    def __post_init__(self):
        if self.analyzer not in ("word", "char", "char_wb"):
            raise ValueError(f"unknown analyzer: {self.analyzer}")
        if not 1 <= self.low <= self.high:
            raise ValueError(f"n-grams of {self.low} to {self.high}")


WORDS = Ngrams("word", 1, 2, min_df=5, limit=100_000)
CHARS = Ngrams("char_wb", 3, 5, min_df=3, limit=25_000)
TITLE = Ngrams("char_wb", 2, 4, min_df=4, limit=20_000)


@dataclass(frozen=True)
class TextParams:
    """``words`` and ``chars`` are taken from the joined text, ``title`` from the title; None leaves a block out.
    ``accents`` is ``unicode`` (drop the marks), ``ascii`` (drop whatever is not ASCII after that) or None."""

    words: Ngrams = WORDS
    chars: Ngrams | None = CHARS
    title: Ngrams | None = None
    title_repeat: int = 2
    missing_article_token: str | None = "__MISSING_ARTICLE__"
    max_df: float = 0.95
    sublinear_tf: bool = True
    lowercase: bool = True
    accents: str | None = "unicode"
    stop_words: tuple[str, ...] | None = None

    def __post_init__(self):
        if isinstance(self.stop_words, str):
            raise ValueError("stop words are a list of words; lists have no names here")
        if self.accents not in (None, "unicode", "ascii"):
            raise ValueError(f"unknown way to treat accents: {self.accents}")

    @classmethod
    def from_dict(cls, values: dict) -> "TextParams":
        blocks = {k: Ngrams(**v) if isinstance(v, dict) else v for k, v in values.items()}
        return cls(**{k: tuple(v) if isinstance(v, list) else v for k, v in blocks.items()})


@dataclass(frozen=True)
class SourceParams:
    """Sources with at least ``min_count`` rows and ``min_frac`` of them are features; ``limit`` bounds how many, the most
    frequent first (None: all). A model has a weight for each, so their list is on the driver like the vocabulary."""

    min_count: int | None = 3
    min_frac: float | None = None
    limit: int | None = 100_000


@dataclass(frozen=True)
class ModelParams:
    type: str = "linearsvc"  # linearsvc, logreg or ridge
    C: float = 8.0
    class_weight: str | dict[int, float] | None = "balanced"
    class_weight_power: float = 0.7
    ridge_alpha: float = 1.0
    tol: float = 1e-4
    max_iter: int = 10_000


@dataclass(frozen=True)
class JobParams:
    """``cache``: a shared folder in which fitted features are kept and found again; None fits anew each time."""

    text: TextParams = field(default_factory=TextParams)
    source: SourceParams = field(default_factory=SourceParams)
    model: ModelParams = field(default_factory=ModelParams)
    k: int = 5
    seed: int = 42
    clean: bool = True
    drop_overlap: bool = False
    drop_same_label: bool = False
    cache: str | None = None


# The plain jobs: no cleaning, and the library defaults for everything that is not a main text or model parameter.
PLAIN = JobParams(source=SourceParams(min_count=5), model=ModelParams(class_weight_power=1.0), clean=False)
