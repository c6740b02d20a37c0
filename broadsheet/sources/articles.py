"""Reading article and prediction tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from broadsheet.sources.quoted import read_quoted

# Column names, and the CSV texts that mean "no value".
DEV_COLUMNS = ("id", "source", "title", "article", "page_rank", "timestamp", "label")
EVAL_COLUMNS = ("id", "source", "title", "article", "page_rank", "timestamp")
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)
LABEL_NAMES = ("label", "true", "y_true", "gold")
PRED_NAMES = ("pred", "y_pred", "prediction")
SCORE_PREFIXES = ("score_", "prob_", "logit_")


def standardize_columns(df: DataFrame) -> DataFrame:
    """Strip header names; ``Id``, else ``ID``, becomes ``id`` unless ``id`` exists. Names are compared exactly."""
    names = [c.strip() for c in df.columns]
    for variant in ("Id", "ID"):
        if "id" not in names and variant in names:
            names = ["id" if c == variant else c for c in names]
    return df.toDF(*names)


def na_tokens_to_null(df: DataFrame) -> DataFrame:
    """CSV missing-value texts become null in every text column."""
    return df.select(*[
        F.when(~F.col(f.name).isin(*NA_TOKENS), F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ])


def require_columns(df: DataFrame, required: tuple[str, ...], name: str) -> DataFrame:
    missing = sorted(set(required) - set(df.columns))
    if missing:
        raise ValueError(f"{name} misses columns {missing}; found {df.columns}")
    return df


def whole_number(c: str, kind: str = "bigint") -> Column:
    """Text as an integer: exact digits first, else a decimal notation cut off; null if it is no number or out of range."""
    return F.coalesce(F.col(c).try_cast(kind), F.col(c).try_cast("double").try_cast(kind))


def typed(df: DataFrame) -> DataFrame:
    """Ids and labels as integers and page ranks as numbers where they are text; what is no number becomes null."""
    texts = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
    kinds = {"id": whole_number("id"), "label": whole_number("label", "int"), "page_rank": F.col("page_rank").try_cast("double")}
    return df.withColumns({c: value for c, value in kinds.items() if c in texts})


def _read(spark: SparkSession, path: str, fmt: str, multi_line: bool, range_bytes: int | None = None) -> DataFrame:
    if fmt == "csv" and range_bytes:
        return read_quoted(spark, path, range_bytes)
    if fmt == "csv":
        # every column is read as text: no inference pass over the data
        return spark.read.csv(path, header=True, multiLine=multi_line, quote='"', escape='"', encoding="UTF-8")
    return spark.read.format(fmt).load(path)


def _articles(df: DataFrame, required: tuple[str, ...], name: str) -> DataFrame:
    return typed(na_tokens_to_null(require_columns(standardize_columns(df), required, name)))


def read_development(
    spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = True, range_bytes: int | None = None
) -> DataFrame:
    """Labelled articles. ``multi_line`` is needed if texts hold line breaks; Spark does not split such files. With
    ``range_bytes``, ``quoted.read_quoted`` reads them by ranges of that size, many tasks to a file."""
    return _articles(_read(spark, path, fmt, multi_line, range_bytes), DEV_COLUMNS, "development table")


def read_evaluation(
    spark: SparkSession, path: str, fmt: str = "csv", multi_line: bool = True, range_bytes: int | None = None
) -> DataFrame:
    return _articles(_read(spark, path, fmt, multi_line, range_bytes), EVAL_COLUMNS, "evaluation table")


def enforce_schema(df: DataFrame, expected: tuple[str, ...], name: str) -> DataFrame:
    """Strict: the same columns in the same order."""
    if list(df.columns) == list(expected):
        return df
    parts = [f"{name}: columns do not match.", f"current: {df.columns}", f"expected: {list(expected)}"]
    missing = [c for c in expected if c not in df.columns]
    extra = [c for c in df.columns if c not in expected]
    parts += [f"missing: {missing}"] if missing else []
    parts += [f"extra: {extra}"] if extra else []
    raise ValueError("\n".join(parts))


def schema_report(df: DataFrame, expected: tuple[str, ...]) -> DataFrame:
    """Per column: ok, moved, missing or extra, and its non-null values."""
    rows = []
    for i, c in enumerate(expected):
        status = "missing" if c not in df.columns else "ok" if df.columns.index(c) == i else "moved"
        rows.append((c, status))
    rows += [(c, "extra") for c in df.columns if c not in expected]
    return df.agg(F.array(*[
        F.struct(
            F.lit(c).alias("column"), F.lit(s).alias("status"),
            (F.count(c) if c in df.columns else F.lit(0).cast("bigint")).alias("values"),
        ) for c, s in rows
    ]).alias("r")).select(F.inline("r"))


def _first(columns: list[str], names: tuple[str, ...]) -> str | None:
    return next((n for n in names if n in columns), None)


def score_columns(columns: list[str], prefix: str | None = None) -> dict[str, str]:
    """class -> column, for the first prefix that occurs."""
    for p in (prefix,) if prefix else SCORE_PREFIXES:
        found = {c[len(p):]: c for c in columns if c.startswith(p)}
        if found:
            return found
    return {}


def resolve_predictions(df: DataFrame) -> DataFrame:
    """Rename the label and prediction columns to ``label`` and ``pred``."""
    label, pred = _first(df.columns, LABEL_NAMES), _first(df.columns, PRED_NAMES)
    if label is None or pred is None:
        raise ValueError(f"a label and a prediction column are needed; found {df.columns}")
    return df.withColumnsRenamed({label: "label", pred: "pred"})


def score_rows(df: DataFrame, prefix: str | None = None) -> DataFrame:
    """One row per (row, class) instead of one score column per class."""
    df = resolve_predictions(df)
    scores = score_columns(df.columns, prefix)
    keep = [c for c in df.columns if c not in scores.values()]
    if not scores:
        return df.select(*keep, F.lit(None).cast("string").alias("class"), F.lit(None).cast("double").alias("score")).limit(0)
    cells = [
        F.struct(F.lit(k).alias("class"), F.col(c).cast("string").try_cast("double").alias("score"))
        for k, c in scores.items()
    ]
    return df.select(*keep, F.inline(F.array(*cells)))


def read_predictions(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """Out-of-fold predictions with ``label`` and ``pred``; score columns stay wide (see ``score_rows``)."""
    return resolve_predictions(na_tokens_to_null(_read(spark, path, fmt, multi_line=False)))
