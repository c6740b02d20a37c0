"""The sparse design matrix: fitting all feature state outside each fold, and assembling (indices, values) rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from broadsheet.functions.times import PARTS
from broadsheet.operators import columns as C
from broadsheet.operators import terms as W
from broadsheet.params import JobParams, Ngrams, SourceParams, TextParams
from broadsheet.sources.sinks import stored

CHUNK_ROWS = 512
DESIGN = "id bigint, label int, fold int, model int, idx array<int>, val array<double>"


def prepare(df: DataFrame, p: TextParams, keep: tuple[str, ...] = ("id", "label", "fold")) -> DataFrame:
    """Cleaned text and unfitted columns per row. ``fold`` is -1 for rows that belong to no fold."""
    if "fold" not in df.columns:
        df = df.withColumn("fold", F.lit(-1))
    if "label" not in df.columns:
        df = df.withColumn("label", F.lit(None).cast("int"))
    cols = [*keep, W.document_text(p).alias("text"), C.source_value().alias("source_value"), *C.raw_columns()]
    if p.title:
        cols.append(W.title_text(p).alias("title_text"))
    return df.select(*cols)


def block_terms(p: TextParams) -> dict[str, tuple[str, Ngrams, tuple[str, ...] | None]]:
    """Per text block: the column it reads, its n-grams, and the stop words (which concern the words only)."""
    out = {"word": ("text", p.words, p.stop_words), "char": ("text", p.chars, None), "title": ("title_text", p.title, None)}
    return {name: block for name, block in out.items() if block[1]}


@dataclass
class SourceBlock:
    """Kept sources of all models in alphabetical order, and per model which of them it has."""

    values: list[str]
    kept: np.ndarray
    has_other: np.ndarray

    @property
    def categories(self) -> list[str]:
        return sorted({*self.values, C.OTHER})

    @classmethod
    def fit(cls, rows: DataFrame, p: SourceParams, models: list[int], n_docs: dict[int, int]) -> "SourceBlock":
        # a weight for each is on the driver anyway, so their list is bounded like the vocabulary
        table, others = C.kept_sources(rows, p, models, n_docs)
        found = sorted(table.collect(), key=lambda r: r["value"])
        values = [r["value"] for r in found]
        kept = np.array([[r[f"k{i}"] for r in found] for i in range(len(models))], dtype=bool).reshape(len(models), len(values))
        has_other = np.array(others, dtype=bool)
        return cls(values, kept, has_other)


@dataclass
class Features:
    """All fitted feature state; on the driver it is no larger than the coefficients of the linear model."""

    params: TextParams
    models: list[int]
    n_docs: dict[int, int]
    blocks: list[W.TermBlock]
    sources: SourceBlock
    fills: list[dict[str, int]]
    scales: list[list[float]]
    offsets: dict[str, int] = field(default_factory=dict)
    size: int = 0

    def __post_init__(self):
        at = 0
        for b in self.blocks:
            self.offsets[b.name] = at
            at += len(b.terms)
        for name, n in (("meta", len(C.X.PATTERN_FEATURES)), ("source", len(self.sources.categories)), ("rest", len(C.AFTER_SOURCE))):
            self.offsets[name] = at
            at += n
        self.size = at

    @property
    def dense(self) -> np.ndarray:
        """Positions of the dense features, in the order of ``columns.DENSE``."""
        meta, rest = len(C.X.PATTERN_FEATURES), len(C.AFTER_SOURCE)
        return np.concatenate([self.offsets["meta"] + np.arange(meta), self.offsets["rest"] + np.arange(rest)])

    def names(self) -> list[str]:
        out = [f"{b.name}:{t}" for b in self.blocks for t in b.terms]
        out += [*C.X.PATTERN_FEATURES, *[f"source:{s}" for s in self.sources.categories], *C.AFTER_SOURCE]
        return out


def fit_features(rows: DataFrame, p: JobParams, models: list[int]) -> Features:
    """``rows`` come from ``prepare``. Model m sees only rows outside fold m; model -1 sees all rows."""
    per_fold = {r["fold"]: r["n"] for r in rows.groupBy("fold").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(per_fold.values())
    n_docs = {m: total - (per_fold.get(m, 0) if m >= 0 else 0) for m in models}
    blocks = [
        W.TermBlock.fit(name, rows, column, grams, models, n_docs, p.text.max_df, stop)
        for name, (column, grams, stop) in block_terms(p.text).items()
    ]
    sources = SourceBlock.fit(rows, p.source, models, n_docs)
    narrow = rows.select("fold", *[c for c in rows.columns if c in C.DENSE or c.startswith("ts_")])
    seen = narrow.withColumn("model", F.explode(F.array(*[F.lit(m) for m in models]))).where(
        (F.col("model") < 0) | (F.col("model") != F.col("fold"))
    )
    fills = {r["model"]: {k: r[k] for k in PARTS} for r in C.fit_time_fill(seen, ["model"]).collect()}
    fill_map = {
        k: F.element_at(F.create_map(*[F.lit(v) for m in models for v in (m, fills[m][k])]), F.col("model")) for k in PARTS
    }
    scales = {r["model"]: [r[c] for c in C.DENSE] for r in C.fit_scales(seen, fill_map, ["model"]).collect()}
    return Features(p.text, models, n_docs, blocks, sources, [fills[m] for m in models], [scales[m] for m in models])


def _dense(f: Features) -> Column:
    """One array of scaled dense features per model, computed by built-in expressions."""
    return F.array(*[
        F.array(*[c / F.lit(s) for c, s in zip(C.dense_columns({k: F.lit(v) for k, v in fill.items()}), scale)])
        for fill, scale in zip(f.fills, f.scales)
    ])


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(flat values, row lengths) of a list column."""
    return column.flatten().to_numpy(zero_copy_only=False), np.diff(column.offsets.to_numpy())


def _tfidf(idx, tf, row, n_rows, weights, sublinear):
    """Weights of one block with unit length per row; terms the model does not have vanish."""
    v = _unit((1.0 + np.log(tf)) if sublinear else tf, idx, row, n_rows, weights)
    held = weights[idx] > 0
    return row[held], idx[held], v[held]


def _unit(tf, idx, row, n_rows, weights):
    """Weights of one block with unit length per row, 0 for terms the model does not have."""
    v = tf * weights.take(idx)
    norm = np.sqrt(np.bincount(row, weights=v * v, minlength=n_rows))
    norm[norm == 0.0] = 1.0
    return v / norm.take(row)


def _assembler(f: Features):
    blocks = [(b.name, f.offsets[b.name], b.weights) for b in f.blocks]
    categories = {s: i for i, s in enumerate(f.sources.categories)}
    source_at = np.array([categories[s] for s in f.sources.values], dtype=np.int64) if f.sources.values else None
    kept = f.sources.kept
    other, has_other = categories[C.OTHER], f.sources.has_other
    dense_at = f.dense
    models, sublinear, source_base = f.models, f.params.sublinear_tf, f.offsets["source"]

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for start in range(0, big.num_rows, CHUNK_ROWS):
                yield from one(big.slice(start, CHUNK_ROWS))

    def one(b: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n = b.num_rows
        every, texts, rows, cols = np.arange(n), [], [], []
        for name, base, weights in blocks:
            column = b.column(f"{name}_tf")
            idx, lengths = _lists(column.field("indices"))
            tf, _ = _lists(column.field("values"))
            row = np.repeat(every, lengths)
            texts.append(((1.0 + np.log(tf)) if sublinear else tf, idx, row, weights))
            rows.append(row), cols.append(idx + base)
        category = b.column("source_at").to_numpy()
        dense = b.column("dense").flatten().flatten().to_numpy(zero_copy_only=False).reshape(n, len(models), len(dense_at))
        # all models have their entries in the same places; each leaves out what is 0
        rows += [every, np.repeat(every, len(dense_at))]
        row = np.concatenate(rows)
        order = np.argsort(row.astype(np.int16), kind="stable")
        row = row[order]
        for i, m in enumerate(models):
            known = category >= 0
            if known.any():
                known[known] = kept[i][category[known]]
            column = source_base + np.where(known, source_at[np.maximum(category, 0)] if source_at is not None else 0, other)
            vals = [_unit(tf, idx, at, n, weights[i]) for tf, idx, at, weights in texts]
            val = np.concatenate([*vals, (known | has_other[i]).astype(float), dense[:, i, :].ravel()]).take(order)
            col = np.concatenate([*cols, column, np.tile(dense_at, n)]).astype(np.int32).take(order)
            held = val != 0.0
            ends = np.concatenate([[0], np.cumsum(np.bincount(row[held], minlength=n))]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(ends, pa.array(part[held])) for part in (col, val)]
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("label"), b.column("fold"), pa.array(np.full(n, m, dtype=np.int32)), *lists],
                names=["id", "label", "fold", "model", "idx", "val"],
            )

    return assemble


def tokenized(rows: DataFrame, f: Features) -> DataFrame:
    """Per row what ``term_counter`` and then ``assembler`` need: tokens of the texts, the source, dense features."""
    blocks = block_terms(f.params)
    none = F.array().cast("array<string>")
    return rows.select(
        F.col("id").cast("bigint"), F.col("label").cast("int"), F.col("fold").cast("int"),
        *[F.coalesce(W.tokens(*blocks[b.name]), none).alias(f"{b.name}_tokens") for b in f.blocks], "source_value", _dense(f).alias("dense"),
    )


def term_counter(f: Features):
    """Turns batches of ``tokenized`` into batches of ``counted``: terms are numbered in alphabetical order."""
    grams = block_terms(f.params)
    blocks = [(b.name, b.terms, grams[b.name][1]) for b in f.blocks]
    sources = f.sources.values

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [(name, W.lookup(terms, p)) for name, terms, p in blocks]
        known = pa.array(sources, pa.string())
        for big in batches:
            for b in (big.slice(a, CHUNK_ROWS) for a in range(0, big.num_rows, CHUNK_ROWS)):
                columns = {name: b.column(name) for name in ("id", "label", "fold")}
                for name, count in counts:
                    row, at, tf = count(b.column(f"{name}_tokens"))
                    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=b.num_rows))]).astype(np.int32)
                    lists = [pa.ListArray.from_arrays(ends, pa.array(v)) for v in (at.astype(np.int32), tf)]
                    columns[f"{name}_tf"] = pa.StructArray.from_arrays(lists, names=["indices", "values"])
                columns["source_at"] = pc.index_in(b.column("source_value"), value_set=known).fill_null(-1)
                yield pa.RecordBatch.from_arrays([*columns.values(), b.column("dense")], names=[*columns, "dense"])

    return run


def counted(rows: DataFrame, f: Features) -> DataFrame:
    """Per row the term counts, source and dense features that all models share, without a shuffle. This is what
    training caches: one row per article, however many folds."""
    blocks = "".join(f"{b.name}_tf struct<indices: array<int>, values: array<double>>, " for b in f.blocks)
    schema = f"id bigint, label int, fold int, {blocks}source_at int, dense array<array<double>>"
    return tokenized(rows, f).mapInArrow(term_counter(f), schema)


def assembler(f: Features):
    """Turns batches of ``counted`` into batches of the design matrix, a row per article and model."""
    return _assembler(f)


def token_assembler(f: Features):
    """Turns batches of ``tokenized`` into batches of the design matrix."""
    count, assemble = term_counter(f), _assembler(f)
    return lambda batches: assemble(count(batches))


def design(rows: DataFrame, f: Features) -> DataFrame:
    """(id, label, fold, model, idx, val): per row and model its sparse features, without a shuffle."""
    return tokenized(rows, f).mapInArrow(token_assembler(f), DESIGN)


def packed(df: DataFrame, assemble=lambda batches: batches) -> DataFrame:
    """Batches of ``df`` as ``assemble`` turns them, each one value of a row: cached rows that Spark need not convert value
    by value whenever a task reads them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small = (big.slice(a, CHUNK_ROWS) for big in batches for a in range(0, big.num_rows, CHUNK_ROWS))
        for b in assemble(small):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, b.schema) as out:
                out.write_batch(b)
            yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["batch"])

    return df.mapInArrow(run, "batch binary")


def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches that ``packed`` has packed."""
    for b in batches:
        for value in b.column("batch"):
            yield from pa.ipc.open_stream(value.as_buffer())


def term_weights(df: DataFrame, p: JobParams, block: str = "word") -> DataFrame:
    """(id, term, weight) of one text block fitted on the same table."""
    rows = stored(prepare(df, p.text), "prepared")
    f = fit_block_only(rows, p, block)
    b = f.blocks[0]
    out = design(rows, f).select("id", F.inline(F.arrays_zip("idx", "val"))).where(F.col("idx") < len(b.terms))
    names = df.sparkSession.createDataFrame(list(enumerate(b.terms)), "idx int, term string")
    return out.join(names, "idx").select("id", "term", F.col("val").alias("weight"))


def fit_block_only(rows: DataFrame, p: JobParams, block: str) -> Features:
    n = rows.count()
    column, grams, stop = block_terms(p.text)[block]
    fitted = W.TermBlock.fit(block, rows, column, grams, [-1], {-1: n}, p.text.max_df, stop)
    none = SourceBlock([], np.zeros((1, 0), dtype=bool), np.zeros(1, dtype=bool))
    return Features(p.text, [-1], {-1: n}, [fitted], none, [dict(PARTS)], [[1.0] * len(C.DENSE)])
