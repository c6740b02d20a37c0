"""A corpus from documents, in five stages, each written and read again before the next."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import jaccard, langid
from broadsheet.llm.common import packed, stored, unpacked
from broadsheet.llm.lines import dedup_lines
from broadsheet.llm.merges import encode_documents
from broadsheet.llm.mixing import mixed_documents


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that rows with a language teach."""
    return langid.keep_identified(docs, langid.learn(docs))


def without_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without their repeated lines, and their length counted anew; a null text becomes an empty one."""
    kept = F.col("kept_text")
    new = {"text": kept, "n_chars": F.length(kept).cast(docs.schema["n_chars"].dataType)}
    return dedup_lines(packed(docs, "doc_id", "text")).select(*unpacked(docs.columns, ("doc_id", "text"), **new))


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five words a shingle, similarity of 0.8."""
    return jaccard.keep_one(docs, jaccard.jaccard_groups(docs, jaccard.JaccardParams(words=5, percent=80)))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, ids, n_pieces) of every row of the mix."""
    return encode_documents(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("language identification", identified),
    ("line dedup", without_repeated_lines),
    ("n-gram jaccard join", one_of_each_group),
    ("mixing sources", mixed),
    ("pieces", encoded),
]

# language identification and merge-dropout are beyond SQL; the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
