"""Article tables derived from the given ``documents`` and ``labels`` tables.

The SQL text below runs unchanged in Spark and in DuckDB, so the same derivation feeds a query and its oracle.
Every document is used with its whole text: the title is the first line, the article is the rest. The CASE
expressions only decorate values (placeholders, tags, links, broken timestamps) so that every rule has something to do.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

BASE_SQL = """
SELECT d.doc_id AS id,
 CASE WHEN d.doc_id % 29 = 0 THEN NULL WHEN d.doc_id % 31 = 0 THEN chr(92) || 'N'
      WHEN d.doc_id % 43 = 0 THEN '  ' ELSE d.source END AS source,
 CASE WHEN d.doc_id % 47 = 0 THEN NULL ELSE
   CASE WHEN d.doc_id % 17 = 0 THEN 'Advertisement: ' WHEN d.doc_id % 53 = 0 THEN ' sponsored content - ' ELSE '' END
   || split_part(d.text, chr(10), 1)
   || CASE WHEN d.doc_id % 19 = 0 THEN ' &amp; <b>live</b>' ELSE '' END END AS title,
 CASE WHEN d.doc_id % 23 = 0 THEN chr(92) || 'N'
      ELSE substr(d.text, length(split_part(d.text, chr(10), 1)) + 2)
        || CASE WHEN d.doc_id % 13 = 0 THEN ' see https://example.com/' || CAST(d.doc_id AS STRING) ELSE '' END END AS article,
 CAST(2 + CAST(substr(d.source, 4) AS INT) % 4 + CASE WHEN d.doc_id % 41 = 0 THEN 1 ELSE 0 END AS INT) AS page_rank,
 CASE WHEN d.doc_id % 7 = 0 THEN '0000-00-00 00:00:00' WHEN d.doc_id % 37 = 0 THEN NULL
      WHEN d.doc_id % 59 = 0 THEN 'N/A' WHEN d.doc_id % 61 = 0 THEN 'soon'
      ELSE CAST(2004 + d.doc_id % 5 AS STRING) || '-' || lpad(CAST(1 + d.doc_id % 12 AS STRING), 2, '0') || '-'
        || lpad(CAST(1 + d.doc_id % 28 AS STRING), 2, '0') || ' ' || lpad(CAST(d.doc_id % 24 AS STRING), 2, '0') || ':'
        || lpad(CAST(d.doc_id % 60 AS STRING), 2, '0') || ':00' END AS timestamp
FROM documents d
"""

# Labelled documents. Natural copies of one text receive different labels now and then.
DEV_SQL = f"""
WITH n AS ({BASE_SQL})
SELECT n.*, CAST((l.quality + 2 * l.toxic + CASE WHEN n.id % 3 = 0 THEN 1 ELSE 0 END) % 4 AS INT) AS label
FROM n JOIN labels l ON n.id = l.doc_id
"""

# Unlabelled documents, some retyped so that they equal a labelled one only after canonicalisation.
EVAL_SQL = f"""
WITH n AS ({BASE_SQL})
SELECT n.id, CASE WHEN n.id % 67 = 0 THEN 'wire' || CAST(n.id % 5 AS STRING) ELSE n.source END AS source,
 CASE WHEN n.id % 3 = 1 THEN '<i>' || replace(n.title, 'e', 'E') || '</i>  ' ELSE n.title END AS title,
 n.article, n.page_rank, n.timestamp
FROM n LEFT JOIN labels l ON n.id = l.doc_id WHERE l.doc_id IS NULL
"""

PREDS_SQL = """
SELECT l.doc_id AS id, CAST(l.doc_id % 5 AS INT) AS fold, CAST(l.quality + 2 * l.toxic AS INT) AS label,
 CAST(CASE WHEN l.doc_id % 6 = 0 THEN (l.quality + 2 * l.toxic + 1) % 4 ELSE l.quality + 2 * l.toxic END AS INT) AS pred,
 CASE WHEN l.doc_id % 71 = 0 THEN NULL ELSE CAST(((l.doc_id * 53) % 97) AS DOUBLE) / CAST(97 AS DOUBLE)
   + CASE WHEN l.quality = 0 THEN CAST(0.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END END AS score_0,
 CAST(((l.doc_id * 37) % 101) AS DOUBLE) / CAST(101 AS DOUBLE)
   + CASE WHEN l.quality = 1 THEN CAST(0.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS score_1
FROM labels l
"""


def register(spark: SparkSession, sf_dir: str, tables: tuple[str, ...] = ("documents", "labels")) -> None:
    for name in tables:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def news_dev(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir)
    return spark.sql(DEV_SQL)


def news_eval(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir)
    return spark.sql(EVAL_SQL)


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    register(spark, sf_dir)
    return spark.sql(PREDS_SQL)
