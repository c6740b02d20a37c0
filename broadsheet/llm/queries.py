"""Registered queries of this folder and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from broadsheet.llm import brown, langid
from broadsheet.llm.codes import books_digest, vector_codes, with_label_error
from broadsheet.llm.common import documents, held_out
from broadsheet.llm.embed import near_vectors
from broadsheet.llm.exact import exact_duplicates
from broadsheet.llm.jaccard import jaccard_links
from broadsheet.llm.lines import dedup_lines
from broadsheet.llm.merges import encoded_digests
from broadsheet.llm.merkle import leaf, manifest
from broadsheet.llm.mixing import mix
from broadsheet.llm.nearest import nearest
from broadsheet.llm.records import token_records
from broadsheet.llm.toxicity import toxicity


def op1_brown(spark, sf_dir):
    docs = documents(spark, sf_dir).withColumn("flag", held_out(7))
    train = docs.where("not flag")
    model, counts = brown.fit(train)
    model = brown.refine(train, model, counts)
    return brown.score(docs, model, counts).select(
        "doc_id", F.col("flag").alias("held_out"), "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        "base_score", "score", "perplexity")


def op2_language(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = langid.learn(docs.where(~held_out(4)), check_docs=0)  # nothing is rejected here, so no limits are needed
    return langid.identify(docs, model).select("doc_id", held_out(4).alias("held_out"), "lang_pred", "score", "phrase_rate")


def op3_near_vectors(spark, sf_dir):
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op5_token_records(spark, sf_dir):
    return token_records(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.json")).drop("file")


def op6_toxicity(spark, sf_dir):
    return toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_merge_dropout(spark, sf_dir):
    return encoded_digests(documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model"))


def op9_jaccard_join(spark, sf_dir):
    return jaccard_links(documents(spark, sf_dir))


def op4_mixing(spark, sf_dir):
    return mix(documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op8_line_dedup(spark, sf_dir):
    out = dedup_lines(documents(spark, sf_dir))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op10_exact_dedup(spark, sf_dir):
    return exact_duplicates(documents(spark, sf_dir))


def op11_nearest(spark, sf_dir):
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


def op12_vector_codes(spark, sf_dir):
    codes, books = vector_codes(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    return with_label_error(codes).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def op13_merkle(spark, sf_dir):
    # the tampered copies: line breaks deleted in the rows with an even checksum
    tampered = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(2)) == 0
    without = leaf(text=F.replace(F.col("text"), F.lit("\n"), F.lit("")))
    claimed = F.when(tampered & F.col("text").contains("\n"), without).otherwise(leaf())
    return manifest(documents(spark, sf_dir), claimed).select(
        "doc_id", "leaf", "subroot", "root", F.sha2(F.col("proof").cast("binary"), 256).alias("proof_sha256"), "folded_root", "verified")


def queries():
    return {
        "op1_brown": op1_brown,
        "op2_language": op2_language,
        "op3_near_vectors": op3_near_vectors,
        "op4_mixing": op4_mixing,
        "op5_token_records": op5_token_records,
        "op6_toxicity": op6_toxicity,
        "op7_merge_dropout": op7_merge_dropout,
        "op8_line_dedup": op8_line_dedup,
        "op9_jaccard_join": op9_jaccard_join,
        "op10_exact_dedup": op10_exact_dedup,
        "op11_nearest": op11_nearest,
        "op12_vector_codes": op12_vector_codes,
        "op13_merkle": op13_merkle,
    }


BLANKS = r"[ \t\n\x0B\f\r]"

OP10 = rf"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '{BLANKS}+', '', 'g') AS norm FROM documents),
g AS (SELECT *, count(*) OVER (PARTITION BY norm) AS group_size,
  first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
  max(n) OVER (PARTITION BY norm) AS top FROM t)
SELECT doc_id, keep_id, group_size, (doc_id IS NOT DISTINCT FROM keep_id AND n = top) AS kept, sha256(norm) AS text_sha256 FROM g
"""

OP8 = rf"""
WITH lines AS (
  SELECT doc_id, i, list_extract(l, i) AS line,
    translate(regexp_replace(list_extract(l, i), '^{BLANKS}+|{BLANKS}+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents))),
rep AS (SELECT key, max(doc_id) AS keep FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT lines.*, rep.key IS NOT NULL AND doc_id != keep AS gone FROM lines LEFT JOIN rep ON lines.key = rep.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP4 = rf"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+')) AS size,
    CAST('0x' || substr(md5('17:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS BIGINT) AS key FROM documents),
src AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    CAST(list_extract([5, 2, 1], CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INT) + 1) AS DOUBLE) AS weight
  FROM sized GROUP BY source),
lim AS (SELECT *, 3.0::DOUBLE * source_size AS lim, row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source) AS k FROM src),
cut AS (
  SELECT a.k, (SELECT sum(source_size) FROM src) - coalesce((SELECT sum(b.lim) FROM lim b WHERE b.k < a.k), 0) AS free,
    (SELECT sum(b.weight) FROM lim b WHERE b.k >= a.k) AS w, a.lim / a.weight AS ratio FROM lim a),
lev AS (SELECT CAST(free AS DOUBLE) / w AS level FROM cut WHERE CAST(free AS DOUBLE) / w < ratio ORDER BY k LIMIT 1),
tgt AS (SELECT source, source_size, least(lim, weight * coalesce((SELECT level FROM lev), 0)) AS target FROM lim),
plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(round(target) AS BIGINT) // source_size ELSE 0 END AS whole FROM tgt),
run AS (
  SELECT s.doc_id, s.size, p.source_size, p.target, p.whole, CAST(round(p.target) AS BIGINT) - p.whole * p.source_size AS rest,
    coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key % 4096, s.key, s.doc_id, s.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior
  FROM sized s JOIN plan p ON s.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(size * whole + greatest(0, least(size, rest - prior)) AS BIGINT) AS taken FROM run
"""


def _field(value: str) -> str:
    return f"coalesce(strlen({value}) || ':' || {value}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)) + ")"


OP13 = f"""
WITH RECURSIVE
step(i, k, v) AS (
  SELECT range, 0, range FROM range(256)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM step WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS tab FROM step WHERE k = 8),
docs AS (
  SELECT d.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda x, y: xor(x >> 8, tab[1 + xor(x & 255, y)])), 4294967295) % 2 AS parity FROM documents d, tab),
ranked AS (
  SELECT *, row_number() OVER (ORDER BY doc_id) AS r, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
    count(*) OVER (PARTITION BY k) AS n
  FROM (SELECT doc_id, coalesce(':' || source, '-') AS k, {_leaf("text")} AS leaf,
    CASE WHEN parity = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS claim FROM docs)),
nodes(k, lvl, pos, n, h) AS (
  SELECT k, 0, pos, n, leaf FROM ranked
  UNION ALL SELECT k, lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM nodes WHERE n > 1 GROUP BY k, lvl, pos // 3, n),
subs AS (
  SELECT k, h, row_number() OVER (ORDER BY k) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops(lvl, pos, n, h) AS (
  SELECT 0, pos, n, h FROM subs
  UNION ALL SELECT lvl + 1, pos // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY pos)) FROM tops WHERE n > 1 GROUP BY lvl, pos // 3, n),
allnodes AS (
  SELECT k, lvl, pos, n, h FROM nodes UNION ALL SELECT NULL, lvl, pos, n, h FROM tops),
sides AS (
  SELECT k, lvl, pos, coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS b,
    coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS a
  FROM allnodes WHERE n > 1 WINDOW w AS (PARTITION BY k, lvl, pos // 3 ORDER BY pos)),
height AS (SELECT k, max(lvl) AS m FROM nodes GROUP BY k),
way AS (
  SELECT r.r, s.lvl, s.b, s.a FROM ranked r JOIN sides s ON r.k = s.k AND r.pos // CAST(pow(3, s.lvl) AS BIGINT) = s.pos
  UNION ALL
  SELECT r.r, height.m + s.lvl, s.b, s.a FROM ranked r JOIN subs USING (k) JOIN height USING (k)
    JOIN sides s ON s.k IS NULL AND subs.pos // CAST(pow(3, s.lvl) AS BIGINT) = s.pos),
proofs AS (SELECT r, sha256(string_agg(b || a, '' ORDER BY lvl)) AS p FROM way GROUP BY r),
fold(r, lvl, h) AS (
  SELECT r, 0, claim FROM ranked
  UNION ALL SELECT f.r, f.lvl + 1, sha256(w.b || f.h || w.a) FROM fold f JOIN way w ON f.r = w.r AND f.lvl = w.lvl),
folded AS (SELECT r, arg_max(h, lvl) AS folded_root FROM fold GROUP BY r)
SELECT doc_id, leaf, subs.h AS subroot, top.h AS root, coalesce(p, sha256('')) AS proof_sha256, folded_root, folded_root = top.h AS verified
FROM ranked JOIN subs USING (k) JOIN folded USING (r) LEFT JOIN proofs USING (r), (SELECT h FROM tops WHERE n = 1) top
"""


def _codes() -> str:
    """Components as rows (r: row, p: part, j: place, x), and per round the entries (p, e, j, c) and the codes (r, p, e, d)."""
    steps = ["""
rows AS (
  SELECT *, row_number() OVER (ORDER BY vec_id) - 1 AS r FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
comp AS (
  SELECT r, (i - 1) // w AS p, (i - 1) % w AS j, CAST(floor(256 * CAST(embedding[i] AS DOUBLE)) AS BIGINT) AS x
  FROM (SELECT r, embedding, len(embedding) // 16 AS w, unnest(range(1, len(embedding) + 1)) AS i FROM rows)),
book0 AS (SELECT p, r AS e, j, x AS c FROM comp WHERE r < 64)"""]
    for k in range(3):
        steps.append(f"""
near{k} AS (SELECT r, p, e, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM comp JOIN book{k} USING (p, j) GROUP BY r, p, e),
code{k} AS (SELECT r, p, e, d FROM near{k} QUALIFY row_number() OVER (PARTITION BY r, p ORDER BY d, e) = 1)""")
        if k < 2:
            steps.append(f"""
mean{k} AS (SELECT p, e, j, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM comp JOIN code{k} USING (r, p) GROUP BY p, e, j),
book{k + 1} AS (
  SELECT p, e, j, CASE WHEN n IS NULL THEN c ELSE s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END END AS c
  FROM book{k} LEFT JOIN mean{k} USING (p, e, j))""")
    return "WITH" + ",".join(steps)


OP12 = _codes() + """,
coded AS (SELECT r, string_agg(format('{:02x}', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM code2 GROUP BY r)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY p, e, j)) FROM book2) AS codebooks_sha256
FROM rows JOIN coded USING (r)
"""


def oracle_sql():
    return {"op4_mixing": OP4, "op8_line_dedup": OP8, "op10_exact_dedup": OP10, "op12_vector_codes": OP12, "op13_merkle": OP13}
