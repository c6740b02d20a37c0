"""DuckDB SQL for the registered queries, written independently of the Spark code, on the same derived tables."""

from __future__ import annotations

from broadsheet.fixtures import DEV_SQL, EVAL_SQL, PREDS_SQL

DEV = f"dev AS ({DEV_SQL})"
EVA = f"eva AS ({EVAL_SQL})"
PREDS = f"preds AS ({PREDS_SQL})"
N = "chr(92) || 'N'"
AD = r"(?i)^\s*(?:adv\s*[:\-]|advertisement\s*[:\-]?|sponsored\s*(?:content)?\s*[:\-]?)"
ENTITY = r"(?i)&(?:nbsp|amp|lt|gt|quot|#\d+);"
ZEROS = "('0000-00-00 00:00:00', '0000-00-00')"


def r(e):
    return f"round({e}, 6)"


def strip(c):
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def squeeze(c):
    return rf"trim(regexp_replace({c}, '\s+', ' ', 'g'))"


def text(c):
    return f"coalesce({c}, '')"


def gone(c):
    return f"({c} IS NULL OR {strip(c)} IN ('', {N}))"


def words(c):
    return rf"CAST(len(list_filter(string_split_regex({text(c)}, '\s+'), lambda x: x <> '')) AS INTEGER)"


def chars(c):
    return f"CAST(length({text(c)}) AS INTEGER)"


def unescape(c):
    out = c
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&amp;", "&")):
        out = f"replace({out}, '{a}', '{b}')"
    return out


def plain(c):
    """Entities, tags and links replaced."""
    out = rf"regexp_replace({unescape(c)}, '<[^>]+>', ' ', 'g')"
    return rf"regexp_replace({out}, '(?i)(https?://\S+|www\.\S+)', ' __URL__ ', 'g')"


def canonical(c):
    base = f"CASE WHEN {gone(c)} THEN '' ELSE {c} END"
    return f"lower({squeeze(f'strip_accents({plain(base)})')})"


def clean(c):
    return squeeze(plain(text(c)))


def near(c):
    return rf"regexp_replace({squeeze(f'lower({text(c)})')}, '[^\p{{L}}\p{{N}}_\s]', '', 'g')"


def eda_ts(c="timestamp"):
    return f"CASE WHEN {c} NOT IN {ZEROS} THEN try_cast({c} AS TIMESTAMP) END"


def ts(c="timestamp"):
    return (f"CASE WHEN {strip(c)} NOT IN ('', 'NA', 'N/A', 'null', 'None', '0000-00-00 00:00:00', '0000-00-00') "
            f"THEN try_cast({strip(c)} AS TIMESTAMP) END")


def shorten(c, n):
    s = squeeze(text(c))
    return f"CASE WHEN length({s}) <= {n} THEN {s} ELSE substr({s}, 1, {n - 3}) || '...' END"


def raw_hash():
    return f"md5({text('title')} || chr(10) || {text('article')})"


def near_hash():
    return f"md5({near('title')} || chr(10) || {near('article')})"


def matches(c, pattern):
    return f"regexp_matches({text(c)}, '{pattern}')"


def flags(c):
    return {
        "contains_html_tag": matches(c, "<[^>]+>"),
        "contains_url": matches(c, r"https?://|www\."),
        "contains_amp_entity": matches(c, "&[a-zA-Z]+;"),
        "contains_non_ascii": f"strlen({text(c)}) > length({text(c)})",
    }


def count_if(cond):
    return f"count(*) FILTER (WHERE {cond})"


def listed(items, sep=", "):
    return sep.join(items)


def missing_flags(c, placeholder=None):
    na, empty = f"{c} IS NULL", f"{strip(text(c))} = ''"
    placeholder = placeholder or f"{strip(text(c))} = {N}"
    return {"na": na, "empty_str": empty, "placeholder": placeholder, "missing_like": f"({na} OR {empty} OR {placeholder})"}


def missingness(table, cte, columns):
    parts = []
    for c, kind in columns:
        if kind == "number":
            f = {"na": f"{c} IS NULL", "empty_str": "false", "placeholder": "false", "missing_like": f"{c} IS NULL"}
        elif kind == "time":
            f = missing_flags(c, f"{strip(text(c))} IN ('0000-00-00 00:00:00', '0000-00-00', {N})")
            f["missing_like"] = f"(({eda_ts(c)}) IS NULL OR {f['empty_str']} OR {f['placeholder']})"
        else:
            f = missing_flags(c)
        sums = listed(f"{count_if(x)} AS {n}, {r(count_if(x) + ' / greatest(1, count(*))')} AS {n}_share" for n, x in f.items())
        parts.append(f"SELECT '{c}' AS col, {sums} FROM {table}")
    return f"WITH {cte} " + " UNION ALL ".join(parts)


DESCRIBE = {"p01": 0.01, "p05": 0.05, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}


def describe(v):
    q = listed(f"{r(f'quantile_cont(CAST({v} AS DOUBLE), {p})')} AS {n}" for n, p in DESCRIBE.items())
    return (f"count({v}) AS count, {r(f'avg({v})')} AS mean, {r(f'stddev_samp({v})')} AS std, {q}")


def hist_sql(source, bins):
    """Equal-width histogram of column v of ``source`` (a SELECT)."""
    return f"""v AS ({source}), lim AS (SELECT min(v) AS lo, max(v) AS hi FROM v),
 b AS (SELECT least(CAST(floor((v - lo) / (hi - lo) * {bins}.0::DOUBLE) AS INTEGER), {bins - 1}) AS g, v, lo, hi FROM v, lim),
 f AS (SELECT CASE WHEN v < lo + g * ((hi - lo) / {bins}.0::DOUBLE) THEN g - 1
   WHEN g < {bins - 1} AND v >= lo + (g + 1) * ((hi - lo) / {bins}.0::DOUBLE) THEN g + 1 ELSE g END AS bin FROM b),
 c AS (SELECT bin, count(*) AS n FROM f GROUP BY bin)
SELECT CAST(i AS INTEGER) AS bin, round(lo + i * ((hi - lo) / {bins}.0::DOUBLE), 6) AS left,
 round(CASE WHEN i = {bins - 1} THEN hi ELSE lo + (i + 1) * ((hi - lo) / {bins}.0::DOUBLE) END, 6) AS right, coalesce(n, 0) AS n
FROM range({bins}) t(i) CROSS JOIN lim LEFT JOIN c ON c.bin = i"""


def group_stats(hash_sql):
    return (f"WITH {DEV}, h AS (SELECT *, {hash_sql} AS content_hash FROM dev), "
            "g AS (SELECT content_hash, count(*) AS n, count(DISTINCT label) AS k FROM h GROUP BY 1 HAVING count(*) > 1)")


def dup_groups(hash_sql):
    out = []
    for name, cond in (("dup", "true"), ("same_label", "k = 1"), ("cross_label", "k > 1")):
        rows = f"CAST(coalesce(sum(n) FILTER (WHERE {cond}), 0) AS BIGINT)"
        out += [f"{count_if(cond)} AS {name}_groups", f"{rows} AS {name}_rows",
                f"round({rows} / greatest(1, (SELECT count(*) FROM dev)), 6) AS {name}_share"]
    return f"{group_stats(hash_sql)} SELECT {listed(out)} FROM g"


KEYED = (f"WITH {DEV}, {EVA}, k AS (SELECT *, {canonical('title')} AS ct, {canonical('article')} AS ca FROM dev), "
         f"e AS (SELECT DISTINCT {canonical('title')} AS ct, {canonical('article')} AS ca FROM eva)")
GROUPED = (f"WITH {DEV}, k AS (SELECT *, {canonical('title')} AS ct, {canonical('article')} AS ca FROM dev), "
           "g AS (SELECT ct, ca, count(*) AS n, count(DISTINCT coalesce(CAST(label AS VARCHAR), 'nan')) AS kinds FROM k GROUP BY 1, 2)")
KEPT = "id, label, source, title"


def label_time(part, limit):
    return f"""WITH {DEV}, t AS (SELECT label, CAST({part}({eda_ts()}) AS INTEGER) AS {part} FROM dev WHERE ({eda_ts()}) IS NOT NULL),
 c AS (SELECT label, {part}, count(*) AS n FROM t GROUP BY 1, 2)
SELECT label, {part}, n, round(n / sum(n) OVER (PARTITION BY label), 6) AS share FROM c
QUALIFY row_number() OVER (ORDER BY n DESC, label, {part}) <= {limit}"""


PER_LABEL = f"""WITH {PREDS}, cells AS (SELECT fold, label, pred, count(*) AS n FROM preds GROUP BY 1, 2, 3),
 t AS (SELECT fold, label, sum(n) AS n_true, sum(n) FILTER (WHERE label = pred) AS tp FROM cells GROUP BY 1, 2),
 p AS (SELECT fold, pred AS label, sum(n) AS n_pred FROM cells GROUP BY 1, 2),
 m AS (SELECT coalesce(t.fold, p.fold) AS fold, coalesce(t.label, p.label) AS label, coalesce(n_true, 0) AS n_true,
   coalesce(n_pred, 0) AS n_pred, coalesce(tp, 0) AS tp FROM t FULL JOIN p ON t.fold = p.fold AND t.label = p.label),
 s AS (SELECT *, CASE WHEN n_pred = 0 THEN 0 ELSE tp / n_pred END AS pr, CASE WHEN n_true = 0 THEN 0 ELSE tp / n_true END AS rc,
   2 * tp / (n_true + n_pred) AS f1 FROM m),
 folds AS (SELECT fold, avg(f1) AS macro_f1, sum(tp) / sum(n_true) AS micro_f1, sum(f1 * n_true) / sum(n_true) AS weighted_f1,
   CAST(sum(n_true) AS BIGINT) AS n_valid FROM s GROUP BY fold),
 grid AS (SELECT fold, label FROM (SELECT DISTINCT fold FROM preds), (SELECT DISTINCT label FROM preds)),
 pc AS (SELECT g.fold, g.label, coalesce(pr, 0.0) AS precision, coalesce(rc, 0.0) AS recall, coalesce(f1, 0.0) AS f1,
   CAST(coalesce(n_true, 0) AS BIGINT) AS support FROM grid g LEFT JOIN s ON g.fold = s.fold AND g.label = s.label)"""

COUNTS = f"""WITH {PREDS}, t AS (SELECT label, count(*) AS true_count FROM preds GROUP BY 1),
 p AS (SELECT pred AS label, count(*) AS pc FROM preds GROUP BY 1),
 c AS (SELECT t.label, true_count, coalesce(pc, 0) AS pred_count, coalesce(pc, 0) / true_count AS pred_per_true FROM t LEFT JOIN p ON t.label = p.label)"""

LABEL_F1 = f"""lf AS (SELECT t.label, 2 * coalesce(tp, 0) / (n_true + coalesce(n_pred, 0)) AS f1 FROM
 (SELECT label, count(*) AS n_true, count(*) FILTER (WHERE label = pred) AS tp FROM preds GROUP BY 1) t LEFT JOIN
 (SELECT pred, count(*) AS n_pred FROM preds GROUP BY 1) p ON t.label = p.pred)"""

SCORES = f"""WITH {PREDS}, long AS (SELECT id, label, pred, '0' AS class, score_0 AS score FROM preds UNION ALL
 SELECT id, label, pred, '1', score_1 FROM preds),
 s AS (SELECT class, score, CAST(label AS VARCHAR) = class AS is_pos FROM long WHERE score IS NOT NULL),
 u AS (SELECT class, score, count(*) FILTER (WHERE is_pos) AS tp_here, count(*) AS n_here FROM s GROUP BY 1, 2),
 k AS (SELECT class, score, tp_here, sum(tp_here) OVER w AS tp, sum(n_here) OVER w AS n,
   sum(tp_here) OVER (PARTITION BY class) AS pos FROM u WINDOW w AS (PARTITION BY class ORDER BY score DESC)),
 c AS (SELECT class, score, tp_here, pos, CAST(tp / n AS DOUBLE) AS p, CAST(tp / pos AS DOUBLE) AS r FROM k)"""
BEST = """best AS (SELECT class, f1 AS best_f1, score AS best_thr FROM (SELECT class, score, 2.0::DOUBLE * p * r / (p + r + 1e-12::DOUBLE) AS f1 FROM c)
 QUALIFY row_number() OVER (PARTITION BY class ORDER BY f1 DESC, score) = 1),
 ap AS (SELECT class, sum(p * tp_here / pos) AS ap FROM c GROUP BY 1)"""

BINS = f"""WITH {DEV}, {EVA}, a AS (SELECT *, 1 AS d, 0 AS e FROM (SELECT id, source, title, article, page_rank, timestamp FROM dev)
 UNION ALL SELECT *, 0, 1 FROM eva),
 w AS (SELECT d, e, 'title.word_len' AS feature, {words('title')} AS n FROM a UNION ALL
   SELECT d, e, 'article.word_len', {words('article')} FROM a),
 edges AS (SELECT * FROM (VALUES (0, 0, 5), (1, 5, 10), (2, 10, 20), (3, 20, 40), (4, 40, 80), (5, 80, 160), (6, 160, 320), (7, 320, 10000)) v(i, lo, hi)),
 x AS (SELECT d, e, 'page_rank' AS feature, CAST(page_rank AS DOUBLE) AS bin, CAST(1 AS DOUBLE) AS width FROM a UNION ALL
   SELECT d, e, 'timestamp.year', CAST(year({eda_ts()}) AS DOUBLE), 1 FROM a WHERE ({eda_ts()}) IS NOT NULL UNION ALL
   SELECT d, e, feature, CAST(i AS DOUBLE), CAST(hi - lo AS DOUBLE) FROM w JOIN edges ON (n >= lo AND n < hi) OR (i = 7 AND n = hi)),
 al AS (SELECT feature, bin, width, CAST(sum(d) AS BIGINT) AS n_dev, CAST(sum(e) AS BIGINT) AS n_eval FROM x GROUP BY 1, 2, 3)"""

NA_LIST = ("('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
           "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')")


def na(c):
    return f"CASE WHEN {c} NOT IN {NA_LIST} THEN {c} END AS {c}"


PATTERNS = {}
for _c in ("title", "article"):
    _s = f"CASE WHEN {strip(text(_c))} = {N} THEN '' ELSE {text(_c)} END"
    PATTERNS[f"{_c}_chars"] = f"length({_s})"
    PATTERNS[f"{_c}_words"] = words(f"({_s})")
    PATTERNS[f"{_c}_adv"] = f"regexp_matches({_s}, '{AD}')"
    PATTERNS[f"{_c}_url"] = rf"regexp_matches({_s}, '(?i)(https?://\S+|www\.\S+)')"
    PATTERNS[f"{_c}_html"] = f"(regexp_matches({_s}, '<[^>]+>') OR regexp_matches({_s}, '{ENTITY}'))"
    PATTERNS[f"{_c}_non_ascii"] = f"strlen({_s}) > length({_s})"
for _k in ("adv", "url", "html", "non_ascii"):
    PATTERNS[f"any_{_k}"] = f"({PATTERNS[f'title_{_k}']} OR {PATTERNS[f'article_{_k}']})"
META = ("title_chars", "article_chars", "title_words", "article_words", "title_adv", "article_adv", "any_adv",
        "title_url", "article_url", "any_url", "title_html", "article_html", "any_html", "any_non_ascii")


def dev(select):
    return f"WITH {DEV} SELECT {select} FROM dev"


def both(select):
    return f"WITH {DEV}, {EVA} SELECT {select}"


def top_values(value, source, n=10):
    return f"""WITH {source}, c AS (SELECT {value} AS value, count(*) AS n FROM t GROUP BY 1)
SELECT value, n, round(n / (SELECT sum(n) FROM c), 6) AS share, (SELECT count(value) FROM c) AS n_distinct
FROM c ORDER BY n DESC, value ASC NULLS LAST LIMIT {n}"""


RANKS = ("ranks AS (SELECT source, count(DISTINCT page_rank) AS n_page_ranks FROM dev "
         "WHERE source IS NOT NULL AND page_rank IS NOT NULL GROUP BY 1)")


FOLD = "CAST((row_number() OVER (ORDER BY label NULLS FIRST, md5(CAST(id AS VARCHAR) || ':42'), id) - 1) % 5 AS INTEGER)"


def extremes(c, kind, order):
    return (f"SELECT '{c}' AS field, '{kind}' AS kind, id, chars, {shorten(c, 160)} AS example FROM "
            f"(SELECT id, {chars(c)} AS chars, {c} FROM dev ORDER BY chars {order}, id LIMIT 3)")


def per_field(select):
    return f"WITH {DEV} " + " UNION ALL ".join(select(c) for c in ("title", "article"))


ORACLES = {
    "scan_dev": dev(f"id, {na('source')}, {na('title')}, {na('article')}, CAST(page_rank AS DOUBLE) AS page_rank, {na('timestamp')}, label"),
    "scan_dev_ranges": dev(f"id, {na('source')}, {na('title')}, {na('article')}, CAST(page_rank AS DOUBLE) AS page_rank, {na('timestamp')}, label"),
    "scan_eval": f"WITH {EVA} SELECT id, {na('source')}, {na('title')}, {na('article')}, CAST(page_rank AS DOUBLE) AS page_rank, {na('timestamp')} FROM eva",
    "standardize_columns": dev("*"),
    "na_tokens": dev(f"id, {na('source')}, {na('title')}, {na('article')}, {na('timestamp')}"),
    "schema_check": f"WITH {DEV} " + " UNION ALL ".join(
        f"SELECT '{c}' AS column, '{s}' AS status, {n} AS values FROM dev" for c, s, n in (
            ("id", "ok", "count(id)"), ("source", "ok", "count(source)"), ("title", "ok", "count(title)"),
            ("article", "ok", "count(article)"), ("page_rank", "missing", "0 * count(*)"),
            ("timestamp", "moved", "count(timestamp)"), ("label", "moved", "count(label)"), ("lang", "extra", "count(*)"))),
    "scan_predictions": f"""WITH {PREDS} SELECT id, label, pred, '0' AS class, {r('score_0')} AS score FROM preds UNION ALL
SELECT id, label, pred, '1', {r('score_1')} FROM preds""",
    "write_predictions": f'WITH {PREDS} SELECT id AS "Id", pred AS "Predicted" FROM preds',
    "metric_sinks": f"""{PER_LABEL}, q AS (SELECT count(DISTINCT fold) AS f, count(DISTINCT label) AS k, count(DISTINCT pred) AS p FROM preds)
SELECT 'folds' AS table_name, f AS rows, 6 AS n_cols, CAST(0 AS BIGINT) AS differing FROM q UNION ALL
SELECT 'per_class_mean', k, 4, 0 FROM q UNION ALL SELECT 'confusion_matrix', k, CAST(1 + k AS INTEGER), 0 FROM q UNION ALL
SELECT 'oof_true_pred_counts', k, 4, 0 FROM q UNION ALL SELECT 'pred_label_counts', p, 2, 0 FROM q""",
    "run_summary": f"""{PER_LABEL} SELECT 'cv' AS stage, (SELECT count(*) FROM folds) AS k, (SELECT count(*) FROM preds) AS n,
 round((SELECT avg(macro_f1) FROM folds), 6) AS macro_f1_mean""",
    "missing_like": dev("id, " + listed(f"{gone(c)} AS {c}" for c in ("source", "title", "article"))),
    "missing_indicator": dev(f"id, CAST({gone('article')} AS DOUBLE) AS article_missing"),
    "canonical_text": f"WITH {DEV}, {EVA}, a AS (SELECT id, title, article FROM dev UNION ALL SELECT id, title, article FROM eva) "
                      f"SELECT id, {canonical('title')} AS title, {canonical('article')} AS article FROM a",
    "clean_text": dev(f"id, {clean('title')} AS title, {clean('article')} AS article"),
    "clean_pages": "SELECT page_id, " + squeeze(plain("replace(replace(html, '&copy;', '©'), '&middot;', '·')")) + " AS text FROM pages",
    "strip_ad_prefix": dev("id, " + listed(f"regexp_replace({text(c)}, '{AD}', '') AS {c}" for c in ("title", "article"))),
    "join_text": dev(f"id, {text('title')} || ' ' || {text('title')} || ' ' || "
                     f"CASE WHEN {gone('article')} THEN ' __MISSING_ARTICLE__ ' ELSE article END AS joined"),
    "text_column": dev(f"id, {text('title')} AS title, CASE WHEN {gone('article')} THEN '__MISSING_ARTICLE__' ELSE article END AS article"),
    "text_pattern_features": dev("id, " + listed(f"CAST({PATTERNS[m]} AS DOUBLE) AS {m}" for m in META)),
    "numeric_coerce": dev("id, CAST(coalesce(page_rank, 0) AS DOUBLE) AS page_rank, coalesce(try_cast(source AS DOUBLE), 0) AS source_number, "
                          "coalesce(try_cast(substr(timestamp, 1, 4) AS DOUBLE), 0) AS year_number"),
    "parse_timestamp": dev(f"id, CAST({ts()} AS VARCHAR) AS ts"),
    "timestamp_missing": dev(f"id, CAST(({ts()}) IS NULL AS DOUBLE) AS ts_missing"),
    "eda_timestamp": dev(f"id, CAST({eda_ts()} AS VARCHAR) AS ts"),
    "normalize_near_dup": dev(f"id, {near('title')} AS title, {near('article')} AS article"),
    "content_hash": dev(f"id, {raw_hash()} AS raw, {near_hash()} AS near"),
    "text_lengths": dev("id, " + listed(f"{chars(c)} AS {c}_chars, {words(c)} AS {c}_words" for c in ("title", "article"))),
    "pattern_flags": dev("id, " + listed(f"{e} AS {c}_{n}" for c in ("title", "article") for n, e in flags(c).items())),
    "shorten": dev(f"id, {shorten('article', 160)} AS article, {shorten('title', 40)} AS title"),
    "select_features": dev("label AS y, id, source, title, article, page_rank, timestamp"),
    "filter_rows": dev(f"id, label") + f" WHERE {gone('article')} OR ({eda_ts()}) IS NOT NULL",
    "leakage_semi": f"{KEYED} SELECT {KEPT} FROM k WHERE EXISTS (SELECT 1 FROM e WHERE e.ct = k.ct AND e.ca = k.ca)",
    "leakage_anti": f"{KEYED} SELECT {KEPT} FROM k WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.ct = k.ct AND e.ca = k.ca)",
    "cross_label_anti": f"{GROUPED} SELECT {KEPT} FROM k JOIN g USING (ct, ca) WHERE kinds = 1",
    "cross_label_rows": f"{GROUPED} SELECT {KEPT} FROM k JOIN g USING (ct, ca) WHERE kinds > 1",
    "id_overlap": both("count(DISTINCT dev.id) AS overlapping_ids FROM dev JOIN eva ON dev.id = eva.id"),
    "source_overlap": f"""WITH {DEV}, {EVA}, a AS (SELECT DISTINCT {strip('source')} AS s FROM dev WHERE source IS NOT NULL),
 b AS (SELECT DISTINCT {strip('source')} AS s FROM eva WHERE source IS NOT NULL), u AS (SELECT s FROM b EXCEPT SELECT s FROM a)
SELECT (SELECT count(*) FROM a) AS dev_sources, (SELECT count(*) FROM b) AS eval_sources, (SELECT count(*) FROM u) AS unseen_in_dev,
 round((SELECT count(*) FROM u) / (SELECT count(*) FROM b), 6) AS unseen_share""",
    "unseen_sources": f"""WITH {DEV}, {EVA} SELECT DISTINCT {strip('source')} AS source FROM eva WHERE source IS NOT NULL AND {strip('source')} NOT IN
 (SELECT {strip('source')} FROM dev WHERE source IS NOT NULL) ORDER BY 1 LIMIT 15""",
    "content_overlap": f"WITH {DEV}, {EVA} " + " UNION ALL ".join(
        f"SELECT '{c}' AS field, count(*) AS shared_hashes FROM (SELECT md5({text(c)}) FROM dev INTERSECT SELECT md5({text(c)}) FROM eva)"
        for c in ("title", "article")),
    "share_of_label": f"""WITH {DEV}, c AS (SELECT label, page_rank, count(*) AS n FROM dev GROUP BY 1, 2)
SELECT *, round(n / sum(n) OVER (PARTITION BY label), 6) AS share FROM c""",
    "true_pred_counts": f"{COUNTS} SELECT label, true_count, pred_count, round(pred_per_true, 6) AS pred_per_true FROM c",
    "bin_alignment": f"{BINS} SELECT * FROM al",
    "union_folds": f"WITH {PREDS} SELECT label, pred, count(*) AS n FROM preds GROUP BY 1, 2",
    "label_summary": f"WITH {DEV} SELECT label, count(*) AS n, round(count(*) / sum(count(*)) OVER (), 6) AS share FROM dev GROUP BY 1",
    "majority_baseline": f"""WITH {DEV}, c AS (SELECT label, count(*) AS n FROM dev GROUP BY 1), p AS (SELECT max(n) / sum(n) AS p, count(label) AS k FROM c)
SELECT round(p, 6) AS majority_share, k, round(2 * p / (p + 1), 6) AS f1_majority, round(2 * p / (p + 1) / k, 6) AS macro_f1 FROM p WHERE k > 1""",
    "class_weights": f"""WITH {DEV}, c AS (SELECT label, count(*) AS n FROM dev GROUP BY 1)
SELECT label, n, round(pow((SELECT sum(n) FROM c) / ((SELECT count(*) FROM c) * n), 0.7), 6) AS weight FROM c""",
    "missingness": missingness("dev", DEV, (("id", "number"), ("source", "text"), ("title", "text"), ("article", "text"),
                                            ("page_rank", "number"), ("timestamp", "time"), ("label", "number"))),
    "missingness_eval": missingness("eva", EVA, (("id", "number"), ("source", "text"), ("title", "text"), ("article", "text"),
                                                 ("page_rank", "number"), ("timestamp", "time"))),
    "text_missingness": per_field(lambda c: f"SELECT '{c}' AS field, " + listed(
        f"{count_if(x)} AS {n}, {r(count_if(x) + ' / greatest(1, count(*))')} AS {n}_share" for n, x in missing_flags(c).items()) + " FROM dev"),
    "missing_article_by_label": f"""WITH {DEV}, c AS (SELECT label, count(*) AS missing_count FROM dev WHERE {gone('article')} GROUP BY 1)
SELECT *, round(missing_count / sum(missing_count) OVER (), 6) AS share_of_missing FROM c""",
    "missing_ts_by_label": f"""WITH {DEV}, c AS (SELECT label, count(*) AS missing_count FROM dev WHERE ({eda_ts()}) IS NULL GROUP BY 1)
SELECT *, round(missing_count / sum(missing_count) OVER (), 6) AS share_of_missing FROM c""",
    "label_ts_missingness": dev(f"""label, {count_if(f"{strip(text('timestamp'))} IN {ZEROS}")} AS placeholder,
 {count_if(f'({eda_ts()}) IS NULL')} AS missing_like, count(*) AS total,
 {r(count_if(f'({eda_ts()}) IS NULL') + ' / count(*)')} AS missing_like_share""") + " GROUP BY label",
    "label_text_missingness": per_field(lambda c: f"SELECT '{c}' AS field, label, " + listed(
        f"{count_if(x)} AS {n}" for n, x in missing_flags(c).items()) + ", count(*) AS total FROM dev GROUP BY label"),
    "id_checks": dev("count(*) AS rows, count(*) - count(id) AS missing, count(*) - (SELECT count(*) FROM (SELECT DISTINCT id FROM dev)) "
                     "AS duplicates, count(DISTINCT id) AS distinct_ids, min(id) AS id_min, max(id) AS id_max"),
    "duplicate_counts": f"WITH {DEV} " + " UNION ALL ".join(
        f"SELECT '{k}' AS kind, (SELECT count(*) FROM dev) - (SELECT count(*) FROM (SELECT DISTINCT {c} FROM dev)) AS duplicates, "
        f"round(((SELECT count(*) FROM dev) - (SELECT count(*) FROM (SELECT DISTINCT {c} FROM dev))) / (SELECT count(*) FROM dev), 6) AS share"
        for k, c in (("all_columns", "*"), ("title_article", "title, article"), ("title", "title"))),
    "categorical_summary": top_values("source", f"{DEV}, t AS (SELECT source FROM dev)"),
    "categorical_summary_events": top_values("user_id", "t AS (SELECT user_id FROM events)"),
    "numeric_summary": dev(f"{describe('page_rank')}, CAST(min(page_rank) AS DOUBLE) AS min, CAST(max(page_rank) AS DOUBLE) AS max"),
    "numeric_summary_events": f"SELECT {describe('value')}, round(min(value), 6) AS min, round(max(value), 6) AS max FROM events",
    "numeric_summary_lineitem": f"""SELECT {describe('v')}, round(min(v), 6) AS min, round(max(v), 6) AS max
FROM (SELECT CAST(l_extendedprice AS DOUBLE) AS v FROM lineitem)""",
    "timestamp_summary": dev(f"count(*) AS rows, {count_if(f'timestamp IN {ZEROS}')} AS placeholder, {count_if(f'({eda_ts()}) IS NULL')} AS invalid, "
                             f"CAST(min({eda_ts()}) AS VARCHAR) AS ts_min, CAST(max({eda_ts()}) AS VARCHAR) AS ts_max"),
    "counts_by_year": f"""WITH {DEV} SELECT CAST(year({eda_ts()}) AS INTEGER) AS year, count(*) AS n,
 round(count(*) / (SELECT count(*) FROM dev), 6) AS share FROM dev WHERE ({eda_ts()}) IS NOT NULL GROUP BY 1""",
    "counts_by_hour": f"""WITH {DEV} SELECT CAST(hour({eda_ts()}) AS INTEGER) AS hour, count(*) AS n,
 round(count(*) / sum(count(*)) OVER (), 6) AS share FROM dev WHERE ({eda_ts()}) IS NOT NULL GROUP BY 1""",
    "text_length_summary": per_field(lambda c: " UNION ALL ".join(
        f"SELECT '{c}' AS field, '{m}' AS measure, {describe(m)}, min({m}) AS min, max({m}) AS max "
        f"FROM (SELECT {chars(c)} AS chars, {words(c)} AS words FROM dev)" for m in ("chars", "words"))),
    "pattern_prevalence": per_field(lambda c: " UNION ALL ".join(
        f"SELECT '{c}' AS field, '{n}' AS pattern, {count_if(e)} AS n, {r(count_if(e) + ' / count(*)')} AS share FROM dev" for n, e in flags(c).items())),
    "source_pagerank": f"""WITH {DEV}, {RANKS} SELECT source, n_page_ranks, (SELECT count(*) FROM ranks WHERE n_page_ranks > 1) AS n_varying,
 (SELECT count(DISTINCT source) FROM dev) AS n_sources FROM ranks WHERE n_page_ranks > 1 ORDER BY n_page_ranks DESC, source LIMIT 10""",
    "label_text_lengths": per_field(lambda c: f"SELECT '{c}' AS field, label, count(*) AS n, " + listed(
        f"round(avg({m}), 2) AS {m}_mean, round(quantile_cont(CAST({m} AS DOUBLE), 0.5), 2) AS {m}_p50, "
        f"round(quantile_cont(CAST({m} AS DOUBLE), 0.9), 2) AS {m}_p90" for m in ("chars", "words"))
        + f" FROM (SELECT label, {chars(c)} AS chars, {words(c)} AS words FROM dev) GROUP BY label"),
    "label_pattern_prevalence": per_field(lambda c: f"SELECT '{c}' AS field, label, "
        f"{r('avg(CAST(' + flags(c)['contains_html_tag'] + ' AS INTEGER))')} AS has_html, "
        f"{r('avg(CAST(' + flags(c)['contains_url'] + ' AS INTEGER))')} AS has_url FROM dev GROUP BY label"),
    "label_year_counts": label_time("year", 60),
    "label_month_counts": label_time("month", 60),
    "duplicate_groups": dup_groups(raw_hash()),
    "duplicate_groups_near": dup_groups(near_hash()),
    "cross_label_dup_by_label": f"""{group_stats(near_hash())}, x AS (SELECT label, count(*) AS cross_dup_rows FROM h
 WHERE content_hash IN (SELECT content_hash FROM g WHERE k > 1) GROUP BY 1)
SELECT x.label, cross_dup_rows, round(cross_dup_rows / (SELECT count(*) FROM dev WHERE dev.label = x.label), 6) AS share_of_label FROM x""",
    "leakage_report": f"""{KEYED}, c AS (SELECT (SELECT count(*) FROM dev) AS n, (SELECT count(*) FROM eva) AS m,
 (SELECT count(*) FROM k WHERE EXISTS (SELECT 1 FROM e WHERE e.ct = k.ct AND e.ca = k.ca)) AS o)
SELECT n AS n_dev_before, m AS n_eval, o AS n_overlap_with_eval, o AS n_removed_from_dev, n - o AS n_dev_after,
 round(100 * o / greatest(1, n), 6) AS pct_overlap_in_dev, round(100 * o / greatest(1, n), 6) AS pct_removed_from_dev FROM c""",
    "dedup_report": f"""{GROUPED}, t AS (SELECT CAST(sum(n) AS BIGINT) AS n0, count(*) FILTER (WHERE n > 1) AS dg,
 count(*) FILTER (WHERE kinds > 1) AS cg, CAST(coalesce(sum(n) FILTER (WHERE kinds > 1), 0) AS BIGINT) AS cr,
 count(*) FILTER (WHERE n > 1 AND kinds = 1) AS sg, CAST(coalesce(sum(n) FILTER (WHERE n > 1 AND kinds = 1), 0) AS BIGINT) AS sr FROM g)
SELECT n0 AS n_dev_before, n0 - cr - (sr - sg) AS n_dev_after, dg AS dup_groups, cg AS cross_label_groups, cr AS cross_label_rows,
 sg AS same_label_groups, sr AS same_label_rows, cr AS rows_removed_cross_label, sr - sg AS rows_removed_same_label,
 round(100 * (cr + sr - sg) / greatest(1, n0), 6) AS pct_removed_from_dev FROM t""",
    "js_divergence": f"""{BINS}, tot AS (SELECT feature, sum(n_dev) AS td, sum(n_eval) AS te FROM al GROUP BY 1),
 q AS (SELECT feature, n_dev / td / width + 1e-12 AS p, n_eval / te / width + 1e-12 AS q FROM al JOIN tot USING (feature)),
 z AS (SELECT feature, p / sum(p) OVER (PARTITION BY feature) AS p, q / sum(q) OVER (PARTITION BY feature) AS q FROM q)
SELECT feature, round(0.5 * sum(p * ln(p / (0.5 * (p + q)))) + 0.5 * sum(q * ln(q / (0.5 * (p + q)))), 6) AS js_div FROM z GROUP BY 1""",
    "word_len_histogram": f"""WITH {DEV}, w AS (SELECT 'title' AS field, {words('title')} AS n FROM dev UNION ALL SELECT 'article', {words('article')} FROM dev),
 edges AS (SELECT * FROM (VALUES (0, 0, 5), (1, 5, 10), (2, 10, 20), (3, 20, 40), (4, 40, 80), (5, 80, 160), (6, 160, 320), (7, 320, 10000)) v(i, lo, hi)),
 c AS (SELECT field, i, lo, hi, count(*) AS k FROM w JOIN edges ON (n >= lo AND n < hi) OR (i = 7 AND n = hi) GROUP BY 1, 2, 3, 4)
SELECT field, i AS bin, lo AS left, hi AS right, k AS n, round(k / (sum(k) OVER (PARTITION BY field) * (hi - lo)), 6) AS density FROM c""",
    "gotchas": f"""WITH {DEV}, {RANKS}, v AS (SELECT 'timestamp_placeholder' AS rule,
 avg(CAST(coalesce(timestamp, '') = '0000-00-00 00:00:00' AS INTEGER)) AS value, 0.01 AS threshold FROM dev """ + "".join(
        f" UNION ALL SELECT '{c}_{k}', avg(CAST({flags(c)[f]} AS INTEGER)), 0.05 FROM dev"
        for c in ("title", "article") for k, f in (("html", "contains_html_tag"), ("url", "contains_url"))) + """
 UNION ALL SELECT 'source_page_rank_varies', avg(CAST(n_page_ranks > 1 AS INTEGER)), 0.001 FROM ranks)
SELECT rule, round(value, 6) AS value, CAST(threshold AS DOUBLE) AS threshold, value > threshold AS fired FROM v""",
    "histogram": f"WITH {DEV}, " + hist_sql(f"SELECT CAST({words('article')} AS DOUBLE) AS v FROM dev", 60),
    "histogram_events": "WITH " + hist_sql("SELECT value AS v FROM events WHERE value IS NOT NULL", 50),
    "top_bar_counts": f"WITH {DEV} SELECT source AS value, count(*) AS n FROM dev WHERE source IS NOT NULL GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 15",
    "top_bar_years": f"WITH {DEV} SELECT CAST(year({eda_ts()}) AS INTEGER) AS value, count(*) AS n FROM dev WHERE ({eda_ts()}) IS NOT NULL GROUP BY 1 ORDER BY 1 LIMIT 15",
    "pred_label_counts": f"WITH {PREDS} SELECT pred AS label, count(*) AS n FROM preds GROUP BY 1",
    "dedup_keep_first": f"{GROUPED} SELECT {KEPT} FROM k JOIN g USING (ct, ca) WHERE kinds = 1 QUALIFY row_number() OVER (PARTITION BY ct, ca ORDER BY id) = 1",
    "top_sources_per_label": f"""WITH {DEV}, c AS (SELECT label, coalesce(source, '') AS source, count(*) AS n FROM dev GROUP BY 1, 2),
 s AS (SELECT *, round(n / sum(n) OVER (PARTITION BY label), 6) AS share, CAST(row_number() OVER (PARTITION BY label ORDER BY n DESC, source) AS INTEGER) AS rank FROM c)
SELECT * FROM s WHERE rank <= 5""",
    "shortest_longest": per_field(lambda c: f"{extremes(c, 'shortest', 'ASC')} UNION ALL {extremes(c, 'longest', 'DESC')}"),
    "cross_label_examples": f"""{group_stats(near_hash())}, top AS (SELECT content_hash, n FROM g WHERE k > 1 ORDER BY n DESC, content_hash LIMIT 5),
 l AS (SELECT content_hash, label, count(*) AS c FROM h WHERE content_hash IN (SELECT content_hash FROM top) GROUP BY 1, 2)
SELECT top.content_hash, n, (SELECT string_agg(label || ': ' || c, ', ' ORDER BY label) FROM l WHERE l.content_hash = top.content_hash) AS labels,
 (SELECT {shorten('arg_min(title, id)', 160)} FROM h WHERE h.content_hash = top.content_hash) AS title FROM top""",
    "random_sample": per_field(lambda c: f"""SELECT '{c}' AS field, id, {shorten(c, 220)} AS example FROM
 (SELECT * FROM dev ORDER BY md5(CAST(id AS VARCHAR) || ':0'), id LIMIT 3)"""),
    "stratified_folds": f"WITH {DEV} SELECT id, label, {FOLD} AS fold FROM dev",
    "weak_labels": f"WITH {PREDS}, {LABEL_F1} SELECT CAST(label AS VARCHAR) AS label, round(f1, 6) AS f1 FROM lf ORDER BY lf.f1, lf.label LIMIT 2",
    "fold_f1": f"""{PER_LABEL} SELECT fold, round(macro_f1, 6) AS macro_f1, round(micro_f1, 6) AS micro_f1, round(weighted_f1, 6) AS weighted_f1,
 n_valid, (SELECT count(*) FROM preds) - n_valid AS n_train FROM folds""",
    "per_class_metrics": f"{PER_LABEL} SELECT fold, label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM pc",
    "per_class_mean": f"""{PER_LABEL} SELECT label, round(avg(precision), 6) AS precision, round(avg(recall), 6) AS recall,
 round(avg(f1), 6) AS f1 FROM pc GROUP BY 1""",
    "confusion_matrix": f"WITH {PREDS} SELECT label, " + listed(f"count(*) FILTER (WHERE pred = {c}) AS pred_{c}" for c in range(4)) + " FROM preds GROUP BY 1",
    "cv_summary": f"""{PER_LABEL} SELECT count(*) AS folds, round(avg(macro_f1), 6) AS macro_f1_mean,
 round(coalesce(stddev_samp(macro_f1), 0), 6) AS macro_f1_std FROM folds""",
    "oof_counts": f"""{COUNTS} SELECT CAST(label AS VARCHAR) AS label, true_count, pred_count, round(pred_per_true, 6) AS pred_per_true,
 round(true_count / sum(true_count) OVER (), 6) AS true_share, round(pred_count / sum(pred_count) OVER (), 6) AS pred_share FROM c""",
    "pr_curve": f"""{SCORES} SELECT class, round(score, 6) AS threshold, round(p, 6) AS precision, round(r, 6) AS recall FROM c UNION ALL
SELECT DISTINCT class, CAST(NULL AS DOUBLE), CAST(1 AS DOUBLE), CAST(0 AS DOUBLE) FROM c""",
    "average_precision": f"{SCORES}, {BEST} SELECT class, round(ap, 6) AS ap FROM ap",
    "best_f1_threshold": f"{SCORES}, {BEST} SELECT class, round(best_f1, 6) AS best_f1, round(best_thr, 6) AS best_thr FROM best",
    "pr_summary": f"""{SCORES}, {BEST}, {LABEL_F1} SELECT class AS label, round(ap, 4) AS ap, round(lf.f1, 4) AS f1_pred, round(best_f1, 4) AS best_f1,
 round(best_thr, 6) AS best_thr FROM ap JOIN best USING (class) JOIN lf ON CAST(lf.label AS VARCHAR) = class""",
    "score_separation": f"""{SCORES} SELECT class, round(avg(score) FILTER (WHERE is_pos), 6) AS pos_mean, round(avg(score) FILTER (WHERE NOT is_pos), 6) AS neg_mean,
 round(quantile_cont(score, 0.9) FILTER (WHERE is_pos), 6) AS pos_p90, round(quantile_cont(score, 0.9) FILTER (WHERE NOT is_pos), 6) AS neg_p90 FROM s GROUP BY 1""",
    "score_histogram": f"""{SCORES}, lim AS (SELECT class, is_pos, min(score) AS lo, max(score) AS hi, count(*) AS total FROM s GROUP BY 1, 2),
 b AS (SELECT class, is_pos, least(CAST(floor((score - lo) / (hi - lo) * 40.0::DOUBLE) AS INTEGER), 39) AS g, score AS v, lo, hi FROM s JOIN lim USING (class, is_pos)),
 f AS (SELECT class, is_pos, CASE WHEN v < lo + g * ((hi - lo) / 40.0::DOUBLE) THEN g - 1
   WHEN g < 39 AND v >= lo + (g + 1) * ((hi - lo) / 40.0::DOUBLE) THEN g + 1 ELSE g END AS bin FROM b),
 h AS (SELECT class, is_pos, bin, count(*) AS n FROM f GROUP BY 1, 2, 3),
 g AS (SELECT *, CAST(i AS INTEGER) AS bin, lo + i * ((hi - lo) / 40.0::DOUBLE) AS le,
   CASE WHEN i = 39 THEN hi ELSE lo + (i + 1) * ((hi - lo) / 40.0::DOUBLE) END AS re FROM lim, range(40) t(i))
SELECT class, is_pos, bin, round(le, 6) AS left, round(re, 6) AS right, coalesce(n, 0) AS n,
 round(coalesce(n, 0) / (total * (re - le)), 6) AS density FROM g LEFT JOIN h USING (class, is_pos, bin)""",
}


# Features

def _document(title, article):
    """Ad prefixes off, title twice, article or its token, cleaned, lower case, no accents."""
    t = f"regexp_replace({text(title)}, '{AD}', '')"
    a = f"regexp_replace({text(article)}, '{AD}', '')"
    joined = f"{t} || ' ' || {t} || ' ' || CASE WHEN {gone(a)} THEN ' __MISSING_ARTICLE__ ' ELSE {a} END"
    return f"strip_accents(lower({clean('j')}))", joined


_DOC, _JOINED = _document("title", "article")
DOCS = f"{DEV}, j AS (SELECT id, title, {_JOINED} AS j FROM dev), docs AS (SELECT id, title, {_DOC} AS t FROM j)"
WORD_GRAMS = f"""{DOCS}, w AS (SELECT id, regexp_extract_all(t, '[\\p{{L}}\\p{{N}}_]{{2,}}') AS w FROM docs),
 grams AS (SELECT id, unnest(w) AS term FROM w UNION ALL
   SELECT id, w[i] || ' ' || w[i + 1] FROM w, unnest(range(1, len(w))) u(i))"""


def char_grams(source, low, high):
    return f"""cw AS (SELECT id, ' ' || unnest(list_filter(string_split_regex(t, '\\s+'), lambda x: x <> '')) || ' ' AS w FROM {source}),
 grams AS (SELECT id, substr(w, i, n) AS term FROM cw, range({low}, {high + 1}) r(n), unnest(range(1, length(w) - n + 2)) u(i) WHERE length(w) >= n
   UNION ALL SELECT id, w FROM cw WHERE length(w) < {low})"""


TERMS = "per AS (SELECT id, term, count(*) AS tf FROM grams GROUP BY 1, 2), st AS (SELECT term, CAST(sum(tf) AS BIGINT) AS tf, count(*) AS df FROM per GROUP BY 1)"


def weighted(grams, min_df, limit):
    return f"""WITH {grams}, {TERMS}, nd AS (SELECT count(*) AS n FROM dev),
 voc AS (SELECT term, df FROM st, nd WHERE df >= {min_df} AND df <= 0.95::DOUBLE * n ORDER BY st.tf DESC, term LIMIT {limit}),
 raw AS (SELECT id, term, (1 + ln(tf)) * (ln((1.0 + n) / (1.0 + df)) + 1) AS w FROM per JOIN voc USING (term), nd)
SELECT id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY id)), 6) AS weight FROM raw"""


_SRC = f"CASE WHEN {strip(text('source'))} IN ('', {N}) THEN '__MISSING__' ELSE {strip(text('source'))} END"
_TITLES = f"{DEV}, titles AS (SELECT id, strip_accents(lower({clean('title')})) AS t FROM dev)"
KEPT_SOURCES = f"kept AS (SELECT {_SRC} AS s FROM dev GROUP BY 1 HAVING count(*) >= 3)"
_PARTS = {"year": f"year({ts()})", "month": f"month({ts()})", "dow": f"isodow({ts()}) - 1", "hour": f"hour({ts()})", "doy": f"dayofyear({ts()})"}
TIMES = (f"{DEV}, raw AS (SELECT *, ({ts()}) IS NULL AS gone, " + listed(f"{e} AS {n}" for n, e in _PARTS.items()) + " FROM dev), "
         "med AS (SELECT " + listed(f"CAST(trunc(median({n})) AS INTEGER) AS m_{n}" for n in _PARTS) + " FROM raw), "
         "tm AS (SELECT raw.id, CAST(gone AS DOUBLE) AS is_missing, " + listed(f"coalesce({n}, m_{n}) AS {n}" for n in _PARTS) + " FROM raw, med)")
_TURNS = {"hour": "hour / 24.0::DOUBLE", "dow": "dow / 7.0::DOUBLE", "month": "(month - 1) / 12.0::DOUBLE", "doy": "(doy - 1) / 365.0::DOUBLE"}
_TIME_COLS = {n: f"CAST({n} AS DOUBLE)" for n in ("year", "month", "doy", "dow")}
for _n, _e in _TURNS.items():
    _TIME_COLS[f"{_n}_sin"] = f"sin(2 * pi() * {_e})"
    _TIME_COLS[f"{_n}_cos"] = f"cos(2 * pi() * {_e})"
_DENSE = (*META, "page_rank", *_TIME_COLS, "article_missing")

ORACLES.update({
    "timestamp_features": f"WITH {TIMES} SELECT id, is_missing, " + listed(f"round({e}, 6) AS {n}" for n, e in _TIME_COLS.items()) + " FROM tm",
    "word_ngrams": f"WITH {WORD_GRAMS}, {TERMS} SELECT term, tf, df FROM st",
    "char_wb_ngrams": f"WITH {DOCS}, {char_grams('docs', 3, 5)}, {TERMS} SELECT term, tf, df FROM st",
    "vocabulary": f"""WITH {WORD_GRAMS}, {TERMS} SELECT term, tf, df FROM st WHERE df >= 5 AND df <= 0.95::DOUBLE * (SELECT count(*) FROM dev)
ORDER BY tf DESC, term LIMIT 100000""",
    "tfidf": weighted(WORD_GRAMS, 5, 100000),
    "title_char_tfidf": weighted(f"{_TITLES}, {char_grams('titles', 2, 4)}", 4, 20000),
    "source_binner": f"WITH {DEV}, {KEPT_SOURCES} SELECT id, CASE WHEN {_SRC} IN (SELECT s FROM kept) THEN {_SRC} ELSE '__OTHER__' END AS source_bin FROM dev",
    "source_onehot": f"""WITH {DEV}, {EVA}, {KEPT_SOURCES}, seen AS (SELECT DISTINCT CASE WHEN {_SRC} IN (SELECT s FROM kept) THEN {_SRC} ELSE '__OTHER__' END AS c FROM dev),
 e AS (SELECT id, CASE WHEN {_SRC} IN (SELECT s FROM kept) THEN {_SRC} ELSE '__OTHER__' END AS category FROM eva)
SELECT * FROM e WHERE category IN (SELECT c FROM seen)""",
    "scale_no_mean": f"""WITH {TIMES}, fe AS (SELECT dev.id, {listed(f"CAST({PATTERNS[m]} AS DOUBLE) AS {m}" for m in META)},
 CAST(coalesce(page_rank, 0) AS DOUBLE) AS page_rank, CAST({gone('article')} AS DOUBLE) AS article_missing, is_missing AS timestamp_missing,
 {listed(f"{e} AS {n}" for n, e in _TIME_COLS.items())} FROM dev JOIN tm ON dev.id = tm.id),
 sd AS (SELECT {listed(f"CASE WHEN stddev_pop({c}) > 0 THEN stddev_pop({c}) ELSE 1 END AS s_{c}" for c in _DENSE)} FROM fe)
SELECT id, timestamp_missing, {listed(f"round({c} / s_{c}, 6) AS {c}" for c in _DENSE)} FROM fe, sd""",
    "fitted_cache": f"""WITH {WORD_GRAMS}, {TERMS}, v AS (SELECT term FROM st WHERE df >= 5 AND df <= 0.95::DOUBLE * (SELECT count(*) FROM dev)
 ORDER BY tf DESC, term LIMIT 100000) SELECT (SELECT count(*) FROM dev) AS n_docs, count(*) AS n_terms, TRUE AS found, TRUE AS other_not_found FROM v""",
    "pipeline_model": f"""WITH {DEV}, {KEPT_SOURCES} SELECT id, {text('title')} || ' ' || {text('title')} || ' ' ||
 CASE WHEN {gone('article')} THEN ' __MISSING_ARTICLE__ ' ELSE article END AS joined, CAST({gone('article')} AS DOUBLE) AS article_missing,
 {listed(f"CAST({PATTERNS[m]} AS DOUBLE) AS {m}" for m in META)},
 CASE WHEN {_SRC} IN (SELECT s FROM kept) THEN {_SRC} ELSE '__OTHER__' END AS source_bin, TRUE AS unit_length FROM dev""",
    "feature_cache": f"""WITH {DOCS}, f AS (SELECT id, {FOLD} AS fold FROM dev)
SELECT fold, count(*) AS n, CAST(sum(length(t)) AS BIGINT) AS chars FROM f JOIN docs USING (id) GROUP BY 1""",
})

# Training: rows, folds and classes follow from the tables; the fitted models answer for the booleans
CLEANED = f"{GROUPED}, cleaned AS (SELECT k.* FROM k JOIN g USING (ct, ca) WHERE kinds = 1)"
_CLASSES = "(SELECT CAST(count(DISTINCT label) AS INTEGER) FROM {})"


def _trained():
    return f"{CLEANED} SELECT label, count(*) AS n, true AS converged FROM cleaned GROUP BY 1"


def _folds(cte, table):
    return f"""{cte}, f AS (SELECT {FOLD} AS fold FROM {table})
SELECT fold, count(*) AS n_valid, (SELECT count(*) FROM f) - count(*) AS n_train, true AS in_range, true AS converged FROM f GROUP BY 1"""


_NONZERO = " + ".join(f"CAST({e} <> 0 AS INTEGER)" for e in [
    *[f"CAST({PATTERNS[m]} AS DOUBLE)" for m in META], "CAST(coalesce(page_rank, 0) AS DOUBLE)", *_TIME_COLS.values(),
    f"CAST({gone('article')} AS INTEGER)", "is_missing"])
_WORDS_SET = weighted(WORD_GRAMS, 5, 100000)
_CHARS_SET = weighted(f"{DOCS}, {char_grams('docs', 3, 5)}", 3, 25000)

ORACLES.update({
    "table_profile": """WITH m AS (SELECT CAST('0x' || substr(md5(concat_ws('|', """ + listed(
        f"coalesce(length(CAST({c} AS VARCHAR)) || ':' || {c}, '-')" for c in ("doc_id", "text", "lang", "source", "n_chars")) + """)), 1, 15) AS BIGINT) AS m
 FROM documents) SELECT count(*) AS rows, 5 AS n_cols, 'doc_id bigint, text string, lang string, source string, n_chars bigint' AS columns,
 bit_xor(m) AS fingerprint_xor, CAST(sum(m) AS VARCHAR) AS fingerprint_sum FROM m""",
    "assemble": f"""WITH {TIMES}, nw AS (SELECT id, count(*) AS n FROM ({_WORDS_SET}) GROUP BY 1), nc AS (SELECT id, count(*) AS n FROM ({_CHARS_SET}) GROUP BY 1)
SELECT dev.id, label, CAST(coalesce(nw.n, 0) + coalesce(nc.n, 0) + 1 + {_NONZERO} AS INTEGER) AS n_set,
 CAST((nw.n IS NOT NULL)::INTEGER + (nc.n IS NOT NULL)::INTEGER AS DOUBLE) AS text_norm
FROM dev JOIN tm ON dev.id = tm.id LEFT JOIN nw ON nw.id = dev.id LEFT JOIN nc ON nc.id = dev.id""",
    "train_linearsvc": _trained(),
    "train_logreg": _trained(),
    "train_ridge": _trained(),
    "predict": f"{CLEANED}, {EVA} SELECT id, {_CLASSES.format('cleaned')} AS n_scores, true AS known_class, true AS converged FROM eva",
    "plain_train_predict": f"WITH {DEV}, {EVA} SELECT id, {_CLASSES.format('dev')} AS n_scores, true AS known_class, true AS converged FROM eva",
    "cross_validate": _folds(CLEANED, "cleaned"),
    "plain_cv": _folds(f"WITH {DEV}", "dev"),
    "train_and_score": f"""{KEYED}, g AS (SELECT ct, ca, count(DISTINCT coalesce(CAST(label AS VARCHAR), 'nan')) AS kinds FROM k GROUP BY 1, 2)
SELECT (SELECT count(*) FROM g WHERE kinds = 1 AND NOT EXISTS (SELECT 1 FROM e WHERE e.ct = g.ct AND e.ca = g.ca)) AS n_dev,
 (SELECT count(*) FROM eva) AS n_eval, (SELECT count(*) FROM eva) AS n_scored, true AS converged""",
    "model_save_load": f"WITH {EVA} SELECT count(*) AS n, CAST(0 AS BIGINT) AS differing FROM eva",
})


def _counts(tables):
    return " UNION ALL ".join(f"SELECT '{name}' AS table_name, count(*) AS rows FROM ({sql})" for name, sql in tables.items())


_FREE = ("missingness", "text_missingness", "id_checks", "duplicate_counts", "timestamp_summary", "counts_by_year", "counts_by_hour",
         "text_length_summary", "pattern_prevalence", "source_pagerank", "shortest_longest", "random_sample", "gotchas",
         "table_profile", "categorical_summary", "numeric_summary")
_LABELLED = ("label_summary", "majority_baseline", "missing_article_by_label", "missing_ts_by_label", "label_ts_missingness",
             "label_text_missingness", "label_text_lengths", "label_pattern_prevalence", "label_year_counts", "label_month_counts",
             "top_sources_per_label", "duplicate_groups", "duplicate_groups_near", "cross_label_dup_by_label", "cross_label_examples")
_COMPARED = ("id_overlap", "source_overlap", "unseen_sources", "content_overlap", "js_divergence", "word_len_histogram")
# the same SQL over the other table, under the name of the first
_AS_EVAL = f"dev AS (WITH {EVA} SELECT * FROM eva)"
ORACLES["eda_report"] = _counts(
    {n: ORACLES[n] for n in (*_FREE, *_LABELLED, *_COMPARED)}
    | {f"eval_{n}": ORACLES["missingness_eval"] if n == "missingness" else ORACLES[n].replace(DEV, _AS_EVAL)
       for n in (*_FREE, "word_len_histogram")})
_WEAK = f"WITH {PREDS} SELECT label FROM preds WHERE label IN (0, 1) GROUP BY 1 LIMIT 2"
ORACLES["oof_report"] = _counts({
    "oof_counts": ORACLES["oof_counts"], "pr_summary": ORACLES["pr_summary"], "weak_labels": _WEAK,
    "score_separation": ORACLES["score_separation"], "score_histogram": ORACLES["score_histogram"]})
