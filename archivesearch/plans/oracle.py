"""SQL equivalents (DuckDB dialect) of the registered queries, over the same
parquet tables registered as views. Written independently of the DataFrame
code: windows and joins where the engine uses arrays or executor blocks.
"""

from __future__ import annotations

ORACLE: dict[str, str] = {}

_ARTICLE_VECS = """
  SELECT e.vec_id AS doc_id, e.embedding::DOUBLE[] AS emb
  FROM embeddings e WHERE e.vec_id IN (SELECT doc_id FROM documents WHERE lang = 'en')
"""
_QUERY_VECS = "SELECT vec_id AS query_id, embedding::DOUBLE[] AS qv FROM embeddings"

ORACLE["knn_exact"] = f"""
WITH d AS ({_ARTICLE_VECS}), q AS ({_QUERY_VECS}),
p AS (SELECT q.query_id, d.doc_id, list_distance(q.qv, d.emb) AS dist FROM q, d),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(dist, 9), doc_id) AS rk FROM p)
SELECT query_id, doc_id, round(dist, 6) AS distance, CAST(rk AS BIGINT) AS rank FROM r WHERE rk <= 5
"""

_INDEX = f"""
d AS ({_ARTICLE_VECS}),
cents AS (SELECT vec_id AS cell, embedding::DOUBLE[] AS c FROM embeddings WHERE vec_id < 16),
dc AS (SELECT d.doc_id, d.emb, cents.cell,
              row_number() OVER (PARTITION BY d.doc_id ORDER BY round(list_distance(d.emb, cents.c), 9), cents.cell) AS o
       FROM d, cents),
idx AS (SELECT doc_id, emb, cell FROM dc WHERE o = 1)
"""

# codewords: the 4-number parts of the vectors with vec_id < 256, nearest one (lowest number of a tie) of each part
_CODES = f"""
subs AS (SELECT unnest(range(16)) AS s),
words AS (SELECT s, vec_id AS code, embedding[4 * s + 1:4 * s + 4]::DOUBLE[] AS w FROM embeddings, subs WHERE vec_id < 256),
parts AS (SELECT doc_id, s, emb[4 * s + 1:4 * s + 4] AS x FROM idx, subs),
coded AS (SELECT doc_id, s, min(struct_pack(d := round(list_distance(x, w), 9), code := code)).code AS code
          FROM parts JOIN words USING (s) GROUP BY doc_id, s)
"""

ORACLE["vector_index_build"] = f"""
WITH {_INDEX}, {_CODES}
SELECT idx.doc_id, CAST(cell AS BIGINT) AS cell, string_agg(printf('%02x', code), '' ORDER BY s) AS code
FROM idx JOIN coded ON coded.doc_id = idx.doc_id GROUP BY idx.doc_id, cell
"""

ORACLE["vector_index_sizes"] = f"""
WITH {_INDEX}
SELECT 'Article' AS kind, CAST(cell AS BIGINT) AS cell, count(*) AS n FROM idx GROUP BY cell
"""

ORACLE["knn_ivf"] = f"""
WITH {_INDEX}, {_CODES},
q AS ({_QUERY_VECS}),
sizes AS (SELECT cell, count(*) AS n FROM idx GROUP BY cell),
qc AS (SELECT q.query_id, cents.cell, s.n, round(list_distance(q.qv, cents.c), 9) AS cd
       FROM q, cents JOIN sizes s ON s.cell = cents.cell),
cum AS (SELECT *, sum(n) OVER (PARTITION BY query_id ORDER BY cd, cell
                               ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cs FROM qc),
probe AS (SELECT query_id, cell FROM cum WHERE cs - n < 0.8 * (SELECT count(*) FROM idx)),
look AS (SELECT q.query_id, words.s, words.code, list_distance(qv[4 * words.s + 1:4 * words.s + 4], w) ** 2 AS sq FROM q, words),
far AS (SELECT probe.query_id, idx.doc_id, round(sum(look.sq), 9) AS far
        FROM probe JOIN idx ON idx.cell = probe.cell JOIN coded ON coded.doc_id = idx.doc_id
        JOIN look ON look.query_id = probe.query_id AND look.s = coded.s AND look.code = coded.code
        GROUP BY probe.query_id, idx.doc_id),
cand AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY far, doc_id) AS place FROM far),
p AS (SELECT cand.query_id, idx.doc_id, list_distance(q.qv, idx.emb) AS dist
      FROM cand JOIN idx ON idx.doc_id = cand.doc_id JOIN q ON q.query_id = cand.query_id WHERE place <= 100),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(dist, 9), doc_id) AS rk FROM p)
SELECT query_id, doc_id, round(dist, 6) AS distance, CAST(rk AS BIGINT) AS rank FROM r WHERE rk <= 5
"""


# ------------------------------------------------------------------ text

from archivesearch.functions.stopwords import sql_list  # noqa: E402
from archivesearch.functions.text import HIGHLIGHT_CLOSE, HIGHLIGHT_OPEN  # noqa: E402

STOP = f"({sql_list()})"
CTX = "[()?!.,]"


def _sentence_list(text: str) -> str:
    return (f"list_filter(string_split_regex(regexp_replace({text}, '([.!?])\\s+', '\\1' || chr(1), 'g'),"
            f" '[' || chr(1) || '\\n]'), lambda s: regexp_matches(s, '\\S'))")


def _clean_query(q: str) -> str:
    return (f"array_to_string(list_filter(string_split(trim(regexp_replace(lower({q}), '[^a-z]+', ' ', 'g')), ' '),"
            f" lambda w: w <> '' AND NOT list_contains([{sql_list()}], w)), ' ')")


def _clean_text(t: str) -> str:
    return f"trim(regexp_replace({t}, '[^0-9a-zA-Z]+', ' ', 'g'))"


def yake_ctes(src: str, p: str) -> str:
    """CTEs ``{p}sent, {p}tok, {p}terms, {p}cand, {p}score, {p}top`` over
    ``src`` (a SELECT yielding id, text)."""
    elig = "(length({0}) > 1 AND NOT regexp_full_match({0}, '[0-9]+'))"
    return f"""
{p}src AS ({src}),
{p}sa AS (SELECT id, {_sentence_list('text')} AS arr FROM {p}src WHERE text IS NOT NULL),
{p}nsent AS (SELECT id, len(arr) AS n_sent FROM {p}sa),
{p}sent AS (SELECT id, unnest(arr) AS s, unnest(range(len(arr))) AS sent FROM {p}sa),
{p}raw AS (SELECT id, sent, unnest(tl) AS raw, unnest(range(len(tl))) AS pos
           FROM (SELECT id, sent, list_filter(string_split_regex(s, '\\s+'), lambda t: t <> '') AS tl FROM {p}sent)),
{p}t0 AS (SELECT id, sent, pos,
                 regexp_replace(regexp_replace(raw, '^{CTX}+', ''), '{CTX}+$', '') AS word,
                 regexp_matches(raw, '^{CTX}') AS lb, regexp_matches(raw, '{CTX}$') AS tb FROM {p}raw),
{p}t1 AS (SELECT *, lower(word) AS term,
                 (word <> '' AND lead(word) OVER w <> '' AND NOT tb AND NOT lead(lb) OVER w) AS conn
          FROM {p}t0 WINDOW w AS (PARTITION BY id, sent ORDER BY pos)),
{p}t2 AS (SELECT id, sent, pos, word, term,
                 CASE WHEN lag(conn) OVER w THEN lag(term) OVER w END AS lft,
                 CASE WHEN conn THEN lead(term) OVER w END AS rgt,
                 CASE WHEN conn AND lead(conn) OVER w THEN lead(term, 2) OVER w END AS rgt2
          FROM {p}t1 WINDOW w AS (PARTITION BY id, sent ORDER BY pos)),
{p}tok AS (SELECT *,
                  (length(word) > 1 AND regexp_matches(word, '\\p{{Lu}}') AND NOT regexp_matches(word, '\\p{{Ll}}')) AS acr
           FROM {p}t2 WHERE word <> ''),
{p}terms0 AS (SELECT id, term, count(*) AS tf,
                     count(*) FILTER (WHERE acr) AS tf_acr,
                     count(*) FILTER (WHERE pos > 0 AND regexp_matches(word, '^\\p{{Lu}}') AND NOT acr) AS tf_cap,
                     quantile_cont(sent, 0.5) AS med,
                     count(DISTINCT sent) AS nst, count(DISTINCT lft) AS dln, count(lft) AS dld,
                     count(DISTINCT rgt) AS drn, count(rgt) AS drd
              FROM {p}tok GROUP BY id, term),
{p}terms1 AS (SELECT t.*, n.n_sent,
                     avg(CASE WHEN t.term NOT IN {STOP} THEN tf END) OVER (PARTITION BY t.id) AS mean_tf,
                     stddev_pop(CASE WHEN t.term NOT IN {STOP} THEN tf END) OVER (PARTITION BY t.id) AS std_tf,
                     max(tf) OVER (PARTITION BY t.id) AS max_tf
              FROM {p}terms0 t JOIN {p}nsent n ON n.id = t.id),
{p}terms2 AS (SELECT *,
                     greatest(tf_acr, tf_cap) / (1.0 + ln(tf)) AS f_case,
                     ln(ln(3.0 + med)) AS f_pos,
                     tf / nullif(mean_tf + coalesce(std_tf, 0.0), 0.0) AS f_freq,
                     1.0 + (coalesce(dln / nullif(dld, 0), 0.0) + coalesce(drn / nullif(drd, 0), 0.0)) * tf / max_tf AS f_rel,
                     nst / n_sent AS f_spread
              FROM {p}terms1),
{p}terms AS (SELECT id, term, tf,
                    f_rel * f_pos / (f_case + coalesce(f_freq, 0.0) / f_rel + f_spread / f_rel) AS s_term
             FROM {p}terms2),
{p}occ AS (
  SELECT id, sent, 1 AS n, term AS kw, term AS t1, NULL::VARCHAR AS t2, NULL::VARCHAR AS t3 FROM {p}tok
    WHERE {elig.format('term')} AND term NOT IN {STOP}
  UNION ALL
  SELECT id, sent, 2, term || ' ' || rgt, term, rgt, NULL FROM {p}tok
    WHERE {elig.format('term')} AND term NOT IN {STOP} AND rgt IS NOT NULL AND {elig.format('rgt')} AND rgt NOT IN {STOP}
  UNION ALL
  SELECT id, sent, 3, term || ' ' || rgt || ' ' || rgt2, term, rgt, rgt2 FROM {p}tok
    WHERE {elig.format('term')} AND term NOT IN {STOP} AND rgt IS NOT NULL AND rgt2 IS NOT NULL
      AND {elig.format('rgt')} AND {elig.format('rgt2')} AND rgt2 NOT IN {STOP}),
{p}cand AS (SELECT id, kw, count(*) AS tf_kw, min(sent) AS sentence, any_value(n) AS n,
                   any_value(t1) AS t1, any_value(t2) AS t2, any_value(t3) AS t3
            FROM {p}occ GROUP BY id, kw),
{p}comp AS (SELECT id, kw, t1 AS term FROM {p}cand
            UNION ALL SELECT id, kw, t2 FROM {p}cand WHERE t2 IS NOT NULL AND NOT (n = 3 AND t2 IN {STOP})
            UNION ALL SELECT id, kw, t3 FROM {p}cand WHERE t3 IS NOT NULL),
{p}aggs AS (SELECT c.id, c.kw, sum(ln(s.s_term)) AS lp, sum(s.s_term) AS ss
            FROM {p}comp c JOIN {p}terms s ON s.id = c.id AND s.term = c.term GROUP BY c.id, c.kw),
{p}bi AS (SELECT id, term AS a, rgt AS b, count(*) AS n_ab FROM {p}tok WHERE rgt IS NOT NULL GROUP BY id, term, rgt),
{p}f AS (SELECT bi.id, bi.a, bi.b, bi.n_ab / t.tf AS f FROM {p}bi bi JOIN {p}terms0 t ON t.id = bi.id AND t.term = bi.a),
{p}mid AS (SELECT c.id, c.kw, 1.0 - f1.f * f2.f AS q FROM {p}cand c
           JOIN {p}f f1 ON f1.id = c.id AND f1.a = c.t1 AND f1.b = c.t2
           JOIN {p}f f2 ON f2.id = c.id AND f2.a = c.t2 AND f2.b = c.t3
           WHERE c.n = 3 AND c.t2 IN {STOP}),
{p}score AS (SELECT c.id, c.kw AS result, c.n, c.tf_kw, c.sentence,
                    a.lp + ln(1.0 + coalesce(m.q, 0.0)) - ln(c.tf_kw) - ln(1.0 + a.ss - coalesce(m.q, 0.0)) AS ln_score
             FROM {p}cand c JOIN {p}aggs a ON a.id = c.id AND a.kw = c.kw
             LEFT JOIN {p}mid m ON m.id = c.id AND m.kw = c.kw),
{p}top AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY round(ln_score, 9), result) AS kw_rank
                          FROM {p}score) WHERE kw_rank <= 20)
"""


_DOCS = "SELECT doc_id AS id, text FROM documents"
_QUERIES = "SELECT item_id AS id, text FROM benchmark"

ORACLE["sentences"] = f"""
WITH {yake_ctes(_DOCS, 'd_').split(',' + chr(10) + 'd_raw')[0]}
SELECT id AS doc_id, CAST(sent AS BIGINT) AS sent, s AS sentence FROM d_sent
"""

ORACLE["tokens"] = f"""
WITH {yake_ctes(_DOCS, 'd_')},
ch AS (SELECT id, sent, pos, word, term, lft, rgt,
              sum(CASE WHEN pos > 0 AND NOT coalesce(pconn, false) THEN 1 ELSE 0 END)
                OVER (PARTITION BY id, sent ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS chunk
       FROM (SELECT *, lag(NOT tb AND NOT nlb) OVER (PARTITION BY id, sent ORDER BY pos) AS pconn
             FROM (SELECT t0.*, lead(lb) OVER (PARTITION BY id, sent ORDER BY pos) AS nlb, t2.lft, t2.rgt, t2.term
                   FROM d_t0 t0 JOIN d_t2 t2 USING (id, sent, pos))))
SELECT id AS doc_id, CAST(sent AS BIGINT) AS sent, CAST(chunk AS BIGINT) AS chunk,
       CAST(pos - min(pos) OVER (PARTITION BY id, sent, chunk) AS BIGINT) AS idx, term, lft, rgt
FROM ch WHERE word <> ''
"""

_PLAIN = "list_filter(string_split_regex(lower(text), '[^\\p{L}\\p{N}]+'), lambda t: t <> '')"

ORACLE["plain_tokens"] = f"""
WITH a AS (SELECT doc_id, {_PLAIN} AS arr FROM documents)
SELECT doc_id, CAST(unnest(range(len(arr))) AS BIGINT) AS pos, unnest(arr) AS token FROM a
"""

ORACLE["stopword_filter"] = f"""
WITH a AS (SELECT doc_id, list_filter({_PLAIN}, lambda w: NOT list_contains([{sql_list()}], w)) AS arr FROM documents)
SELECT doc_id, CAST(unnest(range(len(arr))) AS BIGINT) AS pos, unnest(arr) AS token FROM a
"""

ORACLE["ngrams"] = f"""
WITH {yake_ctes(_DOCS, 'd_')}
SELECT id AS doc_id, kw AS result, CAST(n AS BIGINT) AS n, tf_kw, CAST(sentence AS BIGINT) AS sentence FROM d_cand
"""

ORACLE["yake_terms"] = f"""
WITH {yake_ctes(_DOCS, 'd_')}
SELECT id AS doc_id, term, tf, round(ln(s_term), 6) AS ln_s FROM d_terms
"""

ORACLE["yake_keywords"] = f"""
WITH {yake_ctes(_DOCS, 'd_')}
SELECT id AS doc_id, result, round(ln_score, 6) AS ln_score, CAST(sentence AS BIGINT) AS sentence,
       CAST(kw_rank AS BIGINT) AS kw_rank FROM d_top
"""

ORACLE["keywords_nested"] = f"""
WITH {yake_ctes(_DOCS, 'd_')}
SELECT d.doc_id, CAST(t.kw_rank - 1 AS BIGINT) AS kpos, t.result
FROM documents d LEFT JOIN d_top t ON t.id = d.doc_id
"""

ORACLE["query_keywords"] = f"""
WITH {yake_ctes(_QUERIES, 'q_')}
SELECT id AS query_id, result, CAST(kw_rank AS BIGINT) AS kw_rank FROM q_top
"""

ORACLE["clean_query"] = f"""
SELECT item_id AS query_id, {_clean_query('text')} AS cleaned FROM benchmark
"""

ORACLE["clean_text"] = f"""
SELECT doc_id, {_clean_text('text')} AS cleaned FROM documents
"""

_TITLE_RE = f"""
SELECT doc_id, {_clean_text('d.text')} AS ctext, replace({_clean_query('q.text')}, ' ', '|') AS re
FROM documents d JOIN benchmark q ON q.item_id = d.doc_id % (SELECT count(*) FROM benchmark)
"""


def _hl_sql(block: str, re: str) -> str:
    return (f"CASE WHEN coalesce({re}, '') = '' THEN {block} ELSE regexp_replace({block}, '(?i)(' || {re} || ')', "
            f"'{HIGHLIGHT_OPEN.replace(chr(39), chr(39) * 2)}\\1{HIGHLIGHT_CLOSE}', 'g') END")


ORACLE["highlight"] = f"""
WITH d AS ({_TITLE_RE})
SELECT doc_id, re, {_hl_sql('ctext', 're')} AS highlighted FROM d
"""

ORACLE["snippet"] = f"""
WITH d AS ({_TITLE_RE}),
m AS (SELECT *, re <> '' AND regexp_matches(ctext, '(?i)(' || re || ')') AS has,
             length(regexp_extract(ctext, '(?is)^(.*?)(' || re || ')', 1)) AS st,
             length(regexp_extract(ctext, '(?i)(' || re || ')', 1)) AS ml FROM d),
c AS (SELECT *, greatest(st - 200, 0) AS cs, least(st + ml + 200, length(ctext)) AS ce FROM m)
SELECT doc_id, re,
       CASE WHEN has THEN {_hl_sql('substring(ctext, cs + 1, ce - cs)', 're')}
            ELSE substring(ctext, 1, 200) END AS snippet
FROM c
"""


# ------------------------------------------------------------------ search

_ARTICLE_TEXTS = "SELECT doc_id AS id, text FROM documents WHERE lang = 'en'"
_CLEAN_QUERIES = f"SELECT item_id AS id, {_clean_query('text')} AS text FROM benchmark"

ORACLE["filter_object_type"] = """
SELECT doc_id, substring(text, 1, 40) AS record_title FROM documents WHERE lang = 'en'
"""

_KS = yake_ctes(_ARTICLE_TEXTS, "k_")
_ALL_TEXTS = "SELECT doc_id AS id, text FROM documents"
_KA = yake_ctes(_ALL_TEXTS, "k_")  # of every document
_QS = yake_ctes(_QUERIES, "q_")
_QC = yake_ctes(_CLEAN_QUERIES, "c_")

ORACLE["project_nested"] = f"""
WITH {_KA}
SELECT d.doc_id, string_agg(t.result, '|' ORDER BY t.kw_rank) AS results, CAST(count(t.result) AS BIGINT) AS n_scores
FROM documents d LEFT JOIN k_top t ON t.id = d.doc_id GROUP BY d.doc_id
"""
ORACLE["project_nested"] = ORACLE["project_nested"].replace(
    "CAST(count(t.result) AS BIGINT) AS n_scores",
    "CASE WHEN count(t.result) = 0 THEN NULL ELSE CAST(count(t.result) AS BIGINT) END AS n_scores")

ORACLE["unnest_keywords"] = f"""
WITH {_KA}
SELECT id AS doc_id, result, round(ln_score, 6) AS ln_score FROM k_top
"""

_QN = "qn AS (SELECT DISTINCT id AS query_id, result FROM q_top)"
_QNC = "qn AS (SELECT DISTINCT id AS query_id, result FROM c_top)"

ORACLE["match_ngrams"] = f"""
WITH {_KS}, {_QS}, {_QN}
SELECT qn.query_id, k.id AS doc_id, k.result FROM k_top k JOIN qn ON qn.result = k.result
"""

ORACLE["distinct_matches"] = f"""
WITH {_KS}, {_QS}, {_QN}
SELECT DISTINCT qn.query_id, k.id AS doc_id, k.result, round(k.ln_score, 6) AS ln_score
FROM k_top k JOIN qn ON qn.result = k.result
"""

ORACLE["matched_set"] = f"""
WITH {_KS}, {_QS}, {_QN}
SELECT qn.query_id, k.id AS doc_id, array_to_string(list_sort(list(DISTINCT k.result)), '|') AS keywords
FROM k_top k JOIN qn ON qn.result = k.result GROUP BY qn.query_id, k.id
"""

ORACLE["reciprocal_score"] = f"""
WITH {_KA}
SELECT id AS doc_id, result,
       round(ln(1.0 / coalesce(nullif(TRY_CAST(CAST(exp(ln_score) AS VARCHAR) AS DOUBLE), 0.0), 1e7)), 6) AS ln_recip
FROM k_top
"""


def _l1_sql(qn: str) -> str:
    return f"""{qn},
l1m AS (SELECT DISTINCT qn.query_id, k.id AS doc_id, k.result, exp(k.ln_score) AS score
        FROM k_top k JOIN qn ON qn.result = k.result),
l1a AS (SELECT query_id, doc_id, sum(1.0 / coalesce(nullif(score, 0.0), 1e7)) AS s,
               array_to_string(list_sort(list(DISTINCT result)), '|') AS keywords
        FROM l1m GROUP BY query_id, doc_id),
l1 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(ln(s), 9) DESC, doc_id) AS rk
                      FROM l1a) WHERE rk <= 5)"""


ORACLE["search_keyword"] = f"""
WITH {_KS}, {_QS}, {_l1_sql(_QN)}
SELECT query_id, doc_id, round(ln(s), 6) AS ln_score, keywords, CAST(rk AS BIGINT) AS rank FROM l1
"""

ORACLE["topk_per_query"] = f"""
WITH {_KS}, {_QS}, {_l1_sql(_QN)}
SELECT query_id, doc_id, CAST(rk AS BIGINT) AS rank FROM l1
"""

ORACLE["topk_global"] = f"""
WITH {_KA}
SELECT id AS doc_id, result, round(ln_score, 6) AS ln_score FROM k_top
ORDER BY round(ln_score, 9), id, result LIMIT 5
"""


_SUB_PHRASES = """
bkw AS (SELECT id AS doc_id, result, string_split(result, ' ') AS w FROM k_top),
bdl AS (SELECT doc_id, sum(len(w)) AS dl FROM bkw GROUP BY doc_id),
bst AS (SELECT CAST(count(*) AS DOUBLE) AS n_docs, avg(dl) AS avgdl FROM bdl),
bsp AS (SELECT doc_id, w[1] AS phrase FROM bkw
        UNION ALL SELECT doc_id, w[2] FROM bkw WHERE len(w) >= 2
        UNION ALL SELECT doc_id, w[3] FROM bkw WHERE len(w) >= 3
        UNION ALL SELECT doc_id, w[1] || ' ' || w[2] FROM bkw WHERE len(w) >= 2
        UNION ALL SELECT doc_id, w[2] || ' ' || w[3] FROM bkw WHERE len(w) >= 3
        UNION ALL SELECT doc_id, w[1] || ' ' || w[2] || ' ' || w[3] FROM bkw WHERE len(w) >= 3)"""


def _bm25_sql(qn: str) -> str:
    return f"""{qn},
{_SUB_PHRASES},
btf AS (SELECT qn.query_id, bsp.phrase, bsp.doc_id, count(*) AS tf
        FROM bsp JOIN qn ON qn.result = bsp.phrase GROUP BY qn.query_id, bsp.phrase, bsp.doc_id),
bdf AS (SELECT query_id, phrase, count(*) AS df FROM btf GROUP BY query_id, phrase),
bpart AS (SELECT btf.query_id, btf.doc_id,
                 ln(1.0 + (bst.n_docs - bdf.df + 0.5) / (bdf.df + 0.5)) * btf.tf * 2.2
                 / (btf.tf + 1.2 * (0.25 + 0.75 * bdl.dl / bst.avgdl)) AS s
          FROM btf JOIN bdf ON bdf.query_id = btf.query_id AND bdf.phrase = btf.phrase
          JOIN bdl ON bdl.doc_id = btf.doc_id, bst),
bsum AS (SELECT query_id, doc_id, sum(s) AS score FROM bpart GROUP BY query_id, doc_id),
bm25 AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, doc_id) AS rk
                        FROM bsum) WHERE rk <= 5)"""


ORACLE["collection_postings"] = f"""
WITH {_KS}, {_SUB_PHRASES}
SELECT phrase, bsp.doc_id, count(*) AS tf, CAST(any_value(dl) AS BIGINT) AS dl FROM bsp JOIN bdl ON bdl.doc_id = bsp.doc_id
GROUP BY phrase, bsp.doc_id
"""

ORACLE["collection_phrases"] = f"""
WITH {_KS}, {_SUB_PHRASES}
SELECT phrase, count(DISTINCT doc_id) AS df FROM bsp GROUP BY phrase
"""

ORACLE["collection_build"] = f"""
WITH {_KA}
SELECT lang = 'en' AS is_article, count(DISTINCT doc_id) AS n_docs,
       CAST(sum(len(string_split(k_top.result, ' '))) AS BIGINT) AS dl
FROM k_top JOIN documents ON doc_id = id GROUP BY 1
"""

ORACLE["search_phrase_bm25"] = f"""
WITH {_KS}, {_QS}, {_bm25_sql(_QN)}
SELECT query_id, doc_id, round(score, 6) AS score, CAST(rk AS BIGINT) AS rank FROM bm25
"""

_HEXV = "(instr('0123456789abcdef', substr(md5(word), {0}, 1)) - 1)"
_WV = f"""
wv AS (SELECT word, list_transform(range(16), lambda i: sqrt(({_HEXV.format('2 * i + 1')} * 16 + {_HEXV.format('2 * i + 2')}) / 255.0) - 0.5) AS vec
       FROM (SELECT DISTINCT unnest({_PLAIN}) AS word FROM (SELECT text FROM documents UNION ALL SELECT text FROM benchmark)))
"""


def _embed_sql(name: str, src: str) -> str:
    """{name}: (id, dim, val) weighted mean of word vectors; {name}_v: (id, vec list)."""
    return f"""
{name}_tc AS (SELECT id, word, count(*) AS cnt FROM (SELECT id, unnest({_PLAIN}) AS word FROM ({src})) GROUP BY id, word),
{name}_ev AS (SELECT t.id, t.cnt, unnest(wv.vec) AS v, unnest(range(16)) AS dim FROM {name}_tc t JOIN wv ON wv.word = t.word),
{name} AS (SELECT id, dim, sum(cnt * v) / sum(cnt) AS val FROM {name}_ev GROUP BY id, dim),
{name}_v AS (SELECT id, list(val ORDER BY dim) AS vec FROM {name} GROUP BY id)"""


ORACLE["embed_from_table"] = f"""
WITH {_WV}, {_embed_sql('e', 'SELECT doc_id AS id, text FROM documents')}
SELECT d.doc_id, CAST(e.dim AS BIGINT) AS dim, round(e.val, 6) + 0.0 AS value
FROM documents d LEFT JOIN e ON e.id = d.doc_id
"""

ORACLE["embed_finish"] = f"""
WITH {_WV}, {_embed_sql('e', 'SELECT doc_id AS id, text FROM documents')}
SELECT id AS doc_id, CAST(dim AS BIGINT) AS dim, round(CAST(CAST(val AS FLOAT) AS DOUBLE), 6) + 0.0 AS value FROM e
"""

_VARM = f"""
{_WV}, {_embed_sql('de', _ARTICLE_TEXTS)}, {_embed_sql('qe', _CLEAN_QUERIES)},
vp AS (SELECT q.id AS query_id, d.id AS doc_id, list_distance(q.vec, d.vec) AS dist FROM qe_v q, de_v d),
varm AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(dist, 9), doc_id) AS rk
                        FROM vp) WHERE rk <= 5)
"""
_KARM = f"{_KS}, {_QC}, {_bm25_sql(_QNC)}"
_ARMS = f"""{_VARM}, {_KARM},
va AS (SELECT query_id, doc_id, 1.0 / (rk - 1 + 61 + 1) AS vs_score FROM varm),
ka AS (SELECT query_id, doc_id, 1.0 / (rk - 1 + 60 + 1) AS kw_score FROM bm25),
un AS (SELECT query_id, doc_id, vs_score, NULL::DOUBLE AS kw_score FROM va
       UNION ALL SELECT query_id, doc_id, NULL, kw_score FROM ka),
mg AS (SELECT query_id, doc_id, coalesce(max(vs_score), 0.0) AS vs_score, coalesce(max(kw_score), 0.0) AS kw_score
       FROM un GROUP BY query_id, doc_id),
fu AS (SELECT * FROM (SELECT *, vs_score + kw_score AS score,
                             row_number() OVER (PARTITION BY query_id ORDER BY round(vs_score + kw_score, 9) DESC, doc_id) AS rk
                      FROM mg) WHERE rk <= 5)"""

ORACLE["arm_rank"] = f"""
WITH {_VARM}
SELECT query_id, doc_id, CAST(rk - 1 AS BIGINT) AS arm_rank FROM varm
"""

ORACLE["rrf_contribution"] = f"""
WITH {_ARMS}
SELECT query_id, doc_id, 'vector' AS arm, round(vs_score, 6) AS contribution FROM va
UNION ALL SELECT query_id, doc_id, 'keyword', round(kw_score, 6) FROM ka
"""

ORACLE["union_arms"] = f"""
WITH {_ARMS}
SELECT query_id, doc_id, round(vs_score, 6) AS vs_score, round(kw_score, 6) AS kw_score FROM un
"""

ORACLE["merge_arms"] = f"""
WITH {_ARMS}
SELECT query_id, doc_id, round(vs_score, 6) AS vs_score, round(kw_score, 6) AS kw_score FROM mg
"""

ORACLE["search_hybrid"] = f"""
WITH {_ARMS}
SELECT query_id, doc_id, round(vs_score, 6) AS vs_score, round(kw_score, 6) AS kw_score,
       round(score, 6) AS score, CAST(rk AS BIGINT) AS rank FROM fu
"""

# vector arm of the candidate budget: 16 cells and 64 codewords from the first documents, 4 parts of 4 numbers
_IVF_ARM = f"""
{_WV}, {_embed_sql('de', _ARTICLE_TEXTS)}, {_embed_sql('qe', _CLEAN_QUERIES)},
ino AS (SELECT id AS doc_id, vec, row_number() OVER (ORDER BY id) - 1 AS no FROM de_v),
icd AS (SELECT d.doc_id, d.vec, c.no AS cell, row_number() OVER (
          PARTITION BY d.doc_id ORDER BY round(list_distance(d.vec, c.vec), 9), c.no) AS o FROM ino d JOIN ino c ON c.no < 16),
iix AS (SELECT doc_id, vec, cell FROM icd WHERE o = 1),
isub AS (SELECT unnest(range(4)) AS s),
iwd AS (SELECT s, no AS code, vec[4 * s + 1:4 * s + 4] AS w FROM ino, isub WHERE no < 64),
ico AS (SELECT doc_id, i.s, min(struct_pack(d := round(list_distance(vec[4 * i.s + 1:4 * i.s + 4], w), 9), code := code)).code AS code
        FROM iix, isub i JOIN iwd ON iwd.s = i.s GROUP BY doc_id, i.s),
isz AS (SELECT cell, count(*) AS n FROM iix GROUP BY cell),
iqc AS (SELECT q.id AS query_id, c.no AS cell, n, round(list_distance(q.vec, c.vec), 9) AS cd
        FROM qe_v q, ino c JOIN isz ON isz.cell = c.no),
icu AS (SELECT *, sum(n) OVER (PARTITION BY query_id ORDER BY cd, cell ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cs FROM iqc),
ilk AS (SELECT q.id AS query_id, s, code, list_distance(q.vec[4 * s + 1:4 * s + 4], w) ** 2 AS sq FROM qe_v q, iwd),
ifr AS (SELECT icu.query_id, iix.doc_id, round(sum(ilk.sq), 9) AS far FROM icu JOIN iix ON iix.cell = icu.cell
        JOIN ico ON ico.doc_id = iix.doc_id JOIN ilk ON ilk.query_id = icu.query_id AND ilk.s = ico.s AND ilk.code = ico.code
        WHERE cs - n < 0.5 * (SELECT count(*) FROM iix) GROUP BY icu.query_id, iix.doc_id),
ica AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY far, doc_id) AS place FROM ifr),
varm AS (SELECT * FROM (SELECT ica.query_id, ica.doc_id, row_number() OVER (
           PARTITION BY ica.query_id ORDER BY round(list_distance(q.vec, iix.vec), 9), ica.doc_id) AS rk
         FROM ica JOIN iix ON iix.doc_id = ica.doc_id JOIN qe_v q ON q.id = ica.query_id WHERE place <= 100) WHERE rk <= 5)
"""

ORACLE["search_hybrid_ivf"] = ORACLE["search_hybrid"].replace(_VARM, _IVF_ARM)

ORACLE["rrf_three_arms"] = f"""
WITH {_ARMS}, {_l1_sql(_QNC.replace('qn AS', 'qn2 AS')).replace('JOIN qn ON qn.', 'JOIN qn2 ON qn2.').replace('qn.query_id', 'qn2.query_id')},
la AS (SELECT query_id, doc_id, 1.0 / (rk - 1 + 60 + 1) AS l1_score FROM l1),
un3 AS (SELECT query_id, doc_id, vs_score, NULL::DOUBLE AS kw_score, NULL::DOUBLE AS l1_score FROM va
        UNION ALL SELECT query_id, doc_id, NULL, kw_score, NULL FROM ka
        UNION ALL SELECT query_id, doc_id, NULL, NULL, l1_score FROM la),
mg3 AS (SELECT query_id, doc_id, coalesce(max(vs_score), 0.0) AS vs_score, coalesce(max(kw_score), 0.0) AS kw_score,
               coalesce(max(l1_score), 0.0) AS l1_score FROM un3 GROUP BY query_id, doc_id),
fu3 AS (SELECT * FROM (SELECT *, vs_score + kw_score + l1_score AS score,
                              row_number() OVER (PARTITION BY query_id ORDER BY round(vs_score + kw_score + l1_score, 9) DESC, doc_id) AS rk
                       FROM mg3) WHERE rk <= 5)
SELECT query_id, doc_id, round(vs_score, 6) AS vs_score, round(kw_score, 6) AS kw_score, round(l1_score, 6) AS l1_score,
       round(score, 6) AS score, CAST(rk AS BIGINT) AS rank FROM fu3
"""


# ------------------------------------------------------------------ results

ORACLE["fetch_ranked"] = f"""
WITH {_ARMS}
SELECT fu.query_id, CAST(fu.rk AS BIGINT) AS rank, fu.doc_id, substring(d.text, 1, 40) AS record_title,
       d.source AS publisher
FROM fu JOIN documents d ON d.doc_id = fu.doc_id
"""

_SHARE = """CAST(CASE WHEN vs_score = 0 THEN 0 WHEN kw_score = 0 THEN 100
                 ELSE round_even(100.0 * vs_score / score, 0) END AS BIGINT) AS vec_pct,
            CAST(CASE WHEN vs_score = 0 THEN 100 WHEN kw_score = 0 THEN 0
                 ELSE 100 - round_even(100.0 * vs_score / score, 0) END AS BIGINT) AS kw_pct"""

ORACLE["fusion_share"] = f"""
WITH {_ARMS}
SELECT query_id, doc_id, {_SHARE} FROM fu
"""

ORACLE["search_results"] = f"""
WITH {_ARMS},
qr AS (SELECT item_id AS query_id, replace({_clean_query('text')}, ' ', '|') AS re FROM benchmark),
j AS (SELECT fu.*, qr.re, substring(d.text, 1, 40) AS record_title, d.source AS publisher,
             {_clean_text('d.text')} AS ctext
      FROM fu JOIN qr ON qr.query_id = fu.query_id JOIN documents d ON d.doc_id = fu.doc_id),
m AS (SELECT *, re <> '' AND regexp_matches(ctext, '(?i)(' || re || ')') AS has,
             length(regexp_extract(ctext, '(?is)^(.*?)(' || re || ')', 1)) AS st,
             length(regexp_extract(ctext, '(?i)(' || re || ')', 1)) AS ml FROM j),
c AS (SELECT *, greatest(st - 200, 0) AS cs, least(st + ml + 200, length(ctext)) AS ce FROM m)
SELECT query_id, CAST(rk AS BIGINT) AS rank, doc_id, record_title,
       CASE WHEN has THEN {_hl_sql('substring(ctext, cs + 1, ce - cs)', 're')} ELSE substring(ctext, 1, 200) END AS snippet,
       publisher, '1970-01-01' AS alpha_pub_date, {_SHARE},
       {_hl_sql('ctext', 're')} AS highlighted
FROM c
"""

ORACLE["query_status"] = f"""
WITH {_ARMS},
h AS (SELECT query_id, count(*) AS n FROM fu GROUP BY query_id),
q AS (SELECT item_id AS query_id, {_clean_query('text')} AS cleaned FROM benchmark)
SELECT q.query_id, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hits,
       CASE WHEN q.cleaned = '' THEN 'EMPTY_QUERY' WHEN coalesce(h.n, 0) = 0 THEN 'NO_RESULTS' ELSE 'OK' END AS status
FROM q LEFT JOIN h ON h.query_id = q.query_id
"""

ORACLE["annotate_articles"] = f"""
WITH {_KA}, {_WV}, {_embed_sql('de', _ALL_TEXTS)},
nk AS (SELECT id, count(*) AS n FROM k_top GROUP BY id),
nd AS (SELECT id, count(*) AS n FROM de GROUP BY id)
SELECT d.doc_id, CAST(coalesce(nk.n, 0) AS BIGINT) AS n_keywords, CAST(coalesce(nd.n, 0) AS BIGINT) AS dims
FROM documents d LEFT JOIN nk ON nk.id = d.doc_id LEFT JOIN nd ON nd.id = d.doc_id
"""


# ------------------------------------------------------------------ ingest

_MEMBERS = """
mc AS (SELECT source, CAST(ceil(count(*) / 10000.0) AS BIGINT) AS np FROM documents GROUP BY source),
mem AS (SELECT d.doc_id, d.source || '-' || CAST(d.doc_id % mc.np AS VARCHAR) || '.zip' AS zip_file,
               CAST(d.doc_id AS VARCHAR) || '.xml' AS member
        FROM documents d JOIN mc ON mc.source = d.source)
"""


def _sample_sql(samplesize: int | None, batchsize: int) -> str:
    return f"""{_MEMBERS},
na AS (SELECT count(DISTINCT zip_file) AS na FROM mem),
hm AS (SELECT doc_id, zip_file, member, md5(concat_ws('|', '42', zip_file, member)) AS h FROM mem),
rk AS (SELECT *, row_number() OVER (PARTITION BY zip_file ORDER BY h, member) - 1 AS in_zip_rank FROM hm),
smp AS (SELECT rk.* FROM rk, na WHERE {f"in_zip_rank < floor({samplesize} / na.na)" if samplesize else "true"}),
zc AS (SELECT zip_file, count(*) AS n FROM smp GROUP BY zip_file),
zo AS (SELECT zip_file, coalesce(sum(n) OVER (ORDER BY zip_file ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS off FROM zc),
bat AS (SELECT smp.*, CAST(zo.off + smp.in_zip_rank AS BIGINT) AS rn,
               CAST(floor((zo.off + smp.in_zip_rank) / {batchsize}) AS BIGINT) AS batch_no
        FROM smp JOIN zo ON zo.zip_file = smp.zip_file)"""


ORACLE["archive_members"] = f"WITH {_MEMBERS} SELECT zip_file, member FROM mem"

ORACLE["stratified_sample"] = f"""
WITH {_sample_sql(500, 100)}
SELECT zip_file, member, CAST(in_zip_rank AS BIGINT) AS in_zip_rank FROM smp
"""

ORACLE["batch_assign"] = f"WITH {_sample_sql(None, 100)} SELECT zip_file, member, rn, batch_no FROM bat"

ORACLE["first_batch"] = f"WITH {_sample_sql(None, 100)} SELECT zip_file, member FROM bat WHERE batch_no = 0"

ORACLE["archive_extract"] = f"WITH {_MEMBERS} SELECT zip_file, member, doc_id FROM mem"

ORACLE["xml_records"] = f"""
WITH {_MEMBERS}
SELECT mem.zip_file, mem.member, d.doc_id, substring(d.text, 1, 40) AS record_title, d.source AS publisher,
       '1970-01-01' AS alpha_pub_date, CASE WHEN d.lang = 'en' THEN 'Article' ELSE d.lang END AS object_type,
       md5(d.text) AS text_md5
FROM documents d JOIN mem ON mem.doc_id = d.doc_id
"""

ORACLE["xml_rejects"] = """
SELECT CAST(doc_id AS VARCHAR) || '.xml' AS member, 'malformed' AS reason FROM documents WHERE doc_id % 10 = 0
"""

ORACLE["schema_union"] = """
SELECT doc_id, CASE WHEN lang = 'en' THEN source END AS publisher,
       CAST(CASE WHEN doc_id % 7 = 0 THEN 2 ELSE 1 END AS BIGINT) AS n_types
FROM documents
"""

ORACLE["cache_roundtrip"] = f"WITH {_sample_sql(None, 100)} SELECT doc_id, batch_no FROM bat"

ORACLE["append_idempotent"] = f"""
WITH {_sample_sql(None, 100)} SELECT batch_no, count(*) AS n_rows FROM bat GROUP BY batch_no
"""

ORACLE["batch_status"] = f"""
WITH {_sample_sql(None, 100)}
SELECT batch_no, 'PROCESSED' AS stage, count(*) AS n_rows, count(*) FILTER (WHERE doc_id % 10 = 0) AS n_rejects
FROM bat GROUP BY batch_no
"""

ORACLE["incremental_ingest"] = ORACLE["annotate_articles"]

ORACLE["ingest_stages"] = """
SELECT unnest(['PROCESSED', 'CACHED', 'UPLOADED']) AS stage, count(*) AS n_rows, count(*) FILTER (WHERE doc_id % 10 = 0) AS n_rejects
FROM documents UNION ALL SELECT 'FAILED', count(*), count(*) FROM documents WHERE doc_id % 10 = 0 HAVING count(*) > 0
"""

ORACLE["ingest_sampled"] = f"""
WITH {_sample_sql(500, 100)} SELECT doc_id, zip_file, member, batch_no FROM bat
"""

ORACLE["embed_trained"] = "SELECT doc_id, CAST(300 AS BIGINT) AS dims FROM documents"
