"""Registered queries of this subpackage, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivesearch.llm.common import documents
from archivesearch.llm.decontaminate import similar_windows
from archivesearch.llm.exact_dedup import exact_dedup
from archivesearch.llm.filter_audit import corpus_masks, filter_audit, mask_cells
from archivesearch.llm.html_extract import extract
from archivesearch.llm.lm_score import backoff_scores
from archivesearch.llm.ngram_join import jaccard_components
from archivesearch.llm.packing import pack, tokenised_pieces
from archivesearch.llm.secrets import find_secrets, joined
from archivesearch.llm.seed_extend import cut_repeats
from archivesearch.llm.sharding import shard_rows
from archivesearch.llm.suffix_dedup import remove_repeats
from archivesearch.llm.toxicity import held_out, score, train
from archivesearch.llm.whitening import whiten

SHARDS = 40
CAPACITY = 4096


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = shard_rows(documents(spark, sf_dir), SHARDS)
    return rows.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("rows").alias("law"), "shard",
                       "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir)).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op3_stupid_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = backoff_scores(documents(spark, sf_dir))
    return scored.select(F.col("id").alias("doc_id"), "n_words", "n_backed_off", F.round("log_score", 3).alias("log_score"))


def op4_prefix_free_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir)).select(
        F.col("id").alias("doc_id"), "n_bytes", "n_removed", F.size("removed").cast("bigint").alias("n_spans"), "kept_sha256")


def op5_linked_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(documents(spark, sf_dir))

    def n(kind: int):
        return F.expr(f"cast(size(filter(base, x -> x.kind = {kind})) as bigint)")

    return found.select(F.col("id").alias("doc_id"), n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op6_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similar_windows(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(F.col("id").alias("doc_id"), "item_id", F.col("start").cast("bigint").alias("start_word"),
                        F.col("n_words").cast("bigint").alias("n_words"),
                        F.round(F.col("shared") / F.col("total"), 9).alias("similarity"))


def op7_residual_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = pack(tokenised_pieces(documents(spark, sf_dir), tokenizer_path(), CAPACITY), CAPACITY)
    return placed.withColumnRenamed("id", "doc_id")


def op8_stateful_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup(documents(spark, sf_dir))
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size",
                       (F.col("locator") == F.col("keep_locator")).alias("kept"),
                       F.col("digest").alias("text_sha256"))


def op9_nb_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(F.col("doc_id")))
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    masks = corpus_masks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return filter_audit(mask_cells(masks))


def op12_seed_extend(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"])
    return cut_repeats(documents(spark, sf_dir)).select(
        "doc_id", "n_words", removed.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet")).withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ring_sharding": op1_ring_sharding,
    "op2_jaccard_join": op2_jaccard_join,
    "op3_stupid_backoff": op3_stupid_backoff,
    "op4_prefix_free_dedup": op4_prefix_free_dedup,
    "op5_linked_secrets": op5_linked_secrets,
    "op6_simhash_decontamination": op6_simhash_decontamination,
    "op7_residual_packing": op7_residual_packing,
    "op8_stateful_dedup": op8_stateful_dedup,
    "op9_nb_toxicity": op9_nb_toxicity,
    "op10_style_tree": op10_style_tree,
    "op11_filter_audit": op11_filter_audit,
    "op12_seed_extend": op12_seed_extend,
    "op13_embedding_whitening": op13_embedding_whitening,
}

ORACLE: dict[str, str] = {
    "op2_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 85 * (x.n + y.n - c)),
e2 AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(d, x) AS (SELECT doc_id, doc_id FROM w UNION SELECT r.d, e2.b FROM r JOIN e2 ON r.x = e2.a)
SELECT d AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(x) AS component_id
FROM r LEFT JOIN n ON n.doc_id = d GROUP BY d""",
    "op3_stupid_backoff": r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
t AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, w FROM w),
g AS (SELECT doc_id, i, w[i] AS g1, CASE WHEN i > 1 THEN w[i - 1] || ' ' || w[i] END AS g2, CASE WHEN i > 1 THEN w[i - 1] END AS x2,
  CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] || ' ' || w[i] END AS g3,
  CASE WHEN i > 2 THEN w[i - 2] || ' ' || w[i - 1] END AS x3 FROM t),
d AS (SELECT doc_id, g, count(*) AS n FROM (SELECT doc_id, unnest([g1, g2, g3]) AS g FROM g) WHERE g IS NOT NULL GROUP BY 1, 2),
a AS (SELECT g, sum(n) AS n FROM d GROUP BY 1),
o AS (SELECT d.doc_id, d.g, a.n - d.n AS c FROM d JOIN a USING (g)),
z AS (SELECT doc_id, greatest((SELECT sum(len(w)) FROM w) - len(w), 1) AS rest FROM w),
s AS (SELECT g.doc_id, g2, g3, CASE
    WHEN c3.c > 0 THEN ln(c3.c / b3.c)
    WHEN c2.c > 0 THEN ln(c2.c / b2.c) + CASE WHEN g3 IS NULL THEN 0 ELSE ln(0.4) END
    ELSE ln(greatest(c1.c, 1) / rest) + ln(0.4) * CASE WHEN g3 IS NOT NULL THEN 2 WHEN g2 IS NOT NULL THEN 1 ELSE 0 END END AS v,
  CASE WHEN c3.c > 0 OR (g3 IS NULL AND c2.c > 0) OR g2 IS NULL THEN 0 ELSE 1 END AS b
  FROM g JOIN z USING (doc_id) JOIN o c1 ON c1.doc_id = g.doc_id AND c1.g = g1
  LEFT JOIN o c2 ON c2.doc_id = g.doc_id AND c2.g = g2 LEFT JOIN o b2 ON b2.doc_id = g.doc_id AND b2.g = x2
  LEFT JOIN o c3 ON c3.doc_id = g.doc_id AND c3.g = g3 LEFT JOIN o b3 ON b3.doc_id = g.doc_id AND b3.g = x3)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(sum(b), 0) AS BIGINT) AS n_backed_off,
  round(coalesce(sum(v), 0.0), 3) AS log_score
FROM w LEFT JOIN s USING (doc_id) GROUP BY w.doc_id, len(w)""",
    "op6_simhash_decontamination": r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM documents),
i AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS v
  FROM benchmark),
ig AS (SELECT item_id, len(v) AS n, unnest(list_transform(range(1, len(v) - 3), lambda j: array_to_string(v[j:j + 4], ' '))) AS g
  FROM i WHERE len(v) >= 5),
ic AS (SELECT item_id, n, g, count(*) AS c FROM ig GROUP BY ALL),
dg AS (SELECT doc_id, len(w) AS size, unnest(range(0, len(w) - 4)) AS p,
  unnest(list_transform(range(1, len(w) - 3), lambda j: array_to_string(w[j:j + 4], ' '))) AS g FROM d WHERE len(w) >= 5),
h AS (SELECT doc_id, size, p, dg.g, item_id, n, c FROM dg JOIN ic ON dg.g = ic.g),
s AS (SELECT DISTINCT doc_id, size, item_id, n,
  unnest(range(greatest(0, least(p - (n - 5), size - n)), greatest(0, least(p, size - n)) + 1)) AS start FROM h),
k AS (SELECT s.doc_id, s.item_id, s.n, s.start, least(s.n, s.size) - 4 + s.n - 4 AS both_n, h.g, least(count(*), any_value(h.c)) AS m
  FROM s JOIN h ON h.doc_id = s.doc_id AND h.item_id = s.item_id AND h.p >= s.start AND h.p <= s.start + s.n - 5
  GROUP BY 1, 2, 3, 4, 5, 6),
t AS (SELECT doc_id, item_id, n, start, sum(m) AS shared, any_value(both_n) - sum(m) AS total FROM k GROUP BY 1, 2, 3, 4),
q AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY shared / total DESC, start) AS rn FROM t
  WHERE 100 * shared >= 80 * total)
SELECT doc_id, item_id, CAST(start AS BIGINT) AS start_word, CAST(n AS BIGINT) AS n_words, round(shared / total, 9) AS similarity
FROM q WHERE rn = 1""",
    "op8_stateful_dedup": r"""
WITH n AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h
           FROM documents),
g AS (SELECT h, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY h)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM n JOIN g USING (h)""",
    "op11_filter_audit": r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY 1),
e AS (SELECT t, min(doc_id) AS first FROM d GROUP BY 1),
m AS (SELECT part, coalesce(good, 0) AS good, coalesce(bad, 0) AS bad, CASE WHEN len(w) < 200 THEN 1 ELSE 0 END
  + CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END
  + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t) THEN 4 ELSE 0 END
  + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN first < doc_id THEN 16 ELSE 0 END AS mask
  FROM w JOIN e USING (t) LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(bad) AS bad FROM m GROUP BY 1, 2),
f(l, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT v.l || w.l || x.l || y.l || z.l AS filter_order, [v.b, w.b, x.b, y.b, z.b] AS bits
  FROM f v, f w, f x, f y, f z WHERE v.b | w.b | x.b | y.b | z.b = 31),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS before
  FROM o, unnest(range(1, 6)) AS r(step)),
r AS (SELECT part, filter_order, step, bit,
  sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
  sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS removed,
  sum(CASE WHEN mask & before <> 0 AND mask & bit <> 0 THEN n ELSE 0 END) AS redundant,
  sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
  sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN good ELSE 0 END) AS good_lost,
  sum(CASE WHEN mask & before = 0 AND mask & bit <> 0 THEN bad ELSE 0 END) AS toxic_lost
  FROM c, s GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
  CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r""",
    "op12_seed_extend": r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS p,
  unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) AS s FROM d WHERE len(w) >= 13),
f AS (SELECT s, min(doc_id) AS first FROM g GROUP BY 1),
c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS i FROM g JOIN f USING (s) WHERE first < doc_id),
u AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
k AS (SELECT u.doc_id, count(c.i) AS removed, string_agg(x, ' ' ORDER BY u.i) FILTER (WHERE c.i IS NULL) AS kept
  FROM u LEFT JOIN c ON c.doc_id = u.doc_id AND c.i = u.i GROUP BY u.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)""",
}
