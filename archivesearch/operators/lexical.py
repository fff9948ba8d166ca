"""Keyword search over the long keyword table (X1-X7, A1, L1) and lexical
phrase search with BM25 relevance (L2).

Inputs: ``keywords(doc_id, result, score[, n])`` — one row per (document,
keyword), already restricted by the pre-filter (X1) — and
``query_ngrams(query_id, result)`` from L0. No join is forced: AQE broadcasts
the query side from its measured bytes and otherwise splits skewed n-grams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivesearch.config import SearchParams
from archivesearch.operators.vector import top_k_per_query

BAD_SCORE = 1e7


def prefilter_object_type(df: DataFrame, value: str = "Article", col: str = "object_type") -> DataFrame:
    """Equality match that also matches members of an array field."""
    return df.where(F.array_contains(F.col(col), value))


def project_nested(df: DataFrame) -> DataFrame:
    """Only the nested keyword text and score (nested-schema pruning)."""
    return df.select("doc_id", F.col("keywords.result").alias("results"),
                     F.col("keywords.score").alias("scores"))


def unnest_keywords(df: DataFrame) -> DataFrame:
    """One row per keyword; NULL/empty arrays drop the document."""
    return df.select("doc_id", F.explode("keywords").alias("k")).select(
        "doc_id", F.col("k.result").alias("result"), F.col("k.score").alias("score"))


def tolerant_reciprocal(score: Column) -> Column:
    """1 / score with unparsable, NULL or zero scores counting as 1e7."""
    as_double = score.cast("string").try_cast("double")
    return F.lit(1.0) / F.coalesce(F.nullif(as_double, F.lit(0.0)), F.lit(BAD_SCORE))


def match_ngrams(keywords: DataFrame, query_ngrams: DataFrame) -> DataFrame:
    """Keyword rows whose text is one of the query's n-grams
    (an IN-list per query, i.e. an equi-join with the query side)."""
    return keywords.join(query_ngrams.select("query_id", "result").distinct(), "result")


def distinct_matches(matches: DataFrame) -> DataFrame:
    """Distinct whole (result, score) pairs per (query, document)."""
    return matches.dropDuplicates(["query_id", "doc_id", "result", "score"])


def search_keyword(keywords: DataFrame, query_ngrams: DataFrame,
                   params: SearchParams = SearchParams()) -> DataFrame:
    """L1: sum of reciprocal keyword scores over matched keywords, top k.

    Returns (query_id, doc_id, score, keywords ARRAY<STRING>, rank) where
    ``keywords`` is the sorted set of matched texts (X6) and rank is 1..k,
    ordered by round(ln(score), 9) descending, then doc_id.
    """
    return score_matches(match_ngrams(keywords, query_ngrams), params)


def score_matches(matches: DataFrame, params: SearchParams = SearchParams()) -> DataFrame:
    """L1 from X5 on, for matched keyword rows ``(query_id, doc_id, result, score)``."""
    agg = (distinct_matches(matches).withColumn("recip", tolerant_reciprocal(F.col("score")))
           .groupBy("query_id", "doc_id")
           .agg(F.sum("recip").alias("score"),
                F.sort_array(F.collect_set("result")).alias("keywords"))
           .withColumn("ln_score", F.ln("score")))
    return top_k_per_query(agg, params.k, "ln_score", descending=True)


def sub_phrases(keywords: DataFrame) -> DataFrame:
    """Every contiguous sub-phrase of each keyword (<= 6 for 3 words), so
    phrase containment becomes an equi-join. Adds ``phrase``."""
    words = F.split(F.col("result"), " ")
    n = F.size(words)
    starts = F.sequence(F.lit(0), n - 1)
    spans = F.flatten(F.transform(starts, lambda s: F.transform(
        F.sequence(s + 1, n), lambda e: F.array_join(F.slice(words, s + 1, e - s), " "))))
    return keywords.withColumn("phrase", F.explode(spans))


def search_phrase_bm25(keywords: DataFrame, query_ngrams: DataFrame,
                       params: SearchParams = SearchParams()) -> DataFrame:
    """L2: documents with at least one query n-gram as a phrase inside one of
    their keywords, ranked by BM25 over keyword tokens.

    tf(q, d) = occurrences of q among d's keyword sub-phrases,
    dl(d) = keyword tokens of d, N / avgdl over the (filtered) keyword table,
    idf(q) = ln(1 + (N - df + 0.5) / (df + 0.5)),
    score = sum_q idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * dl / avgdl)).
    Returns (query_id, doc_id, score, rank) with rank 1..k.
    """
    kw = keywords.select("doc_id", "result",
                         F.size(F.split(F.col("result"), " ")).alias("ntok"))
    dl = kw.groupBy("doc_id").agg(F.sum("ntok").alias("dl"))
    # corpus statistics as scalar subqueries (one small job each)
    n_docs = dl.select(F.count(F.lit(1)).cast("double")).scalar()
    avgdl = dl.select(F.avg("dl")).scalar()
    q = query_ngrams.select("query_id", F.col("result").alias("phrase")).distinct()
    hits = sub_phrases(kw).join(q, "phrase")
    tf = hits.groupBy("query_id", "phrase", "doc_id").agg(F.count(F.lit(1)).alias("tf"))
    dfq = tf.groupBy("query_id", "phrase").agg(F.count(F.lit(1)).alias("df"))
    return bm25_top_k(tf.join(dfq, ["query_id", "phrase"]).join(dl, "doc_id"), n_docs, avgdl, params)


def bm25_top_k(hits: DataFrame, n_docs: Column, avgdl: Column, params: SearchParams = SearchParams()) -> DataFrame:
    """The k best documents of each query by the sum of BM25 over ``hits(query_id, doc_id, tf, df, dl)``."""
    k1, b, tf = params.bm25_k1, params.bm25_b, F.col("tf").cast("double")
    idf = F.ln(F.lit(1.0) + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = hits.select("query_id", "doc_id",
                       (idf * tf * (k1 + 1) / (tf + k1 * (1 - b + b * F.col("dl") / avgdl))).alias("s"))
    scored = part.groupBy("query_id", "doc_id").agg(F.sum("s").alias("score"))
    return top_k_per_query(scored, params.k, "score", descending=True)
