"""Reciprocal-rank fusion of ranked result sets.

Every arm is a small per-query frame (<= k rows per query), so the fusion
steps shuffle only k rows per query and arm.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivesearch.config import SearchParams
from archivesearch.operators.vector import top_k_per_query


def arm_rank(arm: DataFrame, rank_col: str = "rank") -> DataFrame:
    """0-based position within the arm (arms carry a 1-based ``rank``)."""
    return arm.withColumn("arm_rank", (F.col(rank_col) - 1).cast("bigint"))


def rrf_contribution(rank0, penalty: int):
    """1 / (rank + penalty + 1) for a 0-based rank."""
    return F.lit(1.0) / (rank0 + F.lit(penalty) + F.lit(1))


def scored_arm(arm: DataFrame, name: str, penalty: int) -> DataFrame:
    """(query_id, doc_id, <name>): the arm's RRF contribution per document."""
    r = arm_rank(arm)
    return r.select("query_id", "doc_id", rrf_contribution(F.col("arm_rank"), penalty).alias(name))


def union_arms(arms: list[DataFrame]) -> DataFrame:
    """Bag union of arms whose score columns differ."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), arms)


def merge_arms(union: DataFrame, score_cols: list[str]) -> DataFrame:
    """A2 + X8: one row per (query, document), max of each arm's score,
    missing arms count 0."""
    aggs = [F.coalesce(F.max(c), F.lit(0.0)).alias(c) for c in score_cols]
    return union.groupBy("query_id", "doc_id").agg(*aggs)


def rrf(arms: list[tuple[DataFrame, str, int]], k: int) -> DataFrame:
    """F2: fuse any number of ranked arms ``(frame, score_name, penalty)``.

    Each frame has (query_id, doc_id, rank 1..). Output: (query_id, doc_id,
    <score_name>..., score, rank) with the k best fused scores per query,
    ordered by round(score, 9) desc, then doc_id.
    """
    names = [name for _, name, _ in arms]
    merged = merge_arms(union_arms([scored_arm(df, name, pen) for df, name, pen in arms]), names)
    fused = merged.withColumn("score", reduce(lambda a, b: a + b, [F.col(n) for n in names]))
    return top_k_per_query(fused, k, "score", descending=True)


def hybrid(vector_arm: DataFrame, keyword_arm: DataFrame,
           params: SearchParams = SearchParams()) -> DataFrame:
    """vector arm (penalty 61) + keyword arm (penalty 60), top k fused.
    Output (query_id, doc_id, vs_score, kw_score, score, rank)."""
    return rrf([(vector_arm, "vs_score", params.vector_penalty),
                (keyword_arm, "kw_score", params.keyword_penalty)], params.k)
