"""Lexical search, fusion and result assembly on literal frames."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from archivesearch.config import SearchParams
from archivesearch.operators import fusion, lexical, results


def test_tolerant_reciprocal_bad_scores(spark):
    df = spark.createDataFrame([("0",), (None,), ("abc",), ("0.5",)], "s string")
    got = [r.r for r in df.select(lexical.tolerant_reciprocal(F.col("s")).alias("r")).collect()]
    assert got == pytest.approx([1e-7, 1e-7, 1e-7, 2.0])


def test_search_keyword_sums_reciprocals_and_breaks_ties_by_id(spark):
    kw = spark.createDataFrame(
        [(1, "red car", 0.5), (1, "fast", 0.25), (2, "red car", 0.5), (2, "fast", 0.25),
         (3, "red car", 0.1), (4, "blue", 0.01)],
        "doc_id bigint, result string, score double")
    q = spark.createDataFrame([(7, "red car"), (7, "fast")], "query_id bigint, result string")
    r = lexical.search_keyword(kw, q, SearchParams(k=2)).orderBy("rank").collect()
    assert [(x.doc_id, x.rank) for x in r] == [(3, 1), (1, 2)]
    assert r[1].score == pytest.approx(6.0)
    assert r[1].keywords == ["fast", "red car"]


def test_distinct_matches_keeps_same_text_with_two_scores(spark):
    m = spark.createDataFrame([(1, 1, "a", 0.5), (1, 1, "a", 0.5), (1, 1, "a", 0.25)],
                              "query_id bigint, doc_id bigint, result string, score double")
    assert lexical.distinct_matches(m).count() == 2


def test_bm25_phrase_containment(spark):
    kw = spark.createDataFrame(
        [(1, "red car", 1.0), (1, "old house", 1.0), (2, "big red car", 1.0), (3, "blue sky", 1.0)],
        "doc_id bigint, result string, score double")
    q = spark.createDataFrame([(1, "red car")], "query_id bigint, result string")
    r = lexical.search_phrase_bm25(kw, q, SearchParams(k=5)).orderBy("rank").collect()
    assert sorted(x.doc_id for x in r) == [1, 2]
    # doc 1 has fewer keyword tokens than doc 2 (4 vs 3)? both tf=1: shorter doc scores higher
    assert r[0].doc_id == 2 or r[0].score >= r[1].score


def test_hybrid_bounds_and_shares(spark):
    vec = spark.createDataFrame([(1, d, r) for r, d in enumerate([10, 11, 12, 13, 14], 1)],
                                "query_id bigint, doc_id bigint, rank bigint")
    kwa = spark.createDataFrame([(1, d, r) for r, d in enumerate([12, 20, 10, 21, 22], 1)],
                                "query_id bigint, doc_id bigint, rank bigint")
    h = fusion.hybrid(vec, kwa)
    rows = h.collect()
    assert len(rows) == 5
    assert all(r.score <= 1 / 61 + 1 / 62 + 1e-12 for r in rows)
    top = h.orderBy("rank").first()
    assert top.doc_id == 12 and top.score == pytest.approx(1 / 64 + 1 / 61)
    v, k = results.fusion_share(F.col("vs_score"), F.col("kw_score"), F.col("score"))
    for r in h.select(v.alias("v"), k.alias("k")).collect():
        assert r.v + r.k == 100


def test_fusion_share_half_even(spark):
    df = spark.createDataFrame([(0.625, 0.375, 1.0), (0.0, 1.0, 1.0), (1.0, 0.0, 1.0)],
                               "vs double, kw double, s double")
    v, k = results.fusion_share(F.col("vs"), F.col("kw"), F.col("s"))
    got = [(r.v, r.k) for r in df.select(v.alias("v"), k.alias("k")).collect()]
    assert got == [(62, 38), (0, 100), (100, 0)]


def test_query_status(spark):
    q = spark.createDataFrame([(1, "the and of"), (2, "rare words"), (3, "found words")],
                              "query_id bigint, text string")
    res = spark.createDataFrame([(3, 99)], "query_id bigint, doc_id bigint")
    got = {r.query_id: r.status for r in results.query_status(q, res).collect()}
    assert got == {1: results.EMPTY_QUERY, 2: results.NO_RESULTS, 3: results.OK}


def test_rrf_three_arms_general(spark):
    a = spark.createDataFrame([(1, 5, 1)], "query_id bigint, doc_id bigint, rank bigint")
    b = spark.createDataFrame([(1, 5, 2), (1, 6, 1)], "query_id bigint, doc_id bigint, rank bigint")
    c = spark.createDataFrame([(1, 6, 1)], "query_id bigint, doc_id bigint, rank bigint")
    r = fusion.rrf([(a, "a", 61), (b, "b", 60), (c, "c", 60)], k=5).orderBy("rank").collect()
    assert [x.doc_id for x in r] == [6, 5]
    assert r[0].score == pytest.approx(2 / 61)
    assert r[1].score == pytest.approx(1 / 62 + 1 / 62)
