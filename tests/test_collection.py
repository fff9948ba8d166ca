from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from archivesearch.config import SearchParams
from archivesearch.operators import collection as coll
from archivesearch.operators import embeddings as emb
from archivesearch.operators import fusion, lexical, vector
from archivesearch.operators import keywords as kw

POOL = ["river", "bank", "storm", "council", "vote", "harbour", "market", "school", "budget", "train", "fire", "museum"]
SCHEMA = "doc_id bigint, is_article boolean, record_title string, publisher string, alpha_pub_date string, full_text string"


def rows(ids, seed):
    rng = random.Random(seed)
    out = []
    for i in ids:
        text = ". ".join(" ".join(["Storm"] * (i % 3 == 0) + rng.choices(POOL, k=rng.randint(3, 9))).capitalize() for _ in range(5))
        out.append((i, i % 4 != 0, f"title {i}", f"p{i % 3}", "1970", text))
    return out


@pytest.fixture(scope="module")
def made(spark):
    """A collection in two batches, with hot results and phrases dealt into parts, and the same articles as a frame."""
    every = rows(range(60), 1) + rows(range(60, 90), 2)
    frame = spark.createDataFrame(every, SCHEMA)
    words = emb.hashed_word_vectors(spark.createDataFrame([(w,) for w in POOL], "word string"))
    c = coll.create_collection(spark, buckets=4, part_rows=7)
    coll.add_articles(c, frame.where("doc_id < 60"), words)
    more = spark.createDataFrame([(900, True, "t", "p", "1970", None), (None, True, "t", "p", "1970", "Storm at sea")], SCHEMA)
    coll.add_articles(c, frame.where("doc_id >= 60").unionAll(more), words)
    queries = spark.createDataFrame(
        [(0, "storm council vote"), (1, "Harbour market, river bank"), (2, "the of"), (3, "nothing known here"), (4, "museum")],
        "query_id bigint, text string")
    return c, frame, words, queries


def values(df, *cols):
    return sorted(tuple(round(v, 9) if isinstance(v, float) else tuple(v) if isinstance(v, list) else v for v in r)
                  for r in df.select(*cols).collect())


def texts(frame):
    return frame.where("is_article").select("doc_id", F.col("full_text").alias("text"))


def test_stored_searches_equal_searches_of_the_articles(made):
    c, frame, words, queries = made
    p = SearchParams(k=7)
    keywords = kw.extract_keywords(texts(frame))
    grams = kw.query_keywords(queries)
    assert values(coll.search_keyword(c, grams, p), "query_id", "doc_id", "score", "keywords", "rank") == values(
        lexical.search_keyword(keywords, grams, p), "query_id", "doc_id", "score", "keywords", "rank")
    stored, direct = coll.search_phrase(c, grams, p), lexical.search_phrase_bm25(keywords, grams, p)
    assert values(stored, "query_id", "doc_id", "score", "rank") == values(direct, "query_id", "doc_id", "score", "rank")
    vectors = emb.embed_from_table(texts(frame), words).where("embedding IS NOT NULL")
    asked = emb.embed_from_table(queries, words, id_col="query_id").where("embedding IS NOT NULL")
    fused = fusion.hybrid(vector.knn_exact(vectors, asked, p.k), direct, p)
    cols = ("query_id", "doc_id", "vs_score", "kw_score", "score", "rank")
    assert values(coll.search_hybrid(c, queries, p), *cols) == values(fused, *cols)


def test_hot_phrases_lie_in_parts_and_counts_add_up_over_batches(made):
    c, frame, words, _ = made
    counts = {r.phrase: (r.n, r.parts) for r in c.table("phrases").groupBy("phrase").agg(
        F.sum("n").alias("n"), F.max("parts").alias("parts")).collect()}
    stored = {r.phrase: (r.n, r.p) for r in c.table("postings").groupBy("phrase").agg(
        F.count(F.lit(1)).alias("n"), F.max("part").alias("p")).collect()}
    assert {p: n for p, (n, _) in counts.items()} == {p: n for p, (n, _) in stored.items()}
    assert counts["storm"][1] > 1 and 0 < stored["storm"][1] < counts["storm"][1]
    most = c.table("postings").groupBy("phrase", "part").count().agg(F.max("count")).first()[0]
    assert most <= 20  # 7 rows and an uneven hash, of each of two batches
    assert c.table("words").count() == len(POOL)


def test_other_records_are_kept_apart(made):
    c, frame, _, queries = made
    grams = kw.query_keywords(queries)
    found = {r.doc_id for r in coll.search_keyword(c, grams, SearchParams(k=90), articles=False).collect()}
    assert found and all(i % 4 == 0 for i in found)
    assert {r.doc_id % 4 != 0 for r in c.table("texts").collect()} == {True}


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_searches_read_stored_tables_and_shuffle_only_the_queries(spark, made):
    c, _, _, queries = made
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        grams = spark.createDataFrame([(0, "storm"), (1, "river bank")], "query_id bigint, result string")
        plan = plan_of(coll.search_phrase(c, grams))
        for table in ("postings", "phrases"):
            at = plan.index(f"{table}_true")
            line_start = plan.rindex("\n", 0, at)
            own = plan[line_start:plan.index("\n", at)]
            assert "Bucketed: true" in own
            above = plan[:line_start].rsplit("\n", 4)[1:]  # operators between the scan and its join
            join = [k for k, line in enumerate(above) if "Join" in line]
            assert not any("Exchange" in line for line in above[join[-1] + 1 if join else 0:])
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    hybrid = plan_of(coll.search_hybrid(c, queries))
    assert not re.search(r"full_text|is_article#", hybrid)


def test_a_collection_is_opened_from_its_folder(spark, made):
    c, _, _, queries = made
    again = coll.open_collection(spark, c.path)
    assert again.name != c.name and again.buckets == 4 and again.part_rows == 7
    cols = ("query_id", "doc_id", "vs_score", "kw_score", "score", "rank")
    assert values(coll.search_hybrid(again, queries), *cols) == values(coll.search_hybrid(c, queries), *cols)


def test_search_in_one_call(made):
    c, frame, _, queries = made
    found = coll.search(c, queries)
    status = {r.query_id: (r.n_hits, r.status) for r in found.status.collect()}
    assert status[2] == (0, "EMPTY_QUERY") and status[3] == (0, "NO_RESULTS")
    assert status[0] == (5, "OK") and status[4][1] == "OK"
    shown = found.rows.collect()
    assert [(r.query_id, r.rank) for r in shown] == sorted((r.query_id, r.rank) for r in shown)
    assert all(r.vec_pct + r.kw_pct == 100 and r.record_title == f"title {r.doc_id}" for r in shown)
    assert any("<" in r.snippet for r in shown if r.query_id == 4)


def test_an_empty_collection(spark):
    c = coll.create_collection(spark, buckets=2)
    queries = spark.createDataFrame([(1, "storm")], "query_id bigint, text string")
    assert [r.status for r in coll.search(c, queries).status.collect()] == ["NO_RESULTS"]
    coll.add_articles(c, spark.createDataFrame([], SCHEMA))
    assert coll.search(c, queries).rows.count() == 0


def test_fetching_ids_reads_a_few_pages(spark):
    """Rows that the scan hands on for three of 20,000 ids, from the plan's own metrics."""
    n = 20_000
    c = coll.create_collection(spark, buckets=2)
    rows = spark.range(n).select(F.col("id").alias("doc_id"), F.lit("t").alias("record_title"), F.lit("p").alias("publisher"),
                                 F.lit("d").alias("alpha_pub_date"), F.concat(F.lit("text "), F.sha2(F.col("id").cast("string"), 512)).alias("full_text"))
    c.append("texts", rows.repartitionByRange(4, "doc_id").sortWithinPartitions("doc_id"))
    hits = spark.createDataFrame([(0, 5), (0, 9_999), (1, 17_001), (1, 5)], "query_id bigint, doc_id bigint")
    found = coll.fetch_texts(c, hits)
    assert sorted(r.doc_id for r in found.collect()) == [5, 9_999, 17_001]
    leaf = found._jdf.queryExecution().executedPlan().collectLeaves().apply(0)
    read = leaf.metrics().apply("numOutputRows").value()
    assert 3 <= read <= 3 * 400
    many = coll.fetch_texts(c, hits, look_up=2)
    assert sorted(r.doc_id for r in many.collect()) == [5, 9_999, 17_001]
