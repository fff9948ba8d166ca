"""What a query shuffles and holds: findings of round 3 on time, disk and memory."""

from __future__ import annotations

import contextlib
import io
import tracemalloc

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from archivesearch.functions import text as tx
from archivesearch.operators import ann
from archivesearch.operators import collection as coll
from archivesearch.operators import embeddings as emb
from archivesearch.operators import keywords as kw
from archivesearch.operators import vector, wordvec
from archivesearch.session import scratch_path
from archivesearch.sources import tables


def plan(df) -> str:
    with contextlib.redirect_stdout(io.StringIO()) as out:
        df.explain()
    return out.getvalue()


def test_terms_and_ngrams_shuffle_the_texts_once(spark):
    df = spark.createDataFrame([(i % 5, f"Old cats eat fish. Cats like word{i}") for i in range(12)], "doc_id bigint, text string")
    dealt = tx.context_tokens(tables.by_id(df, task_bytes=64))
    grams = kw.candidate_table(kw.keyword_events(dealt, kw.KeywordParams(), with_terms=False))
    whole = kw.candidate_table(kw.keyword_events(tx.context_tokens(df), kw.KeywordParams()))
    assert plan(grams).count("Exchange hashpartitioning") == 1 == plan(kw.term_features(dealt)).count("Exchange hashpartitioning")
    assert sorted(map(tuple, grams.collect())) == sorted(map(tuple, whole.collect()))
    terms = [sorted(map(tuple, kw.term_features(t).select("doc_id", "term", "tf", F.round("s_term", 9)).collect())) for t in (
        dealt, tx.context_tokens(df))]
    assert terms[0] == terms[1] and len(terms[0]) > 20


def test_a_block_gets_the_columns_that_it_uses(spark):
    dim, blocks = 2, 3
    entries = [(0, 4, 2.0), (1, 4, 1.0), (4, 0, 2.0), (4, 1, 1.0), (4, 7, 3.0), (7, 4, 3.0)]
    matrix = spark.createDataFrame(entries, "a bigint, b bigint, value float").selectExpr(
        "*", f"pmod(a, {blocks}) i", f"pmod(b, {blocks}) j")
    columns = spark.createDataFrame([(c, [float(c), 1.0]) for c in (0, 1, 4, 7, 9)], "code bigint, vec array<float>")
    used = matrix.selectExpr("b code", "i").distinct()
    got = {r.code: r.vec for r in wordvec._times(matrix, columns, used, blocks, dim).collect()}
    want = {}
    for a, b, v in entries:
        want[a] = np.add(want.get(a, [0.0, 0.0]), [v * b, v])
    assert set(got) == set(want) and all(np.allclose(got[a], want[a]) for a in want)
def test_embeddings_of_repeated_and_null_ids_in_slices(spark):
    rows = [(1, "a b a"), (1, "c zz"), (2, "zz"), (3, None), (None, "a"), (4, ""), (5, "b B")]
    rows += [(10 + i, f"a w{i % 7}") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    vec = {"a": [1.0, 0.0], "b": [0.0, 1.0], "c": [4.0, 4.0], **{f"w{i}": [float(i), 0.5] for i in range(7)}}
    table = spark.createDataFrame([*vec.items(), ("b", [2.0, 3.0])], "word string, vec array<double>")  # b has two vectors
    found = emb.embed_from_table(df, table, slice_bytes=20)
    assert "doc_id#" not in "".join(line for line in plan(found).splitlines() if "hashpartitioning" in line and "word" in line)
    got = {}
    for r in found.collect():
        got.setdefault(r.doc_id, []).append(r.embedding)
    assert len(got[1]) == 2 and got[1][0] == got[1][1]
    np.testing.assert_allclose(got[1][0], np.array([2.0 + 2.0 + 4.0, 0.0 + 4.0 + 4.0]) / 5)  # 2 a, b twice, c
    np.testing.assert_allclose(got[5][0], [1.0, 2.0])
    assert got[2] == got[3] == got[4] == got[None] == [None]
    for i in range(40):
        np.testing.assert_allclose(got[10 + i][0], [(1 + i % 7) / 2, 0.25])


def test_dealing_rows_to_parts_shuffles_only_counts(spark):
    at = scratch_path(spark, "dealt")
    rows = spark.range(60).selectExpr("id doc_id", "if(id < 40, 'hot', concat('k', id)) phrase")
    dealt, counts = coll._dealt(rows, "phrase", 15, at)
    assert "Exchange hashpartitioning" not in plan(dealt)
    got = dealt.collect()
    assert len(got) == 60 and {r.part for r in got if r.phrase == "hot"} == {0, 1, 2} and {r.part for r in got if r.phrase != "hot"} == {0}
    assert {r.phrase: (r.n, r.parts) for r in counts.collect()} == {"hot": (40, 3), **{f"k{i}": (1, 1) for i in range(40, 60)}}


def test_knn_exact_holds_a_tile_of_distances():
    rng = np.random.default_rng(1)
    docs = pd.DataFrame({"doc_id": np.arange(20_000), "embedding": list(rng.normal(size=(20_000, 8)))})
    asked = pd.DataFrame({"query_id": np.arange(512), "qvec": list(rng.normal(size=(512, 8)))})
    tracemalloc.start()
    found = vector._block_topk(3)(docs, asked)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 << 20  # all distances at once are 82 MB, in several arrays
    d, q = np.stack(docs["embedding"]), np.stack(asked["qvec"])
    for k in (0, 100, 511):
        want = np.argsort(np.sqrt(((d - q[k]) ** 2).sum(axis=1)))[:3]
        assert found[found["query_id"] == k]["doc_id"].tolist() == want.tolist()


def test_groups_of_knn_exact_are_not_merged_by_size(spark):
    rows = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)], "doc_id bigint, embedding array<double>")
    near = vector.knn_exact(rows, rows.withColumnRenamed("doc_id", "query_id"), 1, block_rows=2, chunk_queries=2)
    assert "REPARTITION_BY_NUM" in plan(near)
    assert sorted((r.query_id, r.doc_id) for r in near.collect()) == [(i, i) for i in range(20)]


def test_groups_of_many_queries_are_not_merged_by_size(spark):
    rows = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(20)], "doc_id bigint, embedding array<double>")
    index = ann.create_index(spark, buckets=2)
    ann.give_model(index, rows.where("doc_id < 2").selectExpr("doc_id cell", "embedding centroid"),
                   rows.where("doc_id < 20").selectExpr("int(doc_id) code", "embedding value"), 1)
    ann.add_vectors(index, rows)
    near = ann.search_index(index, rows.withColumnRenamed("doc_id", "query_id"), 1, scan=1.0, chunk_queries=5)
    assert plan(near).count("REPARTITION_BY_NUM") == 2
    assert sorted((r.query_id, r.doc_id) for r in near.collect()) == [(i, i) for i in range(20)]


def test_stop_words_are_looked_up_in_a_set(spark):
    df = spark.createDataFrame([(1, "The cat and a CAT's hat"), (2, None), (3, "the and")], "doc_id bigint, text string")
    kept = df.select("doc_id", tx.remove_stop_words(tx.plain_token_array(F.col("text"))).alias("kept"),
                     tx.clean_query(F.col("text")).alias("clean"))
    assert "array_contains" not in plan(kept) and "INSET" in plan(kept)
    assert [tuple(r) for r in kept.orderBy("doc_id").collect()] == [(1, ["cat", "cat", "hat"], "cat cat hat"), (2, None, None), (3, [], "")]
