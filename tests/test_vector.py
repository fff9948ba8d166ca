"""Vector search against numpy brute force; IVF recall on clustered data."""

from __future__ import annotations

import numpy as np

from archivesearch.operators import vector
from archivesearch.sources import tables

SF1 = "/root/testdata/sf0.1"


def _frames(spark, docs, queries):
    d = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(docs)],
                              "doc_id bigint, embedding array<double>")
    q = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(queries)],
                              "query_id bigint, embedding array<double>")
    return d, q


def _brute(docs, queries, k):
    out = {}
    for qi, q in enumerate(queries):
        dist = np.sqrt(((docs - q) ** 2).sum(axis=1))
        order = np.lexsort((np.arange(len(docs)), np.round(dist, 9)))[:k]
        out[qi] = [int(i) for i in order]
    return out


def test_knn_exact_matches_brute_force_with_ties(spark):
    rng = np.random.default_rng(3)
    docs = rng.normal(size=(300, 8))
    docs[50] = docs[49]  # exact copies tie: broken by doc_id
    docs[51] = docs[49]
    queries = np.vstack([rng.normal(size=(20, 8)), docs[49:50]])
    d, q = _frames(spark, docs, queries)
    got = {}
    for r in vector.knn_exact(d, q, k=5, block_rows=64, chunk_queries=7).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.doc_id))
    got = {k_: [d_ for _, d_ in sorted(v)] for k_, v in got.items()}
    assert got == _brute(docs, queries, 5)
    assert got[20][:3] == [49, 50, 51]


def test_index_build_assigns_nearest_cell(spark):
    cents = np.eye(4)
    docs = np.array([[0.9, 0, 0, 0], [0, 0, 0.8, 0.1], [0.5, 0.5, 0, 0]])
    d, _ = _frames(spark, docs, docs)
    c = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(cents)],
                              "cell bigint, centroid array<double>")
    idx, _ = vector.vector_index_build(d, dim=4, centroids=c)
    got = {r.doc_id: r.cell for r in idx.collect()}
    assert got == {0: 0, 1: 2, 2: 0}  # tie between cells 0 and 1 -> lowest id


def test_ivf_recall_on_clustered_data(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(40, 64))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    labels = rng.integers(0, 40, size=2000)
    docs = centres[labels] + 0.05 * rng.normal(size=(2000, 64))
    docs /= np.linalg.norm(docs, axis=1, keepdims=True)
    queries = docs[rng.choice(2000, 50, replace=False)] + 0.01 * rng.normal(size=(50, 64))
    d, q = _frames(spark, docs, queries)
    idx, cents = vector.vector_index_build(d, dim=64, n_cells=32, seed=1)
    approx = vector.knn_ivf(idx, cents, q, k=5, candidates=100).collect()
    truth = _brute(docs, queries, 5)
    hits = sum(1 for r in approx if r.doc_id in truth[r.query_id])
    assert hits / (5 * len(queries)) >= 0.95


def test_fitted_candidates_reach_the_recall_on_the_given_table(spark):
    index, cents = vector.vector_index_build(tables.embedded_articles(spark, SF1), dim=64,
                                             centroids=tables.fixture_centroids(spark, SF1))
    index = index.cache()
    queries = tables.query_vectors(spark, SF1)
    candidates = vector.fit_candidates(index, cents, queries, k=5, recall=0.9, sample=500)
    truth = vector.knn_exact(index, queries, k=5).select("query_id", "doc_id").cache()
    found = vector.knn_ivf(index, cents, queries, k=5, candidates=candidates)
    recall = found.join(truth, ["query_id", "doc_id"]).count() / truth.count()
    assert recall >= 0.9 and candidates < index.count()
