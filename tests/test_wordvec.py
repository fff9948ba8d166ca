from __future__ import annotations

import random

import numpy as np
from pyspark.sql import functions as F

from archivesearch.config import EmbeddingParams
from archivesearch.operators import embeddings as emb
from archivesearch.operators import vector, wordvec


def test_pair_counts_and_ppmi_by_hand(spark):
    texts = ["a b c a", "b a", "", "c"]
    rng = random.Random(1)
    texts += [" ".join(rng.choices("abcdef", k=rng.randint(1, 12))) for _ in range(40)]
    docs = spark.createDataFrame([(t.split(),) for t in texts], "tokens array<string>")
    names = {r.code: r.word for r in docs.select(F.explode("tokens").alias("word")).distinct().select(
        "word", F.xxhash64("word").alias("code")).collect()}
    pairs = wordvec.pair_counts(docs.select(F.transform("tokens", lambda w: F.xxhash64(w)).alias("codes")), 2)
    want = {}
    for t in texts:
        w = t.split()
        for i in range(len(w)):
            for j in range(len(w)):
                if i != j and abs(i - j) <= 2:
                    want[w[i], w[j]] = want.get((w[i], w[j]), 0) + 1
    assert {(names[r.a], names[r.b]): r.n for r in pairs.collect()} == want
    words = spark.createDataFrame([(c,) for c, w in names.items() if w != "f"], "code bigint")
    kept = {p: n for p, n in want.items() if "f" not in p}
    margin, total = {}, sum(kept.values())
    for (a, _), n in kept.items():
        margin[a] = margin.get(a, 0) + n
    got = {(names[r.a], names[r.b]): r.value for r in wordvec.ppmi(pairs, words).collect()}
    for p, n in kept.items():
        value = np.log(n * total / (margin[p[0]] * margin[p[1]]))
        assert (p in got) == (value > 1e-9) or abs(value) < 1e-6
        assert p not in got or abs(got[p] - value) < 1e-5


def corpus(spark, topics=6, docs=120):
    rng = random.Random(3)
    pools = [[f"t{k}w{i}" for i in range(12)] for k in range(topics)]
    common = [f"common{i}" for i in range(10)]
    rows = [(d, " ".join(rng.choices(pools[d % topics], k=40) + rng.choices(common, k=10))) for d in range(docs)]
    shuffled = []
    for d, t in rows:
        w = t.split()
        rng.shuffle(w)
        shuffled.append((d, " ".join(w)))
    return spark.createDataFrame(shuffled, "doc_id bigint, text string"), topics


def test_eigenvectors_equal_those_of_the_whole_matrix(spark):
    docs, _ = corpus(spark)
    dim = 8
    vectors = {r.word: np.array(r.vec) for r in wordvec.train_vectors(
        docs, EmbeddingParams(vector_size=dim), rounds=12, block_words=20).collect()}  # several blocks
    words = sorted(vectors)
    tokens = [t.text.split() for t in docs.collect()]
    no = {w: i for i, w in enumerate(words)}
    count = np.zeros((len(words),) * 2)
    for w in tokens:
        for i in range(len(w)):
            for j in range(max(0, i - 2), min(len(w), i + 3)):
                if i != j:
                    count[no[w[i]], no[w[j]]] += 1
    margin = count.sum(axis=1)
    with np.errstate(divide="ignore"):
        matrix = np.maximum(np.log(count * count.sum() / np.outer(margin, margin)), 0)
    values, basis = np.linalg.eigh(matrix)
    top = np.argsort(-np.abs(values))[:dim]
    own = np.stack([vectors[w] for w in words])
    got = np.linalg.svd(own, compute_uv=False) ** 2
    assert np.allclose(got[:5], np.abs(values[top])[:5], rtol=0.02)
    lead = basis[:, top[:5]]
    space = np.linalg.qr(own)[0]
    assert (np.linalg.norm(space.T @ lead, axis=0) > 0.98).all()


def test_words_of_a_topic_and_queries_meet_their_documents(spark):
    docs, topics = corpus(spark)
    vectors, words = wordvec.embed_spectral(docs, EmbeddingParams(vector_size=16))
    queries = docs.select(F.col("doc_id").alias("query_id"), F.expr("array_join(slice(split(text, ' '), 1, 30), ' ')").alias("text"))
    asked = emb.embed_from_table(queries, words, id_col="query_id")
    near = vector.knn_exact(vectors, asked, k=5).collect()
    same = [r.query_id % topics == r.doc_id % topics for r in near]
    assert sum(same) / len(same) > 0.95
    own = {r.query_id for r in near if r.query_id == r.doc_id}
    assert len(own) > 0.5 * 120  # of 20 documents of the same topic


def test_full_texts_are_nearest_to_their_own_documents_in_300_dimensions(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("text IS NOT NULL").select("doc_id", "text")
    docs = docs.groupBy("text").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "text")
    vectors, words = wordvec.embed_spectral(docs)
    sizes = {r[0] for r in vectors.select(F.size("embedding")).distinct().collect()}
    assert sizes == {300}
    known = vectors.where(F.exists("embedding", lambda x: x != 0))
    asked = emb.embed_from_table(docs.select(F.col("doc_id").alias("query_id"), "text"), words, id_col="query_id").where("embedding IS NOT NULL")
    near = vector.knn_exact(known, asked, k=1).collect()
    assert sum(r.query_id == r.doc_id for r in near) > 0.95 * len(near) and len(near) > 100


def test_no_texts_and_rare_words(spark):
    none = spark.createDataFrame([], "doc_id bigint, text string")
    assert wordvec.embed_spectral(none, EmbeddingParams(vector_size=4))[0].count() == 0
    rare = spark.createDataFrame([(1, "once upon a time"), (2, None)], "doc_id bigint, text string")
    vectors, words = wordvec.embed_spectral(rare, EmbeddingParams(vector_size=4))
    assert words.count() == 0 and [r.embedding for r in vectors.collect()] == [[0.0] * 4] * 2


def test_no_table_of_words_or_vectors_is_sent_through_the_driver(spark, monkeypatch):
    plans = []

    def kept(df, purpose, f=wordvec._kept):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return f(df, purpose)

    monkeypatch.setattr(wordvec, "_kept", kept)
    docs = spark.createDataFrame([(d, " ".join(f"w{(d + j * j) % 12}" for j in range(30))) for d in range(40)], "doc_id bigint, text string")
    before = [spark.conf.get(k, None) for k in wordvec.LEAN]
    vectors, words = wordvec.embed_spectral(docs, EmbeddingParams(vector_size=4))
    assert len(plans) > 8 and not [p for p in plans if "Broadcast" in p]
    assert [spark.conf.get(k, None) for k in wordvec.LEAN] == before
    double = words.withColumn("vec", F.col("vec").cast("array<double>"))  # means are of doubles either way
    assert dict(words.dtypes)["vec"] == "array<float>"
    assert sorted(map(str, vectors.collect())) == sorted(map(str, emb.embed_from_table(docs, double).collect()))
