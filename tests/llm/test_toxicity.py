from __future__ import annotations

import math
import random

import numpy as np
from pyspark.sql import functions as F

from archivesearch.llm import toxicity
from archivesearch.llm.toxicity import MAX_N, MIN_N, Features, Sample, held_out, labelled_sample, log_count_ratios, score, train

LABELS = "doc_id bigint, toxic int"


def grams(text):
    out = set()
    for w in set(text.lower().split()):
        m = f" {w} "
        out |= {m[a:a + n] for n in range(MIN_N, MAX_N + 1) for a in range(len(m) - n + 1)}
    return out


def make(words, n=240):
    rng = random.Random(2)
    pool = words(300, 1)
    rows, labels = [], []
    for i in range(n):
        body = rng.choices(pool, k=30)
        bad = i % 3 == 0
        if bad:
            body += rng.choices(["vileword", "scumbags", "idiotic"], k=3)
        rng.shuffle(body)
        rows.append((i, " ".join(body)))
        labels.append((i, int(bad)))
    return rows, labels


def test_features_are_the_distinct_grams_of_the_words():
    texts = ["Ab cab ab", "", "x", "ünïcode wörds", "a " * 9]
    for text, found in zip(texts, Features().of(texts)):
        assert len(found) == len(set(found.tolist())) <= len(grams(text))
        if len(text) > 2:
            assert len(found) >= 0.99 * len(grams(text))


def test_ratios_equal_counts_by_hand():
    counts = np.array([[8.0, 0.0, 3.0, 2.0, 40.0], [1.0, 9.0, 1.0, 30.0, 41.0]])
    rows, weight = np.array([50, 45]), np.array([2.0, 0.5])
    got = log_count_ratios(counts, rows, weight)
    for k in range(5):
        by_hand = math.log(((1 + 0.5 * counts[1, k]) / (2 + 0.5 * 45)) / ((1 + 2 * counts[0, k]) / (2 + 2 * 50)))
        counted = counts[:, k].sum() >= toxicity.LEAST and abs(by_hand) >= toxicity.TELL
        assert math.isclose(got[k], by_hand if counted else 0.0)


def test_fit_equals_a_dense_regression():
    """The same loss on a dense matrix by plain gradient steps reaches no lower value than the fit, within a margin."""
    rng = np.random.default_rng(1)
    n, size = 90, 40
    toxic = (np.arange(n) % 2).astype(float)
    present = rng.random((n, size)) < np.where(toxic[:, None] == 1, np.linspace(0.9, 0.1, size), np.linspace(0.1, 0.9, size))
    row, column = (a.astype(np.int32) for a in np.nonzero(present))
    counts = np.stack([[present[(np.arange(n) % 3 == f) & (toxic == c)].sum(axis=0) for c in (0, 1)] for f in range(3)]).astype(float)
    weight = np.array([1.2, 0.8])
    sample = Sample(row, column, toxic, counts, weight)
    w, bias = sample.fit(rounds=2000, step=0.02)
    ratio = log_count_ratios(counts.sum(axis=0), np.array([(toxic == c).sum() for c in (0, 1)]), weight)
    x = present * ratio
    share = np.where(toxic == 1, 0.8, 1.2)
    share = share / share.sum()

    def loss(u, b):
        z = x @ u + b
        return float((share * (np.logaddexp(0, z) - toxic * z)).sum() + 0.0025 * (u * u).sum())

    u, b = np.zeros(size), 0.0
    for _ in range(30_000):
        error = (1 / (1 + np.exp(-(x @ u + b))) - toxic) * share
        u, b = u - 0.05 * (x.T @ error + 0.005 * u), b - 0.05 * error.sum()
    own = np.divide(w, ratio, out=np.zeros(size), where=ratio != 0)
    assert abs(loss(own, bias) - loss(u, b)) < 1e-3
    assert np.allclose(sample.logits(w, bias), x @ own + bias)


def test_sample_is_bounded_by_rows_and_bytes(spark, table, words):
    rows, labels = make(words)
    rows = rows * 2 + [(7, "other text of an id that is there")]
    known = table(labels, LABELS).select(F.col("doc_id").alias("__id"), F.col("toxic").alias("__toxic"))
    some = labelled_sample(table(rows), known, 20, 1 << 20, "doc_id", "text").collect()
    assert sorted(r.row for r in some) == list(range(40)) and sum(r.toxic for r in some) == 20
    small = labelled_sample(table(rows), known, 20, 2000, "doc_id", "text").collect()
    assert 2 <= len(small) < 40 and sum(len(r.body) for r in small) <= 2000
    assert len(labelled_sample(table(rows), known, 20, 1, "doc_id", "text").collect()) == 2


def test_learns_and_replaces_a_clashing_column(spark, table, words):
    rows, labels = make(words)
    docs = table([(*r, "mine", 5) for r in rows], "doc_id bigint, text string, score string, row int")
    model = train(docs, table(labels[:180], LABELS))
    got = {r.doc_id: r.score for r in score(docs, model).collect()}
    right = sum((got[i] >= 0.5) == (t == 1) for i, t in labels[180:])
    assert right == 60 and score(docs, model).columns == ["doc_id", "text", "row", "score"]


def test_held_out_accuracy_on_the_given_table(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = train(docs, labels.where(~held_out(F.col("doc_id"))))
    rows = score(docs.join(labels.where(held_out(F.col("doc_id"))), "doc_id"), model).select("toxic", "score").collect()
    bad, good = ([r.score for r in rows if r.toxic == t] for t in (1, 0))
    auc = sum((b > g) + 0.5 * (b == g) for b in bad for g in good) / (len(bad) * len(good))
    recall, wrong = sum(b >= 0.5 for b in bad) / len(bad), sum(g >= 0.5 for g in good)
    print(f"AUC {auc:.4f} recall {recall:.3f} precision {sum(b >= 0.5 for b in bad) / (sum(b >= 0.5 for b in bad) + wrong):.3f}")
    assert auc > 0.97 and recall > 0.8 and wrong < 0.02 * len(good)
