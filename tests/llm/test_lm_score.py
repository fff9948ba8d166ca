from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from archivesearch.llm.lm_score import backoff_scores, pack_counts, pack_sorted, unpack_counts, unpack_sorted


def brute(rows, order=3):
    texts = [re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for _, t in rows]
    per = [Counter(tuple(w[i:i + k]) for k in range(order + 1) for i in range(len(w) - k + 1 if k else len(w))) for w in texts]
    total = sum(per, Counter())
    out = []
    for (d, _), w, own in zip(rows, texts, per):
        score, backed = 0.0, 0
        for i in range(len(w)):
            longest = min(i + 1, order)
            for k in range(longest, 0, -1):
                g = tuple(w[i - k + 1:i + 1])
                c, context = total[g] - own[g], total[g[:-1]] - own[g[:-1]]
                if c > 0 or k == 1:
                    score += math.log(max(c, 1) / max(context, 1)) + (longest - k) * math.log(0.4)
                    backed += k < longest
                    break
        out.append((d, len(w), backed, round(score, 6)))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.id, r.n_words, r.n_backed_off, round(r.log_score, 6)) for r in df.collect()), key=str)


def rows_of(words, n=80):
    rng = random.Random(3)
    pool = words(60, 1)
    rows = [(i, " ".join(rng.choices(pool, weights=range(1, 61), k=rng.randint(0, 60)))) for i in range(n)]
    return rows + [(500, rows[3][1]), (501, rows[3][1].upper()), (502, None), (503, " \t"), (3, "twice"), (3, "twice"),
                   (None, "the é"), (504, "the the " * 300)]


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_matches_brute_force(table, words, order):
    rows = rows_of(words)
    assert result(backoff_scores(table(rows), order, chunk_bytes=3000)) == brute(rows, order)


def test_chunks_do_not_change_scores(table, words):
    docs = table(rows_of(words)).withColumn("chunk", F.lit(1)).withColumn("id", F.lit(1))
    assert result(backoff_scores(docs)) == result(backoff_scores(docs, chunk_bytes=500))


def test_one_document_and_none(table):
    assert backoff_scores(table([])).count() == 0
    assert result(backoff_scores(table([(1, "a b a")]))) == brute([(1, "a b a")])


def test_packed_rows_round_trip():
    rng = np.random.default_rng(1)
    for top in (10, 2**20, 2**64 - 1):
        h = np.unique(rng.integers(0, top, 500, dtype=np.uint64, endpoint=True))
        assert np.array_equal(unpack_sorted(len(h), *pack_sorted(h)), h)
    n = rng.integers(1, 600, 100)
    assert np.array_equal(unpack_counts(100, *pack_counts(n)), n)
