from __future__ import annotations

import random
import re
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from archivesearch.llm import ngram_join
from archivesearch.llm.components import components
from archivesearch.llm.hashing import hashed_words, shingle_sets
from archivesearch.llm.ngram_join import jaccard_components


def shingles(text, k=4):
    w = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)] if w else [])


def brute(rows, percent=85):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        low[find(i)] = min(low.get(find(i), d), d)
    return sorted((d, len(sets[i]), low[find(i)]) for i, (d, _) in enumerate(rows))


def corpus(words, seed=5):
    """Families of near copies of many sizes, lines and passages that all share, and singles."""
    rng = random.Random(seed)
    line = words(12, 777)
    rows = []
    for family, (size, n) in enumerate([(40, 120), (3, 900), (25, 400), (12, 30), (2, 8), (9, 70), (2, 15), (15, 62), (6, 66)]):
        base = words(n, 10 + family)
        for _ in range(size):
            own = list(base)
            for _ in range(rng.randint(0, max(1, n // 25))):
                own[rng.randrange(n)] = rng.choice(["x", "y", "z", "uvw"])
            rows.append(" ".join(own))
    for s in range(60):
        rows.append(" ".join(words(rng.randint(1, 60), 500 + s) + line + words(rng.randint(0, 30), 900 + s)))
    rows += [" ".join(line)] * 12 + ["a b c", "A\tb\nc", "a b", "", None, " ", "a b c d", "a  b c d"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def result(df):
    return sorted((r.id, r.n_shingles, r.component_id) for r in df.collect())


def test_components_match_brute_force(table, words):
    rows = corpus(words)
    assert result(jaccard_components(table(rows, files=4))) == brute(rows)


def test_combinations_alone_lose_nothing(table, words, monkeypatch):
    monkeypatch.setattr(ngram_join, "RARE", 1)  # every shared token is frequent
    rows = corpus(words, 6)[::2]
    assert result(jaccard_components(table(rows))) == brute(rows)


def test_small_and_odd_tables(table, spark):
    assert jaccard_components(table([])).count() == 0
    assert result(jaccard_components(table([(4, None), (2, "")]))) == [(2, 0, 2), (4, 0, 4)]
    docs = table([(5, "q w e r t"), (5, "q w e r t"), (3, "q W e r t"), (5, "other")]).withColumn("name", F.lit(1)).withColumn("n", F.lit(2))
    assert result(jaccard_components(docs)) == [(3, 2, 3), (5, 1, 5), (5, 2, 3), (5, 2, 3)]


def test_hashes_do_not_depend_on_neighbours(words):
    texts = [" ".join(words(n, n)) for n in range(0, 50)] + ["É é", "A B c", "a b C", "\x0b\x0c"]
    together = [s.tolist() for s in shingle_sets(texts, 4)]
    alone = [next(iter(shingle_sets([t], 4))).tolist() for t in texts]
    small = [s.tolist() for s in shingle_sets(texts, 4, chunk=40)]
    assert together == alone == small
    assert [len(s) for s in together] == [len(shingles(t)) for t in texts]
    many = sorted({w for n in range(300) for w in words(60, n)})
    assert len(np.unique(hashed_words([" ".join(many)])[0])) == len(many)


def test_a_batch_of_texts_is_hashed_in_small_parts(words):
    text = " ".join(words(400, 1))
    texts = [text] * (4_000_000 // len(text))
    tracemalloc.start()
    n = sum(len(s) for s in shingle_sets(texts, 4))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 397 * len(texts) and peak < 20_000_000  # parts of 1 MB took 42 MB


@pytest.mark.parametrize("seed", range(2))
def test_components_of_random_links(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(90)] + [(i, i + 1) for i in range(300, 360)]
    root = {}

    def find(i):
        while root.setdefault(i, i) != i:
            i = root[i]
        return i

    for a, b in links:
        if a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    want = sorted((i, find(i)) for i in root)
    got = sorted(map(tuple, components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    assert got == want


def test_the_driver_holds_no_joined_tables_and_plans_stay_small(table, spark, words, monkeypatch):
    """Each joined table of links and each copy of the links in one plan is memory of the driver."""
    plans, write = [], ngram_join.stage

    def noted(df, purpose):
        plans.append((purpose, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, purpose)

    monkeypatch.setattr(ngram_join, "stage", noted)
    monkeypatch.setattr("archivesearch.llm.components.stage", noted)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    rows = corpus(words)
    assert sorted(tuple(r) for r in jaccard_components(table(rows)).select("id", "n_shingles", "component_id").collect()) == brute(rows)
    assert {"large-stars", "stars", "pairs-first", "links-first"} <= {p for p, _ in plans}
    assert not [p for p, plan in plans if "BroadcastExchange" in plan]
    stars = [plan.count("FileScan") for p, plan in plans if "stars" in p]
    assert stars and max(stars) <= 4
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before
