from __future__ import annotations

import random
import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from archivesearch.llm.ngram_join import keep_one_of_each
from archivesearch.llm.toxicity import held_out, score, train

INSULTS = ["idiot", "moron", "scum", "clown"]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """Documents with toxic ones, copies, near copies and benchmark passages planted."""
    rng = random.Random(9)
    pool = ["".join(rng.choices("abcdefghijklm", k=rng.randint(3, 8))) for _ in range(3000)]
    item = " ".join(rng.choices(pool, k=30))
    plain = [rng.choices(pool, k=rng.randint(40, 80)) for _ in range(160)]
    rows, toxic, copies, near, leaks = [], set(), set(), set(), set()
    for d, words in enumerate(plain):
        if d % 4 == 1:
            words = words[:]
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
            toxic.add(d)
        rows.append((d, " ".join(words)))
    for k in range(10):
        copies.add(1000 + k)
        rows.append((1000 + k, rows[4 * k][1].replace(" ", " \n", 3)))
        near.add(2000 + k)
        rows.append((2000 + k, rows[4 * k + 2][1] + " tail"))
        leaks.add(3000 + k)
        rows.append((3000 + k, " ".join(rng.choices(pool, k=20)) + " " + item + " " + " ".join(rng.choices(pool, k=20))))
    rows += [(4000, None), (4001, "")]
    rng.shuffle(rows)
    d = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, "doc_id bigint, text string").withColumns(
        {"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("bigint")}).write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, 0, int(i in toxic)) for i, _ in rows if i < 160], "doc_id bigint, quality int, toxic int").write.parquet(
        f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{d}/benchmark.parquet")
    return d, rows, toxic, copies, near, leaks


def test_stages_take_planted_rows_and_leave_the_rest(spark, sf_dir):
    d, rows, toxic, copies, near, leaks = sf_dir
    docs = spark.read.parquet(f"{d}/documents.parquet")
    columns, went = docs.columns, []
    for k, (_, function) in enumerate(corpus_pipeline.STAGES[:4]):
        left = corpus_pipeline.stage(function(spark, docs, d), "test")
        assert left.columns == columns
        went.append({r.doc_id for r in docs.select("doc_id").collect()} - {r.doc_id for r in left.select("doc_id").collect()})
        docs = left
    assert went[0] == toxic
    assert went[1] == copies | {4001}  # the empty text equals the null one
    assert went[2] == near | (leaks & went[2]) and not leaks & went[2]
    assert went[3] == leaks
    pieces = corpus_pipeline.STAGES[4][1](spark, docs, d).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in docs.collect()}


def test_run_equals_its_stages(spark, sf_dir):
    d, rows, toxic, copies, near, leaks = sf_dir
    kept = {r.doc_id for r in corpus_pipeline.run(spark, d).collect()}
    assert kept == {i for i, _ in rows} - toxic - copies - near - leaks - {4001}


def test_near_copies_match_brute_force(table, words):
    rng = random.Random(4)
    rows = []
    for f in range(30):
        base = words(40, f)
        for _ in range(rng.randint(1, 4)):
            own = base[:]
            own[rng.randrange(40)] = "changed"
            rows.append((len(rows), " ".join(own)))
    rows += [(900, None), (901, ""), (902, None), (None, rows[0][1]), (3, "same id, other text of six words")]

    def sh(t):
        w = re.findall(r"\S+", t or "")
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    keep = []
    for i, t in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):  # single linkage within families
        s = sh(t)
        linked = [f for f in keep if s and any(len(s & x) * 100 >= 80 * len(s | x) for x in f[1])]
        own = (i, [s])
        for f in linked:
            keep.remove(f)
            own = (min(own[0] if own[0] is not None else 10**9, f[0]), own[1] + f[1])
        keep.append(own)
    got = sorted(r.doc_id for r in keep_one_of_each(table(rows)).collect())
    assert got == sorted(f[0] for f in keep)


def test_toxicity_on_held_out_rows(spark):
    d = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    model = train(docs, labels.where(~held_out(F.col("doc_id"))))
    test = score(docs.join(labels.where(held_out(F.col("doc_id"))), "doc_id").select("doc_id", "text", "toxic"), model)
    rows = test.select("toxic", "score").collect()
    right = sum((r.score >= 0.5) == (r.toxic == 1) for r in rows)
    found = sum(r.score >= 0.5 and r.toxic == 1 for r in rows)
    assert right > 0.97 * len(rows) and found > 0.75 * sum(r.toxic for r in rows)


def test_toxicity_without_labels_and_of_odd_texts(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None), (None, ""), (2, "idiot " * 50_000)], "doc_id bigint, text string")
    labels = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert {r.score for r in score(docs, train(docs, labels)).collect()} == {0.5}
    labels = spark.createDataFrame([(1, 0), (1, 0), (9, 1), (2, None)], "doc_id bigint, toxic int")
    scores = [r.score for r in score(docs.withColumn("score", F.lit("x")), train(docs, labels), into="p").select(F.col("p").alias("score")).collect()]
    assert len(scores) == 4 and all(0 <= s <= 1 for s in scores)
    assert score(docs.limit(0), train(docs, labels)).count() == 0
