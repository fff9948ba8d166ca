from __future__ import annotations

import random
import re
from collections import Counter

from pyspark.sql import functions as F

from archivesearch.llm import decontaminate
from archivesearch.llm.decontaminate import block_values, fingerprint, similar_windows, without_benchmark


def split(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def brute(docs, items, percent=80):
    """Every window of every document against every item."""
    out = set()
    for doc, text in docs:
        w = split(text)
        for item, item_text in items:
            v = split(item_text)
            if not v or not w:
                continue
            k, n = min(5, len(v)), len(v)
            if len(w) < k:
                continue
            b = Counter(tuple(v[i:i + k]) for i in range(n - k + 1))
            best = None
            for s in range(max(1, len(w) - n + 1)):
                win = w[s:s + n]
                a = Counter(tuple(win[i:i + k]) for i in range(len(win) - k + 1))
                shared = sum((a & b).values())
                total = sum((a | b).values())
                if shared and 100 * shared >= percent * total and (best is None or shared / total > best[0]):
                    best = (shared / total, s, shared, total)
            if best:
                out.add((doc, item, *best[1:]))
    return out


def got(df):
    return {(r.id, r.item_id, r.start, r.shared, r.total) for r in df.collect()}


def test_matches_all_windows_of_brute_force(table, words):
    rng = random.Random(3)
    items = [(i, " ".join(words(rng.randint(3, 60), i))) for i in range(25)]
    items += [(100, "tic tac " * 12), (101, "one"), (102, ""), (103, None), (104, items[0][1])]
    docs = []
    for d in range(80):
        body = words(rng.randint(0, 120), 1000 + d)
        for _ in range(rng.randint(0, 2)):
            part = (rng.choice(items)[1] or "").split()
            for _ in range(rng.randint(0, 2)):  # small edits
                if part:
                    part[rng.randrange(len(part))] = rng.choice(["edit", "", "two words"])
            at = rng.randint(0, len(body))
            body[at:at] = part
        docs.append((d, " ".join(body)))
    docs += [(900, None), (901, ""), (902, items[5][1].upper().replace(" ", "!! ")), (903, items[5][1].rsplit(" ", 1)[0])]
    found = similar_windows(table(docs), table(items, "item_id bigint, text string", 1))
    assert got(found) == brute(docs, items)
    assert len(brute(docs, items)) > 20


def test_runs_of_one_word_are_compared(table, words):
    rng = random.Random(9)
    items, docs = [], []
    for i in range(12):  # 160 shingles shared, 16 equal and 4 mixed ones differ on each side: similarity 0.8
        same = [f"{w}{j}" for j, w in enumerate(words(164, 50 + i))]
        items.append((i, " ".join(same + [f"run{i}"] * 20)))
        docs.append((i, " ".join(words(rng.randint(0, 9), 90 + i) + same + [f"other{i}"] * 20)))
    found = got(similar_windows(table(docs), table(items, "item_id bigint, text string", 1)))
    assert found == brute(docs, items) and len(found) == 12 and {f[3:] for f in found} == {(160, 200)}


def test_blocks_hold_every_pair_within_the_radius():
    rng = random.Random(1)
    values = set(block_values(23))
    for _ in range(2000):
        change = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 23)))
        assert any((change >> 8 * p) & 255 in values for p in range(8))


def test_fingerprint_is_the_majority_of_each_bit(spark):
    rng = random.Random(2)
    hashes = [rng.getrandbits(64) - (1 << 63) for _ in range(9)]
    frame = spark.createDataFrame([(1, h) for h in hashes], "k int, h bigint")
    fp = fingerprint(frame, ["k"]).first().fp & (2**64 - 1)
    want = sum((sum((h & (2**64 - 1)) >> b & 1 for h in hashes) > 4) << b for b in range(64))
    assert fp == want


def test_filter_keeps_clean_repeated_and_odd_rows(table, words):
    item = " ".join(words(30, 1))
    clean = " ".join(words(50, 2))
    docs = table([(1, clean), (2, f"{clean} {item}"), (2, f"{clean} {item}"), (None, None), (None, item), (3, ""), (3, clean)])
    items = table([(7, item)], "item_id bigint, text string", 1)
    left = without_benchmark(docs.withColumn("h", F.lit(1)).withColumn("key", F.lit(2)), items)
    assert sorted((r.doc_id or 0, r.text or "") for r in left.collect()) == sorted([(1, clean), (0, ""), (3, ""), (3, clean)])
    assert similar_windows(docs, items).count() == 2
    assert without_benchmark(docs, table([], "item_id bigint, text string", 1)).count() == 7
    assert similar_windows(table([]), items).count() == 0


def test_texts_are_shuffled_to_the_hits_and_not_their_words(spark, monkeypatch):
    from archivesearch.llm import decontaminate as dec

    seen, whole = {}, dec.stage
    monkeypatch.setattr(dec, "stage", lambda df, purpose: whole(seen.setdefault(purpose, df), purpose))
    docs = spark.createDataFrame([(1, "x one two three four five six y"), (2, "none of it"), (3, None)], "doc_id bigint, text string")
    items = spark.createDataFrame([(7, "one two three four five six")], "item_id bigint, text string")
    assert [(r.id, r.item_id, r.start) for r in dec.similar_windows(docs, items).collect()] == [(1, 7, 1)]
    plan = seen["windows"]._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().head()
    assert [c.split("#")[0] for c in plan.children().head().output().mkString(",").split(",")] == ["key", "id", "text"]


def test_windows_are_dealt_by_their_number_and_kept_as_texts(spark, table, words, monkeypatch):
    items = [(i, " ".join(words(20, i))) for i in range(5)]
    docs = [(d, " ".join(words(30, 50 + d) + items[d % 5][1].split() + words(10, 90 + d))) for d in range(20)]
    docs += docs[:3]
    kept = {}
    monkeypatch.setattr(decontaminate, "stage", lambda df, name, f=decontaminate.stage: kept.setdefault(name, f(df, name)))
    monkeypatch.setattr(decontaminate, "TASK_WINDOWS", 10)
    d, i = table(docs, "doc_id bigint, text string"), table(items, "item_id bigint, text string")
    found = similar_windows(d, i)
    assert got(found) == brute(docs, items)
    assert not [kind for _, kind in kept["windows"].dtypes if kind == "array<string>"]
    n = kept["windows"].select(F.sum(F.size("starts"))).first()[0]
    tasks = max(spark.sparkContext.defaultParallelism, -(-n // 10))
    assert n > 200 and re.search(rf"hashpartitioning\(key#\d+L, n#\d+, {tasks}\), REPARTITION_BY_NUM",
                                 found._jdf.queryExecution().executedPlan().toString())
