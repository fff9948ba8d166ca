from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from archivesearch.llm import seed_extend
from archivesearch.llm.hashing import hashed_words
from archivesearch.llm.seed_extend import LENGTH, anchors, cut_repeats


def brute(rows):
    """``{(id, text): (n_words, n_removed, kept)}``"""
    split = [((-(1 << 63) if i is None else i), (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, w in split:
        for p in range(len(w) - LENGTH + 1):
            s = tuple(w[p:p + LENGTH])
            first[s] = min(first.get(s, i), i)
    out = {}
    for (i, w), (raw, text) in zip(split, rows):
        gone = set()
        for p in range(len(w) - LENGTH + 1):
            if first[tuple(w[p:p + LENGTH])] < i:
                gone.update(range(p, p + LENGTH))
        out[raw, text] = (len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode())
    return out


def check(frame, rows):
    got = cut_repeats(frame).collect()
    want = brute(rows)
    assert len(got) == len(rows)
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_words, sum(s.end - s.start for s in r.removed), r.kept) for r in got) == sorted(
        (i is not None, i or 0, *want[i, t]) for i, t in rows)
    return got


def test_mixed_passages_equal_brute_force(spark, table, words):
    rng = random.Random(5)
    passages = [words(n, s) for s, n in enumerate([13, 14, 20, 40, 60, 200])]
    vocabulary = words(12, 99)  # few words, so anchors meet by chance
    rows = []
    for i in range(150):
        body = []
        for _ in range(rng.randint(0, 6)):
            p = rng.choice(passages)
            a = rng.randint(0, 4)
            body += rng.choice([p, p[a:], p[:len(p) - a], words(rng.randint(1, 20), rng.random()), rng.choices(vocabulary, k=30), p[:12]])
        rows.append((rng.randint(0, 400), rng.choice([" ", "\n", "\t  "]).join(body)))
    rows += [(500, None), (501, ""), (502, "one two"), (503, "    x"), (None, " ".join(passages[3])), (504, " ".join(passages[3]))]
    rows += [rows[3], rows[3]]
    check(table(rows), rows)


def test_hot_passages_with_other_text_around(spark, table, words):
    passage, copy = words(60, 1), " ".join(words(80, 2))
    rows = [(i, " ".join([*words(6, 1000 + i), *passage, *words(6, 5000 + i)])) for i in range(400)]
    rows += [(1000 + i, copy) for i in range(400)]
    got = check(table(rows, files=8), rows)
    spans = {r.doc_id: r.removed for r in got}
    assert [(s.start, s.end) for s in spans[7]] == [(6, 66)] and spans[1000] == [] and [(s.start, s.end) for s in spans[1001]] == [(0, 80)]


def test_repeats_within_one_document_or_id_stay(spark, table, words):
    p = words(20, 1)
    rows = [(1, " ".join(p + p)), (1, " ".join(p)), (2, "a " * 500), (2, "a " * 40), (3, "b " * 30)]
    assert all(not r.removed for r in check(table(rows), rows))


def test_very_long_text_in_blocks(spark, table, words, monkeypatch):
    long = words(90_000, 7)
    monkeypatch.setattr(seed_extend, "CHUNK", 10_000)
    rows = [(1, " ".join(long)), (2, " ".join(long[500:70_000])), (3, " ".join(words(30, 8) + long[40_000:40_050] + words(30, 9)))]
    check(table(rows), rows)


def test_empty_table_and_clashing_columns(spark, table, words):
    assert cut_repeats(table([])).count() == 0
    p = " ".join(words(30, 1))
    rows = [(1, p, 5, 6, "k", 0.5), (2, p, 7, 8, "l", 1.5)]
    docs = table(rows, "doc_id bigint, text string, id bigint, seed bigint, kept string, place double")
    got = {r.doc_id: (r.n_words, r.kept) for r in cut_repeats(docs).collect()}
    assert got == {1: (30, p), 2: (30, "")}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2), min_size=LENGTH, max_size=80), st.integers(13, 40))
def test_every_window_has_one_anchor(letters, block):
    words, counts = hashed_words([" ".join("xyz"[k] for k in letters)])
    seen = []
    for _, start, windows, before, _, _ in anchors(words, counts, block):
        for s, n, b in zip(start, windows, before):
            seen += range(s, s + n)
            assert 0 <= b <= LENGTH - 5 and b - (n - 1) >= 0
    assert sorted(seen) == list(range(len(letters) - LENGTH + 1))


@pytest.mark.parametrize("collide", [1, 3])
def test_colliding_keys_are_told_apart(spark, table, words, monkeypatch, collide):
    """All anchors share a few hashes; the extension must still find each document's own repeats."""
    plain = seed_extend.sequences

    def few(x, k):
        h = plain(x, k)
        return h % np.uint64(collide) if k == seed_extend.SEED else h

    monkeypatch.setattr(seed_extend, "sequences", few)
    texts = [" ".join(words(25, s % 3) + words(4, 50 + s)) for s in range(8)]
    rows = list(enumerate(texts))
    want = brute(rows)

    def local(rows):
        frame = table(rows, files=1)
        return {(r.doc_id, t): (r.n_words, sum(s.end - s.start for s in r.removed), r.kept)
                for r, t in zip(sorted(cut_repeats(frame).collect(), key=lambda r: r.doc_id), texts)}

    assert local(rows) == want
