from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from archivesearch.llm import suffix_dedup
from archivesearch.llm.suffix_dedup import parse, remove_repeats


def brute(rows):
    seen, out = set(), []
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0))
    for i in order:
        raw = (rows[i][1] or "").encode()
        gone = bytearray(len(raw))
        for p in range(len(raw) - 99):
            s = raw[p:p + 100]
            if s in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(s)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((rows[i][0], len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.id, r.n_bytes, r.n_removed, len(r.removed), r.kept_sha256) for r in df.collect()), key=str)


def corpus(words, seed=1):
    rng = random.Random(seed)
    passages = [" ".join(words(rng.randint(15, 60), 50 + p)) for p in range(12)]
    rows = []
    for d in range(120):
        parts = [" ".join(words(rng.randint(0, 40), 1000 + d))]
        for _ in range(rng.randint(0, 3)):
            p = rng.choice(passages)
            if rng.random() < 0.3:
                a = rng.randrange(len(p))
                p = p[:a] + "ü" + p[a + rng.randint(0, 2):]
            parts += [p, rng.choice(["", "é", " ".join(words(5, 7 * d))])]
        rows.append((d, rng.choice(["", " ", "\n"]).join(parts)))
    rows += [(200 + i, rows[i][1]) for i in range(0, 30, 3)]
    rows += [(300, "a" * 400), (301, "ab" * 300), (302, "a" * 99), (303, "a" * 100), (304, None), (305, ""), (306, "abc" * 100),
             (307, passages[0] * 5), (None, passages[1])]
    rng.shuffle(rows)
    return rows


def test_matches_brute_force(table, words):
    rows = corpus(words)
    assert result(remove_repeats(table(rows, files=5))) == brute(rows)
    assert sum(r[2] > 0 for r in brute(rows)) > 60


def test_small_pieces_and_crowded_triggers(table, words, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 700)  # documents span several pieces
    monkeypatch.setattr(suffix_dedup, "MANY", 1)
    rows = corpus(words, 2)
    assert result(remove_repeats(table(rows, files=3))) == brute(rows)


def test_odd_tables(table, words):
    assert remove_repeats(table([])).count() == 0
    text = " ".join(words(80, 3))[:300]
    docs = table([(1, text), (1, text), (2, "x" + text), (2, "short")]).withColumn("id", F.lit(0)).withColumn("tag", F.lit(""))
    assert [(r[0], r[2]) for r in result(remove_repeats(docs))] == [(1, 0), (1, 0), (2, 300), (2, 0)]


@pytest.mark.parametrize("seed", range(3))
def test_every_string_lies_in_one_phrase(seed):
    rng = random.Random(seed)
    bodies = [bytes(rng.choices(b"ab ", k=rng.choice([0, 99, 100, 101, 500, 3000]))) for _ in range(20)]
    got = [[] for _ in bodies]
    for _, _, document, place, more in parse(bodies):
        for d, p, m in zip(document, place, more):
            got[d] += range(p, p + m + 1)
    assert all(sorted(g) == list(range(max(0, len(b) - 99))) for g, b in zip(got, bodies))
    assert np.array_equal(*(next(parse([b"x" * 50 + bytes(range(200))]))[0] for _ in range(2)))
