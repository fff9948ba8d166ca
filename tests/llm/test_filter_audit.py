from __future__ import annotations

import random
import re
from itertools import permutations

import numpy as np
import pytest

from archivesearch.llm.filter_audit import FILTERS, corpus_masks, filter_audit, gray_states, mask_cells

DOCS = "doc_id bigint, text string, source string, mask int"


def brute_mask(row, rows):
    text = row[1] or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    first = min((r[0] for r in rows if (r[1] or "") == text and r[0] is not None), default=None)
    fails = [len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", text)) > 2 * len(text),
             re.search(r"[#$%&*|]", text), first is not None and (row[0] is None or first < row[0])]
    return {f for f, bad in zip(FILTERS, fails) if bad}


def brute_audit(rows, labels):
    out = {}
    for part in {r[2] or "" for r in rows}:
        mine = [(r, brute_mask(r, rows)) for r in rows if (r[2] or "") == part]
        removed_by = dict.fromkeys(FILTERS, 0)
        for order in permutations(FILTERS):
            gone = set()
            for step, f in enumerate(order, 1):
                here = {i for i, (_, fails) in enumerate(mine) if f in fails and i not in gone}
                redundant = sum(f in fails and i in gone for i, (_, fails) in enumerate(mine))
                gone |= here
                removed_by[f] += len(here)

                def marked(column):
                    return sum(any(lab[0] == mine[i][0][0] and lab[column] == 1 for lab in labels) for i in here)

                out[part, "".join(order), step] = [len(mine) - len(gone), len(here), redundant,
                                                   sum(fails == {f} for _, fails in mine), marked(1), marked(2), f]
        for key in out:
            if key[0] == part:
                out[key][6] = removed_by[out[key][6]]
    return out


def audit(docs, labels):
    return {(r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
            for r in filter_audit(mask_cells(corpus_masks(docs, labels))).collect()}


def test_all_orders_equal_a_plain_walk(spark, table, words):
    rng = random.Random(3)
    long = [" ".join(words(250, s)) for s in range(4)]
    texts = [*long, long[0] + " 5%", " ".join(words(30, 9) * 9), "ABC " * 220, "", None, "a#b", "X " + long[1], "\t \n",
             "é" * 50 + " Ab"]
    rows = [(i, rng.choice(texts), rng.choice(["s1", "s2", "", None]), None) for i in range(60)]
    rows += [(7, long[2], "s1", None), (7, long[2], "s1", None), (None, long[3], "s2", None), (None, "only here", "s2", None)]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1])) for i in range(0, 60, 2)] + [(4, 1, 1), (4, 0, 0), (999, 1, 1)]
    docs, marks = table(rows, DOCS), table(labels, "doc_id bigint, quality int, toxic int")
    assert audit(docs, marks) == brute_audit(rows, labels)


def test_empty_tables(spark, table):
    docs, marks = table([], DOCS), table([], "doc_id bigint, quality int, toxic int")
    assert audit(docs, marks) == {}
    some = audit(table([(1, None, None, 5)], DOCS), marks)
    assert len(some) == 600 and some["", "ABCDE", 1] == [0, 1, 0, 1, 0, 0, 120]


def test_one_very_frequent_and_one_very_long_text(spark, table, words):
    body, long = " ".join(words(220, 1)), " ".join(words(120_000, 2))
    docs = table([(i, body, "s", 0) for i in range(3000)] + [(9000, long, "s", 0), (9001, long, "t", 0)], DOCS)
    found = audit(docs, table([], "doc_id bigint, quality int, toxic int"))
    assert found["s", "EABCD", 1][:4] == [2, 2999, 0, 2999]
    assert found["t", "EABCD", 1][:2] == [0, 1]


@pytest.mark.parametrize("filters", [1, 3, 5, 6])
def test_states_are_the_survivors_of_each_subset(filters):
    rng = np.random.default_rng(filters)
    masks, counts = np.arange(1 << filters), rng.integers(0, 50, (1 << filters, 3))
    states = gray_states(masks, counts, filters)
    for subset in range(1 << filters):
        assert (states[subset] == counts[(masks & subset) == 0].sum(axis=0)).all()
