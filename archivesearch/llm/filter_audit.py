"""Audit of how quality filters act on each other, by a Gray-code walk over their subsets.

1. Each row gets a mask of the filters that it fails (bit i: filter i), whatever
   the order of the filters. Rows are counted by part and mask, so a part has at
   most ``2**n`` mask cells, whatever its number of rows.
2. Per part, a reflected Gray code visits every subset of the filters, toggling one
   filter at a time. Each cell counts the active filters that it fails; where that
   count leaves or reaches 0, the cell leaves or rejoins the running survivors.
   The survivors of all ``2**n`` states are stored.
3. A step of an order is the difference between the states before and after it.

The five filters of :func:`corpus_masks`: A under 200 words; B under half of the
words distinct; C over two percent capitals; D holds a mark of ``#$%&*|``; E the
same text as a row with a smaller id.

Defined cases: a null text is empty and fails A alone (and E from the second on); a
null part is the empty string; a null id counts as larger than every id; rows
of equal id do not fail E for each other; repeated rows count each; a document
labelled twice is good (toxic) if one of its labels says so; unlabelled rows are
neither; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivesearch.llm.common import ASCII_SPACE, stage, text_or_empty

FILTERS = "ABCDE"
STEPS = ("part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
         "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint")


def text_mask(text: Column) -> Column:
    """Bits 0 to 3: the filters A to D that a text fails."""
    words = F.array_remove(F.split(text, ASCII_SPACE), "")
    n = F.size(words)
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    fails = [n < 200, 100 * F.size(F.array_distinct(words)) < 50 * n, 100 * capitals > 2 * F.length(text),
             text.rlike(r"[#$%&*|]")]
    return sum((F.when(f, F.lit(1 << i)).otherwise(F.lit(0)) for i, f in enumerate(fails)), F.lit(0))


def corpus_masks(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text",
                 part: str = "source") -> DataFrame:
    """``(part, mask, good, toxic)`` of each row of ``docs``.

    Equal texts meet as SHA-256 digests, in a partial aggregate; the row that stays is found by a join on
    digest and id, so that many copies of one text are spread over tasks.
    """
    body = text_or_empty(text)
    rows = stage(docs.select(
        F.coalesce(F.col(doc_id).cast("bigint"), F.lit((1 << 63) - 1)).alias("id"),
        F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(body.cast("binary"), 256)).alias("digest"), text_mask(body).alias("mask")), "audit")
    first = rows.groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(True))
    marks = labels.groupBy(F.col(doc_id).cast("bigint").alias("id")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"))
    return rows.join(first, ["digest", "id"], "left").join(marks, "id", "left").select(
        "part", (F.col("mask") + F.when(F.col("first"), 0).otherwise(16)).alias("mask"),
        F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"))


def mask_cells(masks: DataFrame) -> DataFrame:
    """``(part, mask, n, good, toxic)``: the rows of each cell, and the good and toxic ones of them."""
    return masks.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").cast("bigint").alias("good"), F.sum("toxic").cast("bigint").alias("toxic"))


def gray_states(masks: np.ndarray, counts: np.ndarray, filters: int) -> np.ndarray:
    """Survivors (sums of the rows of ``counts``) of each of the ``2**filters`` subsets of filters.

    One filter is toggled at a time; ``active`` has the number of active filters that each cell fails."""
    active = np.zeros(len(masks), dtype=np.int64)
    alive = counts.sum(axis=0)
    states = np.zeros((1 << filters, counts.shape[1]), dtype=np.int64)
    states[0], subset = alive, 0
    for turn in range(1, 1 << filters):
        toggled = turn & -turn  # the lowest set bit of the count is the bit that the Gray code flips
        subset ^= toggled
        hit = (masks & toggled) != 0
        if subset & toggled:
            alive = alive - counts[hit & (active == 0)].sum(axis=0)
            active[hit] += 1
        else:
            active[hit] -= 1
            alive = alive + counts[hit & (active == 0)].sum(axis=0)
        states[subset] = alive
    return states


def order_steps(states: np.ndarray, names: str) -> pd.DataFrame:
    """One row for each step of each order of the filters, from the stored states."""
    everything = len(states) - 1
    rows = []
    for order in permutations(range(len(names))):
        before = 0
        for step, f in enumerate(order, 1):
            kept, lost = states[before | 1 << f], states[before] - states[before | 1 << f]
            failing = states[0, 0] - states[1 << f, 0]
            alone = states[everything ^ 1 << f, 0] - states[everything, 0]
            rows.append(("".join(names[g] for g in order), step, f, kept[0], lost[0], failing - lost[0], alone, lost[1], lost[2]))
            before |= 1 << f
    out = pd.DataFrame(rows, columns=["filter_order", "step", "f", "kept", "removed", "redundant", "unique_fails",
                                      "good_lost", "toxic_lost"])
    return out.assign(shapley=out.groupby("f")["removed"].transform("sum")).drop(columns="f")


def filter_audit(cells: DataFrame, names: str = FILTERS) -> DataFrame:
    """The steps (see :data:`STEPS`) of all orders of the filters for each part of ``cells``.

    A group holds the at most ``2**len(names)`` cells of one part."""
    def walked(pdf: pd.DataFrame) -> pd.DataFrame:
        states = gray_states(pdf["mask"].to_numpy(np.int64), pdf[["n", "good", "toxic"]].to_numpy(np.int64), len(names))
        return order_steps(states, names).assign(part=pdf["part"].iloc[0])[
            [column.split()[0] for column in STEPS.split(", ")]]

    return cells.groupBy("part").applyInPandas(walked, STEPS)
