"""Character n-gram linear classifier with naive-Bayes log-count-ratio features.

A document's features are the hashed character n-grams (``MIN_N`` to ``MAX_N``,
within lower-cased white-space-separated words, with a mark at either end)
present in it. Each is scaled by its log-count ratio
``log((1 + toxic with it) / (1 + clean with it))``, both normalised by class, and
a logistic regression is fitted on the scaled features; the scale and shift of
its logits are fitted on rows that cross-validation left out. Only the sample that
the model is fitted on is bounded: ``per_class`` labelled rows of each class,
those with the smallest hash of the id, and of them as many, one at least, as have
``sample_bytes / 2`` bytes of text together; they are weighted back to the class frequencies
of all labelled rows. N-grams of the sample are counted by class and fold in executors; those
that at least ``LEAST`` rows have and whose ratio is at least ``TELL`` in size are chosen before the fit,
so that the fit, in one task, holds the chosen pairs of row and n-gram alone, and no text.
Every document is scored on its whole text in Arrow batches; the fitted weights (``2**BITS`` floats) are broadcast.

Defined cases: null and empty texts have no features and score the intercept;
null ids are scored; labels other than 0 and 1 are ignored; a document labelled
twice counts twice; without labels of both classes every score is the smoothed
share of toxic labels (0.5 without any); extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivesearch.llm.common import forget_kept, lean, small_batches, stage, text_or_empty

BITS = 18
MIN_N, MAX_N = 3, 6
#: Labelled rows of each class that the model is fitted on at most.
PER_CLASS = 3000
#: Bytes of their texts at most (but for one row of each class).
SAMPLE_BYTES = 64 << 20
FOLDS = 3
#: An n-gram counts if this many rows of the sample have it and its log-count ratio is at least TELL in size.
LEAST, TELL = 5, 1.0
CACHED_WORDS = 25_000


@dataclass
class Model:
    """Weights of the hashed n-grams, already multiplied by their ratios, and the intercept."""

    weights: np.ndarray
    intercept: float


def word_grams(words: list[str]) -> list[np.ndarray]:
    """Hashed n-grams of each word."""
    if not words:
        return []
    marked = [f" {w} ".encode("utf-32-le", "surrogatepass") for w in words]
    chars = np.frombuffer(b"".join(marked), dtype=np.uint32).astype(np.uint64)
    ends = np.cumsum([len(m) // 4 for m in marked])
    left = np.repeat(ends, np.diff(ends, prepend=0)) - np.arange(len(chars))  # characters up to the word's end
    owner = np.repeat(np.arange(len(words)), np.diff(ends, prepend=0))
    hashes, owners = [], []
    h = np.zeros(len(chars), dtype=np.uint64)
    for n in range(1, MAX_N + 1):
        m = len(chars) - n + 1
        if m <= 0:
            break
        h = (h[:m] ^ chars[n - 1:]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(31)
        if n >= MIN_N:
            fit = left[:m] >= n
            hashes.append(((h * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - BITS))[fit].astype(np.int32))
            owners.append(owner[:m][fit])
    if not hashes:
        return [np.empty(0, np.int32)] * len(words)
    order = np.argsort(np.concatenate(owners), kind="stable")
    per_word = np.bincount(np.concatenate(owners), minlength=len(words))
    return np.split(np.concatenate(hashes)[order], np.cumsum(per_word)[:-1])


class Features:
    """Feature sets of texts; n-grams of recurring words are looked up."""

    def __init__(self) -> None:
        forget_kept()
        self.known: dict[str, np.ndarray] = {}
        self.last = np.zeros(1 << BITS, dtype=np.int64)

    def of(self, texts: list[str]) -> Iterator[np.ndarray]:
        split = [set(t.lower().split()) for t in texts]
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        new = [*{w for words in split for w in words if w not in self.known}]
        self.known.update(zip(new, word_grams(new)))
        for words in split:
            if not words:
                yield np.empty(0, np.int32)
                continue
            grams = np.concatenate([*map(self.known.__getitem__, words)])
            at = np.arange(len(grams))
            self.last[grams] = at  # the last place of each n-gram stands for it
            yield grams[self.last[grams] == at]


def log_count_ratios(counts: np.ndarray, rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Ratio of each n-gram from the ``(class, n-gram)`` counts of rows that have it, the rows of each class and the
    classes' weights; 0 where it does not count (:data:`LEAST`, :data:`TELL`)."""
    smoothed = counts * weight[:, None] + 1.0
    total = rows * weight + 2.0
    ratio = np.log((smoothed[1] / total[1]) / (smoothed[0] / total[0]))
    ratio[(counts.sum(axis=0) < LEAST) | (np.abs(ratio) < TELL)] = 0.0
    return ratio


@dataclass
class Sample:
    """The labelled sample: pairs (row, chosen n-gram), a row's class, the ``(fold, class, n-gram)`` counts of rows
    and the classes' weights. A row's fold is its number modulo the number of folds."""

    row: np.ndarray
    column: np.ndarray
    toxic: np.ndarray
    counts: np.ndarray
    weight: np.ndarray

    def logits(self, weights: np.ndarray, intercept: float) -> np.ndarray:
        return np.bincount(self.row, weights=weights[self.column], minlength=len(self.toxic)) + intercept

    def fit(self, without: int = -1, rounds: int = 100, l2: float = 0.005, step: float = 0.05) -> tuple[np.ndarray, float]:
        """Weights and intercept of a logistic regression (Adam, whole sample but for one fold) on the ratio-scaled n-grams."""
        size, toxic = self.counts.shape[2], self.toxic
        folds = [f for f in range(len(self.counts)) if f != without]
        use = np.isin(np.arange(len(toxic)) % len(self.counts), folds)
        rows = np.array([((toxic == c) & use).sum() for c in (0, 1)])
        ratio = log_count_ratios(self.counts[folds].sum(axis=0), rows, self.weight)
        keep = np.flatnonzero((ratio[self.column] != 0) & use[self.row])
        column, row = self.column[keep], self.row[keep]
        share = np.where(toxic == 1, *self.weight[::-1]) * use
        share, total = share / share.sum(), rows * self.weight + 2.0
        w, m, v, bias = np.zeros(size), np.zeros(size + 1), np.zeros(size + 1), np.log(total[1] / total[0])
        for t in range(1, rounds + 1):
            z = np.bincount(row, weights=(w * ratio)[column], minlength=len(toxic)) + bias
            error = (sigmoid(z) - toxic) * share
            slope = np.append(np.bincount(column, weights=error[row], minlength=size) * ratio + l2 * w, error.sum())
            m, v = 0.9 * m + 0.1 * slope, 0.99 * v + 0.01 * slope**2
            move = step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
            w, bias = w - move[:-1], bias - move[-1]
        return w * ratio, float(bias)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def calibration(z: np.ndarray, toxic: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Scale and shift of logits that fit the labels best (Newton steps on two parameters, halved until the loss falls)."""
    x = np.stack([z, np.ones_like(z)])
    at, start = np.array([1.0, 0.0]), np.array([1.0, 0.0])
    share = weight / weight.sum()

    def loss(a: np.ndarray) -> float:
        y = a @ x
        return float(((np.logaddexp(0, y) - toxic * y) * share).sum() + 5e-5 * ((a - start) ** 2).sum())

    for _ in range(50):
        p = sigmoid(at @ x)
        slope = x @ ((p - toxic) * share) + 1e-4 * (at - start)
        curve = (x * (p * (1 - p) * share)) @ x.T + 1e-4 * np.eye(2)
        move, now = np.linalg.solve(curve, slope), loss(at)
        while np.abs(move).max() > 1e-9 and loss(at - move) > now:
            move = move / 2
        at = at - move
    return max(float(at[0]), 1e-3), float(at[1])


def fit(sample: Sample) -> Model:
    """The model of the whole sample, with logits calibrated on rows that folds left out."""
    fold = np.arange(len(sample.toxic)) % len(sample.counts)
    left_out = np.zeros(len(sample.toxic))
    for k in range(len(sample.counts)):
        left_out[fold == k] = sample.logits(*sample.fit(without=k))[fold == k]
    scale, shift = calibration(left_out, sample.toxic, np.where(sample.toxic == 1, *sample.weight[::-1]))
    weights, bias = sample.fit()
    return Model((weights * scale).astype(np.float32), bias * scale + shift)


def labelled_sample(docs: DataFrame, known: DataFrame, per_class: int, sample_bytes: int, doc_id: str, text: str) -> DataFrame:
    """``(row, toxic, body)``: the sample's rows, numbered in order of a hash of id and text."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("__id"), text_or_empty(text).alias("body")).withColumn("h", F.xxhash64("body"))
    picked = None
    for c in (0, 1):
        some = known.where(F.col("__toxic") == c).orderBy(F.xxhash64("__id"), "__id").limit(per_class)
        picked = some if picked is None else picked.unionAll(some)
    # at most 2 * per_class ids, a parameter; an id that many documents have still gives per_class rows of a class
    found = rows.select("__id", "h", F.octet_length("body").alias("size")).distinct().join(F.broadcast(stage(picked, "labelled")), "__id")
    order = [F.xxhash64("__id"), "__id", "h"]
    some = [found.where(F.col("__toxic") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    upto = Window.partitionBy("__toxic").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chosen = some[0].unionAll(some[1]).withColumns({"upto": F.sum("size").over(upto), "place": F.count(F.lit(1)).over(upto)}).where(
        (F.col("upto") <= sample_bytes // 2) | (F.col("place") == 1))
    numbered = stage(chosen.select("__id", "h", F.col("__toxic").alias("toxic"),
                                   (F.row_number().over(Window.orderBy(F.xxhash64("__id", "h"), "__toxic", "place")) - 1).alias("row")), "chosen")
    return stage(rows.join(F.broadcast(numbered), ["__id", "h"]).dropDuplicates(["row"]).select("row", "toxic", "body"), "sample")


def gram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of this task that have each n-gram, by fold and class."""
    features, counts = Features(), np.zeros((2 * FOLDS, 1 << BITS), dtype=np.int32)
    for batch in lean(batches):
        for at in range(0, batch.num_rows, 128):
            row, toxic, body = (c.to_pylist() for c in batch.slice(at, 128).columns)
            for r, t, grams in zip(row, toxic, features.of(body)):
                counts[2 * (r % FOLDS) + t, grams] += 1
    some = np.flatnonzero(counts.any(axis=0)).astype(np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(some), *(pa.array(c[some].astype(np.int64)) for c in counts)],
                                     names=["gram", *(f"n{k}" for k in range(2 * FOLDS))])


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, doc_id: str = "doc_id",
          text: str = "text", label: str = "toxic", sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on at most ``per_class`` labelled rows of each class, of ``sample_bytes`` of text together."""
    small_batches(docs.sparkSession)
    known = labels.where(F.col(label).isin(0, 1)).select(
        F.col(doc_id).cast("bigint").alias("__id"), F.col(label).cast("int").alias("__toxic"))
    totals = {r[0]: r[1] for r in known.groupBy("__toxic").count().collect()}
    if set(totals) != {0, 1}:
        n = sum(totals.values())
        share = (totals.get(1, 0) + 1) / (n + 2)
        return Model(np.zeros(1 << BITS, np.float32), float(np.log(share / (1 - share))))
    sample = labelled_sample(docs, known, per_class, sample_bytes, doc_id, text)
    rows = {(r[0], r[1]): r[2] for r in sample.groupBy(F.col("row") % FOLDS, "toxic").count().collect()}
    if not rows:  # no labelled document is in the table
        return Model(np.zeros(1 << BITS, np.float32), float(np.log((totals[1] + 1) / (totals[0] + 1))))
    cells = [f"n{k}" for k in range(2 * FOLDS)]
    found = sample.mapInArrow(gram_counts, "gram int, " + ", ".join(f"{c} bigint" for c in cells)).groupBy("gram").agg(
        *(F.sum(c).alias(c) for c in cells)).where(" + ".join(cells) + f" >= {LEAST}").toArrow()  # at most 2**BITS rows
    counts = np.zeros((2 * FOLDS, 1 << BITS))
    counts[:, found.column("gram").to_numpy()] = [found.column(c).to_numpy() for c in cells]
    counts = counts.reshape(FOLDS, 2, -1)
    in_class = np.array([[rows.get((f, c), 0) for c in (0, 1)] for f in range(FOLDS)])
    weight = np.array([totals[c] / max(1, in_class[:, c].sum()) for c in (0, 1)])
    weight /= (in_class.sum(axis=0) * weight).sum() / in_class.sum()
    chosen = np.zeros(1 << BITS, bool)
    for without in range(-1, FOLDS):
        folds = [f for f in range(FOLDS) if f != without]
        chosen |= log_count_ratios(counts[folds].sum(axis=0), in_class[folds].sum(axis=0), weight) != 0
    sent = docs.sparkSession.sparkContext.broadcast((chosen, counts.astype(np.int32)))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in lean(batches):
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                grams = [g[sent.value[0][g]].tobytes() for g in features.of(part.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(grams, pa.binary())],
                                                 names=["row", "toxic", "grams"])

    def fitted(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("row")
        columns = [np.frombuffer(g, np.int32) for g in pdf["grams"]]
        model = fit(Sample(np.repeat(np.arange(len(pdf), dtype=np.int32), [*map(len, columns)]), np.concatenate(columns),
                           pdf["toxic"].to_numpy().astype(float), sent.value[1].astype(float), weight))
        return pd.DataFrame({"weights": [model.weights.tobytes()], "intercept": [model.intercept]})

    model = sample.mapInArrow(pairs, "row int, toxic int, grams binary").withColumn("one", F.lit(0)).groupBy("one").applyInPandas(
        fitted, "weights binary, intercept double").first()
    return Model(np.frombuffer(model.weights, np.float32), model.intercept)


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the probability, 0 to 1, of being toxic, in place of a column ``into``. Text is the only input."""
    if into in docs.columns and into != text:
        docs = docs.drop(into)
    small_batches(docs.sparkSession)
    sent = docs.sparkSession.sparkContext.broadcast((model.weights, model.intercept))
    names = docs.columns

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept = sent.value
        features = Features()
        for batch in lean(batches):
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                bodies = part.column(part.schema.get_field_index(text)).cast(pa.string()).fill_null("").to_pylist()
                z = np.array([weights[s].sum(dtype=np.float64) + intercept for s in features.of(bodies)])
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(sigmoid(z))], names=[*names, into])

    return docs.mapInArrow(scored, docs.select("*", F.lit(0.0).alias(into)).schema)


def held_out(doc_id: Column) -> Column:
    """True for every fifth id by checksum; such rows never train."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
