"""Word vectors trained without a vocabulary on the driver (E2): spectral vectors of a co-occurrence table.

1. Words are named by a 64-bit hash; pairs of words at most ``window`` apart are counted in Arrow batches and summed by
   Spark. Words seen less than ``min_count`` times leave.
2. The table of positive pointwise mutual information (PPMI) is a sparse symmetric matrix, kept as rows ``(a, b, value)``
   in square blocks by hash, ``block_words`` words to a side.
3. Its leading eigenvectors come from block power iteration: the current block of ``dim`` columns lies as one row for
   each word; a product is a co-group of matrix blocks and column blocks, whose partial rows Spark sums. Rows are made
   orthonormal with their ``dim x dim`` Gram matrix, the only thing that reaches the driver, and the last
   product is turned into the eigenbasis (Rayleigh-Ritz). Nothing is broadcast: Spark takes an array for one element
   when it estimates a table, and would send all vectors through the driver.

A word's vector is its row times the roots of the eigenvalues; a document's is the mean over its words (E1). Later
batches and queries use the same table of vectors. Every product is written to the shared folder, so lost executors
repeat one step. Empty texts and unknown words have no vector; with fewer words than dimensions the rest of each
vector is 0; null texts are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivesearch.config import EmbeddingParams
from archivesearch.functions import text as tx
from archivesearch.operators import embeddings as emb
from archivesearch.session import scratch_path, settings

ROWS = "code bigint, vec array<float>"
#: Joins run on the executors; what a step shuffled is freed when its rows are written.
LEAN = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


def _kept(df: DataFrame, purpose: str) -> DataFrame:
    at = scratch_path(df.sparkSession, purpose)
    df.write.parquet(at)
    return df.sparkSession.read.schema(df.schema).parquet(at)


def pair_counts(tokens: DataFrame, window: int) -> DataFrame:
    """``(a, b, n)`` of ordered pairs of codes at most ``window`` apart, from ``tokens(codes array<bigint>)``."""
    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                lists = batch.column(0).slice(at, 512)
                codes = lists.flatten().to_numpy()
                owner = np.repeat(np.arange(len(lists)), lists.value_lengths().fill_null(0).to_numpy())
                names, code = np.unique(codes, return_inverse=True)
                keys = []
                for d in range(1, window + 1):
                    near = owner[d:] == owner[:-d]
                    x, y = code[:-d][near], code[d:][near]
                    keys += [x * len(names) + y, y * len(names) + x]
                pairs, n = np.unique(np.concatenate(keys) if keys else np.empty(0, np.int64), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(names[pairs // max(len(names), 1)]), pa.array(names[pairs % max(len(names), 1)]),
                                                  pa.array(n.astype(np.int64))], names=["a", "b", "n"])

    return tokens.mapInArrow(counted, "a bigint, b bigint, n bigint").groupBy("a", "b").agg(F.sum("n").alias("n"))


def ppmi(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """``(a, b, value)`` of positive pointwise mutual information among ``words(code)``."""
    some = pairs.join(words.select(F.col("code").alias("a")), "a", "left_semi").join(
        words.select(F.col("code").alias("b")), "b", "left_semi")
    some = _kept(some, "pairs")
    margin = _kept(some.groupBy("a").agg(F.sum("n").cast("double").alias("m")), "margins")
    total = margin.select(F.sum("m")).scalar()
    value = F.ln(F.col("n") * total / (F.col("ma") * F.col("mb")))
    return some.join(margin.select("a", F.col("m").alias("ma")), "a").join(
        margin.select(F.col("a").alias("b"), F.col("m").alias("mb")), "b").select(
        "a", "b", value.cast("float").alias("value")).where("value > 0")


def _product(matrix: pa.Table, columns: pa.Table, dim: int) -> pa.Table:
    """Partial rows of a matrix block times a column block."""
    codes = columns.column("code").to_numpy()
    a, b, value = (matrix.column(c).to_numpy() for c in ("a", "b", "value"))
    if not len(codes) or not len(a):
        return pa.table({"code": pa.array([], pa.int64()), "vec": pa.array([], pa.list_(pa.float32()))})
    order = np.argsort(codes)
    x = columns.column("vec").combine_chunks().flatten().to_numpy().reshape(-1, dim)[order]
    at = np.searchsorted(codes[order], b)
    at[at == len(codes)] = 0
    known = codes[order][at] == b
    rows = np.lexsort((at, a))
    rows = rows[known[rows]]
    a, at, value = a[rows], at[rows], value[rows]
    names, first = np.unique(a, return_index=True)
    out = np.zeros((len(names), dim), np.float32)
    edges = np.append(first, len(a))
    row = np.repeat(np.arange(len(names)), np.diff(edges))
    for lo in range(0, len(a), 1 << 14):
        part = slice(lo, lo + (1 << 14))
        own, start = np.unique(row[part], return_index=True)
        out[own] += np.add.reduceat(x[at[part]] * value[part, None], start, axis=0)
    return pa.table({"code": pa.array(names), "vec": pa.array(list(out), pa.list_(pa.float32()))})


def _times(matrix: DataFrame, columns: DataFrame, used: DataFrame, blocks: int, dim: int) -> DataFrame:
    """The product as one row for each word that a row of the matrix has. ``used(code, i)``: the blocks of rows
    that use a word's column; no other block gets it."""
    spread = columns.withColumn("j", F.pmod("code", F.lit(blocks))).join(used, "code").select("code", "vec", F.col("i").alias("at"), "j")
    partial = matrix.groupBy("i", "j").cogroup(spread.groupBy("at", "j")).applyInArrow(
        lambda m, c: _product(m, c, dim), ROWS)
    if blocks == 1:
        return _kept(partial, "product")
    total = partial.groupBy("code").agg(Summarizer.sum(array_to_vector("vec")).alias("v"))
    return _kept(total.select("code", vector_to_array("v", "float32").alias("vec")), "product")


def _gram(left: DataFrame, right: DataFrame | None, dim: int) -> np.ndarray:
    """``left.T @ left``, or ``left.T @ right`` of rows with equal codes: ``dim x dim`` numbers."""
    both = left.select("vec", F.col("vec").alias("other")) if right is None else left.join(
        right.select("code", F.col("vec").alias("other")), "code").select("vec", "other")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            if batch.num_rows:
                x, y = (batch.column(c).flatten().to_numpy().reshape(-1, dim).astype(float) for c in (0, 1))
                total += x.T @ y
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    rows = both.mapInArrow(summed, "i int, row array<double>").groupBy("i").agg(
        Summarizer.sum(array_to_vector("row")).alias("row")).orderBy("i").collect()
    return np.array([r.row.toArray() for r in rows]).reshape(-1, dim) if rows else np.zeros((dim, dim))


def _turned(rows: DataFrame, basis: np.ndarray) -> DataFrame:
    sent = rows.sparkSession.sparkContext.broadcast(basis)  # dim x dim

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy().reshape(-1, len(sent.value)).astype(float) @ sent.value
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(x.astype(np.float32)), pa.list_(pa.float32()))],
                                                 names=["code", "vec"])

    return rows.select("code", "vec").mapInArrow(turn, ROWS)


def _orthonormal(rows: DataFrame, dim: int) -> DataFrame:
    values, basis = np.linalg.eigh(_gram(rows, None, dim))
    scale = np.where(values > 1e-9 * max(values.max(), 1e-300), 1 / np.sqrt(np.maximum(values, 1e-300)), 0.0)
    return _kept(_turned(rows, basis * scale), "basis")


def _signs(words: DataFrame, dim: int, seed: int) -> DataFrame:
    """A row of pseudo-random signs for each word, made from its code alone."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code = batch.column(0).to_numpy().view(np.uint64)[:, None]
            x = code ^ (np.arange(1, dim + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(seed))
            for shift, odd in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
                x = (x ^ (x >> np.uint64(shift))) * np.uint64(odd)
            sign = np.where(x >> np.uint64(63), 1, -1).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(sign), pa.list_(pa.float32()))], names=["code", "vec"])

    return words.select("code").mapInArrow(made, ROWS)


def train_vectors(df: DataFrame, params: EmbeddingParams = EmbeddingParams(), *, text_col: str = "text", window: int = 2,
                  min_count: int = 5, rounds: int = 2, block_words: int = 65_536) -> DataFrame:
    """``(word, vec)`` of the words that ``df``'s texts hold at least ``min_count`` times."""
    with settings(df.sparkSession, LEAN):
        vectors, words = _trained(df, params.vector_size, params.seed, text_col, window, min_count, rounds, block_words)
    return vectors.join(words.hint("merge"), "code").select("word", "vec")


def _trained(df: DataFrame, dim: int, seed: int, text_col: str, window: int, min_count: int, rounds: int,
             block_words: int) -> tuple[DataFrame, DataFrame]:
    """``(code, vec)`` and ``(word, code)``, both stored."""
    texts = df.where(F.col(text_col).isNotNull()).select(tx.plain_token_array(F.col(text_col)).alias("tokens"))
    words = _kept(texts.select(F.explode("tokens").alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") >= min_count).select("word", F.xxhash64("word").alias("code")), "words")
    blocks = max(1, math.ceil(words.count() / block_words))
    pairs = pair_counts(texts.select(F.transform("tokens", lambda w: F.xxhash64(w)).alias("codes")), window)
    matrix = _kept(ppmi(pairs, words).withColumns({"i": F.pmod("a", F.lit(blocks)), "j": F.pmod("b", F.lit(blocks))}), "ppmi")
    used = _kept(matrix.select(F.col("b").alias("code"), "i").distinct(), "used")
    basis = _signs(words, dim, seed)
    for _ in range(rounds):
        basis = _orthonormal(_times(matrix, basis, used, blocks, dim), dim)
    image = _times(matrix, basis, used, blocks, dim)
    small = _gram(basis, image, dim)
    values, turn = np.linalg.eigh((small + small.T) / 2)
    order = np.argsort(-np.abs(values), kind="stable")
    vectors = _kept(_turned(basis, turn[:, order] * np.sqrt(np.abs(values[order]))), "vectors")
    return vectors, words


def embed_spectral(df: DataFrame, params: EmbeddingParams = EmbeddingParams(), *, id_col: str = "doc_id", text_col: str = "text",
                   min_count: int = 5) -> tuple[DataFrame, DataFrame]:
    """``(vectors, words)`` of vectors trained on these documents; ``embeddings.embed_from_table`` embeds later ones with
    ``words``. A document without a known word has the zero vector."""
    trained = train_vectors(df, params, text_col=text_col, min_count=min_count)
    with settings(df.sparkSession, LEAN):
        words = _kept(trained, "word-vectors")
    vectors = emb.embed_from_table(df, words, id_col=id_col, text_col=text_col)
    return vectors.withColumn("embedding", F.coalesce("embedding", F.array_repeat(F.lit(0.0), params.vector_size))), words
