"""Whitening of embeddings with a covariance weighted by multiplicity.

1. Every valid vector becomes the integer vector ``x = floor(1024 * c) + 100000``; equal
   ones are grouped, so a vector that a third of the rows share is one row with a count.
2. The fit list is the distinct vectors, each weighted by its count (or, with
   ``weighted=False``, by one). ``n`` and the sums ``S`` are exact integers; the covariance
   is a weighted matrix product of the vectors centred by ``S / n``, summed over batches
   in executors. Only its ``dim**2`` numbers reach the driver, which finds the eigenvectors.
3. Each distinct vector is whitened once (its deviation in exact integers) and the result is
   joined back to the rows by the SHA-256 digest of ``x``.

Defined cases: rows whose vector is null or has null, NaN or infinite entries are left out, and so
are vectors of another length than the most frequent one (the longer one of a tie); repeated rows
and ids are whitened each; an entry beyond 2**52 after scaling counts as 2**52; a deviation that
does not fit a 64-bit integer is null; components whose eigenvalue is not above
``dim * 2**-52`` times the largest one are not returned (so a single vector gives no rows); an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from archivesearch.llm.common import stage

SCALE, SHIFT = 1024.0, 100_000
LIMIT = float(1 << 52)
ROWS = ("id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double")


def integer_keys(vectors: np.ndarray) -> list[bytes]:
    """The integer vectors as bytes: 32-bit entries where all fit, else 64-bit ones, so equal bytes mean equal vectors."""
    x = (np.clip(np.floor(vectors * SCALE), -LIMIT, LIMIT)).astype("<i8") + SHIFT
    small = x.astype("<i4")
    return [s.tobytes() if fits else v.tobytes() for s, v, fits in zip(small, x, (small == x).all(axis=1))]


def from_keys(keys: pa.Array, dim: int) -> np.ndarray:
    """Integer vectors of a batch of keys."""
    return np.stack([np.frombuffer(k, "<i4" if len(k) == 4 * dim else "<i8").astype(np.int64) for k in keys.to_pylist()])


def valid_vectors(rows: DataFrame, vec_id: str, vector: str) -> tuple[DataFrame, int]:
    """``(id, v)`` of the rows to whiten and the length of their vectors (0: there are none)."""
    v = F.col("v")
    good = rows.select(F.col(vec_id).cast("bigint").alias("id"), F.col(vector).cast("array<double>").alias("v")).where(
        v.isNotNull() & F.forall(v, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))))
    length = good.groupBy(F.size("v").alias("d")).count().where("d > 0").orderBy(F.desc("count"), F.desc("d")).first()
    dim = length.d if length else 0
    return good.where(F.size("v") == dim), dim


def keyed(good: DataFrame, dim: int) -> DataFrame:
    """``(id, x)`` with the integer vector as bytes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                vectors = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(integer_keys(vectors), pa.binary())], names=["id", "x"])

    return good.select("id", "v").mapInArrow(run, "id bigint, x binary")


def exact_sums(distinct: DataFrame, dim: int) -> tuple[int, list[int]]:
    """The number of vectors of the fit list and their sum per dimension, as whole numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * dim
        for batch in batches:
            if batch.num_rows:
                x, copies = from_keys(batch.column(0), dim), batch.column(1).to_numpy()
                if np.abs(x).max() * float(copies.sum()) < 2**62:
                    part = (copies @ x).tolist()
                else:
                    part = (copies.astype(object) @ x.astype(object)).tolist()
                n, total = n + int(copies.sum()), [a + b for a, b in zip(total, part)]
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()),
                                              pa.array([str(t) for t in total])], names=["d", "n", "total"])

    sums = distinct.select("x", "copies").mapInArrow(run, "d int, n bigint, total string").groupBy("d").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("d").collect()
    return sums[0].n, [int(r.total) for r in sums]


def weighted_gemm(vectors: DataFrame, read, mean: np.ndarray) -> np.ndarray:
    """Sum of ``copies * outer(v - mean, v - mean)`` over ``vectors(v, copies)``; ``read`` gives a batch's vectors."""
    dim = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            if batch.num_rows:
                centred = read(batch.column(0)) - mean
                total += (centred * batch.column(1).to_numpy()[:, None]).T @ centred
        yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
                                         names=["i", "row"])

    sums = vectors.mapInArrow(run, "i int, row array<double>").groupBy("i").agg(
        Summarizer.sum(array_to_vector("row")).alias("row")).orderBy("i").collect()
    return np.array([r.row.toArray() for r in sums])


def exact_deviations(x: np.ndarray, n: int, total: list[int]) -> list[int | None]:
    """Sum over the dimensions of ``(n * x - S)**2``; None where it exceeds 64 bits."""
    low, high = x.min(axis=0).tolist(), x.max(axis=0).tolist()
    widest = max(max(abs(n * a - t), abs(n * b - t)) for a, b, t in zip(low, high, total))
    if n * max(map(abs, [*low, *high])) < 2**62 and max(map(abs, total)) < 2**62 and widest**2 * len(total) < 2**63:
        off = n * x - np.array(total, dtype=np.int64)
        return (off * off).sum(axis=1).tolist()
    off = n * x.astype(object) - np.array(total, dtype=object)
    return [int(d) if d < 2**63 else None for d in (off * off).sum(axis=1)]


def whiten(rows: DataFrame, components: int = 8, weighted: bool = True, vec_id: str = "vec_id",
           vector: str = "embedding") -> DataFrame:
    """One row for each valid row of ``rows`` and component (see :data:`ROWS`)."""
    spark = rows.sparkSession
    good, dim = valid_vectors(rows, vec_id, vector)
    if not dim:
        return spark.createDataFrame([], ROWS)
    copies = F.count(F.lit(1)) if weighted else F.lit(1).cast("bigint")
    distinct = stage(keyed(good, dim).groupBy("x").agg(copies.alias("copies")), "distinct")
    n, total = exact_sums(distinct, dim)
    mean = np.array([t / n for t in total])
    covariance = weighted_gemm(distinct.select("x", "copies"), lambda keys: from_keys(keys, dim), mean) / n
    values, basis = np.linalg.eigh((covariance + covariance.T) / 2)
    falling = np.argsort(-values, kind="stable")[:components]
    kept = falling[values[falling] > dim * 2.0**-52 * max(values.max(), 0.0)]
    if not len(kept):
        return spark.createDataFrame([], ROWS)
    project = basis[:, kept] / np.sqrt(values[kept])
    explained = (values[kept] / np.trace(covariance)).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = from_keys(batch.column(0), dim)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array(exact_deviations(x, n, total), pa.int64()),
                     pa.array(list((x - mean) @ project), pa.list_(pa.float64()))], names=["x", "copies", "deviation", "z"])

    digest = F.unhex(F.sha2("x", 256)).alias("digest")
    white = stage(distinct.select("x", "copies").mapInArrow(
        run, "x binary, copies bigint, deviation bigint, z array<double>").select(digest, "copies", "deviation", "z"), "white")
    centre = white.select(Summarizer.mean(array_to_vector("z"), F.col("copies").cast("double"))).first()[0].toArray()

    def lists(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(kept))

    spread = weighted_gemm(white.select("z", "copies"), lists, centre) / n
    error = float(np.abs(spread - np.eye(len(kept))).max())
    # the digest alone is joined: rows of one very frequent vector can be split over tasks
    joined = keyed(good, dim).select("id", digest).join(white.select("digest", "deviation", "z"), "digest")
    return joined.select("id", "deviation", F.posexplode("z").alias("k", "whitened")).select(
        "id", (F.col("k") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        F.element_at(F.array(*map(F.lit, explained)), F.col("k") + 1).alias("explained"), F.lit(error).alias("identity_error"))
