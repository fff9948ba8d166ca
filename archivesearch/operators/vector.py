"""Vector search: exact k-NN (V1), inverted-file approximate k-NN (V2) and
the inverted-file index build (V3).

Distances are euclidean, computed in DOUBLE. Rankings order by the distance
rounded to 9 places, then by id, so last-bit noise cannot reorder ties.

Exact k-NN never materialises query x document pairs: documents are hashed
into blocks sized from their count, the query set is hashed into chunks, and
each (block, chunk) cogroup computes a numpy block product in an executor,
keeping only its local top-k per query. A final ``row_number <= k`` (planned
as ``WindowGroupLimit``, partial before the shuffle) merges the blocks.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANK_DIGITS = 9
EMIT_DIGITS = 6


def euclidean(a: Column, b: Column) -> Column:
    """sqrt(sum((a_i - b_i)^2)) in DOUBLE, JVM-side higher-order functions."""
    sq = F.zip_with(a, b, lambda x, y: (x.cast("double") - y.cast("double"))
                    * (x.cast("double") - y.cast("double")))
    return F.sqrt(F.aggregate(sq, F.lit(0.0).cast("double"), lambda acc, v: acc + v))


def _stack(col: pd.Series) -> np.ndarray:
    if len(col) == 0:
        return np.zeros((0, 0), dtype=np.float64)
    return np.stack([np.asarray(v, dtype=np.float64) for v in col.to_numpy()])


#: Distances that a task computes at once (8 bytes each, in a few arrays).
TILE = 1 << 21


def _block_topk(k: int, tile: int = TILE):
    """Per (block, chunk) group: exact top-k documents for every query, ``tile`` distances at a time."""
    out_cols = ["query_id", "doc_id", "distance"]

    def run(docs: pd.DataFrame, qs: pd.DataFrame) -> pd.DataFrame:
        if docs.empty or qs.empty:
            return pd.DataFrame({c: pd.Series(dtype="int64" if c != "distance" else "float64")
                                 for c in out_cols})
        D = _stack(docs["embedding"])
        ids = docs["doc_id"].to_numpy(dtype=np.int64)
        dn = np.einsum("ij,ij->i", D, D)
        Q = _stack(qs["qvec"])
        qids = qs["query_id"].to_numpy(dtype=np.int64)
        parts = ([], [], [])
        sub = max(1, tile // len(D))
        for s in range(0, len(Q), sub):
            Qs = Q[s:s + sub]
            qn = np.einsum("ij,ij->i", Qs, Qs)
            approx = Qs @ D.T
            approx *= -2.0
            approx += qn[:, None]
            approx += dn
            np.maximum(approx, 0.0, out=approx)
            kk = min(k, D.shape[0])
            kth = np.partition(approx, kk - 1, axis=1)[:, kk - 1]
            # every document within float noise of the k-th distance is a candidate,
            # so ties (e.g. copies) are resolved exactly by (rounded distance, id); the
            # expanded square loses digits in proportion to the squared norms
            slack = 1e-8 * (1.0 + np.sqrt(kth)) + 1e-12 * (qn + dn.max())
            for qi in range(len(Qs)):
                cand = np.nonzero(approx[qi] <= kth[qi] + slack[qi])[0]
                diff = D[cand] - Qs[qi]
                exact = np.sqrt(np.einsum("ij,ij->i", diff, diff))
                order = np.lexsort((ids[cand], np.round(exact, RANK_DIGITS)))[:k]
                parts[0].append(np.full(len(order), qids[s + qi], dtype=np.int64))
                parts[1].append(ids[cand][order])
                parts[2].append(exact[order])
        return pd.DataFrame({c: np.concatenate(p) for c, p in zip(out_cols, parts)})

    return run


def top_k_per_query(pairs: DataFrame, k: int, score: str, *, descending: bool,
                    id_col: str = "doc_id", digits: int = RANK_DIGITS,
                    rank_col: str = "rank") -> DataFrame:
    """``row_number() <= k`` per query ordered by the rounded score then id.
    Catalyst plans this as a partial + final ``WindowGroupLimit``."""
    key = F.round(F.col(score), digits)
    w = Window.partitionBy("query_id").orderBy(key.desc() if descending else key.asc(),
                                               F.col(id_col).asc())
    return (pairs.withColumn(rank_col, F.row_number().over(w).cast("bigint"))
            .where(F.col(rank_col) <= k))


def knn_exact(docs: DataFrame, queries: DataFrame, k: int = 5, *,
              block_rows: int = 50_000, chunk_queries: int = 4_096) -> DataFrame:
    """Exact euclidean k-NN.

    docs: (doc_id, embedding) already pre-filtered (X1);
    queries: (query_id, embedding). Returns (query_id, doc_id, distance, rank)
    with rank 1..k.
    """
    n_docs = docs.count()
    n_queries = queries.count()
    blocks = max(1, math.ceil(n_docs / block_rows))
    chunks = max(1, math.ceil(n_queries / chunk_queries))
    d = (docs.select("doc_id", "embedding")
         .withColumn("blk", F.pmod(F.xxhash64("doc_id"), F.lit(blocks)))
         .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<bigint>"))))
    q = (queries.select("query_id", F.col("embedding").alias("qvec"))
         .withColumn("chunk", F.pmod(F.xxhash64("query_id"), F.lit(chunks)))
         .withColumn("blk", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<bigint>"))))
    schema = "query_id bigint, doc_id bigint, distance double"
    # a group's work is rows times queries, not bytes: a number of tasks of its own, which is not merged by size
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, blocks * chunks)
    local = (d.repartition(tasks, "blk", "chunk").groupBy("blk", "chunk")
             .cogroup(q.repartition(tasks, "blk", "chunk").groupBy("blk", "chunk"))
             .applyInPandas(_block_topk(k), schema))
    return top_k_per_query(local, k, "distance", descending=False)


# ---------------------------------------------------------------- V3 index

def _centroid_matrix(centroids: DataFrame, max_cells: int) -> np.ndarray:
    """Centroids are a model: bounded by ``max_cells`` (checked) and ordered by cell."""
    rows = (centroids.select("cell", "centroid").orderBy("cell")
            .limit(max_cells + 1).collect())
    if len(rows) > max_cells:
        raise ValueError(f"more than {max_cells} centroids")
    cells = [r["cell"] for r in rows]
    if cells != list(range(len(cells))):
        raise ValueError("centroid cells must be 0..n-1")
    return np.asarray([r["centroid"] for r in rows], dtype=np.float64)


def _nearest_cell_udf(spark: SparkSession, cents: np.ndarray):
    bc = spark.sparkContext.broadcast(cents)

    @F.pandas_udf(T.LongType())
    def nearest(vecs: pd.Series) -> pd.Series:
        C = bc.value
        if len(vecs) == 0:
            return pd.Series([], dtype="int64")
        V = _stack(vecs)
        dist = np.sqrt(((V[:, None, :] - C[None, :, :]) ** 2).sum(axis=2))
        key = np.round(dist, RANK_DIGITS)
        return pd.Series(np.argmin(key, axis=1).astype(np.int64))  # first min = lowest cell

    return nearest


def _cell_distances_udf(spark: SparkSession, cents: np.ndarray):
    bc = spark.sparkContext.broadcast(cents)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def cell_dist(vecs: pd.Series) -> pd.Series:
        C = bc.value
        out = []
        for v in vecs.to_numpy():
            diff = C - np.asarray(v, dtype=np.float64)[None, :]
            out.append(np.sqrt(np.einsum("ij,ij->i", diff, diff)))
        return pd.Series(out)

    return cell_dist


def kmeans_centroids(docs: DataFrame, n_cells: int, seed: int = 42) -> DataFrame:
    """Train cell centroids with MLlib k-means (distributed Lloyd iterations)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    feats = docs.select(array_to_vector("embedding").alias("features"))
    model = KMeans(k=n_cells, seed=seed, featuresCol="features").fit(feats)
    spark = docs.sparkSession
    rows = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    return spark.createDataFrame(rows, "cell bigint, centroid array<double>")


def vector_index_build(docs: DataFrame, *, dim: int, centroids: DataFrame | None = None,
                       n_cells: int = 16, seed: int = 42, max_cells: int = 65_536,
                       path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Assign every vector to its nearest cell (tie -> lowest cell id).

    docs: (doc_id, embedding, *filter columns). Returns (index, centroids);
    when ``path`` is given the index is written partitioned by ``cell`` (so a
    probe reads only its cells) and read back.
    """
    bad = docs.where(F.size("embedding") != dim).limit(1).count()
    if bad:
        raise ValueError(f"embedding dimension differs from {dim}")
    if centroids is None:
        centroids = kmeans_centroids(docs, n_cells, seed)
    cents = _centroid_matrix(centroids, max_cells)
    nearest = _nearest_cell_udf(docs.sparkSession, cents)
    index = docs.withColumn("cell", nearest(F.col("embedding")))
    if path is not None:
        index.write.mode("overwrite").partitionBy("cell").parquet(path)
        index = docs.sparkSession.read.parquet(path)
    return index, centroids


def _cells_in_order(index: DataFrame, centroids: DataFrame, queries: DataFrame, max_cells: int) -> DataFrame:
    """``(query_id, cell, before)``: the vectors in the cells that each query probes before this one."""
    cents = _centroid_matrix(centroids, max_cells)
    cell_dist = _cell_distances_udf(index.sparkSession, cents)
    sizes = index.groupBy("cell").agg(F.count(F.lit(1)).alias("n"))
    qc = (queries.select("query_id", F.posexplode(cell_dist(F.col("embedding"))).alias("cell", "cdist"))
          .withColumn("cell", F.col("cell").cast("bigint"))
          .join(sizes, "cell"))
    w = (Window.partitionBy("query_id").orderBy(F.round("cdist", RANK_DIGITS), F.col("cell"))
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return qc.select("query_id", "cell", (F.sum("n").over(w) - F.col("n")).alias("before"))


def fit_candidates(index: DataFrame, centroids: DataFrame, queries: DataFrame, k: int = 5,
                   recall: float = 0.9, *, sample: int = 1_000, max_cells: int = 65_536) -> int:
    """The smallest ``candidates`` with which :func:`knn_ivf` reaches ``recall`` against :func:`knn_exact`.

    Fitted on the ``sample`` queries of lowest id hash: their mean recall less two standard errors reaches
    ``recall``. A true neighbour is found when its cell is probed, so one exact search of the sample and the
    vectors ``before`` each neighbour's cell give the recall of every budget; at most ``sample * k`` of these
    numbers come to the driver.
    """
    if not 0 < recall <= 1:
        raise ValueError("recall must lie in (0, 1]")
    chosen = queries.orderBy(F.xxhash64("query_id"), "query_id").limit(sample)
    truth = knn_exact(index, chosen, k).select("query_id", "doc_id").join(index.select("doc_id", "cell"), "doc_id")
    needs = truth.join(_cells_in_order(index, centroids, chosen, max_cells), ["query_id", "cell"]).groupBy(
        "query_id").agg(F.collect_list("before").alias("before"))  # k of a query
    before = [np.asarray(r["before"]) for r in needs.collect()]
    if not before:
        return 1
    budgets = np.unique(np.concatenate(before)) + 1

    def reached(budget: int) -> bool:
        found = np.asarray([(b < budget).mean() for b in before])
        return found.mean() - 2 * found.std() / math.sqrt(len(found)) >= recall

    low, high = 0, len(budgets) - 1  # the largest budget finds every neighbour
    while low < high:
        mid = (low + high) // 2
        low, high = (low, mid) if reached(budgets[mid]) else (mid + 1, high)
    return int(budgets[low])


def knn_ivf(index: DataFrame, centroids: DataFrame, queries: DataFrame, k: int = 5,
            candidates: int = 100, *, max_cells: int = 65_536) -> DataFrame:
    """Approximate k-NN over the inverted file.

    ``candidates`` alone sets the recall; :func:`fit_candidates` finds it for a wanted recall.
    Per query, cells are ordered by centroid distance (rounded, then cell id)
    and the fewest nearest cells whose (post-filter) cumulative size reaches
    ``candidates`` are probed; their vectors are re-ranked exactly.
    index: (doc_id, embedding, cell) already pre-filtered.
    """
    probes = _cells_in_order(index, centroids, queries, max_cells).where(F.col("before") < candidates).select(
        "query_id", "cell")
    qv = queries.select("query_id", F.col("embedding").alias("qvec"))
    probes = probes.join(qv, "query_id")
    pairs = (index.select("doc_id", "embedding", "cell")
             .join(probes, "cell")
             .select("query_id", "doc_id", euclidean(F.col("qvec"), F.col("embedding")).alias("distance")))
    return top_k_per_query(pairs, k, "distance", descending=False)
