"""Readers for the driver's parquet tables and the article-shaped views the
operators expect (FIXTURES.md section 3 role mapping).

Column selection and the language predicate are written so Catalyst prunes
columns and pushes ``lang = 'en'`` into the parquet scan.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ARTICLE_LANG = "en"  # stands in for ObjectType = "Article"
TITLE_CHARS = 40  # documents have no title; their first characters stand in for one
PUB_DATE = "1970-01-01"  # AlphaPubDate is shown, never parsed


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def article_filter() -> Column:
    """X1 pre-filter on the fixtures (scalar, so it reaches the parquet scan)."""
    return F.col("lang") == F.lit(ARTICLE_LANG)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of several files is read as it is; a fixture of one file, which one task would
    read, is dealt out."""
    df = table(spark, sf_dir, "documents")
    return df.repartition(spark.sparkContext.defaultParallelism) if len(df.inputFiles()) == 1 else df


def by_id(df: DataFrame, task_bytes: int = 4 << 20) -> DataFrame:
    """``df(doc_id, text)`` dealt out by id, about ``task_bytes`` of texts to a task: what is counted for each document
    afterwards needs no other shuffle, and a task's counts stay in memory."""
    size = df.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, -(-size // task_bytes)), "doc_id")


def articles(spark: SparkSession, sf_dir: str, prefilter: bool = True) -> DataFrame:
    """Article view: doc_id, record_title, publisher, alpha_pub_date,
    object_type, full_text (+ lang)."""
    df = documents(spark, sf_dir)
    if prefilter:
        df = df.where(article_filter())
    return df.select(
        "doc_id",
        F.substring("text", 1, TITLE_CHARS).alias("record_title"),
        F.col("source").alias("publisher"),
        F.lit(PUB_DATE).alias("alpha_pub_date"),
        F.array(F.when(F.col("lang") == ARTICLE_LANG, F.lit("Article"))
                .otherwise(F.col("lang"))).alias("object_type"),
        F.col("text").alias("full_text"),
        "lang",
    )


def article_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, text) of pre-filtered articles: the keyword-annotation input."""
    return documents(spark, sf_dir).where(article_filter()).select("doc_id", "text")


def query_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages as a query table (query_id, text)."""
    return table(spark, sf_dir, "benchmark").select(
        F.col("item_id").alias("query_id"), "text")


def embedded_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, embedding) for pre-filtered articles: embeddings on vec_id = doc_id."""
    emb = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("doc_id"), "embedding")
    docs = documents(spark, sf_dir).where(article_filter()).select("doc_id")
    return emb.join(docs, "doc_id", "left_semi")


def query_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stored vector used as a query: (query_id, embedding)."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("query_id"), "embedding")


def fixture_centroids(spark: SparkSession, sf_dir: str, n_cells: int = 16) -> DataFrame:
    """Given IVF centroids: the vectors with vec_id < n_cells, cell = vec_id."""
    return (table(spark, sf_dir, "embeddings").where(F.col("vec_id") < n_cells)
            .select(F.col("vec_id").alias("cell"),
                    F.col("embedding").cast("array<double>").alias("centroid")))


def fixture_codebook(spark: SparkSession, sf_dir: str, n_words: int = 256) -> DataFrame:
    """Given codewords: the parts of the vectors with vec_id < n_words, code = vec_id."""
    return (table(spark, sf_dir, "embeddings").where(F.col("vec_id") < n_words)
            .select(F.col("vec_id").cast("int").alias("code"),
                    F.col("embedding").cast("array<double>").alias("value")))
