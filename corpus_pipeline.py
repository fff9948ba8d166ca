"""The training-data pipeline: each stage takes what its predecessor kept.

``run`` writes each stage's rows as Parquet into the folder of ``spark.checkpoint.dir``
and reads them back for the next. All stages but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from archivesearch.llm import queries
from archivesearch.llm.common import documents, stage
from archivesearch.llm.decontaminate import without_benchmark
from archivesearch.llm.exact_dedup import keep_first
from archivesearch.llm.ngram_join import keep_one_of_each
from archivesearch.llm.packing import pack, tokenised_pieces
from archivesearch.llm.toxicity import held_out, score, train


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not hold to be toxic."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out(F.col("doc_id")))
    return score(docs, train(docs, labels), into="__toxic").where("__toxic < 0.5").drop("__toxic")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest id."""
    return keep_first(docs)


def jaccard_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near copies (five-word shingles, similarity 0.8) the row with the smallest id."""
    return keep_one_of_each(docs, k=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return without_benchmark(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents that are left, in sequences of at most 4096 tokens."""
    placed = pack(tokenised_pieces(docs, queries.tokenizer_path(), queries.CAPACITY), queries.CAPACITY)
    return placed.withColumnRenamed("id", "doc_id")


STAGES = [("toxicity", toxicity), ("exact dedup", exact_dedup), ("n-gram Jaccard join", jaccard_dedup),
          ("benchmark decontamination", decontamination), ("best-fit packing", packing)]

#: The classifier and the tokenizer have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (_, function) in enumerate(STAGES):
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
