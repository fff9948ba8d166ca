"""Exact deduplication over keyed streaming state.

Arrivals (digest, identifier, content locator) stream into an aggregation whose
state lives in RocksDB, is checkpointed in the shared folder and never expires:
for each digest it retains the smallest identifier seen, that row's locator and
the number of rows. A later run over the same state folder continues from it: its rows also meet those of
earlier runs, whose texts are read again through their locators, so a digest alone never decides.
A digest that was met more than once is only a hit: the full normalised text of
each hit is read again through its locator and compared with the text of the row
that stays. Texts that differ under one digest are grouped by their bytes.

Only DataFrame and SQL functions run on the executors.

Defined cases: a null text equals the empty text; null identifiers order after
all others; repeated identifiers are separate rows, of which the smallest
locator stays; an empty table gives an empty result; other columns of ``docs``
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from archivesearch.llm.common import ASCII_SPACE, settings, shared_dir, stage, text_or_empty

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, ASCII_SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def located(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, body, locator)``; the locator is file and row, so ``docs`` is staged first unless
    it reads files directly."""
    try:
        return _with_locator(docs, doc_id, text)
    except Exception as e:  # the frame has no file metadata
        if "_metadata" not in str(e):
            raise
    return _with_locator(stage(docs.select(F.col(doc_id), F.col(text)), "content"), doc_id, text)


def _with_locator(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(
        F.col(doc_id).cast("bigint").alias("id"), text_or_empty(text).alias("body"),
        F.concat_ws("#", F.col("_metadata.file_path"),
                    F.lpad(F.col("_metadata.row_index").cast("string"), 12, "0")).alias("locator"))


def observe(spark: SparkSession, arrivals: DataFrame, state_dir: str) -> DataFrame:
    """Run the arrivals of a streaming frame ``(digest, id, locator)`` into the state of
    ``state_dir`` and return the state: ``(digest, first(no_id, id, locator), n)``."""
    held = arrivals.groupBy("digest").agg(
        F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "locator")).alias("first"),
        F.count(F.lit(1)).alias("n"))
    with settings(spark, spark__sql__streaming__stateStore__providerClass=ROCKSDB,
                  spark__sql__streaming__stateStore__rocksdb__allowFAllocate="false",
                  # memory of all of an executor's state partitions together, outside its heap
                  spark__sql__streaming__stateStore__rocksdb__boundedMemoryUsage="true",
                  spark__sql__streaming__stateStore__rocksdb__maxMemoryUsageMB="64",
                  # states of a stream that has ended are closed this soon
                  spark__sql__streaming__stateStore__maintenanceInterval="10s"):
        query = (held.writeStream.format("noop").outputMode("update")
                 .option("checkpointLocation", state_dir).trigger(availableNow=True).start())
        query.awaitTermination()
        state = spark.read.format("statestore").load(state_dir)
        return stage(state.select("key.*", "value.*").toDF("digest", "first", "n"), "state")


def at_locators(spark: SparkSession, rows: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``(locator, body)`` of rows ``(locator)`` of earlier runs, read again from the files that their locators name.

    The names of these files come to the driver, not the rows; the files must still be there."""
    files = [r.file for r in rows.select(F.regexp_replace("locator", "#[0-9]+$", "").alias("file")).distinct().collect()]
    if not files:
        return spark.createDataFrame([], "locator string, body string")
    return _with_locator(spark.read.parquet(*files), doc_id, text).join(rows.select("locator").distinct(), "locator", "left_semi").select(
        "locator", "body")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                digest: Callable[[Column], Column] = sha256, state_dir: str | None = None,
                ) -> DataFrame:
    """One row per row of ``docs``: ``(id, locator, digest, keep_id, keep_locator, group_size)``.

    With a ``state_dir``, rows of earlier calls with it count too: arrivals are appended to a log in it, beside
    the state, and the texts of earlier rows are read through their locators where a hit needs them. Rows that are
    given twice count twice."""
    spark = docs.sparkSession
    content = located(docs, doc_id, text)
    log = f"{state_dir}/arrivals" if state_dir else shared_dir(spark, "arrivals")
    schema = "id bigint, locator string, digest string"
    arrivals = content.select("id", "locator", digest(normalised(F.col("body"))).alias("digest"))
    if state_dir:  # this call's rows, then those of all calls
        arrivals = stage(arrivals, "arrivals")
        arrivals.write.mode("append").parquet(log)
    else:
        arrivals.write.parquet(log)
        arrivals = spark.read.schema(schema).parquet(log)
    if arrivals.isEmpty():  # nothing to stream
        return arrivals.select("*", F.col("id").alias("keep_id"), F.col("locator").alias("keep_locator"),
                               F.lit(1).cast("bigint").alias("group_size"))
    stream = spark.readStream.schema(schema).parquet(log)
    state = observe(spark, stream, f"{state_dir}/state" if state_dir else shared_dir(spark, "dedup-state"))
    decided = arrivals.join(state, "digest").select(
        "id", "locator", "digest", F.col("first.id").alias("keep_id"),
        F.col("first.locator").alias("keep_locator"), F.col("n").alias("group_size"))

    hits = decided.where("group_size > 1").select("id", "locator", "digest", "keep_locator")
    texts = stage(content.select("locator", "body").join(hits, "locator").select(
        "id", "locator", "digest", "keep_locator", normalised(F.col("body")).alias("body")), "hits")
    if state_dir:  # and the rows of earlier calls under these digests
        met = hits.select("digest", "keep_locator").distinct()
        before = stage(spark.read.schema(schema).parquet(log).join(met, "digest").join(
            arrivals.select("locator"), "locator", "left_anti").select("id", "locator", "digest", "keep_locator"), "before")
        bodies = at_locators(spark, before, doc_id, text).select("locator", normalised(F.col("body")).alias("body"))
        texts = stage(texts.unionByName(before.join(bodies, "locator")), "hits-of-all")
    stays = texts.where("locator = keep_locator").select("digest", F.col("body").alias("kept_body"))
    stays = stays.distinct() if state_dir else stays  # a row that was given twice
    differ = stage(texts.where("locator != keep_locator").join(stays, "digest")
                   .where("body != kept_body").select("digest"), "differ")
    if differ.isEmpty():
        return decided
    exact = texts.join(differ, "digest", "left_semi")
    groups = exact.groupBy("digest", "body").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "locator")).alias("own"), F.count(F.lit(1)).alias("own_n"))
    own = exact.join(groups, ["digest", "body"]).select("locator", "own", "own_n")
    own = own.distinct() if state_dir else own
    return decided.join(own, "locator", "left").select(
        "id", "locator", "digest",
        F.when(F.col("own").isNull(), F.col("keep_id")).otherwise(F.col("own.id")).alias("keep_id"),
        F.coalesce("own.locator", "keep_locator").alias("keep_locator"),
        F.coalesce("own_n", "group_size").alias("group_size"))


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns. ``docs`` must read files."""
    gone = exact_dedup(docs, doc_id, text).where("locator != keep_locator").select("locator")
    at = F.concat_ws("#", F.col("_metadata.file_path"),
                     F.lpad(F.col("_metadata.row_index").cast("string"), 12, "0"))
    return docs.join(gone.select(F.col("locator").alias("__gone")), at == F.col("__gone"), "left_anti")
