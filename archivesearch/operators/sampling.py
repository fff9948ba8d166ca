"""Reproducible stratified sampling (B1), dense fixed-size batching (B2) and
first-batch selection (B3) over archive members ``(zip_file, member)``.

B1 orders members by ``md5(seed | zip_file | member)`` — repeatable on any
machine, unlike listing order + a seeded RNG — and keeps the first
``quota`` per archive. Skew-safe: a first cut keeps the best ``quota`` per
(archive, salt) sub-group, so the final per-archive window sees at most
``salts * quota`` rows however large one archive is.

B2 numbers the sample densely in (zip_file, hash) order without a global
single-partition window: per-archive counts get an exclusive prefix sum over
the (small) archive table, plus the in-archive rank from B1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from archivesearch.config import IngestParams


def hash_order(seed: int):
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("zip_file"), F.col("member")))


def stratified_sample(members: DataFrame, params: IngestParams = IngestParams(),
                      salts: int = 16) -> DataFrame:
    """(zip_file, member, h, in_zip_rank 0-based) for the sampled members.

    quota = samplesize // n_archives, capped by the archive size; unused quota
    is not redistributed. ``remainder="last"`` gives samplesize % n_archives
    extra to the last archive by name (the intended behaviour);
    ``"none"`` reproduces the observed one.
    """
    m = members.select("zip_file", "member").withColumn("h", hash_order(params.seed))
    n_arch = members.select(F.count_distinct("zip_file")).scalar()
    quota = F.floor(F.lit(params.samplesize) / n_arch)
    if params.remainder == "last":
        last = members.select(F.max("zip_file")).scalar()
        quota = quota + F.when(F.col("zip_file") == last, F.pmod(F.lit(params.samplesize), n_arch)) \
                         .otherwise(F.lit(0))
    m = m.withColumn("quota", quota)
    w1 = Window.partitionBy("zip_file", "salt").orderBy("h", "member")
    first = (m.withColumn("salt", F.pmod(F.xxhash64("member"), F.lit(salts)))
             .withColumn("r1", F.row_number().over(w1))
             .where(F.col("r1") <= F.col("quota")))
    w2 = Window.partitionBy("zip_file").orderBy("h", "member")
    return (first.withColumn("in_zip_rank", (F.row_number().over(w2) - 1).cast("bigint"))
            .where(F.col("in_zip_rank") < F.col("quota"))
            .select("zip_file", "member", "h", "in_zip_rank"))


def all_members(members: DataFrame, seed: int = IngestParams().seed, digits: int = 2) -> DataFrame:
    """Every member with its place in the archive's hash order: B2's input without a sample.

    Members are ranked within the first ``digits`` hex digits of their hash, and the counts of the smaller digits are
    added, so a large archive is ranked by ``16**digits`` tasks."""
    m = members.select("zip_file", "member").withColumn("h", hash_order(seed)).withColumn("slot", F.substring("h", 1, digits))
    smaller = Window.partitionBy("zip_file").orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    before = m.groupBy("zip_file", "slot").agg(F.count(F.lit(1)).alias("n")).select(
        "zip_file", "slot", F.coalesce(F.sum("n").over(smaller), F.lit(0)).alias("before"))
    w = Window.partitionBy("zip_file", "slot").orderBy("h", "member")
    return m.withColumn("own", F.row_number().over(w) - 1).join(before, ["zip_file", "slot"]).select(
        "zip_file", "member", "h", (F.col("own") + F.col("before")).cast("bigint").alias("in_zip_rank"))


def assign_batches(sample: DataFrame, batchsize: int) -> DataFrame:
    """B2: ``rn`` dense 0-based over (zip_file, h); ``batch_no = rn // batchsize``."""
    counts = sample.groupBy("zip_file").agg(F.count(F.lit(1)).alias("n"))
    w = Window.orderBy("zip_file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("zip_file", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("offset"))
    rn = F.col("offset") + F.col("in_zip_rank")
    return (sample.join(offsets, "zip_file")
            .withColumn("rn", rn.cast("bigint"))
            .withColumn("batch_no", F.floor(rn / F.lit(batchsize)).cast("bigint"))
            .drop("offset"))


def first_batch(batched: DataFrame) -> DataFrame:
    """Test mode keeps only batch 0."""
    return batched.where(F.col("batch_no") == 0)
