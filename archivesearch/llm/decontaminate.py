"""Benchmark decontamination with SimHash over item-sized windows.

Words are runs of letters and digits, lower-cased; shingles are ``width`` words,
or all words of an item with fewer.

1. A window of zero common shingles has similarity 0, so windows are laid only
   around shingles that some item has: documents' shingles meet the items'
   shingles, which are broadcast in blocks of at most ``BLOCK`` hashes. Texts, not their words, are shuffled to the hits.
2. Every window of an item's size (the whole text where it is shorter) that holds
   such a shingle gets a 64-bit SimHash of its shingles. Each occurrence of a shingle
   that recurs in a window or item is numbered and is a feature of its own, so that
   the similarity of the weights is that of sets of features.
3. Fingerprints are cut into 8 blocks of 8 bits. Two fingerprints within
   ``radius`` bits differ by at most ``radius // 8`` bits in one block at least, so
   items are indexed under all values that near to each of their blocks, and a join
   on (size, block, value) finds every pair within the radius.
4. Pairs are verified on the shingles' words: each shingle weighs its number of
   occurrences, similarity is the sum of the smaller weights by that of the larger.

At similarity 0.8 the expected distance is 9.7 of 64 bits with a deviation of 2.9;
the default radius of 23 lies 4.6 deviations above, also where shingles recur.

Only DataFrame and SQL functions run on the executors.

Defined cases: null or wordless texts and items match nothing; equal ids are
told apart by their text; repeated rows are reported once; a null id is reported
as null; ties keep the first window; extra columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from archivesearch.llm.common import stage

#: Hashes that one broadcast holds at most (16 bytes each).
BLOCK = 1_000_000
#: Windows whose hashes one task counts, about.
TASK_WINDOWS = 1 << 17
PARTS, PART_BITS = 8, 8


def words(text: str) -> Column:
    lowered = F.lower(F.coalesce(F.col(text).cast("string"), F.lit("")))
    return F.array_remove(F.split(lowered, r"[^\p{L}\p{N}]+"), "")


def doc_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    return F.xxhash64(F.col(doc_id), F.col(text))


def shingle_hash(array: str, at: str, width: int) -> Column:
    return F.expr(f"xxhash64({', '.join(f'{array}[{at} + {j}]' for j in range(width))})")


def numbered(hashes: str) -> Column:
    """An array's hashes, the second and later occurrences of a value replaced by a hash of value and number."""
    later = ("transform(array(sort_array({0})), s -> transform(s, (h, i) -> "
             "if(coalesce(get(s, i - 1) = h, false), xxhash64(h, i - array_position(s, h) + 1), h)))[0]").format(hashes)
    return F.expr(f"if(size(array_distinct({hashes})) = size({hashes}), {hashes}, {later})")


def fingerprint(hashes: DataFrame, keys: list[str], value: str = "h") -> DataFrame:
    """SimHash per key: each bit is the majority of its bit over the hashes, counted two bits to a long."""
    counts = [F.sum(F.expr(f"(shiftright({value}, {2 * j}) & 1L) + shiftleft(shiftright({value}, {2 * j + 1}) & 1L, 32)"))
              .alias(f"c{j}") for j in range(32)]
    lanes = [f"if(2 * {part} > hashes, shiftleft(1L, {bit}), 0L)" for j in range(32) for part, bit in
             ((f"(c{j} & 4294967295L)", 2 * j), (f"shiftright(c{j}, 32)", 2 * j + 1))]
    return hashes.groupBy(*keys).agg(F.count(F.lit(1)).alias("hashes"), *counts).select(
        *keys, F.expr(" | ".join(lanes)).alias("fp"))


def block_values(radius: int) -> list[int]:
    """Changes of one block that a pair within the radius has in one block at least."""
    return [x for x in range(1 << PART_BITS) if x.bit_count() <= radius // PARTS]


def block_of(fp: str, part: str) -> str:
    return f"(shiftrightunsigned({fp}, {PART_BITS} * {part}) & {(1 << PART_BITS) - 1}L)"


def similar_windows(docs: DataFrame, items: DataFrame, percent: int = 80, width: int = 5, radius: int = 23,
                    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
                    item_text: str = "text") -> DataFrame:
    """``(key, id, item_id, start, n_words, shared, total)``: for each document and item the most similar
    window, where ``100 * shared >= percent * total``. ``key`` is :func:`doc_key` of the row."""
    items = stage(items.select(F.col(item_id).alias("item_id"), words(item_text).alias("iw")).select(
        "*", F.size("iw").alias("n"), F.least(F.size("iw"), F.lit(width)).alias("k")).where("n > 0"), "items")
    widths = sorted(r.k for r in items.select("k").distinct().collect())  # at most ``width`` values
    found = [_of_width(docs, items.where(F.col("k") == k), k, percent, radius, doc_id, text) for k in widths]
    if not found:
        return docs.select(doc_key(doc_id, text).alias("key"), F.col(doc_id).alias("id")).limit(0).selectExpr(
            "key", "id", "cast(null as bigint) item_id", "0 start", "0 n_words", "0 shared", "0 total")
    return reduce(DataFrame.unionAll, found)


def _of_width(docs: DataFrame, items: DataFrame, k: int, percent: int, radius: int, doc_id: str, text: str) -> DataFrame:
    texts = docs.select(doc_key(doc_id, text).alias("key"), F.col(doc_id).alias("id"), words(text).alias("w"))
    item_hashes = stage(items.select("item_id", "n", F.explode(F.sequence(F.lit(0), F.col("n") - k)).alias("i"), "iw")
                        .select("item_id", "n", shingle_hash("iw", "i", k).alias("h")), "item-hashes")
    seeds = item_hashes.select("h", "n").distinct()
    blocks = max(1, math.ceil(seeds.count() / BLOCK))
    shingled = texts.where(F.size("w") >= k).select(
        "key", F.size("w").alias("size"), "w", F.explode(F.sequence(F.lit(0), F.size("w") - k)).alias("at")).select(
        "key", "size", "at", shingle_hash("w", "at", k).alias("h"))
    hits = reduce(DataFrame.unionAll, [
        shingled.join(F.broadcast(seeds.where(F.pmod(F.col("h"), F.lit(blocks)) == b)), "h") for b in range(blocks)])

    # starts of the windows of n words around the hits of one document
    at_hits = hits.groupBy("key", "n").agg(F.collect_set("at").alias("at"), F.max("size").alias("size"))
    starts = at_hits.select("key", "n", F.expr(
        f"array_distinct(flatten(transform(at, p -> sequence(greatest(0, least(p - (n - {k}), size - n)), "
        "greatest(0, least(p, size - n))))))").alias("starts"))
    # whole texts meet the starts, are kept and sorted, and are split into words where these are used: arrays of words
    # take several times the memory
    around = stage(docs.select(doc_key(doc_id, text).alias("key"), F.col(doc_id).alias("id"), F.col(text).alias("text")).join(
        starts, "key").select("key", "id", "n", "starts", "text"), "windows")
    # a window takes some 400 bytes while its hashes are counted: tasks by the number of windows, not of bytes read
    n_windows = around.select(F.coalesce(F.sum(F.size("starts")), F.lit(0))).first()[0]
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, math.ceil(n_windows / TASK_WINDOWS))
    hashed = around.repartition(tasks, "key", "n").dropDuplicates(["key", "n"]).select("key", "n", "starts", words("text").alias("w")).select(
        "key", "n", "starts", F.expr(f"transform(sequence(0, size(w) - {k}), i -> "
                                     f"xxhash64({', '.join(f'w[i + {j}]' for j in range(k))}))").alias("hs"))
    each = hashed.select("key", "n", "hs", F.explode("starts").alias("start")).select(
        "key", "n", "start", F.expr(f"slice(hs, start + 1, n - {k} + 1)").alias("hs")).select(
        "key", "n", "start", F.explode(numbered("hs")).alias("h"))
    windows = fingerprint(each, ["key", "n", "start"]).select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part")).select(
        "*", F.expr(block_of("fp", "part")).alias("value"))

    near = F.array(*[F.lit(x) for x in block_values(radius)])
    occurrences = item_hashes.groupBy("item_id", "n").agg(F.collect_list("h").alias("hs")).select(  # of one item
        "item_id", "n", F.explode(numbered("hs")).alias("h"))
    index = stage(fingerprint(occurrences, ["item_id", "n"]).withColumnRenamed("fp", "item_fp").select(
        "*", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("part"), near.alias("near")).select(
        "item_id", "n", "item_fp", "part", F.explode("near").alias("change")).select(
        "item_id", "n", "item_fp", "part", F.expr(f"{block_of('item_fp', 'part')} ^ change").alias("value")), "index")
    # a pair may meet in several blocks; the first of them stands for it
    first = "case " + " ".join(
        f"when bit_count({block_of('(fp ^ item_fp)', str(p))}) <= {radius // PARTS} then {p}" for p in range(PARTS)) + " end"
    pairs = windows.join(index, ["n", "part", "value"]).where(
        (F.expr("bit_count(fp ^ item_fp)") <= radius) & (F.expr(first) == F.col("part"))).select(
        "key", "n", "item_id", "start")
    by_doc = pairs.groupBy("key", "n", "item_id").agg(F.collect_list("start").alias("found"))

    def bag(array: str, start: str, n: str) -> Column:
        return F.expr(f"transform(sequence({start}, {start} + {n} - {k}), i -> concat_ws(' ', slice({array}, i + 1, {k})))")

    pairs_of = around.drop("starts").join(by_doc, ["key", "n"]).join(items.select("item_id", "iw"), "item_id").select(
        "key", "id", "n", "item_id", "iw", "found", words("text").alias("w"))
    bags = pairs_of.withColumn("b", bag("iw", "0", "n")).withColumn("start", F.explode("found")).withColumn(
        "a", bag("w", "start", "least(n, size(w))"))
    distinct = "size(array_distinct(a)) = size(a) AND size(array_distinct(b)) = size(b)"
    counted = ("aggregate(array_distinct(b), 0, (sum, s) -> sum + least(size(filter(a, x -> x = s)), "
               "size(filter(b, x -> x = s))))")
    verified = bags.withColumn("shared", F.expr(f"if({distinct}, size(array_intersect(a, b)), {counted})")).withColumn(
        "total", F.expr("size(a) + size(b) - shared")).where(F.col("shared") * 100 >= F.col("total") * percent)
    best = F.min(F.struct((-F.col("shared") / F.col("total")).alias("s"), "start", "shared", "total")).alias("best")
    return verified.groupBy("key", "id", "item_id", F.col("n").alias("n_words")).agg(best).select(
        "key", "id", F.col("item_id").cast("bigint").alias("item_id"), "best.start", "n_words", "best.shared", "best.total")


def without_benchmark(docs: DataFrame, items: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that hold no window similar to an item, with all their columns."""
    found = stage(similar_windows(docs, items, percent).select(F.col("key").alias("__key")).distinct(), "contaminated")
    return docs.join(found, doc_key() == F.col("__key"), "left_anti")
