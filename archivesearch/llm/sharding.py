"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``2**ring_bits`` places. Each shard owns ``vnodes`` places; a key
belongs to the next owned place clockwise from the place of its hash. A shard
takes rows only up to its bound; what overflows continues clockwise to the next
shard with room, so the balance is guaranteed and only overflow moves.

Rows are counted per ring place in Spark. The counts (at most ``2**ring_bits``
rows, whatever the input) reach the driver, which walks the ring once and
returns runs ``(place, first rank, last rank, shard, slot)``; rows get their rank
within their place from a window and join the runs.

``slack=0`` bounds shards at ceil or floor of the mean, in all exactly the
number of rows: row counts then differ by at most one. A larger slack
(``(1 + slack) * mean``) moves fewer rows when shards are added.

Defined cases: null ids hash to one fixed place; equal ids share a place and are
ranked by text checksum; a null text counts no bytes; an empty table gives an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from archivesearch.llm.common import text_or_empty

SEED = 7919


def ring_place(key: Column, ring_bits: int) -> tuple[Column, Column]:
    """Hash of a key and its place on the ring."""
    h = F.xxhash64(F.lit(SEED), key)
    return h, F.shiftrightunsigned(h, 64 - ring_bits).cast("int")


def _mixed(x: int) -> int:
    """A fixed 64-bit scramble of an integer."""
    x = (x + 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & 0xFFFFFFFFFFFFFFFF
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & 0xFFFFFFFFFFFFFFFF
    return x ^ (x >> 31)


def ring_nodes(shards: int, vnodes: int, ring_bits: int) -> list[tuple[int, int]]:
    """``(place, shard)`` of each virtual node, clockwise."""
    return sorted((_mixed((s << 20) | v) >> (64 - ring_bits), s) for s in range(shards) for v in range(vnodes))


def bounds(rows: int, shards: int, slack: float) -> list[int]:
    if slack > 0:
        return [max(1, math.ceil(rows * (1 + slack) / shards))] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def walk_ring(counts: dict[int, int], shards: int, vnodes: int, ring_bits: int, slack: float,
              ) -> list[tuple[int, int, int, int, int]]:
    """Runs ``(place, first, last, shard, slot of first)``; ranks and slots from 0, last inclusive."""
    nodes = ring_nodes(shards, vnodes, ring_bits)
    room = bounds(sum(counts.values()), shards, slack)
    after = list(range(len(nodes) + 1))  # next node clockwise that may have room; the last entry wraps
    owner, k = {}, 0
    for place in sorted(counts):
        while k < len(nodes) and nodes[k][0] < place:
            k += 1
        owner[place] = k % len(nodes)

    def with_room(i: int) -> int:
        seen = []
        while True:
            if i == len(nodes):
                i = 0
            if after[i] != i:
                seen.append(i)
                i = after[i]
            elif room[nodes[i][1]] == 0:
                after[i] = i + 1
            else:
                for j in seen:
                    if j < i:
                        after[j] = i
                return i

    filled, runs = [0] * shards, []
    for place in sorted(counts, key=_mixed):
        at, rank, left = owner[place], 0, counts[place]
        while left:
            at = with_room(at)
            shard = nodes[at][1]
            n = min(left, room[shard])
            runs.append((place, rank, rank + n - 1, shard, filled[shard]))
            filled[shard] += n
            room[shard] -= n
            rank, left = rank + n, left - n
    return runs


def shard_rows(docs: DataFrame, shards: int, vnodes: int = 64, ring_bits: int = 16, slack: float = 0.0,
               doc_id: str = "doc_id", text: str = "text", overhead: int = 16) -> DataFrame:
    """``(id, size, text_crc32, place, shard, slot)`` for each row of ``docs``."""
    spark = docs.sparkSession
    h, place = ring_place(F.col(doc_id).cast("bigint"), ring_bits)
    counts = {r["place"]: r["n"] for r in
              docs.select(place.alias("place")).groupBy("place").agg(F.count(F.lit(1)).alias("n")).collect()}
    runs = walk_ring(counts, shards, vnodes, ring_bits, slack)
    # one run per place and one more for each shard that fills up: bounded by the ring
    run_frame = spark.createDataFrame(
        pd.DataFrame(runs, columns=["run_place", "first", "last", "shard", "base"]).astype("int64"),
        "run_place bigint, first bigint, last bigint, shard bigint, base bigint")
    body = text_or_empty(text)
    rows = docs.select(F.col(doc_id).cast("bigint").alias("id"), h.alias("h"), place.alias("place"),
                       (F.octet_length(body) + F.lit(overhead)).cast("bigint").alias("size"),
                       F.crc32(body.cast("binary")).alias("text_crc32"))
    ranked = rows.withColumn("rank", F.row_number().over(
        Window.partitionBy("place").orderBy("h", "id", "text_crc32", "size")) - 1)
    hit = (F.col("place") == F.col("run_place")) & F.col("rank").between(F.col("first"), F.col("last"))
    return ranked.join(F.broadcast(run_frame), hit).select(
        "id", "size", "text_crc32", "place", F.col("shard").cast("int").alias("shard"),
        (F.col("base") + F.col("rank") - F.col("first")).cast("bigint").alias("slot"))
